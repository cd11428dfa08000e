import hashlib
import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm_tables import clashing, components_of, odd_docs, odd_rows
from test_llm_exact import digest
from test_llm_near import plain
from tickwell.llm import decontaminate, language
from tickwell.llm.common import fold


def kept_by_force(rows, items):
    """Stages two to four by all pairs; stage one drops only texts without letters here."""
    rows = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    best = {}
    for r in rows:
        if (d := digest(r[1])) not in best or best[d][0] < r[0]:
            best[d] = r
    rows = sorted(best.values())
    prints = [plain(r[1]) for r in rows]
    root = components_of(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    rows = [r for i, r in enumerate(rows) if root[i] == i]
    block = decontaminate.Benchmark(items)
    return [r for r in rows if not block.found(r[1])]


def test_run_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = kept_by_force(rows, items)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == {i for i, _ in want}
    for doc_id, text in want:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted(found[doc_id], key=lambda r: r.start)
        assert [r.start for r in pieces] == [0, *np.cumsum([r.length for r in pieces])[:-1].tolist()]
        assert sum(r.length for r in pieces) == len(ids)
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in pieces)


def test_stages_keep_the_columns(spark, sf_dir):
    docs = clashing(odd_docs(spark))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        assert out.exceptAll(docs).count() == 0
        empty = stage(spark, docs.where(F.lit(False)), sf_dir)
        assert empty.columns == docs.columns and empty.count() == 0


def test_every_stage_works_on_its_input(spark, sf_dir):
    """Repeated rows go at the second stage even if the first never saw them."""
    docs = odd_docs(spark)
    kept = corpus_pipeline.drop_copies(spark, docs, sf_dir).collect()
    assert len(kept) == len({hashlib.sha256((r[1] or "").lower().encode()).digest() if (r[1] or "").isascii() else digest(r[1]) for r in odd_rows()})


def test_run_on_odd_rows_and_empty_tables(spark, scratch):
    docs = clashing(odd_docs(spark))
    items = spark.createDataFrame([(1, odd_rows()[-1][1])], "item_id long, text string")
    for name, own, benchmark in (("odd", docs, items), ("no_items", docs, items.limit(0)), ("empty", docs.limit(0), items)):
        folder = f"{scratch}/{name}"
        own.write.parquet(f"{folder}/documents.parquet")
        benchmark.write.parquet(f"{folder}/benchmark.parquet")
        found = corpus_pipeline.run(spark, folder).collect()
        if name == "empty":
            assert found == []
            continue
        named = {r.doc_id for r in language.identified(docs, ~fold(5, 0)).collect()}
        rows = [r[:2] for r in odd_rows() if r[0] is not None and r[0] in named]
        want = {r[0] for r in kept_by_force(rows, [tuple(r) for r in benchmark.collect()])}
        assert {r.doc_id for r in found} == want | {None}
        assert not {4, 5, 6, 9} & want and (odd_rows()[-1][0] in want) == (name == "no_items")
        assert all(sum(r.length for r in found if r.doc_id == i) == max(r.doc_tokens for r in found if r.doc_id == i) for i in want)
