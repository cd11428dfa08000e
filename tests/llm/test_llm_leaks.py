import random

import numpy as np
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, prose
from tickwell.llm import decontaminate as d


def edited(text: str, seed: int) -> str:
    words = text.split()
    words[random.Random(seed).randrange(len(words))] = "changed"
    return " ".join(words)


ITEMS = [(i, prose(500 + i, 20 + 5 * i)) for i in range(12)] + [(20, "two words"), (21, None), (22, " !! "), (23, prose(500, 20))]
LONG = prose(499, 120)


def docs_of(spark):
    rows = [(1000 + i, f"{prose(600 + i, 30)} {text} {prose(700 + i, 25)}") for i, text in ITEMS[:12]]
    rows += [(2000, "SOME " + "!! ".join(LONG.upper().split()) + " end"), (2001, prose(1, 50) + " " + edited(LONG, 3) + " " + prose(2, 9)), (2002, " ".join(LONG.split()[:60]))]
    rows += [(2003, "so two words here"), (2004, None), (2005, ""), (2006, prose(3, 200)), (2007, prose(11, 3000) + " " + LONG + " " + prose(12, 3000))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def brute(docs, items):
    """All windows of an item's length against the item."""
    out = set()
    for doc_id, text in docs:
        words = d.words_of(text or "")
        for item_id, item in items:
            own = d.words_of(item or "")
            if own and any(d.similarity(words[s : s + len(own)], own, min(5, len(own))) >= 0.8 - 1e-9 for s in range(len(words) - len(own) + 1)):
                out.add((doc_id, item_id))
    return out


def test_finds_what_all_windows_find(spark):
    docs, items = docs_of(spark), [*ITEMS, (30, LONG)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute([tuple(r) for r in docs.collect()], items)
    assert len(want) > 14
    for per_block in (20_000, 5):
        found = d.leaks(clashing(docs), bench, per_block=per_block)
        assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_clean_keeps_the_rest(spark):
    docs, bench = clashing(docs_of(spark)), spark.createDataFrame([*ITEMS, (30, LONG)], "item_id long, text string")
    kept = d.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {2002, 2004, 2005, 2006}


def test_index_finds_all_within_the_radius():
    """The blocks' index against every pair."""
    block = d.Benchmark([(i, prose(i, 40)) for i in range(300)])
    (length,) = block.lengths
    rng = np.random.default_rng(0)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 30, 500)], np.uint64)
    prints = rng.choice(length.prints, 500) ^ flips
    got = set(zip(*(x.tolist() for x in block.candidates(length, prints)[:2])))
    near = np.bitwise_count(prints[:, None] ^ length.prints[None]) <= d.RADIUS
    assert got == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_similarity_counts_repeats():
    assert d.similarity("a b a b".split(), "a b a b".split(), 2) == 1
    assert d.similarity("a b a b".split(), "a b c".split(), 2) == 1 / 4


def test_odd_rows(spark):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = odd_docs(spark)
    assert d.leaks(docs, bench).count() == 0
    assert d.clean(docs, bench).count() == docs.count()
    assert d.leaks(spark.createDataFrame([], DOCS), bench).count() == 0
    assert d.leaks(docs, bench.limit(0)).count() == 0
    assert d.clean(docs, bench.where(F.lit(False))).count() == docs.count()
