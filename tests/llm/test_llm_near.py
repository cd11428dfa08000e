import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from llm_tables import DOCS, clashing, components_of, odd_docs, odd_rows, prose
from tickwell.llm import graph, near


def plain(text, size=4):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def clustered(rng, clusters, members, flips):
    centres = rng.integers(0, 1 << 63, clusters, dtype=np.uint64)
    out = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(members):
            for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
                c ^= 1 << int(b)
            out.add(c)
    return np.array(sorted(out), np.uint64)


def test_components_and_fingerprints(spark):
    rows = odd_rows()
    prints = [plain(r[1]) for r in rows]
    root = components_of(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for r, c in zip(rows, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted(((r[0] or -1, p, least.get(c, -1)) for r, p, c in zip(rows, prints, root)))
    found = near.simhash_components(clashing(odd_docs(spark)))
    assert sorted((r.doc_id or -1, r.fp % (1 << 64), -1 if r.component_id is None else r.component_id) for r in found.collect()) == want


@pytest.mark.parametrize("flips", [1, 3, 6])
@pytest.mark.parametrize("one_run", [True, False])
def test_index_links(flips, one_run):
    rng = np.random.default_rng(flips)
    prints = clustered(rng, 40, 30, flips)
    runs = np.zeros(len(prints), np.int64) if one_run else (prints >> np.uint64(60)).astype(np.int64)
    index = near.GrayIndex(prints, runs)
    parent = index.links(4, chunk=100)
    p, r = index.prints, index.runs
    root = components_of(len(p), lambda i, j: r[i] == r[j] and int(p[i] ^ p[j]).bit_count() <= 4)
    assert parent.tolist() == root


def test_gray_rank_orders_neighbours_apart_by_one_bit():
    values = np.arange(256, dtype=np.uint64)
    order = values[np.argsort(near.gray_rank(values))]
    assert (np.bitwise_count(order[1:] ^ order[:-1]) == 1).all()


@pytest.mark.parametrize("cap", [7, 60, 20_000])
def test_all_links_at_any_cap(spark, cap):
    """Small caps cut runs into parts and the bits into more blocks."""
    prints = clustered(np.random.default_rng(9), 30, 12, 4)
    rows = spark.createDataFrame([(int(p.view(np.int64)), i) for i, p in enumerate(prints)], "fp long, rep long")
    label = {r.v: r.component for r in graph.components(near.near_links(rows, 4, cap)).collect()}
    root = components_of(len(prints), lambda i, j: int(prints[i] ^ prints[j]).bit_count() <= 4)
    assert [label.get(i, i) for i in range(len(prints))] == root


def test_blocks_share_out_the_bits():
    for blocks in (5, 6, 8):
        masks = near.block_masks(blocks, 4)
        rng = np.random.default_rng(blocks)
        for _ in range(200):
            flipped = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(flipped & m == 0 for m in masks)


def test_first_of_each(spark):
    docs = clashing(odd_docs(spark).where("doc_id IS NOT NULL"))
    kept = near.first_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    found = near.simhash_components(docs)
    assert sorted(ids) == sorted({r.component_id for r in found.collect()})


def test_null_and_repeated_ids_name_no_component(spark):
    """Different texts stay, whether under null ids or under one repeated id."""
    texts = [prose(3000 + i, 60) for i in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (7, texts[3]), (8, texts[4]), (None, texts[4]), (9, texts[5])]
    prints = [plain(t) for t in texts]
    assert all((a ^ b).bit_count() > 4 for i, a in enumerate(prints) for b in prints[:i])
    kept = near.first_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (8, texts[4]), (9, texts[5])]
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted((i or 0, t) for i, t in want)


def test_fingerprints_of_null_ids_link(spark):
    """A null id's fingerprint joins what lies on both sides of it, and its rows are near copies too."""
    prints = spark.createDataFrame([(1, 0), (None, 0b1111), (2, 0b11111111), (None, 1 << 62 | 0b11111111), (None, 0xFFFF << 40)], "doc_id long, fp long")
    found = {r.fp: r for r in near.near_duplicates(prints).collect()}
    assert {f: r.component for f, r in found.items()} == {0: 0, 0b1111: 0, 0b11111111: 0, 1 << 62 | 0b11111111: 0, 0xFFFF << 40: 0xFFFF << 40}


def test_components_of_long_chains(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = graph.components(edges.unionByName(spark.createDataFrame([(900, 1000), (1000, 950), (5, 5)], "a long, b long")))
    assert {r.v: r.component for r in found.collect()} == {**dict.fromkeys(range(301), 0), 900: 900, 950: 900, 1000: 900}


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCS)
    assert near.simhash_components(docs).count() == 0
    assert near.first_of_each(docs).count() == 0
