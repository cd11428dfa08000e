import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import DOCS, clashing, odd_docs, odd_rows
from tickwell.llm import merkle


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h(told(doc_id), told(source), told(lang), told(n_chars), told(text))


def levels_of(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, at):
    out = []
    for nodes in levels[:-1]:
        low = at // 3 * 3
        out.append(("".join(nodes[low:at]), "".join(nodes[at + 1 : low + 3])))
        at //= 3
    return out


def shown(doc_id, text):
    cut = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
    return text.replace("\n", "") if cut else text


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for source in order:
        own = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, levels_of([leaf(r, r[1]) for r in own])))
    top = levels_of([levels[-1][0] for _, levels in trees])
    out = []
    for at, (own, levels) in enumerate(trees):
        for i, row in enumerate(own):
            path = siblings(levels, i) + siblings(top, at)
            folded = leaf(row, shown(row[0], row[1]))
            for left, right in path:
                folded = h(left, folded, right)
            root = top[-1][0]
            out.append((row[0], leaf(row, row[1]), levels[-1][0], root, path, folded, folded == root))
    return sorted(out, key=str)


def presented():
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def proved(made):
    rows = merkle.proofs(made).collect()
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.siblings], r.folded_root, r.verified) for r in rows), key=str)


def lined(rows):
    return [(i, t.replace(" the ", "\nthe\n", 3) if t else t, *rest) for i, t, *rest in rows]


@pytest.mark.parametrize(("per_part", "levels"), [(16384, 9), (5, 2), (1, 1)])
def test_proofs(spark, per_part, levels):
    rows = lined(odd_rows()) + [(200 + i, "a\nb", "en", f"one source each {i}", i) for i in range(5)]
    docs = clashing(spark.createDataFrame(rows, DOCS)).repartition(3)
    found = proved(merkle.manifest(docs, presented(), per_part, levels))
    assert found == brute(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("rows", [odd_rows()[:1], odd_rows()[:2], [(None, None, None, None, None)] * 4])
def test_small_tables(spark, rows):
    assert proved(merkle.manifest(spark.createDataFrame(rows, DOCS))) == brute(rows)


def test_untouched_documents_verify(spark):
    assert all(r.verified for r in merkle.proofs(merkle.manifest(odd_docs(spark), per_part=7)).collect())


def test_partitions_of_scattered_leaves(spark):
    """Parts that hold any leaves, here by a remainder, fetch what they lack and prove the same."""
    made = merkle.manifest(odd_docs(spark), per_part=7, levels=2)
    part = F.pmod(F.col("pos") * 7 + F.col("tree"), F.lit(4)).cast("long")
    leaves = made.leaves.withColumn("part", part)
    runs = leaves.select("part", "tree", "n", F.col("pos").alias("first"), F.col("pos").alias("last"))
    assert proved(made._replace(leaves=leaves, runs=runs)) == proved(made)


def test_fetched_union_is_minimal(spark):
    """No coordinate twice, none that follows from others; a partition with the whole tree fetches nothing."""
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 4, 10, 27, 100):
        for known in (np.arange(size), rng.choice(size, rng.integers(1, size + 1), replace=False)):
            fetched = [(level, int(i)) for level, places in merkle.missing(known, size) for i in places]
            have, sizes = {0: set(known.tolist())}, [size]
            while sizes[-1] > 1:
                sizes.append(-(-sizes[-1] // 3))
            wanted = []
            for level, n in enumerate(sizes[:-1]):
                parents = {i // 3 for i in have[level]}
                wanted += [(level, i) for p in parents for i in range(3 * p, min(3 * p + 3, n)) if i not in have[level]]
                have[level + 1] = parents
            assert sorted(fetched) == sorted(wanted) and len(set(fetched)) == len(fetched)
            assert len(known) < size or not fetched


def test_no_rows(spark):
    made = merkle.manifest(spark.createDataFrame([], DOCS))
    assert made.nodes.count() == 0 and merkle.proofs(made).collect() == []
