"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints: texts with A-Z in lower case, words between the six ASCII white-space
characters, shingles of ``size`` words joined by a space, repeats included (fewer words:
the whole sequence). Each shingle's XXH64 (UTF-8, seed 42) votes; a bit is 1 if set in
over half of them. No words: fingerprint zero, which links like any other.

Candidates: the 64 bits are cut into b blocks; two fingerprints within distance r agree
on at least b - r blocks, so they meet under one choice of b - r blocks at least. All
distinct fingerprints are dealt once per choice by the bits they show there (a *run*).
b is the smallest that keeps a run of evenly spread fingerprints under ``cap``; it alters
the number of runs, never the links found.

Index: a task sorts its runs by Gray rank, under which neighbours differ little, and puts
``FANOUT`` neighbours under a node that holds the bits they share, those bits factored out
of the levels below. A query walks down from the root of its run, adds up the differences
at each node's own bits, and leaves a whole group once they exceed r. Groups that already
hang together with the query are left as well, which keeps dense runs cheap.

A run above ``cap`` rows is cut into parts, and each pair of parts is searched by a task
of its own, so a task's rows are bounded by twice the cap and no pair is lost. Each task
returns one link from each fingerprint to the smallest it hangs together with there; the
components of these links are those of all links.

Edge cases: a null text is an empty one (fingerprint zero). Copies of a fingerprint
are one vertex, named by the fingerprint, so that different texts under one doc_id, or
under none, stay apart, and a fingerprint that only null ids bear links like any other. A
component's id is its smallest doc_id, null if it has none. An empty table gives no rows. Columns other than doc_id and text are not
read.
"""

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickwell.llm.common import free_name, ranges, stored
from tickwell.llm.graph import components

SEED, SIZE, RADIUS, FANOUT = 42, 4, 4, 16
_VALUES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_OFFSETS = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: bytes, size: int = SIZE) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        hashes = np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        after = list(itertools.accumulate(len(w) + 1 for w in words))
        starts = itertools.chain((0,), after)
        hashes = np.fromiter((xxh64_intdigest(joined[a : b - 1], SEED) for a, b in zip(starts, after[size - 1 :])), np.uint64, len(words) - size + 1)
    values = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
    votes = values @ _VALUES  # by byte and bit
    return int.from_bytes(np.packbits(2 * votes > len(hashes), axis=1, bitorder="little").tobytes(), "little")


def fingerprinter(size: int = SIZE):
    """A column function: text -> fingerprint as a long."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint((t or "").encode(), size) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return prints


def block_masks(blocks: int, radius: int) -> list[int]:
    """The masks of each choice of ``blocks - radius`` of the 64 bits' blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in itertools.pairwise(edges)]
    return [sum(chosen) for chosen in itertools.combinations(parts, blocks - radius)]


def blocks_for(count: int, radius: int, cap: int) -> int:
    """The fewest blocks that leave at most a sixteenth of ``cap`` evenly spread fingerprints in a run."""
    return next(b for b in range(radius + 1, 64) if b == 16 or count * 16 <= cap << (64 * (b - radius) // b))


def gray_rank(values: np.ndarray) -> np.ndarray:
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Runs of fingerprints in Gray order under nodes of shared bits. ``order`` is the order it keeps them in."""

    def __init__(self, prints: np.ndarray, runs: np.ndarray):
        self.order = np.lexsort((gray_rank(prints), runs))
        self.prints, self.runs = prints[self.order], runs[self.order]
        ones, zeros, run = self.prints, ~self.prints, self.runs
        self.levels = []  # from the rows up: values, own bits, first child, end, run
        while True:
            first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
            number = np.arange(len(run)) - np.repeat(first, np.diff(np.r_[first, len(run)]))
            heads = np.flatnonzero(number % FANOUT == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, heads), np.bitwise_and.reduceat(zeros, heads)
            self.levels.append([ones, ones | zeros, heads, np.r_[heads[1:], len(run)]])
            if len(heads) == len(first):
                break
            run = run[heads]
        for upper, lower in zip(self.levels[:0:-1], self.levels[-2::-1], strict=True):
            lower.append(lower[1] & ~np.repeat(upper[1], upper[3] - upper[2]))
        self.levels[-1].append(self.levels[-1][1])
        top = np.arange(len(self.levels[-1][2]))
        for level in self.levels[::-1]:
            top = np.repeat(top, level[3] - level[2])
        self.root = top  # of each row

    def links(self, radius: int, chunk: int = 2048):
        """For each row the first row that it hangs together with through links within the radius."""
        n = len(self.prints)
        parent = np.arange(n)

        def settle():
            nonlocal parent
            while ((up := parent[parent]) != parent).any():
                parent = up

        def join(a: np.ndarray, b: np.ndarray):
            pairs = np.unique(np.stack([parent[a], parent[b]], axis=1), axis=0)
            for x, y in pairs[pairs[:, 0] != pairs[:, 1]].tolist():
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)
            settle()

        near = np.flatnonzero((self.runs[1:] == self.runs[:-1]) & (np.bitwise_count(self.prints[1:] ^ self.prints[:-1]) <= radius)) if n else np.zeros(0, int)
        heads = np.ones(n, bool)
        heads[near + 1] = False
        parent = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
        for start in range(0, n, chunk):
            query = np.arange(start, min(n, start + chunk))
            low, high, spans = parent, parent, []
            for level in self.levels:
                low, high = np.minimum.reduceat(low, level[2]), np.maximum.reduceat(high, level[2])
                spans.append((low, high))
            node, sum_ = self.root[query], np.zeros(len(query), np.int64)
            for level, (low, high) in zip(self.levels[::-1], spans[::-1], strict=True):
                values, _, first, end, own = level
                sum_ = sum_ + np.bitwise_count((self.prints[query] ^ values[node]) & own[node])
                stay = (sum_ <= radius) & ~((low[node] == high[node]) & (low[node] == parent[query]))
                query, node, sum_ = query[stay], node[stay], sum_[stay]
                owner, node = ranges(first[node], end[node])
                query, sum_ = query[owner], sum_[owner]
            hit = (node > query) & (np.bitwise_count(self.prints[query] ^ self.prints[node]) <= radius)
            if hit.any():
                join(query[hit], node[hit])
        return parent


def _search(radius: int):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        prints = group.fp.to_numpy(np.int64).view(np.uint64)
        index = GrayIndex(prints, group.run.to_numpy())
        parent = index.links(radius)
        names = group.rep.to_numpy()[index.order]
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, parent, names)
        to = least[parent]
        own = names != to
        return pd.DataFrame({"a": names[own], "b": to[own]})

    return search


def near_links(vertices: DataFrame, radius: int = RADIUS, cap: int = 20_000) -> DataFrame:
    """Links (a, b) that join all of ``vertices`` (fp, rep) within the radius into their components."""
    count = vertices.count()
    masks = block_masks(blocks_for(count, radius, cap), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    choice = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(signed)]))
    rows = vertices.select("fp", "rep", choice.alias("c")).select("fp", "rep", F.xxhash64("c.i", "c.bits").alias("key"))
    large = rows.groupBy("key").count().where(F.col("count") > cap).select("key", F.ceil(F.col("count") / cap).cast("int").alias("parts"))
    cut = rows.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64("fp", "key"), F.col("parts")).cast("int")
    pairs = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.least(own, o).cast("long") * F.col("parts") + F.greatest(own, o))
    )
    dealt = cut.select("fp", "rep", "key", F.explode(pairs).alias("pair")).select("fp", "rep", F.xxhash64("key", "pair").alias("run"))
    groups = max(1, math.ceil(count * len(masks) / cap))
    return dealt.withColumn("task", F.pmod("run", F.lit(groups))).groupBy("task").applyInPandas(_search(radius), "a long, b long")


def near_duplicates(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, rep, component) of rows (doc_id, fp): each fingerprint, its smallest doc_id, its component's smallest fingerprint."""
    vertices = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "prints")
    label = components(near_links(vertices.select("fp", F.col("fp").alias("rep")), radius))
    return vertices.join(label, vertices["fp"] == label["v"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("component"))


def simhash_components(docs: DataFrame, size: int = SIZE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp (long), component_id of each row of ``docs``."""
    prints = stored(docs.select("doc_id", fingerprinter(size)("text").alias("fp")), "fingerprints")
    found = stored(near_duplicates(prints, radius), "components")
    named = found.join(found.groupBy("component").agg(F.min("rep").alias("component_id")), "component")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, size: int = SIZE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: its smallest doc_id (null if it has no other), one of its rows if repeated.

    A row is named by doc_id and fingerprint; where one row alone has a doc_id, that suffices.
    """
    prints = stored(docs.select("doc_id", fingerprinter(size)("text").alias("fp")), "fingerprints")
    best = near_duplicates(prints, radius).groupBy("component").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("best"))
    rows_of = prints.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    n, own, same = (free_name(docs, c) for c in ("n", "kept_id", "kept_fp"))
    kept = best.select(F.col("best.rep").alias(own), F.col("best.fp").alias(same)).join(rows_of.withColumnRenamed("n", n), F.col(own) == F.col("doc_id"), "left").drop("doc_id")
    kept = stored(kept.withColumn(n, F.coalesce(n, F.lit(2))), "kept")  # null ids are told apart by their fingerprint
    lone, others = kept.where(F.col(n) == 1).drop(same), kept.where(F.col(n) > 1)
    single = docs.join(lone, docs["doc_id"] == lone[own])
    ids = others.where(F.col(own).isNotNull()).select(F.col(own).alias(own)).distinct()
    doubtful = docs.join(ids, docs["doc_id"] == ids[own], "left_semi").unionByName(docs.where("doc_id IS NULL"))
    fp = free_name(docs, "fp")
    printed = doubtful.withColumn(fp, fingerprinter(size)("text"))
    repeated = printed.join(others, printed["doc_id"].eqNullSafe(others[own]) & (printed[fp] == others[same])).dropDuplicates(["doc_id", fp])
    return single.select(*docs.columns).unionByName(repeated.select(*docs.columns))
