"""Benchmark decontamination by SimHash over item-sized windows.

Words are runs of letters and digits of the lower-cased text, shingles five consecutive
words (all words of an item that has fewer). The weighted similarity of a window and an
item is the sum of the smaller over the sum of the larger of their counts per shingle; a
window leaks an item at 0.8 or more.

Windows: for each length an item has, every window of a document of as many words, at
every word. A window can reach similarity s with an item of m shingles only if s * m of
its own shingles are some item's, so windows below that count, read off a running count,
are passed over; that loses nothing.

Search: 64-bit SimHash over a window's words, weighted by how often they occur. The 64
bits are cut into ``radius + 1`` blocks; fingerprints within the radius agree on one block
at least. For every length and block there is an index of the items by the block's bits,
so looking up a window's blocks yields every item of its length within the radius.

Check: of each document and item, windows are tried from the nearest fingerprint on until
one reaches the similarity, computed exactly on word shingles.

The benchmark is the stated query set. It goes to the tasks in blocks of at most
``per_block`` items; each block passes over all documents.

Edge cases: null and empty texts leak nothing and items without a word are leaked by
nothing. Repeated items are found under each id, and repeated documents give repeated
rows. Empty tables give no rows. Other columns than those named are not read.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tickwell.llm.common import free_name, ranges

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 16
FOUND = "array<struct<item_id: long, start: long, words: long, distance: int, similarity: double>>"
_WORDS = re.compile(r"[^\W_]+")
_MIX = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def similarity(a: list[str], b: list[str], size: int) -> float:
    """Weighted similarity of two word lists, by shingles of ``size`` words."""
    left, right = (Counter(tuple(x[i : i + size]) for i in range(len(x) - size + 1)) for x in (a, b))
    both = sum((left & right).values())
    return both / (sum(left.values()) + sum(right.values()) - both)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((xxh64_intdigest(w.encode(), 0) for w in words), np.uint64, len(words))


def _sums(hashes: np.ndarray) -> np.ndarray:
    """Running sums, from zero, of each bit as +1 or -1."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1
    return np.vstack([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])


def _prints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).ravel()


def _shingle_keys(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit key per run of ``size`` word codes, 0 where a code is 0."""
    n = len(codes) - size + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    key, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(size):
        key += codes[i : i + n] * _MIX[i]
        key ^= key >> np.uint64(29)
        whole &= codes[i : i + n] > 0
    return np.where(whole, key | np.uint64(1), np.uint64(0))


@dataclass
class Length:
    """The items of one number of words."""

    words: int
    size: int
    items: np.ndarray
    prints: np.ndarray
    keys: np.ndarray
    holder: np.ndarray


class Benchmark:
    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS, least: float = SIMILARITY):
        self.radius, self.least = radius, least
        self.ids, self.words = [], []
        for item_id, text in items:
            if words := words_of(text or ""):
                self.ids.append(item_id)
                self.words.append(words)
        self.codes: dict[str, int] = {}
        for words in self.words:
            for w in words:
                self.codes.setdefault(w, len(self.codes) + 1)
        edges = [round(64 * i / (radius + 1)) for i in range(radius + 2)]
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
        keys: dict[int, list[np.ndarray]] = {}
        lengths: dict[int, list[int]] = {}
        for i, words in enumerate(self.words):
            size = min(SHINGLE, len(words))
            keys.setdefault(size, []).append(_shingle_keys(self.coded(words), size))
            lengths.setdefault(len(words), []).append(i)
        self.keys = {size: np.unique(np.concatenate(k)) for size, k in keys.items()}
        self.lengths = [self._length(n, rows) for n, rows in sorted(lengths.items())]

    def coded(self, words: list[str]) -> np.ndarray:
        get = self.codes.get
        return np.array([get(w, 0) for w in words], np.uint64)

    def _block_keys(self, prints: np.ndarray) -> list[np.ndarray]:
        return [((prints >> shift) & mask) + np.uint64(j << 32) for j, (shift, mask) in enumerate(self.blocks)]

    def _length(self, n: int, rows: list[int]) -> Length:
        prints = np.array([_prints(_sums(word_hashes(self.words[i]))[-1:])[0] for i in rows], np.uint64)
        keys = np.concatenate(self._block_keys(prints))
        order = np.argsort(keys, kind="stable")
        return Length(n, min(SHINGLE, n), np.array(rows), prints, keys[order], np.tile(np.arange(len(rows)), len(self.blocks))[order])

    def candidates(self, length: Length, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item of the length, distance) of all pairs within the radius."""
        found = []
        for keys in self._block_keys(prints):
            window, at = ranges(np.searchsorted(length.keys, keys), np.searchsorted(length.keys, keys, side="right"))
            found.append(window * len(length.items) + length.holder[at])
        window, item = np.divmod(np.unique(np.concatenate(found)), len(length.items))
        distance = np.bitwise_count(prints[window] ^ length.prints[item])
        near = distance <= self.radius
        return window[near], item[near], distance[near]

    def found(self, text: str | None) -> list[tuple[int, int, int, int, float]]:
        """(item_id, first word, words, distance, similarity) of each item that the text leaks."""
        if not text or not self.lengths:
            return []
        words = words_of(text)
        codes, counts = self.coded(words), {}
        for size, known in self.keys.items():
            keys = _shingle_keys(codes, size)
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = (known[at] == keys) & (keys > 0)
            if hit.any():
                counts[size] = np.concatenate([[0], np.cumsum(hit)])
        hits: dict[int, list[tuple[int, int, int]]] = {}
        for length in self.lengths:
            if (count := counts.get(length.size)) is None or len(words) < length.words:
                continue
            m = length.words - length.size + 1
            starts = np.flatnonzero(count[m:] - count[:-m] >= self.least * m - 1e-9)
            for window, item, distance in self._near(words, starts, length):
                hits.setdefault(item, []).append((distance, window, length.words))
        out = []
        for item, tries in sorted(hits.items()):
            own = self.words[item]
            size = min(SHINGLE, len(own))
            for distance, start, n in sorted(tries):
                if (s := similarity(words[start : start + n], own, size)) >= self.least - 1e-9:
                    out.append((self.ids[item], start, n, distance, s))
                    break
        return out

    def _near(self, words: list[str], starts: np.ndarray, length: Length, step: int = 16384):
        """(start, item, distance) of candidates, some windows at a time."""
        at = 0
        while at < len(starts):
            low = starts[at]
            end = np.searchsorted(starts, low + step)
            chosen = starts[at:end] - low
            sums = _sums(word_hashes(words[low : low + chosen[-1] + length.words]))
            window, item, distance = self.candidates(length, _prints(sums[chosen + length.words] - sums[chosen]))
            yield from zip((chosen[window] + low).tolist(), length.items[item].tolist(), distance.tolist(), strict=True)
            at = end


def blocks_of(benchmark: DataFrame, per_block: int, radius: int = RADIUS, least: float = SIMILARITY) -> Iterator[Benchmark]:
    """The stated items, ``per_block`` at a time."""
    count = benchmark.count()
    blocks = -(-count // per_block)
    for b in range(blocks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").collect()
        yield Benchmark([(r.item_id, r.text) for r in rows], radius, least)


def finder(block: Benchmark):
    """A column function: text -> the items of the block that it leaks."""

    @F.pandas_udf(FOUND)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("item_id", "start", "words", "distance", "similarity")
        for texts in batches:
            yield pd.Series([[dict(zip(names, hit, strict=True)) for hit in block.found(t)] for t in texts])

    return find


def leaks(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY, per_block: int = 20_000) -> DataFrame:
    """A row per document and item that it leaks: doc_id, item_id, start, words, distance, similarity."""
    found = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start long, words long, distance int, similarity double")
    for block in blocks_of(benchmark, per_block, radius, least):
        found = found.unionByName(docs.select("doc_id", F.explode(finder(block)("text")).alias("f")).select("doc_id", "f.*"))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, radius: int = RADIUS, least: float = SIMILARITY, per_block: int = 20_000) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    found = free_name(docs, "found")
    for block in blocks_of(benchmark, per_block, radius, least):
        docs = docs.withColumn(found, finder(block)("text")).where(F.size(found) == 0).drop(found)
    return docs
