"""Ranked lexical search by an Aho-Corasick scan of the documents.

The stated items are dealt into blocks of bounded bytes. A block's distinct terms, each
guarded by a boundary on both sides, become one automaton, which every task builds from
the broadcast block and runs over its texts: what it outputs are the terms' occurrences,
and a table from term to items turns these into scores. There is no index of documents.

A block takes two scans. The first counts, per task, in how many documents each of its
terms occurs, the documents that have a term and their terms; these sums, one row per
term of the block, go to the driver. The second knows the weights, scores each text
against all items of the block and keeps per task the best rows of each item. What the
tasks kept is cut in two steps, first among some tasks each, so that no item's group grows
with the number of tasks by more than its root.

Terms are the maximal runs of ASCII letters and digits and of all characters beyond
ASCII, A-Z in lower case.

Bounds: a block holds ``block_bytes`` of terms and items, or one longer term. An item with
more than that is spread over blocks of its own; its scores are then added up per document
in a shuffle, so none is cut. A task holds ``top`` rows per item of a block and one batch
of scores, SCORES at most.

Edge cases: null and empty texts have no term, on either side, and an item without a term
ranks nothing. Rows of one item_id are one item with the terms of all of them; a null
item_id is an item like any other. Repeated documents are ranked once each; equal scores
go by doc_id, null last. Empty tables give no rows. Other columns are not read.
"""

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import itemgetter

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import batches_of, utf8

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 50
BLOCK_BYTES = 1 << 20
#: What a term of an item takes besides its text.
ROW_BYTES = 64
#: Scores a task holds at a time.
SCORES = 2_000_000
#: Groups of tasks whose best rows are cut first.
TASK_GROUPS = 256

_IS_TERM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
_FOLDED = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 32 for b in range(256))


@dataclass
class Block:
    """Items and their distinct terms; ``members`` lists the terms of each item, item by item from ``starts`` on."""

    whole: bool
    items: list[int | None] = field(default_factory=list)
    terms: list[str] = field(default_factory=list)
    members: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)


def _block(rows: list[tuple], whole: bool) -> Block:
    block, places = Block(whole), {}
    for item, term in rows:
        if not block.items or block.items[-1] != item:
            block.items.append(item)
            block.starts.append(len(block.members))
        block.members.append(places.setdefault(term, len(places)))
    block.terms = list(places)
    return block


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term), each pair once."""
    terms = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), 0)
    return items.select("item_id", F.explode(terms).alias("term")).distinct()


def blocks_of(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of whole items, and blocks of parts of an item that is larger than a block."""
    terms = item_terms(items)
    total = terms.agg(F.sum(F.octet_length("term") + ROW_BYTES)).first()[0] or 0
    dealt = terms.repartitionByRange(1 + total // block_bytes, "item_id", "term").sortWithinPartitions("item_id", "term")
    done, done_size, open_, size, cut = [], 0, [], 0, False
    for item, term in dealt.toLocalIterator():
        if open_ and open_[-1][0] != item:
            if cut:
                yield _block(open_, False)
            elif done_size + size > block_bytes and done:
                yield _block(done, True)
                done, done_size = open_, size
            else:
                done, done_size = done + open_, done_size + size
            open_, size, cut = [], 0, False
        if size >= block_bytes:
            yield _block(open_, False)
            open_, size, cut = [], 0, True
        open_.append((item, term))
        size += len(term.encode()) + ROW_BYTES
    if open_ and cut:
        yield _block(open_, False)
    elif open_ and done_size + size > block_bytes and done:
        yield _block(done, True)
        done = open_
    else:
        done = done + open_
    if done:
        yield _block(done, True)


class Scan:
    """Counts a block's terms in texts."""

    def __init__(self, block: Block):
        self.size = len(block.terms)
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(block.terms):
            self.automaton.add_word(f" {term} ", i)
        self.automaton.make_automaton()

    def terms(self, folded: bytes) -> int:
        """Terms of a text, with repeats."""
        inside = _IS_TERM[np.frombuffer(folded, np.uint8)]
        return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[:1].sum())

    def counts(self, folded: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(term, occurrences) of the block's terms in a text."""
        found = map(itemgetter(1), self.automaton.iter(f" {folded.decode()} "))
        total = np.zeros(self.size, np.int64)
        while len(some := np.fromiter(islice(found, 1_000_000), np.int64)):
            total += np.bincount(some, minlength=self.size)
        present = np.flatnonzero(total)
        return present, total[present]


@dataclass
class Statistics:
    """N, L, and the weight of each term of a block."""

    documents: int
    terms: int
    weights: np.ndarray


class Best:
    """The ``top`` rows of each item so far: highest score, then smallest id, null last."""

    def __init__(self, items: int, top: int):
        self.items, self.top, self.floor = items, top, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 4
        self.new: list[tuple] = []
        self.waiting = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.floor)
        self.new.append((item, ids[doc], nulls[doc], scores[doc, item]))
        self.waiting += len(doc)
        if self.waiting > len(self.rows[0]) + 100_000:
            self.cut()

    def cut(self) -> None:
        item, ids, nulls, scores = (np.concatenate(c) for c in zip(self.rows, *self.new, strict=True))
        order = np.lexsort((ids, nulls, -scores, item))
        first = np.searchsorted(item[order], np.arange(self.items))
        at = np.arange(len(order)) - first[item[order]]
        last = order[at == self.top - 1]
        self.floor[item[last]] = scores[last]
        order = order[at < self.top]
        self.rows = [c[order] for c in (item, ids, nulls, scores)]
        self.new, self.waiting = [], 0


def _document_counts(block: Block):
    """Per task: documents that hold each term; under term -1 the documents that have any, and their terms."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scan(block)
        held, documents, terms = np.zeros(scan.size, np.int64), 0, 0
        for batch in batches:
            for text in utf8(batch.column(0)):
                folded = text.translate(_FOLDED)
                if n := scan.terms(folded):
                    documents, terms = documents + 1, terms + n
                    held[scan.counts(folded)[0]] += 1
        some = np.flatnonzero(held)
        yield from batches_of([([-1, *some], [documents, *held[some]], [terms] + [0] * len(some))], ["term", "documents", "terms"], [pa.int32(), pa.int64(), pa.int64()])

    return count


def statistics(docs: DataFrame, block: Block) -> Statistics:
    counted = docs.select("text").mapInArrow(_document_counts(block), "term int, documents long, terms long")
    sums = {r.term: r for r in counted.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("terms").alias("terms")).collect()}
    documents, terms = (sums[-1].documents, sums[-1].terms) if -1 in sums else (0, 0)
    held = [sums[i].documents if i in sums else 0 for i in range(len(block.terms))]
    weights = [math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in held]
    return Statistics(documents, terms, np.array(weights, np.int64))


def _scored(block: Block, known: Statistics, batches) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """(scores by text and item, ids, whether null, texts), some texts at a time."""
    scan, members, starts = Scan(block), np.array(block.members), np.array(block.starts)
    step = max(1, SCORES // len(block.items))
    for batch in batches:
        texts, column = utf8(batch.column(1)), batch.column(0)
        nulls = column.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = column.fill_null(0).to_numpy()
        for low in range(0, len(texts), step):
            some = texts[low : low + step]
            scores = np.zeros((len(some), len(block.items)), np.int64)
            for row, text in enumerate(some):
                folded = text.translate(_FOLDED)
                present, tf = scan.counts(folded)
                if len(present):
                    m = 50 + 50 * scan.terms(folded) * known.documents // known.terms
                    gain = np.zeros(scan.size, np.int64)
                    gain[present] = known.weights[present] * (1_000_000_000 * tf // (1000 * tf + 20 * m))
                    scores[row] = np.add.reduceat(gain[members], starts)
            yield scores, ids[low : low + step], nulls[low : low + step], some


def _best_rows(block: Block, known: Statistics, top: int):
    import pyarrow as pa

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(block.items), top)
        for scores, ids, nulls, _ in _scored(block, known, batches):
            best.add(scores, ids, nulls)
        best.cut()
        item, ids, nulls, scores = best.rows
        for low in range(0, len(item), 10_000):
            part = slice(low, low + 10_000)
            names = [block.items[i] for i in item[part]]
            docs = pa.array(ids[part], pa.int64(), mask=nulls[part].astype(bool))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), docs, pa.array(scores[part])], names=["item_id", "doc_id", "score"])

    return rank


def _parts_of_scores(block: Block, known: Statistics):
    """All scores above 0, with a digest of the text: what this block adds to items that are not whole in it."""
    import pyarrow as pa

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for scores, ids, nulls, texts in _scored(block, known, batches):
            doc, item = np.nonzero(scores)
            digests = {d: hashlib.sha256(texts[d]).digest() for d in set(doc.tolist())}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.items[i] for i in item], pa.int64()),
                    pa.array(ids[doc], pa.int64(), mask=nulls[doc].astype(bool)),
                    pa.array([digests[d] for d in doc.tolist()], pa.binary()),
                    pa.array(scores[doc, item], pa.int64()),
                ],
                names=["item_id", "doc_id", "digest", "score"],
            )

    return score


def _first(rows: DataFrame, top: int, *groups: str) -> DataFrame:
    order = Window.partitionBy("item_id", *groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``top`` documents of each item by score: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    parts = None
    for block in blocks_of(items, block_bytes):
        known = statistics(texts, block)
        if block.whole:
            rows = texts.mapInArrow(_best_rows(block, known, top), "item_id long, doc_id long, score long")
            some = _first(rows.withColumn("tasks", F.spark_partition_id() % TASK_GROUPS), top, "tasks")
            found = found.unionByName(some.select("item_id", "doc_id", "score"))
        else:
            rows = texts.mapInArrow(_parts_of_scores(block, known), "item_id long, doc_id long, digest binary, score long")
            # Rows that repeat id and text have one score.
            rows = rows.groupBy("item_id", "doc_id", "digest").agg(F.max("score").alias("score"), F.count("*").alias("copies"))
            parts = rows if parts is None else parts.unionByName(rows)
    if parts is not None:
        sums = parts.groupBy("item_id", "doc_id", "digest").agg(F.sum("score").alias("score"), F.max("copies").alias("copies"))
        grouped = _first(sums.withColumn("tasks", F.pmod(F.xxhash64("digest"), F.lit(TASK_GROUPS))), top, "tasks")
        copies = F.explode(F.array_repeat("score", F.least("copies", F.lit(top)).cast("int")))
        found = found.unionByName(grouped.select("item_id", "doc_id", copies.alias("score")))
    return _first(found, top).select("item_id", "rank", "doc_id", "score")
