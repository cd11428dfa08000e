"""Substring dedup by content-defined chunking with a gear rolling hash.

White space: each run of it counts as one space wherever texts are cut or compared, so a
passage repeats whatever its line breaks are; places reported are those of the text itself.

Copies: documents with the same words are found by a digest first. The smallest doc_id
stands for them, and only its text goes on.

Chunks: over the bytes of a text with its white space made single spaces, the gear hash of
a place is h = 2 * h + table[byte] modulo 2**32, so it knows the last 32 bytes only. The
hashes at the ends of words are winnowed: of every ``reach`` words in a row the one with
the smallest hash, the last of equal ones, ends a chunk. What stands before a passage, or
is inserted there, moves no cut that a run of ``reach`` words inside it decides. Chunks
longer than ``MOST`` bytes are cut there. Chunks are deduplicated by digest: those of two
documents or more are shared.

Why no passage is lost: let two documents share ``least_words`` words. A word takes two
bytes at least, so from the 17th word on all hashes are those of the passage alone, and
with ``reach`` = (least_words - 18) / 2 two runs of words that don't meet lie behind it.
The cuts of the first run, of the last and all between are the same in both documents, so
both have all chunks between these cuts: there is one at least, and each of them is
shared. Only windows of ``least_words`` words whose chunks are all shared may therefore
repeat; these are deduplicated by a 128-bit digest as well, and those of two documents or
more are the repeats. A window's first document owns it, in every other it is a copy.

The shared chunks reach the tasks as a Bloom filter, at most 2**MOST_BITS bits whatever the
corpus. It only saves work: windows it lets through by chance share their digest with none.

Spans: windows that follow each other word by word in a document and have one owner make
up a span, reported in the copy (kept false) and in its owner (kept true). Every window of
a span stands in its owner. In text that repeats itself, as one line over and over, windows
of a span may stand at the same place of the owner; ``owner_start`` is the first of them,
and the owner's own row tells how far they reach there.

Edge cases: null and empty texts and those under ``least_words`` words have no passage. Rows
with a null doc_id have no place that could be named and are left out. Rows of one doc_id
with different texts are texts of one document: each is searched, but what only they share
is no repeat. Rows repeated with their id are one. What repeats within one document only
is no repeat. An empty table gives no rows. Columns other than doc_id and text are not read.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from tickwell.llm.common import stored, utf8

MOST, LEAST_WORDS = 512, 50
#: Words within which a hash may still know bytes from before: 32 bytes are 16 of the shortest words.
CONTEXT_BYTES, CONTEXT_WORDS = 32, 16
#: A filter has some bits for each shared chunk, 2**28 (32 MB) at most.
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 16, 28
#: Copies of whole texts that are sent to all tasks, 16 bytes each; more are shuffled.
BROADCAST_ROWS = 1_000_000
#: Words of a text that are worked on at once.
PART = 1 << 16
_PLAIN = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")
_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: Fixed pseudo-random numbers, one per byte.
GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
WINDOW = ["hi", "lo", "doc_id", "key", "word", "from", "to"]


def collapsed(raw: bytes) -> bytes:
    """A text with each run of white space made one space."""
    out = raw.translate(_PLAIN)
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte, by doubling the window: 1, 2, 4, ... 32 bytes."""
    h = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        wide = h.copy()
        wide[width:] += h[:-width] << np.uint32(width)
        h = wide
    return h


def smallest(values: np.ndarray, reach: int) -> np.ndarray:
    """Minima of each ``reach`` values in a row."""
    out, width = values, 1
    while width < reach:
        step = min(width, reach - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def words_of(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start and end."""
    inside = ~_SPACE[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(np.diff(np.r_[False, inside, False]))
    return edges[::2], edges[1::2]


def reach_of(least_words: int) -> int:
    if least_words < CONTEXT_WORDS + 4:
        raise ValueError(f"passages of {CONTEXT_WORDS + 4} words at least")
    return (least_words - CONTEXT_WORDS - 2) // 2


def winnowed(h: np.ndarray, reach: int) -> np.ndarray:
    """For each ``reach`` words in a row the last of those with the smallest hash."""
    later = np.uint64(0xFFFFFFFF) - np.arange(len(h), dtype=np.uint64)
    least = smallest((h.astype(np.uint64) << np.uint64(32)) | later, min(reach, len(h)))
    return (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype(np.int64)


def ends(raw: bytes, reach: int | None = None, most: int = MOST) -> np.ndarray:
    """Where the chunks of a collapsed text that isn't empty end."""
    start, end = words_of(raw)
    cuts = np.zeros(0, np.int64)
    if len(end):
        cuts = end[np.unique(winnowed(gear(np.frombuffer(raw, np.uint8))[end - 1], reach or reach_of(LEAST_WORDS)))]
    cuts = np.unique(np.r_[0, cuts, len(raw)])
    gaps = np.diff(cuts)
    if gaps.max() > most:
        extra = [np.arange(a + most, b, most) for a, b in zip(cuts[:-1][gaps > most], cuts[1:][gaps > most], strict=True)]
        cuts = np.unique(np.concatenate([cuts, *extra]))
    return cuts[1:]


class Cut:
    """A part of a text that is worked on at once: its words, its cuts and the chunks between them."""

    def __init__(self, flat: bytes, start: np.ndarray, end: np.ndarray, reach: int):
        base = int(start[0])
        self.flat, self.start, self.end = flat[base : int(end[-1])], start - base, end - base
        self.least = winnowed(gear(np.frombuffer(self.flat, np.uint8))[self.end - 1], reach)
        self.cuts = np.unique(self.least)

    def digests(self) -> np.ndarray:
        """Of the chunk between each cut and the next; those longer than ``MOST`` by a digest of the pieces they are cut into."""
        lows, highs = self.start[self.cuts[:-1] + 1], self.end[self.cuts[1:]]
        flat = self.flat
        out = [xxh3_64_intdigest(flat[a:b]) if b - a <= MOST else _of_pieces(flat[a:b]) for a, b in zip(lows.tolist(), highs.tolist(), strict=True)]
        return np.array(out, np.uint64).view(np.int64)

    def windows(self, shared: np.ndarray, n: int, reach: int) -> np.ndarray:
        """Windows of n words all of whose chunks are ``shared``, by their first word."""
        first = np.arange(len(self.start) - n + 1)
        # The first word whose hash knows the window's bytes alone, and the cuts of the first and last run behind it.
        alone = np.searchsorted(self.end, self.start[first] + CONTEXT_BYTES)
        low, high = (np.searchsorted(self.cuts, self.least[at]) for at in (alone, first + n - reach))
        known = np.cumsum(np.r_[0, shared])
        return first[known[high] - known[low] == high - low]


def _of_pieces(chunk: bytes) -> int:
    return xxh3_64_intdigest(b"".join(xxh3_128_digest(chunk[i : i + MOST]) for i in range(0, len(chunk), MOST)))


def parts(raw: bytes, least_words: int):
    """(number of its first word, Cut) of a text part by part; parts overlap, so that each window lies in one."""
    flat, reach = collapsed(raw), reach_of(least_words)
    start, end = words_of(flat)
    for low in range(0, len(start) - least_words + 1, PART):
        part = slice(low, low + PART + least_words - 1)
        yield low, Cut(flat, start[part], end[part], reach)


def _own(docs: DataFrame) -> DataFrame:
    """doc_id, key, text: the key tells apart texts of one id."""
    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("key"), "text")


def whole_texts(own: DataFrame, least_words: int) -> DataFrame:
    """(hi, lo, doc_id, key, word, from, to) of each text as if it were one window; ``word`` counts its words."""

    def look(batches):
        for batch in batches:
            rows = []
            for doc_id, key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                start, end = words_of(raw)
                if len(start) >= least_words:
                    low, high = int(start[0]), int(end[-1])
                    digest = xxh3_128_digest(collapsed(raw[low:high]))
                    rows.append((*np.frombuffer(digest, "<i8").tolist(), doc_id, key, len(start), low, high))
            if rows:
                yield [np.array(c) for c in zip(*rows, strict=True)]

    return own.mapInArrow(lambda batches: _gathered(look(batches), WINDOW), ", ".join(f"{c} long" for c in WINDOW))


def _gathered(lists, names: list[str], least: int = 20_000):
    """Arrow batches of lists of columns, put together until they have so many rows."""

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*held, strict=True)], names=names)

    held, n = [], 0
    for columns in lists:
        held.append(columns)
        n += len(columns[0])
        if n >= least:
            yield batch()
            held, n = [], 0
    if held:
        yield batch()


def chunk_digests(own: DataFrame, least_words: int) -> DataFrame:
    """(hi, doc_id) of the chunks of every text that has a window."""

    def look(batches):
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), utf8(batch.column(2)), strict=True):
                for _, part in parts(raw, least_words):
                    digests = np.unique(part.digests())
                    yield [digests, np.full(len(digests), doc_id)]

    return own.mapInArrow(lambda batches: _gathered(look(batches), ["hi", "doc_id"]), "hi long, doc_id long")


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A Bloom filter of the numbers ``hi``, as large as their count asks for; its words reach the driver summed up."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(BITS_EACH * hashes.count() + 1))))
    words = hashes.groupBy(F.shiftright(F.col("hi").bitwiseAND(F.lit((1 << bits) - 1)), 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, int(hi & 63))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint64)


def maybe_in(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) & np.uint64(len(filter_) * 64 - 1)
    return (filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def windows(own: DataFrame, shared: np.ndarray, least_words: int) -> DataFrame:
    """Windows whose chunks may all be shared: digest, place, number of the first word, bytes of the text."""
    reach = reach_of(least_words)

    def look(batches):
        for batch in batches:
            for doc_id, key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                places = None
                for low, part in parts(raw, least_words):
                    first = part.windows(maybe_in(shared, part.digests()), least_words, reach)
                    if not len(first):
                        continue
                    if places is None:
                        places = words_of(raw)
                    last = first + least_words - 1
                    flat = part.flat
                    digests = b"".join([xxh3_128_digest(flat[a:b]) for a, b in zip(part.start[first].tolist(), part.end[last].tolist(), strict=True)])
                    halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
                    n = len(first)
                    yield [halves[:, 0], halves[:, 1], np.full(n, doc_id), np.full(n, key), low + first, places[0][low + first], places[1][low + last]]

    return own.mapInArrow(lambda batches: _gathered(look(batches), WINDOW), ", ".join(f"{c} long" for c in WINDOW))


def copies(found: DataFrame) -> DataFrame:
    """Windows in documents other than the first that has them, with their place in that one."""
    place = F.struct("doc_id", "key", "word", "from", "to")
    owned = found.groupBy("hi", "lo").agg(F.min(place).alias("o"), F.max("doc_id").alias("last")).where("o.doc_id < last")
    owner = [F.col(f"o.{c}").alias(name) for c, name in (("doc_id", "owner"), ("key", "owner_key"), ("from", "owner_from"), ("to", "owner_to"))]
    return found.join(owned.select("hi", "lo", *owner), ["hi", "lo"]).where("doc_id <> owner").drop("hi", "lo")


def spans(copied: DataFrame, least_words: int) -> DataFrame:
    """(doc_id, from, to, words, owner, owner_from, owner_to) of windows that follow each other and have one owner."""
    unit = ["doc_id", "key", "owner", "owner_key"]
    line = Window.partitionBy(*unit).orderBy("word")
    numbered = copied.distinct().withColumn("span", F.col("word") - F.row_number().over(line))
    edges = [F.min("from").alias("from"), F.max("to").alias("to"), F.min("owner_from").alias("owner_from"), F.max("owner_to").alias("owner_to")]
    return numbered.groupBy(*unit, "span").agg(*edges, (F.count("*") + least_words - 1).alias("words")).drop("key", "owner_key", "span")


def repeats(docs: DataFrame, least_words: int = LEAST_WORDS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, start, length, words, owner, owner_start, kept of each repeated span; places in bytes of the text."""
    own = _own(docs)
    same = stored(copies(stored(whole_texts(own, least_words), "texts")).distinct(), "same")
    gone = same.select("doc_id", "key").distinct()
    if same.count() <= broadcast_rows:
        gone = F.broadcast(gone)
    rest = own.join(gone, ["doc_id", "key"], "left_anti")

    chunks = chunk_digests(rest, least_words).groupBy("hi").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = filter_of(stored(chunks.where("first < last").select("hi"), "shared"))
    found = spans(copies(stored(windows(rest, shared, least_words), "windows")), least_words)
    names = ["doc_id", "from", "to", "words", "owner", "owner_from", "owner_to"]
    whole = stored(found.select(*names).unionByName(same.withColumnRenamed("word", "words").select(*names)), "spans")
    length, owner_length = F.col("to") - F.col("from"), F.col("owner_to") - F.col("owner_from")
    copy = whole.select("doc_id", F.col("from").alias("start"), length.alias("length"), "words", "owner", F.col("owner_from").alias("owner_start"), F.lit(False).alias("kept"))
    first = whole.select(F.col("owner").alias("doc_id"), F.col("owner_from").alias("start"), owner_length.alias("length"), "words", "owner", F.col("owner_from").alias("owner_start"), F.lit(True).alias("kept"))
    return copy.unionByName(first.distinct())
