"""Harmonic packing of tokenised documents into sequences of a fixed capacity.

Pieces: a document's ids, an end id after them, are cut at the capacity; what is left is
one piece of length n if the class k = floor(capacity / n) fills its bins to within
``slack`` of the capacity (k pieces of that length), else it is cut at the largest whole
capacity / j that fits, and so on with the rest.

Classes: piece lengths are partitioned by reciprocals of the capacity; class k holds the
lengths in (capacity / (k + 1), capacity / k], any k of which fit a bin. Each worker, the
task that tokenised the documents, fills bins of each class with exactly k of its own
pieces, in order, without asking any other. Its fewer than k remaining pieces of a class
join those of the other workers: prefix sums over one count per worker and class number
them, and again k make a bin. The fewer than k that then remain of each class are one
partial bin per class; partial bins are laid together first-fit, longest first, by one task
that sees one row per class.

Only counts per worker and class are gathered; documents, ids and pieces stay where they
were tokenised until each sequence's pieces meet for their offsets.

Edge cases: a null or empty text is the end id alone. Repeated rows and repeated or null
ids are packed as they come, each row a document. An empty table gives no pieces. Columns
other than doc_id and text are not read.
"""

import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.common import stored, utf8

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin_class long, worker long, number long"
#: Pre-tokens whose ids a Python worker keeps, twice: those in use and those of before.
KEPT_PARTS = 400_000
#: Longer ones are not kept.
LONGEST_KEPT = 64
#: Characters of texts that are looked up together.
AT_ONCE = 1 << 21
#: Fixed value: how a byte-level BPE of this kind cuts a text.
_PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Beyond these scripts what counts as a letter may differ between libraries; the tokenizer decides.
_SETTLED = "\u0530"
_ODD_SPACE = re.compile(r" (?=\s)| \Z")
_UNSETTLED = re.compile(rf"[{_SETTLED}-\U0010ffff]|<\|")
_NOT_CUT = re.compile(rf"{_UNSETTLED.pattern}| |\A\Z")


class WordIds(dict):
    """Ids of whole texts, by way of those of each distinct word with a space before it.

    A byte-level BPE cuts a text before every space that a non-space follows, so ids of
    the parts between these cuts, each with its space, are the ids of the text. The distinct
    words of many texts are cut on into pre-tokens in one go, which go to the tokenizer's
    model one by one and are kept; words that may hold special tokens or unsettled scripts
    go to the tokenizer as they are.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.before: dict[str, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        some = "".join(map(chr, (*range(0x800), *range(0x800, 0xD800, 0x400), *range(0xE000, 0x110000, 0x1000))))
        #: How the model writes each byte.
        self.letters = {b: c for char in some for b, c in zip(char.encode(), spell(char)[0][0], strict=True)}

    def whole(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids) if text else b""

    def __missing__(self, part: str) -> bytes:
        """Ids of one pre-token, or of a text of unsettled scripts."""
        ids = self.before.get(part)
        if ids is None:
            if part.isascii() and part[1:].isalpha():
                # Letters of ASCII are written as they are.
                ids = packed([t.id for t in self.model.tokenize(self.letters[ord(part[0])] + part[1:])])
            elif _UNSETTLED.search(part):
                ids = self.whole(part)
            else:
                ids = packed([t.id for t in self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))])
        if len(part) <= LONGEST_KEPT:
            if len(self) >= KEPT_PARTS:
                # The oldest go first, so that no more than two tables are held at once.
                self.before.clear()
                self.before.update(self)
                self.clear()
            self[part] = ids
        return ids

    def apart(self, text: str) -> bytes:
        """Ids of a text by itself."""
        return self[text] if _UNSETTLED.search(text) else b"".join(map(self.__getitem__, _PRE_TOKENS.findall(text)))

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; some texts at a time, so that a word is looked up once among them."""
        out: list[bytes] = []
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= AT_ONCE:
                out += self._together(some)
                some, size = [], 0
                pa.default_memory_pool().release_unused()
        return out + self._together(some) if some else out

    def _together(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts: each distinct word's once, then copied to where it stands."""
        out: list[bytes] = [b""] * len(texts)
        even, odd = [], []
        for i, text in enumerate(texts):
            (odd if _ODD_SPACE.search(text) else even).append(i)
        split = pc.split_pattern(pa.array((texts[i].partition(" ")[2] for i in even), pa.string()), " ")
        self._copied(even, [texts[i].partition(" ")[0] for i in even], split.offsets.to_numpy(), split.values.dictionary_encode(), out)
        del split
        if odd:
            lists = [parts(texts[i]) for i in odd]
            edges = np.cumsum([0, *(len(x) - 1 for x in lists)])
            self._copied(odd, [x[0] for x in lists], edges, pa.array([w for x in lists for w in x[1:]], pa.string()).dictionary_encode(), out)
        return out

    def _copied(self, where: list[int], firsts: list[str], edges: np.ndarray, words: pa.DictionaryArray, out: list[bytes]) -> None:
        """Sets ids of the texts at ``where``: those of the first word, no space before it, and of the words between two edges."""
        known, starts, sizes = self._of_words(words.dictionary)
        at, edges = words.indices.to_numpy(), edges.tolist()
        for i, first, low, high in zip(where, firsts, edges, edges[1:]):
            own = at[low:high]
            each = sizes[own]
            place = np.repeat(starts[own] - np.cumsum(each) + each, each)
            place += np.arange(len(place))
            out[i] = self.apart(first) + known[place].tobytes()

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first place, number) of words, a space before each; the empty one stands for none."""
        texts = words.to_numpy(zero_copy_only=False)
        letters = pc.ascii_is_alpha(words).to_numpy(zero_copy_only=False)
        single, others = np.flatnonzero(letters), np.flatnonzero(~letters)
        alone = np.fromiter((_NOT_CUT.search(w) is not None for w in texts[others]), bool, len(others))
        joint, alone = others[~alone], others[alone]
        cut = _PRE_TOKENS.findall("".join(" " + w for w in texts[joint]))
        # Each word's first pre-token, and no other, has the space.
        begins = np.flatnonzero(np.fromiter((c[0] == " " for c in cut), bool, len(cut)))
        ids = [self[" " + w] for w in texts[single]]
        ids += map(self.__getitem__, cut)
        ids += [self.apart(" " + w) if w else b"" for w in texts[alone]]
        heads = np.r_[np.arange(len(single)), len(single) + begins, len(single) + len(cut) + np.arange(len(alone))]
        del texts, cut
        each = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        ends = np.r_[0, np.cumsum(each)]
        begin = ends[heads]
        starts, sizes = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        order = np.r_[single, joint, alone]
        starts[order], sizes[order] = begin, np.diff(np.r_[begin, ends[-1]])
        return np.frombuffer(b"".join(ids), "<u4"), starts, sizes


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def parts(text: str) -> list[str]:
    """A text cut at each space that a non-space follows, these spaces left out."""
    words = text.split(" ")
    if not _ODD_SPACE.search(text):
        return words
    out = words[:1]
    for word in words[1:]:
        if word and not word[0].isspace():
            out.append(word)
        else:
            out[-1] += " " + word
    return out


@lru_cache(maxsize=4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def byte_bpe(path: str) -> Callable[[], Callable[[list[str]], list[bytes]]]:
    """What a task calls for its tokenizer; the file's words are kept per Python worker."""
    return lambda: word_ids(path).of


def cuts(length: int, capacity: int, slack: float) -> list[tuple[int, int, int]]:
    """(start, length, class) of a document's pieces."""
    out, at = [], 0
    while at < length:
        n = min(length - at, capacity)
        k = capacity // n
        if capacity - k * n > slack * capacity:
            k += 1
            while capacity // k > n:
                k += 1
            n = capacity // k
            k = capacity // n
        out.append((at, n, k))
        at += n
    return out


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of rows, as many rows at a time as make ``AT_ONCE`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, raw in zip(batch.column(0).cast("int64").to_pylist(), utf8(batch.column(1)), strict=True):
            ids.append(doc_id)
            texts.append(raw.decode())
            size += len(texts[-1])
            if size >= AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def pieces(docs: DataFrame, tokenizer: Callable, end: int, capacity: int, slack: float, keep_ids: bool = False) -> DataFrame:
    """Pieces of each document, numbered per class by the task that cut them."""
    names = [c.split()[0] for c in PIECE.split(", ")] + ["ids"] * keep_ids
    types = [pa.int64()] * 8 + [pa.binary()] * keep_ids

    def cut(batches):
        from pyspark import TaskContext

        worker, ids_of, tail, seen = TaskContext.get().partitionId(), tokenizer(), np.array([end], "<u4").tobytes(), {}
        known_cuts: dict[int, list[tuple[int, int, int]]] = {}
        for ids, texts in together(batches):
            rows = []
            for doc_id, raw in zip(ids, ids_of(texts), strict=True):
                raw += tail
                n = len(raw) // 4
                if (spans := known_cuts.get(n)) is None:
                    spans = cuts(n, capacity, slack)
                    if len(known_cuts) < 8192:
                        known_cuts[n] = spans
                for start, length, k in spans:
                    number = seen.get(k, 0)
                    seen[k] = number + 1
                    piece = raw[4 * start : 4 * (start + length)]
                    rows.append((doc_id, start, length, zlib.crc32(piece), n, k, worker, number) + ((piece,) if keep_ids else ()))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECE + ", ids binary" * keep_ids)


def _lay(capacity: int):
    """Partial bins (bin_class, fill), one per class, laid into sequences: first fit, longest first."""

    def lay(bins: pd.DataFrame) -> pd.DataFrame:
        room: list[int] = []
        at = []
        for piece in bins.sort_values(["fill", "bin_class"], ascending=False).itertuples():
            place = next((i for i, r in enumerate(room) if r >= piece.fill), len(room))
            if place == len(room):
                room.append(capacity)
            at.append((piece.bin_class, place, capacity - room[place]))
            room[place] -= piece.fill
        return pd.DataFrame(at, columns=["bin_class", "place", "before"])

    return lay


def harmonic(cut: DataFrame, capacity: int) -> DataFrame:
    """Adds sequence_id and offset to stored pieces.

    Only tables of at most ``capacity`` rows, one per class, are broadcast.
    """
    counts = cut.groupBy("bin_class", "worker").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("bin_class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    k = F.col("bin_class")
    full, over = F.floor(F.col("n") / k), F.col("n") % k
    spread = stored(
        counts.withColumns({"full": full, "over": over}).withColumns({"full_before": F.coalesce(F.sum("full").over(earlier), F.lit(0)), "over_before": F.coalesce(F.sum("over").over(earlier), F.lit(0))}), "counts"
    )
    bins = spread.groupBy("bin_class").agg(F.sum("full").alias("own"), F.sum("over").alias("shared_pieces"))
    bins = bins.withColumns({"shared": F.floor(F.col("shared_pieces") / k), "bins": F.col("own") + F.floor(F.col("shared_pieces") / k)})
    bins = bins.withColumn("base", F.coalesce(F.sum("bins").over(Window.orderBy("bin_class").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    totals = bins.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("whole"))
    per_worker = spread.join(F.broadcast(bins), "bin_class").select("bin_class", "worker", "full", "full_before", "over_before", "own", "shared", "base")
    placed = cut.join(per_worker, ["bin_class", "worker"])
    own = F.col("number") < F.col("full") * k
    late = F.col("over_before") + F.col("number") - F.col("full") * k
    sequence = (
        F.when(own, F.col("base") + F.col("full_before") + F.floor(F.col("number") / k))
        .when(late < F.col("shared") * k, F.col("base") + F.col("own") + F.floor(late / k))
    )
    slot = F.when(own, F.col("number") % k).otherwise(late % k)
    placed = stored(placed.withColumns({"sequence_id": sequence, "slot": slot}).drop("full", "full_before", "over_before", "own", "shared", "base"), "placed")
    partial = placed.where("sequence_id IS NULL").groupBy("bin_class").agg(F.sum("length").alias("fill"))
    laid = partial.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(_lay(capacity), "bin_class long, place long, before long")
    whole = totals.first()["whole"]
    joined = placed.join(F.broadcast(laid), "bin_class", "left").withColumns({"sequence_id": F.coalesce("sequence_id", F.lit(whole) + F.col("place")), "before": F.when(F.col("sequence_id").isNull(), F.col("before"))})
    order = Window.partitionBy("sequence_id").orderBy(F.coalesce("before", F.lit(0)), "bin_class", "slot").rowsBetween(Window.unboundedPreceding, -1)
    return joined.withColumn("offset", F.coalesce(F.sum("length").over(order), F.lit(0))).drop("place", "before", "slot", "worker", "number")


def pack(docs: DataFrame, tokenizer: Callable, end: int = 1, capacity: int = 2048, slack: float = 1 / 64, keep_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, bin_class, sequence_id, offset, and its ids if asked for."""
    return harmonic(stored(pieces(docs, tokenizer, end, capacity, slack, keep_ids), "pieces"), capacity)


def sequences(packed: DataFrame, capacity: int = 2048, pad: int = 0) -> DataFrame:
    """(sequence_id, ids, used) of pieces with ids: little-endian 32-bit ids, padded to the capacity unless ``used`` is a power of two."""
    runs = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("runs"), F.sum("length").alias("used"))
    ids = F.aggregate("runs", F.lit(b""), lambda a, r: F.concat(a, r.ids))
    power = F.bit_count("used") == 1
    missing = F.when(power, F.lit(0)).otherwise(capacity - F.col("used")).cast("int")
    return runs.select("sequence_id", F.concat(ids, F.unhex(F.repeat(F.lit(pad.to_bytes(4, "little").hex()), missing))).alias("ids"), "used")
