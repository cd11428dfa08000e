"""Language identification with bit-sliced n-gram filters.

Learning: over all training texts, the rate of each byte n-gram (lower-cased text, runs of
anything but letters as one space) is worked out per language, each document counting by
its n-grams. An n-gram belongs to a language if its rate there is at least ``floor`` and at
least ``share`` of its highest rate in any language. As rates of a language sum to one, it
has at most 1 / floor n-grams, whatever the corpus; that bounds the filters and their size.

Filters: one Bloom filter per language, all with the same hash functions, stored sliced:
word i holds bit i of every language's filter, so that the AND of an n-gram's few words is
the bit mask of all languages that contain it. Up to 64 languages share a word; more take
further slices.

Deciding: per language, the number of n-grams of a text whose mask has its bit, less what
a filter of its fill would accept by chance: (hits - n * p) / (1 - p). The largest wins;
ties go to the language first in alphabetical order. The score is the winner's part of the
sum of the two largest, 0 if no n-gram is known.

Edge cases: null texts and texts without a letter are ``und`` with score 0. Texts with
letters but no known n-gram get the language with most training n-grams, score 0. With no
training row every text is ``und``. Repeated rows count as often as they occur. Columns
other than those named are not read.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import free_name, stored

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_ORDERS = (3, 4)
#: Bytes to keep: a-z and all above ASCII; anything else becomes a space.
_KEEP = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def grams_of(text: str) -> np.ndarray:
    """All byte n-grams of a text as numbers; the order is told by the leading byte."""
    data = np.frombuffer(b" " + b" ".join(text.lower().encode().translate(_KEEP).split()) + b" ", np.uint8).astype(np.uint32)
    three = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return np.concatenate([three, (three[:-1] << 8) | data[3:]])


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of rows (lang, text), counted per task before they are sent."""

    def count(batches):
        for batch in batches:
            frame = batch.to_pandas()
            for lang, texts in frame.groupby("lang").text:
                parts, size = [], 0
                for text in texts:
                    parts.append(grams_of(text))
                    size += len(parts[-1])
                    if size > 2_000_000:
                        yield packed(lang, parts)
                        parts, size = [], 0
                if parts:
                    yield packed(lang, parts)

    def packed(lang, parts):
        grams, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL").mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Filters:
    """Bloom filters of all languages, sliced by position."""

    def __init__(self, langs: list[str], bits: int = 18, hashes: int = 3):
        self.langs, self.bits, self.hashes = langs, bits, hashes
        slices = max(1, -(-len(langs) // 64))
        kind = np.uint8 if len(langs) <= 8 else np.uint64
        self.words = np.zeros((slices, 1 << bits), kind)
        self.chance: list[float] = []
        self.fallback = 0

    def _places(self, grams: np.ndarray) -> list[np.ndarray]:
        a = grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        shift = np.uint64(64 - self.bits)
        out = []
        for _ in range(self.hashes):
            out.append(a >> shift)
            a = (a ^ (a >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return out

    def add(self, lang: int, grams: np.ndarray) -> None:
        kind = self.words.dtype.type
        for place in self._places(grams):
            self.words[lang // 64, place] |= kind(1 << (lang % 64))

    def close(self) -> None:
        """Fixes each language's chance of accepting an n-gram that it doesn't hold."""
        kind = self.words.dtype.type
        fill = [float(((self.words[i // 64] >> kind(i % 64)) & kind(1)).mean()) for i in range(len(self.langs))]
        self.chance = [min(f**self.hashes, 0.99) for f in fill]

    def hits(self, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per text and language, the n-grams whose mask has the language's bit."""
        masks = []
        for words in self.words:
            first, *others = self._places(grams)
            mask = words[first]
            for place in others:
                mask &= words[place]
            masks.append(mask)
        kind = self.words.dtype.type
        return np.stack([np.add.reduceat((masks[i // 64] >> kind(i % 64)) & kind(1), starts, dtype=np.int64) for i in range(len(self.langs))], axis=1)

    def decide(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        fit = [i for i, t in enumerate(texts) if t and self.langs and _LETTER.search(t)]
        parts, where = [], []

        def settle():
            sizes = np.array([len(p) for p in parts])
            hits = self.hits(np.concatenate(parts), np.cumsum(sizes) - sizes)
            chance = np.array(self.chance)
            true = np.maximum(0, (hits - sizes[:, None] * chance) / (1 - chance))
            best = true.argmax(axis=1)
            two = np.sort(true, axis=1)[:, -2:].sum(axis=1)
            for i, b, row, total in zip(where, best, true, two, strict=True):
                out[i] = (self.langs[b], float(row[b] / total)) if total > 0 else (self.langs[self.fallback], 0.0)
            parts.clear()
            where.clear()

        size = 0
        for i in fit:
            grams = grams_of(texts[i])
            if len(grams):
                parts.append(grams)
                where.append(i)
                size += len(grams)
            else:
                out[i] = (self.langs[self.fallback], 0.0)
            if size > 500_000:
                settle()
                size = 0
        if parts:
            settle()
        return out


def learn(docs: DataFrame, floor: float = 2e-5, share: float = 0.5) -> Filters:
    """Filters from rows (lang, text); at most 1 / floor n-grams per language reach the driver."""
    counts = stored(gram_counts(docs), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(totals, "lang").groupBy("gram").agg(F.collect_list(F.struct("lang", (F.col("n") / F.col("total")).alias("rate"))).alias("rated"))
    highest = F.array_max(F.transform("rated", lambda r: r.rate))
    own = F.filter("rated", lambda r: (r.rate >= floor) & (r.rate >= share * highest))
    members = rated.select("gram", F.explode(own).alias("r")).groupBy("r.lang").agg(F.collect_list("gram").alias("grams"))
    sizes = {r.lang: r.total for r in totals.collect()}
    held = {r.lang: r.grams for r in members.collect()}
    filters = Filters(sorted(sizes))
    for i, lang in enumerate(filters.langs):
        filters.add(i, np.array(held.get(lang, []), np.int64))
    filters.close()
    filters.fallback = max(range(len(filters.langs)), key=lambda i: (sizes[filters.langs[i]], -i), default=0)
    return filters


def predictor(filters: Filters):
    """A column function: text -> struct<lang, score>. The filters' size is fixed, so each task gets them whole."""

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(filters.decide(texts.tolist()), columns=["lang", "score"])

    return predict


def identify(docs: DataFrame, training: Column) -> DataFrame:
    """doc_id, lang_pred, score of each row, learnt from the rows where ``training`` holds."""
    predict = predictor(learn(docs.where(training)))
    return docs.select("doc_id", predict("text").alias("p")).select("doc_id", F.col("p.lang").alias("lang_pred"), "p.score")


def identified(docs: DataFrame, training: Column) -> DataFrame:
    """``docs`` without the rows that show no language: no letter, or no known n-gram."""
    predict, found = predictor(learn(docs.where(training))), free_name(docs, "found")
    return docs.withColumn(found, predict("text")).where((F.col(found)["lang"] != UNKNOWN) & (F.col(found)["score"] > 0)).select(*docs.columns)
