"""Exact dedup through a minimal perfect hash over the digests of earlier documents.

Texts are equal when identical after lower-casing A-Z; their digest is SHA-256. The
distinct digests of the *history* are dealt to buckets, so many that neither its digests
nor those of the *batch* are over ``per_bucket`` in one on average. Each
bucket gets a minimal perfect hash built in levels: a digest whose place in a level's bit
field no other shares is settled there, the rest go to the next level, and a digest's slot
is the number of settled places before its own. A slot holds the full digest and the
locator of the winner, the largest doc_id. A digest of the *batch* is looked up in its
bucket: any digest leads to some slot, so the slot's bytes are compared, and only an equal
digest is a repeat. Digests that are no members form groups of their own.

Rows are counted per (digest, doc_id) and then per digest before they meet a bucket, so a
text that a third of all rows repeat is one row there; the last join, from rows to their
group, is a plain equi-join that Spark may split.

Edge cases: a null text counts as empty, so empty and null texts are copies of each
other. A null doc_id loses to any other; a group of null ids only has keep_id null and
keeps all its rows. Rows repeated with id and text share their group's fate: all are
counted and, if their id wins, all are marked kept; ``survivors`` leaves one of them. An
empty table gives no rows. Other columns are not read.
"""

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.llm.common import free_name, stored

GROUP = "bucket int, digest binary, winner long, winner_rows long, copies long"


def text_digest(column: str) -> Column:
    """SHA-256 of the UTF-8 text with A-Z in lower case; of no bytes for null."""

    @F.pandas_udf("binary")
    def digest(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: hashlib.sha256((t or "").encode().lower()).digest())

    return digest(column)


def _places(halves: np.ndarray, level: int, size: int) -> np.ndarray:
    """A place below ``size`` for each digest, another one at each level."""
    mixed = halves[:, 0] + np.uint64(level) * (halves[:, 1] | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(size)).astype(np.int64)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(d[:16] for d in digests), "<u8").reshape(-1, 2)


def perfect_hash(digests: list[bytes]) -> tuple[list[int], np.ndarray]:
    """(sizes of the levels, their bits in a row) for distinct digests."""
    rest, sizes, fields = _halves(digests), [], []
    while len(rest):
        size = 2 * len(rest) + 1
        places = _places(rest, len(sizes), size)
        taken = np.bincount(places, minlength=size)
        sizes.append(size)
        fields.append(taken == 1)
        rest = rest[taken[places] > 1]
    return sizes, np.concatenate(fields) if fields else np.zeros(0, bool)


def slots_of(digests: list[bytes], sizes: list[int], field: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where no level settles it (then it is no member)."""
    halves, found, before = _halves(digests), np.full(len(digests), -1, np.int64), np.cumsum(field) - field
    open_, start = np.arange(len(digests)), 0
    for level, size in enumerate(sizes):
        at = start + _places(halves[open_], level, size)
        settled = field[at]
        found[open_[settled]] = before[at[settled]]
        open_, start = open_[~settled], start + size
    return found


def _build(group: pd.DataFrame) -> pd.DataFrame:
    digests = group.digest.tolist()
    sizes, field = perfect_hash(digests)
    order = np.argsort(slots_of(digests, sizes, field))
    return pd.DataFrame(
        {
            "bucket": [group.bucket.iloc[0]],
            "sizes": [sizes],
            "field": [np.packbits(field).tobytes()],
            "digests": [b"".join(digests[i] for i in order)],
            "winners": [[None if pd.isna(w) else int(w) for w in group.winner.iloc[order]]],
            "winner_rows": [group.winner_rows.to_numpy()[order]],
            "copies": [group.copies.to_numpy()[order]],
        }
    )


INDEX = "bucket int, sizes array<long>, field binary, digests binary, winners array<long>, winner_rows array<long>, copies array<long>"


def distinct_digests(rows: DataFrame) -> DataFrame:
    """(digest, winner, winner_rows, copies) of rows (doc_id, digest)."""
    each = rows.groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    best = each.groupBy("digest").agg(F.max(F.struct("doc_id", "n")).alias("best"), F.sum("n").alias("copies"))
    return best.select("digest", F.col("best.doc_id").cast("long").alias("winner"), F.col("best.n").alias("winner_rows"), "copies")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int").alias("bucket")


def build_index(history: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket of distinct digests: its perfect hash and its slots."""
    return history.select(_bucket(buckets), "*").groupBy("bucket").applyInPandas(_build, INDEX)


def _merge(batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    if index.empty:
        return batch[["bucket", "digest", "winner", "winner_rows", "copies"]]
    held = index.iloc[0]
    raw = held.digests
    slots = [raw[i : i + 32] for i in range(0, len(raw), 32)]
    kept = pd.DataFrame({"bucket": held.bucket, "digest": slots, "winner": pd.array(held.winners, "Int64"), "winner_rows": held.winner_rows, "copies": held.copies})
    if batch.empty:
        return kept
    digests, sizes = batch.digest.tolist(), [int(s) for s in held.sizes]
    field = np.unpackbits(np.frombuffer(held.field, np.uint8), count=sum(sizes)).astype(bool)
    at = slots_of(digests, sizes, field)
    member = np.array([s >= 0 and slots[s] == d for s, d in zip(at, digests, strict=True)], bool)
    for s, row in zip(at[member], batch[member].itertuples(), strict=True):
        old = kept.winner.iat[s]
        if pd.isna(old) or (not pd.isna(row.winner) and row.winner > old):
            kept.iloc[s, 2:4] = [row.winner, row.winner_rows]
        elif row.winner == old:
            kept.iat[s, 3] += row.winner_rows
        kept.iat[s, 4] += row.copies
    return pd.concat([kept, batch.loc[~member, kept.columns]])


def merged_groups(history: DataFrame, batch: DataFrame, per_bucket: int = 16384) -> DataFrame:
    """(digest, winner, winner_rows, copies) of history and batch together, each with distinct digests."""
    buckets = max(1, math.ceil(max(history.count(), batch.count()) / per_bucket))
    index = build_index(history, buckets)
    wide = batch.select(_bucket(buckets), "*")
    return wide.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(_merge, GROUP).drop("bucket")


def exact_dedup(docs: DataFrame, in_history: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, digest, keep_id, keep_rows, group_size, kept.

    ``in_history`` says which rows are the history that is indexed; the others are the
    batch that is looked up. The result does not depend on it.
    """
    rows = stored(docs.select("doc_id", text_digest("text").alias("digest"), F.coalesce(in_history, F.lit(False)).alias("old")), "digests")
    history = stored(distinct_digests(rows.where("old")), "history")
    groups = merged_groups(history, stored(distinct_digests(rows.where("NOT old")), "batch"))
    return rows.drop("old").join(groups, "digest").select(
        "doc_id",
        "digest",
        F.col("winner").alias("keep_id"),
        F.col("winner_rows").alias("keep_rows"),
        F.col("copies").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("winner")).alias("kept"),
    )


def survivors(docs: DataFrame, in_history: Column) -> DataFrame:
    """``docs`` with one row of each group: the largest doc_id, one of its rows if it is repeated."""
    digest, many, own, same = (free_name(docs, n) for n in ("digest", "keep_rows", "kept_id", "kept_digest"))
    kept = exact_dedup(docs, in_history).where("kept").select(F.col("doc_id").alias(own), F.col("digest").alias(same), F.col("keep_rows").alias(many)).distinct()
    wide = docs.withColumn(digest, text_digest("text"))
    found = wide.join(kept, wide["doc_id"].eqNullSafe(kept[own]) & (wide[digest] == kept[same]))
    single, repeated = found.where(F.col(many) == 1), found.where(F.col(many) > 1).dropDuplicates([digest])
    return single.unionByName(repeated).select(*docs.columns)
