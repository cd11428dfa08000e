"""The price table's key: arrival stamps that satisfy it, and checks that enforce it."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.plans.slices import ranked
from tickwell.schema import LINEAGE, PRICE_KEY


def first_by_key(df: DataFrame, keys: list[str] = PRICE_KEY, order: list[str] | None = None) -> DataFrame:
    """One row per key, the first to arrive.

    Spark keeps only the best row per key and task ahead of the shuffle, so a key
    repeated without end sends one row per task.
    """
    arrival = Window.partitionBy(*keys).orderBy(*(order or LINEAGE))
    return df.withColumn("_nth", F.row_number().over(arrival)).filter(F.col("_nth") == 1).drop("_nth")


def repeats_by_key(df: DataFrame, keys: list[str] = PRICE_KEY, order: list[str] | None = None) -> DataFrame:
    """The rows ``first_by_key`` leaves out. ``order`` must tell any two rows apart."""
    order = order or LINEAGE
    return df.join(first_by_key(df, keys, order).select(*order), order, "left_anti")


def not_stored(batch: DataFrame, history: DataFrame, keys: list[str] = PRICE_KEY) -> DataFrame:
    """Rows whose key the history does not hold yet. Pass the history pruned to the batch's dates."""
    return batch.join(history.select(*keys), keys, "left_anti")


def already_stored(batch: DataFrame, history: DataFrame, keys: list[str] = PRICE_KEY) -> DataFrame:
    return batch.join(history.select(*keys), keys, "left_semi")


def stamp_arrivals(
    df: DataFrame,
    base: Column,
    within: list[str] | None = None,
    order: list[str] | None = None,
    latest: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ``timestamp``: arrival time, distinct per symbol.

    A batch has one clock reading, ``base``; the records of a symbol are a microsecond
    apart from there on, in arrival order. ``latest`` (``symbol``, ``last``) moves a
    symbol's start behind the last stamp it already has. ``within`` names the group a
    rank is counted in, if one plan holds several batches.
    """
    ranks = ranked(df.withColumn("_clock", base), within or ["symbol"], order or LINEAGE, "_nth", latest, slices)
    start = F.unix_micros(F.col("_clock").cast("timestamp"))
    if latest is not None:
        start = F.greatest(start, F.unix_micros(F.col("last").cast("timestamp")) + 1)
    stamp = F.timestamp_micros(start + F.col("_nth") - 1).cast("timestamp_ntz")
    return ranks.select(*[c for c in df.columns if c != "timestamp"], stamp.alias("timestamp"))
