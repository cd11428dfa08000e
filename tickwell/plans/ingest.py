"""From topic records to prices and rejects, in one plan for tables and micro-batches."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.operators.keys import first_by_key, not_stored, stamp_arrivals
from tickwell.operators.validate import accepted, judge, rejected
from tickwell.schema import LINEAGE, PRICE_COLUMNS, REJECT_COLUMNS
from tickwell.sources.scratch import kept


class Settled(NamedTuple):
    """``prices``: the table's columns and the lineage. ``rejects``: every other record, with its reason."""

    prices: DataFrame
    rejects: DataFrame


def settle_by_arrival(judged: DataFrame, base: Column, latest: DataFrame | None = None) -> Settled:
    """Stamp accepted records with their arrival, which makes the key unique by itself.

    ``latest`` holds the stamps (``symbol``, ``last``) that ``base`` may not be past.
    """
    stamped = stamp_arrivals(accepted(judged), base, latest=latest)
    return Settled(stamped.select(*PRICE_COLUMNS, *LINEAGE), rejected(judged).select(*REJECT_COLUMNS))


def on_clock(judged: DataFrame, clock: str) -> DataFrame:
    """``judged`` with ``clock`` as its ``timestamp``; a record without a time has no key and is rejected."""
    timeless = F.col("reason").isNull() & F.col(clock).isNull()
    return judged.withColumn("reason", F.when(timeless, "null_timestamp").otherwise(F.col("reason"))).withColumn(
        "timestamp", F.col(clock).cast("timestamp_ntz")
    )


def first_prices(timed: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Accepted records whose key is new; the first writer of a key wins.

    Repeats go first, most of them before the shuffle, as the history takes whole keys.
    """
    first = first_by_key(accepted(timed).select(*PRICE_COLUMNS, *LINEAGE))
    return first if history is None else not_stored(first, history)


def left_over(timed: DataFrame, stored: DataFrame) -> DataFrame:
    """Every record that is not stored: for its own reason, or as another record has its key.

    Records with a reason of their own take no part in the join.
    """
    late = accepted(timed).select(*LINEAGE, "value").join(stored.select(*LINEAGE), LINEAGE, "left_anti")
    return rejected(timed).select(*REJECT_COLUMNS).unionByName(late.withColumn("reason", F.lit("duplicate_key")))


def settle_by_clock(judged: DataFrame, clock: str, history: DataFrame | None = None) -> Settled:
    """Key accepted records by a time of their own, ``clock``. Pass ``judged`` kept, as both sides read it."""
    timed = on_clock(judged, clock)
    prices = first_prices(timed, history)
    return Settled(prices, left_over(timed, prices))


def ingest(records: DataFrame, clock: str, history: DataFrame | None = None, legacy: bool = False) -> Settled:
    """A whole table of topic records, keyed by ``clock``. Payloads are parsed once, at the call."""
    return settle_by_clock(kept(judge(records, legacy=legacy)), clock, history)
