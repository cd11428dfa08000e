"""Sessions of a symbol: runs of ticks with no more than a gap of time between one and the next."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.clock import arrival_order
from tickwell.operators.partials import merged, state_of
from tickwell.plans.slices import sliced

SESSION = ["symbol", "start", "end", "open", "high", "low", "close", "avg_price", "n_ticks"]


def session_trend(prices: DataFrame, gap_seconds: float, tie: str | None = None, slices: int | None = None) -> DataFrame:
    """Open, high, low, close and average price per symbol and session.

    ``start`` and ``end`` are a session's first and last tick; a tick more than
    ``gap_seconds`` after the one before it begins the next session. Ticks without a
    symbol or a time belong to none.

    No task holds a symbol. Sessions are found per slice of the table sorted by symbol and
    time, and numbered along the symbol from one row per slice: a slice's first session
    goes on with the number of the last one before it if no gap lies between them. A
    session that runs over many slices has one state from each.
    """
    gap = round(gap_seconds * 1_000_000)
    order = ["timestamp", *([tie] if tie else [])]
    timed = prices.dropna(subset=["symbol", "timestamp"]).select("symbol", "price", *order)
    cut = sliced(timed, ["symbol"], order, slices).withColumn("_us", F.unix_micros(F.col("timestamp").cast("timestamp")))

    within = Window.partitionBy("symbol", "_slice").orderBy(*order)
    breaks = F.coalesce((F.col("_us") - F.lag("_us").over(within) > gap).cast("long"), F.lit(0))
    numbered = cut.withColumn("_break", breaks).withColumn("_local", F.sum("_break").over(within))
    local = numbered.groupBy("symbol", "_slice", "_local").agg(
        F.min("_us").alias("_first"), F.max("_us").alias("_last"), *state_of(arrival_order(numbered, tie))
    )

    along = Window.partitionBy("symbol").orderBy("_slice")
    spans = cut.groupBy("symbol", "_slice").agg(F.min("_us").alias("_from"), F.max("_us").alias("_to"))
    opened = spans.join(local.groupBy("symbol", "_slice").agg(F.max("_local").alias("_more")), ["symbol", "_slice"])
    fresh = F.coalesce((F.col("_from") - F.lag("_to").over(along) > gap).cast("long"), F.lit(0))
    # The number of a slice's first session: breaks in the slices before it and at the edges up to its own.
    bases = opened.withColumn("_fresh", fresh).withColumn("_base", F.sum(F.col("_fresh") + F.col("_more")).over(along) - F.col("_more"))
    whole = local.join(bases.select("symbol", "_slice", "_base"), ["symbol", "_slice"]).withColumn("_session", F.col("_base") + F.col("_local"))
    sessions = whole.groupBy("_session", "symbol").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), *merged())
    return sessions.select(
        "symbol",
        F.timestamp_micros("_first").cast("timestamp_ntz").alias("start"),
        F.timestamp_micros("_last").cast("timestamp_ntz").alias("end"),
        "open",
        "high",
        "low",
        "close",
        (F.col("sum_price") / F.col("n_priced")).alias("avg_price"),
        "n_ticks",
    )
