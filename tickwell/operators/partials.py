"""Trends as partial states that merge: what some ticks of a bucket say, whatever the others are.

A state holds first, last, highest and lowest price, the sum and two counts, with the order
of the first and the last tick. States of one bucket add up in any order and grouping, so a
trend can be kept per batch, per pane or per task and put together when it is asked for.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.clock import arrival_order

#: What a state holds besides its keys.
STATE = ["open", "first_at", "close", "last_at", "high", "low", "sum_price", "n_priced", "n_ticks"]
TREND = ["open", "high", "low", "close", "avg_price", "n_ticks"]


def state_of(order: Column) -> list[Column]:
    """Aggregates that make a state of ticks."""
    return [
        F.min_by("price", order).alias("open"),
        F.min(order).alias("first_at"),
        F.max_by("price", order).alias("close"),
        F.max(order).alias("last_at"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("price").alias("sum_price"),
        F.count("price").alias("n_priced"),
        F.count(F.lit(1)).alias("n_ticks"),
    ]


def merged() -> list[Column]:
    """Aggregates that make one state of several."""
    return [
        F.min_by("open", "first_at").alias("open"),
        F.min("first_at").alias("first_at"),
        F.max_by("close", "last_at").alias("close"),
        F.max("last_at").alias("last_at"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("sum_price").alias("sum_price"),
        F.sum("n_priced").alias("n_priced"),
        F.sum("n_ticks").alias("n_ticks"),
    ]


def bucket_states(ticks: DataFrame, bucket: str, tie: str | None = None) -> DataFrame:
    """A state per ``bucket`` and ``symbol``. Combined per task, so a hot symbol sends one row per task and bucket."""
    start = F.window("timestamp", bucket).getField("start")
    return ticks.withColumn("bucket", start).groupBy("bucket", "symbol").agg(*state_of(arrival_order(ticks, tie)))


def merge_states(states: DataFrame, *keys: str) -> DataFrame:
    return states.groupBy(*keys).agg(*merged())


def trend_of(states: DataFrame, *keys: str) -> DataFrame:
    """The trend that states stand for: open, high, low, close, avg_price, n_ticks."""
    average = (F.col("sum_price") / F.col("n_priced")).alias("avg_price")
    return states.select(*keys, "open", "high", "low", "close", average, "n_ticks")


def sliding_trend(prices: DataFrame, width: str, slide: str, tie: str | None = None) -> DataFrame:
    """``price_trend`` over windows of ``width`` that begin every ``slide``; ``width`` must be a multiple of ``slide``.

    Ticks make states per pane, as wide as the slide, once. A pane's state, not its ticks,
    goes to each window that covers it, so overlap multiplies panes only. Ticks without a
    time fall into no window.
    """
    spark = prices.sparkSession
    # As whole microseconds: intervals of months have none.
    wide, step = (spark.range(1).select(F.unix_micros(F.expr(f"TIMESTAMP'1970-01-01 00:00:00Z' + INTERVAL {x}"))).first()[0] for x in (width, slide))
    if step <= 0 or wide % step:
        raise ValueError(f"{width} is no multiple of {slide}")
    panes = bucket_states(prices, slide, tie)
    starts = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(wide // step - 1).cast("bigint")), lambda i: F.timestamp_micros(F.unix_micros(F.col("bucket").cast("timestamp")) - i * step).cast("timestamp_ntz"))
    windows = panes.withColumn("starts", starts).withColumn("bucket", F.explode("starts"))
    return trend_of(merge_states(windows, "bucket", "symbol"), "symbol", "bucket")
