"""Event-time streams (our addition: messages themselves carry no event time): trend, tick volume, unique keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.functions.clock import arrival_order
from tickwell.schema import PRICE_KEY


def unique_stream(ticks: DataFrame, late: str = "10 minutes") -> DataFrame:
    """One tick per key; keys are remembered for ``late`` after their time.

    A tick of an earlier micro-batch goes before one of a later; which one is kept of
    those that come in one micro-batch is open. For a stream that is not stored; ``start_ingest`` with a clock checks the whole history.
    """
    return (
        ticks.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", late)
        .dropDuplicatesWithinWatermark(PRICE_KEY)
        .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    )


def trend_stream(ticks: DataFrame, bucket: str = "1 hour", late: str = "10 minutes", tie: str | None = None) -> DataFrame:
    """``price_trend`` over a stream of ticks; a bucket is emitted once no tick up to ``late`` may still change it."""
    order = arrival_order(ticks, tie)
    return (
        ticks.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        .withWatermark("timestamp", late)
        .groupBy(F.window("timestamp", bucket).alias("_w"), "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.avg("price").alias("avg_price"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .select(
            "symbol",
            F.col("_w.start").cast("timestamp_ntz").alias("bucket"),
            "open",
            "high",
            "low",
            "close",
            "avg_price",
            "n_ticks",
        )
    )
