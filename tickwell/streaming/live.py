"""Trend and latest price kept up to date by a stream, and the ticks that came too late for it.

Every batch shrinks to partial states (``operators.partials``), which are merged into the
stored states of the days and symbols it touches and of no other. States merge in any order,
so batches may come in any order; a replayed batch changes nothing (``sources.versions``).
"""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tickwell.functions.clock import arrival_order
from tickwell.operators.partials import bucket_states, merged, state_of, trend_of
from tickwell.sources.files import if_there
from tickwell.sources.versions import Snapshot, commit, read_parts, read_rows, read_snapshot, write_parts, write_rows
from tickwell.streaming.ingest import run_id_of

#: Parts of the table of latest prices, by a hash of the symbol.
SYMBOL_PARTS = 64


def fold_batch(ticks: DataFrame, folder: str, run_id: str, batch_id: int, bucket: str = "1 hour", late: str | None = None, tie: str | None = None) -> None:
    """Merge a batch of ticks into the live tables of ``folder``; does nothing if they hold the batch.

    With ``late``, a bucket is closed once a tick of an earlier batch is ``late`` past its
    end: its ticks go to the late table, with the bucket they missed, and change no trend and
    no latest price. So do ticks without a time, whose bucket is null. Without ``late`` no
    bucket ever closes. Writers of a folder must agree on ``bucket`` and ``tie``.
    """
    spark = ticks.sparkSession
    before = read_snapshot(spark, folder)
    if before.holds(run_id, batch_id):
        return
    version = before.version + 1
    # Spark drops rows without a time where it works out windows.
    timeless = ticks.filter(F.col("timestamp").isNull()).withColumn("bucket", F.lit(None).cast("timestamp_ntz"))
    window = F.window("timestamp", bucket)
    ticks = ticks.withColumn("bucket", window.getField("start")).withColumn("_end", F.unix_micros(window.getField("end").cast("timestamp")))
    ticks = ticks.unionByName(timeless, allowMissingColumns=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        closed = before.memory.get("closed")
        missed = F.col("_end").isNull() | (F.lit(False) if late is None or closed is None else F.col("_end") <= F.lit(closed))
        on_time = ticks.filter(~missed).drop("bucket", "_end")
        write_rows(ticks.filter(missed).drop("_end"), folder, "late", version)
        latest = on_time.groupBy("symbol").agg(*state_of(arrival_order(on_time, tie)), F.max("timestamp").alias("timestamp"))
        written = {
            "trend": _merge(bucket_states(on_time, bucket, tie), folder, "trend", F.to_date("bucket").cast("string"), before, "bucket", "symbol"),
            "latest": _merge(latest, folder, "latest", _symbol_part(), before, "symbol"),
        }
        memory = {}
        if late is not None:
            last = F.unix_micros(F.max(F.col("timestamp")).cast("timestamp") - F.expr(f"INTERVAL {late}"))
            reached = [x for x in (closed, ticks.agg(last).first()[0]) if x is not None]
            memory = {"closed": max(reached)} if reached else {}
        commit(spark, folder, before, written, run_id, batch_id, **memory)
    finally:
        ticks.unpersist()


def _symbol_part() -> Column:
    return F.pmod(F.xxhash64("symbol"), F.lit(SYMBOL_PARTS)).cast("string")


def _merge(new: DataFrame, folder: str, name: str, part: Column, before: Snapshot, *keys: str) -> list[str]:
    """Write the states of the partitions that ``new`` touches, stored and new ones merged; these partitions."""
    touched = [r.part for r in new.select(part.alias("part")).distinct().collect()]
    if touched:
        old = read_parts(new.sparkSession, folder, name, new.schema, before, touched)
        more = [F.max("timestamp").alias("timestamp")] if "timestamp" in new.columns else []
        both = old.unionByName(new).groupBy(*keys).agg(*merged(), *more)
        write_parts(both.withColumn("part", part), folder, name, before.version + 1)
    return touched


def start_live(
    ticks: DataFrame, folder: str, checkpoint: str, bucket: str = "1 hour", late: str | None = None, tie: str | None = None, seconds: int | None = None
) -> StreamingQuery:
    """Keep the live tables up to date from a stream; ``None`` for ``seconds`` takes what is there and ends."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        fold_batch(batch, folder, run_id_of(batch.sparkSession, checkpoint), batch_id, bucket, late, tie)

    writer = ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fold)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def live_sink(folder: str, bucket: str = "1 hour", late: str | None = None) -> Callable[[DataFrame, int], None]:
    """A further sink for ``start_ingest``: the live tables follow what it stores."""

    def store(prices: DataFrame, batch_id: int) -> None:
        first = prices.select("run_id").first()
        if first is not None:
            fold_batch(prices.drop("run_id", "batch_id", "date"), folder, first.run_id, batch_id, bucket, late)

    return store


def _schema(spark: SparkSession, folder: str, name: str, snapshot: Snapshot) -> StructType | None:
    current = snapshot.of(name)
    return next((spark.read.parquet(f"{folder}/{name}/part={p}/version={at}").schema for p, at in current.items()), None)


def _states(spark: SparkSession, folder: str, name: str, parts: list[str] | None = None) -> DataFrame | None:
    snapshot = read_snapshot(spark, folder)
    schema = _schema(spark, folder, name, snapshot)
    return None if schema is None else read_parts(spark, folder, name, schema, snapshot, parts)


_TREND_DDL = "symbol STRING, bucket TIMESTAMP_NTZ, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, avg_price DOUBLE, n_ticks BIGINT"
_LATEST_DDL = "symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ"


def live_trend(spark: SparkSession, folder: str, days: list[str] | None = None) -> DataFrame:
    """The trend as of the last batch, of some days (``YYYY-MM-DD``) if named. Reads one state per symbol and bucket."""
    states = _states(spark, folder, "trend", days)
    return spark.createDataFrame([], _TREND_DDL) if states is None else trend_of(states, "symbol", "bucket")


def live_latest(spark: SparkSession, folder: str, symbols: list[str] | None = None) -> DataFrame:
    """The last price per symbol as of the last batch; of some symbols if named, from their parts alone."""
    parts = None
    if symbols is not None:
        named = spark.createDataFrame([(s,) for s in symbols], "symbol STRING")
        parts = sorted({r.part for r in named.select(_symbol_part().alias("part")).collect()})
    states = _states(spark, folder, "latest", parts)
    if states is None:
        return spark.createDataFrame([], _LATEST_DDL)
    latest = states.select("symbol", F.col("close").alias("price"), "timestamp")
    return latest if symbols is None else latest.filter(F.col("symbol").isin(symbols))


def late_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Ticks that came after their ``bucket`` had closed, of all batches that the live tables hold."""
    snapshot = read_snapshot(spark, folder)
    empty = "symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, bucket TIMESTAMP_NTZ"
    written = if_there(spark, lambda: spark.read.parquet(f"{folder}/late/version=*"), empty)
    return read_rows(spark, folder, "late", written.schema, snapshot)
