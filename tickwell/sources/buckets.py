"""Keys of a history in a table bucketed by their hash, so that a key check moves the batch alone.

The table is dealt by day and, within it, into a fixed number of buckets by the hash of the
key. A batch of distinct keys is dealt into as many parts by the same hash, and each part
meets its bucket where the bucket lies: the history is neither shuffled nor sent around,
and only the days between the batch's first and last are read. A hot symbol is spread by
its times. ``sources.filters`` opens less of the history when nearly all keys are new;
buckets cost the same however many are repeats.

Each batch adds its keys under its own run and number. A batch that is replayed leaves its
own keys out of account and adds them again, which changes no answer.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.schema import PRICE_KEY


def create_keys(spark: SparkSession, name: str, folder: str, buckets: int = 200) -> None:
    """Create the table in ``folder`` unless it is there. The number of its buckets stays: take as many as
    a day's keys of the largest history will need parts."""
    ddl = "symbol STRING, timestamp TIMESTAMP_NTZ, run_id STRING, batch_id BIGINT, date DATE"
    layout = f"PARTITIONED BY (date) CLUSTERED BY ({', '.join(PRICE_KEY)}) INTO {int(buckets)} BUCKETS"
    where = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({ddl}) USING parquet {layout} LOCATION '{where}'", args={"name": name})


def _buckets(spark: SparkSession, name: str) -> int:
    told = spark.sql("DESCRIBE EXTENDED IDENTIFIER(:name)", args={"name": name})
    return int(told.filter("col_name = 'Num Buckets'").first()["data_type"])


def append_bucketed(prices: DataFrame, name: str, run_id: str, batch_id: int) -> None:
    """Add the keys of a batch. Rows without a symbol or a time have none."""
    rows = prices.dropna(subset=PRICE_KEY).select(
        *PRICE_KEY, F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("long").alias("batch_id"), F.to_date("timestamp").alias("date")
    )
    # One task per bucket, so that a day gets one file of each and not one per task.
    rows.repartition(_buckets(prices.sparkSession, name), *PRICE_KEY).write.mode("append").insertInto(name)


def not_stored_by_bucket(batch: DataFrame, name: str, run_id: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Rows of ``batch`` (distinct keys) whose key the table lacks, whatever batch ``batch_id`` of ``run_id`` has added.

    Rows without a symbol or a time have no key that could be stored, and stay.
    """
    spark = batch.sparkSession
    day = F.to_date("timestamp")
    first, last = batch.agg(F.min(day).cast("string"), F.max(day).cast("string")).first()
    stored = spark.table(name).filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if run_id is not None:
        stored = stored.filter((F.col("run_id") != run_id) | (F.col("batch_id") != batch_id))
    # A merge of two sides dealt alike; a broadcast would move the history after all. An anti-join would be
    # pushed below the deal, and the history be dealt like the batch if that has more parts than buckets.
    dealt = batch.repartition(_buckets(spark, name), *PRICE_KEY)
    known = stored.select(*PRICE_KEY, F.lit(True).alias("_stored")).hint("merge")
    return dealt.join(known, PRICE_KEY, "left").filter(F.col("_stored").isNull()).drop("_stored")
