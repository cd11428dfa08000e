import uuid
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tickwell.plans import sql
from tickwell.schema import PRICE_COLUMNS
from tickwell.sources.table import (
    append_prices,
    compact_history,
    create_price_table,
    drop_merged,
    jdbc_options,
    only_missing,
    read_batch,
    read_history,
    time_predicates,
    write_history,
)


def prices(spark, *rows):
    df = spark.createDataFrame(list(rows), "symbol STRING, price DOUBLE, t STRING, company STRING, market STRING")
    return df.withColumn("timestamp", F.col("t").cast("timestamp_ntz")).drop("t")


ROW = ("A", 1.0, "2024-01-01 00:00:00", "A", "NASDAQ")


def test_create_append_reset(spark):
    name = f"prices_{uuid.uuid4().hex}"
    create_price_table(spark, name)
    append_prices(prices(spark, ROW, ("B", float("nan"), "2024-01-01 00:00:01", None, None)), name)
    create_price_table(spark, name)
    assert spark.table(name).columns == PRICE_COLUMNS
    assert spark.table(name).count() == 2
    with pytest.raises(PySparkException):
        append_prices(prices(spark, ("S" * 11, *ROW[1:])), name)
    create_price_table(spark, name, reset=True)
    assert spark.table(name).count() == 0


def test_history_batches_replace_themselves(spark, scratch):
    path = f"{scratch}/history"
    assert read_history(spark, path).count() == 0
    lineage = {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    batch = prices(spark, ROW, ("A", 2.0, "2024-01-02 00:00:00", "A", "NASDAQ")).withColumns(lineage)
    for _ in range(2):
        write_history(batch, path, "run-1", 0)
    assert read_history(spark, path).count() == 2
    write_history(batch, path, "run-2", 0)
    assert read_history(spark, path).count() == 4
    day = date(2024, 1, 2)
    assert [r.price for r in read_history(spark, path, [day]).collect()] == [2.0, 2.0]
    assert read_history(spark, path, [day, date(2024, 1, 1), date(2023, 1, 1)]).count() == 4
    assert read_history(spark, path, [date(2023, 1, 1)]).count() == 0
    assert read_history(spark, path, [day]).schema == read_history(spark, path).schema
    assert read_batch(spark, path, "run-2", 0).count() == 2
    one_day = read_history(spark, path).filter("date = DATE '2024-01-02'")
    assert one_day.count() == 2
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().executedPlan().toString()


def test_the_table_takes_each_key_once(spark):
    name = f"prices_{uuid.uuid4().hex}"
    create_price_table(spark, name)
    rows = prices(spark, ROW, ROW, ("A", 0.5, *ROW[2:]), (None, 1.0, *ROW[2:]), ("B", 2.0, None, "B", "X"), ("C", 3.0, *ROW[2:]))
    left = [sorted((r.symbol or "", r.price, r.reason) for r in append_prices(rows, name).collect()) for _ in range(2)]
    assert sorted((r.symbol, r.price) for r in spark.table(name).collect()) == [("A", 0.5), ("C", 3.0)]
    no_key = [("", 1.0, "null_key"), ("B", 2.0, "null_key")]
    assert left[0] == sorted([*no_key, ("A", 1.0, "duplicate_key"), ("A", 1.0, "duplicate_key")])
    assert left[1] == sorted([*left[0], ("A", 0.5, "duplicate_key"), ("C", 3.0, "duplicate_key")])


def test_merged_batches_count_once(spark, scratch):
    path = f"{scratch}/history"
    lineage = {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    rows = [prices(spark, ("A", float(n), f"2024-01-0{1 + n % 3} 00:00:0{n}", "A", "X")).withColumns(lineage) for n in range(6)]

    def write(n):
        write_history(rows[n], path, "run", n)

    def stored(**days):
        return sorted(r.price for r in read_history(spark, path, **days).collect())

    for n in range(5):
        write(n)
    compact_history(spark, path, date(2024, 1, 3))
    assert stored() == [0, 1, 2, 3, 4]
    write(1)  # a replay
    assert stored() == [0, 1, 2, 3, 4]
    drop_merged(spark, path)
    assert stored() == [0, 1, 2, 3, 4]
    assert stored(days=[date(2024, 1, 1)]) == [0, 3] and stored(days=[date(2024, 1, 3)]) == [2]
    write(1)
    write(5)
    compact_history(spark, path, date(2024, 2, 1))
    compact_history(spark, path, date(2024, 2, 1))
    drop_merged(spark, path)
    assert stored() == [0, 1, 2, 3, 4, 5]
    assert read_history(spark, path).columns == read_history(spark, f"{scratch}/none").columns


def test_a_merge_that_broke_off_counts_for_nothing(spark, scratch):
    path = f"{scratch}/history"
    lineage = {"topic": F.lit("t"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint")}
    write_history(prices(spark, ROW).withColumns(lineage), path, "run", 0)
    compact_history(spark, path, date(2025, 1, 1))
    lost = spark.read.parquet(f"{path}/_merged").withColumn("merge_id", F.lit("lost"))
    lost.write.mode("append").partitionBy("merge_id", "date").parquet(f"{path}/_merged")
    assert read_history(spark, path).count() == 1


def test_parameters(spark):
    sql.register(prices(spark, ROW, ("B", 2.0, "2024-01-01 00:00:01", "B", "NYSE")), "some_prices")
    text = "SELECT price FROM IDENTIFIER(:t) WHERE symbol = :s"
    assert [r.price for r in sql.query(spark, text, t="some_prices", s="B").collect()] == [2.0]
    assert sql.query(spark, text, t="some_prices", s="B' OR '1'='1").count() == 0


def test_a_further_sink_gets_only_what_it_lacks(spark):
    batch = prices(spark, ROW, ("A", 2.0, "2024-01-02 00:00:00", "A", "NASDAQ"))
    assert [r.price for r in only_missing(batch, prices(spark, ROW)).collect()] == [2.0]
    assert only_missing(batch, batch).count() == 0
    assert only_missing(batch.limit(0), batch).count() == 0


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/prices", "u", "p")
    assert options["dbtable"] == "stock_prices" and options["batchsize"] == "10000"


def test_database_ranges_hold_every_row_once(spark):
    bounds = [datetime(2024, 1, 2), datetime(2024, 1, 1), datetime(2024, 1, 3, 12)]
    rows = spark.sql("SELECT CASE WHEN id < 9 THEN TIMESTAMP'2023-12-31' + make_interval(0, 0, 0, 0, int(id) * 12) END AS timestamp FROM range(10)")
    parts = [rows.filter(p).count() for p in time_predicates(bounds)]
    assert parts == [3, 2, 3, 2] and time_predicates([]) == ["1 = 1"]
    assert sum(rows.filter(p).count() for p in time_predicates(bounds[:1])) == 10


def test_a_large_day_goes_to_several_tasks(spark, scratch):
    """A task sorts a piece of a batch, not millions of rows of its one day; the setting stays as it was."""
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    rows = spark.range(0, 2_000_000, 1, 8).select(
        F.concat(F.lit("S"), F.col("id") % 1000).alias("symbol"),
        F.rand(1).alias("price"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.rand(2) * 80_000)).alias("timestamp"),
        F.lit("A").alias("company"),
        F.lit("NASDAQ").alias("market"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("id").alias("offset"),
    )
    assert write_history(rows, f"{scratch}/history", "run", 0) == 2_000_000
    stored = read_history(spark, f"{scratch}/history")
    assert len(stored.inputFiles()) > 1
    assert stored.agg(F.count_distinct("offset")).first()[0] == 2_000_000
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) == before
