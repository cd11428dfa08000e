"""Sliced windows must equal plain ones, whatever the slices and however uneven the groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickwell.operators.keys import first_by_key, repeats_by_key, stamp_arrivals
from tickwell.operators.trends import price_momentum
from tickwell.plans.slices import ranked, sliced


@pytest.fixture(scope="module")
def ticks(spark):
    """One symbol with most rows, in bursts; a few with little; one with a single row."""
    rng = random.Random(7)
    rows = []
    micros = 1_700_000_000_000_000
    for i in range(6000):
        micros += rng.choice([1, 3, 1000, 1, 900_000_000 if i % 500 == 0 else 5])
        symbol = "HOT" if rng.random() < 0.8 else rng.choice(["A", "B", "C"])
        rows.append((i, symbol, None if rng.random() < 0.01 else round(rng.uniform(1, 500), 2), micros))
    rows.append((6000, "LONE", 1.0, micros))
    df = spark.createDataFrame(rows, "id BIGINT, symbol STRING, price DOUBLE, micros BIGINT")
    return df.select("id", "symbol", "price", F.timestamp_micros("micros").cast("timestamp_ntz").alias("timestamp")).cache()


@pytest.mark.parametrize("slices", [1, 7, 100, None])
def test_ranked(ticks, slices):
    plain = F.row_number().over(Window.partitionBy("symbol").orderBy("id"))
    both = ranked(ticks.withColumn("expected", plain), ["symbol"], ["id"], "nth", slices=slices)
    assert both.count() == 6001
    assert both.filter("nth != expected").count() == 0


def test_ranked_over_partitions_and_offsets(ticks):
    placed = ticks.select("symbol", (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).alias("offset"))
    plain = F.row_number().over(Window.partitionBy("symbol").orderBy("partition", "offset"))
    both = ranked(placed.withColumn("expected", plain), ["symbol"], ["partition", "offset"], "nth", slices=50)
    assert both.filter("nth != expected").count() == 0


@pytest.mark.parametrize("slices", [1, 6, 400, None])
@pytest.mark.parametrize("window", [1, 2, 20])
def test_momentum(ticks, slices, window):
    by_time = Window.partitionBy("symbol").orderBy("timestamp", "id")
    expected = ticks.select(
        "id",
        F.avg("price").over(by_time.rowsBetween(1 - window, 0)).alias("avg"),
        (F.col("price") - F.lag("price").over(by_time)).alias("diff"),
    )
    got = price_momentum(ticks, ticks=window, tie="id", slices=slices)
    joined = got.join(expected, "id")
    assert joined.count() == 6001
    wrong = joined.filter(
        "NOT (moving_avg <=> avg OR abs(moving_avg - avg) < 1e-9) OR NOT (change <=> diff OR abs(change - diff) < 1e-9)"
    )
    assert wrong.count() == 0, wrong.take(3)


def bounded(cut, rows, slices):
    """Slices rise with the order and none holds much more than its part of the rows."""
    sizes = [r["count"] for r in cut.groupBy("_slice").count().collect()]
    assert sum(sizes) == rows and len(sizes) >= slices / 2 and max(sizes) <= 2 * rows / slices


def test_slices_are_in_order_and_bounded(ticks):
    cut = sliced(ticks, ["symbol"], ["timestamp", "id"], 30)
    bounded(cut, 6001, 30)
    back = cut.withColumn("_before", F.max("_slice").over(Window.orderBy("symbol", "timestamp", "id").rowsBetween(Window.unboundedPreceding, -1)))
    assert back.filter("_before > _slice").count() == 0


def test_an_instant_is_cut(ticks):
    at_once = ticks.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).withColumn("symbol", F.lit("HOT"))
    bounded(sliced(at_once, ["symbol"], ["timestamp", "id"], 30), 6001, 30)
    by_id = Window.partitionBy("symbol").orderBy("id")
    got = price_momentum(at_once, tie="id", slices=30).withColumn("diff", F.col("price") - F.lag("price").over(by_id))
    assert got.filter("NOT (change <=> diff OR abs(change - diff) < 1e-9)").count() == 0


def test_sparse_ids_make_no_more_slices(ticks):
    sparse = ticks.withColumn("id", F.col("id") * 5_000_000)
    bounded(sliced(sparse, ["symbol"], ["id"], 30), 6001, 30)
    plain = F.row_number().over(Window.partitionBy("symbol").orderBy("id"))
    assert ranked(sparse.withColumn("expected", plain), ["symbol"], ["id"], "nth", slices=30).filter("nth != expected").count() == 0


def test_no_window_over_a_whole_symbol(ticks):
    plan = price_momentum(ticks, tie="id", slices=60)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):
        if "Window [" in line and "row_number" in line:
            assert "_slice" in line
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_stamps_are_distinct_and_in_order(spark, ticks):
    placed = ticks.select(
        "symbol", F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.floor(F.col("id") / 2).alias("offset")
    )
    base = F.lit("2024-01-01 00:00:00").cast("timestamp")
    stamped = stamp_arrivals(placed, base, slices=64).cache()
    assert stamped.select("symbol", "timestamp").distinct().count() == stamped.count() == 6001
    by_arrival = Window.partitionBy("symbol").orderBy("partition", "offset")
    assert stamped.withColumn("p", F.lag("timestamp").over(by_arrival)).filter("p >= timestamp").count() == 0
    assert str(stamped.agg(F.min("timestamp")).first()[0]) == "2024-01-01 00:00:00"

    latest = spark.createDataFrame([("HOT", "2024-01-01 00:00:07")], "symbol STRING, last STRING")
    latest = latest.withColumn("last", F.col("last").cast("timestamp_ntz"))
    moved = stamp_arrivals(placed, base, latest=latest).groupBy("symbol").agg(F.min("timestamp").alias("first"))
    first = {r.symbol: str(r["first"]) for r in moved.collect()}
    assert first["HOT"] == "2024-01-01 00:00:07.000001"
    assert first["A"] == "2024-01-01 00:00:00"


def test_hot_key_is_cut_down_before_the_shuffle(ticks):
    one_key = ticks.withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    first = first_by_key(one_key, order=["id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert first.count() == 5
    assert repeats_by_key(one_key, order=["id"]).count() == 6001 - 5


@pytest.mark.parametrize(("ticks", "slices"), [(1, 9), (120, 40), (3, 60)])
def test_windows_over_many_slices(spark, ticks, slices):
    """Windows that reach over several slices, and slices that lie within one window."""
    rows = spark.range(300).select(
        F.when(F.col("id") % 5 < 3, "HOT").otherwise("B").alias("symbol"),
        F.when(F.col("id") % 11 > 0, F.col("id").cast("double")).alias("price"),
        F.timestamp_micros(F.col("id") * 7_000_000).cast("timestamp_ntz").alias("timestamp"),
    )
    along = Window.partitionBy("symbol").orderBy("timestamp")
    want = rows.withColumns({"moving_avg": F.avg("price").over(along.rowsBetween(1 - ticks, 0)), "change": F.col("price") - F.lag("price").over(along)})
    found = price_momentum(rows, ticks, slices=slices)
    assert sorted(map(tuple, found.select("timestamp", "moving_avg", "change").collect())) == sorted(map(tuple, want.select("timestamp", "moving_avg", "change").collect()))
