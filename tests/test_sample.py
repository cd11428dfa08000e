import random
from bisect import bisect_right
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwell.operators.sample import poll_sample, poll_sample_bounded, quote_asof, whole_grid

START = datetime(2024, 1, 1)


def ticks_at(spark, rows):
    df = spark.createDataFrame([(s, p, str(START + timedelta(seconds=t))) for s, p, t in rows], "symbol STRING, price DOUBLE, t STRING")
    return df.select("symbol", "price", F.col("t").cast("timestamp_ntz").alias("timestamp"))


def points(df, symbol):
    rows = df.filter(F.col("symbol") == symbol).orderBy("poll_ts").collect()
    return [(int((r.poll_ts - START).total_seconds()), r.price) for r in rows]


def test_fixture(spark):
    ticks = ticks_at(spark, [("A", 10.0, 5), ("A", 11.0, 20)])
    assert points(poll_sample(ticks, START, 4), "A") == [(0, None), (12, 10.0), (24, 11.0), (36, 11.0)]


def test_tick_on_a_point_counts(spark):
    ticks = ticks_at(spark, [("A", 10.0, 12), ("A", 11.0, 24)])
    assert points(poll_sample(ticks, START, 3), "A") == [(0, None), (12, 10.0), (24, 11.0)]


def test_ticks_outside_the_grid(spark):
    ticks = ticks_at(spark, [("A", 9.0, -100), ("A", 10.0, 500), ("LATE", 1.0, 500)])
    sampled = poll_sample(ticks, START, 3)
    assert points(sampled, "A") == [(0, 9.0), (12, 9.0), (24, 9.0)]
    assert points(sampled, "LATE") == [(0, None), (12, None), (24, None)]


def test_bound_is_inclusive(spark):
    sampled = poll_sample_bounded(ticks_at(spark, [("A", 10.0, 5), ("B", 1.0, 0)]), START)
    assert sampled.filter("symbol = 'A'").count() == 21
    assert sampled.count() == 42


@pytest.mark.parametrize("block", [1, 2, 5, 64, 4096])
def test_blocks_do_not_show(spark, block):
    rng = random.Random(block)
    times = sorted(rng.sample(range(0, 3000), 60)) + sorted(rng.sample(range(9000, 12000), 40))
    rows = [(rng.choice("AAAB"), float(i), t) for i, t in enumerate(times)] + [("C", 5.0, 11_999)]
    ticks = ticks_at(spark, rows)
    start, n = whole_grid(ticks)
    sampled = poll_sample(ticks, start, n, block=block).cache()
    first, last = min(times) // 12 * 12, -(-11_999 // 12) * 12
    for symbol in "ABC":
        own = sorted((t, p) for s, p, t in rows if s == symbol)
        expected = []
        for at in range(first, last + 1, 12):
            i = bisect_right([t for t, _ in own], at)
            expected.append((at, own[i - 1][1] if i else None))
        assert points(sampled, symbol) == expected


def test_asof(spark):
    ticks = ticks_at(spark, [("A", 10.0, 5), ("A", 11.0, 20), ("B", 1.0, 30)])
    rows = quote_asof(ticks, START + timedelta(seconds=20)).collect()
    assert [(r.symbol, r.price) for r in rows] == [("A", 11.0)]
    assert quote_asof(ticks, "2023-01-01").count() == 0
