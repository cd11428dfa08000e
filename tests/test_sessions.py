"""Sessions and sliding windows, in batch and as streams with keyed state."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickwell.operators.partials import sliding_trend
from tickwell.operators.sessions import session_trend
from tickwell.operators.trends import price_trend
from tickwell.plans.slices import sliced
from tickwell.streaming.sessions import joined, keyed_state, session_stream, stale_stream

TICKS = "symbol string, price double, timestamp timestamp_ntz, event_id long"
START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def random_ticks(n, seed=1):
    """Three of five ticks are of one symbol; some share an instant, some have no price."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        symbol = "HOT" if i % 5 < 3 else rng.choice(["A", "B"])
        rows.append((symbol, None if rng.random() < 0.05 else rng.randint(1, 999) / 8, at(rng.randrange(0, n * 20, 10)), i))
    return rows


def brute(rows, gap):
    out = []
    for symbol in sorted({r[0] for r in rows if r[0] is not None}):
        own = sorted((r for r in rows if r[0] == symbol and r[2] is not None), key=lambda r: (r[2], r[3]))
        runs = []
        for r in own:
            if runs and (r[2] - runs[-1][-1][2]).total_seconds() <= gap:
                runs[-1].append(r)
            else:
                runs.append([r])
        for run in runs:
            prices = [r[1] for r in run if r[1] is not None]
            average = round(sum(prices) / len(prices), 9) if prices else None
            out.append((symbol, run[0][2], run[-1][2], run[0][1], max(prices, default=None), min(prices, default=None), run[-1][1], average, len(run)))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.withColumn("avg_price", F.round("avg_price", 9)).collect()), key=str)


@pytest.mark.parametrize("slices", [1, 7, 60])
def test_sessions_do_not_depend_on_slices(spark, slices):
    rows = random_ticks(400) + [(None, 1.0, at(5), 900), ("A", 1.0, None, 901)]
    ticks = spark.createDataFrame(rows, TICKS)
    for gap in (30, 100_000):
        assert rows_of(session_trend(ticks, gap, "event_id", slices)) == brute(rows, gap)


def test_gap_itself_breaks_nothing(spark):
    rows = [("A", 1.0, at(0), 1), ("A", 2.0, at(30), 2), ("A", 3.0, at(60.001), 3), ("A", 4.0, at(60.001), 4)]
    assert [r[-1] for r in rows_of(session_trend(spark.createDataFrame(rows, TICKS), 30, "event_id"))] == [2, 2]
    assert session_trend(spark.createDataFrame([], TICKS), 30).count() == 0


def test_hot_symbol_is_dealt_out(spark):
    cut = sliced(spark.createDataFrame(random_ticks(2000), TICKS), ["symbol"], ["timestamp", "event_id"], 20)
    sizes = [r.n for r in cut.groupBy("_slice").agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 2000 * 0.6 / 4


def test_sliding_windows(spark):
    rows = random_ticks(300)
    ticks = spark.createDataFrame(rows, TICKS).withColumn("timestamp", F.expr("timestamp + make_interval(0, 0, 0, 0, 0, 0, event_id)"))
    wide = ticks.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("moved", F.expr("timestamp - make_interval(0, 0, 0, 0, 0, 20 * bucket)"))
    slid = rows_of(sliding_trend(ticks, "1 hour", "20 minutes", "event_id"))
    starts = wide.select("symbol", "price", F.window("moved", "20 minutes")["start"].alias("bucket"), "event_id", "timestamp")
    want = starts.groupBy("symbol", "bucket").agg(F.min_by("price", F.struct("timestamp", "event_id")).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", F.struct("timestamp", "event_id")).alias("close"), F.avg("price").alias("avg_price"), F.count("*").alias("n_ticks"))
    assert slid == rows_of(want)
    assert rows_of(sliding_trend(ticks, "1 hour", "1 hour", "event_id")) == rows_of(price_trend(ticks, "1 hour", "event_id"))
    with pytest.raises(ValueError, match="multiple"):
        sliding_trend(ticks, "1 hour", "25 minutes")


def test_partial_sessions_join_in_any_order():
    rng = random.Random(4)
    ticks = [(rng.randrange(500), i, float(rng.randint(0, 9))) for i in range(80)]
    parts = [(t, i, p, t, i, p, p, p, p, 1, 1) for t, i, p in ticks]
    whole = joined(parts, 6)
    for _ in range(20):
        rng.shuffle(parts)
        cut = rng.randrange(80)
        assert joined([*joined(parts[:cut], 6), *joined(parts[cut:], 6)], 6) == whole
    assert sum(s[-1] for s in whole) == 80


class Stream:
    """A stream of small batches that can be stopped and started again."""

    def __init__(self, spark, scratch, make):
        self.spark, self.root, self.make = spark, scratch, make

    def feed(self, *batches):
        for rows in batches:
            self.spark.createDataFrame(rows, TICKS).coalesce(1).write.mode("append").parquet(f"{self.root}/ticks")

    def run(self):
        ticks = self.spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(f"{self.root}/ticks")
        with keyed_state(self.spark):
            writer = self.make(ticks).writeStream.format("parquet").option("checkpointLocation", f"{self.root}/progress")
            query = writer.option("path", f"{self.root}/out").trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(map(tuple, self.spark.read.parquet(f"{self.root}/out").collect()), key=str)


def test_silence_is_raised_by_timer_also_after_a_restart(spark, scratch):
    stream = Stream(spark, scratch, lambda ticks: stale_stream(ticks, 1, "10 seconds"))
    stream.feed([("A", 1.0, at(0), 0), ("B", 1.0, at(5), 1)], [("A", 1.0, at(50), 2)])
    assert stream.run() == []
    # B falls silent for good, A for a while; nothing but the clock of C tells so.
    stream.feed([("C", 1.0, at(76), 3)])
    assert stream.run() == [("B", at(5), at(65))]
    stream.feed([("C", 1.0, at(130), 4)], [("A", 1.0, at(140), 5)], [("C", 1.0, at(190), 6)])
    assert stream.run() == [("A", at(50), at(110)), ("B", at(5), at(65))]
    provider = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" not in (spark.conf.get(provider, None) or "")


def test_ticks_out_of_order_extend_and_join_sessions(spark, scratch):
    stream = Stream(spark, scratch, lambda ticks: session_stream(ticks, 30, "100 seconds", "event_id"))
    rows = [[("A", 1.0, at(0), 0), ("A", 3.0, at(60), 1)], [("A", 2.0, at(30), 2), (None, 1.0, at(1), 8), ("A", 1.0, None, 9)], [("A", 9.0, at(120), 3), ("A", None, at(0), -1)]]
    stream.feed(*rows, [("Z", 1.0, at(1000), 4)])
    found = stream.run()
    assert found == [
        ("A", at(0), at(60), None, 3.0, 1.0, 3.0, 2.0, 4),
        ("A", at(120), at(120), 9.0, 9.0, 9.0, 9.0, 9.0, 1),
    ]


def test_streamed_sessions_equal_batch(spark, scratch):
    rows = sorted(random_ticks(300, 7), key=lambda r: r[2])
    stream = Stream(spark, scratch, lambda ticks: session_stream(ticks, 40, "1 second", "event_id"))
    stream.feed(rows[:90], rows[90:200])
    stream.run()
    stream.feed(rows[200:], [("Z", 1.0, at(100_000), 999)])
    found = [(*r[:7], None if r[7] is None else round(r[7], 9), r[8]) for r in stream.run()]
    assert sorted(found, key=str) == brute(rows, 40)


def test_tie_must_be_a_number(spark):
    with pytest.raises(TypeError, match="symbol"):
        session_stream(spark.createDataFrame([], TICKS), 1, tie="symbol")
