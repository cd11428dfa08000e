"""Streams against the batch plan; restarts and replays."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickwell.functions.clock import moment
from tickwell.operators.validate import accepted, judge
from tickwell.plans.ingest import ingest
from tickwell.sources.events import mixed_payload, records_of
from tickwell.sources.table import read_history, read_rejects, write_history
from tickwell.sources.topic import append_topic, follow_topic, read_topic, to_messages, to_records, topic_ends
from tickwell.streaming.ingest import start_ingest
from tickwell.streaming.poll import _placed, start_poller


@pytest.fixture(scope="module")
def records(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return records_of(events, mixed_payload()).withColumn("timestamp", F.date_trunc("hour", "timestamp")).cache()


class Job:
    def __init__(self, spark, root, clock=None, files=1, **options):
        self.spark, self.root, self.clock, self.files, self.options = spark, root, clock, files, options

    def run(self, progress="progress"):
        query = start_ingest(
            follow_topic(self.spark, f"{self.root}/topic", self.files),
            f"{self.root}/history",
            f"{self.root}/rejects",
            f"{self.root}/{progress}",
            self.clock,
            **self.options,
        )
        query.awaitTermination()
        return query

    @property
    def history(self):
        return read_history(self.spark, f"{self.root}/history")

    @property
    def rejects(self):
        return read_rejects(self.spark, f"{self.root}/rejects")

    def forget_last_commit(self, progress="progress"):
        """As after a crash between writing a batch and committing it."""
        commits = sorted((p for p in Path(f"{self.root}/{progress}/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        commits[-1].unlink()
        crc = commits[-1].with_name(f".{commits[-1].name}.crc")
        if crc.exists():
            crc.unlink()


def write_in_parts(records, path, n):
    for i in range(n):
        append_topic(records.filter(F.col("event_id") % n == i).coalesce(1), path)


def rows(df, *names):
    return sorted(df.select(*names).collect(), key=str)


LINEAGE = ["topic", "partition", "offset"]


def test_arrival_stream_stores_what_is_valid(spark, records, scratch):
    write_in_parts(records, f"{scratch}/topic", 3)
    job = Job(spark, scratch)
    job.run()
    judged = judge(records)
    fields = ["symbol", "price", "company", "market", *LINEAGE]
    assert rows(job.history, *fields) == rows(accepted(judged), *fields)
    assert rows(job.rejects, *LINEAGE, "reason") == rows(judged.filter("reason IS NOT NULL"), *LINEAGE, "reason")
    assert job.history.select("batch_id").distinct().count() == 3
    assert job.history.select("symbol", "timestamp").distinct().count() == job.history.count()


def test_restart_reads_nothing_twice(spark, records, scratch):
    write_in_parts(records, f"{scratch}/topic", 2)
    job = Job(spark, scratch)
    job.run()
    before = rows(job.history, "symbol", "timestamp", *LINEAGE)
    assert not any(p["numInputRows"] for p in map(json.loads, map(lambda x: x.json, job.run().recentProgress)))
    assert rows(job.history, "symbol", "timestamp", *LINEAGE) == before
    append_topic(records.filter("event_id < 10"), f"{scratch}/topic")
    job.run()
    assert job.history.count() == len(before) + accepted(judge(records.filter("event_id < 10"))).count()


@pytest.mark.parametrize("clock", [None, "timestamp"])
def test_replayed_batch_replaces_itself(spark, records, scratch, clock):
    write_in_parts(records, f"{scratch}/topic", 2)
    job = Job(spark, scratch, clock)
    job.run()
    prices = rows(job.history, "symbol", "timestamp", "price", *LINEAGE)
    rejects = rows(job.rejects, "reason", *LINEAGE)
    job.forget_last_commit()
    job.run()
    assert rows(job.history, "symbol", "timestamp", "price", *LINEAGE) == prices
    assert rows(job.rejects, "reason", *LINEAGE) == rejects


def test_stamps_move_behind_those_of_a_batch_that_ran_ahead(spark, records, scratch):
    """As if an earlier run had stamped a minute ahead of the clock."""
    append_topic(records, f"{scratch}/topic")
    job = Job(spark, scratch)
    now = spark.sql("SELECT CAST(current_timestamp() AS TIMESTAMP_NTZ) + INTERVAL 60 SECOND AS t").first().t
    ahead = accepted(judge(records)).filter("symbol = 'click'").limit(1).withColumn("timestamp", moment(now))
    write_history(ahead, f"{scratch}/history", "earlier", 0)
    job.run()
    first = {r.symbol: r.t for r in job.history.filter("run_id <> 'earlier'").groupBy("symbol").agg(F.min("timestamp").alias("t")).collect()}
    assert first["click"] > now > first["view"]
    assert job.history.select("symbol", "timestamp").distinct().count() == job.history.count()


def test_new_checkpoint_leaves_old_history(spark, records, scratch):
    append_topic(records, f"{scratch}/topic")
    job = Job(spark, scratch)
    job.run("first")
    n = job.history.count()
    job.run("second")
    assert job.history.count() == 2 * n
    assert job.history.select("symbol", "timestamp").distinct().count() == 2 * n


def test_keyed_stream_equals_batch(spark, records, scratch):
    # One file after another in the order of arrival, so that the first writer is the same in both.
    path = f"{scratch}/topic"
    for p in range(4):
        append_topic(records.filter(F.col("partition") == p).coalesce(1), path)
    job = Job(spark, scratch, "timestamp")
    job.run()
    settled = ingest(records, "timestamp")
    keyed = ["symbol", "timestamp", "price", "company", "market"]
    assert job.history.select("batch_id").distinct().count() > 1
    assert job.history.select("symbol", "timestamp").distinct().count() == job.history.count()
    assert rows(job.history, "symbol", "timestamp") == rows(settled.prices, "symbol", "timestamp")
    assert job.rejects.count() == settled.rejects.count()
    assert job.rejects.filter("reason = 'duplicate_key'").count() > 0

    whole = Job(spark, f"{scratch}/whole", "timestamp", files=None)
    append_topic(records, f"{scratch}/whole/topic")
    whole.run()
    assert rows(whole.history, *keyed, *LINEAGE) == rows(settled.prices, *keyed, *LINEAGE)
    assert rows(whole.rejects, *LINEAGE, "reason") == rows(settled.rejects, *LINEAGE, "reason")


def test_further_sink_gets_each_batch(spark, records, scratch):
    write_in_parts(records, f"{scratch}/topic", 2)
    seen = {}
    job = Job(spark, scratch, also=lambda df, batch_id: seen.update({batch_id: df.count()}))
    job.run()
    assert len(seen) == 2 and sum(seen.values()) == job.history.count()


def test_malformed_may_stop_the_stream(spark, records, scratch):
    append_topic(records, f"{scratch}/topic")
    with pytest.raises(Exception, match="not JSON"):
        Job(spark, scratch, on_malformed="fail").run()
    assert read_history(spark, f"{scratch}/history").count() == 0


def test_legacy_stream(spark, scratch):
    text = F.format_string('{"Price":%d,"Name":"AMZN","Timestamp":%d}', F.col("id"), F.col("id") * 1000)
    messages = to_messages(spark.range(10), text)
    append_topic(to_records(messages, F.lit(0), ["id"]), f"{scratch}/topic")
    job = Job(spark, scratch, "event_time", legacy=True)
    job.run()
    assert [str(r.timestamp) for r in job.history.orderBy("timestamp").limit(2).collect()] == [
        "1970-01-01 00:00:00", "1970-01-01 00:00:01",
    ]


def test_poller_sends_every_symbol_each_time(spark, scratch):
    ticks = "symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ"

    def trade(symbol, price, second):
        df = spark.sql(f"SELECT '{symbol}' AS symbol, {price}D AS price, TIMESTAMP_NTZ'2024-01-01 00:00:{second:02}' AS timestamp")
        df.write.mode("append").parquet(f"{scratch}/ticks")

    def poll():
        stream = spark.readStream.schema(ticks).parquet(f"{scratch}/ticks")
        start_poller(stream, f"{scratch}/topic", f"{scratch}/progress", seconds=None, partitions=2, echo=True).awaitTermination()

    trade("A", 1.0, 1)
    trade("B", 5.0, 1)
    poll()
    trade("A", 2.0, 2)
    poll()
    sent = judge(read_topic(spark, f"{scratch}/topic"))
    assert [(r.symbol, r.price) for r in sent.orderBy("symbol", "price").collect()] == [("A", 1.0), ("A", 2.0), ("B", 5.0), ("B", 5.0)]
    assert all(r.market == "NASDAQ" for r in sent.collect())
    ends = {r.partition: r.end for r in topic_ends(read_topic(spark, f"{scratch}/topic")).collect()}
    assert sum(ends.values()) == 4


def test_poison_times_stop_nothing(spark, scratch):
    stamps = F.when(F.col("id") == 3, "9223372036854775807").when(F.col("id") == 4, "1700000000123000").otherwise(F.col("id").cast("string"))
    messages = to_messages(spark.range(10), F.format_string('{"Price":%d,"Name":"AMZN","Timestamp":%s}', F.col("id"), stamps))
    records = to_records(messages, F.lit(0), ["id"])
    for clock in ("event_time", None):
        append_topic(records, f"{scratch}/{clock}/topic")
        job = Job(spark, f"{scratch}/{clock}", clock, legacy=True)
        job.run()
        assert job.history.count() == 8
        assert [r.reason for r in job.rejects.collect()] == ["bad_timestamp"] * 2


def test_poller_sends_without_new_ticks(spark, scratch):
    spark.sql("SELECT 'A' AS symbol, 1D AS price, TIMESTAMP_NTZ'2024-01-01 00:00:01' AS timestamp").write.parquet(f"{scratch}/ticks")
    stream = spark.readStream.schema("symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ").parquet(f"{scratch}/ticks")
    query = start_poller(stream, f"{scratch}/topic", f"{scratch}/progress", seconds=2, partitions=2)
    try:
        for _ in range(120):
            time.sleep(0.5)
            if read_topic(spark, f"{scratch}/topic").count() >= 4:
                break
    finally:
        query.stop()
    sent = read_topic(spark, f"{scratch}/topic").orderBy("offset").collect()
    assert len(sent) >= 4
    assert [r.offset for r in sent] == list(range(len(sent)))
    assert all(b'"symbol":"A"' in bytes(r.value) for r in sent)


def test_offsets_of_a_batch_have_no_gap(spark):
    messages = to_messages(spark.range(3000).select(F.format_string("S%d", "id").alias("symbol")), F.lit("x"))
    ends = spark.createDataFrame([(0, 7)], "partition INT, end BIGINT")
    placed = _placed(messages, ends, 3)
    found = {r.partition: (r.lo, r.hi, r.n) for r in placed.groupBy("partition").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi"), F.countDistinct("offset").alias("n")).collect()}
    assert found[0][0] == 7 and found[1][0] == 0
    assert all(hi - lo + 1 == n for lo, hi, n in found.values())
    assert sum(n for *_, n in found.values()) == 3000
