"""One commit for history and rejects, and reports by counts kept on the way."""

import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickwell.schema import REASONS
from tickwell.sources.events import mixed_payload, records_of
from tickwell.sources.table import append_prices, create_price_table, drop_merged, only_missing, read_history, read_rejects, write_history
from tickwell.sources.topic import append_topic, follow_topic
from tickwell.streaming import ingest
from tickwell.streaming.report import ArrivalListener


@pytest.fixture(scope="module")
def records(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return records_of(events, mixed_payload()).withColumn("timestamp", F.date_trunc("hour", "timestamp")).cache()


@pytest.fixture
def topic(records, scratch):
    for n in range(3):
        append_topic(records.filter(F.col("event_id") % 3 == n).coalesce(1), f"{scratch}/topic")
    return scratch


def run(spark, root, clock="timestamp", **options):
    follow = follow_topic(spark, f"{root}/topic", 1)
    ingest.start_ingest(follow, f"{root}/history", f"{root}/rejects", f"{root}/progress", clock, **options).awaitTermination()


def batches(spark, root):
    return [{r.batch_id for r in df.select("batch_id").distinct().collect()} for df in (read_history(spark, f"{root}/history"), read_rejects(spark, f"{root}/rejects"))]


def places(spark, root):
    both = [read_history(spark, f"{root}/history"), read_rejects(spark, f"{root}/rejects")]
    return sorted((r.partition, r.offset) for df in both for r in df.select("partition", "offset").collect())


@pytest.mark.parametrize("clock", ["timestamp", None])
def test_failure_between_the_sinks_shows_neither(spark, records, topic, monkeypatch, clock):
    write, calls = ingest.write_rejects, []

    def fail_at_the_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(*args)

    with monkeypatch.context() as broken, pytest.raises(Exception, match="lost"):
        broken.setattr(ingest, "write_rejects", fail_at_the_second)
        run(spark, topic, clock)
    assert list(Path(topic, "history").glob("date=*/run_id=*/batch_id=1"))
    assert batches(spark, topic) == [{0}, {0}]
    run(spark, topic, clock)
    assert batches(spark, topic) == [{0, 1, 2}, {0, 1, 2}]
    assert places(spark, topic) == sorted((r.partition, r.offset) for r in records.select("partition", "offset").collect())


def test_first_batch_is_hidden_too(spark, topic, monkeypatch):
    with monkeypatch.context() as broken, pytest.raises(Exception, match="commit_batch"):
        broken.setattr(ingest, "commit_batch", None)
        broken.setattr(ingest, "commit_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("commit_batch")))
        run(spark, topic)
    assert batches(spark, topic) == [set(), set()]
    assert not list(Path(topic, "history").glob("_merged*")) and drop_merged(spark, f"{topic}/history") is None
    run(spark, topic)
    assert batches(spark, topic) == [{0, 1, 2}, {0, 1, 2}]


def test_log_does_not_grow(spark, topic):
    run(spark, topic)
    assert len(list(Path(topic, "history", "_commits").glob("run_id=*/batch_id=*"))) == 2
    # Rows written by hand, of a run without a log, are seen at once.
    write_history(read_history(spark, f"{topic}/history"), f"{topic}/history", "by hand", 0)
    assert read_history(spark, f"{topic}/history").filter("run_id = 'by hand'").count() > 0


@pytest.mark.parametrize("clock", ["timestamp", None])
def test_reports_equal_the_tables(spark, topic, monkeypatch, clock):
    if clock is not None:
        monkeypatch.setattr(ingest, "_counts", None)
    told, arrived = [], {}
    listener = ArrivalListener(lambda batch_id, counts: arrived.update({batch_id: counts}))
    spark.streams.addListener(listener)
    try:
        run(spark, topic, clock, report=told.append)
        for _ in range(50):
            if len(arrived) == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    stored = {r.batch_id: r["count"] for r in read_history(spark, f"{topic}/history").groupBy("batch_id").count().collect()}
    left = {(r.batch_id, r.reason): r["count"] for r in read_rejects(spark, f"{topic}/rejects").groupBy("batch_id", "reason").count().collect()}
    assert [t.batch_id for t in told] == [0, 1, 2]
    assert {t.batch_id: t.stored for t in told} == stored
    assert {(t.batch_id, reason): n for t in told for reason, n in t.rejected.items()} == left
    assert {reason for _, reason in left} <= set(REASONS)
    for t in told:
        own = {reason: n for reason, n in t.rejected.items() if reason != "duplicate_key"}
        assert arrived[t.batch_id] == {"records": t.stored + sum(t.rejected.values()), **own}


def test_table_is_read_by_the_time_of_the_batch(spark):
    name = f"prices_{uuid.uuid4().hex}"
    create_price_table(spark, name)
    rows = spark.range(100).select(F.lit("A").alias("symbol"), F.lit(1.0).alias("price"), F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("timestamp"), F.lit("A").alias("company"), F.lit("X").alias("market"))
    assert append_prices(rows, name).count() == 0
    plan = only_missing(rows.filter("id < 10"), spark.table(name))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert append_prices(rows.limit(7), name).count() == 7
    assert append_prices(rows.limit(0), name).count() == 0
