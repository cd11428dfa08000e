"""Bucketed keys: the same answers as the plain check, and no exchange of the history."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from test_filters import KEYS, START, keys, rows
from tickwell.operators.keys import first_by_key, not_stored
from tickwell.sources import buckets
from tickwell.sources.events import mixed_payload, records_of
from tickwell.sources.table import read_history, read_rejects
from tickwell.sources.topic import append_topic, follow_topic
from tickwell.streaming import ingest


@pytest.fixture
def name(spark, scratch):
    own = f"keys_{uuid.uuid4().hex}"
    buckets.create_keys(spark, own, f"{scratch}/keys", buckets=6)
    yield own
    spark.sql(f"DROP TABLE {own}")


def test_same_as_the_plain_check(spark, name):
    stored, batch = keys(spark, 0, 300), keys(spark, 200, 500)
    for n in range(3):
        buckets.append_bucketed(stored.filter(F.col("price") % 3 == n), name, "run", n)
    assert rows(buckets.not_stored_by_bucket(batch, name)) == rows(not_stored(batch, stored))
    # What the batch itself has added doesn't count, nor does adding it again.
    buckets.append_bucketed(batch, name, "run", 3)
    buckets.append_bucketed(batch, name, "run", 3)
    assert rows(buckets.not_stored_by_bucket(batch, name, "run", 3)) == rows(not_stored(batch, stored))
    assert buckets.not_stored_by_bucket(batch, name, "other", 3).count() == 0


@pytest.mark.parametrize("shuffle", ["4", "6", "50"])
def test_only_the_batch_is_shuffled(spark, name, shuffle):
    """Also where the batch, made distinct, already lies in more or fewer parts than there are buckets."""
    buckets.append_bucketed(keys(spark, 0, 300), name, "run", 0)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shuffle)
    try:
        found = buckets.not_stored_by_bucket(first_by_key(keys(spark, 200, 500), order=["price"]), name)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert rows(found) == rows(keys(spark, 300, 500))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    join = plan.index("SortMergeJoin")
    # The join's second child, the history, begins where a child is drawn right below the join's own line.
    indent = join - plan.rindex("\n", 0, join) - 1
    history = plan[plan.index("\n" + " " * indent + "+-", join) :]
    assert "Bucketed: true" in history and "PartitionFilters: [isnotnull(date" in history
    assert "Exchange" in plan and "Exchange" not in history and "Exchange" not in plan[:join]


def test_other_days_are_not_read(spark, name):
    buckets.append_bucketed(keys(spark, 0, 3000), name, "run", 0)  # 601 seconds apart, some 21 days
    found = buckets.not_stored_by_bucket(keys(spark, 0, 100), name)
    assert found.count() == 0
    days = spark.table(name).select("date").distinct().count()
    files = len(spark.table(name).filter(F.col("date") == F.lit(START.date())).inputFiles())
    assert days > 15 and files <= 6


def test_edges(spark, name):
    assert buckets.not_stored_by_bucket(keys(spark, 0, 0), name).count() == 0
    assert rows(buckets.not_stored_by_bucket(keys(spark, 0, 5), name)) == rows(keys(spark, 0, 5))
    odd = spark.createDataFrame([(None, START, 1.0), ("A", None, 2.0), (None, None, 3.0)], KEYS)
    buckets.append_bucketed(odd, name, "run", 0)
    assert spark.table(name).count() == 0 and buckets.not_stored_by_bucket(odd, name).count() == 3
    long_ = spark.createDataFrame([("x" * 100_000, datetime(1, 1, 1), 1.0)], KEYS)
    buckets.append_bucketed(long_, name, "run", 1)
    assert buckets.not_stored_by_bucket(long_, name).count() == 0


def test_ingestion_with_buckets_equals_ingestion_without(spark, scratch, name, monkeypatch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    records = records_of(events, mixed_payload()).withColumn("timestamp", F.date_trunc("minute", "timestamp")).cache()
    for n in range(3):
        append_topic(records.filter(F.col("event_id") % 3 == n).coalesce(1), f"{scratch}/topic")
    found = []
    for kind, table in (("with", name), ("without", None)):
        root = f"{scratch}/{kind}"

        def run(root=root, table=table):
            follow = follow_topic(spark, f"{scratch}/topic", 1)
            ingest.start_ingest(follow, f"{root}/history", f"{root}/rejects", f"{root}/progress", "timestamp", buckets=table).awaitTermination()

        if table:
            # The first batch's keys are in the table, but it did not commit: its replay must not take them for stored.
            with monkeypatch.context() as broken, pytest.raises(Exception, match="lost"):
                broken.setattr(ingest, "commit_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                run()
        run()
        prices = read_history(spark, f"{root}/history").select("symbol", "timestamp", "price", "partition", "offset")
        rejects = read_rejects(spark, f"{root}/rejects").select("partition", "offset", "reason")
        found.append((sorted(map(tuple, prices.collect())), sorted(map(tuple, rejects.collect()))))
    assert found[0] == found[1] and found[0][0]


def test_keys_need_a_clock(spark, scratch, name):
    with pytest.raises(ValueError, match="clock"):
        ingest.start_ingest(None, scratch, scratch, scratch, buckets=name)
