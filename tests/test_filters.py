"""Key filters: no key is lost, and a batch of new keys opens no history."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickwell.operators.keys import not_stored
from tickwell.sources import filters
from tickwell.sources.events import mixed_payload, records_of
from tickwell.sources.table import read_history, read_rejects
from tickwell.sources.topic import append_topic, follow_topic
from tickwell.streaming import ingest

KEYS = "symbol string, timestamp timestamp_ntz, price double"
START = datetime(2024, 1, 1)


def keys(spark, first, last, step=1):
    seconds = F.col("id") * F.lit(601)
    at = F.timestamp_micros(F.unix_micros(F.lit(START)) + seconds * 1_000_000).cast("timestamp_ntz")
    symbol = F.concat(F.lit("S"), (F.col("id") % 7).cast("string"))
    return spark.range(first, last, step).select(symbol.alias("symbol"), at.alias("timestamp"), F.col("id").cast("double").alias("price"))


def rows(df):
    return sorted(map(tuple, df.select("symbol", "timestamp", "price").collect()))


@pytest.mark.parametrize("bits", [1 << 23, 1 << 15, 64])
def test_result_does_not_depend_on_the_size(spark, scratch, bits):
    """With 64 bits an hour the filters are full and everything is looked up."""
    stored, batch = keys(spark, 0, 300), keys(spark, 200, 500)
    for n in range(3):
        filters.add_keys(stored.filter(F.col("price") % 3 == n), scratch, "run", n, bits)
        filters.add_keys(stored.filter(F.col("price") % 3 == n), scratch, "run", n, bits)
    asked = []

    def history(days):
        asked.extend(days)
        return stored.filter(F.to_date("timestamp").isin(days))

    assert rows(filters.not_stored_by_filter(batch, scratch, history)) == rows(not_stored(batch, stored))
    repeated = {r.d for r in keys(spark, 200, 300).select(F.to_date("timestamp").alias("d")).distinct().collect()}
    assert set(asked) >= repeated and len(asked) == len(set(asked))
    if bits == 1 << 23:
        assert set(asked) == repeated


def test_new_keys_open_no_history(spark, scratch):
    filters.add_keys(keys(spark, 0, 3000), scratch, "run", 0)
    assert rows(filters.not_stored_by_filter(keys(spark, 3000, 4000), scratch, None)) == rows(keys(spark, 3000, 4000))
    again = filters.judged_by_filter(keys(spark, 0, 3000), scratch)
    assert again.filter("NOT _maybe").count() == 0


def test_edges(spark, scratch):
    assert rows(filters.not_stored_by_filter(keys(spark, 0, 5), scratch, None)) == rows(keys(spark, 0, 5))
    odd = spark.createDataFrame([(None, START, 1.0), ("A", None, 2.0)], KEYS)
    filters.add_keys(odd, scratch, "run", 0)
    filters.add_keys(keys(spark, 0, 0), scratch, "run", 1)
    assert filters.not_stored_by_filter(keys(spark, 0, 0), scratch, None).count() == 0


def test_ingestion_with_filters_equals_ingestion_without(spark, scratch, monkeypatch):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    records = records_of(events, mixed_payload()).withColumn("timestamp", F.date_trunc("minute", "timestamp")).cache()
    for n in range(3):
        append_topic(records.filter(F.col("event_id") % 3 == n).coalesce(1), f"{scratch}/topic")
    found = []
    for name, folder in (("with", f"{scratch}/filters"), ("without", None)):
        root = f"{scratch}/{name}"

        def run(root=root, folder=folder):
            follow = follow_topic(spark, f"{scratch}/topic", 1)
            ingest.start_ingest(follow, f"{root}/history", f"{root}/rejects", f"{root}/progress", "timestamp", filters=folder).awaitTermination()

        if folder:
            # The first batch's keys are in the filters, but it did not commit: its replay must not take them for stored.
            with monkeypatch.context() as broken, pytest.raises(Exception, match="lost"):
                broken.setattr(ingest, "commit_batch", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
                run()
        run()
        prices = read_history(spark, f"{root}/history").select("symbol", "timestamp", "price", "partition", "offset")
        rejects = read_rejects(spark, f"{root}/rejects").select("partition", "offset", "reason")
        found.append((sorted(map(tuple, prices.collect())), sorted(map(tuple, rejects.collect()))))
    assert found[0] == found[1] and found[0][0]
