import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tickwell.schema import TOPIC_RECORD
from tickwell.sources.topic import (
    append_topic,
    checkpoint_of,
    kafka_sink_options,
    kafka_source_options,
    read_kafka,
    read_topic,
    scan_topic,
    to_messages,
    to_records,
    topic_ends,
    write_kafka,
)


def records(spark, first, last, ends=None):
    df = spark.range(first, last).select("id", F.concat(F.lit("m"), F.col("id")).alias("text"))
    return to_records(to_messages(df, F.col("text")), F.col("id") % 3, ["id"], ends=ends, slices=4)


def test_append_goes_on_where_the_topic_ends(spark, scratch):
    path = f"{scratch}/topic"
    assert read_topic(spark, path).count() == 0
    append_topic(records(spark, 0, 10), path)
    append_topic(records(spark, 10, 25, topic_ends(read_topic(spark, path))), path)
    stored = read_topic(spark, path)
    assert stored.schema.names == TOPIC_RECORD.names
    rows = stored.orderBy("partition", "offset").collect()
    assert [r.offset for r in rows if r.partition == 1] == list(range(8))
    assert [bytes(r.value).decode() for r in rows if r.partition == 1] == [f"m{i}" for i in range(1, 25, 3)]
    assert all(r.key is None and r.topic == "stockprice" for r in rows)


def test_starting_offsets(spark):
    df = records(spark, 0, 30)
    assert scan_topic(df).count() == 30
    assert scan_topic(df, "other").count() == 0
    assert scan_topic(df, starting={0: 4, 2: 10}).count() == 6 + 10 + 0


def test_kafka_options():
    assert kafka_source_options("b:9092") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "stockprice", "startingOffsets": "earliest",
    }
    assert kafka_source_options("b:9092", "t", 500)["maxOffsetsPerTrigger"] == "500"
    assert kafka_sink_options("b:9092") == {"kafka.bootstrap.servers": "b:9092", "topic": "stockprice"}
    assert checkpoint_of("/shared/") == "/shared/stock_price_consumer_group"


def test_kafka_offsets_per_partition():
    options = kafka_source_options("host:9092", "t", starting={0: 5, 1: -2})
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 5, "1": -2}}


def test_kafka_calls_name_the_source(spark):
    """The connector is not on this machine; what is asked of Spark is."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_kafka(spark, "host:9092", starting={0: 1})
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        write_kafka(to_messages(spark.range(1), F.lit("x")), "host:9092")


def test_many_starting_offsets_are_one_lookup(spark):
    records = spark.range(100).selectExpr("'stockprice' AS topic", "int(id % 50) AS partition", "id AS offset")
    picked = scan_topic(records, starting={p: 60 for p in range(1, 5000)})
    assert picked.count() == 42
    assert picked._jdf.queryExecution().optimizedPlan().toString().count("partition") < 12
