"""The message topic: Kafka options, and a file-backed topic with the same record shape."""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.plans.slices import ranked
from tickwell.schema import CONSUMER_GROUP, TOPIC, TOPIC_RECORD
from tickwell.sources.files import if_there

#: Kafka's code for a timestamp set by the producer.
CREATE_TIME = 0


def kafka_source_options(
    servers: str, topic: str = TOPIC, per_trigger: int | None = None, starting: dict[int, int] | None = None
) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``: from the start, unless the checkpoint knows better.

    ``starting`` holds offsets by partition, of all the topic's partitions, as Kafka's
    source asks for; -2 stands for a partition's start, -1 for its end.
    """
    first = "earliest" if starting is None else json.dumps({topic: {str(p): o for p, o in starting.items()}})
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": first}
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return options


def kafka_sink_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    """Options for ``write(Stream).format("kafka")`` on ``to_messages`` output."""
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def checkpoint_of(root: str, group: str = CONSUMER_GROUP) -> str:
    """A consumer group's progress is the checkpoint of its query: one per group."""
    return f"{root.rstrip('/')}/{group}"


def to_messages(df: DataFrame, value: Column) -> DataFrame:
    """Add ``key`` (always NULL) and ``value`` (UTF-8 bytes), as the Kafka sink takes them."""
    return df.withColumns({"key": F.lit(None).cast("binary"), "value": value.cast("binary")})


def to_records(
    messages: DataFrame,
    partition: Column,
    order: list[str],
    topic: str = TOPIC,
    clock: Column | None = None,
    ends: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Give messages their place in a topic: a partition, and the next offset in it.

    ``order`` is the order of sending; see ``ranked`` for what it must be. ``ends``
    (``partition``, ``end``) are the topic's present ends. Columns other than the
    record's stay.
    """
    messages = messages.withColumn("partition", partition.cast("int"))
    placed = ranked(messages, ["partition"], order, "_nth", ends, slices)
    end = F.lit(0) if ends is None else F.coalesce("end", F.lit(0))
    return placed.withColumns(
        {
            "topic": F.lit(topic),
            "offset": (end + F.col("_nth") - 1).cast("bigint"),
            "timestamp": (F.current_timestamp() if clock is None else clock).cast("timestamp"),
            "timestampType": F.lit(CREATE_TIME),
        }
    ).drop("_nth", "end")


def topic_ends(records: DataFrame) -> DataFrame:
    """Next offset per partition: one row for each, however long the topic."""
    return records.groupBy("partition").agg((F.max("offset") + 1).alias("end"))


def append_topic(records: DataFrame, path: str) -> None:
    """Append records to a file topic; readers that follow it see whole files only."""
    records.select(*TOPIC_RECORD.names).write.mode("append").parquet(path)


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    return if_there(spark, lambda: reader.parquet(path), TOPIC_RECORD)


def follow_topic(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The file topic as a stream, from its start unless a checkpoint knows better."""
    reader = spark.readStream.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.parquet(path)


def scan_topic(records: DataFrame, topic: str = TOPIC, starting: dict[int, int] | None = None) -> DataFrame:
    """Records of one topic, from given offsets on; a partition not named is read from its start."""
    picked = records.filter(F.col("topic") == topic)
    if not starting:
        return picked
    first = F.map_from_arrays(*(F.lit([int(x) for x in xs]) for xs in (starting.keys(), starting.values())))
    return picked.filter(F.col("offset") >= F.coalesce(F.try_element_at(first, F.col("partition")), F.lit(0)))


def read_kafka(spark: SparkSession, servers: str, topic: str = TOPIC, starting: dict[int, int] | None = None, **options: str) -> DataFrame:
    """A Kafka topic as a stream, from its start or, per partition, from given offsets; a checkpoint knows better."""
    return spark.readStream.format("kafka").options(**kafka_source_options(servers, topic, starting=starting), **options).load()


def write_kafka(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Append ``to_messages`` output to a Kafka topic."""
    messages.select("key", "value").write.format("kafka").options(**kafka_sink_options(servers, topic)).save()
