"""Ticks and messages derived from an event table: symbol = event type, price = value, order = event id."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.functions.codec import encode_legacy_tick, encode_tick, epoch_millis
from tickwell.schema import TOPIC_RECORD
from tickwell.sources.topic import to_messages, to_records

TOPIC_PARTITIONS = 4


def ticks_of(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.col("ts").alias("timestamp"),
    )


def topic_partition() -> Column:
    return F.pmod(F.col("user_id"), F.lit(TOPIC_PARTITIONS)).cast("int")


def records_of(events: DataFrame, value: Column) -> DataFrame:
    """The events as records of the topic, stamped with their own time."""
    messages = to_messages(events, value)
    records = to_records(messages, topic_partition(), ["event_id"], clock=F.col("ts"))
    return records.select("event_id", *TOPIC_RECORD.names)


def clean_payload() -> Column:
    return encode_tick(F.col("value"), F.col("event_type"))


#: Kinds of ``mixed_payload``, in turn; those past the list are clean messages.
MIXED = [
    "{bad",
    '{"price":%p}',
    '{"price":null,"symbol":"%s"}',
    '{"price":"%p","symbol":"%s","company":"%s Inc","market":"NASDAQ"}',
    '{"price":"abc","symbol":"%s"}',
    '{"price":%p,"symbol":"%s","company":null,"market":"NYSE"}',
    "[1]",
    '{"price":true,"symbol":"%s"}',
    '{"symbol":"%s"}',
    '{"price":%p,"symbol":null}',
    '{"price":%p,"symbol":{"a":"%s"}}',
    '{"price":%p,"symbol":"%s-too-long"}',
    '{"price":%p,"symbol":"%s","market":[1]}',
]
MIXED_KINDS = 20

#: Kinds of ``legacy_payload``, in turn; ``%t`` is the producer's clock. Those past the list are clean.
LEGACY = [
    '{"price":%p,"symbol":"%s","company":"%s","market":"NASDAQ"}',
    '{"Price":"%p","Name":"%s","Timestamp":"%t"}',
    '{"Price":%p,"Name":"%s"}',
    '{"Price":%p,"Name":"%s","Timestamp":9223372036854775807}',
    '{"Price":%p,"Name":"%s","Timestamp":1700000000123000}',
    '{"Price":%p,"Name":{"a":1},"Timestamp":%t}',
    '{"Price":%p,"Name":null,"Timestamp":%t}',
    '{"Price":true,"Name":"%s","Timestamp":%t}',
    '{"Name":"%s","Timestamp":%t}',
    '{"Price":"x","Name":"%s","Timestamp":%t}',
    '{"Price":%p,"Name":"%s-too-long","Timestamp":%t}',
    "[1]",
    '{"Price":%p,"Timestamp":%t}',
]
LEGACY_KINDS = 24


def _filled(template: str, values: dict[str, Column]) -> Column:
    parts = re.split("(%[pst])", template)
    return F.concat(*[values[p] if p in values else F.lit(p) for p in parts if p])


def _in_turn(kinds: list[str], of: int, values: dict[str, Column], clean: Column) -> Column:
    kind = F.pmod(F.col("event_id"), F.lit(of))
    payload = F.when(kind == 0, _filled(kinds[0], values))
    for n, template in enumerate(kinds[1:], 1):
        payload = payload.when(kind == n, _filled(template, values))
    return payload.otherwise(clean)


def mixed_payload() -> Column:
    """Payloads of twenty kinds in turn, good and bad, so that a table of any size holds them all."""
    values = {"%p": F.col("value").cast("string"), "%s": F.col("event_type")}
    return _in_turn(MIXED, MIXED_KINDS, values, clean_payload())


def legacy_payload(clock: Column) -> Column:
    """Legacy messages stamped with ``clock``, good and bad, and current ones, of 24 kinds in turn."""
    values = {"%p": F.col("value").cast("string"), "%s": F.col("event_type"), "%t": epoch_millis(clock).cast("string")}
    return _in_turn(LEGACY, LEGACY_KINDS, values, encode_legacy_tick(F.col("value"), F.col("event_type"), clock))
