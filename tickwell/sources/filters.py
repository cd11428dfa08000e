"""Filters over the keys of a history, so that a batch of new keys need not open it.

Each hour of the keys' own time has a Bloom filter, kept as bitmaps of 4 KB. A key sets
HASHES bits of its hour's filter. A key that lacks one of its bits is new for certain; only
the others, true repeats and a few by chance, are looked up in the history. Filters miss no
key, so what is stored does not depend on them; one that is too full costs look-ups, no
right answer. Batches merge their keys into the hours they touch (``sources.versions``).
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.operators.keys import not_stored
from tickwell.schema import PRICE_KEY
from tickwell.sources.scratch import kept
from tickwell.sources.versions import commit, read_parts, read_snapshot, write_parts

#: Bits of an hour's filter: at 20 a key, room for 400,000 keys an hour with one in 10,000 looked up in vain.
BITS = 1 << 23
HASHES = 14
_BITMAP = 1 << 15
_DDL = "hour STRING, chunk BIGINT, bits BINARY"


def _hour() -> Column:
    return F.date_format("timestamp", "yyyy-MM-dd'T'HH").alias("hour")


def _positions(keys: DataFrame, bits: int) -> DataFrame:
    """A row per bit of each key: the key, hour, chunk, bit."""
    places = F.array(*[F.pmod(F.xxhash64(*PRICE_KEY, F.lit(i)), F.lit(bits)) for i in range(HASHES)])
    each = keys.select(*PRICE_KEY, _hour(), F.explode(places).alias("p"))
    return each.select(*PRICE_KEY, "hour", F.floor(F.col("p") / _BITMAP).alias("chunk"), (F.col("p") % _BITMAP).alias("bit"))


def add_keys(prices: DataFrame, folder: str, run_id: str, batch_id: int, bits: int = BITS) -> None:
    """Merge the keys of a batch into the filters; does nothing if they hold the batch. ``bits`` is fixed by the first batch."""
    spark = prices.sparkSession
    before = read_snapshot(spark, folder)
    if before.holds(run_id, batch_id):
        return
    bits = before.memory.get("bits", bits)
    keys = prices.dropna(subset=PRICE_KEY).select(*PRICE_KEY)
    hours = [r.hour for r in keys.select(_hour()).distinct().collect()]
    if hours:
        new = _positions(keys, bits).groupBy("hour", "chunk").agg(F.bitmap_construct_agg("bit").alias("bits"))
        old = _read(spark, folder, hours)
        both = old.unionByName(new).groupBy("hour", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
        write_parts(both.withColumn("part", F.col("hour")), folder, "filters", before.version + 1)
    commit(spark, folder, before, {"filters": hours}, run_id, batch_id, bits=bits)


def _read(spark: SparkSession, folder: str, hours: list[str]) -> DataFrame:
    schema = spark.createDataFrame([], _DDL).schema
    return read_parts(spark, folder, "filters", schema, read_snapshot(spark, folder), hours)


def judged_by_filter(keys: DataFrame, folder: str) -> DataFrame:
    """Rows with distinct keys, with ``_maybe``: whether the filters can't rule out that the key is stored."""
    spark = keys.sparkSession
    snapshot = read_snapshot(spark, folder)
    hours = [r.hour for r in keys.select(_hour()).distinct().collect()]
    asked = _positions(keys, snapshot.memory.get("bits", BITS))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte.cast("bigint"), (F.col("bit") % 8).cast("int"))
    hits = asked.join(_read(spark, folder, hours), ["hour", "chunk"]).filter(is_set == 1).groupBy(*PRICE_KEY).agg(F.count(F.lit(1)).alias("_bits"))
    found = hits.filter(F.col("_bits") == HASHES).select(*PRICE_KEY, F.lit(True).alias("_maybe"))
    return keys.join(found, PRICE_KEY, "left").withColumn("_maybe", F.coalesce("_maybe", F.lit(False)))


def not_stored_by_filter(batch: DataFrame, folder: str, history: Callable[[list[date]], DataFrame]) -> DataFrame:
    """Rows of ``batch`` (distinct keys) whose key the history lacks. ``history`` gives the stored rows of some days.

    It is called with the days of doubtful keys alone, and not at all if no key is doubtful.
    """
    judged = kept(judged_by_filter(batch, folder))
    sure, doubtful = (judged.filter(F.col("_maybe") == maybe).drop("_maybe") for maybe in (False, True))
    days = [r.date for r in doubtful.select(F.to_date("timestamp").alias("date")).distinct().collect()]
    return sure.unionByName(not_stored(doubtful, history(days))) if days else sure
