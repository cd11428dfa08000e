"""Periodic emission: every so often the last price of every symbol goes to the topic."""

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.functions.codec import encode_tick
from tickwell.operators.sample import latest_quote
from tickwell.schema import POLL_SECONDS, TOPIC, TOPIC_RECORD
from tickwell.sources.files import if_there
from tickwell.sources.topic import CREATE_TIME, read_topic, to_messages, topic_ends
from tickwell.streaming.ingest import run_id_of


log = logging.getLogger(__name__)

#: Parts of a topic partition that are numbered apart.
PARTS = 256
_ENDS = "partition INT, end BIGINT"


def start_poller(
    ticks: DataFrame,
    path: str,
    checkpoint: str,
    seconds: int | None = POLL_SECONDS,
    partitions: int = 4,
    echo: bool = False,
    tie: str | None = None,
) -> StreamingQuery:
    """Append every symbol's last price to the file topic at ``path`` each ``seconds``, whether or not there are new
    ticks; ``None`` takes what is there, once.

    The stream keeps one row per symbol. Each batch goes to a folder of its own, which a
    replay writes anew; as with any producer that is cut off, a reader may see it twice.
    The topic's new ends are written beside it, where the next batch finds them; so
    nothing else may write to the topic while a poller does. ``echo`` logs of each batch
    how many records it sent and the folder from which every one of them can be read.
    """

    def send(quotes: DataFrame, batch_id: int) -> None:
        spark = quotes.sparkSession
        run_id = run_id_of(spark, checkpoint)
        folder = f"{path.rstrip('/')}/{run_id}-{batch_id}"
        messages = to_messages(quotes.filter(F.col("symbol").isNotNull()), encode_tick(F.col("price"), F.col("symbol")))
        ends = _ends_before(spark, path, run_id, batch_id)
        records = _placed(messages, ends, partitions)
        records.select(*TOPIC_RECORD.names).write.mode("overwrite").parquet(folder)
        sent = spark.read.schema(TOPIC_RECORD).parquet(folder)
        # A partition without messages in this batch keeps its end.
        after = topic_ends(sent).unionByName(ends).groupBy("partition").agg(F.max("end").alias("end"))
        after.write.mode("overwrite").parquet(_ends_folder(path, run_id, batch_id))
        if echo:
            log.info("batch %d: %d records in %s", batch_id, sent.count(), folder)

    if seconds is not None:
        ticks = _with_clock(ticks)
    writer = (
        latest_quote(ticks, tie).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(send)
    )
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


def _with_clock(ticks: DataFrame) -> DataFrame:
    """Ticks and, each second, a row without a symbol, so that no interval is without a batch."""
    beat = ticks.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.unionByName(beat.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in ticks.schema.fields]))


def _ends_folder(path: str, run_id: str, batch_id: int) -> str:
    # Readers of the topic pass over folders with an underscore in front.
    return f"{path.rstrip('/')}/_ends/{run_id}-{batch_id}"


def _ends_before(spark: SparkSession, path: str, run_id: str, batch_id: int) -> DataFrame:
    """The topic's ends before a batch: as the batch before left them, or, for the first, as the topic itself shows."""
    if batch_id == 0:
        own = F.input_file_name().contains(f"/{run_id}-0/")
        return topic_ends(read_topic(spark, path).filter(~own))
    return if_there(spark, lambda: spark.read.schema(_ENDS).parquet(_ends_folder(path, run_id, batch_id - 1)), _ENDS)


def _placed(messages: DataFrame, ends: DataFrame, partitions: int) -> DataFrame:
    """Messages with their partition and offset. Each partition is numbered in ``PARTS`` parts, by symbol in each."""
    dealt = messages.withColumns(
        {
            "partition": F.pmod(F.xxhash64("symbol"), F.lit(partitions)).cast("int"),
            "_part": F.pmod(F.xxhash64("symbol", F.lit(1)), F.lit(PARTS)).cast("int"),
        }
    )
    earlier = Window.partitionBy("partition").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy("partition", "_part").agg(F.count(F.lit(1)).alias("_n"))
    bases = parts.withColumn("_base", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(ends, "partition", "left")
    nth = F.row_number().over(Window.partitionBy("partition", "_part").orderBy("symbol"))
    return (
        dealt.withColumn("_nth", nth)
        .join(bases, ["partition", "_part"])
        .withColumns(
            {
                "topic": F.lit(TOPIC),
                "offset": (F.coalesce("end", F.lit(0)) + F.col("_base") + F.col("_nth") - 1).cast("bigint"),
                "timestamp": F.current_timestamp(),
                "timestampType": F.lit(CREATE_TIME),
            }
        )
    )
