"""Continuous ingestion: topic to history and rejects, the same rows however often a batch is replayed."""

import json
import logging
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickwell.functions.clock import moment
from tickwell.operators.validate import accepted, judge
from tickwell.plans.ingest import Settled, first_prices, left_over, on_clock, settle_by_arrival
from tickwell.sources.buckets import append_bucketed, not_stored_by_bucket
from tickwell.sources.commits import commit_batch, open_run
from tickwell.sources.filters import add_keys, not_stored_by_filter
from tickwell.sources.table import read_batch, read_history, write_history, write_rejects
from tickwell.streaming.report import ARRIVED, Report, arrivals

log = logging.getLogger(__name__)


def start_ingest(
    records: DataFrame,
    history: str,
    rejects: str,
    checkpoint: str,
    clock: str | None = None,
    legacy: bool = False,
    on_malformed: str = "quarantine",
    seconds: int | None = None,
    also: Callable[[DataFrame, int], None] | None = None,
    report: Callable[[Report], None] | None = None,
    filters: str | None = None,
    buckets: str | None = None,
) -> StreamingQuery:
    """Start ingestion of a record stream.

    Without ``clock``, prices are stamped on arrival; with it, they are keyed by that
    column. Without ``seconds``, the query takes what is there and ends. ``also`` gets
    each batch's stored prices, for a further sink. One query at a time may write to a
    history; within it, all topic partitions are read in parallel.

    The stream's progress is kept in ``checkpoint``; history partitions carry the id of
    that checkpoint and the batch number, so a replayed batch replaces itself. History and
    rejects of a batch become visible together, by one mark that is written last.

    With ``filters``, a folder of key filters beside the history, keys that a batch brings
    for the first time are known as such without a look at the history. They must cover
    it: fill them with ``sources.filters.add_keys`` if the history is older. With ``buckets``,
    a table of ``sources.buckets.create_keys``, repeated keys are found there and the history
    itself stays unread; the table must cover it likewise. Both need ``clock``.

    Each batch is reported to the log and to ``report``, by counts that the tasks which
    write it keep on the way. What arrived is observed as well: a listener finds it under
    ``streaming.report.ARRIVED``.
    """
    if (filters or buckets) and clock is None:
        raise ValueError("only rows with a time of their own can repeat a key: name its column as clock")
    if filters and buckets:
        raise ValueError("give filters or buckets, not both")
    judging = judge(records.withColumn("_arrived", F.current_timestamp()), legacy=legacy, on_malformed=on_malformed)
    arriving = judging.observe(ARRIVED, *arrivals())

    stamps = _Stamps()
    opened: set[str] = set()

    def settle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = run_id_of(spark, checkpoint)
        if run_id not in opened:
            open_run(spark, history, run_id, rejects)
            opened.add(run_id)
        judged = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)

            def stored_on(days: list[date] | None = None) -> DataFrame:
                return read_history(spark, history, days).filter(~own)

            if clock is None:
                # Stamps need the batch's clock and size beforehand.
                counts = _counts(judged)
                if not counts:
                    return
                settled = _by_arrival(judged, counts, stamps, stored_on)
                stored = write_history(settled.prices, history, run_id, batch_id)
                left = write_rejects(settled.rejects, rejects, run_id, batch_id)
            else:
                timed = on_clock(judged, clock)
                if filters is not None:
                    new = not_stored_by_filter(first_prices(timed), filters, stored_on)
                elif buckets is not None:
                    new = not_stored_by_bucket(first_prices(timed), buckets, run_id, batch_id)
                else:
                    new = first_prices(timed, _on_days_of(timed, stored_on()))
                stored = write_history(new, history, run_id, batch_id)
                if filters is not None:
                    add_keys(read_batch(spark, history, run_id, batch_id), filters, run_id, batch_id)
                if buckets is not None:
                    append_bucketed(read_batch(spark, history, run_id, batch_id), buckets, run_id, batch_id)
                left = write_rejects(left_over(timed, read_batch(spark, history, run_id, batch_id)), rejects, run_id, batch_id)
            if also is not None:
                also(read_batch(spark, history, run_id, batch_id), batch_id)
            commit_batch(spark, history, run_id, batch_id)
            told = Report(run_id, batch_id, stored, left)
            log.info("%s", told)
            if report is not None:
                report(told)
        finally:
            judged.unpersist()

    writer = arriving.writeStream.option("checkpointLocation", checkpoint).foreachBatch(settle)
    if seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{seconds} seconds").start()


class _Stamps:
    """No stamp given so far is past ``reached``; not known before the first batch of a run."""

    reached: datetime | None = None


def _counts(judged: DataFrame) -> list[Row]:
    """One row per reason, NULL for what is accepted, with the batch's clock."""
    clock = F.min(F.col("_arrived").cast("timestamp_ntz")).alias("clock")
    return judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), clock).collect()


def _by_arrival(
    judged: DataFrame, counts: list[Row], stamps: _Stamps, stored_on: Callable[[list[date]], DataFrame]
) -> Settled:
    """The history is read only if an earlier batch may have stamped ahead of this one's clock: it had more
    records of a symbol than microseconds passed, or it ran before a restart."""
    clock = min(r.clock for r in counts)
    latest = None
    if stamps.reached is None or stamps.reached >= clock:
        day = clock.date()
        ahead = stored_on([day, day + timedelta(days=1)]).filter(F.col("timestamp") >= moment(clock))
        latest = ahead.groupBy("symbol").agg(F.max("timestamp").alias("last"))
        stamps.reached = max(clock, latest.agg(F.max("last")).first()[0] or clock)
    stamps.reached = max(stamps.reached, clock) + timedelta(microseconds=sum(r.n for r in counts))
    return settle_by_arrival(judged, F.col("_arrived"), latest)


def _on_days_of(timed: DataFrame, history: DataFrame) -> DataFrame:
    """The history on the days that the batch's own times fall on.

    Producers' clocks bound neither their number nor their span, so the days stay a
    table; only the first and the last, as texts, come to the driver, to prune by.
    """
    days = accepted(timed).select(F.to_date("timestamp").alias("date")).distinct()
    span = days.agg(F.min("date").cast("string").alias("first"), F.max("date").cast("string").alias("last")).first()
    between = F.col("date").between(F.lit(span["first"]).cast("date"), F.lit(span["last"]).cast("date"))
    return history.filter(between).join(days, "date", "left_semi")


def run_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gives a checkpoint when it is first used; a new checkpoint never repeats an old one's."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]
