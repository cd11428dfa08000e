"""Which batches of a run are complete: one marker for all the tables that a batch writes.

A run opens a log beside the history before its first batch and marks each batch when all
its writes are done. Readers of the history, and of any table that points to the log, see
the batches of an open run up to its last mark; a run that has no log is seen whole. As the
batches of a run come in order, its last mark says it all: earlier ones go.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.sources.files import delete, if_there

_LOG, _POINTER = "_commits", "_commits_at"
_DDL = "run_id STRING, batch_id BIGINT, n BIGINT"


def open_run(spark: SparkSession, path: str, run_id: str, *others: str) -> None:
    """Begin a run that writes the table at ``path`` and ``others``; nothing of it is seen until it commits."""
    for other in others:
        if if_there(spark, lambda: spark.read.text(f"{other}/{_POINTER}"), "value STRING").isEmpty():
            spark.createDataFrame([(path,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{other}/{_POINTER}")
    if _log(spark, path).filter(F.col("run_id") == run_id).isEmpty():
        _mark(spark, path, run_id, -1)


def commit_batch(spark: SparkSession, path: str, run_id: str, batch_id: int) -> None:
    """Make a batch of an open run visible, in all its tables at once."""
    _mark(spark, path, run_id, batch_id)
    for earlier in (batch_id - 2, -1) if batch_id > 0 else ():
        delete(spark, f"{path}/{_LOG}/run_id={run_id}/batch_id={earlier}")


def _mark(spark: SparkSession, path: str, run_id: str, batch_id: int) -> None:
    spark.range(1).select(F.lit(1).cast("bigint").alias("n")).coalesce(1).write.mode("overwrite").parquet(f"{path}/{_LOG}/run_id={run_id}/batch_id={batch_id}")


def _log(spark: SparkSession, path: str) -> DataFrame:
    log = f"{path}/{_LOG}"
    return if_there(spark, lambda: spark.read.schema(_DDL).option("basePath", log).parquet(f"{log}/run_id=*/batch_id=*"), _DDL)


def committed(df: DataFrame, path: str) -> DataFrame:
    """``df`` (with ``run_id`` and ``batch_id``) without batches that the log at ``path`` has not marked yet.

    A log has a row or two per run, so it goes to all tasks.
    """
    spark = df.sparkSession
    upto = {r.run_id: r.upto for r in _log(spark, path).groupBy("run_id").agg(F.max("batch_id").alias("upto")).collect()}
    for run_id, batch_id in upto.items():
        df = df.filter((F.col("run_id") != run_id) | (F.col("batch_id") <= batch_id))
    return df


def log_of(spark: SparkSession, other: str) -> str | None:
    """The table whose log says which batches of the table at ``other`` are complete, if one does."""
    first = if_there(spark, lambda: spark.read.text(f"{other}/{_POINTER}"), "value STRING").first()
    return None if first is None else first.value
