"""Where jobs keep what must outlive an executor."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Only a local session, as in tests, may do without the setting: its executors see
    the driver's own disk.
    """
    root = spark.conf.get(_SETTING, None)
    if root is None:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"{_SETTING} must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="run-")
        spark.conf.set(_SETTING, root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """``df`` worked out now and kept in the shared folder, whatever becomes of the executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession, "kept"))
    return df.checkpoint()


@contextmanager
def in_pieces(spark: SparkSession, size: str = "16m") -> Iterator[None]:
    """Rebalanced rows go to tasks in pieces of about ``size``, not Spark's own 64 MB: a task that sorts them takes ten times that."""
    before = spark.conf.get(_ADVISORY, None)
    spark.conf.set(_ADVISORY, size)
    try:
        yield
    finally:
        spark.conf.unset(_ADVISORY) if before is None else spark.conf.set(_ADVISORY, before)
