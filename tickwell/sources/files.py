"""Reading folders that a first run has yet to write."""

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def if_there(spark: SparkSession, read: Callable[[], DataFrame], schema: StructType | str) -> DataFrame:
    """What ``read`` yields, or no rows if its folder does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """The files and folders that match ``pattern``."""
    where, system = _hadoop(spark, pattern)
    return [str(status.getPath().toString()) for status in system.globStatus(where) or []]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a whole folder, if it is there."""
    where, system = _hadoop(spark, path)
    system.delete(where, True)
