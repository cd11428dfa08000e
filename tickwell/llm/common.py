"""What the corpus operators share: reading, keeping intermediate rows, names, splits."""

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.sources.scratch import shared_folder


_SHIPPED: set[str] = set()


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Makes this package known to Python workers wherever they start; Spark's driver serves the archive to them.

    Texts go to them a thousand at a time, unless the session asks for another number than
    Spark's own ten thousand, which is much for long texts.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, "1000")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='run-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """``df`` worked out once, written below ``spark.checkpoint.dir`` and read again.

    Lineage ends there: a lost executor costs the reading of files that all can reach.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def fold(folds: int, left_out: int, column: str = "doc_id") -> Column:
    """Whether a row is held out: crc32 of the id's text leaves ``left_out``. A null id is held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == left_out, F.lit(True))


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of each position in starts[i]..ends[i]-1, owner by owner."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def utf8(batch_column) -> list[bytes]:
    """Texts of an Arrow column as UTF-8, null as empty."""
    return [b or b"" for b in batch_column.cast("binary").to_pylist()]


def batches_of(lists: Iterator, names: list[str], types: list):
    """Arrow batches from an iterator of tuples of sequences."""
    import pyarrow as pa

    for columns in lists:
        if len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names)
