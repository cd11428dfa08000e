"""Tables kept up to date by batches: each batch writes new versions of the partitions it touches, a snapshot last.

A partition's version is a folder of its own and never changes once a snapshot names it.
A snapshot names the current version of every partition of every table in the folder, the
last batch of each run and what else the writer must remember; it is one small file, the
last that a batch writes. Until then readers see the state before the batch; a batch that is
replayed writes the same version again, and one that a snapshot names is not done twice.
One writer at a time.
"""

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickwell.sources.files import delete, if_there, listed

_SNAPSHOT = "kind STRING, name STRING, part STRING, at BIGINT"
_FOLDER = "_snapshots"


@dataclass(frozen=True)
class Snapshot:
    """``parts``: version by (table, partition). ``runs``: last batch by run. ``memory``: a number by name."""

    version: int = -1
    parts: dict[tuple[str, str], int] = field(default_factory=dict)
    runs: dict[str, int] = field(default_factory=dict)
    memory: dict[str, int] = field(default_factory=dict)

    def holds(self, run_id: str, batch_id: int) -> bool:
        return self.runs.get(run_id, -1) >= batch_id

    def of(self, name: str) -> dict[str, int]:
        return {part: at for (table, part), at in self.parts.items() if table == name}


def _snapshots(spark: SparkSession, folder: str) -> DataFrame:
    ddl = f"{_SNAPSHOT}, version BIGINT"
    path = f"{folder}/{_FOLDER}"
    return if_there(spark, lambda: spark.read.schema(ddl).option("basePath", path).parquet(f"{path}/version=*"), ddl)


def read_snapshot(spark: SparkSession, folder: str) -> Snapshot:
    """The last snapshot, or an empty one. It has a row per partition and run, not per batch."""
    all_ = _snapshots(spark, folder)
    last = all_.agg(F.max("version")).first()[0]
    if last is None:
        return Snapshot()
    kinds = {"part": {}, "run": {}, "memory": {}}
    for row in all_.filter(F.col("version") == last).collect():
        kinds[row.kind][(row.name, row.part) if row.kind == "part" else row.name] = row.at
    return Snapshot(last, kinds["part"], kinds["run"], kinds["memory"])


def commit(spark: SparkSession, folder: str, before: Snapshot, written: dict[str, list[str]], run_id: str, batch_id: int, **memory: int) -> Snapshot:
    """Make what was written as the version after ``before`` the current one: partitions by table."""
    version = before.version + 1
    now = replace(
        before,
        version=version,
        parts=before.parts | {(name, part): version for name, parts in written.items() for part in parts},
        runs=before.runs | {run_id: batch_id},
        memory=before.memory | memory,
    )
    rows = [("part", name, part, at) for (name, part), at in now.parts.items()]
    rows += [("run", run, None, at) for run, at in now.runs.items()] + [("memory", name, None, at) for name, at in now.memory.items()]
    spark.createDataFrame(rows, _SNAPSHOT).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_FOLDER}/version={version}")
    delete(spark, f"{folder}/{_FOLDER}/version={version - 2}")
    return now


def write_parts(df: DataFrame, folder: str, name: str, version: int) -> None:
    """Write ``df`` as ``version`` of the partitions of table ``name`` that its column ``part`` (text) names."""
    _write(df.withColumn("version", F.lit(version).cast("bigint")).hint("rebalance", "part"), f"{folder}/{name}", ["part", "version"])


def write_rows(df: DataFrame, folder: str, name: str, version: int) -> None:
    """Write ``df`` as the rows that ``version`` adds to table ``name``; nothing if there are none."""
    _write(df.withColumn("version", F.lit(version).cast("bigint")), f"{folder}/{name}", ["version"])


def _write(df: DataFrame, path: str, folders: list[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(path)


def read_rows(spark: SparkSession, folder: str, name: str, schema: StructType, snapshot: Snapshot) -> DataFrame:
    """Rows of table ``name`` that versions up to the snapshot's added."""
    path = f"{folder}/{name}"
    whole = StructType([*schema, *StructType.fromDDL("version BIGINT")])
    rows = if_there(spark, lambda: spark.read.schema(whole).option("basePath", path).parquet(f"{path}/version=*"), whole)
    return rows.filter(F.col("version") <= snapshot.version).drop("version")


def read_parts(spark: SparkSession, folder: str, name: str, schema: StructType, snapshot: Snapshot, parts: list[str] | None = None) -> DataFrame:
    """The current rows of table ``name``; of some partitions if named. Folders of no interest are not even listed."""
    current = snapshot.of(name)
    paths = [f"{folder}/{name}/part={p}/version={current[p]}" for p in (current if parts is None else parts) if p in current]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def drop_versions(spark: SparkSession, folder: str, name: str) -> None:
    """Delete versions of table ``name`` that neither the last snapshot nor the one before it names.

    Call it when no reader is at work that began before the last batch. What is deleted is
    gone from the folder, so a call costs what has come since the one before.
    """
    last = read_snapshot(spark, folder)
    named = _snapshots(spark, folder).filter((F.col("version") >= last.version - 1) & (F.col("kind") == "part") & (F.col("name") == name))
    keep = {(r.part, r.at) for r in named.select("part", "at").distinct().collect()}
    for path in listed(spark, f"{folder}/{name}/part=*/version=*"):
        part, version = path.split("/")[-2].removeprefix("part="), int(path.split("/")[-1].removeprefix("version="))
        if version <= last.version and (part, version) not in keep:
            delete(spark, path)
