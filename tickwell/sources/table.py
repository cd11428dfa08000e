"""The price table: catalog table, replay-safe file history, and database options."""

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime
from itertools import pairwise

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tickwell.functions.clock import moment
from tickwell.operators.keys import first_by_key, not_stored
from tickwell.schema import LINEAGE, PRICE_COLUMNS, PRICE_KEY, REASONS, REJECT_COLUMNS, TABLE, price_columns_ddl
from tickwell.sources.commits import committed, log_of
from tickwell.sources.files import delete, if_there, listed
from tickwell.sources.scratch import in_pieces, kept

# --- catalog table --------------------------------------------------------


def create_price_table(spark: SparkSession, name: str = TABLE, reset: bool = False) -> None:
    """Create the table unless it is there; ``reset`` drops it first.

    After a reset start ingestion from a new checkpoint as well, or the table lacks
    what the old one had already read.
    """
    if reset:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({price_columns_ddl()}) USING parquet", args={"name": name})


def append_prices(prices: DataFrame, name: str = TABLE, order: list[str] | None = None) -> DataFrame:
    """Append the prices whose key is new to the table, and return the others with their ``reason``.

    A row without a symbol or a time has no key (``null_key``). Of rows with one key the
    first by ``order`` is taken, and none if the table holds the key; the others are
    ``duplicate_key``. Both are settled on the rows as they are at the call.

    Of the table only the time range of these rows is read; rows are stored in the order
    of their time, so that files and row groups outside it are passed over.
    """
    stored = prices.sparkSession.table(name)
    # Equal rows are told apart by where they are.
    rows = kept(prices.withColumn("_row", F.monotonically_increasing_id()))
    keyed = rows.dropna(subset=PRICE_KEY)
    new = kept(only_missing(first_by_key(keyed, order=[*(order or ["price", "company", "market"]), "_row"]), stored))
    in_order = new.select(*PRICE_COLUMNS).repartitionByRange("timestamp", "symbol").sortWithinPartitions("timestamp", "symbol")
    in_order.write.mode("append").insertInto(name)
    reason = F.when(F.col("symbol").isNull() | F.col("timestamp").isNull(), "null_key").otherwise("duplicate_key")
    return rows.join(new.select("_row"), "_row", "left_anti").drop("_row").withColumn("reason", reason)


# --- file history ---------------------------------------------------------


def write_history(prices: DataFrame, path: str, run_id: str, batch_id: int) -> int:
    """Store one batch under its date, run and number; the number of its rows. Writing it again replaces it.

    A day goes to one task, or to several if it is large, so that a batch over many
    days leaves few files; these are sorted for reads of one symbol or time range.
    """
    dated = prices.select(*PRICE_COLUMNS, *LINEAGE, F.to_date("timestamp").alias("date"))
    counts = {"stored": F.count(F.lit(1))}
    return _write_batch(dated.hint("rebalance", "date"), path, run_id, batch_id, ["date"], ["symbol", "timestamp"], counts)["stored"]


def write_rejects(rejects: DataFrame, path: str, run_id: str, batch_id: int) -> dict[str, int]:
    """Store a batch's rejects; how many there are of each reason."""
    counts = {reason: F.count_if(F.col("reason") == reason) for reason in REASONS}
    counts["other"] = F.count_if(~F.coalesce(F.col("reason").isin(*REASONS), F.lit(False)))
    found = _write_batch(rejects.select(*REJECT_COLUMNS).hint("rebalance"), path, run_id, batch_id, [], [], counts)
    return {reason: n for reason, n in found.items() if n}


def _write_batch(df: DataFrame, path: str, run_id: str, batch_id: int, lead: list[str], sort: list[str], counts: dict[str, Column]) -> dict[str, int]:
    """Write a batch; ``counts`` are worked out on the way, by the tasks that write."""
    folders = [*lead, "run_id", "batch_id"]
    seen = Observation()
    with in_pieces(df.sparkSession):
        (
            df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
            .observe(seen, *[c.alias(name) for name, c in counts.items()])
            .sortWithinPartitions(*folders, *sort)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders)
            .parquet(path)
        )
    found = seen.get
    return {name: found.get(name, 0) for name in counts}


_LINEAGE_DDL = "topic STRING, partition INT, offset BIGINT"
_BATCH_DDL = "run_id STRING, batch_id BIGINT"
HISTORY_DDL = (
    f"symbol STRING, price DOUBLE, timestamp TIMESTAMP_NTZ, company STRING, market STRING, "
    f"{_LINEAGE_DDL}, date DATE, {_BATCH_DDL}"
)
BATCH = ["date", "run_id", "batch_id"]
REJECTS_DDL = f"{_LINEAGE_DDL}, value BINARY, reason STRING, {_BATCH_DDL}"


def read_history(spark: SparkSession, path: str, days: Iterable[date] | None = None) -> DataFrame:
    """Stored prices of complete batches. With ``days``, the folders of other days are not even listed.

    What ``compact_history`` merged is read from where it was merged to, also while its
    batches' own folders are still there or come again with a replay.
    """
    names = None if days is None else sorted(d.isoformat() for d in days)
    apart = _apart(spark, path, names)
    if _last_list(spark, path) < 0:
        return apart
    merged = spark.read.schema(f"{HISTORY_DDL}, merge_id STRING").parquet(f"{path}/_merged")
    if names is not None:
        merged = merged.filter(F.col("date").isin(names))
    whole = merged.join(_merged_batches(spark, path).select("merge_id").distinct(), "merge_id", "left_semi")
    return apart.unionByName(whole.select(*apart.columns))


def read_batch(spark: SparkSession, path: str, run_id: str, batch_id: int) -> DataFrame:
    """The stored prices of one batch, on whatever days."""
    return _read(spark, path, f"{path}/date=*/run_id={run_id}/batch_id={batch_id}", HISTORY_DDL)


def compact_history(spark: SparkSession, path: str, before: date) -> None:
    """Merge the batches of the days before ``before`` into few files per day, sorted by symbol and time.

    The list of merged batches is written last. Until then nothing is merged; from then
    on a merged batch counts once, wherever else it lies, so a replay adds nothing. Its
    own folders may go: ``drop_merged``. Batches that come later to a merged day stay
    apart until the next call. One call at a time; ingestion may go on meanwhile, as it
    replays its last batch only, and that replay writes the same rows.
    """
    merge_id = uuid.uuid4().hex
    open_ = _apart(spark, path, None).filter(F.col("date") < F.lit(before.isoformat()).cast("date"))
    batches = kept(open_.select(*BATCH).distinct())
    rows = open_.join(batches, BATCH, "left_semi").withColumn("merge_id", F.lit(merge_id))
    sorted_ = rows.hint("rebalance", "date").sortWithinPartitions("date", "symbol", "timestamp")
    with in_pieces(spark):
        sorted_.write.mode("append").partitionBy("merge_id", "date").parquet(f"{path}/_merged")
    number = _last_list(spark, path) + 1
    now = _merged_batches(spark, path).unionByName(_in_ranges(batches).withColumn("merge_id", F.lit(merge_id)))
    # One file: readers see the list before the merge or the one after it.
    now.coalesce(1).write.mode("overwrite").parquet(f"{path}/_merged_batches/list={number}")
    delete(spark, f"{path}/_merged_batches/list={number - 2}")


def _in_ranges(batches: DataFrame) -> DataFrame:
    """Batches of each day and run as ranges of consecutive numbers, most often one: date, run_id, first, last."""
    along = Window.partitionBy("date", "run_id").orderBy("batch_id")
    ranges = batches.withColumn("_range", F.col("batch_id") - F.row_number().over(along)).groupBy("date", "run_id", "_range")
    return ranges.agg(F.min("batch_id").alias("first"), F.max("batch_id").alias("last")).drop("_range")


def drop_merged(spark: SparkSession, path: str) -> None:
    """Delete the folders of merged batches. Call it when no reader from before the merge is at work.

    Goes by the folders that are there, so a call costs what has come since the one before.
    """
    merged: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for row in _merged_batches(spark, path).toLocalIterator():
        merged.setdefault((str(row.date), row.run_id), []).append((row.first, row.last))
    for folder in listed(spark, f"{path}/date=*/run_id=*/batch_id=*"):
        day, run_id, batch = (part.split("=", 1)[1] for part in folder.rsplit("/", 3)[1:])
        if any(first <= int(batch) <= last for first, last in merged.get((day, run_id), ())):
            delete(spark, folder)


_MERGED_DDL = "date DATE, run_id STRING, first BIGINT, last BIGINT, merge_id STRING"


def _lists(spark: SparkSession, path: str) -> DataFrame:
    root, ddl = f"{path}/_merged_batches", f"{_MERGED_DDL}, list BIGINT"
    return if_there(spark, lambda: spark.read.schema(ddl).option("basePath", root).parquet(f"{root}/list=*"), ddl)


def _last_list(spark: SparkSession, path: str) -> int:
    return _lists(spark, path).agg(F.coalesce(F.max("list"), F.lit(-1))).first()[0]


def _merged_batches(spark: SparkSession, path: str) -> DataFrame:
    """Merged batches, as few rows per day and run."""
    return _lists(spark, path).filter(F.col("list") == _last_list(spark, path)).drop("list")


def _apart(spark: SparkSession, path: str, names: list[str] | None) -> DataFrame:
    """Complete batches that were not merged, of some days if named."""
    all_ = committed(_read(spark, path, path if names is None else _either(f"{path}/date=", names), HISTORY_DDL), path)
    if _last_list(spark, path) < 0:
        return all_
    done = _merged_batches(spark, path)
    within = all_["batch_id"].between(done["first"], done["last"])
    return all_.join(done, (all_["date"] == done["date"]) & (all_["run_id"] == done["run_id"]) & within, "left_anti")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Stored rejects of complete batches."""
    rejects, log = _read(spark, path, path, REJECTS_DDL), log_of(spark, path)
    return rejects if log is None else committed(rejects, log)


def _read(spark: SparkSession, path: str, where: str, ddl: str) -> DataFrame:
    reader = spark.read.schema(ddl).option("basePath", path)
    return if_there(spark, lambda: reader.parquet(where), ddl)


def _either(prefix: str, names: list[str]) -> str:
    return f"{prefix}{names[0]}" if len(names) == 1 else f"{prefix}{{{','.join(names)}}}"


# --- database -------------------------------------------------------------


def jdbc_options(url: str, user: str, password: str, table: str = TABLE, batch_rows: int = 10_000) -> dict[str, str]:
    """Options for ``format("jdbc")``. Writes go out in batches, not one transaction per row."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "batchsize": str(batch_rows),
        "fetchsize": str(batch_rows),
    }


def time_predicates(bounds: list[datetime]) -> list[str]:
    """Conditions that part the rows by time: before the first bound or without a time, between bounds, from the last on."""
    if not bounds:
        return ["1 = 1"]
    texts = [f"TIMESTAMP '{b.isoformat(sep=' ')}'" for b in sorted(bounds)]
    between = [f"timestamp >= {a} AND timestamp < {b}" for a, b in pairwise(texts)]
    return [f"timestamp < {texts[0]} OR timestamp IS NULL", *between, f"timestamp >= {texts[-1]}"]


def read_jdbc(spark: SparkSession, options: dict[str, str], bounds: list[datetime] | None = None) -> DataFrame:
    """Prices in a database; filters and column lists run there.

    With ``bounds`` the ranges of time between them are read by a task and connection each.
    """
    if bounds is None:
        return spark.read.format("jdbc").options(**options).load()
    own = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=time_predicates(bounds), properties=own)


def jdbc_sink(options: dict[str, str], connections: int = 16) -> Callable[[DataFrame, int], None]:
    """A further sink for ``start_ingest``: a replayed batch adds only the rows that did not get through."""

    def store(prices: DataFrame, batch_id: int) -> None:
        append_jdbc(only_missing(prices, read_jdbc(prices.sparkSession, options)), options, connections)

    return store


def only_missing(prices: DataFrame, stored: DataFrame) -> DataFrame:
    """Prices whose key ``stored`` lacks; of ``stored`` only the batch's own time range is read."""
    span = prices.agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).first()
    if span["first"] is None:
        return prices
    return not_stored(prices, stored.filter(F.col("timestamp").between(moment(span["first"]), moment(span["last"]))))


def append_jdbc(prices: DataFrame, options: dict[str, str], connections: int = 16) -> None:
    """Append checked rows to a database table over a bounded number of connections.

    Enforce the key before: one row that breaks it fails its task's whole batch.
    """
    prices.select(*PRICE_COLUMNS).coalesce(connections).write.format("jdbc").options(**options).mode("append").save()
