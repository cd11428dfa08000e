"""Distinct symbols and price quantiles of any range of days from one small sketch per day, and their exact forms.

A day's sketches are made once, when its ticks come; batches of ticks are merged into the
days they touch, replays change nothing (``sources.versions``). A question about many days
merges their sketches and reads no tick.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwell.plans.slices import ranked
from tickwell.sources.versions import Snapshot, commit, read_parts, read_snapshot, write_parts

#: Size of a quantile sketch, and how far the rank of what it gives may be off (99% of the time less than half of it).
QUANTILE_SIZE, QUANTILE_ERROR = 800, 0.01
#: Size of a distinct-count sketch, as a power of two, and how far its count may be off, as a share (five standard errors).
DISTINCT_SIZE, DISTINCT_ERROR = 14, 0.04

PRICES = "date DATE, symbol STRING, sketch BINARY, n_priced BIGINT"
SYMBOLS = "date DATE, sketch BINARY"


def _priced(prices: DataFrame) -> DataFrame:
    return prices.filter(F.col("price").isNotNull() & ~F.isnan("price"))


def day_price_sketches(prices: DataFrame) -> DataFrame:
    """A quantile sketch per day and symbol. NULL and NaN are no prices."""
    daily = _priced(prices).groupBy(F.to_date("timestamp").alias("date"), "symbol")
    return daily.agg(F.kll_sketch_agg_double(F.col("price").cast("double"), QUANTILE_SIZE).alias("sketch"), F.count(F.lit(1)).alias("n_priced"))


def day_symbol_sketches(prices: DataFrame) -> DataFrame:
    """A sketch of the symbols of each day."""
    return prices.groupBy(F.to_date("timestamp").alias("date")).agg(F.hll_sketch_agg("symbol", DISTINCT_SIZE).alias("sketch"))


def _merged_prices() -> list[Column]:
    return [F.kll_merge_agg_double("sketch", QUANTILE_SIZE).alias("sketch"), F.sum("n_priced").alias("n_priced")]


def fold_sketches(prices: DataFrame, folder: str, run_id: str, batch_id: int) -> None:
    """Merge a batch of ticks into the sketches of its days; does nothing if they hold the batch. Ticks without a time are left out."""
    spark = prices.sparkSession
    before = read_snapshot(spark, folder)
    if before.holds(run_id, batch_id):
        return
    timed = prices.filter(F.col("timestamp").isNotNull())
    days = [str(r.date) for r in timed.select(F.to_date("timestamp").alias("date")).distinct().collect()]
    new = {"prices": (PRICES, day_price_sketches(timed), ["date", "symbol"], _merged_prices()), "symbols": (SYMBOLS, day_symbol_sketches(timed), ["date"], [F.hll_union_agg("sketch").alias("sketch")])}
    for name, (schema, sketches, keys, merge) in new.items():
        both = _read(spark, folder, name, schema, before, days).unionByName(sketches).groupBy(*keys).agg(*merge)
        write_parts(both.withColumn("part", F.col("date").cast("string")), folder, name, before.version + 1)
    # A day without a price has symbols only.
    priced = [str(r.date) for r in _priced(timed).select(F.to_date("timestamp").alias("date")).distinct().collect()]
    commit(spark, folder, before, {"prices": priced, "symbols": days}, run_id, batch_id)


def _read(spark: SparkSession, folder: str, name: str, schema: str, snapshot: Snapshot, days: list[str]) -> DataFrame:
    empty = spark.createDataFrame([], schema)
    return read_parts(spark, folder, name, empty.schema, snapshot, days)


def _between(snapshot: Snapshot, name: str, first: str, last: str) -> list[str]:
    return [day for day in snapshot.of(name) if first <= day <= last]


def quantiles_between(spark: SparkSession, folder: str, first: str, last: str, ranks: list[float]) -> DataFrame:
    """Estimated price per symbol and rank over the days ``first`` to ``last``: symbol, rank, price, n_priced."""
    snapshot = read_snapshot(spark, folder)
    days = _read(spark, folder, "prices", PRICES, snapshot, _between(snapshot, "prices", first, last))
    merged = days.groupBy("symbol").agg(*_merged_prices())
    each = [F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias("price")) for r in ranks]
    return merged.select("symbol", F.inline(F.array(*each)), "n_priced")


def symbols_between(spark: SparkSession, folder: str, first: str, last: str) -> DataFrame:
    """Estimated number of distinct symbols over the days ``first`` to ``last``: one row, n_symbols."""
    snapshot = read_snapshot(spark, folder)
    days = _read(spark, folder, "symbols", SYMBOLS, snapshot, _between(snapshot, "symbols", first, last))
    return days.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("n_symbols"))


def exact_quantiles(prices: DataFrame, ranks: list[float], slices: int | None = None) -> DataFrame:
    """Exact price per symbol and rank: the smallest price that this share of the symbol's prices is not above.

    Prices are numbered along each symbol by slices of the sorted table, so no task holds a symbol.
    """
    priced = _priced(prices).select("symbol", "price").filter(F.col("symbol").isNotNull())
    rows = priced.withColumn("_row", F.monotonically_increasing_id())
    counts = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_priced"))
    placed = ranked(rows, ["symbol"], ["price", "_row"], "_nth", counts, slices)
    wanted = [F.struct(F.lit(float(r)).alias("rank"), F.greatest(F.ceil(F.lit(float(r)) * F.col("n_priced")), F.lit(1)).alias("nth")) for r in ranks]
    hits = F.filter(F.array(*wanted), lambda w: w["nth"] == F.col("_nth"))
    return placed.select("symbol", "price", "n_priced", F.explode(hits).alias("w")).select("symbol", "w.rank", "price", "n_priced")


def rank_errors(estimates: DataFrame, prices: DataFrame) -> DataFrame:
    """``estimates`` (symbol, rank, price) with ``error``: how far the rank lies outside the shares of prices below, and not above, the estimate."""
    asked = estimates.select("symbol", "rank", F.col("price").alias("_estimate"))
    per_symbol = asked.groupBy("symbol").agg(F.collect_list(F.struct("rank", "_estimate")).alias("_asked"))
    both = _priced(prices).select("symbol", "price").join(per_symbol, "symbol")
    each = both.select("symbol", "price", F.explode("_asked").alias("a")).select("symbol", "price", "a.*")
    shares = each.groupBy("symbol", "rank").agg(F.avg((F.col("price") < F.col("_estimate")).cast("int")).alias("_below"), F.avg((F.col("price") <= F.col("_estimate")).cast("int")).alias("_upto"))
    off = F.greatest(F.col("_below") - F.col("rank"), F.col("rank") - F.col("_upto"), F.lit(0.0))
    return estimates.join(shares.select("symbol", "rank", off.alias("error")), ["symbol", "rank"])
