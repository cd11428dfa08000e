"""Questions asked of the price table: price over time, trend, tick volume, latest price."""

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.clock import arrival_order, moment
from tickwell.operators.sample import latest_quote
from tickwell.plans.slices import last_items, rows_before_slice, sliced


def price_series(
    prices: DataFrame,
    symbols: list[str] | None = None,
    since: datetime | str | None = None,
    until: datetime | str | None = None,
) -> DataFrame:
    """Price over time, ordered; for some symbols and a half-open time range if given."""
    picked = prices
    if symbols is not None:
        picked = picked.filter(F.col("symbol").isin(symbols))
    if since is not None:
        picked = picked.filter(F.col("timestamp") >= moment(since))
    if until is not None:
        picked = picked.filter(F.col("timestamp") < moment(until))
    return picked.select("symbol", "timestamp", "price").orderBy("symbol", "timestamp")


def price_trend(prices: DataFrame, bucket: str = "1 hour", tie: str | None = None) -> DataFrame:
    """Open, high, low, close and average price per symbol and time bucket.

    Pre-aggregated per task, so a hot symbol or bucket sends one row per task.
    """
    order = arrival_order(prices, tie)
    return (
        _bucketed(prices, bucket)
        .groupBy("bucket", "symbol")
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.avg("price").alias("avg_price"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
        .select("symbol", "bucket", "open", "high", "low", "close", "avg_price", "n_ticks")
    )


def tick_volume(prices: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Ticks per symbol and time bucket. Messages carry no traded volume."""
    counted = _bucketed(prices, bucket).groupBy("bucket", "symbol").agg(F.count(F.lit(1)).alias("n_ticks"))
    return counted.select("symbol", "bucket", "n_ticks")


def _bucketed(prices: DataFrame, bucket: str) -> DataFrame:
    # The bucket's start leads the grouping: where Spark sorts to aggregate, it sorts by one number first.
    return prices.withColumn("bucket", F.window("timestamp", bucket).getField("start"))


def latest_price(prices: DataFrame, tie: str | None = None) -> DataFrame:
    """Last known price per symbol."""
    return latest_quote(prices, tie)


def price_momentum(
    prices: DataFrame, ticks: int = 20, tie: str | None = None, slices: int | None = None
) -> DataFrame:
    """Moving average over the last ``ticks`` prices, and change from the previous one (our reading of "trend").

    Windows run per slice of a symbol; the first rows of a slice take the rest of
    their window from the slices before.
    """
    order = ["timestamp", *([tie] if tie else [])]
    columns = ["symbol", "price", *order]
    cut = sliced(prices.select(*columns), ["symbol"], order, slices)
    before = rows_before_slice(cut, "symbol", order, "price", max(ticks - 1, 1))

    here = Window.partitionBy("symbol", "_slice").orderBy(*order)
    span = here.rowsBetween(-(ticks - 1), 0)
    windowed = cut.withColumns(
        {
            "_at": F.row_number().over(here),
            "_sum": F.sum("price").over(span),
            "_n": F.count("price").over(span),
            "_previous": F.lag("price").over(here),
        }
    ).join(before, ["symbol", "_slice"], "left")

    missing = F.greatest(F.lit(ticks) - F.col("_at"), F.lit(0))
    carried = F.when(missing > 0, F.filter(last_items(F.col("_before"), missing), lambda p: p.isNotNull()))
    carried_sum = F.coalesce(F.aggregate(carried, F.lit(0.0), lambda a, p: a + p), F.lit(0.0))
    carried_n = F.coalesce(F.when(carried.isNotNull(), F.size(carried)), F.lit(0))
    total, n = F.coalesce(F.col("_sum"), F.lit(0.0)) + carried_sum, F.col("_n") + carried_n
    previous = F.when(
        F.col("_at") == 1, F.get(F.col("_before"), F.size("_before") - 1)
    ).otherwise(F.col("_previous"))
    return windowed.select(
        *columns,
        F.when(n > 0, total / n).alias("moving_avg"),
        (F.col("price") - previous).alias("change"),
    )


def market_summary(prices: DataFrame) -> DataFrame:
    """Ticks, average price and number of symbols per market (our reading of what the columns are for)."""
    per_symbol = prices.groupBy("market", "symbol").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("price").alias("_sum"), F.count("price").alias("_priced")
    )
    return per_symbol.groupBy("market").agg(
        F.sum("_n").alias("n_ticks"),
        (F.sum("_sum") / F.sum("_priced")).alias("avg_price"),
        F.count("symbol").alias("n_symbols"),
    )


def market_rollup(prices: DataFrame) -> DataFrame:
    """Ticks and average price per market and symbol, per market, and in all (ours, like ``market_summary``).

    Totals have NULL in the open columns.
    """
    return prices.rollup("market", "symbol").agg(
        F.count(F.lit(1)).alias("n_ticks"), F.avg("price").alias("avg_price")
    )
