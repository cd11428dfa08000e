"""Values that depend on all earlier prices of a symbol: weighted average, peak and drawdown.

What a slice of a symbol does to the value that comes in is one small row, however many
ticks the slice has; these rows, composed along the symbol, give the value each slice
begins with. So no task walks along a whole symbol.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.plans.slices import sliced

_SLICE = ["symbol", "_slice"]


def _cut(prices: DataFrame, tie: str | None, slices: int | None) -> tuple[DataFrame, list[str], list[str]]:
    order = ["timestamp", *([tie] if tie else [])]
    columns = ["symbol", "price", *order]
    return sliced(prices.filter(F.col("symbol").isNotNull()).select(*columns), ["symbol"], order, slices), order, columns


def _there() -> Column:
    return F.col("price").isNotNull() & ~F.isnan("price")


def price_ewma(prices: DataFrame, alpha: float, tie: str | None = None, slices: int | None = None) -> DataFrame:
    """Exponentially weighted average price: ``alpha`` times the price and the rest times the average before it.

    A symbol's first price is its first average. A missing price, NULL or NaN, leaves the
    average as it is, NULL before the first price. Ticks without a symbol are left out; those without a
    time come first.

    Over a slice the average is an affine map of the one before: with n prices it keeps
    (1 - alpha)^n of it and adds a sum of prices. These maps are composed per symbol.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be above 0 and at most 1")
    cut, order, columns = _cut(prices, tie, slices)
    keep = 1 - alpha
    behind = Window.partitionBy(*_SLICE).orderBy(*[F.col(c).desc() for c in order])
    priced = cut.filter(_there()).withColumn("_behind", F.row_number().over(behind) - 1)
    maps = priced.groupBy(*_SLICE).agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("price", "_behind").alias("first"),
        F.sum(F.lit(alpha) * F.col("price") * F.pow(F.lit(keep), F.col("_behind"))).alias("added"),
    )
    # A slice without a price passes on what it gets.
    whole = cut.select(*_SLICE).distinct().join(maps, _SLICE, "left").na.fill({"n": 0, "added": 0.0})
    along = whole.repartition("symbol").sortWithinPartitions(*_SLICE)
    before = along.mapInPandas(_composed(keep), "symbol string, _slice int, _before double")
    joined = cut.join(before, _SLICE, "left").select(*columns, "_slice", "_before")
    dealt = joined.repartition(*_SLICE).sortWithinPartitions(*_SLICE, *order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name in columns)
    return dealt.mapInPandas(_averaged(alpha, columns), f"{schema}, ewma double")


def _composed(keep: float):
    """The average that each slice begins with, from the maps of the slices before it, in their order."""

    def compose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        symbol, value = None, None
        for maps in batches:
            before = []
            for s, n, first, added in zip(maps.symbol, maps.n, maps["first"], maps.added, strict=True):
                if s != symbol:
                    symbol, value = s, None
                before.append(value)
                # A symbol's first price counts in full: it stands for the average before it.
                if n:
                    value = added + keep**n * (first if value is None else value)
            yield pd.DataFrame({"symbol": maps.symbol, "_slice": maps["_slice"], "_before": pd.array(before, "Float64")})

    return compose


def _averaged(alpha: float, columns: list[str]):
    """The running average of sorted slices, a batch of rows at a time."""

    def average(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, value = None, np.nan
        for rows in batches:
            out = np.empty(len(rows))
            prices, before = rows.price.to_numpy(float), rows["_before"].to_numpy(float)
            for i, (s, cut) in enumerate(zip(rows.symbol, rows["_slice"], strict=True)):
                if (s, cut) != place:
                    place, value = (s, cut), before[i]
                price = prices[i]
                if price == price:
                    value = price if value != value else value + alpha * (price - value)
                out[i] = value
            yield rows[columns].assign(ewma=pd.array(np.where(np.isnan(out), None, out), "Float64"))

    return average


def price_drawdown(prices: DataFrame, tie: str | None = None, slices: int | None = None) -> DataFrame:
    """``peak``, the highest price so far, and ``drawdown``, how far below it the price is as a share of it.

    A missing price, NULL or NaN, has the peak before it and no drawdown; a peak that is not above zero
    has none either. Ticks without a symbol are left out; those without a time come first.
    """
    cut, order, columns = _cut(prices, tie, slices)
    so_far = Window.partitionBy(*_SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("symbol").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("_price", F.when(_there(), F.col("price")))
    tops = cut.groupBy(*_SLICE).agg(F.max("_price").alias("_top"))
    before = tops.select(*_SLICE, F.max("_top").over(earlier).alias("_before"))
    peak: Column = F.greatest(F.max("_price").over(so_far), F.col("_before"))
    peaked = cut.join(before, _SLICE).withColumn("peak", peak)
    return peaked.select(*columns, "peak", F.when(F.col("peak") > 0, F.col("_price") / F.col("peak") - 1).alias("drawdown"))
