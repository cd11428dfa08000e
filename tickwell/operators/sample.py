"""Quotes at a moment and on a fixed grid of moments."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.functions.clock import arrival_order, moment
from tickwell.schema import POLL_ITERATIONS, POLL_SECONDS

#: Grid points generated per row and carried forward per task group.
GRID_BLOCK = 4096


def quote_asof(ticks: DataFrame, at: datetime | str, tie: str | None = None) -> DataFrame:
    """Last price per symbol as of ``at``."""
    until = ticks.filter(F.col("timestamp") <= moment(at))
    return latest_quote(until, tie)


def latest_quote(ticks: DataFrame, tie: str | None = None) -> DataFrame:
    """Last price per symbol. Ticks without a time count for nothing but their symbol."""
    last = F.max_by("price", arrival_order(ticks, tie))
    return ticks.groupBy("symbol").agg(last.alias("price"), F.max("timestamp").alias("timestamp"))


def poll_sample(
    ticks: DataFrame,
    start: Column | datetime | str,
    points: Column | int,
    seconds: int = POLL_SECONDS,
    tie: str | None = None,
    block: int = GRID_BLOCK,
) -> DataFrame:
    """What a poller sees that asks for every symbol's last price each ``seconds``, ``points`` times from ``start`` on.

    Yields ``symbol, poll_ts, price``; the price is NULL before a symbol's first tick.

    Ticks shrink to the last one per symbol and grid interval before they are
    shuffled. Grid points are generated from these: each price spans the points up to
    the next one. The grid is cut into blocks with the price carried in from the
    blocks before, so no task holds a symbol's whole grid.
    """
    origin = F.unix_micros(moment(start).cast("timestamp"))
    size = (points if isinstance(points, Column) else F.lit(points)).cast("bigint")
    step = seconds * 1_000_000
    order = arrival_order(ticks, tie)

    # The first grid point at or after the tick; ticks ahead of the grid count for its
    # first point, ticks behind it for the point past its end, which yields no row.
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    due = F.least(F.greatest(F.ceil((micros - origin) / F.lit(step)), F.lit(0)), size)
    seen = (
        ticks.withColumn("_at", due)
        .groupBy("_at", "symbol")
        .agg(F.max_by("price", order).alias("price"))
        .withColumn("_block", F.floor(F.col("_at") / F.lit(block)))
    )

    # The price a block opens with is the close of the last block before it that has one.
    by_block = Window.partitionBy("symbol").orderBy("_block")
    closing = (
        seen.groupBy("symbol", "_block")
        .agg(F.max_by("price", "_at").alias("_close"))
        .withColumn("_first", F.row_number().over(by_block) == 1)
        .withColumn("_next", F.coalesce(F.lead("_block").over(by_block), F.floor((size - 1) / F.lit(block))))
    )
    opened = F.concat(
        F.when(F.col("_first"), _blocks(F.lit(0).cast("bigint"), F.col("_block"), F.lit(None).cast("double"))).otherwise(F.array()),
        _blocks(F.col("_block") + 1, F.col("_next"), F.col("_close")),
    )
    openings = closing.select("symbol", F.inline(opened)).select(
        "symbol", "_block", (F.col("_block") * block).alias("_at"), "price", F.lit(0).alias("_own")
    )
    own = seen.select("symbol", "_block", "_at", "price", F.lit(1).alias("_own"))

    along = Window.partitionBy("symbol", "_block").orderBy("_at", "_own")
    end = F.least((F.col("_block") + 1) * block, size)
    # An opening gives way to a tick due at the same point: its span is then empty.
    # So is the span of what lies past the grid.
    return (
        openings.unionByName(own)
        .withColumn("_until", F.coalesce(F.lead("_at").over(along), end) - 1)
        .filter(F.col("_until") >= F.col("_at"))
        .select("symbol", "price", F.explode(F.sequence("_at", "_until")).alias("_at"))
        .select(
            "symbol",
            F.timestamp_micros(origin + F.col("_at") * step).cast("timestamp_ntz").alias("poll_ts"),
            "price",
        )
    )


def _blocks(first: Column, last: Column, price: Column) -> Column:
    """Blocks ``first`` to ``last``, none if that is empty, each opening with ``price``."""
    return F.when(
        first <= last, F.transform(F.sequence(first, last), lambda b: F.struct(b.alias("_block"), price.alias("price")))
    ).otherwise(F.array())


def whole_grid(ticks: DataFrame, seconds: int = POLL_SECONDS) -> tuple[Column, Column]:
    """Start and number of points of the grid that covers all ticks, aligned to ``seconds``."""
    step = seconds * 1_000_000
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    first, last = F.floor(F.min(micros) / F.lit(step)), F.ceil(F.max(micros) / F.lit(step))
    span = ticks.agg(first.alias("first"), last.alias("last"))
    start = span.select(F.timestamp_micros(F.col("first") * step)).scalar()
    points = span.select(F.col("last") - F.col("first") + 1).scalar()
    return start, points


def poll_sample_bounded(
    ticks: DataFrame,
    start: Column | datetime | str,
    iterations: int = POLL_ITERATIONS,
    seconds: int = POLL_SECONDS,
    tie: str | None = None,
) -> DataFrame:
    """``poll_sample`` for a bounded run, whose bound is inclusive: ``iterations + 1`` points."""
    return poll_sample(ticks, start, iterations + 1, seconds, tie)
