"""The last price at each moment that a table asks for."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.plans.slices import sliced


def asof_join(
    probes: DataFrame,
    prices: DataFrame,
    at: str = "moment",
    tie: str | None = None,
    within_seconds: float | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``probes`` with ``price`` and ``price_at``: each symbol's last tick at or before ``at``, and its time.

    Both are NULL where there is no such tick, where the probe lacks a symbol or a moment,
    or, with ``within_seconds``, where the tick is older than that. Of ticks at one instant
    the one with the largest ``tie`` counts. No probe is lost or doubled.

    Probes and ticks are one sorted table, cut into slices, so neither a symbol nor a
    moment that many probes ask for ends up in one task. A slice takes the last tick from the slices before
    it, which have one row each for this. No range join is involved.
    """
    for name in ("price", "price_at"):
        if name in probes.columns:
            raise ValueError(f"probes have a column {name} already")
    asked = probes.select(F.struct("*").alias("_probe"), "symbol", F.col(at).cast("timestamp_ntz").alias("_t"))
    found = F.struct(F.col("price"), F.col("timestamp").alias("price_at"))
    ticks = prices.filter(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull()).select(
        "symbol",
        F.col("timestamp").cast("timestamp_ntz").alias("_t"),
        F.lit(0).alias("_side"),
        (F.lit(0) if tie is None else F.col(tie)).alias("_nth"),
        found.alias("_tick"),
    )
    placed = asked.filter(F.col("symbol").isNotNull() & F.col("_t").isNotNull()).withColumns({"_side": F.lit(1), "_row": F.monotonically_increasing_id()})
    # A tick goes before the probes of its instant; probes are told apart so that they can be cut.
    order = ["_t", "_side", "_nth", "_row"]
    cut = sliced(ticks.unionByName(placed, allowMissingColumns=True), ["symbol"], order, slices)

    here = Window.partitionBy("symbol", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    last = cut.filter("_side = 0").groupBy("symbol", "_slice").agg(F.max_by("_tick", F.struct("_t", "_nth")).alias("_last"))
    earlier = Window.partitionBy("symbol").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    spans = cut.select("symbol", "_slice").distinct().join(last, ["symbol", "_slice"], "left")
    carried = spans.select("symbol", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    own = cut.withColumn("_own", F.last("_tick", ignorenulls=True).over(here)).filter("_side = 1")
    answered = own.join(carried, ["symbol", "_slice"]).select("_probe", "_t", F.coalesce("_own", "_before").alias("_tick"))
    if within_seconds is not None:
        age = F.unix_micros(F.col("_t").cast("timestamp")) - F.unix_micros(F.col("_tick.price_at").cast("timestamp"))
        answered = answered.withColumn("_tick", F.when(age <= round(within_seconds * 1_000_000), F.col("_tick")))
    without = asked.filter(F.col("symbol").isNull() | F.col("_t").isNull()).select("_probe")
    return answered.unionByName(without, allowMissingColumns=True).select("_probe.*", "_tick.price", "_tick.price_at")
