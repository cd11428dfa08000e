"""Moments as literals, free of any machine's own time zone."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def moment(at: Column | datetime | str) -> Column:
    """A wall-clock time (UTC) as a zone-free timestamp."""
    if isinstance(at, datetime):
        at = at.isoformat(sep=" ")
    return (at if isinstance(at, Column) else F.lit(at)).cast("timestamp_ntz")


def arrival_order(df: DataFrame, tie: str | None) -> Column:
    """What ticks are ordered by: their ``timestamp``, and ``tie`` where that is equal.

    With an integer for a tie both are one decimal, microseconds before it, and not a
    struct: aggregates ordered by a number run on hash tables, by a struct on sorted rows.
    """
    clock = F.col("timestamp")
    if tie is None:
        return clock
    if not isinstance(df.schema[tie].dataType, IntegralType):
        return F.struct(clock, tie)
    micros = F.unix_micros(clock.cast("timestamp")).cast("decimal(19,0)")
    return (micros * F.lit(Decimal(2**64)) + F.col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")
