"""Row checks: every record is either a storable tick or carries the reason why it is not."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.functions.codec import decode_ticks
from tickwell.schema import LIMITS


def check_lengths(df: DataFrame, limits: dict[str, int] = LIMITS) -> DataFrame:
    """Bounded-string rule: too many characters is a reason, surplus trailing blanks are cut."""
    reason = F.col("reason")
    columns = {}
    for name, limit in limits.items():
        text = F.col(name)
        reason = F.when(reason.isNull() & (F.char_length(F.rtrim(text)) > limit), f"too_long_{name}").otherwise(reason)
        columns[name] = F.when(F.char_length(text) > limit, F.substring(text, 1, limit)).otherwise(text)
    # Both sides read the uncut text, as one projection evaluates them on the input row.
    return df.withColumns({"reason": reason, **columns})


def judge(df: DataFrame, value: str = "value", legacy: bool = False, on_malformed: str = "quarantine") -> DataFrame:
    """Decode and check ``value``: adds the tick columns and ``reason``.

    ``legacy`` lets legacy messages in and adds ``event_time``: their producer's clock,
    or the record's own ``timestamp``, if there is one, for a message without.

    ``on_malformed="fail"`` stops the job at a payload that is no JSON text, instead
    of setting it aside.
    """
    if on_malformed not in ("quarantine", "fail"):
        raise ValueError(f"on_malformed: {on_malformed}")
    judged = decode_ticks(df, value, legacy)
    if legacy and "timestamp" in df.columns:
        judged = judged.withColumn("event_time", F.coalesce("event_time", F.col("timestamp").cast("timestamp_ntz")))
    if on_malformed == "fail":
        stop = F.raise_error(F.lit("payload is not JSON")).cast("string")
        judged = judged.withColumn("reason", F.when(F.col("reason") == "malformed", stop).otherwise(F.col("reason")))
    return check_lengths(judged)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull())


def reject_report(judged: DataFrame) -> DataFrame:
    """Rejected records per reason."""
    return rejected(judged).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
