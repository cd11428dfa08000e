"""Ordered work on groups of any size.

A window over a whole group runs in one task, and one symbol may hold a third of all
rows. The helpers here cut the table into slices along its groups and their order, run
the window per slice, and carry over from slice to slice what the window needs from
before. Spark's range partitioning finds the cuts from a sample of the sort key, so
they fall inside an instant, between sparse ids or within one crowded minute alike.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.sources.scratch import kept


def sliced(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """``df`` with ``_slice``, a number that rises along ``keys`` and ``order`` over the whole table.

    A slice is a range of the sorted table, of about as many rows as any other, however
    uneven the groups are: one of ``slices``, or, if that is not given, what one task of
    a shuffle gets (``spark.sql.shuffle.partitions``). ``order`` should tell the rows of
    a group apart, as equal rows stay together. The rows are kept in the shared folder,
    so that all uses of the result and all attempts of a task see the same slices.
    """
    cut = df.repartitionByRange(*([slices] if slices else []), *keys, *order)
    return kept(cut.withColumn("_slice", F.spark_partition_id()))


def ranked(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    per_group: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Add ``name``: the 1-based position of each row in its group, without one task per group.

    ``order`` must tell the rows of a group apart. The sizes of the slices are summed on
    the side, where ``per_group`` (some of ``keys``, and columns to add) joins without
    moving the rows; a group has no more rows there than there are slices.
    """
    cut = sliced(df, keys, order, slices)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        cut.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    added = []
    if per_group is not None:
        on = [k for k in keys if k in per_group.columns]
        added = [c for c in per_group.columns if c not in on]
        bases = bases.join(per_group, on, "left")
    within = Window.partitionBy(*keys, "_slice").orderBy(*order)
    return (
        cut.withColumn("_at", F.row_number().over(within))
        .join(bases, [*keys, "_slice"])
        .select(*df.columns, *added, (F.col("_base") + F.col("_at")).alias(name))
    )


def rows_before_slice(cut: DataFrame, key: str, order: list[str], value: str, rows: int) -> DataFrame:
    """Per ``(key, _slice)`` behind another: ``_before``, the last ``rows`` values ahead of the slice, in order.

    A slice offers at most ``rows`` of its own rows (kept per task before the shuffle). By
    the running count of rows over the slices it is known which later slices each of them
    is for, so no slice is sent more than it needs: ``rows`` values, from however many slices.
    """
    backwards = Window.partitionBy(key, "_slice").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        cut.select(key, "_slice", *order, F.col(value).alias("_value"))
        .withColumn("_last", F.row_number().over(backwards))
        .filter(F.col("_last") <= rows)
    )
    along = Window.partitionBy(key).orderBy("_slice")
    ends = cut.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n")).withColumns(
        {"_end": F.sum("_n").over(along), "_to": F.lead("_slice").over(along)}
    )
    # Slices whose predecessor ends within reach of this one's end.
    reach = Window.partitionBy(key).orderBy("_end").rangeBetween(Window.currentRow, max(rows - 1, 0))
    targets = ends.withColumn("_targets", F.collect_list(F.struct("_to", "_end")).over(reach))
    wanted = F.filter("_targets", lambda t: t["_to"].isNotNull() & (t["_end"] - F.col("_end") + F.col("_last") <= rows))
    sent = tails.join(targets.select(key, "_slice", "_end", "_targets"), [key, "_slice"]).withColumn("_target", F.explode(wanted))
    return sent.groupBy(key, F.col("_target._to").alias("_slice")).agg(
        F.sort_array(F.collect_list(F.struct(*order, "_value"))).getField("_value").alias("_before")
    )


def last_items(items: Column, n: Column) -> Column:
    """The last ``n`` items, or all if there are fewer; ``n`` must not be negative."""
    return F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)
