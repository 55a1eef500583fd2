"""Positions and running sums in a given order, without one task per group.

Rows are dealt by key ranges, so a group that holds a third of all rows lies in many partitions.
Each partition counts for itself; what precedes it in a group is the sum over the earlier partitions,
a window over one row per group and partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chesstally.llm.common import materialize


def lay_out(df: DataFrame, deal: list[Column], order: list[Column], label: str) -> DataFrame:
    """``df`` written in the order of ``order``, with ``part`` (range of keys) and ``pos`` (unique and
    ascending in that order). ``deal`` is a prefix of ``order``, or values that ascend with it."""
    laid = df.repartitionByRange(*deal).sortWithinPartitions(*order)
    return materialize(laid.withColumn("pos", F.monotonically_increasing_id())
                       .withColumn("part", F.shiftright("pos", 33)), label)


def running(laid: DataFrame, group: list[str], value: Column, out: str,
            per_group: DataFrame | None = None) -> DataFrame:
    """A result of ``lay_out`` with ``out``: the sum of ``value`` over the rows before this one in its
    group (all rows if ``group`` is empty; its columns hold no nulls). ``per_group`` adds columns by
    ``group``, joined to the few rows per group and partition and not to the rows themselves."""
    keys = [*group, "part"]
    rows = laid.withColumn(out, value)
    sums = rows.groupBy(*keys).agg(F.sum(out).alias("_n"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    if per_group is not None:
        base = base.join(per_group, group)
    inside = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn(out, F.coalesce(F.sum(out).over(inside), F.lit(0))).join(base, keys)
            .withColumn(out, F.col(out) + F.col("_base")).drop("_base"))


def key_of(col: str) -> Column:
    """A key without nulls that tells null from every value and sorts nulls last."""
    return F.when(F.col(col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("a"), F.col(col).cast("string")))
