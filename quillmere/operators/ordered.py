"""Ordered computations per group that don't put a large group into one task.

``spread`` range-partitions rows by group and order and materialises them, so a group that
holds much of the table lies in many partitions. ``prefix`` then combines, for each row, what
comes before it in its group: the partition's own rows through a window, earlier partitions
through one value per (partition, group), of which a group has at most one a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

PART = "__part"


def spread(df: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """The rows with their partition number; rows equal in group and order stay together."""
    return cut_lineage(df.repartitionByRange(*group, *order).withColumn(PART, F.spark_partition_id()))


def prefix(d: DataFrame, group: list[str], order: list[str], value: Column, out: str, how: str = "sum", own: bool = False) -> DataFrame:
    """Add ``out``: sum or max of ``value`` over the group's rows before this one (``own``: and it).

    Nothing before gives 0 for sums, null for maxima. Null groups are a group of their own.
    """
    f = {"sum": F.sum, "max": F.max}[how]
    d = d.withColumn("__v", value)
    sums = d.groupBy(PART, *group).agg(f("__v").alias("__s"))
    earlier = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(F.col(PART).alias("__q"), *[F.col(g).alias("__g" + g) for g in group], f("__s").over(earlier).alias("__b")).filter("__b is not null")
    on = [d[PART] == before["__q"], *[d[g].eqNullSafe(before["__g" + g]) for g in group]]
    here = Window.partitionBy(PART, *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    # An outer join, so no estimate of a table's size can make the rows themselves the broadcast side.
    j = d.join(F.broadcast(before), on, "left").drop("__q", *["__g" + g for g in group]).withColumn("__h", f("__v").over(here))
    # Within a group every value here comes behind all before it.
    both = F.coalesce("__b", F.lit(0)) + F.coalesce("__h", F.lit(0)) if how == "sum" else F.when(F.col("__h").isNull(), F.col("__b")).when(F.col("__b").isNull(), F.col("__h")).otherwise(F.greatest("__b", "__h"))
    return j.withColumn(out, both).drop("__v", "__b", "__h")


def running_total(df: DataFrame, group: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the group's earlier rows."""
    return prefix(spread(df, group, order), group, order, value, out).withColumn(out, F.col(out).cast("bigint")).drop(PART)
