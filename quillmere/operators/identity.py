"""Pseudonymous ids, date shifts, session numbers and continued ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import running_total


def shift_days(key: Column, salt: str = "quillmere") -> Column:
    """A keyed shift of -365 to 365 days, the same wherever it is computed."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 8), 16, 10).cast("bigint") % 731 - 365).cast("int")


def dense_ids(df: DataFrame, key: str, prefix: str = "P-", start: int = 0) -> DataFrame:
    """(key, number, id, shift_days): one sequential number per distinct key in key order.

    Only the distinct keys are sorted. They are range-partitioned and numbered by partition
    offset plus position, so no partition holds them all; the offsets are one row a partition.
    Null and empty keys get no id.
    """
    keys = df.select(key).filter(F.col(key) != "").distinct().repartitionByRange(key).sortWithinPartitions(key)
    keys = cut_lineage(keys.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    sizes = keys.groupBy("__p").agg(F.count("*").alias("n"), F.min("__i").alias("first"))
    offsets = sizes.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = keys.join(offsets, "__p").withColumn("number", (F.col("before") + F.col("__i") - F.col("first") + 1 + start).cast("bigint"))
    return d.select(key, "number", F.concat(F.lit(prefix), F.col("number").cast("string")).alias("id"), shift_days(F.col(key)).alias("shift_days"))


def session_starts(df: DataFrame, entity: str, order: list[str], count: str) -> DataFrame:
    """Add ``session_start``: 1 plus the counts of the entity's earlier rows."""
    return running_total(df, [entity], order, F.col(count), "__t").withColumn("session_start", F.col("__t") + 1).drop("__t")


def numbered(df: DataFrame, group: list[str], order: list[str], out: str = "position") -> DataFrame:
    """Add ``out``: the row's place within its group, from 1."""
    return running_total(df, group, order, F.lit(1), "__t").withColumn(out, F.col("__t") + 1).drop("__t")


def keep_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in the given order; combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    g = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return g.select(*key, *[F.col("__r")[c].alias(c) for c in rest])


def continued_ids(existing: DataFrame, new_keys: DataFrame, key: str, prefix: str = "P-") -> DataFrame:
    """Ids for keys that ``existing`` (key, id) lacks, numbered on from its greatest suffix."""
    top = existing.agg(F.max(F.regexp_extract("id", r"(\d+)$", 1).try_cast("bigint"))).first()[0] or 0
    fresh = new_keys.select(key).distinct().join(existing.select(key), key, "left_anti")
    return dense_ids(fresh, key, prefix, int(top))
