"""Counts, exact quantiles, bands, histograms, co-occurrence, run comparison."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import prefix, spread


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Counts of the non-null values of the columns."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))


def shares(df: DataFrame, column: str) -> DataFrame:
    """Counts with their per cent of all; the total is one more (one-row) aggregate."""
    c = value_counts(df, column)
    total = df.filter(F.col(column).isNotNull()).agg(F.count("*").alias("total"))
    return c.join(F.broadcast(total)).withColumn("percent", F.round(100.0 * F.col("n") / F.col("total"), 2)).drop("total")


def quartiles(df: DataFrame, column: str, by: list[str] | None = None, places: int = 4) -> DataFrame:
    """Exact quartiles with linear interpolation.

    Values are counted first, then spread by group and value; what lies before a value comes from
    per-partition offsets, so no group's values meet in one task or one map. Null values take no part in the
    quartiles, but their groups come out.
    """
    by = by or []
    keys = by or ["__all"]
    d = df.select(*by, F.col(column).alias("__x")) if by else df.select(F.lit(0).alias("__all"), F.col(column).alias("__x"))
    c = spread(d.filter("__x is not null").groupBy(*keys, "__x").agg(F.count("*").alias("__c")), keys, ["__x"])
    c = prefix(c, keys, ["__x"], F.col("__c"), "__lo")
    n = d.groupBy(*keys).agg(F.count("__x").alias("n")) if by else d.agg(F.count("__x").alias("n")).withColumn("__all", F.lit(0))
    names, places_at = ("q1", "median", "q3"), (0.25, 0.5, 0.75)
    j = n.alias("n").join(c.alias("c"), [F.col(f"n.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys], "left")
    value = lambda rank: F.max(F.when((F.col("__lo") <= rank) & (rank < F.col("__lo") + F.col("__c")), F.col("__x").cast("double")))
    at = lambda q: (F.col("n") - 1) * F.lit(q)
    g = j.groupBy(*[F.col(f"n.{k}").alias(k) for k in keys], "n.n").agg(*[value(f(at(q))).alias(f"__{x}{e}") for x, q in zip(names, places_at) for e, f in (("l", F.floor), ("h", F.ceil))])
    line = lambda x, q: F.round(F.col(f"__{x}l") + (F.col(f"__{x}h") - F.col(f"__{x}l")) * (at(q) - F.floor(at(q))), places).alias(x)
    return g.select(*by, "n", *[line(x, q) for x, q in zip(names, places_at)])


def nearest_rank_quartiles(df: DataFrame, column: str) -> DataFrame:
    """Elements n//4, n//2 and 3n//4 of the sorted values.

    Values are first counted, so what is ranked grows with the distinct values alone; the
    ranks come from per-range offsets, not from one sorted partition.
    """
    from ..session import cut_lineage
    from pyspark.sql import Window

    c = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    c = cut_lineage(c.repartitionByRange("v").withColumn("p", F.spark_partition_id()))
    parts = c.groupBy("p").agg(F.sum("c").alias("s"))
    before = parts.withColumn("b", F.coalesce(F.sum("s").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row a partition
    r = c.join(before.drop("s"), "p").withColumn("hi", F.col("b") + F.sum("c").over(Window.partitionBy("p").orderBy("v")))
    n = df.agg(F.count(column).alias("n"))
    r = r.join(F.broadcast(n)).withColumn("lo", F.col("hi") - F.col("c"))
    at = lambda k: F.max(F.when((F.col("lo") <= k) & (k < F.col("hi")), F.col("v")))
    return r.agg(at(F.floor(F.col("n") / 4)).alias("q1"), at(F.floor(F.col("n") / 2)).alias("median"), at(F.floor(3 * F.col("n") / 4)).alias("q3"))


def banded(value: Column, edges: list[tuple[str, float, float]]) -> Column:
    """The name of the band [low, high] that holds the value; bands are tried in order."""
    out = F.lit(None).cast("string")
    for name, low, high in reversed(edges):
        out = F.when((value >= low) & (value <= high), name).otherwise(out)
    return out


def histogram(df: DataFrame, value: Column, low: float, width: float, bins: int) -> DataFrame:
    """Counts per fixed-width bin; the last bin includes its upper edge, values outside are left out."""
    b = F.when(value == low + width * bins, bins - 1).otherwise(F.floor((value - low) / width)).cast("int")
    return df.select(b.alias("bin")).filter(F.col("bin").between(0, bins - 1)).groupBy("bin").agg(F.count("*").alias("n"))


def cooccurrence(df: DataFrame, rows: list[str], columns: list[str]) -> DataFrame:
    """Counts of rows where a flag of each set is 1, for every pair that occurs."""
    names = lambda cs: F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(c)) for c in cs]))
    d = df.select(names(rows).alias("a"), names(columns).alias("b"))
    return d.select(F.explode("a").alias("row_flag"), "b").select("row_flag", F.explode("b").alias("column_flag")).groupBy("row_flag", "column_flag").agg(F.count("*").alias("n"))


def distinct_over_union(tables: list[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-blank ids over several tables, each reduced before the union."""
    parts = [t.select(F.col(c).cast("string").alias("id")).filter("trim(id) <> '' and lower(id) <> 'nan'").distinct() for t, c in tables]
    return reduce(DataFrame.unionByName, parts).agg(F.count_distinct("id").alias("n_ids"))


def long_metrics(df: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """(metric, value) rows from one pass."""
    row = df.agg(*[v.cast("double").alias(k) for k, v in metrics.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in metrics])).alias("m")).select("m.metric", "m.value")


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """Full comparison of two (metric, value) tables."""
    j = old.select("metric", F.col("value").alias("old_value")).join(new.select("metric", F.col("value").alias("new_value")), "metric", "full_outer")
    return j.withColumns({"delta": F.round(F.coalesce("new_value", F.lit(0.0)) - F.coalesce("old_value", F.lit(0.0)), 4), "changed": ~F.col("old_value").eqNullSafe(F.col("new_value"))})


def dense_hours(df: DataFrame, hour: str, flag: Column) -> DataFrame:
    """24 rows: how often each hour occurs and how often with the flag, zeros included."""
    counted = df.groupBy(F.col(hour).cast("int").alias("hour")).agg(F.count("*").alias("n_logged"), F.sum(flag.cast("int")).alias("n_flagged"))
    return df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour")).join(counted, "hour", "left").na.fill(0, ["n_logged", "n_flagged"])


def coverage(whole: DataFrame, key: str, parts: dict[str, DataFrame]) -> DataFrame:
    """(part, n, percent): distinct keys of each part against those of the whole, in whole per cent of 100 at most."""
    ids = lambda d: d.filter(F.col(key).isNotNull()).agg(F.count_distinct(key).alias("n"))
    n = reduce(DataFrame.unionByName, [ids(d).select(F.lit(name).alias("part"), "n") for name, d in parts.items()])
    total = ids(whole).select(F.greatest("n", F.lit(1)).alias("total"))
    return n.join(F.broadcast(total)).select("part", "n", F.least(F.lit(100), F.bround(100.0 * F.col("n") / F.col("total"))).cast("int").alias("percent"))


def running_counters(increments: DataFrame, order: str, kind: str, amount: str) -> DataFrame:
    """Add ``total``: the amount of this kind so far; increments may come from several workers."""
    d = prefix(spread(increments, [kind], [order]), [kind], [order], F.col(amount), "total", own=True)
    return d.withColumn("total", F.col("total").cast("bigint")).drop("__part")


def remaining_time(done: Column, total: Column, elapsed: Column) -> dict[str, Column]:
    """Average rate since the start and the seconds left at that rate; null before anything is done."""
    rate = F.when((elapsed > 0) & (done > 0), done / elapsed)
    return {"rate": F.round(rate, 4), "eta_sec": F.round((total - done) / rate, 4)}


def decimated(history: DataFrame, order: str, most: int = 500) -> DataFrame:
    """Every second point, from the first on, of a history with more than ``most``; shorter ones stay whole."""
    n = history.agg(F.count("*").alias("__n"))
    d = prefix(spread(history.withColumn("__g", F.lit(0)), ["__g"], [order]), ["__g"], [order], F.lit(1), "__i")
    return d.join(F.broadcast(n)).filter((F.col("__n") <= most) | (F.col("__i") % 2 == 0)).drop("__g", "__i", "__n", "__part")
