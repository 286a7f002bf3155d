"""Tiered resolution of names against a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _first_by(ref: DataFrame, key: str) -> DataFrame:
    """The first reference row of each key, by its order column."""
    return ref.groupBy(F.col(key).alias("__k")).agg(F.min_by("ref_id", "ref_order").alias("__ref"))


def tiered_match(left: DataFrame, ref: DataFrame, most: int = 2) -> DataFrame:
    """(left_id, ref_id, method, confidence): exact, normalised, first word, then edit distance.

    Both sides bring exact_key, norm_key and root_key; ``left`` has left_id, ``ref`` ref_id
    and ref_order (the first wins). Each tier only sees what earlier ones left. Keys are
    matched once per distinct value. The fuzzy tier joins on the keys' deletion-free blocks:
    same first letter and one of the positional segments that two keys within ``most`` edits
    must share, then verifies the distance; the nearest wins, then the first.
    """
    keys = left.select("exact_key", "norm_key", "root_key").distinct()
    open_, done = keys, []
    for key, method, confidence in (("exact_key", "exact", "high"), ("norm_key", "normalized", "high"), ("root_key", "first_root", "medium")):
        hit = open_.join(_first_by(ref, key), F.col(key) == F.col("__k"), "left").drop("__k")
        done.append(hit.filter("__ref is not null").select("exact_key", "norm_key", "root_key", F.col("__ref").alias("ref_id"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence")))
        open_ = hit.filter("__ref is null").drop("__ref")
    d = fuzzy_join(open_.select("norm_key").distinct(), ref.groupBy("norm_key").agg(F.min_by("ref_id", "ref_order").alias("ref_id"), F.min("ref_order").alias("ref_order")), most)
    best = d.groupBy("l").agg(F.min_by("ref_id", F.struct("d", "ref_order")).alias("ref_id"), F.min("d").alias("d"))
    fuzzy = open_.join(best, F.col("norm_key") == F.col("l"), "left")
    done.append(
        fuzzy.select(
            "exact_key", "norm_key", "root_key", "ref_id",
            F.when(F.col("ref_id").isNull(), "unmatched").otherwise(F.concat(F.lit("levenshtein_d"), F.col("d").cast("string"))).alias("method"),
            F.when(F.col("ref_id").isNull(), "").when(F.col("d") <= 1, "medium").otherwise("low").alias("confidence"),
        )
    )
    tiers = done[0]
    for t in done[1:]:
        tiers = tiers.unionByName(t)
    on = [left[k].eqNullSafe(tiers[k]) for k in ("exact_key", "norm_key", "root_key")]
    return left.join(tiers, on).select("left_id", "ref_id", "method", "confidence")


def fuzzy_join(left: DataFrame, right: DataFrame, most: int = 2) -> DataFrame:
    """(l, norm_key, ref_id, ref_order, d) of all pairs with the same first letter within ``most`` edits.

    A right key cut into most + 1 segments keeps at least one unchanged, moved by at most
    ``most``; substrings of the left key at those places join by equality.
    """
    n, k = F.length("norm_key"), most + 1
    start = F.floor(F.col("i") * n / k).cast("int")
    end = F.floor((F.col("i") + 1) * n / k).cast("int")
    r = right.filter(F.length("norm_key") > 0).select("*", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("i"))
    r = r.select("norm_key", "ref_id", "ref_order", F.substring("norm_key", 1, 1).alias("first"), "i", n.alias("n"), F.substr("norm_key", start + 1, end - start).alias("seg"))
    l = left.select(F.col("norm_key").alias("l")).filter(F.length("l") > 0)
    size = F.length("l")
    l = l.select("l", F.explode(F.sequence(F.greatest(F.lit(1), size - most), size + most)).alias("n"), F.explode(F.array([F.lit(x) for x in range(most + 1)])).alias("i"))
    lo = F.floor(F.col("i") * F.col("n") / k).cast("int")
    hi = F.floor((F.col("i") + 1) * F.col("n") / k).cast("int")
    l = l.select("l", "n", "i", F.explode(F.sequence(F.greatest(lo + 1 - most, F.lit(1)), F.greatest(lo + 1 + most, F.lit(1)))).alias("p"), (hi - lo).alias("len"))
    l = l.select("l", "n", "i", F.substring("l", 1, 1).alias("first"), F.substr("l", F.col("p"), F.col("len")).alias("seg")).distinct()
    pairs = l.join(r, ["first", "n", "i", "seg"]).select("l", "norm_key", "ref_id", "ref_order").distinct()
    d = F.levenshtein("l", "norm_key")
    return pairs.withColumn("d", d).filter(F.col("d").between(0, most))


def union_labelled(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """Tables one above the other with their label and priority; absent columns are null."""
    out = None
    for i, (label, t) in enumerate(tables):
        t = t.withColumns({"source": F.lit(label), "priority": F.lit(i)})
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def duplicated(df: DataFrame, key: str) -> DataFrame:
    """Rows of keys that occur more than once, with ``copies``; counts are combined before the shuffle."""
    many = df.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
    return df.join(many, key)
