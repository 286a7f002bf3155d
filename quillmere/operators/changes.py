"""Incremental processing: what is new, newer, failed or recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(items: DataFrame, done: DataFrame, key: str, reprocess: bool = False) -> DataFrame:
    """Items whose key isn't in ``done``; all of them with ``reprocess``."""
    return items if reprocess else items.join(done.select(key).distinct(), key, "left_anti")


def stale(items: DataFrame, results: DataFrame, key: str, changed: str, made: str) -> DataFrame:
    """Items without a result at least as new as their last change."""
    r = results.groupBy(key).agg(F.max(made).alias("__made"))
    return items.join(r, key, "left").filter(F.col("__made").isNull() | (F.col("__made") < F.col(changed))).drop("__made")


def hash_changed(items: DataFrame, manifest: DataFrame, key: str, digest: str) -> DataFrame:
    """Items that are new or whose content hash differs from the recorded one."""
    m = manifest.select(key, F.col(digest).alias("__old"))
    return items.join(m, key, "left").filter(~F.col(digest).eqNullSafe(F.col("__old"))).drop("__old")


def retry(items: DataFrame, status: DataFrame, key: str, method: str) -> DataFrame:
    """Items without an 'ok' of the same method: a skipped run doesn't count as done."""
    ok = status.filter((F.col("status") == "ok") & (F.col("method") == method)).select(key).distinct()
    return items.join(ok, key, "left_anti")


def merge_records(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """New rows over old ones: rows of ``old`` whose key isn't renewed stay."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new, allowMissingColumns=True)
