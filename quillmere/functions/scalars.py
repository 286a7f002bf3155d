"""Null-safe casts and small scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(text: Column) -> Column:
    """Integer text, '' where it is none."""
    return F.coalesce(text.cast("string").try_cast("bigint").cast("string"), F.lit(""))


def safe_float(text: Column) -> Column:
    """Number rounded to four places as text, '' where it is none."""
    return F.coalesce(F.round(text.cast("string").try_cast("double"), 4).cast("string"), F.lit(""))


def safe_text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def first_filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def megabytes(size: Column) -> Column:
    return F.round(size / (1024 * 1024), 2)


def gigabytes(size: Column, binary: bool = False) -> Column:
    """Decimal gigabytes, or with ``binary`` multiples of 1024."""
    return F.round(size / (1024**3 if binary else 10**9), 2)


def hours(seconds: Column) -> Column:
    return F.round(seconds / 3600, 2)


def safe_file_name(text: Column) -> Column:
    return F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")


def finding_list(items: Column) -> Column:
    """array<struct(analyte, value, flag)> to 'analyte: value [flag]; ...' with defaults."""
    part = lambda v, d: F.coalesce(F.nullif(v, F.lit("")), F.lit(d))
    return F.array_join(F.transform(items, lambda x: F.concat(part(x["analyte"], "?"), F.lit(": "), part(x["value"], "?"), F.lit(" ["), part(x["flag"], ""), F.lit("]"))), "; ")


def difference(a: Column, b: Column) -> Column:
    """Element-wise a - b of two arrays."""
    return F.zip_with(a, b, lambda x, y: x - y)
