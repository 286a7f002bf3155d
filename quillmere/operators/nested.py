"""Nested documents: fan-out to tables, leaf-wise scrubbing, lenient JSON."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def map_strings(column: Column, kind: T.DataType, f: Callable[[Column], Column], skip: frozenset[str] = frozenset()) -> Column:
    """``f`` on every string leaf of a nested column; fields named in ``skip`` stay as they are."""
    if isinstance(kind, T.StringType):
        return f(column)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: map_strings(x, kind.elementType, f, skip))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: map_strings(v, kind.valueType, f, skip))
    if isinstance(kind, T.StructType):
        parts = [(column[x.name] if x.name in skip else map_strings(column[x.name], x.dataType, f, skip)).alias(x.name) for x in kind.fields]
        return F.when(column.isNotNull(), F.struct(*parts))
    return column


def scrub_leaves(df: DataFrame, column: str, f: Callable[[Column], Column], skip: list[str]) -> DataFrame:
    return df.withColumn(column, map_strings(F.col(column), df.schema[column].dataType, f, frozenset(skip)))


def fan_out(records: DataFrame, tables: dict[str, tuple[str, list[Column]]]) -> dict[str, DataFrame]:
    """name -> (array column, columns of ``x``): one row per element of the array, as its own table."""
    return {name: records.select("*", F.explode(array).alias("x")).select(*columns) for name, (array, columns) in tables.items()}


def whitelist(df: DataFrame, crosswalk: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """Only listed columns, the key replaced by the crosswalk's id; rows without an id go."""
    have = [c for c in keep if c in df.columns]
    if len(have) < len(keep):
        warnings.warn(f"absent columns: {sorted(set(keep) - set(have))}", stacklevel=2)
    return df.join(crosswalk.select(key, "person_id"), key).select("person_id", *have)


def repair(text: str | None) -> str | None:
    """A JSON text cut off at its end, completed: fences off, string closed, brackets closed."""
    if text is None:
        return None
    s = text.strip()
    if s.startswith("```"):
        s = s.partition("\n")[2]
    s = s.removesuffix("```").strip()
    open_, quoted, escaped = [], False, False
    for c in s:
        if quoted:
            quoted, escaped = not (c == '"' and not escaped), c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "{[":
            open_.append("}" if c == "{" else "]")
        elif open_ and c == open_[-1]:
            open_.pop()
    s = (s + '"' if quoted else s).rstrip().rstrip(",")
    return s + "".join(reversed(open_))


@F.pandas_udf(T.StringType())
def repaired_json(texts: pd.Series) -> pd.Series:
    """Valid JSON where repair succeeds, else null. For the texts native parsing refuses."""

    def one(t: str | None) -> str | None:
        try:
            fixed = repair(t)
            json.loads(fixed)
            return fixed
        except (TypeError, ValueError):
            return None

    return texts.map(one)


def lenient_json(df: DataFrame, column: str, out: str) -> DataFrame:
    """Native parsing first; only texts it refuses go through the repair."""
    valid = F.try_parse_json(F.col(column)).isNotNull()
    good = df.filter(F.coalesce(valid, F.lit(False))).withColumn(out, F.col(column))
    bad = df.filter(~F.coalesce(valid, F.lit(False))).withColumn(out, repaired_json(F.col(column)))
    return good.unionByName(bad)
