"""Sinks: delimited files, tables with dictionaries, fan-out, JSON per entity, templates."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", single: bool = False, null: str = "") -> bool:
    """With header, only if there are rows; ``single`` is for small results that must be one file."""
    if df.isEmpty():
        return False
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", "true").option("sep", sep).option("nullValue", null).csv(path)
    return True


def write_tsv_with_dictionary(df: DataFrame, folder: str, name: str, description: dict[str, str]) -> None:
    """A TSV with 'n/a' for nulls beside a JSON data dictionary of its columns."""
    write_csv(df, os.path.join(folder, name), sep="\t", null="n/a")
    known = {c: {"Description": description.get(c, c), "Type": t} for c, t in df.dtypes}
    df.sparkSession.createDataFrame([(json.dumps(known),)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(folder, name + ".json"))


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Each table to its own folder; the committer replaces a folder as a whole."""
    for name, df in tables.items():
        df.write.mode("overwrite").format(fmt).save(os.path.join(folder, name))


def write_json_per_entity(df: DataFrame, folder: str, key: str) -> None:
    df.repartition(key).write.mode("overwrite").partitionBy(key).json(folder)


def append_log(df: DataFrame, folder: str) -> None:
    df.write.mode("append").option("header", "true").csv(folder)


def write_subject_tree(df: DataFrame, folder: str) -> None:
    """sub=.../ses=... partitions, rows of a session together."""
    df.repartition("sub", "ses").write.mode("overwrite").partitionBy("sub", "ses").option("header", "true").option("sep", "\t").option("nullValue", "n/a").csv(folder)


def versioned(df: DataFrame, key: list[str], order: list[str], name: str) -> DataFrame:
    """Names that would collide get _ses2_, _ses3_, ... in front of the extension."""
    from ..operators.identity import numbered

    d = numbered(df, key, order, "__v")
    stem, ext = F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract(name, r"(\.[^.]*)$", 1)
    return d.withColumn(name, F.when(F.col("__v") == 1, F.col(name)).otherwise(F.concat(stem, F.lit("_ses"), F.col("__v").cast("string"), F.lit("_"), ext))).drop("__v")


def fill_template(text: str, values: dict[str, str]) -> tuple[str, list[str]]:
    """``{NEW: key}`` to its value; unknown keys stay and are reported."""
    unknown: list[str] = []

    def put(m: re.Match[str]) -> str:
        key = m.group(1).strip()
        if key in values:
            return values[key]
        unknown.append(key)
        return m.group(0)

    return re.sub(r"\{NEW:([^}]*)\}", put, text), unknown
