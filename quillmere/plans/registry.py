"""Queries with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import load


class Tables:
    """Tables of one data folder by attribute: ``t.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.folder, name)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register a function of ``Tables`` under its name, with the SQL it must agree with."""

        def add(f: Callable[[Tables], DataFrame]):
            self.queries[f.__name__] = lambda spark, folder: f(Tables(spark, folder))
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return add
