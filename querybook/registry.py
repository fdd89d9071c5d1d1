"""How a query and its SQL are registered side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The parquet tables of one folder, opened by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def named(self, names) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


@dataclass
class Book:
    queries: dict[str, Query] = field(default_factory=dict)

    def add(self, sql: str | None):
        """Register the decorated function under its own name."""

        def register(build: Callable[[Tables], DataFrame]):
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return build(Tables(spark, folder))

            self.queries[build.__name__] = Query(run, sql)
            return build

        return register
