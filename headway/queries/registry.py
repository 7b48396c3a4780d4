"""Registry of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from headway.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one data folder, read on access."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str) -> DataFrame:
        """The same table as a bounded stream.

        A stream wants a folder or a pattern; this pattern fits the table as one file and
        as a folder of files.
        """
        return self.spark.readStream.schema(getattr(self, name).schema).parquet(f"{self.folder}/{name}.parque[t]")


def query(name: str, sql: str | None = None) -> Callable:
    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(prepare(spark), folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register
