"""Batch and streaming reads.

The format is always a parameter. Without a broker connector on the classpath a topic
is a folder of files with the envelope columns; with one, pass ``kafka`` and its options.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.text_time import at, to_time
from headway.schemas import TOPIC_SCHEMA
from headway.sinks.files import create_once, read_text

TOPIC_COLUMNS = ["key", "value", "topic", "offset", "timestamp"]


def small_table(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """A table from constants in the code.

    Built from Arrow, its exact size is known to the planner, which broadcasts it.
    """
    return spark.createDataFrame(pa.table(dict(zip(names, map(list, zip(*rows))))))


def read_landing(spark: SparkSession, path: str, time_columns: tuple[str, ...] = ("event_time", "ingested_at")) -> DataFrame:
    """Landed Parquet with ISO times typed."""
    df = spark.read.parquet(path)
    return df.withColumns({c: to_time(F.col(c)) for c in time_columns if c in df.columns})


def read_layer(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """A layer table: a path, or a catalog name."""
    return spark.read.format(fmt).load(table) if "/" in table else spark.table(table)


def stream_layer(spark: SparkSession, table: str, schema: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """New rows of a layer table as they are committed.

    A backlog of files that are not in time order should be read in one go: limiting
    files per trigger lets the watermark pass rows that were not read yet.
    """
    reader = spark.readStream.options(**options)
    if "/" not in table:
        return reader.table(table)
    return (reader.schema(schema) if schema else reader).format(fmt).load(table)


def _topic_rows(df: DataFrame) -> DataFrame:
    """Key and value as text, whatever the broker source delivers."""
    texts = {c: F.col(c).cast("string") for c in ("key", "value")}
    return df.withColumns(texts).select(*TOPIC_COLUMNS)


def stream_topic(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """A topic from its beginning, without end."""
    if fmt == "kafka":
        return _topic_rows(spark.readStream.format(fmt).options(**{"startingOffsets": "earliest", **options}).load())
    path = options.pop("path")
    return _topic_rows(spark.readStream.format(fmt).schema(TOPIC_SCHEMA).options(**options).load(path))


def topic_source(spark: SparkSession, fmt: str = "kafka", **options: str) -> Callable[[str], DataFrame]:
    """Streams by topic name, so that each reader fetches its own topic only."""

    def one(topic: str) -> DataFrame:
        if fmt == "kafka":
            return stream_topic(spark, fmt, subscribe=topic, **options)
        return stream_topic(spark, fmt, **options).filter(F.col("topic") == topic)

    return one


def read_topic(spark: SparkSession, fmt: str = "kafka", **options: str) -> DataFrame:
    """A topic from its beginning to its present end, then done."""
    if fmt == "kafka":
        bounds = {"startingOffsets": "earliest", "endingOffsets": "latest"}
        return _topic_rows(spark.read.format(fmt).options(**{**bounds, **options}).load())
    path = options.pop("path")
    return _topic_rows(spark.read.format(fmt).schema(TOPIC_SCHEMA).options(**options).load(path))


def tail_topic(spark: SparkSession, since: str | None = None, fmt: str = "kafka", **options: str) -> DataFrame:
    """Only what arrives from now on; empty payloads are skipped.

    File topics have no offsets to start from, so they take the starting time instead.
    """
    start = {"startingOffsets": "latest"} if fmt == "kafka" else {}
    rows = stream_topic(spark, fmt, **{**start, **options}).filter(F.col("value").isNotNull())
    return rows.filter(F.col("timestamp") >= at(since).cast("timestamp")) if since else rows


def tail_from(spark: SparkSession, store: str, now: str) -> str:
    """Where a tail starts: at ``now`` the first time, at the stored time whenever it is started again."""
    create_once(spark, f"{store.rstrip('/')}/start", now)
    return read_text(spark, f"{store.rstrip('/')}/start")
