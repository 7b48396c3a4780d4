"""Nested API documents to rows, keeping what cannot be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.functions.payload import first_or, int_of, sorted_head

CORRUPT = "_corrupt_record"

STATION_DOCUMENT = (
    "id STRING, commonName STRING, lat DOUBLE, lon DOUBLE, "
    "additionalProperties ARRAY<STRUCT<key: STRING, value: STRING>>"
)
LINE_DOCUMENT = (
    "id STRING, name STRING, lineStatuses ARRAY<STRUCT<statusSeverityDescription: STRING, reason: STRING>>"
)
ARRIVAL_DOCUMENT = (
    "id STRING, naptanId STRING, stationName STRING, lineName STRING, destinationName STRING, "
    "timeToStation INT, expectedArrival STRING, vehicleId STRING"
)


def read_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Landed JSON documents; unreadable ones keep their text in the corrupt column."""
    reader = spark.read.schema(f"{schema}, {CORRUPT} STRING").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("multiLine", multi_line).json(path)


def parse_documents(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON text column to document columns plus the corrupt column."""
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(column, f"{schema}, {CORRUPT} STRING", options)
    return df.withColumn("_doc", parsed).select(*df.columns, "_doc.*")


def split_rejects(documents: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Readable documents, and the texts of the others (NULL and unparsable ones alike)."""
    bad = F.col(CORRUPT).isNotNull() | F.col(text).isNull()
    return documents.filter(~bad).drop(CORRUPT), documents.filter(bad).select(*[text])


def station_rows(documents: DataFrame, event_time: Column) -> DataFrame:
    """Station documents to batch raw rows; counts live in a list of key/value texts."""
    counts = F.col("additionalProperties")
    return documents.select(
        F.col("id").alias("bike_point_id"),
        F.col("commonName").alias("common_name"),
        int_of(counts, "NbDocks").alias("total_docks"),
        int_of(counts, "NbBikes").alias("available_bikes"),
        int_of(counts, "NbEBikes").alias("available_ebikes"),
        "lat", "lon", event_time.alias("event_time"),
    )


def line_rows(documents: DataFrame, event_time: Column) -> DataFrame:
    """Line documents to batch raw rows: the first status of each line."""
    statuses = F.col("lineStatuses")
    return documents.select(
        F.col("id").alias("line_id"), F.col("name").alias("line_name"),
        first_or(statuses, "statusSeverityDescription", "Unknown").alias("status"),
        first_or(statuses, "reason", "").alias("reason"),
        event_time.alias("event_time"),
    )


def line_history_rows(documents: DataFrame, event_time: Column) -> DataFrame:
    """One history point per status of each line."""
    points = documents.select("id", event_time.alias("timestamp"), F.posexplode("lineStatuses").alias("position", "entry"))
    return points.select(
        F.col("id").alias("line_id"), "position", "timestamp",
        F.col("entry.statusSeverityDescription").alias("status"), F.col("entry.reason").alias("reason"),
    )


def arrival_rows(documents: DataFrame, event_time: Column, stop_id: Column | None = None) -> DataFrame:
    """Arrival documents to batch raw rows, missing fields defaulted."""
    asked = F.lit(None).cast("string") if stop_id is None else stop_id
    texts = {"stationName": "station_name", "lineName": "line_name", "destinationName": "destination_name"}
    return documents.select(
        F.coalesce("id", F.lit("")).alias("arrival_id"),
        F.coalesce(F.col("naptanId"), asked).alias("stop_id"),
        *[F.coalesce(F.col(source), F.lit("")).alias(name) for source, name in texts.items()],
        F.coalesce("timeToStation", F.lit(0)).alias("time_to_station"),
        F.coalesce(F.col("expectedArrival"), event_time.cast("string")).alias("expected_arrival"),
        event_time.alias("event_time"),
    )


def soonest_arrivals(arrivals: Column, n: int = 20) -> Column:
    """The next n arrivals inside one stop document."""
    return sorted_head(arrivals, "expectedArrival", n)
