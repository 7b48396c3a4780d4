"""Curated projections, envelopes and serving shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.constants import TOPICS
from headway.functions import measures as m
from headway.functions.payload import extract_json
from headway.functions.text_time import at, to_millis, to_time
from headway.operators.filters import consistent_counts, plausible_arrivals, plausible_stations, required
from headway.sources.readers import small_table

# Columns of the hot path, a subset of the curated table.
HOT_STATION = [
    "bike_point_id", "common_name", "nb_bikes", "nb_ebikes", "nb_empty_docks",
    "occupancy_pct", "is_empty", "is_full",
]
HOT_STATUS = ["line_id", "line_name", "status_severity", "status_description", "reason"]


def clock(as_of: str | None) -> Column:
    """Processing time, or a fixed one where results must be repeatable."""
    return at(as_of) if as_of else F.current_timestamp().cast("timestamp_ntz")


def typed_feed(messages: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Enveloped messages to raw-table rows: payload fields, broker time, ingest time."""
    opened = messages.select("timestamp", F.json_tuple("value", "data", "ingested_at").alias("data", "ingested_at"))
    envelope = opened.select(
        "data", F.col("timestamp").cast("timestamp_ntz").alias("event_time"), to_time(F.col("ingested_at")).alias("ingested_at")
    )
    return extract_json(envelope, "data", fields).select(*fields, "event_time", "ingested_at")


REJECTS = ["outcome", "reject_reason", "reject_value"]
READ, REJECTED = "read", "rejected"


def checked_feed(messages: DataFrame, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """The same rows, and for messages that give none what is wrong with them and their text.

    ``envelope``: no text, no JSON or no payload in it; ``payload``: none of the fields can be read
    from it. Both come out of the one parse that types the fields.
    """
    opened = messages.select("timestamp", "value", F.json_tuple("value", "data", "ingested_at").alias("data", "ingested_at"))
    envelope = opened.select(
        "value", "data", F.col("timestamp").cast("timestamp_ntz").alias("event_time"), to_time(F.col("ingested_at")).alias("ingested_at")
    )
    typed = extract_json(envelope, "data", fields)
    nothing = F.coalesce(*[F.col(name).cast("string") for name in fields]).isNull()
    reason = F.when(F.col("data").isNull(), "envelope").when(nothing, "payload")
    return typed.select(
        *fields, "event_time", "ingested_at", F.when(reason.isNull(), READ).otherwise(REJECTED).alias("outcome"), reason.alias("reject_reason"),
        F.when(reason.isNotNull(), F.col("value")).alias("reject_value"),
    )


def accepted(checked: DataFrame) -> DataFrame:
    """Rows of readable messages.

    By a column of the files: a stream that starts on an empty folder doesn't know its partitions.
    Files of rejects are passed over by their statistics.
    """
    return checked.filter(F.col("reject_reason").isNull()).drop(*REJECTS)


def rejects(checked: DataFrame) -> DataFrame:
    """Unreadable messages: reason, text and time."""
    return checked.filter(F.col("reject_reason").isNotNull()).select("reject_reason", "reject_value", "event_time")


def curate_stations(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Streaming-vocabulary station rows: filtered, with occupancy and edge flags."""
    bikes, ebikes = F.col("nb_bikes"), F.col("nb_ebikes")
    return plausible_stations(raw).select(
        "bike_point_id", "common_name", "lat", "lon", bikes, ebikes, "nb_empty_docks", "nb_docks",
        m.occupancy_pct(bikes, ebikes, F.col("nb_docks")).alias("occupancy_pct"),
        m.holds_nothing(bikes, ebikes).alias("is_empty"),
        m.no_free_dock(F.col("nb_empty_docks")).alias("is_full"),
        "event_time",
        clock(as_of).alias("processed_at"),
    )


def hot_stations(curated: DataFrame) -> DataFrame:
    """Curated stations for the keyed topic: fewer columns, millisecond time."""
    return curated.select(*HOT_STATION, to_millis(F.col("event_time")).alias("event_time"))


def curate_arrivals(raw: DataFrame, as_of: str | None = None) -> DataFrame:
    """Streaming-vocabulary arrivals: plausible ones, seconds floored at zero."""
    seconds = F.col("time_to_station")
    return plausible_arrivals(raw).select(
        "arrival_id", "vehicle_id", "line_id", "line_name", "destination_name",
        "stop_id", "stop_name", "direction",
        m.floor_at(seconds).alias("time_to_station_seconds"),
        m.has_arrived(seconds).alias("has_arrived"),
        "event_time",
        clock(as_of).alias("processed_at"),
    )


def enrich_stations(raw: DataFrame) -> DataFrame:
    """Batch-vocabulary station rows: unrounded occupancy and an availability status."""
    bikes, docks = F.col("available_bikes"), F.col("total_docks")
    return consistent_counts(raw).select(
        "bike_point_id", "common_name", docks, bikes, "available_ebikes",
        m.fill_pct(bikes, docks).alias("occupancy_pct"),
        m.holds_nothing(bikes).alias("is_empty"),
        m.at_capacity(bikes, docks).alias("is_full"),
        m.availability_status(bikes, docks).alias("availability_status"),
        "lat", "lon", "event_time",
    )


def enrich_arrivals(raw: DataFrame) -> DataFrame:
    """Batch-vocabulary arrivals: typed expected time and a status bucket."""
    return required(raw, "arrival_id").select(
        "arrival_id", "stop_id", "station_name", "line_name", "destination_name", "time_to_station",
        to_time(F.col("expected_arrival")).alias("expected_arrival"),
        m.arrival_status(F.col("time_to_station")).alias("arrival_status"),
        "event_time",
    )


def enrich_lines(raw: DataFrame) -> DataFrame:
    """Batch-vocabulary line status with a traffic-light colour."""
    return required(raw, "line_id").select(
        "line_id", "line_name", "status", "reason",
        m.line_rag(F.col("status")).alias("severity"), "event_time",
    )


def status_rows(raw: DataFrame) -> DataFrame:
    """Raw line status as rows of the latest-status table."""
    return raw.select(*HOT_STATUS[:2], "mode_id", *HOT_STATUS[2:], F.col("event_time").alias("last_updated"))


def hot_status(latest: DataFrame) -> DataFrame:
    """Latest status for the keyed topic: no mode, millisecond time."""
    return latest.select(*HOT_STATUS, to_millis(F.col("last_updated")).alias("last_updated"))


def message_domain(topic: Column) -> Column:
    """Text before the first dot, ``unknown`` when there is none."""
    return F.when(F.instr(topic, ".") > 0, F.substring_index(topic, ".", 1)).otherwise("unknown")


def delivery_envelope(messages: DataFrame) -> DataFrame:
    """Messages as subscribers get them: domain, topic, time in epoch ms, data."""
    return messages.select(
        message_domain(F.col("topic")).alias("domain"),
        "topic",
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp"),
        F.col("value").alias("data"),
    )


def station_document(latest: DataFrame) -> DataFrame:
    """Stations as served, with defaults for missing fields."""
    return latest.select(
        F.col("bike_point_id").alias("station_id"),
        F.coalesce("common_name", F.lit("")).alias("name"),
        "lat", "lon",
        F.coalesce(F.col("nb_bikes"), F.lit(0)).alias("bikes_available"),
        F.coalesce(F.col("nb_empty_docks"), F.lit(0)).alias("docks_available"),
        F.coalesce(F.col("nb_docks"), F.lit(0)).alias("total_docks"),
    )


def status_document(latest: DataFrame) -> DataFrame:
    return latest.select(
        F.col("line_id").alias("id"), F.col("line_name").alias("name"),
        F.col("status_description").alias("status"), "reason",
    )


def arrival_document(arrivals: DataFrame) -> DataFrame:
    """Arrivals as served; missing texts become empty."""
    texts = {"line_name": "line_name", "destination_name": "destination", "expected_arrival": "expected_arrival"}
    return arrivals.select(
        *[F.coalesce(F.col(source), F.lit("")).alias(name) for source, name in texts.items()],
        F.col("time_to_station").alias("time_to_station_sec"), "vehicle_id",
    )


def topic_table(spark: SparkSession, topics: list[tuple] = TOPICS) -> DataFrame:
    return small_table(spark, ["domain", "label", "topic", "description"], topics)


def topic_catalog(topics: DataFrame) -> DataFrame:
    """Topics grouped by domain; one row per topic name goes in, so groups stay small."""
    entry = F.struct(F.col("topic").alias("name"), "description")
    return topics.distinct().groupBy("domain", "label").agg(F.array_sort(F.collect_list(entry)).alias("topics"))
