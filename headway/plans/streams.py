"""Streaming flows: topics to raw, raw to curated, curated to analytics.

Each function prepares the streams it names. ``trigger=None`` works off what is there
and stops; a trigger such as ``30 seconds`` keeps a stream running. Tables are divided
by day.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from headway.operators import projections
from headway.schemas import ARRIVAL_FIELDS, LINE_STATUS_FIELDS, RAW_SCHEMAS, STATION_FIELDS
from headway.sinks.tables import make_folder, with_date
from headway.sinks.topics import to_changelog
from headway.sources.readers import stream_layer
from headway.streaming.jobs import (
    CHECKPOINT_PACE, DISCOVERY, append_files, hourly_stream, latest_stream, send, start_once,
)

# Topic -> (raw table, payload fields).
RAW_TOPICS = {
    "tfl.raw.bike-points": ("stations", STATION_FIELDS),
    "tfl.raw.bus-arrivals": ("arrivals", ARRIVAL_FIELDS),
    "tfl.raw.line-status": ("lines", LINE_STATUS_FIELDS),
}
BY_DAY = ["event_date"]
BY_OUTCOME = ["outcome", *BY_DAY]
LINE_TIEBREAK = ["status_severity", "status_description", "reason"]


def ingest(
    source: Callable[[str], DataFrame], root: str, checkpoint: str, trigger: str | None = None
) -> dict[str, DataStreamWriter]:
    """Enveloped messages to one raw table per topic; ``source`` gives the stream of a topic.

    A message is parsed once and written once, exactly: unreadable ones go to files of their own
    with their text (``raw_rows`` and ``raw_rejects`` read the two). Each batch's progress counts both.
    """
    writers = {}
    for topic, (table, fields) in RAW_TOPICS.items():
        checked = with_date(projections.checked_feed(source(topic), fields), "event_time")
        checked = checked.observe(f"ingest_{table}", F.count_if(F.col("reject_reason").isNull()).alias("rows"), F.count("reject_reason").alias("rejects"))
        writers[table] = append_files(checked, f"{root}/{table}", f"{checkpoint}/{table}", trigger, partition_by=BY_OUTCOME)
    return writers


def raw_rows(raw: DataFrame) -> DataFrame:
    """A raw table's rows, read or streamed."""
    return projections.accepted(raw)


def raw_rejects(raw: DataFrame) -> DataFrame:
    """What could not be read, with its text."""
    return projections.rejects(raw)


def curate_station_stream(
    raw: DataFrame, root: str, checkpoint: str, trigger: str | None = None, as_of: str | None = None,
    partition_by: list[str] = BY_DAY,
) -> DataStreamWriter:
    """Raw stations to the curated table, exactly once.

    Streams that read the table see finished batches only, and each row once, also when a batch
    is repeated.
    """
    dated = with_date(projections.curate_stations(raw, as_of), "event_time")
    return append_files(dated, f"{root}/stations", checkpoint, trigger, partition_by=partition_by)


def station_topic(
    curated: DataFrame, root: str, checkpoint: str, trigger: str | None = None, topic: dict[str, str] | None = None
) -> DataStreamWriter:
    """Curated stations, keyed by station, to the hot topic.

    Read from the curated table, so rows are curated once. ``topic`` holds broker options;
    without them the topic is a folder of files.
    """
    rows = projections.hot_stations(curated)
    changelog = to_changelog(rows, ["bike_point_id"], rows.columns)
    if topic:
        return send(changelog, checkpoint, trigger, **topic)
    return send(changelog, checkpoint, trigger, "parquet", path=f"{root}/stations_topic")


def curate_arrival_stream(
    raw: DataFrame, root: str, checkpoint: str, trigger: str | None = None, as_of: str | None = None,
    partition_by: list[str] = BY_DAY,
) -> DataStreamWriter:
    """Raw arrivals to the curated table.

    Feeds come in time order, so a task writes to few days. For input in no order pass no
    partition columns, or every task leaves a file in every day.
    """
    dated = with_date(projections.curate_arrivals(raw, as_of), "event_time")
    return append_files(dated, f"{root}/arrivals", checkpoint, trigger, partition_by=partition_by)


def station_analytics(curated: DataFrame, root: str, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """Curated stations to closed hourly windows."""
    hourly = with_date(hourly_stream(curated), "window_start")
    return append_files(hourly, f"{root}/station_hourly", checkpoint, trigger, partition_by=BY_DAY)


def line_analytics(raw: DataFrame, root: str, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """Raw line status to the latest-status log."""
    status = projections.status_rows(raw)
    return latest_stream(
        status, f"{root}/line_status_latest", ["line_id"], "last_updated", LINE_TIEBREAK, checkpoint, trigger
    )


def line_topic(
    raw: DataFrame, root: str, checkpoint: str, trigger: str | None = None, topic: dict[str, str] | None = None
) -> DataStreamWriter:
    """Raw line status, keyed by line, to the hot topic."""
    rows = projections.hot_status(projections.status_rows(raw))
    changelog = to_changelog(rows, ["line_id"], rows.columns)
    if topic:
        return send(changelog, checkpoint, trigger, **topic)
    return send(changelog, checkpoint, trigger, "parquet", path=f"{root}/line_topic")


def start_all(
    spark: SparkSession, source: Callable[[str], DataFrame], root: str, checkpoint: str, commit: str = CHECKPOINT_PACE,
    discover: str = DISCOVERY, as_of: str | None = None,
) -> list[StreamingQuery]:
    """Start every layer that is not running yet: topics to raw to curated to analytics."""
    def table(name: str, schema: str) -> DataFrame:
        make_folder(spark, f"{root}/{name}")
        return stream_layer(spark, f"{root}/{name}", schema)

    def place(name: str) -> str:
        return f"{checkpoint}/{name}"

    raw, curated, analytics = f"{root}/raw", f"{root}/curated", f"{root}/analytics"
    running = [start_once(spark, w, f"raw-{name}") for name, w in ingest(source, raw, place("raw"), commit).items()]
    stations, lines, arrivals = (raw_rows(table(f"raw/{name}", RAW_SCHEMAS[name])) for name in ("stations", "lines", "arrivals"))
    curated_stations = table("curated/stations", RAW_SCHEMAS["curated_stations"])
    later = {
        "curated-stations": curate_station_stream(stations, curated, place("stations"), discover, as_of),
        "station-topic": station_topic(curated_stations, curated, place("station_topic"), discover),
        "curated-arrivals": curate_arrival_stream(arrivals, curated, place("arrivals"), discover, as_of),
        "station-hourly": station_analytics(curated_stations, analytics, place("hourly"), discover),
        "line-latest": line_analytics(lines, analytics, place("latest"), discover),
        "line-topic": line_topic(lines, analytics, place("topic"), discover),
    }
    return running + [start_once(spark, writer, name) for name, writer in later.items()]
