"""Declared record and table schemas, and checks of rows against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _fields(nullable: bool, **columns: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind, nullable) for name, kind in columns.items()]


# Envelope of every message, as a broker source delivers it.
TOPIC_SCHEMA = "key STRING, value STRING, topic STRING, `offset` BIGINT, timestamp TIMESTAMP"

# Payload fields per feed as {column: (path, type)}; renames camelCase on the way.
LINE_STATUS_FIELDS = {
    "line_id": ("$.line_id", "string"),
    "line_name": ("$.line_name", "string"),
    "mode_id": ("$.mode_id", "string"),
    "status_severity": ("$.status_severity", "int"),
    "status_description": ("$.status_description", "string"),
    "reason": ("$.reason", "string"),
}
ARRIVAL_FIELDS = {
    "arrival_id": ("$.id", "string"),
    "vehicle_id": ("$.vehicleId", "string"),
    "line_id": ("$.lineId", "string"),
    "line_name": ("$.lineName", "string"),
    "destination_name": ("$.destinationName", "string"),
    "stop_id": ("$.naptanId", "string"),
    "stop_name": ("$.stationName", "string"),
    "platform_name": ("$.platformName", "string"),
    "direction": ("$.direction", "string"),
    "expected_arrival": ("$.expectedArrival", "string"),
    "time_to_station": ("$.timeToStation", "int"),
    "current_location": ("$.currentLocation", "string"),
    "towards": ("$.towards", "string"),
}
STATION_FIELDS = {
    "bike_point_id": ("$.bike_point_id", "string"),
    "common_name": ("$.common_name", "string"),
    "lat": ("$.lat", "double"),
    "lon": ("$.lon", "double"),
    "nb_bikes": ("$.nb_bikes", "int"),
    "nb_ebikes": ("$.nb_ebikes", "int"),
    "nb_empty_docks": ("$.nb_empty_docks", "int"),
    "nb_docks": ("$.nb_docks", "int"),
}

def _raw_schema(fields: dict[str, tuple[str, str]]) -> str:
    columns = ", ".join(f"{name} {kind}" for name, (_, kind) in fields.items())
    # Partition columns come last and in the order of the folders: a stream of files goes by position.
    return (
        f"{columns}, event_time TIMESTAMP_NTZ, ingested_at TIMESTAMP_NTZ, reject_reason STRING, reject_value STRING, "
        "outcome STRING, event_date DATE"
    )


# Tables that later layers read as streams.
RAW_SCHEMAS = {
    "stations": _raw_schema(STATION_FIELDS),
    "arrivals": _raw_schema(ARRIVAL_FIELDS),
    "lines": _raw_schema(LINE_STATUS_FIELDS),
    "curated_stations": (
        "bike_point_id STRING, common_name STRING, lat DOUBLE, lon DOUBLE, nb_bikes INT, nb_ebikes INT, "
        "nb_empty_docks INT, nb_docks INT, occupancy_pct DOUBLE, is_empty BOOLEAN, is_full BOOLEAN, "
        "event_time TIMESTAMP_NTZ, processed_at TIMESTAMP_NTZ, event_date DATE"
    ),
}

# Declared records: required columns are not nullable.
TEXT, WHOLE, REAL, TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()
RECORDS = {
    "bike_occupancy": T.StructType(_fields(
        False, bike_point_id=TEXT, common_name=TEXT, lat=REAL, lon=REAL, nb_bikes=WHOLE, nb_ebikes=WHOLE,
        nb_empty_docks=WHOLE, nb_docks=WHOLE, event_time=TIME, ingested_at=TIME,
    )),
    "bus_arrival": T.StructType(
        _fields(
            False, arrival_id=TEXT, vehicle_id=TEXT, line_id=TEXT, line_name=TEXT, stop_id=TEXT,
            time_to_station=WHOLE, event_time=TIME, ingested_at=TIME,
        )
        + _fields(True, destination_name=TEXT, stop_name=TEXT, direction=TEXT)
    ),
}


def schema_for(record: str) -> T.StructType:
    return RECORDS[record]


def from_record_millis(df: DataFrame, *columns: str) -> DataFrame:
    """Declared times travel as epoch milliseconds; turn them into zone-less timestamps."""
    return df.withColumns({c: F.timestamp_millis(c).cast("timestamp_ntz") for c in columns})


def missing_columns(df: DataFrame, schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.name not in df.columns]


def conforms(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows whose required columns are all present."""
    required = [f.name for f in schema if not f.nullable]
    return df.dropna(subset=required)


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per required column with its number of NULLs, from one scan."""
    required = [f.name for f in schema if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    return counts.unpivot([], required, "field", "nulls")
