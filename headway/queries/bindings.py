"""The given tables seen as transport feeds, and the same views as SQL.

Every view keeps all rows of its table. ``*_SQL`` are named sub-queries for a WITH list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import SEVERITIES
from headway.functions.payload import extract_json
from headway.sinks.topics import JSON, to_messages

AS_OF = "2024-01-31 00:00:00"
WEEK = ("2024-01-08 00:00:00", "2024-01-15 00:00:00")


def typed(events: DataFrame) -> DataFrame:
    """Events with the number in their payload as ``k``, parsed once per row."""
    return extract_json(events, "props", {"k": ("$.k", "int")})


def k() -> Column:
    return F.col("k")


def station_fields() -> list[Column]:
    docks = F.floor("value").cast("int")
    ebikes = F.length("event_type")
    free = docks - k() - ebikes
    return [
        F.concat(F.lit("Dock_"), F.col("user_id")).alias("bike_point_id"),
        F.concat(F.lit("Dock "), F.col("user_id")).alias("common_name"),
        (F.lit(51.25) + k().cast("double") / F.lit(200.0)).alias("lat"),
        (F.lit(-0.6) + F.col("value") / F.lit(100.0)).alias("lon"),
        k().alias("nb_bikes"),
        ebikes.alias("nb_ebikes"),
        F.when(free > 0, free).otherwise(0).alias("nb_empty_docks"),
        docks.alias("nb_docks"),
    ]


def stations(events: DataFrame) -> DataFrame:
    """Users as docking stations: k bikes, and as many docks as the value says."""
    ingested = F.col("ts") + F.expr("INTERVAL '2 seconds'")
    return typed(events).select(*station_fields(), F.col("ts").alias("event_time"), ingested.alias("ingested_at"), "event_id")


STATIONS_SQL = """
e AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
stations AS (
  SELECT 'Dock_' || user_id AS bike_point_id, 'Dock ' || user_id AS common_name,
         CAST(51.25 AS DOUBLE) + CAST(k AS DOUBLE) / CAST(200 AS DOUBLE) AS lat,
         CAST(-0.6 AS DOUBLE) + value / CAST(100 AS DOUBLE) AS lon,
         k AS nb_bikes, CAST(length(event_type) AS INTEGER) AS nb_ebikes,
         CAST(CASE WHEN floor(value) - k - length(event_type) > 0
                   THEN floor(value) - k - length(event_type) ELSE 0 END AS INTEGER) AS nb_empty_docks,
         CAST(floor(value) AS INTEGER) AS nb_docks, ts AS event_time, event_id
  FROM e)"""

CURATED_SQL = f"""{STATIONS_SQL},
curated AS (
  SELECT *, round(CAST(CAST((CAST(nb_bikes AS DOUBLE) + nb_ebikes) * 100 / nb_docks AS VARCHAR) AS DECIMAL(38, 18)), 1)::DOUBLE AS occupancy_pct,
         nb_bikes + nb_ebikes = 0 AS is_empty, nb_empty_docks = 0 AS is_full
  FROM stations
  WHERE bike_point_id IS NOT NULL AND nb_bikes >= 0 AND nb_docks > 0
    AND lat >= CAST(51.28 AS DOUBLE) AND lat <= CAST(51.69 AS DOUBLE)
    AND lon >= CAST(-0.51 AS DOUBLE) AND lon <= CAST(0.33 AS DOUBLE))"""


def station_batch(events: DataFrame) -> DataFrame:
    """The station view in the batch vocabulary."""
    renamed = {"nb_bikes": "available_bikes", "nb_ebikes": "available_ebikes", "nb_docks": "total_docks"}
    return stations(events).withColumnsRenamed(renamed).drop("nb_empty_docks", "ingested_at")


BATCH_SQL = f"""{STATIONS_SQL},
batch AS (
  SELECT bike_point_id, common_name, nb_docks AS total_docks, nb_bikes AS available_bikes,
         nb_ebikes AS available_ebikes, lat, lon, event_time, event_id FROM stations),
enriched AS (
  SELECT bike_point_id, common_name, total_docks, available_bikes, available_ebikes,
         CAST(available_bikes AS DOUBLE) / total_docks * 100 AS occupancy_pct,
         available_bikes = 0 AS is_empty, available_bikes = total_docks AS is_full,
         CASE WHEN CAST(available_bikes AS DOUBLE) / total_docks < CAST(0.1 AS DOUBLE) THEN 'critical'
              WHEN CAST(available_bikes AS DOUBLE) / total_docks < CAST(0.3 AS DOUBLE) THEN 'low'
              WHEN CAST(available_bikes AS DOUBLE) / total_docks > CAST(0.9 AS DOUBLE) THEN 'full'
              ELSE 'normal' END AS availability_status,
         lat, lon, event_time
  FROM batch WHERE total_docks > 0 AND available_bikes >= 0 AND available_bikes <= total_docks)"""


def severity() -> Column:
    return F.floor(k() / F.lit(5)).cast("int")


def lines(events: DataFrame) -> DataFrame:
    """Event types as lines, k as severity 0 to 19."""
    texts = F.when(F.lit(False), "")
    for code, text, _ in SEVERITIES:
        texts = texts.when(severity() == code, text)
    return typed(events).select(
        F.col("event_type").alias("line_id"),
        F.initcap("event_type").alias("line_name"),
        F.lit("tube").alias("mode_id"),
        severity().alias("status_severity"),
        texts.otherwise("Planned Closure").alias("status_description"),
        F.when(severity() != 10, F.concat(F.lit("Cause "), F.floor(F.col("value") / F.lit(50.0)))).alias("reason"),
        F.col("ts").alias("event_time"),
        "event_id",
    )


LINES_SQL = """
l0 AS (SELECT *, CAST(floor(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) / 5) AS INTEGER) AS sev FROM events),
lines AS (
  SELECT event_type AS line_id, upper(event_type[1]) || event_type[2:] AS line_name, 'tube' AS mode_id,
         sev AS status_severity,
         CASE sev WHEN 0 THEN 'Special Service' WHEN 1 THEN 'Closed' WHEN 2 THEN 'Suspended'
                  WHEN 5 THEN 'Part Closure' WHEN 6 THEN 'Severe Delays' WHEN 7 THEN 'Reduced Service'
                  WHEN 9 THEN 'Minor Delays' WHEN 10 THEN 'Good Service' ELSE 'Planned Closure' END AS status_description,
         CASE WHEN sev <> 10 THEN 'Cause ' || CAST(floor(value / 50) AS BIGINT) END AS reason,
         ts AS event_time, event_id
  FROM l0)"""


def arrivals(lineitem: DataFrame) -> DataFrame:
    """Line items as predictions: the price sets the seconds to go."""
    seconds = F.floor(F.col("l_extendedprice") / F.lit(20.0)).cast("int") - 100
    expected = F.col("l_shipdate") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("arrival_id"),
        F.concat(F.lit("V"), F.col("l_suppkey")).alias("vehicle_id"),
        F.col("l_returnflag").alias("line_id"),
        F.concat(F.lit("Line "), F.col("l_returnflag")).alias("line_name"),
        F.concat(F.lit("Depot "), F.col("l_linestatus")).alias("destination_name"),
        F.concat(F.lit("S"), F.col("l_linenumber")).alias("stop_id"),
        F.concat(F.lit("Stop "), F.col("l_linenumber")).alias("stop_name"),
        F.concat(F.lit("Stop "), F.col("l_linenumber")).alias("station_name"),
        F.col("l_linestatus").alias("direction"),
        seconds.alias("time_to_station"),
        F.date_format(expected, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("expected_arrival"),
        F.col("l_shipdate").alias("event_time"),
    )


ARRIVALS_SQL = """
a0 AS (SELECT *, CAST(floor(l_extendedprice / 20) AS INTEGER) - 100 AS secs FROM lineitem),
arrivals AS (
  SELECT l_orderkey || '-' || l_linenumber AS arrival_id, 'V' || l_suppkey AS vehicle_id,
         l_returnflag AS line_id, 'Line ' || l_returnflag AS line_name, 'Depot ' || l_linestatus AS destination_name,
         'S' || l_linenumber AS stop_id, 'Stop ' || l_linenumber AS stop_name, 'Stop ' || l_linenumber AS station_name,
         l_linestatus AS direction, secs AS time_to_station,
         l_shipdate + to_seconds(secs) AS expected_time,
         strftime(l_shipdate + to_seconds(secs), '%Y-%m-%dT%H:%M:%SZ') AS expected_arrival,
         CAST(l_shipdate AS TIMESTAMP) AS event_time
  FROM a0)"""


def requests(events: DataFrame) -> DataFrame:
    """Events as API requests; errors are those the fallback had to answer."""
    return typed(events).select(
        F.concat(F.lit("/k/"), F.floor(k() / F.lit(25))).alias("endpoint"),
        F.when(F.col("event_type") == "error", "fallback").otherwise("primary").alias("source"),
        F.col("ts").alias("event_time"),
    )


REQUESTS_SQL = """
requests AS (
  SELECT '/k/' || CAST(floor(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) / 25) AS BIGINT) AS endpoint,
         CASE WHEN event_type = 'error' THEN 'fallback' ELSE 'primary' END AS source, ts AS event_time
  FROM events)"""


def topic_name() -> Column:
    """Topic per event type; signups come on one without a domain."""
    return F.when(F.col("event_type") == "signup", F.col("event_type")).otherwise(
        F.concat(F.lit("tfl.raw."), F.col("event_type"))
    )


TOPIC_SQL = "CASE WHEN event_type = 'signup' THEN event_type ELSE 'tfl.raw.' || event_type END"


def feed_kind() -> Column:
    """Which feed an event belongs to."""
    return (
        F.when(F.col("event_type").isin("view", "click"), "bike-points")
        .when(F.col("event_type") == "purchase", "bus-arrivals")
        .otherwise("line-status")
    )


def messages(events: DataFrame) -> DataFrame:
    """Events as enveloped messages of three feeds, every row once."""
    arrival = F.struct(
        F.concat(F.lit("A"), F.col("event_id")).alias("id"),
        F.concat(F.lit("V"), F.col("user_id")).alias("vehicleId"),
        F.lit("L1").alias("lineId"),
        (k() * 40 - 100).cast("string").alias("timeToStation"),
    )
    line = F.struct(
        F.col("event_type").alias("line_id"), severity().alias("status_severity"),
        F.concat(F.lit("Cause "), F.floor("value")).alias("reason"),
    )
    data = (
        F.when(feed_kind() == "bike-points", F.to_json(F.struct(*station_fields()), JSON))
        .when(feed_kind() == "bus-arrivals", F.to_json(arrival, JSON))
        .otherwise(F.to_json(line, JSON))
    )
    enveloped = to_messages(typed(events), feed_kind(), data, F.col("ts") + F.expr("INTERVAL '2 seconds'"))
    return enveloped.select(
        F.lit(None).cast("string").alias("key"), "value",
        F.concat(F.lit("tfl.raw."), feed_kind()).alias("topic"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )

