"""Latest state, ordered heads, serving documents and dashboard views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import aggregates, filters, joins, projections, ranking
from headway.plans import dashboard
from headway.plans import serving as api
from headway.queries import bindings as b
from headway.queries.registry import Tables, query
from headway.queries.statistics import (
    CUSTOMER_STATUS_SQL, HOURLY_MEANS, HOURLY_OUT, HOURLY_SQL, curated_stations, customer_status, rounded,
)
from headway.sinks.topics import to_changelog
from headway.sources.readers import small_table

LATEST_SQL = f"""{b.CURATED_SQL},
latest AS (SELECT * FROM curated QUALIFY row_number() OVER (PARTITION BY bike_point_id ORDER BY event_time DESC, event_id DESC) = 1)"""


def latest_stations(t: Tables) -> DataFrame:
    """Latest curated row per station; all other columns break ties."""
    curated = curated_stations(t)
    return ranking.latest_per_key(curated, ["bike_point_id"], "event_time", ranking.remaining(curated, "bike_point_id", "event_time"))


@query(
    "latest_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_per_key(t: Tables) -> DataFrame:
    return ranking.latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


@query(
    "latest_for_key",
    "SELECT * FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def latest_for_key(t: Tables) -> DataFrame:
    return filters.look_up(ranking.latest_per_key(t.events, ["event_type"], "ts", ["event_id"]), "event_type", "error")


@query(
    "last_n_per_key",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 100",
)
def last_n_per_key(t: Tables) -> DataFrame:
    order = [F.desc("ts"), F.desc("event_id")]
    return ranking.last_n_per_key(t.events, ["event_type"], order, 100)


@query(
    "top_full",
    f"""WITH {LATEST_SQL} SELECT bike_point_id, common_name, occupancy_pct, nb_bikes, nb_ebikes, nb_empty_docks
    FROM latest ORDER BY occupancy_pct DESC, bike_point_id LIMIT 8""",
)
def top_full(t: Tables) -> DataFrame:
    return ranking.fullest(latest_stations(t)).select(*TILE)


@query(
    "top_empty",
    f"""WITH {LATEST_SQL} SELECT bike_point_id, common_name, occupancy_pct, nb_bikes, nb_ebikes, nb_empty_docks
    FROM latest WHERE nb_bikes + nb_ebikes + nb_empty_docks > 0 ORDER BY occupancy_pct, bike_point_id LIMIT 8""",
)
def top_empty(t: Tables) -> DataFrame:
    return ranking.emptiest(latest_stations(t)).select(*TILE)


TILE = ["bike_point_id", "common_name", "occupancy_pct", "nb_bikes", "nb_ebikes", "nb_empty_docks"]


@query(
    "recent_for_key",
    f"WITH {HOURLY_SQL} {HOURLY_OUT} FROM hourly WHERE bike_point_id = 'Dock_7' ORDER BY window_start DESC LIMIT 48",
)
def recent_for_key(t: Tables) -> DataFrame:
    hourly = aggregates.station_hourly_windowed(curated_stations(t))
    return rounded(api.station_hourly(hourly, "Dock_7"), *HOURLY_MEANS)


@query(
    "next_for_key",
    f"""
    WITH {b.ARRIVALS_SQL}
    SELECT line_name, destination_name AS destination, expected_arrival, time_to_station AS time_to_station_sec, vehicle_id
    FROM arrivals WHERE stop_id = 'S3' ORDER BY expected_arrival, arrival_id, vehicle_id LIMIT 20
    """,
)
def next_for_key(t: Tables) -> DataFrame:
    return api.stop_arrivals(b.arrivals(t.lineitem), "S3")


@query(
    "history_24h",
    f"""
    WITH {b.LINES_SQL} SELECT event_id, status_description, reason, event_time FROM lines
    WHERE line_id = 'error' AND event_time >= TIMESTAMP '{b.AS_OF}' - INTERVAL 24 HOUR
    """,
)
def history_24h(t: Tables) -> DataFrame:
    rows = api.line_history(b.lines(t.events), "error", b.AS_OF, ("event_id",))
    return rows.select("event_id", "status_description", "reason", "event_time")


@query(
    "dim_fallback",
    """
    WITH f AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'hammersmith-city' WHEN 'click' THEN 'dlr'
                      ELSE event_type || '-replacement-bus' END AS line_id FROM events)
    SELECT event_id, line_id,
           CASE line_id WHEN 'hammersmith-city' THEN 'Hammersmith & City' WHEN 'dlr' THEN 'DLR'
                ELSE upper(line_id[1]) || split_part(line_id, '-', 1)[2:] || ' Replacement Bus' END AS name,
           CASE line_id WHEN 'hammersmith-city' THEN '#F3A9BB' WHEN 'dlr' THEN '#00A4A7' ELSE '#555555' END AS colour,
           CASE line_id WHEN 'hammersmith-city' THEN '#111111' ELSE '#FFFFFF' END AS ink,
           CASE line_id WHEN 'hammersmith-city' THEN 5 WHEN 'dlr' THEN 13 ELSE 99 END AS line_order
    FROM f
    """,
)
def dim_fallback(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    line = F.when(kind == "view", "hammersmith-city").when(kind == "click", "dlr")
    facts = t.events.select("event_id", line.otherwise(F.concat(kind, F.lit("-replacement-bus"))).alias("line_id"))
    return joins.with_line(facts, joins.line_dimension(t.spark)).withColumnRenamed("order", "line_order")


@query(
    "serve_status",
    f"""
    WITH {b.LINES_SQL} SELECT line_id AS id, line_name AS name, status_description AS status, reason FROM lines
    QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY event_time DESC, status_severity DESC) = 1
    """,
)
def serve_status(t: Tables) -> DataFrame:
    return api.line_status(projections.status_rows(b.lines(t.events)))


@query(
    "serve_nearby",
    f"""
    WITH {b.STATIONS_SQL}
    SELECT bike_point_id AS station_id, common_name AS name, lat, lon, coalesce(nb_bikes, 0) AS bikes_available,
           coalesce(nb_empty_docks, 0) AS docks_available, coalesce(nb_docks, 0) AS total_docks
    FROM stations
    WHERE lat BETWEEN CAST(51.5 AS DOUBLE) - CAST(10 AS DOUBLE) / 111 AND CAST(51.5 AS DOUBLE) + CAST(10 AS DOUBLE) / 111
      AND lon BETWEEN CAST(-0.3 AS DOUBLE) - CAST(10 AS DOUBLE) / 111 AND CAST(-0.3 AS DOUBLE) + CAST(10 AS DOUBLE) / 111
    """,
)
def serve_nearby(t: Tables) -> DataFrame:
    return api.stations_near(b.stations(t.events), 51.5, -0.3, 10.0)


@query(
    "serve_station",
    f"""
    WITH {b.STATIONS_SQL}
    SELECT bike_point_id AS station_id, common_name AS name, lat, lon, coalesce(nb_bikes, 0) AS bikes_available,
           coalesce(nb_empty_docks, 0) AS docks_available, coalesce(nb_docks, 0) AS total_docks
    FROM stations WHERE bike_point_id = 'Dock_7'
    """,
)
def serve_station(t: Tables) -> DataFrame:
    return api.station(b.stations(t.events), "Dock_7")


@query(
    "serve_within",
    f"""
    WITH {b.STATIONS_SQL}
    SELECT bike_point_id AS station_id, common_name AS name, lat, lon, coalesce(nb_bikes, 0) AS bikes_available,
           coalesce(nb_empty_docks, 0) AS docks_available, coalesce(nb_docks, 0) AS total_docks
    FROM stations
    WHERE lat BETWEEN CAST(51.6 AS DOUBLE) - CAST(5000 AS DOUBLE) / 111000 AND CAST(51.6 AS DOUBLE) + CAST(5000 AS DOUBLE) / 111000
      AND lon BETWEEN CAST(-0.4 AS DOUBLE) - CAST(5000 AS DOUBLE) / 111000 AND CAST(-0.4 AS DOUBLE) + CAST(5000 AS DOUBLE) / 111000
    """,
)
def serve_within(t: Tables) -> DataFrame:
    return api.stations_within(b.stations(t.events), 51.6, -0.4, 5000)


@query(
    "sample_rows",
    f"WITH {b.CURATED_SQL} SELECT least(50, count(*)) AS sampled, least(50, count(*)) AS found FROM curated",
)
def sample_rows(t: Tables) -> DataFrame:
    """Any 50 rows: how many they are, and how many of them the curated table has."""
    curated, keys = curated_stations(t), ["bike_point_id", "event_time"]
    known = curated.select(*keys).distinct().withColumn("known", F.lit(1))
    return ranking.sample_rows(curated).join(known, keys, "left").agg(F.count("*").alias("sampled"), F.count("known").alias("found"))


@query(
    "dashboard_extremes",
    f"""
    WITH {LATEST_SQL},
    x AS (SELECT * FROM (SELECT *, 'full' AS side FROM latest ORDER BY occupancy_pct DESC, bike_point_id LIMIT 8)
          UNION ALL
          SELECT * FROM (SELECT *, 'empty' AS side FROM latest WHERE nb_bikes + nb_ebikes + nb_empty_docks > 0
                         ORDER BY occupancy_pct, bike_point_id LIMIT 8))
    SELECT side, bike_point_id, common_name, occupancy_pct, nb_bikes, nb_ebikes, nb_empty_docks,
           least(greatest(occupancy_pct, 0), 100) AS bar_pct,
           CAST(floor(least(greatest(occupancy_pct, 0), 100) + 0.5) AS BIGINT) AS label_pct
    FROM x
    """,
)
def dashboard_extremes(t: Tables) -> DataFrame:
    return dashboard.station_extremes(latest_stations(t)).select("side", *TILE, "bar_pct", "label_pct")


@query(
    "dashboard_status",
    f"""
    WITH {CUSTOMER_STATUS_SQL}
    SELECT p_partkey AS id, p_name AS name, p_size AS line_order, status_severity,
           CASE WHEN status_severity IS NULL THEN 'unknown' WHEN status_severity = 10 THEN 'good'
                WHEN status_severity = 9 THEN 'minor' WHEN status_severity >= 6 THEN 'major' ELSE 'severe' END AS tone
    FROM part LEFT JOIN s ON p_partkey = line_id
    """,
)
def dashboard_status(t: Tables) -> DataFrame:
    catalogue = t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("order"))
    board = dashboard.line_board(catalogue, customer_status(t))
    return board.select("id", "name", F.col("order").alias("line_order"), "status_severity", "tone")


@query(
    "topic_catalog",
    f"""
    WITH c AS (SELECT DISTINCT CASE WHEN event_type = 'signup' THEN 'unknown' ELSE 'tfl' END AS domain,
                      {b.TOPIC_SQL} AS topic, 'Events of type ' || event_type AS description FROM events)
    SELECT domain, upper(domain) AS label, string_agg(topic || ': ' || description, '; ' ORDER BY topic) AS topics
    FROM c GROUP BY domain
    """,
)
def topic_catalog(t: Tables) -> DataFrame:
    topic = b.topic_name()
    named = t.events.select(
        projections.message_domain(topic).alias("domain"),
        F.upper(projections.message_domain(topic)).alias("label"),
        topic.alias("topic"), F.concat(F.lit("Events of type "), "event_type").alias("description"),
    )
    entries = F.transform("topics", lambda x: F.concat(x["name"], F.lit(": "), x["description"]))
    return projections.topic_catalog(named).select("domain", "label", F.array_join(entries, "; ").alias("topics"))


@query(
    "compact_by_key",
    """
    WITH l AS (SELECT *, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
               QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
    SELECT '{"user_id":' || user_id || '}' AS key,
           '{"event_type":"' || event_type || '","k":' || k || ',"note":null}' AS value, event_id AS "offset"
    FROM l WHERE event_type <> 'signup'
    """,
)
def compact_by_key(t: Tables) -> DataFrame:
    """Signups delete their key."""
    rows = b.typed(t.events).select("event_id", "user_id", "event_type", b.k().alias("k"), F.lit(None).cast("string").alias("note"))
    log = to_changelog(rows, ["user_id"], ["event_type", "k", "note"], carry=["event_id", "event_type"])
    value = F.when(F.col("event_type") != "signup", F.col("value"))
    log = log.select("key", value.alias("value"), F.col("event_id").alias("offset"))
    return ranking.compacted(log)


@query(
    "snapshot_then_live",
    f"""
    WITH m AS (SELECT event_id, ts, {b.TOPIC_SQL} AS topic FROM events)
    SELECT *, true AS snapshot FROM (SELECT * FROM m WHERE ts < TIMESTAMP '2024-01-29'
      QUALIFY row_number() OVER (PARTITION BY topic ORDER BY ts DESC, event_id DESC) <= 10)
    UNION ALL SELECT *, false FROM m WHERE ts >= TIMESTAMP '2024-01-29'
    """,
)
def snapshot_then_live(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts", b.topic_name().alias("topic"))
    return ranking.snapshot_then_live(rows, "2024-01-29 00:00:00", ["topic"], "ts", ["event_id"], 10)


SESSIONS = [("s1", "tfl.raw.view"), ("s1", "tfl.raw.error"), ("s2", "tfl.raw.error"), ("s3", "signup"), ("s3", "nothing")]


@query(
    "fan_out_join",
    f"""
    WITH m AS (SELECT event_id, {b.TOPIC_SQL} AS topic FROM events),
    s(session_id, topic) AS (VALUES {", ".join(str(row) for row in SESSIONS)})
    SELECT m.topic, event_id, session_id FROM m JOIN s ON m.topic = s.topic
    """,
)
def fan_out_join(t: Tables) -> DataFrame:
    sessions = small_table(t.spark, ["session_id", "topic"], SESSIONS)
    return joins.deliver(t.events.select("event_id", b.topic_name().alias("topic")), sessions)
