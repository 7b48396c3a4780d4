"""Typing, filtering and curating feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions import measures as m
from headway.functions import text_time as tt
from headway.functions.payload import cast_rejects, extract_json, int_of, pairs_to_map
from headway.operators import filters, projections
from headway.operators.access import decide
from headway.plans import dashboard
from headway.queries import bindings as b
from headway.queries.registry import Tables, query
from headway.schemas import conforms, schema_for, violations
from headway.sources import documents, generator

WEEK_SQL = f"event_time >= TIMESTAMP '{b.WEEK[0]}' AND event_time < TIMESTAMP '{b.WEEK[1]}'"


@query(
    "json_extract_typed",
    """
    WITH d AS (SELECT event_id, '{"outer": ' || props || ', "eventId": "' || event_id || '", "label": "[' || event_type || ']"}' AS doc FROM events)
    SELECT event_id, TRY_CAST(json_extract_string(doc, '$.eventId') AS BIGINT) AS id,
           TRY_CAST(json_extract_string(doc, '$.outer.k') AS INTEGER) AS k,
           TRY_CAST(json_extract_string(doc, '$.label') AS INTEGER) AS not_a_number,
           json_extract_string(doc, '$.label') AS label,
           CAST(NULL AS VARCHAR) AS nested, json_extract_string(doc, '$.missing') AS missing
    FROM d
    """,
)
def json_extract_typed(t: Tables) -> DataFrame:
    doc = F.concat(
        F.lit('{"outer": '), "props", F.lit(', "eventId": "'), "event_id",
        F.lit('", "label": "['), "event_type", F.lit(']"}'),
    )
    fields = {
        "id": ("$.eventId", "bigint"),
        "k": ("$.outer.k", "int"),
        "not_a_number": ("$.label", "int"),
        "label": ("$.label", "string"),
        "nested": ("$.outer", "string"),
        "missing": ("$.missing", "string"),
    }
    return extract_json(t.events.select("event_id", doc.alias("doc")), "doc", fields).drop("doc")


@query(
    "json_cast_rejects",
    """
    SELECT count(*) FILTER (WHERE event_type = 'error') AS n,
           count(*) FILTER (WHERE TRY_CAST(event_type AS DOUBLE) IS NULL) AS kind FROM events
    """,
)
def json_cast_rejects(t: Tables) -> DataFrame:
    number = F.when(F.col("event_type") == "error", "n/a").otherwise(b.k().cast("string"))
    doc = F.to_json(F.struct(number.alias("n"), F.col("event_type").alias("kind")))
    return cast_rejects(b.typed(t.events).select(doc.alias("doc")), "doc", {"n": ("$.n", "int"), "kind": ("$.kind", "double")})


@query(
    "quality_filter_box",
    f"WITH {b.CURATED_SQL} SELECT bike_point_id, lat, lon, nb_bikes, nb_docks, event_time FROM curated",
)
def quality_filter_box(t: Tables) -> DataFrame:
    kept = filters.plausible_stations(b.stations(t.events))
    return kept.select("bike_point_id", "lat", "lon", "nb_bikes", "nb_docks", "event_time")


@query(
    "occupancy_flags",
    f"""
    WITH {b.CURATED_SQL}
    SELECT bike_point_id, event_time, occupancy_pct, is_empty, is_full,
           least(greatest(occupancy_pct, 0), 100) AS bar_pct,
           CAST(floor(least(greatest(occupancy_pct, 0), 100) + 0.5) AS BIGINT) AS label_pct,
           TIMESTAMP '{b.AS_OF}' AS processed_at
    FROM curated
    """,
)
def occupancy_flags(t: Tables) -> DataFrame:
    curated = projections.curate_stations(b.stations(t.events), b.AS_OF)
    return dashboard.bar(curated).select(
        "bike_point_id", "event_time", "occupancy_pct", "is_empty", "is_full", "bar_pct", "label_pct", "processed_at"
    )


@query(
    "hot_path_stations",
    f"""
    WITH {b.CURATED_SQL}
    SELECT bike_point_id, common_name, nb_bikes, nb_ebikes, nb_empty_docks, occupancy_pct, is_empty, is_full,
           date_trunc('millisecond', event_time) AS event_time
    FROM curated
    """,
)
def hot_path_stations(t: Tables) -> DataFrame:
    return projections.hot_stations(projections.curate_stations(b.stations(t.events), b.AS_OF))


@query(
    "arrival_plausible",
    f"""
    WITH {b.ARRIVALS_SQL}
    SELECT arrival_id, vehicle_id, line_id, stop_id, direction,
           greatest(time_to_station, 0) AS time_to_station_seconds, time_to_station <= 0 AS has_arrived, event_time
    FROM arrivals WHERE arrival_id IS NOT NULL AND vehicle_id IS NOT NULL AND time_to_station BETWEEN -60 AND 3600
    """,
)
def arrival_plausible(t: Tables) -> DataFrame:
    return projections.curate_arrivals(b.arrivals(t.lineitem), b.AS_OF).select(
        "arrival_id", "vehicle_id", "line_id", "stop_id", "direction", "time_to_station_seconds", "has_arrived",
        "event_time",
    )


@query("interval_curate_status", f"WITH {b.BATCH_SQL} SELECT * FROM enriched WHERE {WEEK_SQL}")
def interval_curate_status(t: Tables) -> DataFrame:
    return projections.enrich_stations(filters.in_interval(b.station_batch(t.events), "event_time", *b.WEEK))


@query(
    "arrival_bucket",
    f"""
    WITH {b.ARRIVALS_SQL}
    SELECT arrival_id, stop_id, station_name, line_name, destination_name, time_to_station,
           expected_time AS expected_arrival,
           CASE WHEN time_to_station <= 60 THEN 'due' WHEN time_to_station <= 300 THEN 'arriving'
                ELSE 'scheduled' END AS arrival_status, event_time
    FROM arrivals
    """,
)
def arrival_bucket(t: Tables) -> DataFrame:
    return projections.enrich_arrivals(b.arrivals(t.lineitem))


@query(
    "rag_status",
    f"""
    WITH {b.LINES_SQL}
    SELECT line_id, line_name, status_description AS status, reason,
           CASE status_description WHEN 'Good Service' THEN 'green' WHEN 'Minor Delays' THEN 'amber'
                WHEN 'Reduced Service' THEN 'amber' ELSE 'red' END AS severity, event_time
    FROM lines
    """,
)
def rag_status(t: Tables) -> DataFrame:
    return projections.enrich_lines(b.lines(t.events).withColumnRenamed("status_description", "status"))


@query(
    "status_tone",
    """
    SELECT p_partkey, p_size,
           CASE WHEN p_size IS NULL THEN 'unknown' WHEN p_size = 10 THEN 'good' WHEN p_size = 9 THEN 'minor'
                WHEN p_size >= 6 THEN 'major' ELSE 'severe' END AS tone,
           CASE WHEN p_size IS NULL THEN 'unknown' WHEN p_size >= 19 THEN 'planned' WHEN p_size = 10 THEN 'good'
                WHEN p_size = 9 THEN 'minor' WHEN p_size >= 6 THEN 'major' ELSE 'severe' END AS intended_tone
    FROM part
    """,
)
def status_tone(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t.part.select(
        "p_partkey", size, m.status_tone(size).alias("tone"), m.status_tone(size, planned_first=True).alias("intended_tone")
    )


@query(
    "typed_times",
    """
    SELECT o_orderkey, o_orderdate + INTERVAL 90 MINUTE AS parsed,
           date_trunc('hour', o_orderdate + INTERVAL 90 MINUTE) AS hour_start,
           date_trunc('hour', o_orderdate + INTERVAL 90 MINUTE) + INTERVAL 1 HOUR AS hour_end,
           strftime(o_orderdate + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:00:00') AS hour_key,
           CAST(NULL AS TIMESTAMP) AS unreadable
    FROM orders
    """,
)
def typed_times(t: Tables) -> DataFrame:
    text = F.date_format(tt.shift(F.col("o_orderdate"), "90 minutes"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parsed = t.orders.select("o_orderkey", "o_orderpriority", tt.to_time(text).alias("parsed"))
    hour = tt.hour_of(F.col("parsed"))
    return parsed.select(
        "o_orderkey", "parsed", hour.alias("hour_start"), tt.shift(hour, "1 hour").alias("hour_end"),
        tt.hour_key(F.col("parsed")).alias("hour_key"), tt.to_time(F.col("o_orderpriority")).alias("unreadable"),
    )


@query(
    "topic_envelope",
    f"""
    SELECT CASE WHEN event_type = 'signup' THEN 'unknown' ELSE 'tfl' END AS domain, {b.TOPIC_SQL} AS topic,
           epoch_us(ts) // 1000 AS timestamp, props AS data
    FROM events WHERE event_type IN ('signup', 'view', 'click')
    """,
)
def topic_envelope(t: Tables) -> DataFrame:
    rows = t.events.select(b.topic_name().alias("topic"), F.col("ts").alias("timestamp"), F.col("props").alias("value"))
    return projections.delivery_envelope(filters.allowed(rows, "topic", ["signup", "tfl.raw.view", "tfl.raw.click"]))


@query(
    "kv_array_to_map",
    """
    SELECT event_id, CAST(floor(value) AS INTEGER) AS docks,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS bikes, 0 AS ebikes, 0 AS text_count,
           event_type AS kind, CAST(4 AS INTEGER) AS keys
    FROM events
    """,
)
def kv_array_to_map(t: Tables) -> DataFrame:
    def pair(key: str, value) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    pairs = F.array(
        pair("NbBikes", F.lit(-1)), pair("NbDocks", F.floor("value")), pair("NbBikes", b.k()),
        pair("Kind", F.col("event_type")), pair("Note", F.lit("n/a")),
    )
    rows = b.typed(t.events).select("event_id", pairs.alias("pairs"))
    items = F.col("pairs")
    return rows.select(
        "event_id", int_of(items, "NbDocks").alias("docks"), int_of(items, "NbBikes").alias("bikes"),
        int_of(items, "NbEBikes").alias("ebikes"), int_of(items, "Note").alias("text_count"),
        F.try_element_at(pairs_to_map(items), F.lit("Kind")).alias("kind"),
        F.size(pairs_to_map(items)).alias("keys"),
    )


def _line_documents(t: Tables) -> DataFrame:
    """Each event as a line document with two statuses; signups have none."""
    status = F.array(
        F.struct(F.col("event_type").alias("statusSeverityDescription"), F.lit(None).cast("string").alias("reason")),
        F.struct(F.col("props").alias("statusSeverityDescription"), F.col("event_type").alias("reason")),
    )
    statuses = F.when(F.col("event_type") == "signup", F.array().cast(
        "array<struct<statusSeverityDescription:string,reason:string>>")).otherwise(status)
    doc = F.struct(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("name"), statuses.alias("lineStatuses")
    )
    rows = t.events.select("event_id", "ts", F.to_json(doc).alias("doc"))
    return documents.parse_documents(rows, "doc", documents.LINE_DOCUMENT)


@query(
    "nested_docs",
    """
    SELECT CAST(user_id AS VARCHAR) AS line_id, event_type AS line_name,
           CASE WHEN event_type = 'signup' THEN 'Unknown' ELSE event_type END AS status, '' AS reason, ts AS event_time
    FROM events
    """,
)
def nested_docs(t: Tables) -> DataFrame:
    return documents.line_rows(_line_documents(t), F.col("ts"))


@query(
    "nested_docs_history",
    """
    SELECT CAST(user_id AS VARCHAR) AS line_id, 0 AS position, ts AS timestamp, event_type AS status, CAST(NULL AS VARCHAR) AS reason
    FROM events WHERE event_type <> 'signup'
    UNION ALL
    SELECT CAST(user_id AS VARCHAR), 1, ts, props, event_type FROM events WHERE event_type <> 'signup'
    """,
)
def nested_docs_history(t: Tables) -> DataFrame:
    return documents.line_history_rows(_line_documents(t), F.col("ts"))


@query(
    "nested_docs_stations",
    """
    SELECT CAST(user_id AS VARCHAR) AS bike_point_id, event_type AS common_name,
           CAST(floor(value) AS INTEGER) AS total_docks,
           TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS available_bikes, 0 AS available_ebikes,
           value AS lat, -value AS lon, ts AS event_time
    FROM events
    """,
)
def nested_docs_stations(t: Tables) -> DataFrame:
    def pair(key: str, value) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("string").alias("value"))

    doc = F.struct(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("commonName"),
        F.col("value").alias("lat"), (-F.col("value")).alias("lon"),
        F.array(pair("NbDocks", F.floor("value")), pair("NbBikes", b.k())).alias("additionalProperties"),
    )
    rows = b.typed(t.events).select("ts", F.to_json(doc).alias("doc"))
    return documents.station_rows(documents.parse_documents(rows, "doc", documents.STATION_DOCUMENT), F.col("ts"))


@query(
    "nested_docs_arrivals",
    """
    WITH d AS (SELECT event_id, unnest([event_type, 'x' || user_id, 'a' || event_id, '']) AS t FROM events),
    r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY t) AS rn FROM d)
    SELECT event_id, string_agg(t, '|' ORDER BY t) AS soonest FROM r WHERE rn <= 3 GROUP BY event_id
    """,
)
def nested_docs_arrivals(t: Tables) -> DataFrame:
    times = [F.col("event_type"), F.concat(F.lit("x"), "user_id"), F.concat(F.lit("a"), "event_id"), F.lit(None).cast("string")]
    stop = F.array(*[F.struct(x.alias("expectedArrival")) for x in times])
    head = documents.soonest_arrivals(F.col("stop"), 3)
    texts = F.transform(head, lambda a: F.coalesce(a["expectedArrival"], F.lit("")))
    return t.events.select("event_id", stop.alias("stop")).select("event_id", F.array_join(texts, "|").alias("soonest"))


@query(
    "list_elements",
    """
    SELECT event_type, count(*) AS n FROM (
      SELECT unnest(['stop ' || event_type, 'shared']) AS event_type FROM events) GROUP BY 1
    """,
)
def list_elements(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" stop "), "event_type", F.lit(" , shared"))
    return (
        t.events.select(F.explode(tt.split_list(text)).alias("event_type"))
        .groupBy("event_type").agg(F.count("*").alias("n"))
    )


@query(
    "rejects_split",
    """
    SELECT event_id, event_type IN ('error', 'signup') AS rejected,
           CASE WHEN event_type NOT IN ('error', 'signup') THEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
    FROM events
    """,
)
def rejects_split(t: Tables) -> DataFrame:
    """Errors carry a cut-off payload and signups none at all."""
    payload = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("{"), "props"))
        .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
        .otherwise(F.col("props"))
    )
    rows = t.events.select("event_id", payload.alias("payload"))
    bad = F.col(documents.CORRUPT).isNotNull() | F.col("payload").isNull()
    parsed = documents.parse_documents(rows, "payload", "k INT")
    return parsed.select("event_id", bad.alias("rejected"), "k")


@query(
    "schema_conformance",
    """
    SELECT 'arrival_id' AS field, CAST(0 AS BIGINT) AS nulls UNION ALL SELECT 'vehicle_id', count(*) FILTER (WHERE l_returnflag = 'R') FROM lineitem
    UNION ALL SELECT 'line_id', 0 UNION ALL SELECT 'line_name', 0 UNION ALL SELECT 'stop_id', count(*) FILTER (WHERE l_quantity > 25) FROM lineitem
    UNION ALL SELECT 'time_to_station', 0 UNION ALL SELECT 'event_time', 0
    UNION ALL SELECT 'ingested_at', count(*) FILTER (WHERE l_linestatus = 'O') FROM lineitem
    """,
)
def schema_conformance(t: Tables) -> DataFrame:
    return violations(_holed_arrivals(t), schema_for("bus_arrival"))


@query(
    "schema_conforming_rows",
    """
    SELECT l_returnflag AS line_id, count(*) AS n FROM lineitem
    WHERE NOT (l_returnflag = 'R') AND NOT (l_quantity > 25) AND NOT (l_linestatus = 'O') GROUP BY 1
    """,
)
def schema_conforming_rows(t: Tables) -> DataFrame:
    kept = conforms(_holed_arrivals(t), schema_for("bus_arrival"))
    return kept.groupBy("line_id").agg(F.count("*").alias("n"))


def _holed_arrivals(t: Tables) -> DataFrame:
    """Arrivals with some required fields missing."""
    return t.lineitem.select(
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey").cast("string")).alias("vehicle_id"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("arrival_id"),
        F.col("l_returnflag").alias("line_id"), F.col("l_returnflag").alias("line_name"),
        F.when(F.col("l_quantity") <= 25, F.col("l_linenumber").cast("string")).alias("stop_id"),
        F.col("l_linenumber").alias("time_to_station"), F.col("l_shipdate").alias("event_time"),
        F.when(F.col("l_linestatus") != "O", F.col("l_shipdate")).alias("ingested_at"),
    )


_FEED_LINES_SQL = ", ".join("'" + line[0] + "'" for line in generator.FEED_LINES)
_FEED_NAMES_SQL = ", ".join("'" + line[1] + "'" for line in generator.FEED_LINES)
_WEIGHTED_SQL = ", ".join(str(code) for code, _, weight in generator.SEVERITIES for _ in range(weight))


def _draw_sql(field: str, choices: int) -> str:
    return f"CAST('0x' || substr(md5(event_id || ':0:{field}'), 1, 8) AS BIGINT) % {choices}"


@query(
    "generated_feed",
    f"""
    WITH d AS (
      SELECT event_id AS feed_id, {_draw_sql('line', 14)} + 1 AS li,
             [{_WEIGHTED_SQL}][{_draw_sql('severity', 12)} + 1] AS status_severity,
             TIMESTAMP '{b.AS_OF}' - to_hours(CAST({_draw_sql('hours', 73)} AS INTEGER)) AS seen
      FROM events)
    SELECT feed_id, [{_FEED_LINES_SQL}][li] AS line_id, status_severity,
           CASE WHEN status_severity <> 10 THEN 'Test disruption reason for ' || [{_FEED_NAMES_SQL}][li] END AS reason,
           strftime(seen - INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') AS valid_from,
           strftime(seen, '%Y-%m-%dT%H:%M:%S+00:00') AS ingested_at
    FROM d
    """,
)
def generated_feed(t: Tables) -> DataFrame:
    feed = generator.line_status_feed(t.events, "event_id", b.AS_OF)
    return feed.select("feed_id", "line_id", "status_severity", "reason", "valid_from", "ingested_at")


@query(
    "retention_filter",
    f"SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{b.AS_OF}' - INTERVAL 7 DAY",
)
def retention_filter(t: Tables) -> DataFrame:
    return filters.keep_since(t.events, "ts", b.AS_OF, 7).select("event_id", "ts")


_ACTIONS_SQL = """
CASE WHEN k < 20 THEN 'LOAD_TABLE' WHEN k < 40 THEN 'UPDATE_TABLE' WHEN k < 60 THEN 'CREATE_CATALOG'
     WHEN k < 80 THEN 'ADD_TABLE_SNAPSHOT' ELSE 'CREATE_PRINCIPAL' END"""


@query(
    "access_audit",
    f"""
    WITH {b.STATIONS_SQL},
    r AS (SELECT event_id, {_ACTIONS_SQL} AS action, event_type IN ('click', 'purchase') AS engine,
                 event_type IN ('view', 'purchase') AS viewer, event_type = 'signup' AS admin,
                 value < 50 AS scoped FROM e)
    SELECT event_id, action,
           (admin AND action <> 'CREATE_PRINCIPAL')
           OR (engine AND scoped AND action IN ('LOAD_TABLE', 'UPDATE_TABLE', 'ADD_TABLE_SNAPSHOT'))
           OR (viewer AND scoped AND action = 'LOAD_TABLE') AS allowed
    FROM r
    """,
)
def access_audit(t: Tables) -> DataFrame:
    def table(catalog: str) -> Column:
        parent = F.struct(F.lit("CATALOG").alias("type"), F.lit(catalog).alias("name"))
        return F.struct(F.lit("TABLE").alias("type"), F.lit("t").alias("name"), F.array(parent).alias("parents"))

    none = F.filter(F.array(table("raw")), lambda x: F.lit(False))
    targets = (
        F.when(F.col("value") < 5, none)
        .when(F.col("value") < 20, F.array(table("raw")))
        .when(F.col("value") < 50, F.array(table("curated"), table("analytics")))
        .otherwise(F.array(table("curated"), table("shadow")))
    )
    kind = F.col("event_type")
    roles = (
        F.when(kind == "click", F.array(F.lit("trino_service")))
        .when(kind == "view", F.array(F.lit("polaris_viewer")))
        .when(kind == "signup", F.array(F.lit("service_admin")))
        .when(kind == "purchase", F.array(F.lit("polaris_viewer"), F.lit("trino_service")))
        .otherwise(F.array().cast("array<string>"))
    )
    action = (
        F.when(b.k() < 20, "LOAD_TABLE").when(b.k() < 40, "UPDATE_TABLE").when(b.k() < 60, "CREATE_CATALOG")
        .when(b.k() < 80, "ADD_TABLE_SNAPSHOT").otherwise("CREATE_PRINCIPAL")
    )
    rows = b.typed(t.events).select("event_id", roles.alias("roles"), action.alias("action"), targets.alias("targets"))
    return decide(rows).select("event_id", "action", "allowed")
