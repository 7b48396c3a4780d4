"""Hourly statistics, roll-ups, quality gates and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.text_time import hour_of
from headway.operators import aggregates, filters, joins, monitoring, projections, quality, ranking, sequences
from headway.plans import batch
from headway.queries import bindings as b
from headway.queries.registry import Tables, query

_STATS_SQL = """
       avg(nb_bikes) AS avg_bikes, avg(nb_ebikes) AS avg_ebikes,
       CAST(sum(CAST(round(occupancy_pct * 10) AS BIGINT)) AS DOUBLE) / (count(occupancy_pct) * 10) AS avg_occupancy_pct,
       min(nb_bikes) AS min_bikes, max(nb_bikes) AS max_bikes,
       count(*) FILTER (WHERE is_empty) AS empty_count, count(*) FILTER (WHERE is_full) AS full_count,
       count(*) AS sample_count"""

HOURLY_SQL = f"""{b.CURATED_SQL},
hourly AS (
  SELECT bike_point_id, common_name, date_trunc('hour', event_time) AS window_start,
         date_trunc('hour', event_time) + INTERVAL 1 HOUR AS window_end, {_STATS_SQL}
  FROM curated GROUP BY ALL)"""

HOURLY_OUT = """
SELECT bike_point_id, common_name, window_start, window_end, round(avg_bikes, 6) AS avg_bikes,
       round(avg_ebikes, 6) AS avg_ebikes, round(avg_occupancy_pct, 6) AS avg_occupancy_pct,
       min_bikes, max_bikes, empty_count, full_count, sample_count"""

HOURLY_MEANS = ("avg_bikes", "avg_ebikes", "avg_occupancy_pct")


def _one_digit(mean: str) -> str:
    """Half-up on the decimal text of a mean, as the hourly table rounds."""
    return f"round(CAST(CAST({mean} AS VARCHAR) AS DECIMAL(38, 18)), 1)::DOUBLE AS {mean}"


HOURLY_ROUNDED_OUT = f"""
SELECT bike_point_id, common_name, window_start, window_end, {_one_digit('avg_bikes')}, {_one_digit('avg_ebikes')},
       {_one_digit('avg_occupancy_pct')}, min_bikes, max_bikes, empty_count, full_count, sample_count"""


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Means in 6 digits, so the order of summation does not show."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def curated_stations(t: Tables) -> DataFrame:
    return projections.curate_stations(b.stations(t.events), b.AS_OF)


@query("hourly_tumble", f"WITH {HOURLY_SQL} {HOURLY_OUT} FROM hourly")
def hourly_tumble(t: Tables) -> DataFrame:
    return rounded(aggregates.station_hourly_windowed(curated_stations(t)), *HOURLY_MEANS)


@query("hourly_batch", f"WITH {HOURLY_SQL} {HOURLY_ROUNDED_OUT} FROM hourly")
def hourly_batch(t: Tables) -> DataFrame:
    return aggregates.station_hourly_batch(curated_stations(t))


LOCATED_SQL = """
SELECT bike_point_id, common_name, date_trunc('hour', event_time) AS hour_start, lat, lon,
       round(avg(occupancy_pct), 6) AS avg_occupancy_pct, min(available_bikes) AS min_available_bikes,
       max(available_bikes) AS max_available_bikes, round(avg(available_bikes), 6) AS avg_available_bikes,
       max(total_docks) AS total_docks, count(*) FILTER (WHERE is_empty) AS empty_count,
       count(*) FILTER (WHERE is_full) AS full_count, count(*) AS observation_count"""


@query("hourly_with_dims", f"WITH {b.BATCH_SQL} {LOCATED_SQL} FROM enriched GROUP BY ALL")
def hourly_with_dims(t: Tables) -> DataFrame:
    enriched = projections.enrich_stations(b.station_batch(t.events))
    return rounded(aggregates.station_hourly_located(enriched), "avg_occupancy_pct", "avg_available_bikes")


@query(
    "network_totals",
    f"""
    WITH {b.CURATED_SQL},
    latest AS (SELECT * FROM curated QUALIFY row_number() OVER (PARTITION BY bike_point_id ORDER BY event_time DESC, event_id DESC) = 1)
    SELECT count(*) AS stations, CAST(sum(nb_bikes + nb_ebikes) AS BIGINT) AS bikes,
           CAST(sum(nb_bikes + nb_ebikes + nb_empty_docks) AS BIGINT) AS docks
    FROM latest
    """,
)
def network_totals(t: Tables) -> DataFrame:
    kept = filters.plausible_stations(b.stations(t.events))
    return aggregates.network_totals(ranking.latest_per_key(kept, ["bike_point_id"], "event_time", ["event_id"]))


def customer_status(t: Tables) -> DataFrame:
    """Each customer's newest order as a line status; the catalogue of parts has more ids than there are customers."""
    newest = ranking.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    severity = F.when(F.col("o_orderpriority") == "1-URGENT", 10).otherwise(F.substring("o_orderpriority", 1, 1).cast("int") + 4)
    return newest.select(F.col("o_custkey").alias("line_id"), severity.alias("status_severity"))


CUSTOMER_STATUS_SQL = """
s AS (
  SELECT o_custkey AS line_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE CAST(o_orderpriority[1] AS INTEGER) + 4 END AS status_severity
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


@query(
    "status_rollup",
    f"""
    WITH {CUSTOMER_STATUS_SQL}
    SELECT count(*) FILTER (WHERE status_severity = 10) AS good,
           count(*) FILTER (WHERE line_id IS NOT NULL AND status_severity <> 10) AS issues,
           count(*) FILTER (WHERE line_id IS NULL) AS unknown
    FROM part LEFT JOIN s ON p_partkey = line_id
    """,
)
def status_rollup(t: Tables) -> DataFrame:
    merged = joins.with_catalogue(t.part.select("p_partkey"), customer_status(t), "p_partkey", "line_id")
    return aggregates.status_rollup(merged, "line_id")


def health(t: Tables) -> DataFrame:
    return aggregates.table_health({
        "raw": (t.events, "ts"), "curated": (t.orders, "o_orderdate"), "analytics": (t.lineitem, "l_shipdate"),
    })


@query(
    "table_health",
    f"""
    WITH h AS (
      SELECT 'raw' AS table_name, count(*) AS row_count, max(ts) AS newest, 120 AS lim FROM events
      UNION ALL SELECT 'curated', count(*), max(o_orderdate), 180 FROM orders
      UNION ALL SELECT 'analytics', count(*), max(l_shipdate), 3600 FROM lineitem)
    SELECT table_name, row_count, CAST(newest AS TIMESTAMP) AS newest,
           CAST(floor(epoch(TIMESTAMP '{b.AS_OF}')) - floor(epoch(CAST(newest AS TIMESTAMP))) AS BIGINT) AS lag_seconds,
           CAST(lim AS BIGINT) AS limit_seconds,
           floor(epoch(TIMESTAMP '{b.AS_OF}')) - floor(epoch(CAST(newest AS TIMESTAMP))) <= lim AS within_limit
    FROM h
    """,
)
def table_health(t: Tables) -> DataFrame:
    return quality.layer_lag(health(t), b.AS_OF)


@query("source_counts", f"WITH {b.REQUESTS_SQL} SELECT endpoint, source, count(*) AS requests FROM requests GROUP BY ALL")
def source_counts(t: Tables) -> DataFrame:
    return aggregates.count_by(b.requests(t.events), "endpoint", "source")


_GATES_SQL = f"""
m AS (
  SELECT count(*) FILTER (WHERE event_time > TIMESTAMP '{b.AS_OF}' - INTERVAL 2 HOUR) AS fresh,
         count(*) FILTER (WHERE bike_point_id IS NULL) AS missing,
         count(DISTINCT bike_point_id) FILTER (WHERE event_time > TIMESTAMP '{b.AS_OF}' - INTERVAL 24 HOUR) AS complete
  FROM src)
SELECT 'freshness' AS "check", fresh AS value, CAST(1 AS BIGINT) AS min, CAST(NULL AS BIGINT) AS max, fresh >= 1 AS passed FROM m
UNION ALL SELECT 'nulls', missing, NULL, 0, missing <= 0 FROM m
UNION ALL SELECT 'completeness', complete, 100, NULL, complete >= 100 FROM m"""


@query(
    "quality_gates",
    f"""WITH src AS (SELECT ts AS event_time, CASE WHEN event_type <> 'signup' THEN user_id END AS bike_point_id FROM events), {_GATES_SQL}""",
)
def quality_gates(t: Tables) -> DataFrame:
    """Signups carry no key here, so the null gate closes."""
    keyed = t.events.withColumn("key", F.when(F.col("event_type") != "signup", F.col("user_id")))
    return quality.gates(quality.measure(keyed, "key", "ts", b.AS_OF))


@query("gates_of_curated", f"WITH {b.CURATED_SQL}, src AS (SELECT * FROM curated), {_GATES_SQL}")
def gates_of_curated(t: Tables) -> DataFrame:
    return batch.gate_table(curated_stations(t), "bike_point_id", "event_time", b.AS_OF)


SLIDING_SQL = f"""{b.REQUESTS_SQL},
panes AS (SELECT endpoint, source, date_trunc('minute', event_time) - to_minutes(unnest([0, 1, 2, 3, 4])) AS window_start FROM requests)"""

RATIO_SQL = f"""{SLIDING_SQL},
ratios AS (
  SELECT endpoint, window_start, count(*) FILTER (WHERE source = 'fallback') AS fallbacks, count(*) AS requests,
         (count(*) FILTER (WHERE source = 'fallback') / CAST(300 AS DOUBLE))
           / greatest(count(*) / CAST(300 AS DOUBLE), CAST(0.001 AS DOUBLE)) AS ratio
  FROM panes GROUP BY ALL)"""


def _ratios(t: Tables) -> DataFrame:
    """Five minutes wide, every minute."""
    return monitoring.fallback_ratio(b.requests(t.events), ["endpoint"], F.col("source") == "fallback", "event_time")


@query(
    "request_rate",
    f"""
    WITH {b.REQUESTS_SQL},
    w AS (SELECT endpoint, source, unnest([0, 1, 2, 3, 4]) AS i, event_time FROM requests)
    SELECT endpoint, source, date_trunc('minute', event_time) - to_minutes(i) AS window_start,
           date_trunc('minute', event_time) - to_minutes(i) + INTERVAL 5 MINUTE AS window_end,
           count(*) AS requests, round(count(*) / CAST(300 AS DOUBLE), 6) AS rate
    FROM w GROUP BY ALL
    """,
)
def request_rate(t: Tables) -> DataFrame:
    rows = monitoring.rate(b.requests(t.events), ["endpoint", "source"], "event_time")
    return rounded(rows, "rate")


@query(
    "fallback_ratio",
    f"""
    WITH {RATIO_SQL}
    SELECT endpoint, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
           fallbacks, requests, round(ratio, 6) AS ratio FROM ratios
    """,
)
def fallback_ratio(t: Tables) -> DataFrame:
    return rounded(_ratios(t).select("endpoint", "window_start", "window_end", "fallbacks", "requests", "ratio"), "ratio")


@query(
    "sustained_breach",
    f"""
    WITH {RATIO_SQL},
    n AS (SELECT endpoint, window_start, epoch(window_start) / 60
                 - row_number() OVER (PARTITION BY endpoint ORDER BY window_start) AS run
          FROM ratios WHERE ratio > CAST(0.2 AS DOUBLE))
    SELECT endpoint, min(window_start) AS since, max(window_start) AS until, count(*) AS steps
    FROM n GROUP BY endpoint, run HAVING count(*) >= 10
    """,
)
def sustained_breach(t: Tables) -> DataFrame:
    return monitoring.sustained_fallback(_ratios(t), ["endpoint"])


@query(
    "silent_outage",
    f"""
    WITH {SLIDING_SQL},
    w AS (SELECT window_start, count(*) FILTER (WHERE source = 'primary') AS good FROM panes GROUP BY ALL),
    n AS (SELECT window_start, epoch(window_start) / 60 - row_number() OVER (ORDER BY window_start) AS run FROM w WHERE good = 0)
    SELECT 'all' AS scope, min(window_start) AS since, max(window_start) AS until, count(*) AS steps
    FROM n GROUP BY run HAVING count(*) >= 15
    """,
)
def silent_outage(t: Tables) -> DataFrame:
    """Traffic that only the fallback answers, for a quarter of an hour."""
    return monitoring.silent_outage(b.requests(t.events), F.col("source") == "primary", "event_time")


@query(
    "mtbf_by_key",
    f"""
    WITH {b.LINES_SQL},
    p AS (SELECT *, lag(status_severity <> 10) OVER (PARTITION BY line_id ORDER BY event_time, event_id) AS was_bad FROM lines)
    SELECT line_id, count(*) AS disruptions,
           round((epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1e6 / nullif(count(*) - 1, 0), 3) AS mean_seconds_between
    FROM p WHERE status_severity <> 10 AND NOT coalesce(was_bad, false) GROUP BY 1
    """,
)
def mtbf_by_key(t: Tables) -> DataFrame:
    gaps = sequences.mean_gap_between_starts(
        b.lines(t.events), ["line_id"], "event_time", ["event_id"], F.col("status_severity") != 10,
    )
    return gaps.withColumn("mean_seconds_between", F.round("mean_seconds_between", 3))


@query(
    "reason_share",
    f"""
    WITH {b.LINES_SQL},
    c AS (SELECT line_id, reason, count(*) AS occurrences FROM lines GROUP BY ALL)
    SELECT line_id, reason, occurrences, round(occurrences / sum(occurrences) OVER (PARTITION BY line_id), 6) AS share FROM c
    """,
)
def reason_share(t: Tables) -> DataFrame:
    return rounded(sequences.share_within(b.lines(t.events), "line_id", "reason"), "share")


@query(
    "churn_by_area",
    f"""
    WITH {b.STATIONS_SQL},
    p AS (SELECT event_type, ts, abs(k - lag(k) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS moved FROM e)
    SELECT event_type AS area, date_trunc('hour', ts) AS hour, CAST(coalesce(sum(moved), 0) AS BIGINT) AS moved
    FROM p GROUP BY ALL
    """,
)
def churn_by_area(t: Tables) -> DataFrame:
    readings = b.typed(t.events).select(
        "user_id", "ts", "event_id", F.col("event_type").alias("area"), b.k().alias("bikes")
    )
    return sequences.churn(readings, "user_id", "area", hour_of(F.col("ts")), "bikes", "ts", ["event_id"])


@query(
    "arrival_drift",
    """
    WITH p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT v.event_id, v.ts, min(p.ts) AS observed, round((epoch_us(min(p.ts)) - epoch_us(v.ts)) / 1e6, 3) AS drift_seconds
    FROM (SELECT * FROM events WHERE event_type = 'view') v LEFT JOIN p ON p.user_id = v.user_id AND p.ts >= v.ts
    GROUP BY v.event_id, v.ts
    """,
)
def arrival_drift(t: Tables) -> DataFrame:
    """From each view to the user's next purchase, as from a prediction to the arrival."""
    rows = t.events.filter(F.col("event_type").isin("view", "purchase"))
    timed = sequences.with_next_time(rows, ["user_id"], "ts", F.col("event_type") == "purchase")
    drift = (F.unix_micros(F.col("next_time").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / F.lit(1e6)
    views = timed.filter(F.col("event_type") == "view")
    return views.select("event_id", "ts", F.col("next_time").alias("observed"), F.round(drift, 3).alias("drift_seconds"))


@query(
    "distinct_rolling_day",
    """
    WITH h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    r AS (SELECT user_id, hour + to_hours(i) AS hour FROM h, range(24) AS w(i))
    SELECT hour, count(DISTINCT user_id) AS distinct_keys, true AS sketch_agrees FROM r GROUP BY 1
    """,
)
def distinct_rolling_day(t: Tables) -> DataFrame:
    """Distinct users of the last 24 hours, hour by hour, and whether the merged sketches are within 5 % of them."""
    exact = aggregates.rolling_distinct_exact(t.events, "user_id", "ts")
    sketched = aggregates.rolling_distinct(t.events, "user_id", "ts", bits=14).withColumnRenamed("distinct_keys", "sketched")
    near = F.abs(F.col("sketched") - F.col("distinct_keys")) <= F.greatest(F.lit(1.0), F.col("distinct_keys") * F.lit(0.05))
    return exact.join(sketched, "hour", "left").select("hour", "distinct_keys", F.coalesce(near, F.lit(False)).alias("sketch_agrees"))
