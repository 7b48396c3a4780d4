"""Alerts, drift and leases of running streams, against what a table of the same rows says."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.queries import bindings as b
from headway.queries.registry import Tables, query
from headway.queries.statistics import RATIO_SQL, SLIDING_SQL
from headway.session import run_dir
from headway.streaming.continuous import fallback_alerts, observed_next, outage_alerts
from headway.streaming.jobs import append_files, finish
from headway.streaming.leases import start_leased

#: A run is over when the watermark (5 minutes behind) passes its last window's end by a step and a half.
OVER_SQL = "max(window_start) + INTERVAL 5 MINUTE + INTERVAL 90 SECOND <= (SELECT max(ts) - INTERVAL 5 MINUTE FROM events)"


def _kept(t: Tables, alerts: DataFrame) -> DataFrame:
    """What a stream has put out when its input is worked off."""
    out = run_dir(t.spark, "alerts")
    finish(append_files(alerts, out, run_dir(t.spark, "checkpoint")))
    return t.spark.read.schema(alerts.schema).parquet(out)


@query(
    "stream_breach_alerts",
    f"""
    WITH {RATIO_SQL},
    n AS (SELECT endpoint, window_start, epoch(window_start) / 60
                 - row_number() OVER (PARTITION BY endpoint ORDER BY window_start) AS run
          FROM ratios WHERE ratio > CAST(0.2 AS DOUBLE))
    SELECT endpoint, min(window_start) AS since, max(window_start) AS until, count(*) AS steps
    FROM n GROUP BY endpoint, run HAVING count(*) >= 10 AND {OVER_SQL}
    """,
)
def stream_breach_alerts(t: Tables) -> DataFrame:
    requests = b.requests(t.stream("events"))
    return _kept(t, fallback_alerts(requests, ["endpoint"], F.col("source") == "fallback", "event_time"))


@query(
    "stream_outage_alerts",
    f"""
    WITH {SLIDING_SQL},
    w AS (SELECT window_start, count(*) FILTER (WHERE source = 'primary') AS good FROM panes GROUP BY ALL),
    n AS (SELECT window_start, epoch(window_start) / 60 - row_number() OVER (ORDER BY window_start) AS run FROM w WHERE good = 0)
    SELECT 'all' AS scope, min(window_start) AS since, max(window_start) AS until, count(*) AS steps
    FROM n GROUP BY run HAVING count(*) >= 15 AND {OVER_SQL}
    """,
)
def stream_outage_alerts(t: Tables) -> DataFrame:
    return _kept(t, outage_alerts(b.requests(t.stream("events")), F.col("source") == "primary", "event_time"))


#: Predictions whose horizon the watermark has passed for long: their rows are out.
SETTLED_SQL = "(SELECT max(ts) - INTERVAL 30 HOUR FROM events)"


@query(
    "stream_arrival_drift",
    f"""
    WITH p AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase')
    SELECT v.event_id, v.ts, min(p.ts) AS observed, round((epoch_us(min(p.ts)) - epoch_us(v.ts)) / 1e6, 3) AS drift_seconds
    FROM (SELECT * FROM events WHERE event_type = 'view') v
    LEFT JOIN p ON p.user_id = v.user_id AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 12 HOUR
    WHERE v.ts < {SETTLED_SQL} GROUP BY v.event_id, v.ts
    """,
)
def stream_arrival_drift(t: Tables) -> DataFrame:
    """From each view to the user's next purchase within half a day, both read as streams."""
    views, purchases = (t.stream("events").filter(F.col("event_type") == kind) for kind in ("view", "purchase"))
    drift = _kept(t, observed_next(views, purchases, ["user_id"], "event_id", "ts", "12 hours"))
    settled = t.events.agg((F.max("ts") - F.expr("INTERVAL '30 hours'")).alias("until")).scalar()
    return drift.filter(F.col("ts") < settled).select("event_id", "ts", "observed", F.round("drift_seconds", 3).alias("drift_seconds"))


@query(
    "leased_stream",
    """
    SELECT 'started' AS phase, 'first' AS holder, count(*) AS n FROM events UNION ALL SELECT 'refused', 'first', count(*) FROM events
    UNION ALL SELECT 'taken over', 'second', count(*) FROM events
    """,
)
def leased_stream(t: Tables) -> DataFrame:
    """Two sessions start one stream: the second is told who runs it, and takes over when the first has stopped. Rows count once."""
    out, checkpoint, root = (run_dir(t.spark, name) for name in ("copy", "checkpoint", "leases"))
    other = Tables(t.spark.newSession(), t.folder)
    found = []

    def start(tables: Tables, holder: str):
        writer = append_files(tables.stream("events"), out, checkpoint, trigger="1 second")
        query, claim = start_leased(tables.spark, writer, "copy", root, holder, term=30.0)
        found.append(claim.holder)
        return query

    def counted(phase: str) -> DataFrame:
        holder = F.lit(found[-1]).alias("holder")
        return t.spark.read.schema(t.events.schema).parquet(out).agg(F.count("*").alias("n")).select(F.lit(phase).alias("phase"), holder, "n")

    first = start(t, "first")
    try:
        first.processAllAvailable()
        parts = [counted("started")]
        refused = start(other, "second")
        parts.append(counted("refused" if refused is None else "started twice"))
    finally:
        first.stop()
    second = _when_free(lambda: start(other, "second"))
    try:
        second.processAllAvailable()
        parts.append(counted("taken over"))
    finally:
        second.stop()
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _when_free(start, seconds: float = 60.0):
    """A stopped stream's lease is free a moment later, at the latest when its term is over."""
    until = time.monotonic() + seconds
    while (query := start()) is None:
        if time.monotonic() > until:
            raise TimeoutError("the lease was not given back")
        time.sleep(0.2)
    return query
