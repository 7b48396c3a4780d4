"""Streams worked off to their end, and what they leave behind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import ranking
from headway.operators.projections import curate_stations, typed_feed
from headway.plans import streams
from headway.queries import bindings as b
from headway.queries.registry import Tables, query
from headway.queries.statistics import HOURLY_MEANS, HOURLY_OUT, HOURLY_SQL, rounded
from headway.schemas import LINE_STATUS_FIELDS
from headway.session import run_dir
from headway.sinks import tables
from headway.sinks.files import folders
from headway.sinks.keyed import KeyedTable
from headway.sinks.topics import publish
from headway.sources.readers import read_topic, small_table, stream_layer, stream_topic, tail_from, tail_topic, topic_source
from headway.streaming.jobs import append_files, deliver_live, finish, hourly_stream, keep_latest, latest_stream, once_each
from headway.streaming.progress import ProgressLog, health

CLOSED_SQL = "(SELECT max(event_time) - INTERVAL 5 MINUTE FROM curated)"


def _topic(t: Tables) -> str:
    """The events as a topic: files of enveloped messages."""
    path = run_dir(t.spark, "topic")
    publish(b.messages(t.events), "parquet", path=path)
    return path


_LINE_FEED_SQL = """
SELECT event_type AS line_id, CAST(floor(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) / 5) AS INTEGER) AS status_severity,
       'Cause ' || CAST(floor(value) AS BIGINT) AS reason, ts AS event_time
FROM events WHERE event_type IN ('signup', 'error')"""


_FEED_SQL = "CASE WHEN event_type IN ('view', 'click') THEN 'bike-points' WHEN event_type = 'purchase' THEN 'bus-arrivals' ELSE 'line-status' END"
RESTART = "2024-01-15 00:00:00"


@query(
    "topic_to_raw",
    f"""
    WITH {b.STATIONS_SQL}
    SELECT 'stations' AS feed, 'Dock_' || user_id AS id, k AS amount, ts AS event_time, date_trunc('millisecond', ts + INTERVAL 2 SECOND) AS ingested_at
    FROM e WHERE event_type IN ('view', 'click')
    UNION ALL SELECT 'arrivals', 'A' || event_id, k * 40 - 100, ts, date_trunc('millisecond', ts + INTERVAL 2 SECOND) FROM e WHERE event_type = 'purchase'
    UNION ALL SELECT 'lines', event_type, CAST(floor(k / 5) AS INTEGER), ts, date_trunc('millisecond', ts + INTERVAL 2 SECOND) FROM e
    WHERE event_type IN ('signup', 'error')
    """,
)
def topic_to_raw(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "raw")
    source = topic_source(t.spark, "parquet", path=_topic(t))
    finish(*streams.ingest(source, root, run_dir(t.spark, "checkpoint")).values())
    columns = {
        "stations": ("bike_point_id", "nb_bikes"), "arrivals": ("arrival_id", "time_to_station"),
        "lines": ("line_id", "status_severity"),
    }
    parts = [
        streams.raw_rows(t.spark.read.parquet(f"{root}/{feed}")).select(
            F.lit(feed).alias("feed"), F.col(key).alias("id"), F.col(amount).alias("amount"), "event_time", "ingested_at"
        )
        for feed, (key, amount) in columns.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _broken(messages: DataFrame) -> DataFrame:
    """The messages, some without a text, cut off, without a payload, or with one that says nothing."""
    kind, whole = F.col("offset") % 11, F.col("value")
    text = F.when(kind == 1, F.lit(None)).when(kind == 2, F.left(whole, F.lit(20))).when(kind == 3, F.lit('{"event_type":"x"}'))
    return messages.withColumn("value", text.when(kind == 4, F.lit('{"data":"oops"}')).when(kind == 5, F.lit('{"data":"{}"}')).otherwise(whole))


@query(
    "ingest_rejects",
    """
    SELECT CASE WHEN event_type IN ('view', 'click') THEN 'stations' WHEN event_type = 'purchase' THEN 'arrivals' ELSE 'lines' END AS feed,
           CASE WHEN event_id % 11 IN (1, 2, 3) THEN 'envelope' WHEN event_id % 11 IN (4, 5) THEN 'payload' ELSE 'read' END AS outcome,
           count(*) AS n, CAST(sum(CASE event_id % 11 WHEN 2 THEN 20 WHEN 3 THEN 18 WHEN 4 THEN 15 WHEN 5 THEN 13 ELSE 0 END) AS BIGINT) AS reject_chars
    FROM events GROUP BY ALL
    """,
)
def ingest_rejects(t: Tables) -> DataFrame:
    """Every message of a feed is a row or a reject with its text, and no row is without a field."""
    topic, root = run_dir(t.spark, "topic"), run_dir(t.spark, "raw")
    publish(_broken(b.messages(t.events)), "parquet", path=topic)
    finish(*streams.ingest(topic_source(t.spark, "parquet", path=topic), root, run_dir(t.spark, "checkpoint")).values())
    parts = []
    for feed in ("stations", "arrivals", "lines"):
        raw = t.spark.read.parquet(f"{root}/{feed}")
        read = streams.raw_rows(raw).select(F.lit("read").alias("outcome"), F.lit(0).alias("chars"))
        failed = streams.raw_rejects(raw).select(F.col("reject_reason").alias("outcome"), F.coalesce(F.length("reject_value"), F.lit(0)).alias("chars"))
        counts = read.unionByName(failed).groupBy("outcome").agg(F.count("*").alias("n"), F.sum("chars").alias("reject_chars"))
        parts.append(counts.withColumn("feed", F.lit(feed)))
    return reduce(DataFrame.unionByName, parts)


@query("topic_once", f"SELECT event_id AS \"offset\", 'tfl.raw.' || {_FEED_SQL} AS topic, date_trunc('microsecond', ts) AS sent FROM events")
def topic_once(t: Tables) -> DataFrame:
    """A topic that delivers messages twice, at once and again days later: each counts once."""
    folder, out, checkpoint = (run_dir(t.spark, name) for name in ("topic", "once", "checkpoint"))
    messages = b.messages(t.events)
    early = F.col("timestamp") < F.lit(RESTART).cast("timestamp")
    first = messages.filter(early)
    later = messages.filter(~early)
    again = first.filter(F.col("offset") % 9 == 0)  # older than the watermark by now, but for the last seconds
    for part in (first.unionByName(first.filter(F.col("offset") % 5 == 0)), later.unionByName(later.filter(F.col("offset") % 4 == 0)).unionByName(again)):
        publish(part, "parquet", path=folder)
        finish(append_files(once_each(stream_topic(t.spark, "parquet", path=folder)), out, checkpoint))
    return t.spark.read.parquet(out).select("offset", "topic", F.col("timestamp").cast("timestamp_ntz").alias("sent"))


@query(
    "topic_tail",
    f"""SELECT event_id AS "offset", 'tfl.raw.' || {_FEED_SQL} AS topic FROM events WHERE ts >= TIMESTAMP '{RESTART}' AND event_id % 11 <> 1""",
)
def topic_tail(t: Tables) -> DataFrame:
    """A tail from a moment on, stopped and started again later: it goes on from where it first began; empty payloads are skipped."""
    folder, out, checkpoint, store = (run_dir(t.spark, name) for name in ("topic", "tail", "checkpoint", "start"))
    messages = _broken(b.messages(t.events))
    second = F.col("timestamp") >= F.lit("2024-01-20 00:00:00").cast("timestamp")
    for part, now in ((messages.filter(~second), RESTART), (messages.filter(second), "2024-01-25 00:00:00")):
        publish(part, "parquet", path=folder)
        since = tail_from(t.spark, store, now)
        finish(append_files(tail_topic(t.spark, since, "parquet", path=folder), out, checkpoint))
    return t.spark.read.parquet(out).select("offset", "topic")


@query("bounded_topic", _LINE_FEED_SQL)
def bounded_topic(t: Tables) -> DataFrame:
    messages = read_topic(t.spark, "parquet", path=_topic(t)).filter(F.col("topic") == "tfl.raw.line-status")
    return typed_feed(messages, LINE_STATUS_FIELDS).select("line_id", "status_severity", "reason", "event_time")


@query("stream_hourly", f"WITH {HOURLY_SQL} {HOURLY_OUT} FROM hourly WHERE window_end <= {CLOSED_SQL}")
def stream_hourly(t: Tables) -> DataFrame:
    out = run_dir(t.spark, "hourly")
    hourly = hourly_stream(curate_stations(b.stations(t.stream("events")), b.AS_OF))
    finish(append_files(hourly, out, run_dir(t.spark, "checkpoint")))
    return rounded(t.spark.read.parquet(out), *HOURLY_MEANS)


def _two_runs(t: Tables, first: DataFrame, second: DataFrame) -> DataFrame:
    """Hourly windows of a stream that is stopped after one part of its input and started again with the other."""
    source, out, checkpoint = (run_dir(t.spark, name) for name in ("feed", "hourly", "checkpoint"))
    for part in (first, second):
        part.write.mode("append").parquet(source)
        events = t.spark.readStream.schema(first.schema).parquet(source)
        finish(append_files(hourly_stream(curate_stations(b.stations(events), b.AS_OF)), out, checkpoint))
    return rounded(t.spark.read.parquet(out), *HOURLY_MEANS)


@query("stream_resume", f"WITH {HOURLY_SQL} {HOURLY_OUT} FROM hourly WHERE window_end <= {CLOSED_SQL}")
def stream_resume(t: Tables) -> DataFrame:
    """Stopped in between and started again: as if it had never stopped."""
    later = F.col("ts") >= F.lit(RESTART).cast("timestamp_ntz")
    return _two_runs(t, t.events.filter(~later), t.events.filter(later))


@query(
    "stream_late_rows",
    f"WITH {HOURLY_SQL} {HOURLY_OUT} FROM hourly WHERE window_start >= TIMESTAMP '{RESTART}' AND window_end <= {CLOSED_SQL}",
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Rows that come when the watermark has passed their windows change nothing."""
    later = F.col("ts") >= F.lit(RESTART).cast("timestamp_ntz")
    return _two_runs(t, t.events.filter(later), t.events.filter(~later))


@query(
    "stream_idle",
    "SELECT 'idle' AS phase, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS seen UNION ALL SELECT 'fed', count(*), count(*) FROM events "
    "UNION ALL SELECT 'idle again', count(*), CAST(0 AS BIGINT) FROM events",
)
def stream_idle(t: Tables) -> DataFrame:
    """A stream whose source is empty, then fed, then silent: rows in its table after each run, and rows its progress tells of."""
    source, out, checkpoint = (run_dir(t.spark, name) for name in ("idle", "copy", "checkpoint"))
    tables.make_folder(t.spark, source)
    schema, parts = t.events.schema, []
    for phase, fed in (("idle", False), ("fed", True), ("idle again", False)):
        if fed:
            t.events.write.mode("append").parquet(source)
        (run,) = finish(append_files(t.spark.readStream.schema(schema).parquet(source), out, checkpoint))
        seen = sum(p.numInputRows for p in run.recentProgress)
        # Which files are read is settled here, so a later run does not count.
        stored = t.spark.read.schema(schema).parquet(out) if folders(t.spark, out) else t.events.limit(0)
        parts.append(stored.agg(F.count("*").alias("n")).select(F.lit(phase).alias("phase"), "n", F.lit(seen).cast("long").alias("seen")))
    return reduce(DataFrame.unionByName, parts)


@query("stream_health", "SELECT 'copy' AS name, CAST(0 AS BIGINT) AS failed, count(*) AS rows, CAST(0 AS BIGINT) AS late_rows FROM events")
def stream_health(t: Tables) -> DataFrame:
    """Progress records of a stream, appended to a table while it runs."""
    log = ProgressLog(t.spark, run_dir(t.spark, "progress"), chunk=1)
    t.spark.streams.addListener(log)
    try:
        finish(append_files(t.stream("events"), run_dir(t.spark, "copy"), run_dir(t.spark, "checkpoint")).queryName("copy"))
        records = log.table(wait=60)
    finally:
        t.spark.streams.removeListener(log)
    return health(records).select("name", "failed", "rows", "late_rows")


@query(
    "stream_latest",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def stream_latest(t: Tables) -> DataFrame:
    out, keys, order, tiebreak = run_dir(t.spark, "latest"), ["user_id"], "ts", ["event_id"]
    finish(latest_stream(t.stream("events"), out, keys, order, tiebreak, run_dir(t.spark, "checkpoint")))
    return tables.read_latest(t.spark, out, keys, order, tiebreak)


@query(
    "stream_latest_state",
    """
    WITH s AS (SELECT 1 AS step, * FROM events WHERE event_id % 3 = 0 UNION ALL SELECT 2, * FROM events WHERE event_id % 3 < 2 UNION ALL SELECT 3, * FROM events)
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY step, user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def stream_latest_state(t: Tables) -> DataFrame:
    """The newest row per key after each of three runs; rows come in no order of time, some again."""
    source, checkpoint = run_dir(t.spark, "feed"), run_dir(t.spark, "checkpoint")
    table = KeyedTable(t.spark, run_dir(t.spark, "state"), ["user_id"], "ts", ["event_id"], buckets=16)
    rest, again = F.col("event_id") % 3, t.events.filter(F.col("event_id") % 6 == 0)
    states = []
    for step, part in enumerate((t.events.filter(rest == 0), t.events.filter(rest == 1).unionByName(again), t.events.filter(rest == 2).unionByName(again)), 1):
        part.write.mode("append").parquet(source)
        finish(keep_latest(t.spark.readStream.schema(part.schema).parquet(source), table, checkpoint))
        states.append(table.read().withColumn("step", F.lit(step)))
        if step == 2:
            table.compact()
    return reduce(DataFrame.unionByName, states)


SUBSCRIBED = {1: [("s1", "tfl.raw.view"), ("s2", "tfl.raw.view"), ("s2", "tfl.raw.error")], 2: [("s2", "tfl.raw.error"), ("s3", "tfl.raw.view"), ("s3", "tfl.raw.view")]}


@query(
    "live_delivery",
    f"""
    WITH m AS (SELECT event_id, ts, {b.TOPIC_SQL} AS topic FROM events),
    s(session_id, topic, since, until) AS (VALUES ('s1', 'tfl.raw.view', TIMESTAMP '1970-01-01', TIMESTAMP '{RESTART}'), ('s2', 'tfl.raw.view', TIMESTAMP '1970-01-01', TIMESTAMP '{RESTART}'),
        ('s2', 'tfl.raw.error', TIMESTAMP '1970-01-01', TIMESTAMP '9999-01-01'), ('s3', 'tfl.raw.view', TIMESTAMP '{RESTART}', TIMESTAMP '9999-01-01'))
    SELECT m.topic, event_id, session_id FROM m JOIN s ON m.topic = s.topic AND ts >= since AND ts < until
    """,
)
def live_delivery(t: Tables) -> DataFrame:
    """Messages as they come, to those subscribed then: subscriptions change between batches."""
    source, out, checkpoint, subscribed = (run_dir(t.spark, name) for name in ("live", "sent", "checkpoint", "subscriptions"))
    messages = t.events.select("event_id", "ts", b.topic_name().alias("topic"))
    later = F.col("ts") >= F.lit(RESTART).cast("timestamp_ntz")
    for n, part in ((1, messages.filter(~later)), (2, messages.filter(later))):
        tables.replace(small_table(t.spark, ["session_id", "topic"], SUBSCRIBED[n]), subscribed)
        part.write.mode("append").parquet(source)
        live = t.spark.readStream.schema(part.schema).parquet(source)
        finish(deliver_live(live, lambda: t.spark.read.parquet(subscribed), out, checkpoint))
    return tables.read_batches(t.spark, out).select("topic", "event_id", "session_id")


@query(
    "stream_fan_out",
    f"""
    WITH {b.CURATED_SQL}
    SELECT 'table' AS sink, bike_point_id, count(*) AS n, CAST(sum(nb_bikes) AS BIGINT) AS bikes FROM curated GROUP BY ALL
    UNION ALL SELECT 'topic', bike_point_id, count(*), CAST(sum(nb_bikes) AS BIGINT) FROM curated GROUP BY ALL
    """,
)
def stream_fan_out(t: Tables) -> DataFrame:
    """The curated table and the keyed topic hold the same stations."""
    root = run_dir(t.spark, "curated")
    finish(streams.curate_station_stream(b.stations(t.stream("events")), root, run_dir(t.spark, "checkpoint"), as_of=b.AS_OF, partition_by=[]))
    stored = t.spark.read.parquet(f"{root}/stations")
    finish(streams.station_topic(stream_layer(t.spark, f"{root}/stations", stored.schema), root, run_dir(t.spark, "checkpoint")))
    table = stored.select(F.lit("table").alias("sink"), "bike_point_id", "nb_bikes")
    topic = t.spark.read.parquet(f"{root}/stations_topic").select(
        F.lit("topic").alias("sink"), F.get_json_object("key", "$.bike_point_id").alias("bike_point_id"),
        F.get_json_object("value", "$.nb_bikes").cast("int").alias("nb_bikes"),
    )
    both = table.unionByName(topic)
    return both.groupBy("sink", "bike_point_id").agg(F.count("*").alias("n"), F.sum("nb_bikes").alias("bikes"))


@query(
    "stream_arrivals",
    f"""
    WITH {b.ARRIVALS_SQL}
    SELECT arrival_id, vehicle_id, stop_id, greatest(time_to_station, 0) AS time_to_station_seconds,
           time_to_station <= 0 AS has_arrived, event_time
    FROM arrivals WHERE time_to_station BETWEEN -60 AND 3600
    """,
)
def stream_arrivals(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "curated")
    raw = b.arrivals(t.stream("lineitem"))
    finish(streams.curate_arrival_stream(raw, root, run_dir(t.spark, "checkpoint"), as_of=b.AS_OF, partition_by=[]))
    return t.spark.read.parquet(f"{root}/arrivals").select(
        "arrival_id", "vehicle_id", "stop_id", "time_to_station_seconds", "has_arrived", "event_time"
    )


@query(
    "stream_to_analytics",
    f"""
    WITH {HOURLY_SQL}, {b.LINES_SQL},
    last AS (SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY event_time DESC, status_severity DESC, status_description DESC, reason DESC) = 1)
    SELECT 'hourly' AS kind, bike_point_id AS id, window_start AS seen, CAST(sample_count AS BIGINT) AS amount
    FROM hourly WHERE window_end <= {CLOSED_SQL}
    UNION ALL SELECT 'latest', line_id, event_time, status_severity FROM last
    UNION ALL SELECT 'topic', line_id, date_trunc('millisecond', event_time), status_severity FROM last
    """,
)
def stream_to_analytics(t: Tables) -> DataFrame:
    """Curated table to hourly windows; raw lines to the latest log and its keyed topic."""
    spark, root = t.spark, run_dir(t.spark, "analytics")
    curated, out = run_dir(spark, "curated"), run_dir(spark, "checkpoint")
    lines = b.lines(t.stream("events"))
    finish(
        append_files(curate_stations(b.stations(t.stream("events")), b.AS_OF), curated, f"{out}/curated"),
        streams.line_analytics(lines, root, f"{out}/latest"),
        streams.line_topic(lines, root, f"{out}/topic"),
    )
    schema = spark.read.parquet(curated).schema
    finish(streams.station_analytics(stream_layer(spark, curated, schema), root, f"{out}/hourly"))

    hourly = spark.read.parquet(f"{root}/station_hourly").select(
        F.lit("hourly").alias("kind"), F.col("bike_point_id").alias("id"), F.col("window_start").alias("seen"),
        F.col("sample_count").alias("amount"),
    )
    latest = tables.read_latest(spark, f"{root}/line_status_latest", ["line_id"], "last_updated", streams.LINE_TIEBREAK)
    latest = latest.select(
        F.lit("latest").alias("kind"), F.col("line_id").alias("id"), F.col("last_updated").alias("seen"),
        F.col("status_severity").cast("long").alias("amount"),
    )
    topic = spark.read.parquet(f"{root}/line_topic")
    value = F.from_json("value", "status_severity INT, last_updated TIMESTAMP_NTZ")
    topic = topic.select(F.get_json_object("key", "$.line_id").alias("id"), value.alias("v"))
    topic = topic.select(F.lit("topic").alias("kind"), "id", F.col("v.last_updated").alias("seen"),
                         F.col("v.status_severity").cast("long").alias("amount"))
    topic = ranking.latest_per_key(topic, ["id"], "seen", ["amount"])
    return hourly.unionByName(latest).unionByName(topic)
