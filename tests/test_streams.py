"""Streams: parity with batch, restart, late and idle input, several sinks, health."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from headway.operators import aggregates, projections, ranking
from headway.plans import streams
from headway.queries import bindings as b
from headway.queries.registry import Tables
from headway.sinks import tables
from headway.sinks.topics import publish
from headway.sources.readers import stream_layer, stream_topic, tail_topic, topic_source
from headway.streaming import jobs
from headway.streaming.progress import ProgressLog

T0 = dt.datetime(2024, 1, 1)
CURATED = (
    "bike_point_id STRING, common_name STRING, nb_bikes INT, nb_ebikes INT, occupancy_pct DOUBLE, "
    "is_empty BOOLEAN, is_full BOOLEAN, event_time TIMESTAMP_NTZ"
)


def curated(spark, *minutes):
    data = [("a", "A", i, 0, 1.0, False, False, T0 + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
    return spark.createDataFrame(data, CURATED)


def feed(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run_hourly(spark, folder):
    hourly = jobs.hourly_stream(stream_layer(spark, f"{folder}/in", CURATED))
    return jobs.finish(jobs.append_files(hourly, f"{folder}/out", f"{folder}/ck"))[0]


def counts(spark, folder):
    return rows(spark.read.parquet(f"{folder}/out"), "window_start", "sample_count")


def hour(n):
    return T0 + dt.timedelta(hours=n)


def test_windows_close_once_across_restarts(spark, folder):
    feed(curated(spark, 1, 59, 61), f"{folder}/in")
    run_hourly(spark, folder)
    assert counts(spark, folder) == []  # hour 0 may still get rows for 5 minutes
    feed(curated(spark, 30, 66), f"{folder}/in")
    run_hourly(spark, folder)
    assert counts(spark, folder) == [(hour(0), 3)]
    feed(curated(spark, 40, 100), f"{folder}/in")  # minute 40 is late now
    query = run_hourly(spark, folder)
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 1
    run_hourly(spark, folder)  # nothing new: nothing happens
    assert counts(spark, folder) == [(hour(0), 3)]
    feed(curated(spark, 300), f"{folder}/in")
    run_hourly(spark, folder)
    assert counts(spark, folder) == [(hour(0), 3), (hour(1), 3)]


def test_batch_and_stream_agree(spark, folder):
    """Same function both ways, whatever the number of files per batch."""
    events = Tables(spark, DATA).events
    raw = b.stations(events)
    raw.repartitionByRange(6, "event_time").sortWithinPartitions("event_time").write.parquet(f"{folder}/in")
    source = stream_layer(spark, f"{folder}/in", raw.schema)
    jobs.finish(jobs.append_files(jobs.hourly_stream(projections.curate_stations(source, b.AS_OF)), f"{folder}/out", f"{folder}/ck"))
    batch = aggregates.station_hourly_windowed(projections.curate_stations(raw, b.AS_OF))
    limit = raw.filter("nb_docks > 0").agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=30)
    columns = ["bike_point_id", "window_start", "min_bikes", "max_bikes", "sample_count"]
    closed = F.col("window_end") <= F.lit(limit)
    assert rows(spark.read.parquet(f"{folder}/out").filter(closed), *columns) == rows(batch.filter(closed), *columns)


@pytest.mark.parametrize("files", ["1", "3"])
def test_latest_whatever_the_batches(spark, folder, files):
    events = Tables(spark, DATA).events
    events.repartition(4, F.rand(int(files))).write.parquet(f"{folder}/in")
    args = (["user_id"], "ts", ["event_id"])
    stream = stream_layer(spark, f"{folder}/in", events.schema, maxFilesPerTrigger=files)
    jobs.finish(jobs.latest_stream(stream, f"{folder}/log", *args, f"{folder}/ck"))
    want = rows(ranking.latest_per_key(events, *args), "event_id")
    assert rows(tables.read_latest(spark, f"{folder}/log", *args), "event_id") == want


def test_resume_after_stop(spark, folder):
    """A paced stream stopped midway goes on from its checkpoint without loss or doubling."""
    events = Tables(spark, DATA).events
    events.repartition(8).write.parquet(f"{folder}/in")
    source = lambda: stream_layer(spark, f"{folder}/in", events.schema, maxFilesPerTrigger="2")
    sinks = {"all": jobs.to_files(lambda df: df, f"{folder}/all"),
             "errors": jobs.to_files(lambda df: df.filter("event_type = 'error'"), f"{folder}/errors", ["event_type"])}
    query = jobs.fan_out(source(), sinks, f"{folder}/ck", "1 second").start()
    while not query.recentProgress and query.isActive:
        time.sleep(0.2)
    query.stop()
    assert query.exception() is None
    jobs.finish(jobs.fan_out(source(), sinks, f"{folder}/ck"))
    assert rows(tables.read_batches(spark, f"{folder}/all"), "event_id") == rows(events, "event_id")
    errors = events.filter("event_type = 'error'")
    assert rows(tables.read_batches(spark, f"{folder}/errors"), "event_id") == rows(errors, "event_id")


def test_repeated_batch_changes_nothing(spark, folder):
    events = Tables(spark, DATA).events
    events.write.parquet(f"{folder}/in")
    for checkpoint in ("ck1", "ck2"):  # a lost checkpoint delivers batch 0 again
        stream = stream_layer(spark, f"{folder}/in", events.schema)
        jobs.finish(jobs.fan_out(stream, {"all": jobs.to_files(lambda df: df, f"{folder}/all")}, f"{folder}/{checkpoint}"))
    assert tables.read_batches(spark, f"{folder}/all").count() == events.count()


def test_three_feeds(spark, folder):
    data = [
        ("tfl.raw.line-status", '{"data": "{\\"line_id\\": \\"dlr\\", \\"status_severity\\": \\"9\\", \\"reason\\": {\\"a\\": 1}}", "ingested_at": "2024-01-01T00:00:01Z"}'),
        ("tfl.raw.bus-arrivals", '{"data": "{\\"id\\": \\"7\\", \\"vehicleId\\": \\"V\\", \\"timeToStation\\": -5}", "ingested_at": "?"}'),
        ("tfl.raw.bike-points", '{"data": "{\\"bike_point_id\\": \\"b\\", \\"lat\\": \\"51.5\\", \\"nb_docks\\": 3.0}"}'),
        ("tfl.raw.bike-points", "broken"), ("elsewhere", "{}"),
    ]
    messages = spark.createDataFrame([(None, v, t, i, T0) for i, (t, v) in enumerate(data)],
                                     "key STRING, value STRING, topic STRING, offset BIGINT, timestamp TIMESTAMP")
    messages.write.parquet(f"{folder}/topic")
    source = topic_source(spark, "parquet", path=f"{folder}/topic")
    jobs.finish(*streams.ingest(source, f"{folder}/raw", f"{folder}/ck").values())
    read = lambda t: spark.read.parquet(f"{folder}/raw/{t}")
    assert rows(read("lines"), "line_id", "status_severity", "reason", "event_time", "ingested_at") == [
        ("dlr", 9, None, T0, T0 + dt.timedelta(seconds=1))]
    assert rows(read("arrivals"), "arrival_id", "vehicle_id", "time_to_station", "ingested_at") == [("7", "V", -5, None)]
    assert rows(read("stations"), "bike_point_id", "lat", "nb_docks") == sorted([("b", 51.5, None), (None, None, None)], key=repr)


def test_hot_topic_keeps_latest(spark, folder):
    lines = spark.createDataFrame(
        [("dlr", "DLR", "dlr", s, "x", None, T0 + dt.timedelta(seconds=s)) for s in (1, 3, 2)],
        "line_id STRING, line_name STRING, mode_id STRING, status_severity INT, status_description STRING, reason STRING, event_time TIMESTAMP_NTZ")
    lines.write.parquet(f"{folder}/in")
    stream = stream_layer(spark, f"{folder}/in", lines.schema)
    jobs.finish(streams.line_analytics(stream, folder, f"{folder}/ck"))
    log = tables.read_latest(spark, f"{folder}/line_status_latest", ["line_id"], "last_updated", streams.LINE_TIEBREAK)
    assert rows(log, "line_id", "status_severity") == [("dlr", 3)]
    jobs.finish(streams.line_topic(stream, folder, f"{folder}/ck2"))
    assert spark.read.parquet(f"{folder}/line_topic").filter('key = \'{"line_id":"dlr"}\'').count() == 3


def test_tail_skips_the_past_and_empty_payloads(spark, folder):
    data = [(None, "old", "t", 0, T0), (None, "new", "t", 1, T0 + dt.timedelta(hours=2)), (None, None, "t", 2, T0 + dt.timedelta(hours=3))]
    spark.createDataFrame(data, "key STRING, value STRING, topic STRING, offset BIGINT, timestamp TIMESTAMP").write.parquet(f"{folder}/t")
    tail = tail_topic(spark, str(hour(1)), "parquet", path=f"{folder}/t")
    jobs.finish(jobs.append_files(tail, f"{folder}/out", f"{folder}/ck"))
    assert rows(spark.read.parquet(f"{folder}/out"), "value") == [("new",)]


def test_one_run_per_name_and_health(spark, folder):
    log = ProgressLog(spark, f"{folder}/progress", chunk=2)
    spark.streams.addListener(log)
    try:
        feed(curated(spark, 1), f"{folder}/in")
        make = lambda n: jobs.append_files(
            stream_layer(spark, f"{folder}/in", CURATED), f"{folder}/out", f"{folder}/ck{n}", "1 second")
        first = jobs.start_once(spark, make(1), "copy")
        assert jobs.is_running(spark, "copy")
        assert jobs.start_once(spark, make(2), "copy").id == first.id
        first.processAllAvailable()
        first.stop()
        assert not jobs.is_running(spark, "copy")

        def fail(batch, batch_id):
            raise RuntimeError("sink is down")

        broken = stream_layer(spark, f"{folder}/in", CURATED).writeStream.foreachBatch(fail).queryName("broken")
        with pytest.raises(Exception, match="sink is down"):
            jobs.finish(broken.option("checkpointLocation", f"{folder}/ck3").trigger(availableNow=True))
        deadline = time.time() + 20
        while time.time() < deadline and not any(not r[-1] for r in log.table().collect()):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    health = log.table(20).groupBy("name", "completed").agg(F.sum("rows").alias("rows"))
    assert ("copy", True, 1) in rows(health) and ("broken", False, 0) in rows(health)


def test_sessions_get_stream_messages(spark, folder):
    from headway.operators.joins import deliver

    spark.createDataFrame([("t1", 1), ("t2", 2)], "topic STRING, n INT").write.parquet(f"{folder}/m")
    sessions = spark.createDataFrame([("a", "t1"), ("b", "t1")], "session_id STRING, topic STRING")
    stream = deliver(stream_layer(spark, f"{folder}/m", "topic STRING, n INT"), sessions)
    jobs.finish(jobs.append_files(stream, f"{folder}/out", f"{folder}/ck"))
    assert rows(spark.read.parquet(f"{folder}/out"), "session_id", "n") == [("a", 1), ("b", 1)]


def test_all_layers_live(spark, folder):
    """Topic to raw to curated to analytics, running side by side."""
    events = Tables(spark, DATA).events
    publish(b.messages(events), "parquet", path=f"{folder}/topic")
    start = lambda: streams.start_all(
        spark, topic_source(spark, "parquet", path=f"{folder}/topic"), folder, f"{folder}/ck", "1 second", "1 second", b.AS_OF)
    queries = start()
    try:
        assert {q.id for q in start()} == {q.id for q in queries} and len(queries) == 9
        want = projections.curate_stations(b.stations(events.filter("event_type IN ('view', 'click')")), b.AS_OF)
        newest = want.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=5)
        hourly = aggregates.station_hourly_windowed(want).filter(F.col("window_end") <= F.lit(newest))
        deadline = time.time() + 120
        while time.time() < deadline:
            for query in queries:
                if query.exception():
                    raise query.exception()
            done = os.path.isdir(f"{folder}/analytics/station_hourly/_spark_metadata")
            if done and spark.read.schema(hourly.schema).parquet(f"{folder}/analytics/station_hourly").count() >= hourly.count():
                break
            time.sleep(1)
    finally:
        for query in queries:
            query.stop()
    columns = ["bike_point_id", "window_start", "min_bikes", "max_bikes", "empty_count", "full_count", "sample_count"]
    assert rows(spark.read.parquet(f"{folder}/analytics/station_hourly"), *columns) == rows(hourly, *columns)
    latest = tables.read_latest(spark, f"{folder}/analytics/line_status_latest", ["line_id"], "last_updated", streams.LINE_TIEBREAK)
    assert latest.count() == 2
    assert spark.read.parquet(f"{folder}/analytics/line_topic").count() == events.filter("event_type IN ('signup', 'error')").count()
    arrivals = events.filter("event_type = 'purchase'").count()
    assert spark.read.parquet(f"{folder}/raw/arrivals").count() == arrivals


def test_topic_disorder_is_five_seconds(spark, folder):
    """Counting per minute on a topic: 4 seconds late is in time, 6 seconds late is not."""
    schema = "key STRING, value STRING, topic STRING, offset BIGINT, timestamp TIMESTAMP"

    def send(*seconds):
        data = [(None, "x", "t", i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate(seconds)]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/t")

    def run():
        timed = jobs.topic_time(stream_topic(spark, "parquet", path=f"{folder}/t"))
        counted = timed.groupBy(F.window("timestamp", "1 minute")).count().select("window.start", "count")
        return jobs.finish(jobs.append_files(counted, f"{folder}/out", f"{folder}/ck"))[0]

    send(30, 64)
    run()
    send(59, 66)  # the watermark is at 59 s: the first minute is open
    run()
    send(58, 130)  # now it is at 61 s: the first minute is closed
    query = run()
    assert sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators) == 1
    got = {r[0].replace(tzinfo=None): r[1] for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {T0: 2, T0 + dt.timedelta(minutes=1): 2}


def broken(spark):
    """Messages of one feed: two readable ones, and one of each kind that isn't."""
    texts = [
        '{"data":"{\\"line_id\\":\\"l1\\",\\"status_severity\\":\\"5\\"}","ingested_at":"2024-01-01T00:00:02.000"}', '{"data":"{\\"status_severity\\":\\"x\\",\\"reason\\":\\"r\\"}"}',
        None, "", '{"data":', '{"event_type":"x"}', '{"data":"oops"}', '{"data":"{}"}', '{"data":"{\\"status_severity\\":\\"x\\"}"}', "[1]",
    ]
    data = [(None, text, "tfl.raw.line-status", n, T0 + dt.timedelta(seconds=n)) for n, text in enumerate(texts)]
    return spark.createDataFrame(data, "key string, value string, topic string, offset long, timestamp timestamp")


def test_every_message_is_a_row_or_a_reject(spark, folder):
    publish(broken(spark), "parquet", path=f"{folder}/topic")
    writer = streams.ingest(topic_source(spark, "parquet", path=f"{folder}/topic"), f"{folder}/raw", f"{folder}/ck")["lines"]
    (query,) = jobs.finish(writer)
    raw = spark.read.parquet(f"{folder}/raw/lines")
    assert rows(streams.raw_rows(raw), "line_id", "reason") == sorted([("l1", None), (None, "r")], key=repr)
    assert rows(streams.raw_rejects(raw), "reject_reason", "reject_value") == sorted([
        ("envelope", None), ("envelope", ""), ("envelope", '{"data":'), ("envelope", '{"event_type":"x"}'), ("envelope", "[1]"),
        ("payload", '{"data":"oops"}'), ("payload", '{"data":"{}"}'), ("payload", '{"data":"{\\"status_severity\\":\\"x\\"}"}'),
    ], key=repr)
    counted = [p.observedMetrics["ingest_lines"] for p in query.recentProgress if p.numInputRows]
    assert [(c["rows"], c["rejects"]) for c in counted] == [(2, 8)]
    assert "PushedFilters: [IsNull(reject_reason)]" in streams.raw_rows(raw)._jdf.queryExecution().toString()


def test_a_checked_feed_parses_once(spark):
    from headway.schemas import LINE_STATUS_FIELDS

    plan = projections.checked_feed(broken(spark), LINE_STATUS_FIELDS)._jdf.queryExecution().toString()
    assert plan[plan.index("Physical Plan"):].count("json_tuple") == 2  # the envelope and the payload


def test_state_keeps_the_newest_row_of_late_and_repeated_ones(spark, folder):
    from headway.sinks.keyed import KeyedTable

    table = KeyedTable(spark, f"{folder}/table", ["id"], "at", ["n"], buckets=4)
    schema, seen = "id string, at int, n int", spark.createDataFrame([], "id string, at int, n int")
    for values in ([("a", 5, 1), ("b", 1, 1)], [("a", 3, 9), ("b", 1, 2), ("a", 5, 1)], [("c", None, 1), ("b", 1, 1), (None, 2, 2)]):
        part = spark.createDataFrame(values, schema)
        seen = seen.union(part)
        feed(part, f"{folder}/in")
        jobs.finish(jobs.keep_latest(spark.readStream.schema(schema).parquet(f"{folder}/in"), table, f"{folder}/ck"))
        assert rows(table.read()) == rows(ranking.latest_per_key(seen, ["id"], "at", ["n"]))


def test_messages_count_once_within_the_disorder(spark, folder):
    def run(*messages):
        feed(spark.createDataFrame([(None, "v", "t", n, T0 + dt.timedelta(seconds=s)) for n, s in messages], "key string, value string, topic string, offset long, timestamp timestamp"), f"{folder}/in/topic=t")
        jobs.finish(jobs.append_files(jobs.once_each(stream_topic(spark, "parquet", path=f"{folder}/in")), f"{folder}/out", f"{folder}/ck"))
        return rows(spark.read.parquet(f"{folder}/out"), "offset")

    assert run((1, 0), (1, 0), (2, 60)) == [(1,), (2,)]
    assert run((2, 60), (3, 58), (4, 40)) == [(1,), (2,), (3,)]  # 2 again, 3 out of order, 4 too late
    assert run((2, 60), (5, 100)) == [(1,), (2,), (3,), (5,)]


def test_a_tail_goes_on_from_where_it_first_began(spark, folder):
    from headway.sources.readers import tail_from

    assert tail_from(spark, f"{folder}/start", "2024-01-01 00:00:00") == "2024-01-01 00:00:00"
    assert tail_from(spark, f"{folder}/start", "2024-06-01 00:00:00") == "2024-01-01 00:00:00"


def test_subscriptions_of_the_moment_count(spark, folder):
    schema, subscribed = "event_id int, topic string", {"now": [("s1", "t")]}
    for values, sessions in (([(1, "t")], [("s1", "t"), ("s1", "t")]), ([(2, "t"), (3, "u")], []), ([(4, "t")], [("s2", "t"), ("s3", "t")])):
        subscribed["now"] = sessions
        feed(spark.createDataFrame(values, schema), f"{folder}/in")
        current = lambda: spark.createDataFrame(subscribed["now"], "session_id string, topic string")
        jobs.finish(jobs.deliver_live(spark.readStream.schema(schema).parquet(f"{folder}/in"), current, f"{folder}/out", f"{folder}/ck"))
    assert rows(tables.read_batches(spark, f"{folder}/out"), "event_id", "session_id") == [(1, "s1"), (4, "s2"), (4, "s3")]
