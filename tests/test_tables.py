"""Sources and sinks: landing, documents, generator, tables, logs, messages."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway import schemas
from headway.plans import batch
from headway.sinks import tables, topics
from headway.sources import documents, generator, readers

T0 = dt.datetime(2024, 1, 1)


def test_landing_types_times(spark, folder):
    data = [("a", "2024-01-01T00:00:01Z", "x"), ("b", "not a time", None)]
    spark.createDataFrame(data, "id STRING, event_time STRING, ingested_at STRING").write.parquet(f"{folder}/l")
    df = readers.read_landing(spark, f"{folder}/l")
    assert dict(df.dtypes)["event_time"] == "timestamp_ntz"
    assert rows(df) == [("a", T0 + dt.timedelta(seconds=1), None), ("b", None, None)]


def test_documents_and_rejects(spark, folder):
    station = {"id": "s1", "commonName": "One", "lat": 51.5, "lon": -0.1, "additionalProperties": [
        {"key": "NbBikes", "value": "4"}, {"key": "NbDocks", "value": "x"}, {"key": "NbBikes", "value": "5"}]}
    with open(f"{folder}/docs.json", "w") as out:
        out.write(json.dumps(station) + "\n" + '{"id": "cut' + "\n" + json.dumps({"id": "s2"}) + "\n")
    read = readers_docs = documents.read_documents(spark, f"{folder}/docs.json", documents.STATION_DOCUMENT)
    good = readers_docs.filter(F.col(documents.CORRUPT).isNull())
    got = rows(documents.station_rows(good, F.lit(T0)), "bike_point_id", "available_bikes", "total_docks", "available_ebikes")
    assert got == [("s1", 5, 0, 0), ("s2", 0, 0, 0)]
    assert read.count() == 3


def test_array_documents(spark, folder):
    with open(f"{folder}/lines.json", "w") as out:
        json.dump([{"id": "dlr", "name": "DLR", "lineStatuses": [{"statusSeverityDescription": "Good Service"}]},
                   {"id": "x", "name": "X", "lineStatuses": []}, {"id": "y", "name": "Y"}], out, indent=1)
    read = documents.read_documents(spark, folder, documents.LINE_DOCUMENT, multi_line=True)
    assert rows(documents.line_rows(read, F.lit(T0)), "line_id", "status", "reason") == [
        ("dlr", "Good Service", ""), ("x", "Unknown", ""), ("y", "Unknown", "")]
    assert documents.line_history_rows(read, F.lit(T0)).count() == 1


def test_split_rejects(spark):
    texts = spark.createDataFrame([('{"id": "a"}',), ('{"id": ',), (None,), ("[]x",)], "body STRING")
    good, bad = documents.split_rejects(documents.parse_documents(texts, "body", documents.ARRIVAL_DOCUMENT), "body")
    assert rows(documents.arrival_rows(good, F.lit(T0), F.lit("stop9")), "arrival_id", "stop_id", "time_to_station",
                "station_name", "expected_arrival") == [("a", "stop9", 0, "", "2024-01-01 00:00:00")]
    assert rows(bad) == sorted([('{"id": ',), (None,), ("[]x",)], key=repr)


def test_generator(spark):
    feed = generator.generate(spark, 5000, "2024-01-04 00:00:00", seed=1).cache()
    assert feed.count() == 5000
    assert rows(feed.limit(50)) == rows(generator.generate(spark, 5000, "2024-01-04 00:00:00", seed=1).limit(50))
    assert rows(feed.limit(50)) != rows(generator.generate(spark, 5000, "2024-01-04 00:00:00", seed=2).limit(50))
    assert feed.filter((F.col("status_severity") == 10) != F.col("reason").isNull()).count() == 0
    assert feed.select("line_id").distinct().count() == 14
    good = feed.filter("status_severity = 10").count() / 5000
    assert abs(good - 5 / 12) < 0.03
    lowest, highest = feed.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    assert (lowest, highest) == ("2024-01-01T00:00:00+00:00", "2024-01-04T00:00:00+00:00")


def test_record_schema(spark):
    schema = schemas.schema_for("bus_arrival")
    assert [f.name for f in schema if f.nullable] == ["destination_name", "stop_name", "direction"]
    df = spark.createDataFrame([("a", None, 1_700_000_000_123)], "arrival_id STRING, vehicle_id STRING, event_time BIGINT")
    assert schemas.missing_columns(df, schema)[:2] == ["line_id", "line_name"]
    typed = schemas.from_record_millis(df, "event_time")
    assert typed.first()["event_time"] == dt.datetime(2023, 11, 14, 22, 13, 20, 123000)


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n INT")


def test_append_replace_and_count(spark, folder):
    path = f"{folder}/t"
    tables.append(numbers(spark, 1, 2), path)
    tables.append(numbers(spark, 3), path)
    assert rows(readers.read_layer(spark, path)) == [(1,), (2,), (3,)]
    assert tables.counted(numbers(spark, 7, 8), lambda df: tables.replace(df, path)) == 2
    assert tables.read_back_count(spark, path).first()[0] == 2
    tables.replace(spark.read.parquet(path).filter("n > 7"), path)  # reads what it replaces
    assert rows(readers.read_layer(spark, path)) == [(8,)]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.replace(spark.read.parquet(path).selectExpr("n / (n - 8) AS n"), path)
    assert rows(readers.read_layer(spark, path)) == [(8,)]  # a failed write changes nothing
    assert tables.counted(numbers(spark, 1).filter("false"), lambda df: tables.replace(df, path)) == 0


def test_catalog_table(spark):
    tables.replace(numbers(spark, 1), "headway_numbers")
    tables.append(numbers(spark, 2), "headway_numbers")
    assert rows(readers.read_layer(spark, "headway_numbers")) == [(1,), (2,)]
    assert tables.read_back_count(spark, "headway_numbers").first()[0] == 2
    spark.sql("DROP TABLE headway_numbers")


def events(spark, *hours):
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h), h) for h in hours], "event_time TIMESTAMP_NTZ, n INT")


def test_days_are_replaced_not_doubled(spark, folder):
    path = f"{folder}/days"
    dated = lambda *hours: tables.with_date(events(spark, *hours), "event_time")
    tables.replace_days(dated(1, 25, 26, 49), path, ("2024-01-01", "2024-01-04"))
    tables.replace_days(dated(27), path, ("2024-01-02", "2024-01-03"))
    assert rows(spark.read.parquet(path), "n") == [(1,), (27,), (49,)]
    tables.replace_days(dated(50, 99), path, ("2024-01-02", "2024-01-04"))  # a day without rows goes, a row outside stays out
    assert rows(spark.read.parquet(path), "n") == [(1,), (50,)]
    tables.replace_days(dated(27, 49), path, ("2024-01-02", "2024-01-04"))
    tables.rewrite_days(spark, path, f"{folder}/closed", "2024-01-03")
    assert rows(spark.read.parquet(f"{folder}/closed"), "n") == [(1,), (27,)]
    assert tables.drop_days_before(spark, path, "2024-01-02") == ["event_date=2024-01-01"]
    assert rows(spark.read.parquet(path), "n") == [(27,), (49,)]


def test_failed_swap_keeps_the_old_table(spark, folder):
    path = f"{folder}/kept"
    tables.replace(numbers(spark, 8), path)
    with pytest.raises(Exception):
        tables._swap(spark, f"{folder}/missing", path)
    assert rows(readers.read_layer(spark, path)) == [(8,)]


def test_interval_without_rows_replaces_the_old_one(spark, folder):
    path = f"{folder}/interval"
    for hours in ((1, 2), ()):
        tables.replace_interval(events(spark, *hours) if hours else events(spark, 1).filter("false"), path, "2024-01-01 00:30:00")
        tables.replace_interval(events(spark, 5), path, "2024-01-02 00:30:00")
        assert spark.read.parquet(path).count() == len(hours) + 1


def test_latest_log(spark, folder):
    log, keys = f"{folder}/log", (["k"], "v", ["v"])
    state = lambda *data: spark.createDataFrame(list(data), "k STRING, v INT")
    tables.write_batch(state(("a", 1), ("b", 5)), log, 0)
    tables.write_batch(state(("a", 2)), log, 1)
    tables.write_batch(state(("a", 2)), log, 1)  # delivered again
    tables.write_batch(state(("b", 3), ("c", 1)), log, 2)
    want = [("a", 2), ("b", 5), ("c", 1)]
    assert rows(tables.read_latest(spark, log, *keys)) == want
    assert tables.read_batches(spark, log).count() == 5
    tables.compact_latest(spark, log, f"{folder}/compact", *keys)
    assert tables.read_batches(spark, f"{folder}/compact").count() == 3
    tables.write_batch(state(("c", 9)), f"{folder}/compact", 3)
    assert rows(tables.read_latest(spark, f"{folder}/compact", *keys)) == [("a", 2), ("b", 5), ("c", 9)]


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, 1), ("b", 5, 1)], "k STRING, ts INT, n INT")
    batch_ = spark.createDataFrame([("a", 2, 1), ("b", 4, 1), ("c", 1, 1), ("c", 1, 2)], "k STRING, ts INT, n INT")
    once = tables.upsert_latest(target, batch_, ["k"], "ts", ["n"])
    assert rows(once) == [("a", 2, 1), ("b", 5, 1), ("c", 1, 2)]
    assert rows(tables.upsert_latest(once, batch_, ["k"], "ts", ["n"])) == rows(once)
    assert rows(tables.upsert_latest(target, batch_.filter("false"), ["k"], "ts", ["n"])) == rows(target)


def test_changelog_and_messages(spark, folder):
    df = spark.createDataFrame([("a", 1, None)], "k STRING, n INT, note STRING")
    assert tuple(topics.to_changelog(df, ["k"], ["n", "note"]).first()) == ('{"k":"a"}', '{"n":1,"note":null}')
    sent = topics.to_messages(df, "line-status", F.to_json(F.struct("n")), F.lit(T0)).select(
        F.lit(None).cast("string").alias("key"), "value", F.lit("t").alias("topic"),
        F.lit(1).cast("long").alias("offset"), F.lit(T0).cast("timestamp").alias("timestamp"))
    topics.publish(sent, "parquet", path=f"{folder}/topic")
    got = readers.read_topic(spark, "parquet", path=f"{folder}/topic").first()
    assert json.loads(got.value) == {"event_type": "line-status", "data": '{"n":1}', "ingested_at": "2024-01-01T00:00:00.000"}


def test_interval_is_idempotent(spark, folder):
    stations = spark.createDataFrame(
        [("a", "A", 10, 5, 0, 51.5, -0.1, T0 + dt.timedelta(hours=h)) for h in (0, 1, 23, 24)],
        "bike_point_id STRING, common_name STRING, total_docks INT, available_bikes INT, available_ebikes INT, "
        "lat DOUBLE, lon DOUBLE, event_time TIMESTAMP_NTZ")
    lines = spark.createDataFrame([("l", "L", "Good Service", "", T0)], "line_id STRING, line_name STRING, status STRING, reason STRING, event_time TIMESTAMP_NTZ")
    arrivals = spark.createDataFrame([("a", "s", "S", "l", "D", 10, "2024-01-01T00:00:00Z", T0)],
        "arrival_id STRING, stop_id STRING, station_name STRING, line_name STRING, destination_name STRING, "
        "time_to_station INT, expected_arrival STRING, event_time TIMESTAMP_NTZ")
    for start, end in (("2024-01-01 00:30:00", "2024-01-02 00:30:00"), ("2023-12-31 00:30:00", "2024-01-01 00:30:00")) * 2:
        batch.run_interval(stations, lines, arrivals, folder, start, end)
    assert {t: spark.read.parquet(f"{folder}/{t}").count() for t in ("stations", "lines", "arrivals", "hourly")} == {
        "stations": 4, "lines": 1, "arrivals": 1, "hourly": 4}
