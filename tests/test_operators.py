"""Filters, ranking, joins, aggregates, dimensions, gates and monitoring on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators import aggregates, dimensions, filters, joins, monitoring, projections, quality, ranking

T0 = dt.datetime(2024, 1, 1)


def at(hours=0.0):
    return T0 + dt.timedelta(hours=hours)


STATION = (
    "bike_point_id STRING, common_name STRING, lat DOUBLE, lon DOUBLE, nb_bikes INT, nb_ebikes INT, "
    "nb_empty_docks INT, nb_docks INT, event_time TIMESTAMP_NTZ"
)


def station(spark, *changes):
    base = {"bike_point_id": "a", "common_name": "A", "lat": 51.5, "lon": -0.1, "nb_bikes": 3, "nb_ebikes": 1,
            "nb_empty_docks": 6, "nb_docks": 10, "event_time": T0}
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes], STATION)


@pytest.mark.parametrize("change,kept", [
    ({}, True), ({"lat": 51.28}, True), ({"lat": 51.69}, True), ({"lat": 51.2799}, False), ({"lat": 51.6901}, False),
    ({"lon": -0.51}, True), ({"lon": 0.33}, True), ({"lon": -0.5101}, False), ({"lon": 0.3301}, False),
    ({"bike_point_id": None}, False), ({"lat": None}, False), ({"lon": None}, False), ({"nb_bikes": None}, False),
    ({"nb_docks": None}, False), ({"nb_bikes": -1}, False), ({"nb_bikes": 0}, True), ({"nb_docks": 0}, False),
    ({"nb_docks": -3}, False), ({"nb_bikes": 99}, True), ({"nb_ebikes": None}, True), ({"event_time": None}, True),
])
def test_station_filter(spark, change, kept):
    assert filters.plausible_stations(station(spark, change)).count() == int(kept)


def test_batch_filter_and_statuses(spark):
    data = [("a", 0, 10), ("b", 10, 10), ("c", 11, 10), ("d", -1, 10), ("e", 1, 0), ("f", None, 10), ("g", 1, None)]
    df = spark.createDataFrame(data, "bike_point_id STRING, available_bikes INT, total_docks INT")
    df = df.withColumns({"common_name": F.lit("x"), "available_ebikes": F.lit(0), "lat": F.lit(0.0), "lon": F.lit(0.0),
                         "event_time": F.lit(T0)})
    got = rows(projections.enrich_stations(df), "bike_point_id", "occupancy_pct", "is_empty", "is_full", "availability_status")
    assert got == [("a", 0.0, True, False, "critical"), ("b", 100.0, False, True, "full")]


def test_arrival_filter(spark):
    data = [("x", "v", s) for s in (-61, -60, 0, 3600, 3601, None)] + [(None, "v", 5), ("x", None, 5)]
    df = spark.createDataFrame(data, "arrival_id STRING, vehicle_id STRING, time_to_station INT")
    assert rows(filters.plausible_arrivals(df), "time_to_station") == [(-60,), (0,), (3600,)]


def times(spark, *hours):
    return spark.createDataFrame([(at(h) if h is not None else None,) for h in hours], "ts TIMESTAMP_NTZ")


def test_intervals(spark):
    df = times(spark, -0.001, 0, 1, 2, None)
    assert filters.in_interval(df, "ts", str(at(0)), str(at(2))).count() == 2
    assert filters.in_interval(df, "ts", str(at(0))).count() == 3
    assert filters.newer_than(df, "ts", str(at(2)), "2 hours").count() == 2
    assert filters.newer_than(df, "ts", str(at(2)), "2 hours", inclusive=True).count() == 3
    assert filters.keep_since(df, "ts", str(at(24)), 1).count() == 3


def test_high_water(spark):
    source = times(spark, 0, 1, 2, None)
    assert rows(filters.after_high_water(source, times(spark, 1, 0.5), "ts")) == [(at(2),)]
    assert filters.after_high_water(source, times(spark).filter("false"), "ts").count() == 3
    assert filters.after_high_water(source, times(spark, None), "ts").count() == 3


def test_near_is_inclusive(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, -1.0), (1.0, 1.01), (None, 0.0)], "lat DOUBLE, lon DOUBLE")
    assert filters.near(df, 0.0, 0.0, 111.0).count() == 2
    assert filters.near(df, 0.0, 0.0, 111_000.0, per_degree=111_000.0).count() == 2


def test_latest_breaks_ties(spark):
    data = [("a", at(0), 1), ("a", at(1), 2), ("a", at(1), 3), ("b", None, 4), ("b", at(0), 5), (None, at(0), 6)]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP_NTZ, n INT")
    assert rows(ranking.latest_per_key(df, ["k"], "ts", ["n"]), "k", "n") == [("a", 3), ("b", 5), (None, 6)]
    assert rows(ranking.latest_by_arrival(df, ["k"], "n"), "n") == [(3,), (5,), (6,)]


def test_compacted_drops_deleted(spark):
    log = spark.createDataFrame([("a", "1", 1), ("a", None, 2), ("b", None, 1), ("b", "2", 3)], "key STRING, value STRING, `offset` BIGINT")
    assert rows(ranking.compacted(log), "key", "value") == [("b", "2")]


def test_last_n_of_a_hot_key(spark):
    hot = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(-1).alias("k"), F.col("id").alias("n"))
    got = ranking.last_n_per_key(hot.repartition(13), ["k"], [F.desc("n")], 7, spread=3)
    want = hot.toPandas().sort_values("n", ascending=False).groupby("k").head(7)
    assert rows(got, "k", "n") == sorted(map(tuple, want[["k", "n"]].to_numpy().tolist()), key=repr)


def test_extremes(spark):
    data = [(f"s{i}", pct, b, e, f) for i, (pct, b, e, f) in enumerate(
        [(50.0, 1, 1, 2), (100.0, 4, 0, 0), (100.0, 3, 1, 0), (None, 1, 0, 3), (0.0, 0, 0, 4), (0.0, 0, 0, 0), (25.0, 1, 0, 3)])]
    df = spark.createDataFrame(data, "bike_point_id STRING, occupancy_pct DOUBLE, nb_bikes INT, nb_ebikes INT, nb_empty_docks INT")
    assert [r[0] for r in ranking.fullest(df, 3).collect()] == ["s1", "s2", "s0"]
    assert [r[0] for r in ranking.emptiest(df, 3).collect()] == ["s4", "s6", "s0"]
    assert ranking.fullest(df, 8).count() == 7 and ranking.emptiest(df, 8).count() == 6


def test_next_for_key_puts_unknown_times_last(spark):
    df = spark.createDataFrame([("s", None, 1), ("s", "b", 2), ("s", "a", 3), ("t", "a", 4)], "stop STRING, due STRING, n INT")
    assert [r.n for r in ranking.next_for_key(df, "stop", "s", "due", ["n"]).collect()] == [3, 2, 1]


def test_catalogue_and_rollup(spark):
    lines = joins.line_dimension(spark)
    facts = spark.createDataFrame([("dlr", 10), ("tram", 9), ("circle", None), ("other", 10)], "line_id STRING, status_severity INT")
    merged = joins.with_catalogue(lines, facts, "id", "line_id")
    assert merged.count() == 15
    assert tuple(aggregates.status_rollup(merged, "line_id").first()) == (1, 2, 12)


def test_unknown_line_gets_a_name(spark):
    facts = spark.createDataFrame([("dlr",), ("new-ferry",), (None,)], "line_id STRING")
    got = rows(joins.with_line(facts, joins.line_dimension(spark)), "line_id", "name", "order")
    assert got == [("dlr", "DLR", 13), ("new-ferry", "New Ferry", 99), (None, None, 99)]


def test_deliver(spark):
    messages = spark.createDataFrame([("t1", 1), ("t2", 2), ("t3", 3)], "topic STRING, n INT")
    sessions = spark.createDataFrame([("a", "t1"), ("b", "t1"), ("a", "t2"), ("a", "t2")], "session_id STRING, topic STRING")
    assert rows(joins.deliver(messages, sessions), "session_id", "n") == [("a", 1), ("a", 2), ("b", 1)]


def test_hourly_groups_and_borders(spark):
    df = projections.curate_stations(station(
        spark, {"event_time": at(0)}, {"event_time": at(0.999), "nb_bikes": 0, "nb_ebikes": 0, "nb_empty_docks": 10},
        {"event_time": at(1), "nb_empty_docks": 0, "nb_ebikes": None}, {"event_time": None}), str(T0))
    columns = ["window_start", "window_end", "avg_bikes", "avg_ebikes", "avg_occupancy_pct", "min_bikes", "max_bikes",
               "empty_count", "full_count", "sample_count"]
    first = (at(0), at(1), 1.5, 0.5, 20.0, 0, 3, 1, 0, 2)
    second = (at(1), at(2), 3.0, None, None, 3, 3, 0, 1, 1)
    untimed = (None, None, 3.0, 1.0, 40.0, 3, 3, 0, 0, 1)
    assert rows(aggregates.station_hourly_windowed(df), *columns) == [first, second]
    assert rows(aggregates.station_hourly_batch(df), *columns) == sorted([first, second, untimed], key=repr)


def test_totals_of_nothing(spark):
    assert tuple(aggregates.network_totals(station(spark, {}).filter("false")).first()) == (0, 0, 0)


DIM = "id STRING, name STRING, docks INT"


def dim(spark, *data):
    return spark.createDataFrame(list(data), DIM)


def apply(target, incoming, hours):
    return dimensions.scd2(target, incoming, ["id"], ["name", "docks"], str(at(hours)))


def test_scd2(spark):
    target = dimensions.first_versions(dim(spark, ("a", "A", 1), ("b", "B", 2), ("c", None, 3), ("d", "D", 4)), str(at(0)))
    incoming = dim(spark, ("a", "A", 1), ("b", "B", 20), ("c", None, 3), ("e", "E", 5))
    once = apply(target, incoming, 1)
    end = dt.datetime(9999, 12, 31)
    assert rows(once) == sorted([
        ("a", "A", 1, at(0), end, True), ("b", "B", 2, at(0), at(1), False), ("b", "B", 20, at(1), end, True),
        ("c", None, 3, at(0), end, True), ("d", "D", 4, at(0), end, True), ("e", "E", 5, at(1), end, True)], key=repr)
    assert rows(apply(once, incoming, 2)) == rows(once)
    back = apply(once, dim(spark, ("b", "B", 2), ("c", "C", 3)), 3)
    current = back.filter("_is_current").groupBy("id").count()
    assert current.filter("count <> 1").count() == 0
    overlap = back.alias("x").join(back.alias("y"), "id").filter(
        "x._valid_from < y._valid_from AND x._valid_until > y._valid_from")
    assert overlap.count() == 0 and back.count() == 8
    assert apply(target.filter("false"), incoming, 1).count() == 4
    assert rows(apply(target, incoming.filter("false"), 1)) == rows(target)


def test_semi_and_anti(spark):
    current = dim(spark, ("a", "A", 1), ("b", None, 2), ("c", "C", 3), ("z", "Z", 9))
    incoming = dim(spark, ("a", "A", 1), ("b", None, 2), ("c", None, 3), ("d", "D", 4))
    assert rows(joins.changed_rows(current, incoming, ["id"], ["name", "docks"]), "id") == [("c",)]
    assert rows(joins.unmatched_rows(incoming, current, ["id"], ["name", "docks"]), "id") == [("c",), ("d",)]


def test_gates(spark):
    data = [(None, None, None), (0, 1, None), (1, 1, None), (None, 1, None), (1, None, 0), (None, None, 0), (0, None, 0)]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i INT, v INT, lo INT, hi INT")
    got = [r[0] for r in df.orderBy("i").select(quality.passes(F.col("v"), F.col("lo"), F.col("hi"))).collect()]
    assert got == [True, False, True, False, False, True, True]


def test_measure_and_enforce(spark):
    data = [("a", at(0)), ("b", at(22)), ("b", at(21.99)), (None, at(23)), ("c", at(-1)), ("d", None)]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP_NTZ")
    measured = quality.measure(df, "k", "ts", str(at(24)))
    assert tuple(measured.first()) == (1, 1, 1)  # exactly 2 h and 24 h old do not count
    closed = quality.gates(measured)
    assert rows(closed, "check", "passed") == [("completeness", False), ("freshness", True), ("nulls", False)]
    with pytest.raises(quality.QualityError, match="nulls=1"):
        quality.enforce(closed)
    quality.enforce(closed.filter("passed"))
    assert tuple(quality.measure(df.filter("false"), "k", "ts", str(at(24))).first()) == (0, 0, 0)


def test_layer_lag(spark):
    health = aggregates.table_health({
        "raw": (times(spark, 0), "ts"), "curated": (times(spark, 0), "ts"), "analytics": (times(spark, 0), "ts"),
        "other": (times(spark, 0), "ts")})
    got = rows(quality.layer_lag(health, str(at(150 / 3600))), "table_name", "lag_seconds", "within_limit")
    assert got == [("analytics", 150, True), ("curated", 150, True), ("other", 150, False), ("raw", 150, False)]


def requests(spark, *data):
    return spark.createDataFrame([(e, s, T0 + dt.timedelta(minutes=x)) for e, s, x in data], "endpoint STRING, source STRING, ts TIMESTAMP_NTZ")


def test_rates_slide(spark):
    got = rows(monitoring.rate(requests(spark, ("e", "x", 10), ("e", "x", 10.5), ("e", "x", 12)), ["endpoint"], "ts"),
               "window_start", "requests")
    minute = lambda n: T0 + dt.timedelta(minutes=n)
    want = [(minute(6), 2), (minute(7), 2), (minute(8), 3), (minute(9), 3), (minute(10), 3), (minute(11), 1), (minute(12), 1)]
    assert got == sorted(want, key=repr)


def test_ratio_and_sustained(spark):
    calls = [("a", "fallback", m) for m in range(30)] + [("a", "primary", m) for m in range(30)]
    calls += [("b", "fallback", m) for m in range(4)] + [("b", "primary", m) for m in range(30)]
    df = requests(spark, *calls)
    ratios = monitoring.fallback_ratio(df, ["endpoint"], F.col("source") == "fallback", "ts")
    peak = dict(ratios.groupBy("endpoint").agg(F.max("ratio")).collect())
    assert peak["a"] == pytest.approx(0.5) and peak["b"] == pytest.approx(0.5)
    lasting = rows(monitoring.sustained_fallback(ratios, ["endpoint"]), "endpoint", "steps")
    assert lasting == [("a", 34)]
    few = monitoring.fallback_ratio(requests(spark, ("a", "fallback", 0)), ["endpoint"], F.col("source") == "fallback", "ts",
                                    "1 hour", "1 hour", 3600.0)
    assert few.first()["ratio"] == pytest.approx((1 / 3600) / 0.001)  # floored denominator


def test_gap_ends_a_run(spark):
    df = requests(spark, *[("a", "x", m) for m in [*range(0, 20), *range(40, 50)]])
    runs = monitoring.silent_outage(df, F.col("source") == "good", "ts", "1 minute", "1 minute", 60, 15)
    assert rows(runs, "steps") == [(20,)]
    assert monitoring.silent_outage(df, F.col("source") == "x", "ts").count() == 0


def test_topic_catalog(spark):
    (row,) = projections.topic_catalog(projections.topic_table(spark)).collect()
    assert (row.domain, row.label, len(row.topics)) == ("tfl", "London Transport", 5)
    assert row.topics[0].name == "tfl.analytics.line-status-latest"


def test_snapshot_then_live(spark):
    df = spark.createDataFrame([("t", at(h), h) for h in range(10)] + [("u", at(20), 20)], "topic STRING, ts TIMESTAMP_NTZ, n INT")
    got = rows(ranking.snapshot_then_live(df, str(at(5)), ["topic"], "ts", ["n"], 2), "n", "snapshot")
    assert got == sorted([(3, True), (4, True)] + [(n, False) for n in (5, 6, 7, 8, 9, 20)], key=repr)


def test_rolling_distinct_by_sketches(spark):
    from headway.operators import aggregates

    rows = spark.sql("SELECT id % 700 AS k, TIMESTAMP_NTZ '2024-01-01 00:10:00' + make_dt_interval(0, id % 60) AS t FROM range(4000)")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, TIMESTAMP_NTZ '2024-01-01 00:10:00' AS t UNION ALL SELECT 1L, NULL"))
    exact = {r["hour"]: r["distinct_keys"] for r in aggregates.rolling_distinct_exact(rows, "k", "t").collect()}
    sketched = {r["hour"]: r["distinct_keys"] for r in aggregates.rolling_distinct(rows, "k", "t").collect()}
    read = {(r["k"], r["t"].replace(minute=0)) for r in rows.collect() if r["k"] is not None and r["t"] is not None}
    assert exact == {h: len({k for k, own in read if 0 <= (h - own).total_seconds() < 24 * 3600}) for h in exact}
    assert len(exact) == 60 + 23 and exact.keys() == sketched.keys()
    assert all(abs(sketched[h] - n) <= max(1, 0.05 * n) for h, n in exact.items())
    assert aggregates.rolling_distinct(rows.limit(0), "k", "t").count() == 0
