"""What the plans must look like at scale."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import DATA, plan_of, rows
from pyspark.sql import functions as F

from headway.operators import aggregates, filters, projections, quality, ranking
from headway.plans import batch
from headway.queries import QUERIES, bindings as b
from headway.queries.registry import Tables
from headway.sinks import tables

T0 = dt.datetime(2024, 1, 1)
STREAMED = {"interval_rerun", "stream_resume", "stream_late_rows", "stream_health", "topic_to_raw", "bounded_topic", "stream_hourly", "stream_latest", "stream_fan_out", "stream_arrivals",
            "stream_to_analytics", "landing_to_hourly", "backfill_range", "layer_counts", "interval_batch", "smoke_roundtrip",
            "dimension_maintenance"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMED))
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, DATA))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list(event"):
        assert bad not in plan


@pytest.fixture
def typed_table(spark, folder):
    """A curated table on disk, partitioned by day."""
    curated = projections.curate_stations(b.stations(Tables(spark, DATA).events), b.AS_OF)
    tables.replace(tables.with_date(curated, "event_time"), f"{folder}/t", partition_by=["event_date"])
    return spark.read.parquet(f"{folder}/t")


def test_station_filter_reaches_the_scan(typed_table):
    plan = plan_of(filters.plausible_stations(typed_table).select("bike_point_id", "nb_bikes"))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("GreaterThanOrEqual(lat,51.28)", "LessThanOrEqual(lon,0.33)", "GreaterThan(nb_docks,0)", "IsNotNull(bike_point_id)"):
        assert part in pushed
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "occupancy_pct" not in schema and "event_time" not in schema


def test_interval_prunes_days(typed_table):
    days = filters.in_interval(typed_table, "event_time", "2024-01-10", "2024-01-11", "event_date").select("event_time")
    assert "PartitionFilters: [isnotnull(event_date" in plan_of(days, "simple")
    full = filters.in_interval(typed_table, "event_time", "2024-01-10", "2024-01-11").select("event_time")
    assert rows(days) == rows(full)
    read = {r[0] for r in days.select(F.input_file_name()).distinct().collect()}
    assert all("event_date=2024-01-10" in name or "event_date=2024-01-11" in name for name in read)


def test_high_water_is_a_scalar_subquery(typed_table):
    fresh = filters.after_high_water(typed_table, typed_table.filter("event_date < '2024-01-20'"), "event_time", "event_date")
    plan = plan_of(fresh)
    assert "Subquery" in plan and "Join" not in plan.split("===== Subqueries")[0]
    partition_filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert any("ubquery" in line for line in partition_filters)


def test_rank_limits_before_the_shuffle(typed_table):
    for df in (
        ranking.latest_per_key(typed_table, ["bike_point_id"], "event_time", ["nb_bikes"]),
        ranking.last_n_per_key(typed_table, ["bike_point_id"], [F.desc("event_time"), "nb_bikes"], 1000),
    ):
        plan = plan_of(df, "simple")
        below = plan[plan.rindex("Exchange"):]
        assert "WindowGroupLimit" in below and "Partial" in below


def test_key_filter_goes_below_the_rank(typed_table):
    latest = ranking.latest_per_key(typed_table, ["bike_point_id"], "event_time", ["nb_bikes"])
    assert "EqualTo(bike_point_id,Dock_7)" in plan_of(filters.look_up(latest, "bike_point_id", "Dock_7"))


def test_heads_need_no_full_sort(typed_table):
    assert "TakeOrderedAndProject" in plan_of(ranking.fullest(typed_table))
    assert "TakeOrderedAndProject" in plan_of(ranking.next_for_key(typed_table, "bike_point_id", "Dock_7", "event_time", []))


def test_hourly_shuffles_once_after_partial_aggregation(typed_table):
    plan = plan_of(aggregates.station_hourly_windowed(typed_table), "simple")
    assert plan.count("Exchange") == 1 and "partial_sum" in plan[plan.index("Exchange"):]


def test_gates_scan_once(typed_table):
    plan = plan_of(quality.gates(quality.measure(typed_table, "bike_point_id", "event_time", b.AS_OF)), "simple")
    assert plan.count("FileScan") == 1


def test_payload_is_parsed_once(spark):
    plan = plan_of(QUERIES["quality_filter_box"](spark, DATA), "simple")
    assert plan.count("json_tuple") == 1 and "get_json_object" not in plan


def test_layers_are_partitioned_by_day(spark, folder):
    landing = f"{folder}/landing"
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("event_time", "ingested_at")}
    b.stations(Tables(spark, DATA).events).withColumns(iso).write.parquet(landing)
    counts = batch.landing_to_hourly(spark, landing, f"{folder}/all")
    assert counts["raw"] == spark.read.parquet(landing).count()
    part = batch.backfill(spark, landing, f"{folder}/part", "2024-01-10", "2024-01-12")
    before = rows(spark.read.parquet(f"{folder}/all/hourly"))
    batch.backfill(spark, landing, f"{folder}/all", "2024-01-10", "2024-01-12")
    assert rows(spark.read.parquet(f"{folder}/all/hourly")) == before  # other days untouched, these rebuilt
    with pytest.raises(ValueError):
        batch.backfill(spark, landing, f"{folder}/all", "2024-01-10 06:00:00", "2024-01-12")
    days = spark.read.parquet(f"{folder}/part/curated").select("event_date").distinct()
    assert rows(days) == [(dt.date(2024, 1, 10),), (dt.date(2024, 1, 11),)]
    assert 0 < part["hourly"] < counts["hourly"]
