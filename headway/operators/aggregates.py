"""Hourly station statistics, roll-ups and table health.

All functions used combine map-side, so a hot station or endpoint shuffles only
partial results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.functions.text_time import hour_of, shift


def exact_mean(column: str, digits: int = 0) -> Column:
    """Mean of values that have so many decimal digits: a sum of whole numbers, divided once.

    However rows are dealt to tasks, the result is the same to the last bit.
    """
    scale = 10**digits
    units = F.round(F.col(column) * scale).cast("long") if digits else F.col(column).cast("long")
    return F.try_divide(F.sum(units).cast("double"), (F.count(column) * scale).cast("double"))


def by_station(curated: DataFrame, *when: Column) -> DataFrame:
    """Statistics of each station's readings in a stretch of time."""
    means = {"avg_bikes": exact_mean("nb_bikes"), "avg_ebikes": exact_mean("nb_ebikes"), "avg_occupancy_pct": exact_mean("occupancy_pct", 1)}
    readings = curated.groupBy("bike_point_id", "common_name", *when)
    return readings.agg(
        F.count(F.lit(1)).alias("sample_count"), F.count_if("is_empty").alias("empty_count"), F.count_if("is_full").alias("full_count"),
        F.min("nb_bikes").alias("min_bikes"), F.max("nb_bikes").alias("max_bikes"), *[mean.alias(name) for name, mean in means.items()],
    )


def station_hourly_windowed(curated: DataFrame, ts: str = "event_time", width: str = "1 hour") -> DataFrame:
    """Per station and event-time window; the same code on a table and on a watermarked stream."""
    found = by_station(curated, F.window(ts, width).alias("_window"))
    return found.withColumns({f"window_{side}": F.col(f"_window.{side}") for side in ("start", "end")}).drop("_window")


def station_hourly_batch(curated: DataFrame, ts: str = "event_time") -> DataFrame:
    """Per station and hour with means rounded to one digit."""
    found = by_station(curated, hour_of(F.col(ts)).alias("window_start"))
    shown = {name: F.round(name, 1) for name in found.columns if name.startswith("avg_")}
    return found.withColumns({**shown, "window_end": shift(F.col("window_start"), "1 hour")})


def station_hourly_located(curated: DataFrame, ts: str = "event_time") -> DataFrame:
    """Per station, hour and position, in the batch vocabulary."""
    bikes = F.col("available_bikes")
    return curated.groupBy(
        "bike_point_id", "common_name", hour_of(F.col(ts)).alias("hour_start"), "lat", "lon"
    ).agg(
        F.avg("occupancy_pct").alias("avg_occupancy_pct"),
        F.min(bikes).alias("min_available_bikes"),
        F.max(bikes).alias("max_available_bikes"),
        F.avg(bikes.cast("double")).alias("avg_available_bikes"),
        F.max("total_docks").alias("total_docks"),
        F.count_if("is_empty").alias("empty_count"),
        F.count_if("is_full").alias("full_count"),
        F.count(F.lit(1)).alias("observation_count"),
    )


def network_totals(latest: DataFrame) -> DataFrame:
    """Stations, bikes and docks over the latest row of each station."""
    held = F.col("nb_bikes").cast("long") + F.col("nb_ebikes")
    return latest.agg(
        F.count("*").alias("stations"),
        F.coalesce(F.sum(held), F.lit(0)).alias("bikes"),
        F.coalesce(F.sum(held + F.col("nb_empty_docks")), F.lit(0)).alias("docks"),
    )


def status_rollup(catalogue_with_facts: DataFrame, fact_key: str, severity: str = "status_severity") -> DataFrame:
    """Catalogue rows that are good, have issues, or have no fact at all."""
    known, good = F.col(fact_key).isNotNull(), F.col(severity).eqNullSafe(F.lit(10))
    return catalogue_with_facts.agg(
        F.count_if(known & good).alias("good"),
        F.count_if(known & ~good).alias("issues"),
        F.count_if(~known).alias("unknown"),
    )


def table_health(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and newest time of each table; every scan reads one column."""
    stats = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count"), F.max(ts).alias("newest"))
        for name, (df, ts) in tables.items()
    ]
    return reduce(DataFrame.unionByName, stats)


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("requests"))


def _rolling(hourly: DataFrame, hours: int) -> DataFrame:
    """Each hour's row for all hours whose stretch of ``hours``, their own the last, has it."""
    last = F.col("hour") + F.make_dt_interval(hours=F.lit(hours - 1))
    return hourly.withColumn("hour", F.explode(F.sequence("hour", last, F.make_dt_interval(hours=F.lit(1)))))


def rolling_distinct(df: DataFrame, key: str, ts: str, hours: int = 24, bits: int = 12) -> DataFrame:
    """(hour, distinct_keys): about how many keys the last ``hours`` hours have, by mergeable sketches.

    One sketch an hour, of at most 2^bits bytes or so, is exchanged and merged, however many rows and keys there are. Its
    standard error is about 1.04 / sqrt(2^bits). Rows without a key or time count nowhere.
    """
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    hourly = known.groupBy(hour_of(F.col(ts)).alias("hour")).agg(F.hll_sketch_agg(key, bits).alias("_sketch"))
    merged = _rolling(hourly, hours).groupBy("hour").agg(F.hll_union_agg("_sketch").alias("_sketch"))
    return merged.select("hour", F.hll_sketch_estimate("_sketch").alias("distinct_keys"))


def rolling_distinct_exact(df: DataFrame, key: str, ts: str, hours: int = 24) -> DataFrame:
    """The same, exact: a key counts once an hour before it is copied to the hours whose stretch has it."""
    known = df.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
    hourly = known.select(hour_of(F.col(ts)).alias("hour"), key).distinct()
    return _rolling(hourly, hours).groupBy("hour").agg(F.count_distinct(key).alias("distinct_keys"))
