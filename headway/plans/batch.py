"""Scheduled batch flows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import aggregates, dimensions, filters, projections, quality
from headway.sinks import tables
from headway.sources.readers import read_landing, read_layer

LAYERS = ("raw", "curated", "hourly")


def landing_to_hourly(
    spark: SparkSession, landing: str, root: str, as_of: str | None = None, days: tuple[str, str] | None = None
) -> dict[str, int]:
    """Landed stations to raw, curated and hourly tables by day; returns rows written.

    Without ``days`` the tables are replaced. With a range of days (the last one
    excluded) only those days are read and replaced; a day that has no rows any more goes.
    Landed files divided by ``landed_date`` are read for the days of the range only.
    """
    def rows(df: DataFrame, date_column: str | None = None) -> DataFrame:
        return filters.in_interval(df, "event_time", *days, date_column) if days else df

    def write(df: DataFrame, layer: str, gather: bool) -> int:
        def into(dated: DataFrame) -> None:
            if days:
                tables.replace_days(dated, f"{root}/{layer}", days, gather=gather)
            else:
                tables.replace(dated, f"{root}/{layer}", partition_by=["event_date"], gather=gather)

        return tables.counted(df, into)

    def layer(name: str) -> DataFrame:
        return rows(read_layer(spark, f"{root}/{name}"), "event_date").drop("event_date")

    landed = read_landing(spark, landing)
    by_day = "landed_date" if "landed_date" in landed.columns else None
    fresh = rows(landed, by_day).drop("landed_date")
    written = {"raw": write(tables.with_date(fresh, "event_time"), "raw", True)}
    # Raw files hold one day each, so curated rows are in place without a shuffle.
    curated = projections.curate_stations(layer("raw"), as_of)
    written["curated"] = write(tables.with_date(curated, "event_time"), "curated", False)
    hourly = aggregates.station_hourly_batch(layer("curated"))
    written["hourly"] = write(tables.with_date(hourly, "window_start"), "hourly", True)
    return written


def backfill(
    spark: SparkSession, landing: str, root: str, first_day: str, end_day: str, as_of: str | None = None
) -> dict[str, int]:
    """Rebuild the layers for a range of days, leaving all other days alone."""
    for day in (first_day, end_day):
        date.fromisoformat(day)  # whole days only: a part of a day would replace all of it
    return landing_to_hourly(spark, landing, root, as_of, (first_day, end_day))


def interval_batch(
    stations: DataFrame, lines: DataFrame, arrivals: DataFrame, start: str, end: str, date_column: str | None = None
) -> dict[str, DataFrame]:
    """Curated tables of one interval, and the hourly statistics over them."""

    def part(df: DataFrame) -> DataFrame:
        return filters.in_interval(df, "event_time", start, end, date_column)

    curated = projections.enrich_stations(part(stations))
    return {
        "stations": curated,
        "lines": projections.enrich_lines(part(lines)),
        "arrivals": projections.enrich_arrivals(part(arrivals)),
        "hourly": aggregates.station_hourly_located(curated),
    }


def run_interval(
    stations: DataFrame, lines: DataFrame, arrivals: DataFrame, root: str, start: str, end: str,
    date_column: str | None = None,
) -> None:
    """Write the tables of one interval; running it twice leaves one copy."""
    for name, df in interval_batch(stations, lines, arrivals, start, end, date_column).items():
        tables.replace_interval(df, f"{root}/{name}", start)


def incremental_enrich(raw: DataFrame, curated: DataFrame, date_column: str | None = None) -> DataFrame:
    """Curated rows for raw rows newer than the curated table, ready to append."""
    return projections.enrich_stations(filters.after_high_water(raw, curated, "event_time", date_column))


def maintain_dimension(
    target: DataFrame, raw: DataFrame, keys: list[str], tracked: list[str], ts: str, start: str, as_of: str,
    tiebreak: list[str],
) -> DataFrame:
    """Stage what an interval saw of the dimension and apply it."""
    staged = dimensions.stage_latest(raw, keys, tracked, ts, start, tiebreak)
    return dimensions.scd2(target, staged, keys, tracked, as_of)


def gate_table(curated: DataFrame, key: str, ts: str, as_of: str) -> DataFrame:
    """All gates of a curated table as pass/fail rows."""
    return quality.gates(quality.measure(curated, key, ts, as_of))


def smoke(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Count, write, read back, count again."""
    written = tables.counted(df, lambda rows: tables.replace(rows, path))
    back = tables.read_back_count(spark, path)
    return back.select(F.lit(written).cast("long").alias("written"), F.col("row_count").alias("read_back"))
