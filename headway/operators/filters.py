"""Row filters. All of them are plain predicates, so they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import ARRIVAL_SECONDS, EPOCH, KM_PER_DEGREE, LONDON_BOX
from headway.functions.text_time import at


def inside(column: str, bounds: tuple) -> Column:
    return F.col(column).between(*bounds)


def plausible_stations(df: DataFrame, box: dict[str, tuple[float, float]] = LONDON_BOX) -> DataFrame:
    """Stations with an id, a position in the box, docks, and no negative count."""
    located = [inside(axis, bounds) for axis, bounds in box.items()]
    counted = [F.col("nb_bikes") >= 0, F.col("nb_docks") > 0]
    for condition in [F.col("bike_point_id").isNotNull(), *located, *counted]:
        df = df.filter(condition)
    return df


def consistent_counts(df: DataFrame, bikes: str = "available_bikes", docks: str = "total_docks") -> DataFrame:
    """Stations with docks whose bikes fit into them."""
    return df.filter((F.col(docks) > 0) & F.col(bikes).between(F.lit(0), F.col(docks)))


def plausible_arrivals(df: DataFrame, seconds: tuple[int, int] = ARRIVAL_SECONDS) -> DataFrame:
    return required(df, "arrival_id", "vehicle_id").filter(inside("time_to_station", seconds))


def required(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys))


def in_interval(
    df: DataFrame, ts: str, start: str, end: str | None = None, date_column: str | None = None
) -> DataFrame:
    """Rows of ``[start, end)``; without an end, everything from the start on.

    Spark does not derive a date from a time on plain files, so for a table partitioned
    by date, name that column and only the days of the interval are read.
    """
    df = df.filter(F.col(ts) >= at(start))
    if end is not None:
        df = df.filter(F.col(ts) < at(end))
    if date_column:
        df = df.filter(F.col(date_column) >= at(start).cast("date"))
        if end is not None:
            df = df.filter(F.col(date_column) <= at(end).cast("date"))
    return df


def newer_than(df: DataFrame, ts: str, as_of: str, interval: str, inclusive: bool = False) -> DataFrame:
    """Rows younger than an interval; quality checks exclude the edge, history includes it."""
    edge = at(as_of) - F.expr(f"INTERVAL '{interval}'")
    return df.filter(F.col(ts) >= edge if inclusive else F.col(ts) > edge)


def high_water(target: DataFrame, ts: str) -> DataFrame:
    """The newest time of a table as one row, the epoch for an empty one."""
    return target.agg(F.coalesce(F.max(ts), at(EPOCH)).alias("high_water"))


def after_high_water(
    source: DataFrame, target: DataFrame, ts: str, date_column: str | None = None
) -> DataFrame:
    """Source rows newer than anything in the target.

    A scalar subquery, not a join: it runs first and its value is pushed to the scan.
    Rows that arrive late, or tie with the newest target row, are skipped.
    """
    mark = high_water(target, ts).scalar()
    fresh = source.filter(F.col(ts) > mark)
    return fresh.filter(F.col(date_column) >= mark.cast("date")) if date_column else fresh


def near(
    df: DataFrame, lat: float, lon: float, radius: float, per_degree: float = KM_PER_DEGREE
) -> DataFrame:
    """Square box around a point, edges included, the same half-width on both axes."""
    half = radius / per_degree
    return df.filter(inside("lat", (lat - half, lat + half)) & inside("lon", (lon - half, lon + half)))


def look_up(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def allowed(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin(values))


def keep_since(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    """Retention: drop rows older than a number of days."""
    return newer_than(df, ts, as_of, f"{days} days", inclusive=True)
