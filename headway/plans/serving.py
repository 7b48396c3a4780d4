"""Queries behind the API: bounded, filtered reads of the layer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headway.constants import M_PER_DEGREE
from headway.operators import filters, projections, ranking


def line_status(latest: DataFrame, line_id: str | None = None, tiebreak: tuple[str, ...] | None = None) -> DataFrame:
    """Present status of all lines, or of one; the key filter goes below the ranking.

    Without a tiebreak all other columns break ties.
    """
    ties = list(tiebreak) if tiebreak else ranking.remaining(latest, "line_id", "last_updated")
    rows = ranking.latest_per_key(latest, ["line_id"], "last_updated", ties)
    if line_id is not None:
        rows = filters.look_up(rows, "line_id", line_id)
    return projections.status_document(rows)


def line_history(raw: DataFrame, line_id: str, as_of: str, tiebreak: tuple[str, ...] | None = None) -> DataFrame:
    """A line's status over the last 24 hours, newest first."""
    rows = filters.look_up(raw, "line_id", line_id)
    ties = tiebreak or tuple(ranking.remaining(rows, "event_time"))
    return ranking.history(rows, "event_time", as_of, "24 hours", ties)


def stations_near(curated: DataFrame, lat: float, lon: float, radius_km: float = 0.5) -> DataFrame:
    return projections.station_document(filters.near(curated, lat, lon, radius_km))


def stations_within(curated: DataFrame, lat: float, lon: float, radius_m: int = 500) -> DataFrame:
    """The same with a radius in metres."""
    return projections.station_document(filters.near(curated, lat, lon, radius_m, M_PER_DEGREE))


def station(curated: DataFrame, station_id: str) -> DataFrame:
    return projections.station_document(filters.look_up(curated, "bike_point_id", station_id))


def any_stations(curated: DataFrame, n: int = 50) -> DataFrame:
    return projections.station_document(ranking.sample_rows(curated, n))


def station_hourly(hourly: DataFrame, station_id: str, n: int = 48) -> DataFrame:
    """The latest hours of a station."""
    ties = ranking.remaining(hourly, "bike_point_id", "window_start")
    return ranking.recent_for_key(hourly, "bike_point_id", station_id, "window_start", ties, n)


def stop_arrivals(arrivals: DataFrame, stop_id: str, n: int = 20) -> DataFrame:
    """The next arrivals at a stop."""
    rows = ranking.next_for_key(arrivals, "stop_id", stop_id, "expected_arrival", ["arrival_id", "vehicle_id"], n)
    return projections.arrival_document(rows)
