"""Dashboard views over the latest state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions import measures as m
from headway.operators import aggregates, joins, ranking


def bar(stations: DataFrame) -> DataFrame:
    """Width and label of a station's occupancy bar."""
    width = m.clamp(F.col("occupancy_pct"))
    return stations.withColumns({"bar_pct": width, "label_pct": m.whole_percent(width)})


def station_extremes(latest: DataFrame, n: int = 8) -> DataFrame:
    """The fullest and the emptiest stations."""
    full = ranking.fullest(latest, n).withColumn("side", F.lit("full"))
    return bar(full.unionByName(ranking.emptiest(latest, n).withColumn("side", F.lit("empty"))))


def line_board(lines: DataFrame, latest: DataFrame) -> DataFrame:
    """Every catalogue line in order, with its tone; lines without a status are unknown."""
    merged = joins.with_catalogue(lines, latest, "id", "line_id")
    return merged.withColumn("tone", m.status_tone(F.col("status_severity"))).orderBy("order", "id")


def line_counts(lines: DataFrame, latest: DataFrame) -> DataFrame:
    return aggregates.status_rollup(joins.with_catalogue(lines, latest, "id", "line_id"), "line_id")
