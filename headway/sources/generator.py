"""Synthetic line-status feed, one row per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.constants import FEED_LINES, SEVERITIES
from headway.functions.text_time import at

HOURS_BACK = 72
ISO = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def draw(row_id: Column, seed: int, field: str, choices: int) -> Column:
    """A number in [0, choices) that depends only on the row, the seed and the field."""
    digest = F.md5(F.concat_ws(":", row_id.cast("string"), F.lit(str(seed)), F.lit(field)))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(choices)).cast("int")


def _pick(options: list[tuple], names: list[str], index: Column) -> Column:
    entries = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, option)]) for option in options]
    return F.get(F.array(*entries), index)


def line_status_feed(ids: DataFrame, id_column: str, as_of: str, seed: int = 0) -> DataFrame:
    """Random lines and weighted severities over the last 72 hours, repeatable per seed.

    Runs on any table of ids; each row is made on its own, so a lost task remakes the
    same rows.
    """
    weighted = [(code, text) for code, text, weight in SEVERITIES for _ in range(weight)]
    row = F.col(id_column)
    drawn = ids.select(
        row.alias("feed_id"),
        _pick(FEED_LINES, ["id", "name", "mode"], draw(row, seed, "line", len(FEED_LINES))).alias("line"),
        _pick(weighted, ["code", "text"], draw(row, seed, "severity", len(weighted))).alias("severity"),
        draw(row, seed, "hours", HOURS_BACK + 1).alias("hours"),
    )
    event_time = at(as_of) - F.make_dt_interval(hours=F.col("hours"))
    reason = F.concat(F.lit("Test disruption reason for "), F.col("line.name"))
    return drawn.select(
        "feed_id",
        F.col("line.id").alias("line_id"), F.col("line.name").alias("line_name"), F.col("line.mode").alias("mode_name"),
        F.col("severity.code").alias("status_severity"),
        F.col("severity.text").alias("status_severity_description"),
        F.when(F.col("severity.code") != 10, reason).alias("reason"),
        F.date_format(event_time - F.expr("INTERVAL '1 hour'"), ISO).alias("valid_from"),
        F.date_format(event_time, ISO).alias("valid_to"),
        F.date_format(event_time, ISO).alias("ingested_at"),
    )


def generate(spark: SparkSession, rows: int, as_of: str, seed: int = 0) -> DataFrame:
    return line_status_feed(spark.range(rows), "id", as_of, seed)
