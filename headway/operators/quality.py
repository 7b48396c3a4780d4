"""Quality gates over a curated table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import LAYER_LAG_SECONDS, QUALITY_RULES
from headway.functions.text_time import at


class QualityError(ValueError):
    """A quality rule does not hold."""


def passes(value: Column, minimum: Column, maximum: Column) -> Column:
    """A missing value fails a minimum and passes a maximum; a missing rule passes."""
    enough = minimum.isNull() | F.coalesce(value >= minimum, F.lit(False))
    not_too_much = maximum.isNull() | F.coalesce(value <= maximum, F.lit(True))
    return enough & not_too_much


def measure(df: DataFrame, key: str, ts: str, as_of: str, fresh: str = "2 hours", complete: str = "24 hours") -> DataFrame:
    """Fresh rows, NULL keys and distinct recent keys, in one scan of the table."""
    recent = F.col(ts) > at(as_of) - F.expr(f"INTERVAL '{complete}'")
    return df.agg(
        F.count_if(F.col(ts) > at(as_of) - F.expr(f"INTERVAL '{fresh}'")).alias("freshness"),
        F.count_if(F.col(key).isNull()).alias("nulls"),
        F.count_distinct(F.when(recent, F.col(key))).alias("completeness"),
    )


def gates(measured: DataFrame, rules: list[tuple] = QUALITY_RULES) -> DataFrame:
    """One row per rule: check, value, min, max, passed."""
    # fixed small rule list, one struct per rule
    entries = [
        F.struct(
            F.lit(name).alias("check"), F.col(name).cast("long").alias("value"),
            F.lit(low).cast("long").alias("min"), F.lit(high).cast("long").alias("max"),
        )
        for name, low, high in rules
    ]
    rows = measured.select(F.inline(F.array(*entries)))
    return rows.withColumn("passed", passes(F.col("value"), F.col("min"), F.col("max")))


def enforce(gate_rows: DataFrame) -> None:
    """Raise when any gate is closed (a handful of rows, one per rule)."""
    failed = gate_rows.filter(~F.col("passed")).collect()
    if failed:
        raise QualityError("; ".join(f"{r.check}={r.value} not in [{r.min}, {r.max}]" for r in failed))


def layer_lag(health: DataFrame, as_of: str, limits: dict[str, int] = LAYER_LAG_SECONDS) -> DataFrame:
    """Seconds since the newest row of each layer, against its limit."""
    limit = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    lag = F.unix_seconds(at(as_of).cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    return (
        health.withColumn("lag_seconds", lag)
        .withColumn("limit_seconds", F.try_element_at(limit, F.col("table_name")).cast("long"))
        .withColumn("within_limit", F.coalesce(F.col("lag_seconds") <= F.col("limit_seconds"), F.lit(False)))
    )
