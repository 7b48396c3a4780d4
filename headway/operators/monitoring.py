"""Request rates, fallback ratios and conditions that last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.constants import FALLBACK_LIMIT, RATE_FLOOR

DAY = 86_400


def windowed_counts(
    requests: DataFrame, labels: list[str], measures: dict[str, Column], ts: str,
    width: str = "5 minutes", step: str = "1 minute",
) -> DataFrame:
    """Sums of conditions per label and sliding window.

    Rows are first added up per step; only those small sums are copied into the windows
    that overlap them, not every request.
    """
    pane = F.window(ts, step)["start"].alias("_pane")
    per_step = requests.groupBy(*labels, pane).agg(*[F.count_if(c).alias(n) for n, c in measures.items()])
    return (
        per_step.groupBy(*labels, F.window("_pane", width, step).alias("_window"))
        .agg(*[F.sum(n).alias(n) for n in measures])
        .withColumns({"window_start": F.col("_window.start"), "window_end": F.col("_window.end")})
        .drop("_window")
    )


def rate(
    requests: DataFrame, labels: list[str], ts: str, width: str = "5 minutes", step: str = "1 minute",
    seconds: float = 300.0,
) -> DataFrame:
    """Requests per second by label in each window."""
    counts = windowed_counts(requests, labels, {"requests": F.lit(True)}, ts, width, step)
    return counts.withColumn("rate", F.col("requests") / F.lit(seconds))


def fallback_ratio(
    requests: DataFrame, labels: list[str], fallback: Column, ts: str, width: str = "5 minutes",
    step: str = "1 minute", seconds: float = 300.0,
) -> DataFrame:
    """Share of requests served by the fallback, the total rate floored."""
    counts = windowed_counts(requests, labels, {"fallbacks": fallback, "requests": F.lit(True)}, ts, width, step)
    total = F.greatest(F.col("requests") / F.lit(seconds), F.lit(RATE_FLOOR))
    return counts.withColumn("ratio", (F.col("fallbacks") / F.lit(seconds)) / total)


def lasting(series: DataFrame, labels: list[str], condition: Column, step_seconds: int, min_steps: int) -> DataFrame:
    """Runs of consecutive windows where a condition holds, at least ``min_steps`` long.

    A window without traffic has no row and ends a run. Runs are found within each day; only
    they, not their windows, meet in one group to be joined across midnight.
    """
    seconds = F.unix_seconds(F.col("window_start").cast("timestamp"))
    breached = series.filter(condition).withColumns({"_step": F.floor(seconds / F.lit(step_seconds)), "_day": F.floor(seconds / F.lit(DAY))})
    position = F.row_number().over(W.partitionBy(*labels, "_day").orderBy("_step"))
    runs = (
        breached.withColumn("_run", F.col("_step") - position).groupBy(*labels, "_day", "_run")
        .agg(
            F.min("window_start").alias("since"), F.max("window_start").alias("until"),
            F.min("_step").alias("_first"), F.max("_step").alias("_last"), F.count("*").alias("steps"),
        )
    )
    order = W.partitionBy(*labels).orderBy("_first")
    opens = F.coalesce(F.col("_first") != F.lag("_last").over(order) + 1, F.lit(True)).cast("int")
    joined = runs.withColumn("_opens", opens).withColumn("_run", F.sum("_opens").over(order))
    return (
        joined.groupBy(*labels, "_run")
        .agg(F.min("since").alias("since"), F.max("until").alias("until"), F.sum("steps").alias("steps"))
        .filter(F.col("steps") >= min_steps)
        .drop("_run")
    )


def sustained_fallback(
    ratios: DataFrame, labels: list[str], limit: float = FALLBACK_LIMIT, step_seconds: int = 60, min_steps: int = 10
) -> DataFrame:
    return lasting(ratios, labels, F.col("ratio") > limit, step_seconds, min_steps)


def silent_outage(
    requests: DataFrame, good: Column, ts: str, width: str = "5 minutes", step: str = "1 minute",
    step_seconds: int = 60, min_steps: int = 15,
) -> DataFrame:
    """Times with traffic but no good answer, that last."""
    counts = windowed_counts(requests, [], {"good": good, "requests": F.lit(True)}, ts, width, step)
    silent = (F.col("good") == 0) & (F.col("requests") > 0)
    return lasting(counts.withColumn("scope", F.lit("all")), ["scope"], silent, step_seconds, min_steps)
