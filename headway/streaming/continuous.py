"""Conditions that last, and predictions against what was observed, on running streams.

All outputs are in append mode: a row appears once, when the watermark has passed all that could change it.
State holds what is not closed yet, so it follows the disorder allowed and not the age of the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import FALLBACK_LIMIT, RATE_FLOOR
from headway.streaming.jobs import TABLE_DISORDER, watermarked

MINUTE = 60


def sliding_counts(
    stream: DataFrame, labels: list[str], measures: dict[str, Column], ts: str, delay: str = TABLE_DISORDER,
    width: str = "5 minutes", step: str = "1 minute",
) -> DataFrame:
    """Sums of conditions per label and sliding window, as ``monitoring.windowed_counts`` has them for a table.

    Rows are added up per step, within map tasks first; closed steps go on to the windows that overlap them.
    """
    steps = watermarked(stream, ts, delay).groupBy(*labels, F.window(ts, step).alias("_pane")).agg(
        *[F.count_if(c).alias(n) for n, c in measures.items()]
    )
    wide = F.window(F.window_time("_pane"), width, step).alias("window")
    return steps.groupBy(*labels, wide).agg(*[F.sum(n).alias(n) for n in measures])


def lasting_windows(windows: DataFrame, labels: list[str], condition: Column, step_seconds: int = MINUTE, min_steps: int = 10) -> DataFrame:
    """Runs of consecutive windows where a condition holds, at least ``min_steps`` long, once they are over.

    A run is a session of window ends: a step and a half without a window that holds the condition ends it. That
    joins neighbours one step apart and no others. An open run costs one row of state per label.
    """
    gap = f"{step_seconds * 3 // 2} seconds"
    run = F.session_window(F.window_time("window"), gap).alias("_run")
    since = F.col("window.start").alias("_start")
    return (
        windows.filter(condition).select(*labels, "window", since).groupBy(*labels, run)
        .agg(F.min("_start").alias("since"), F.max("_start").alias("until"), F.count("*").alias("steps"))
        .filter(F.col("steps") >= min_steps)
        .select(*labels, *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("since", "until")], "steps")
    )


def fallback_alerts(
    requests: DataFrame, labels: list[str], fallback: Column, ts: str, delay: str = TABLE_DISORDER,
    limit: float = FALLBACK_LIMIT, min_steps: int = 10, seconds: float = 300.0,
) -> DataFrame:
    """Labels whose share of fallbacks stays beyond the limit; the total rate is floored."""
    counts = sliding_counts(requests, labels, {"fallbacks": fallback, "requests": F.lit(True)}, ts, delay)
    total = F.greatest(F.col("requests") / F.lit(seconds), F.lit(RATE_FLOOR))
    return lasting_windows(counts, labels, (F.col("fallbacks") / F.lit(seconds)) / total > limit, MINUTE, min_steps)


def outage_alerts(requests: DataFrame, good: Column, ts: str, delay: str = TABLE_DISORDER, min_steps: int = 15) -> DataFrame:
    """Times with traffic but no good answer, that last."""
    scoped = requests.withColumn("scope", F.lit("all"))
    counts = sliding_counts(scoped, ["scope"], {"good": good, "requests": F.lit(True)}, ts, delay)
    return lasting_windows(counts, ["scope"], (F.col("good") == 0) & (F.col("requests") > 0), MINUTE, min_steps)


def observed_next(
    predictions: DataFrame, observations: DataFrame, keys: list[str], identity: str, ts: str,
    within: str = "1 hour", delay: str = TABLE_DISORDER,
) -> DataFrame:
    """Each prediction with the first observation of its key at or after it, none if it took longer than ``within``.

    Both sides have a watermark, and the join is bounded in time both ways, so either side's rows leave the state when no
    partner can come any more. Of the observations of a key that share a time one is joined. A prediction meets those of its
    key within the horizon, so keys should be fine (a vehicle at a stop) and the horizon no longer than a prediction is of use.
    """
    seen = watermarked(observations.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(ts).alias("_seen")), "_seen", delay)
    seen = seen.dropDuplicatesWithinWatermark([*[f"_{k}" for k in keys], "_seen"])
    made = watermarked(predictions.select(*keys, identity, ts), ts, delay)
    on = (F.col("_seen") >= F.col(ts)) & (F.col("_seen") <= F.col(ts) + F.expr(f"INTERVAL '{within}'"))
    for key in keys:
        on = on & (F.col(key) == F.col(f"_{key}"))
    # Times other than the pane's travel as numbers: a stream has one event time column.
    made_at, seen_at = F.unix_micros(ts).alias("_made"), F.unix_micros("_seen")
    pane = F.window(ts, "1 minute").alias("_pane")
    first = made.join(seen, on, "left_outer").groupBy(*keys, identity, made_at, pane).agg(F.min(seen_at).alias("_first"))
    times = [F.timestamp_micros(c).cast("timestamp_ntz").alias(n) for c, n in (("_made", ts), ("_first", "observed"))]
    return first.select(*keys, identity, *times, ((F.col("_first") - F.col("_made")) / F.lit(1e6)).alias("drift_seconds"))
