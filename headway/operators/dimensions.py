"""Type-2 history of a slowly changing dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.constants import FAR_FUTURE
from headway.functions.text_time import at
from headway.operators.filters import in_interval
from headway.operators.ranking import latest_per_key

VALIDITY = ["_valid_from", "_valid_until", "_is_current"]


def stage_distinct(raw: DataFrame, columns: list[str], ts: str, start: str) -> DataFrame:
    """Distinct attribute rows seen since the interval start."""
    return in_interval(raw, ts, start).select(*columns).distinct()


def stage_latest(
    raw: DataFrame, keys: list[str], tracked: list[str], ts: str, start: str, tiebreak: list[str]
) -> DataFrame:
    """One row per key: its newest attributes since the interval start."""
    since = in_interval(raw, ts, start)
    return latest_per_key(since, keys, ts, tiebreak).select(*keys, *tracked)


def first_versions(staged: DataFrame, as_of: str) -> DataFrame:
    """Staged rows as the current rows of a new dimension."""
    return staged.withColumns(
        {"_valid_from": at(as_of), "_valid_until": at(FAR_FUTURE), "_is_current": F.lit(True)}
    )


def scd2_step(current: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str], as_of: str) -> DataFrame:
    """Current rows after one row per key came in, and the versions that this closes.

    Changed rows are closed at ``as_of`` and followed by a new version, new keys get their first,
    and keys not seen stay as they are. One join on the key serves closing and inserting.
    Comparison is null-safe, so applying the same input again changes nothing.
    """
    columns = [*keys, *tracked, *VALIDITY]
    known = current.select(F.struct(*columns).alias("cur"), *keys)
    fresh = first_versions(incoming.select(*keys, *tracked), as_of).select(F.struct(*columns).alias("inc"), *keys)

    cur, inc = F.col("cur"), F.col("inc")
    same = F.lit(True)
    for name in tracked:
        same = same & cur[name].eqNullSafe(inc[name])
    closed = cur.withField("_valid_until", at(as_of)).withField("_is_current", F.lit(False))
    rows: Column = (
        F.when(cur.isNull(), F.array(inc))
        .when(inc.isNull() | same, F.array(cur))
        .otherwise(F.array(closed, inc))
    )
    return known.join(fresh, keys, "full").select(F.inline(rows))


def scd2(target: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str], as_of: str) -> DataFrame:
    """Apply one row per key to a history table with one current row per key; closed history is only passed on."""
    history = target.filter(~F.col("_is_current") | F.col("_is_current").isNull()).select(*keys, *tracked, *VALIDITY)
    return history.unionByName(scd2_step(target.filter("_is_current"), incoming, keys, tracked, as_of))
