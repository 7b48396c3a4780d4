"""Latest rows, last N per key, and ordered heads.

Every order carries a tiebreak, so results do not depend on how data is split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions.text_time import at
from headway.operators.filters import look_up, newer_than


def _head_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def remaining(df: DataFrame, *used: str) -> list[str]:
    """All other columns that can be ordered, in a fixed order: a tiebreak that leaves only equal rows tied."""
    return sorted(f.name for f in df.schema if f.name not in used and f.dataType.typeName() not in ("map", "variant"))


def latest_per_key(df: DataFrame, keys: list[str], order: str, tiebreak: list[str]) -> DataFrame:
    """Newest row per key.

    The rank filter is applied before the shuffle too, so each map task sends at most
    one row per key and a hot key stays cheap.
    """
    return _head_per_group(df, keys, [F.desc(c) for c in [order, *tiebreak]], 1)


def latest_by_arrival(df: DataFrame, keys: list[str], offset: str = "offset") -> DataFrame:
    """Last row to arrive per key, whatever its event time."""
    return _head_per_group(df, keys, [F.desc(offset)], 1)


def compacted(changelog: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """A keyed log as its readers see it: newest value per key, deleted keys gone."""
    return latest_by_arrival(changelog, [key]).filter(F.col(value).isNotNull())


def last_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1000, spread: int = 256) -> DataFrame:
    """The first n rows per key in the given order.

    Each map task sends at most n rows per key. With many tasks that would still be too
    much for one reducer of a hot key, so tasks are dealt to ``spread`` groups, each cut
    to n rows per key, before the key is cut as a whole.
    """
    dealt = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(spread)))
    cut = _head_per_group(dealt, [*keys, "_group"], order, n)
    return _head_per_group(cut.drop("_group"), keys, order, n)


def fullest(latest: DataFrame, n: int = 8) -> DataFrame:
    """Stations nearest to full."""
    return latest.orderBy(F.desc("occupancy_pct"), "bike_point_id").limit(n)


def emptiest(latest: DataFrame, n: int = 8) -> DataFrame:
    """Stations nearest to empty, among those that report any bike or dock."""
    reported = F.col("nb_bikes").cast("long") + F.col("nb_ebikes") + F.col("nb_empty_docks")
    return latest.filter(reported > 0).orderBy(F.asc_nulls_last("occupancy_pct"), "bike_point_id").limit(n)


def recent_for_key(df: DataFrame, key: str, value: object, order: str, tiebreak: list[str], n: int = 48) -> DataFrame:
    return look_up(df, key, value).orderBy(F.desc(order), *tiebreak).limit(n)


def next_for_key(df: DataFrame, key: str, value: object, order: str, tiebreak: list[str], n: int = 20) -> DataFrame:
    """Soonest rows of a key; rows without a time come last."""
    return look_up(df, key, value).orderBy(F.asc_nulls_last(order), *tiebreak).limit(n)


def history(df: DataFrame, ts: str, as_of: str, interval: str = "24 hours", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """Everything of the last interval, newest first."""
    return newer_than(df, ts, as_of, interval, inclusive=True).orderBy(F.desc(ts), *tiebreak)


def sample_rows(df: DataFrame, n: int = 50) -> DataFrame:
    """Any n rows."""
    return df.limit(n)


def snapshot_then_live(
    messages: DataFrame, cut: str, keys: list[str], ts: str, tiebreak: list[str], n: int = 1000
) -> DataFrame:
    """What a subscriber joining at ``cut`` receives: the last n per key, then all that follows."""
    before, since = messages.filter(F.col(ts) < at(cut)), messages.filter(F.col(ts) >= at(cut))
    order = [F.desc(ts), *[F.desc(c) for c in tiebreak]]
    replay = last_n_per_key(before, keys, order, n)
    return replay.withColumn("snapshot", F.lit(True)).unionByName(since.withColumn("snapshot", F.lit(False)))
