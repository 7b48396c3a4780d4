"""Looking at neighbouring rows of a key without gathering the key in one task.

Rows are ordered within (key, time slice); what must cross a slice border travels as one row
per key and slice. A slice lies within one day and between two quantiles of all times, so a
key that holds a third of the data is spread over days, and a burst within a day over the
quantiles. A single time far off, in the past or future, is in a slice of its own and moves
no border of the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY = 86_400
#: Parts of equal numbers of rows that times are divided into, and the exactness of their borders.
QUANTILES, ACCURACY = 64, 10_000


def sliced(df: DataFrame, ts: str, quantiles: int = QUANTILES) -> DataFrame:
    """Adds ``_slice``, (part, day) of a row, ordered like time.

    The borders are a scalar subquery over the time column, run with the query and not while it
    is built. Any borders give the same results; these keep slices even.
    """
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    shares = F.array(*[F.lit(n / quantiles) for n in range(1, quantiles)])
    borders = df.agg(F.percentile_approx(seconds, shares, ACCURACY)).scalar()

    def part(low: int, high: int) -> Column:
        """Number of borders at or before the row's time, by halving."""
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("_seconds") < F.get("_borders", F.lit(middle)), part(low, middle)).otherwise(part(middle + 1, high))

    timed = df.withColumns({"_borders": borders, "_seconds": seconds})
    place = F.struct(part(0, quantiles - 1).alias("part"), F.floor(F.col("_seconds") / F.lit(DAY)).alias("day"))
    return timed.withColumn("_slice", place).drop("_borders", "_seconds")


def with_previous(
    df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], columns: list[str], quantiles: int = QUANTILES
) -> DataFrame:
    """Add struct ``previous`` with some columns of the preceding row of the key.

    Only the first row of a slice looks beyond it, to the last row of the key's slice
    before. Both parts read the same shuffled rows.
    """
    payload = F.struct(*columns)
    within = W.partitionBy(*keys, "_slice").orderBy(ts, *tiebreak)
    whole = within.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = sliced(df, ts, quantiles).withColumns(
        {"_before": F.lag(payload).over(within), "_last": F.last(payload).over(whole)}
    )
    across = W.partitionBy(*keys).orderBy("_slice")
    inner = rows.filter(F.col("_before").isNotNull()).withColumn("previous", F.col("_before"))
    first = rows.filter(F.col("_before").isNull()).withColumn("previous", F.lag("_last").over(across))
    return inner.unionByName(first).drop("_before", "_last", "_slice")


def with_next_time(df: DataFrame, keys: list[str], ts: str, marked: Column, quantiles: int = QUANTILES) -> DataFrame:
    """Add ``next_time``: the earliest time of a marked row of the key, at or after the row.

    Each slice learns the first marked time of the slices after it. Both sides of the join
    come from the rows dealt once by key and slice.
    """
    placed = sliced(df, ts, quantiles).withColumn("_hit", F.when(marked, F.col(ts)))
    slice_of_key = W.partitionBy(*keys, "_slice")
    rows = placed.withColumns({
        "_here": F.min("_hit").over(slice_of_key.orderBy(F.desc(ts))),  # peers of equal time included
        "_first": F.min("_hit").over(slice_of_key),
    })
    first = rows.groupBy(*keys, "_slice").agg(F.min("_first").alias("_first"))
    later = W.partitionBy(*keys).orderBy(F.desc("_slice")).rowsBetween(W.unboundedPreceding, -1)
    edges = first.withColumn("_after", F.min("_first").over(later)).drop("_first")
    joined = rows.drop("_first").join(edges, [*keys, "_slice"], "left")
    return joined.withColumn("next_time", F.coalesce("_here", "_after")).select(*df.columns, "next_time")


def mean_gap_between_starts(
    df: DataFrame, keys: list[str], ts: str, tiebreak: list[str], bad: Column, quantiles: int = QUANTILES
) -> DataFrame:
    """Mean seconds from the start of one bad run of a key to the start of the next."""
    marked = df.withColumn("_bad", F.coalesce(bad, F.lit(False)))
    ordered = with_previous(marked, keys, ts, tiebreak, ["_bad"], quantiles)
    starts = ordered.filter(F.col("_bad") & ~F.coalesce(F.col("previous._bad"), F.lit(False)))
    span = F.unix_micros(F.max(ts).cast("timestamp")) - F.unix_micros(F.min(ts).cast("timestamp"))
    return starts.groupBy(*keys).agg(
        F.count("*").alias("disruptions"),
        F.try_divide(span / F.lit(1e6), F.count("*") - 1).alias("mean_seconds_between"),
    )


def share_within(df: DataFrame, group: str, value: str) -> DataFrame:
    """How often each value occurs, and its share of the group.

    Totals come from a second small aggregation and a join: a group may hold many values.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("occurrences"))
    totals = counts.groupBy(F.col(group).alias("_group")).agg(F.sum("occurrences").alias("_total"))
    joined = counts.join(totals, F.col(group).eqNullSafe(F.col("_group")))
    return joined.select(group, value, "occurrences", (F.col("occurrences") / F.col("_total")).alias("share"))


def churn(
    df: DataFrame, key: str, area: str, hour: Column, level: str, ts: str, tiebreak: list[str], quantiles: int = QUANTILES
) -> DataFrame:
    """Bikes moved per area and hour: absolute changes between readings of a station."""
    ordered = with_previous(df, [key], ts, tiebreak, [level], quantiles)
    moved = F.abs(F.col(level) - F.col(f"previous.{level}"))
    return ordered.groupBy(area, hour.alias("hour")).agg(F.coalesce(F.sum(moved), F.lit(0)).alias("moved"))
