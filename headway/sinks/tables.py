"""Table writes: append, replace, per-interval overwrite, upsert, counted writes."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway.operators.ranking import latest_per_key
from headway.sinks.files import files_of


def _writer(df: DataFrame, fmt: str, partition_by: list[str], gather: bool = True):
    """Writer of a table; ``gather`` evens out files per partition value by a shuffle.

    A hot day is split and small days are merged. Rows read from files that already hold
    one partition value each need no gathering.
    """
    if partition_by and gather:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt)
    return writer.partitionBy(*partition_by) if partition_by else writer


def with_date(df: DataFrame, ts: str, name: str = "event_date") -> DataFrame:
    """The partition column of event tables."""
    return df.withColumn(name, F.col(ts).cast("date"))


def append(df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Add rows to a path or a catalog table."""
    writer = _writer(df, fmt, partition_by or []).mode("append")
    writer.save(table) if "/" in table else writer.saveAsTable(table)


def replace(
    df: DataFrame, table: str, fmt: str = "parquet", partition_by: list[str] | None = None, gather: bool = True
) -> None:
    """Create or replace a table from a query.

    A path is written beside the old one and swapped in when complete, so the query may
    read the table it replaces, and a failed write or a failed swap leaves the old one (see ``_swap``).
    """
    writer = _writer(df, fmt, partition_by or [], gather)
    if "/" not in table:
        writer.mode("overwrite").saveAsTable(table)
        return
    parent, name = table.rstrip("/").rsplit("/", 1)
    fresh = f"{parent}/_next-{uuid.uuid4().hex}-{name}"
    writer.save(fresh)
    _swap(df.sparkSession, fresh, table)


def _swap(spark: SparkSession, fresh: str | None, path: str) -> None:
    """Put a complete folder in place of another; without one, take the other away.

    The old folder is moved aside first and moved back should the new one not arrive. Between the
    two renames there is no folder of that name, and a driver that dies right there leaves the old one
    aside (``_old-``), complete. Readers that must not meet this, and stores on which a rename copies, want a
    table whose versions are named by a file (``sinks.keyed``, ``sinks.history``) or a catalog's.
    """
    files, target = files_of(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    aside = files_of(spark, f"{parent}/_old-{uuid.uuid4().hex}-{name}")[1]
    had = files.exists(target)
    if had and not files.rename(target, aside):
        raise OSError(f"{path} could not be moved aside")
    moved = False
    try:
        moved = fresh is None or files.rename(files_of(spark, fresh)[1], target)
    finally:
        if not moved and had:
            files.rename(aside, target)
    if not moved:
        raise OSError(f"{fresh} is complete but could not be moved to {path}")
    if had:
        files.delete(aside, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """A stream can only watch a folder that exists."""
    files, target = files_of(spark, path)
    files.mkdirs(target)


def replace_days(df: DataFrame, path: str, days: tuple[str, str], fmt: str = "parquet", gather: bool = True) -> None:
    """Replace the days of a range (the last one excluded) by the rows of ``df``, and no others.

    A day for which there are no rows is gone afterwards. The new days are written beside
    the table and moved in one by one when all are complete.
    """
    first, end = (date.fromisoformat(day) for day in days)
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}/_next-{uuid.uuid4().hex}"
    _writer(df.filter((F.col("event_date") >= F.lit(first)) & (F.col("event_date") < F.lit(end))), fmt, ["event_date"], gather).save(fresh)
    files, _ = files_of(spark, fresh)
    for n in range((end - first).days):
        name = f"event_date={first + timedelta(n)}"
        new = f"{fresh}/{name}"
        _swap(spark, new if files.exists(files_of(spark, new)[1]) else None, f"{path.rstrip('/')}/{name}")
    files.delete(files_of(spark, fresh)[1], True)


def replace_interval(df: DataFrame, path: str, start: str, fmt: str = "parquet") -> None:
    """Write one processing interval into its own partition; running it again replaces it.

    Intervals need not start at midnight, so they are kept apart by their start. The
    partition's folder is overwritten itself, so a run without rows empties it.
    """
    name = "interval_start=" + start.replace("%", "%25").replace(":", "%3A").replace("/", "%2F")
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static").save(f"{path.rstrip('/')}/{name}")


def drop_days_before(spark: SparkSession, path: str, before: str) -> list[str]:
    """Retention of a table partitioned by day: delete whole folders, rewrite nothing."""
    files, root = files_of(spark, path)
    names = [entry.getPath().getName() for entry in files.listStatus(root)]
    old = sorted(n for n in names if n.startswith("event_date=") and n[len("event_date="):] < before)
    for name in old:
        files.delete(files_of(spark, f"{path}/{name}")[1], True)
    return old


def counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return its rows, counted on the way and not by a second pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def read_back_count(spark: SparkSession, table: str, fmt: str = "parquet") -> DataFrame:
    """Rows of a written table, read again."""
    df = spark.read.format(fmt).load(table) if "/" in table else spark.table(table)
    return df.agg(F.count("*").alias("row_count"))


def upsert_latest(target: DataFrame, batch: DataFrame, keys: list[str], order: str, tiebreak: list[str]) -> DataFrame:
    """Target after a batch: the newest row per key of both; a repeated batch changes nothing."""
    return latest_per_key(target.unionByName(batch), keys, order, tiebreak)


def merge_latest(batch: DataFrame, table: str, keys: list[str], order: str, tiebreak: list[str]) -> None:
    """The same upsert as MERGE, for catalogs whose tables support it."""
    newest = latest_per_key(batch, keys, order, tiebreak).alias("src")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"{table}.{key}") == F.col(f"src.{key}"))
    newer = F.col(f"src.{order}") >= F.col(f"{table}.{order}")
    newest.mergeInto(table, on).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()


# --- tables written batch by batch --------------------------------------------------
# Plain files cannot be updated in place, so each batch of a stream has a folder of its
# own. A latest-state log holds the newest row per key of each batch.


def write_batch(
    df: DataFrame, path: str, batch_id: int, fmt: str = "parquet", partition_by: list[str] | None = None
) -> None:
    """Write a batch unless it is complete already, as when a stream repeats its last batch."""
    folder = f"{path}/batch_id={batch_id}"
    files, done = files_of(df.sparkSession, f"{folder}/_SUCCESS")
    if files.exists(done):
        return
    writer = _writer(df, fmt, partition_by or [], gather=False).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").save(folder)


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path).drop("batch_id")


def read_latest(spark: SparkSession, path: str, keys: list[str], order: str, tiebreak: list[str]) -> DataFrame:
    return latest_per_key(read_batches(spark, path), keys, order, tiebreak)


def compact_latest(spark: SparkSession, path: str, into: str, keys: list[str], order: str, tiebreak: list[str]) -> None:
    """One row per key into a new log folder, as its batch -1; later batches go on from there."""
    write_batch(read_latest(spark, path, keys, order, tiebreak), into, -1)


def rewrite_days(spark: SparkSession, path: str, into: str, before: str, fmt: str = "parquet") -> None:
    """Closed days of an event table in full-sized files; many small commits leave small ones."""
    closed = spark.read.format(fmt).load(path).filter(F.col("event_date") < F.lit(before).cast("date"))
    _writer(closed, fmt, ["event_date"]).mode("overwrite").option("partitionOverwriteMode", "dynamic").save(into)
