"""Helpers that several operators share: reading tables, settling results, names that clash with nothing."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import headway
from headway.session import run_dir


#: Rows that a Python worker gets at a time; with whole texts, Spark's default holds too many.
BATCH_ROWS = 4096


def importable() -> None:
    """Prepares the session for Python workers: small batches, and this package where the driver found it."""
    SparkSession.active().conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    home = os.path.dirname(os.path.dirname(os.path.abspath(headway.__file__)))
    environment = SparkSession.active().sparkContext.environment
    if home not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [home, environment.get("PYTHONPATH", "")]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the folder that all machines share.

    What is random or depends on how rows met in a task is then fixed, also for tasks that run
    again after an executor is lost.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(run_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    """The number of parts that the session deals shuffled rows to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without columns of these names, in whatever case, so that results can take them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])
