"""A type-2 dimension on plain files whose loads cost as much as the current rows, not as all history.

Each load writes the current rows and the versions it closed, in one job, into a folder of its own.
A version file then names the load that holds the current rows and all loads that closed some. Closed
versions are never written again. A load that was repeated, or died before its version appeared, leaves one
copy.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.dimensions import VALIDITY, first_versions, scd2_step
from headway.sinks.files import create_once, folders, read_text

CURRENT = "_is_current"


class History:
    """The versions of a dimension's rows: ``keys`` and ``tracked`` columns with their validity."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], tracked: list[str]) -> None:
        self.spark, self.path, self.keys, self.tracked = spark, path.rstrip("/"), keys, tracked

    def loads(self) -> tuple[int, list[str]]:
        """Number of the newest version and its loads, the current one last."""
        names = sorted(n for n in folders(self.spark, f"{self.path}/_versions") if n.endswith(".json"))
        return (int(names[-1].removesuffix(".json")), json.loads(read_text(self.spark, f"{self.path}/_versions/{names[-1]}"))["loads"]) if names else (0, [])

    @staticmethod
    def _name(as_of: str) -> str:
        return as_of.replace(":", "").replace(" ", "T")

    def _part(self, load: str, current: bool) -> str:
        return f"{self.path}/load={load}/{CURRENT}={str(current).lower()}"

    def _rows(self, paths: list[str], current: bool) -> DataFrame | None:
        rows = self.spark.read.parquet(*paths).withColumn(CURRENT, F.lit(current)) if paths else None
        return rows.select(*self.keys, *self.tracked, *VALIDITY) if rows is not None else None

    def _there(self, load: str, current: bool) -> bool:
        return f"{CURRENT}={str(current).lower()}" in folders(self.spark, f"{self.path}/load={load}")

    def current(self) -> DataFrame | None:
        """One row per key; None before the first load."""
        _, loads = self.loads()
        return self._rows([self._part(loads[-1], True)], True) if loads and self._there(loads[-1], True) else None

    def read(self) -> DataFrame:
        """All versions."""
        _, loads = self.loads()
        parts = [self.current(), self._rows([self._part(load, False) for load in loads if self._there(load, False)], False)]
        found = [p for p in parts if p is not None]
        if not found:
            raise FileNotFoundError(f"{self.path} has no load yet")
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def load(self, incoming: DataFrame, as_of: str) -> bool:
        """Apply one row per key as of a time; False if that load is in already."""
        number, loads = self.loads()
        name = self._name(as_of)
        if name in loads:
            return False
        before = self.current()
        staged = incoming.select(*self.keys, *self.tracked)
        rows = first_versions(staged, as_of) if before is None else scd2_step(before, staged, self.keys, self.tracked, as_of)
        rows.write.mode("overwrite").partitionBy(CURRENT).parquet(f"{self.path}/load={name}")
        if not create_once(self.spark, f"{self.path}/_versions/{number + 1:012d}.json", json.dumps({"loads": [*loads, name]})):
            raise RuntimeError(f"{self.path} was loaded by another run meanwhile")
        return True
