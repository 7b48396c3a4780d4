"""Tables with one row per key on plain files: merged when read, rewritten bucket by bucket.

A batch adds a delta: its newest row per key. A base holds the rows of earlier deltas, dealt to
buckets by a hash of the key; it is merged with the deltas behind it whenever the table is read.
``compact`` rewrites the buckets that the deltas touch, and no others, beside the old ones. A version
file then names the folder of each bucket and the last delta in it. It appears at once or not at all, and
only if no other compaction came first. A reader keeps the files of the version it found; ``vacuum`` removes
what the last versions don't name.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from headway.operators.ranking import latest_per_key
from headway.sinks.files import create_once, folders, read_text, remove
from headway.sinks.tables import write_batch
from headway.streaming.jobs import paced

BUCKET = "_bucket"


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & left[key].eqNullSafe(right[key])
    return on


def merged(base: DataFrame, newest: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of a base after newer rows, one per key on both sides; the larger order wins, the base where equal.

    The base is joined by key but not ranked: where the newer rows are few, as Spark knows from their
    files, they are broadcast and the base is not shuffled.
    """
    columns = base.columns
    packed = newest.select(*keys, F.struct(*columns).alias("_new"))
    new, old = F.col("_new"), F.struct(*[base[c] for c in columns])
    newer = F.struct(*[new[c] for c in order]) > F.struct(*[base[c] for c in order])
    kept = base.join(packed, _same(base, packed, keys), "left").select(F.when(new.isNotNull() & newer, new).otherwise(old).alias("_row"))
    known = base.select(*[F.col(k).alias(k) for k in keys])
    added = newest.join(known, _same(newest, known, keys), "left_anti").select(columns)
    return kept.select("_row.*").unionByName(added)


class KeyedTable:
    """A table of the newest row per key, by ``order`` and then ``tiebreak``."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: str, tiebreak: list[str], buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.order, self.tiebreak = spark, path.rstrip("/"), keys, order, tiebreak
        self.buckets = buckets

    # --- versions

    def version(self) -> tuple[int, dict]:
        """Number and content of the newest version; 0 before the first compaction."""
        found = folders(self.spark, f"{self.path}/_versions")
        names = [name for name in found if name.endswith(".json")]
        if not names:
            return 0, {"buckets": self.buckets, "upto": -1, "base": {}}
        return int(max(names).removesuffix(".json")), json.loads(read_text(self.spark, f"{self.path}/_versions/{max(names)}"))

    def _deltas(self, upto: int) -> list[int]:
        """Complete deltas behind a version."""
        ids = [int(n.split("=")[1]) for n in folders(self.spark, f"{self.path}/deltas") if n.startswith("batch_id=")]
        return sorted(i for i in ids if i > upto and "_SUCCESS" in folders(self.spark, f"{self.path}/deltas/batch_id={i}"))

    # --- writing

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """The newest row per key of a batch; batches count up, and a repeated one changes nothing."""
        if batch_id > self.version()[1]["upto"]:
            write_batch(latest_per_key(rows, self.keys, self.order, self.tiebreak), f"{self.path}/deltas", batch_id)

    def fed_by(self, stream: DataFrame, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
        """A stream whose batches are added."""
        return paced(stream.writeStream.foreachBatch(self.add).option("checkpointLocation", checkpoint), trigger)

    # --- reading

    def _newest(self, ids: list[int]) -> DataFrame:
        rows = self.spark.read.parquet(*[f"{self.path}/deltas/batch_id={i}" for i in ids])
        return latest_per_key(rows, self.keys, self.order, self.tiebreak)

    def _base(self, state: dict, buckets: list[int] | None = None) -> DataFrame | None:
        """Rows of the buckets, by the folders that the version names; there are at most as many as buckets."""
        named = [f"{self.path}/{folder}/{BUCKET}={b}" for b, folder in sorted(state["base"].items()) if buckets is None or int(b) in buckets]
        return self.spark.read.parquet(*named) if named else None

    def read(self) -> DataFrame:
        """One row per key: base and deltas as they are now."""
        _, state = self.version()
        base, ids = self._base(state), self._deltas(state["upto"])
        if not ids:
            if base is None:
                raise FileNotFoundError(f"{self.path} has no batch yet")
            return base
        newest = self._newest(ids)
        return newest if base is None else merged(base, newest, self.keys, [self.order, *self.tiebreak])

    # --- upkeep

    def compact(self) -> list[int]:
        """Move the deltas into the base; returns the buckets that were rewritten."""
        number, state = self.version()
        ids = self._deltas(state["upto"])
        if not ids:
            return []
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(state["buckets"])).cast("int")
        newest = self._newest(ids)
        touched = sorted(r[0] for r in newest.select(bucket).distinct().collect())  # no more than buckets
        old = self._base(state, touched)
        rows = newest if old is None else merged(old, newest, self.keys, [self.order, *self.tiebreak])
        folder = f"base/{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, bucket).hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        state = {**state, "upto": ids[-1], "base": {**state["base"], **{str(b): folder for b in touched}}}
        if not create_once(self.spark, f"{self.path}/_versions/{number + 1:012d}.json", json.dumps(state)):
            remove(self.spark, f"{self.path}/{folder}")
            raise RuntimeError(f"{self.path} was compacted by another run meanwhile")
        return touched

    def vacuum(self, versions: int = 2) -> None:
        """Remove what none of the last versions needs; readers of older ones must be done."""
        names = sorted(n for n in folders(self.spark, f"{self.path}/_versions") if n.endswith(".json"))
        kept = [json.loads(read_text(self.spark, f"{self.path}/_versions/{n}")) for n in names[-versions:]]
        if not kept:
            return
        used = {folder for state in kept for folder in state["base"].values()}
        for folder in folders(self.spark, f"{self.path}/base"):
            if f"base/{folder}" not in used:
                remove(self.spark, f"{self.path}/base/{folder}")
        for name in folders(self.spark, f"{self.path}/deltas"):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= kept[0]["upto"]:
                remove(self.spark, f"{self.path}/deltas/{name}")
        for name in names[:-versions]:
            remove(self.spark, f"{self.path}/_versions/{name}")
