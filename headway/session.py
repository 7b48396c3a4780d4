"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Needed for right results, so set on whatever session a caller brings.
RUNTIME = {
    # Times are stored without a zone; casts to and from zoned ones must not move them.
    "spark.sql.session.timeZone": "UTC",
    # Key and value lists may repeat a key; the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Streaming state grows with the number of keys, so it stays off the heap.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}

_local_root: str | None = None


def build_session(app: str = "headway", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; cluster sizing stays with the submitter."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        **RUNTIME,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a session that runs in one process (``local[...]``) and is without ``spark.checkpoint.dir`` gets a temporary folder.
    """
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    if _local_root is None or not os.path.isdir(_local_root):
        _local_root = tempfile.mkdtemp(prefix="headway-")
    return _local_root


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared one, so two runs never meet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
