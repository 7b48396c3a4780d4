"""Health of running streams."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

COLUMNS = (
    "name STRING, run_id STRING, batch_id BIGINT, rows BIGINT, millis BIGINT, "
    "state_rows BIGINT, late_rows BIGINT, completed BOOLEAN"
)


def _row(progress) -> tuple:
    state = progress.stateOperators
    return (
        progress.name, str(progress.runId), progress.batchId, progress.numInputRows, progress.batchDuration,
        sum(s.numRowsTotal for s in state), sum(s.numRowsDroppedByWatermark for s in state), True,
    )


class ProgressLog(StreamingQueryListener):
    """Keeps one record per finished batch and one per failed run, all of them.

    Records are appended to a table in chunks, so the driver holds one chunk at most.
    ``flush`` writes what is left, as before the table is read.
    """

    def __init__(self, spark: SparkSession, path: str, chunk: int = 100) -> None:
        self.spark, self.path, self.chunk = spark, path, chunk
        self.pending: list[tuple] = []
        self.names: dict[str, str | None] = {}
        self.lock = threading.Lock()
        self.idle = threading.Event()
        self.idle.set()

    def _add(self, record: tuple) -> None:
        with self.lock:
            self.pending.append(record)
            full = len(self.pending) >= self.chunk
        if full:
            self.flush()

    def flush(self) -> None:
        with self.lock:
            records, self.pending = self.pending, []
            if records:
                self.spark.createDataFrame(records, COLUMNS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name
        self.idle.clear()

    def onQueryProgress(self, event) -> None:
        self._add(_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            run = str(event.runId)
            self._add((self.names.get(run), run, None, 0, 0, 0, 0, False))
        self.names.pop(str(event.runId), None)
        if not self.names:
            self.idle.set()

    def table(self, wait: float = 0.0) -> DataFrame:
        """All records so far; ``wait``: seconds to wait for the last records of streams that end."""
        self.idle.wait(wait)
        self.flush()
        return self.spark.read.schema(COLUMNS).parquet(self.path)


def health(records: DataFrame) -> DataFrame:
    """Per stream: finished and failed batches, rows read, late rows dropped, and the slowest batch."""
    return records.groupBy("name").agg(
        F.count_if("completed").alias("completed"), F.count_if(~F.col("completed")).alias("failed"),
        F.sum("rows").alias("rows"), F.sum("late_rows").alias("late_rows"), F.max("millis").alias("slowest_millis"),
    )
