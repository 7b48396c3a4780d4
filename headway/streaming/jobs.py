"""Starting streams, and sending one stream to several sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from headway.operators.aggregates import station_hourly_windowed
from headway.operators.joins import deliver
from headway.operators.ranking import latest_per_key
from headway.sinks.tables import write_batch
from headway.sinks.topics import publish

RAW_DISORDER = "5 seconds"
TABLE_DISORDER = "5 minutes"
DISCOVERY = "30 seconds"
CHECKPOINT_PACE = "60 seconds"

Transform = Callable[[DataFrame], DataFrame]
# A sink of a fan-out writes one batch; it may be called again for the same batch.
Sink = Callable[[DataFrame, int], None]


def is_running(spark: SparkSession, name: str) -> bool:
    return any(query.name == name for query in spark.streams.active)


def start_once(spark: SparkSession, writer: DataStreamWriter, name: str) -> StreamingQuery:
    """Start a named stream unless one of that name runs already; returns the running one."""
    for query in spark.streams.active:
        if query.name == name:
            return query
    return writer.queryName(name).start()


def paced(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """Trigger by interval; without one, work off what is there and stop."""
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def watermarked(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time with bounded disorder; watermarks need a zoned timestamp."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def topic_time(messages: DataFrame) -> DataFrame:
    """Broker time of a topic as event time, rows at most 5 seconds out of order.

    Matters to stateful work on a topic; typing messages keeps no state and drops nothing.
    """
    return watermarked(messages, "timestamp", RAW_DISORDER)


def once_each(messages: DataFrame, identity: tuple[str, ...] = ("topic", "offset")) -> DataFrame:
    """Messages of a topic, each once, however often it is delivered within the disorder allowed.

    State holds identities of the last seconds only. A message older than that is late and dropped, so a
    delivery that comes again much later does not count twice either.
    """
    return topic_time(messages).dropDuplicatesWithinWatermark(list(identity))


def latest_state(stream: DataFrame, keys: list[str], order: str, tiebreak: list[str]) -> DataFrame:
    """The newest row per key of all that came so far, for update mode: a batch gives the keys it touched.

    Partial results combine within map tasks. State is one row per key, in RocksDB; rows that come late or again
    change nothing.
    """
    newest = F.max_by(F.struct(*stream.columns), F.struct(order, *tiebreak))
    return stream.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(newest.alias("_row")).select("_row.*")


def keep_latest(stream: DataFrame, table, checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """A keyed table that holds the newest row per key after each batch; ``table`` is a ``KeyedTable``."""
    newest = latest_state(stream, table.keys, table.order, table.tiebreak)
    return paced(newest.writeStream.outputMode("update").foreachBatch(table.add).option("checkpointLocation", checkpoint), trigger)


def deliver_live(
    messages: DataFrame, subscriptions: Callable[[], DataFrame], path: str, checkpoint: str, trigger: str | None = None
) -> DataStreamWriter:
    """Messages to the sessions that are subscribed when a batch begins.

    The subscriptions are read anew for each batch; a batch that is complete is not delivered again.
    """

    def send_batch(batch: DataFrame, batch_id: int) -> None:
        write_batch(deliver(batch, subscriptions()), path, batch_id)

    return paced(messages.writeStream.foreachBatch(send_batch).option("checkpointLocation", checkpoint), trigger)


def hourly_stream(curated: DataFrame, ts: str = "event_time", delay: str = TABLE_DISORDER) -> DataFrame:
    """Hourly station statistics, each window once, when the watermark closes it.

    Rows later than the watermark are dropped and counted in the query's progress.
    """
    hourly = station_hourly_windowed(watermarked(curated, ts, delay), ts)
    return hourly.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def append_files(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, fmt: str = "parquet",
    partition_by: list[str] | None = None,
) -> DataStreamWriter:
    """Append a stream to a table, exactly once, also for streams that read the table."""
    writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    return paced(writer.option("checkpointLocation", checkpoint), trigger)


def to_files(transform: Transform, path: str, partition_by: list[str] | None = None) -> Sink:
    """A table with a folder per batch; a batch that is complete is not written again."""
    return lambda batch, batch_id: write_batch(transform(batch), path, batch_id, partition_by=partition_by)


def to_topic(transform: Transform, **options: str) -> Sink:
    """A keyed topic; a repeated batch sends its messages again, which its keys absorb."""
    return lambda batch, batch_id: publish(transform(batch), "kafka", **options)


def fan_out(stream: DataFrame, sinks: dict[str, Sink], checkpoint: str, trigger: str | None = None) -> DataStreamWriter:
    """One read of the input for several sinks.

    The sinks are not written as one transaction, so each must stand a repeated batch. A
    new checkpoint counts batches from 0 again and needs new folders too. Batches of a
    paced stream are kept while they are written; a backlog worked off at once may exceed
    the cluster's storage, so there each sink reads what it needs.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if trigger else batch
        try:
            for sink in sinks.values():
                sink(kept, batch_id)
        finally:
            if trigger:
                kept.unpersist()

    return paced(stream.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint), trigger)


def send(changelog: DataFrame, checkpoint: str, trigger: str | None = None, fmt: str = "kafka", **options: str) -> DataStreamWriter:
    """A stream of keyed messages to a topic."""
    writer = changelog.writeStream.format(fmt).options(**options).outputMode("append")
    return paced(writer.option("checkpointLocation", checkpoint), trigger)


def latest_stream(
    stream: DataFrame, path: str, keys: list[str], order: str, tiebreak: list[str], checkpoint: str,
    trigger: str | None = None,
) -> DataStreamWriter:
    """Keep a latest-state log: the newest row per key of each batch."""

    def newest(batch: DataFrame, batch_id: int) -> None:
        write_batch(latest_per_key(batch, keys, order, tiebreak), path, batch_id)

    return paced(stream.writeStream.foreachBatch(newest).option("checkpointLocation", checkpoint), trigger)


def finish(*writers: DataStreamWriter) -> list[StreamingQuery]:
    """Run bounded streams side by side to their end; a failure of one is raised here."""
    running = [writer.start() for writer in writers]
    try:
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:
            query.stop()
    return running
