"""Messages and keyed changelogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields without a value are written as null, so readers see every field.
JSON = {"ignoreNullFields": "false"}


def to_changelog(df: DataFrame, keys: list[str], columns: list[str], carry: list[str] | None = None) -> DataFrame:
    """Rows as keyed JSON messages; ``carry`` keeps columns beside them."""
    return df.select(
        F.to_json(F.struct(*keys), JSON).alias("key"), F.to_json(F.struct(*columns), JSON).alias("value"), *(carry or [])
    )


def to_messages(df: DataFrame, event_type: str | Column, data: Column, ingested_at: Column) -> DataFrame:
    """Add the enveloped JSON ``value`` of keyless messages; ``data`` is itself JSON text."""
    kind = F.lit(event_type) if isinstance(event_type, str) else event_type
    envelope = F.struct(
        kind.alias("event_type"), data.alias("data"),
        F.date_format(ingested_at, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ingested_at"),
    )
    return df.withColumn("value", F.to_json(envelope, JSON))


def publish(messages: DataFrame, fmt: str = "kafka", **options: str) -> None:
    """Send messages: to a broker, or as files with the envelope columns, a folder per topic."""
    writer = messages.write.format(fmt).options(**options)
    writer.save() if fmt == "kafka" else writer.partitionBy("topic").mode("append").save()
