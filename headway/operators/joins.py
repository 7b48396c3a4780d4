"""Joins of facts with dimensions and subscriptions.

No broadcast hints: Spark broadcasts a side whose known size is under its threshold,
and otherwise shuffles, splitting hot keys at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.constants import LINES, UNKNOWN_LINE
from headway.functions.text_time import slug_title
from headway.sources.readers import small_table


def line_dimension(spark: SparkSession) -> DataFrame:
    lines = small_table(spark, ["id", "name", "colour", "ink", "order"], LINES)
    return lines.withColumn("order", F.col("order").cast("int"))


def _same(left: str, right: str, columns: list[str]) -> Column:
    """Null-safe equality of some columns of two aliased sides."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def changed_rows(current: DataFrame, incoming: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Current rows for which an incoming row of the key differs in a tracked column."""
    on = [F.col(f"cur.{k}") == F.col(f"inc.{k}") for k in keys]
    return current.alias("cur").join(incoming.alias("inc"), [*on, ~_same("cur", "inc", tracked)], "left_semi")


def unmatched_rows(incoming: DataFrame, current: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Incoming rows without an identical current row: changed ones and new keys."""
    return incoming.alias("inc").join(
        current.alias("cur"), [_same("inc", "cur", [*keys, *tracked])], "left_anti"
    )


def with_catalogue(catalogue: DataFrame, facts: DataFrame, key: str, fact_key: str) -> DataFrame:
    """Every catalogue row with its fact, if there is one."""
    return catalogue.join(facts, F.col(key) == F.col(fact_key), "left")


def with_line(facts: DataFrame, lines: DataFrame, key: str = "line_id") -> DataFrame:
    """Name, colours and order of each line; unknown lines get a name made from their id."""
    known = lines.select(
        F.col("id").alias("_id"), F.col("name").alias("_name"),
        F.col("colour").alias("_colour"), F.col("ink").alias("_ink"), F.col("order").alias("_order"),
    )
    return facts.join(known, F.col(key) == F.col("_id"), "left").withColumns({
        "name": F.coalesce("_name", slug_title(F.col(key))),
        "colour": F.coalesce("_colour", F.lit(UNKNOWN_LINE["colour"])),
        "ink": F.coalesce("_ink", F.lit(UNKNOWN_LINE["ink"])),
        "order": F.coalesce("_order", F.lit(UNKNOWN_LINE["order"])),
    }).drop("_id", "_name", "_colour", "_ink", "_order")


def deliver(messages: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One copy of each message per session subscribed to its topic (also stream with table)."""
    return messages.join(subscriptions.select("session_id", "topic").distinct(), "topic")
