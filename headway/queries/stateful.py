"""Incremental loads, dimension history and layered batch flows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.operators import dimensions, filters, joins, projections
from headway.plans import batch
from headway.queries import bindings as b
from headway.queries.registry import Tables, query
from headway.queries.statistics import HOURLY_ROUNDED_OUT, HOURLY_SQL, LOCATED_SQL, rounded
from headway.session import run_dir
from headway.sinks import tables
from headway.sinks.history import History
from headway.sinks.keyed import KeyedTable
from headway.sources.readers import small_table

CUT = "2024-01-15 00:00:00"
KEYS, TRACKED = ["o_custkey"], ["o_orderpriority", "o_orderstatus"]
FIRST, SECOND = "1998-01-01 00:00:00", "2000-01-01 00:00:00"


@query(
    "incremental_hwm",
    f"SELECT event_id, ts FROM events WHERE ts > (SELECT coalesce(max(ts), TIMESTAMP '1970-01-01') FROM events WHERE ts < TIMESTAMP '{CUT}')",
)
def incremental_hwm(t: Tables) -> DataFrame:
    target = t.events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return filters.after_high_water(t.events, target, "ts").select("event_id", "ts")


@query(
    "incremental_enrich",
    f"""
    WITH {b.BATCH_SQL} SELECT * FROM enriched
    WHERE event_time > (SELECT coalesce(max(event_time), TIMESTAMP '1970-01-01') FROM enriched WHERE event_time < TIMESTAMP '{CUT}')
    """,
)
def incremental_enrich(t: Tables) -> DataFrame:
    raw = b.station_batch(t.events)
    curated = projections.enrich_stations(filters.in_interval(raw, "event_time", "1970-01-01 00:00:00", CUT))
    return batch.incremental_enrich(raw, curated)


@query("distinct_staging", f"SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '{CUT}'")
def distinct_staging(t: Tables) -> DataFrame:
    return dimensions.stage_distinct(t.events, ["user_id", "event_type"], "ts", CUT)


def _seen_sql(name: str, condition: str) -> str:
    return f"""{name} AS (
  SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE {condition}
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""


OLD_SQL = _seen_sql("old", f"o_orderdate < TIMESTAMP '{FIRST}'")
NEW_SQL = _seen_sql("new", f"o_orderdate >= TIMESTAMP '{FIRST}'")
DIFFERS = "(new.o_orderpriority IS DISTINCT FROM old.o_orderpriority OR new.o_orderstatus IS DISTINCT FROM old.o_orderstatus)"


def _old(t: Tables) -> DataFrame:
    """Customers as a dimension: what their newest order before a date said."""
    before = t.orders.filter(F.col("o_orderdate") < F.lit(FIRST).cast("timestamp_ntz"))
    staged = dimensions.stage_latest(before, KEYS, TRACKED, "o_orderdate", "1970-01-01 00:00:00", ["o_orderkey"])
    return dimensions.first_versions(staged, FIRST)


def _new(t: Tables) -> DataFrame:
    return dimensions.stage_latest(t.orders, KEYS, TRACKED, "o_orderdate", FIRST, ["o_orderkey"])


@query(
    "changed_rows",
    f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM old WHERE EXISTS (SELECT 1 FROM new WHERE new.o_custkey = old.o_custkey AND {DIFFERS})",
)
def changed_rows(t: Tables) -> DataFrame:
    return joins.changed_rows(_old(t), _new(t), KEYS, TRACKED).select(*KEYS, *TRACKED)


@query(
    "unmatched_rows",
    f"WITH {OLD_SQL}, {NEW_SQL} SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE new.o_custkey = old.o_custkey AND NOT {DIFFERS})",
)
def unmatched_rows(t: Tables) -> DataFrame:
    return joins.unmatched_rows(_new(t), _old(t), KEYS, TRACKED).select(*KEYS, *TRACKED)


@query(
    "scd2_apply",
    f"""
    WITH {OLD_SQL}, {NEW_SQL},
    j AS (SELECT old.*, {DIFFERS} AS changed FROM old JOIN new USING (o_custkey))
    SELECT old.*, TIMESTAMP '{FIRST}' AS _valid_from,
           CASE WHEN j.changed THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '9999-12-31' END AS _valid_until,
           NOT coalesce(j.changed, false) AS _is_current
    FROM old LEFT JOIN j USING (o_custkey)
    UNION ALL
    SELECT new.*, TIMESTAMP '{SECOND}', TIMESTAMP '9999-12-31', true
    FROM new LEFT JOIN j USING (o_custkey) WHERE coalesce(j.changed, true)
    """,
)
def scd2_apply(t: Tables) -> DataFrame:
    return dimensions.scd2(_old(t), _new(t), KEYS, TRACKED, SECOND)


VERSIONS_SQL = f"""
    WITH {OLD_SQL},
    mid AS (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders
            WHERE o_orderdate >= TIMESTAMP '{FIRST}' AND o_orderdate < TIMESTAMP '{SECOND}'
            QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    late AS (SELECT o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '{SECOND}'
             QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    v AS (SELECT *, 1 AS step, TIMESTAMP '{FIRST}' AS seen FROM old
          UNION ALL SELECT *, 2, TIMESTAMP '{SECOND}' FROM mid
          UNION ALL SELECT *, 3, TIMESTAMP '2002-01-01' FROM late),
    d AS (SELECT *, lag(o_orderpriority || o_orderstatus) OVER w AS before FROM v
          WINDOW w AS (PARTITION BY o_custkey ORDER BY step)),
    k AS (SELECT * FROM d WHERE before IS DISTINCT FROM o_orderpriority || o_orderstatus)
    SELECT o_custkey, o_orderpriority, o_orderstatus, seen AS _valid_from,
           coalesce(lead(seen) OVER w, TIMESTAMP '9999-12-31') AS _valid_until, lead(seen) OVER w IS NULL AS _is_current
    FROM k WINDOW w AS (PARTITION BY o_custkey ORDER BY step)
    """


@query("dimension_maintenance", VERSIONS_SQL)
def dimension_maintenance(t: Tables) -> DataFrame:
    """Two loads in a row; the state in between is a written table, as between two runs."""
    seen = t.orders.filter(F.col("o_orderdate") < F.lit(SECOND).cast("timestamp_ntz"))
    once = batch.maintain_dimension(_old(t), seen, KEYS, TRACKED, "o_orderdate", FIRST, SECOND, ["o_orderkey"])
    path = run_dir(t.spark, "dimension")
    tables.replace(once, path)
    stored = t.spark.read.parquet(path)
    return batch.maintain_dimension(
        stored, t.orders, KEYS, TRACKED, "o_orderdate", SECOND, "2002-01-01 00:00:00", ["o_orderkey"]
    )


@query("dimension_history", VERSIONS_SQL)
def dimension_history(t: Tables) -> DataFrame:
    """Three loads of a stored history, the last one twice: closed versions are written once, current rows by each load."""
    history = History(t.spark, run_dir(t.spark, "history"), KEYS, TRACKED)
    first = dimensions.stage_latest(t.orders.filter(F.col("o_orderdate") < F.lit(FIRST).cast("timestamp_ntz")), KEYS, TRACKED, "o_orderdate", "1970-01-01 00:00:00", ["o_orderkey"])
    second = dimensions.stage_latest(t.orders.filter(F.col("o_orderdate") < F.lit(SECOND).cast("timestamp_ntz")), KEYS, TRACKED, "o_orderdate", FIRST, ["o_orderkey"])
    third = dimensions.stage_latest(t.orders, KEYS, TRACKED, "o_orderdate", SECOND, ["o_orderkey"])
    for staged, as_of in ((first, FIRST), (second, SECOND), (third, "2002-01-01 00:00:00"), (third, "2002-01-01 00:00:00")):
        history.load(staged, as_of)
    return history.read()


@query(
    "latest_compacted",
    """
    WITH r AS (
        SELECT 'open' AS reader, * FROM events WHERE event_id % 5 < 3
        UNION ALL SELECT 'last', * FROM events)
    SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY reader, user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_compacted(t: Tables) -> DataFrame:
    """A keyed table after five batches with compactions in between; a reader opened after three still sees those."""
    table = KeyedTable(t.spark, run_dir(t.spark, "keyed"), ["user_id"], "ts", ["event_id"], buckets=16)
    for batch in range(3):
        table.add(t.events.filter(F.col("event_id") % 5 == batch), batch)
        if batch == 1:
            table.compact()
    opened = table.read()
    table.compact()
    for batch in (3, 3, 4):  # one of them comes twice
        table.add(t.events.filter(F.col("event_id") % 5 == batch), batch)
    return opened.withColumn("reader", F.lit("open")).unionByName(table.read().withColumn("reader", F.lit("last")))


@query(
    "upsert_latest",
    "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def upsert_latest(t: Tables) -> DataFrame:
    """Two overlapping loads leave what one load of everything would."""
    keys, order, tiebreak = ["user_id"], "ts", ["event_id"]
    early = filters.in_interval(t.events, "ts", "1970-01-01 00:00:00", CUT)
    overlapping = filters.in_interval(t.events, "ts", "2024-01-10 00:00:00")
    first = tables.upsert_latest(early.limit(0), early, keys, order, tiebreak)
    return tables.upsert_latest(first, overlapping, keys, order, tiebreak)


def _land(t: Tables, without: str | None = None) -> str:
    """Stations as a landing job leaves them, by day and with times as ISO text."""
    iso = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") for c in ("event_time", "ingested_at")}
    path = run_dir(t.spark, "landing")
    rows = b.stations(t.events).drop("event_id").withColumn("landed_date", F.col("event_time").cast("date"))
    if without:
        rows = rows.filter(F.col("landed_date") != F.lit(without).cast("date"))
    rows.withColumns(iso).hint("rebalance", F.col("landed_date")).write.partitionBy("landed_date").parquet(path)
    return path


@query("landing_to_hourly", f"WITH {HOURLY_SQL} {HOURLY_ROUNDED_OUT} FROM hourly")
def landing_to_hourly(t: Tables) -> DataFrame:
    root = run_dir(t.spark, "layers")
    batch.landing_to_hourly(t.spark, _land(t), root, as_of=b.AS_OF)
    return t.spark.read.parquet(f"{root}/hourly").drop("event_date")


@query(
    "backfill_range",
    f"""WITH {HOURLY_SQL} {HOURLY_ROUNDED_OUT} FROM hourly
    WHERE window_start >= TIMESTAMP '2024-01-10' AND window_start < TIMESTAMP '2024-01-15'
      AND NOT (window_start >= TIMESTAMP '2024-01-11' AND window_start < TIMESTAMP '2024-01-12')""",
)
def backfill_range(t: Tables) -> DataFrame:
    """Two ranges that overlap; the days in both are replaced, and a day landed again without rows goes."""
    root, landing = run_dir(t.spark, "backfill"), _land(t)
    again = _land(t, without="2024-01-11")
    for folder, first, end in ((landing, "2024-01-10", "2024-01-13"), (landing, "2024-01-12", "2024-01-15"), (again, "2024-01-10", "2024-01-13")):
        batch.backfill(t.spark, folder, root, first, end, b.AS_OF)
    return t.spark.read.parquet(f"{root}/hourly").drop("event_date")


@query(
    "layer_counts",
    f"""
    WITH {HOURLY_SQL}
    SELECT (SELECT count(*) FROM stations) AS raw, (SELECT count(*) FROM curated) AS curated, (SELECT count(*) FROM hourly) AS hourly
    """,
)
def layer_counts(t: Tables) -> DataFrame:
    """Rows per layer as counted by the writes themselves."""
    counts = batch.landing_to_hourly(t.spark, _land(t), run_dir(t.spark, "layers"), as_of=b.AS_OF)
    return small_table(t.spark, list(batch.LAYERS), [tuple(counts[layer] for layer in batch.LAYERS)])


def _interval_tables(t: Tables, root: str, arrivals: DataFrame | None = None) -> None:
    lines = b.lines(t.events).withColumnRenamed("status_description", "status")
    batch.run_interval(b.station_batch(t.events), lines, b.arrivals(t.lineitem) if arrivals is None else arrivals, root, *b.WEEK)


IN_WEEK = f"event_time >= TIMESTAMP '{b.WEEK[0]}' AND event_time < TIMESTAMP '{b.WEEK[1]}'"


@query("interval_batch", f"""WITH {b.BATCH_SQL} {LOCATED_SQL} FROM enriched WHERE {IN_WEEK} GROUP BY ALL""")
def interval_batch(t: Tables) -> DataFrame:
    """One week, run twice: the interval is replaced, so nothing doubles."""
    root = run_dir(t.spark, "interval")
    for _ in range(2):
        _interval_tables(t, root)
    hourly = t.spark.read.parquet(f"{root}/hourly").drop("interval_start")
    return rounded(hourly, "avg_occupancy_pct", "avg_available_bikes")


@query(
    "interval_rerun",
    f"""
    WITH {b.BATCH_SQL}
    SELECT 'stations' AS table_name, count(*) AS row_count FROM enriched WHERE {IN_WEEK}
    UNION ALL SELECT 'lines', count(*) FROM events WHERE ts >= TIMESTAMP '{b.WEEK[0]}' AND ts < TIMESTAMP '{b.WEEK[1]}'
    UNION ALL SELECT 'arrivals', 0
    """,
)
def interval_rerun(t: Tables) -> DataFrame:
    """The week again, now without arrivals: theirs are gone, the other tables are as before."""
    root = run_dir(t.spark, "interval")
    _interval_tables(t, root)
    _interval_tables(t, root, b.arrivals(t.lineitem).filter("false"))
    counts = [
        t.spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in ("stations", "lines", "arrivals")
    ]
    return counts[0].union(counts[1]).union(counts[2])


@query("smoke_roundtrip", "SELECT count(*) AS written, count(*) AS read_back FROM orders")
def smoke_roundtrip(t: Tables) -> DataFrame:
    return batch.smoke(t.spark, t.orders, run_dir(t.spark, "smoke"))
