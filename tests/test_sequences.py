"""Neighbouring rows against brute force, with a key that holds a third of the data."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators import sequences

T0 = dt.datetime(2024, 1, 1)


def readings(spark, n=3000, seed=7):
    import random

    rng = random.Random(seed)
    data = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(40)}"
        minutes = rng.randrange(0, 12 * 24 * 60, 7)  # equal times occur
        data.append((i, key, T0 + dt.timedelta(minutes=minutes), rng.randrange(20), rng.random() < 0.1))
    return data, spark.createDataFrame(data, "id INT, k STRING, ts TIMESTAMP_NTZ, level INT, hit BOOLEAN").repartition(7)


@pytest.mark.parametrize("quantiles", [1, 5, 64])
def test_previous(spark, quantiles):
    data, df = readings(spark)
    want, last = {}, {}
    for i, key, _, level, _ in sorted(data, key=lambda r: (r[2], r[0])):
        want[i] = last.get(key)
        last[key] = level
    got = sequences.with_previous(df, ["k"], "ts", ["id"], ["level"], quantiles)
    assert dict(rows(got, "id", "previous.level")) == want


@pytest.mark.parametrize("quantiles", [1, 5, 64])
def test_next_time(spark, quantiles):
    data, df = readings(spark)
    got = dict(rows(sequences.with_next_time(df, ["k"], "ts", F.col("hit"), quantiles), "id", "next_time"))
    hits = [(key, ts) for _, key, ts, _, hit in data if hit]
    for i, key, ts, _, _ in data:
        assert got[i] == min((h for k, h in hits if k == key and h >= ts), default=None)


def test_mean_gap(spark):
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    data = [("a", minutes(0), 1), ("a", minutes(10), 1), ("a", minutes(20), 10), ("a", minutes(30), 2), ("a", minutes(35), 10),
            ("a", minutes(3000), 2), ("b", minutes(0), 10), ("c", minutes(0), 3), ("d", minutes(0), None)]
    df = spark.createDataFrame(data, "line STRING, ts TIMESTAMP_NTZ, severity INT")
    got = rows(sequences.mean_gap_between_starts(df, ["line"], "ts", ["severity"], F.col("severity") != 10, 3))
    assert got == [("a", 3, 90_000.0), ("c", 1, None)]


def test_share(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", None), (None, "x")], "line STRING, reason STRING")
    assert rows(sequences.share_within(df, "line", "reason")) == sorted(
        [("a", "x", 2, 2 / 3), ("a", None, 1, 1 / 3), (None, "x", 1, 1.0)], key=repr)


def test_slices_stand_outliers_and_bursts(spark):
    """A row in 9999 and one burst: no key and slice holds more than a small multiple of the mean."""
    spread = [("hot" if i % 3 == 0 else f"k{i % 40}", T0 + dt.timedelta(minutes=5 * i)) for i in range(20_000)]
    burst = [("hot", T0 + dt.timedelta(days=30, microseconds=i * 4_000_000)) for i in range(10_000)]
    df = spark.createDataFrame([*spread, *burst, ("hot", dt.datetime(9999, 12, 31)), ("hot", dt.datetime(1, 1, 1)), ("hot", None)], "k STRING, ts TIMESTAMP_NTZ")
    sizes = [r["count"] for r in sequences.sliced(df, "ts").groupBy("k", "_slice").count().collect()]
    assert sum(sizes) == 30_003 and max(sizes) <= 30_003 / sequences.QUANTILES * 1.2


def test_slices_are_ordered_like_time(spark):
    _, df = readings(spark)
    got = sorted((r["ts"], tuple(r["_slice"])) for r in sequences.sliced(df, "ts", 7).collect())
    assert [s for _, s in got] == sorted(s for _, s in got) and len({p for _, (p, _) in got}) == 7
    assert sequences.sliced(df.filter("false"), "ts").count() == 0


def test_no_query_runs_while_it_is_built(spark):
    _, df = readings(spark)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    sequences.with_previous(df, ["k"], "ts", ["id"], ["level"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before
