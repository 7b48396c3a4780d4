"""Alerts and drift of running streams over several batches, and leases of stream names."""

from __future__ import annotations

import datetime as dt
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.operators import monitoring
from headway.streaming import continuous, jobs
from headway.streaming.leases import Lease, start_leased

T0 = dt.datetime(2024, 1, 1)
REQUESTS = "endpoint STRING, source STRING, ts TIMESTAMP_NTZ"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def requests(spark, *spans):
    """One request a minute: (endpoint, source, first minute, last minute)."""
    data = [(e, s, at(m) + dt.timedelta(seconds=7)) for e, s, first, last in spans for m in range(first, last + 1)]
    return spark.createDataFrame(data, REQUESTS)


def run(spark, folder, part, transform, name="in"):
    part.write.mode("append").parquet(f"{folder}/{name}")
    alerts = transform(spark.readStream.schema(part.schema).parquet(f"{folder}/{name}"))
    (query,) = jobs.finish(jobs.append_files(alerts, f"{folder}/out", f"{folder}/ck"))
    return query, rows(spark.read.schema(alerts.schema).parquet(f"{folder}/out"))


def breaches(stream):
    return continuous.fallback_alerts(stream, ["endpoint"], F.col("source") == "fallback", "ts")


def test_alerts_come_once_a_run_is_over_and_equal_the_table(spark, folder):
    parts = [
        requests(spark, ("a", "fallback", 0, 20), ("b", "primary", 0, 20)),
        requests(spark, ("a", "primary", 21, 60), ("b", "fallback", 40, 43), (None, "fallback", 21, 60)),
        requests(spark, ("a", "primary", 61, 200), (None, "primary", 61, 200)),
    ]
    _, found = run(spark, folder, parts[0], breaches)
    assert found == []  # the run may go on
    _, found = run(spark, folder, parts[1], breaches)
    assert [f[0] for f in found] == ["a"]  # b is too short, the run without an endpoint is open
    query, found = run(spark, folder, parts[2], breaches)
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    table = monitoring.fallback_ratio(whole, ["endpoint"], F.col("source") == "fallback", "ts")
    expected = rows(monitoring.sustained_fallback(table, ["endpoint"]), "endpoint", "since", "until", "steps")
    assert found == expected and len(found) == 2
    state = query.recentProgress[-1].stateOperators
    assert sum(s.numRowsTotal for s in state) < 50  # minutes that are still open, not the stream's age


def test_disorder_within_the_watermark_changes_nothing(spark, folder):
    late = requests(spark, ("a", "fallback", 1, 19))
    first = requests(spark, ("a", "fallback", 0, 0), ("a", "fallback", 20, 22))
    run(spark, folder, first.filter(F.col("ts") < at(4).isoformat()), breaches)
    run(spark, folder, late, breaches)
    run(spark, folder, first.filter(F.col("ts") >= at(4).isoformat()), breaches)
    _, found = run(spark, folder, requests(spark, ("a", "primary", 23, 90)), breaches)
    assert [(f[0], f[1]) for f in found] == [("a", at(-4))]


def test_a_missing_window_ends_a_run(spark, folder):
    windows = requests(spark, ("a", "x", 0, 9), ("a", "x", 11, 19), ("z", "x", 100, 100))

    def lasting(stream):
        counted = continuous.sliding_counts(stream, ["endpoint"], {"n": F.lit(True)}, "ts", width="1 minute")
        return continuous.lasting_windows(counted, ["endpoint"], F.col("n") > 0, min_steps=9)

    _, found = run(spark, folder, windows, lasting)
    assert found == [("a", at(0), at(9), 10), ("a", at(11), at(19), 9)]


def test_outage_needs_traffic(spark, folder):
    part = requests(spark, ("a", "bad", 0, 30), ("a", "good", 31, 31), ("a", "good", 90, 90))
    _, found = run(spark, folder, part, lambda s: continuous.outage_alerts(s, F.col("source") == "good", "ts"))
    assert found == rows(monitoring.silent_outage(part, F.col("source") == "good", "ts"), "scope", "since", "until", "steps")
    assert len(found) == 1


def test_empty_stream_has_no_alerts(spark, folder):
    _, found = run(spark, folder, spark.createDataFrame([], REQUESTS), breaches)
    assert found == []


def test_drift_is_the_first_observation_within_the_horizon(spark, folder):
    def part(*data):
        return spark.createDataFrame([(i, k, kind, at(m)) for i, k, kind, m in data], "id INT, k STRING, kind STRING, ts TIMESTAMP_NTZ")

    def drift(stream):
        made, seen = (stream.filter(F.col("kind") == kind) for kind in ("made", "seen"))
        return continuous.observed_next(made, seen, ["k"], "id", "ts", "30 minutes")

    run(spark, folder, part((1, "a", "made", 0), (2, "a", "made", 10), (3, "b", "made", 0), (4, None, "made", 0)), drift)
    run(spark, folder, part((0, "a", "seen", 10), (0, "a", "seen", 10), (0, "a", "seen", 12), (0, "b", "seen", 31), (0, None, "seen", 5)), drift)
    for n in range(1, 4):  # time goes on on both sides
        query, found = run(spark, folder, part((100 + n, "z", "made", 500 * n), (0, "z", "seen", 500 * n)), drift)
    settled = [f for f in found if f[1] < 100]
    assert settled == [
        ("a", 1, at(0), at(10), 600.0), ("a", 2, at(10), at(10), 0.0), ("b", 3, at(0), None, None), (None, 4, at(0), None, None),
    ]
    assert sum(s.numRowsTotal for s in query.recentProgress[-1].stateOperators) < 10


def test_lease_passes_on_and_fences(spark, folder):
    now = [1000.0]
    one, two = (Lease(spark, folder, "s", holder, 60.0, lambda: now[0]) for holder in ("one", "two"))
    assert one.current() is None and not one.renew()
    assert one.take() and not two.take() and two.current().holder == "one"
    now[0] += 50
    assert one.renew("run") and two.current().run_id == "run"
    now[0] += 59
    assert not two.take()
    now[0] += 1
    assert two.take() and not one.renew() and one.mine is None  # it was away for too long
    two.give_back()
    assert two.current() is None and one.take()
    for _ in range(30):
        assert one.renew()
    assert len(one._numbers()) <= 9


def test_of_several_that_take_one_succeeds(spark, folder):
    from concurrent.futures import ThreadPoolExecutor

    leases = [Lease(spark, folder, "s", str(i)) for i in range(8)]
    with ThreadPoolExecutor(8) as pool:
        assert sum(pool.map(lambda lease: lease.take(), leases)) == 1


def _copy(spark, folder):
    requests(spark, ("a", "x", 0, 3)).write.mode("append").parquet(f"{folder}/in")
    return jobs.append_files(spark.readStream.schema(REQUESTS).parquet(f"{folder}/in"), f"{folder}/out", f"{folder}/ck", trigger="1 second")


def _wait(condition):
    until = time.monotonic() + 30
    while not condition() and time.monotonic() < until:
        time.sleep(0.1)
    assert condition()


def test_a_stream_whose_lease_is_lost_stops(spark, folder):
    query, claim = start_leased(spark, _copy(spark, folder), "lost", folder, "one", term=1.5)
    assert claim.run_id == str(query.runId)
    rival = Lease(spark, folder, "lost", "two")
    assert not rival.take()
    _wait(lambda: rival._write(rival._last().number, rival.clock() + 60, None))  # as if the first had slept
    _wait(lambda: not query.isActive)
    assert rival.current().holder == "two"


def test_a_stream_that_cannot_start_gives_its_lease_back(spark, folder):
    requests(spark, ("a", "x", 0, 3)).write.parquet(f"{folder}/in")
    broken = spark.readStream.schema(REQUESTS).parquet(f"{folder}/in").writeStream.format("parquet")  # no path
    with pytest.raises(Exception):
        start_leased(spark, broken, "broken", folder, "one")
    assert Lease(spark, folder, "broken").take()
