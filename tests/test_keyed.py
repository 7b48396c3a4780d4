"""Keyed tables and stored histories on plain files."""

from __future__ import annotations

import os

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from headway.operators.ranking import latest_per_key
from headway.sinks import files as file_system
from headway.sinks.history import History
from headway.sinks.keyed import KeyedTable

SCHEMA = "id string, at int, n int, what string"


def batch(spark, *values):
    return spark.createDataFrame([tuple(v) for v in values], SCHEMA)


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, f"{folder}/keyed", ["id"], "at", ["n"], buckets=8)


def test_reads_equal_the_newest_rows_after_every_step(spark, table):
    steps = [
        [("a", 1, 1, "x"), ("b", 1, 1, "x"), (None, 1, 1, "x"), ("a", 2, 1, "y")], [("a", 1, 9, "late"), ("c", None, 1, "z")],
        [("b", 1, 2, "tie"), (None, 3, 1, "w"), ("c", None, 2, "still no time")], [("d", 5, 1, "new"), ("c", 0, 0, "a time")],
    ]
    seen = batch(spark).limit(0)
    for n, values in enumerate(steps):
        seen = seen.union(batch(spark, *values))
        table.add(batch(spark, *values), n)
        expected = rows(latest_per_key(seen, ["id"], "at", ["n"]))
        assert rows(table.read()) == expected
        if n % 2:
            assert table.compact()
            assert rows(table.read()) == expected and table.compact() == []


def test_compaction_rewrites_touched_buckets_only(spark, table):
    table.add(batch(spark, *[(f"k{i}", 1, i, "x") for i in range(200)]), 0)
    assert len(table.compact()) == 8
    before = files(f"{table.path}/base")
    table.add(batch(spark, ("k3", 2, 3, "y")), 1)
    touched = table.compact()
    assert len(touched) == 1
    after = files(f"{table.path}/base")
    assert set(before) < set(after) and all(f"_bucket={touched[0]}/" in f for f in set(after) - set(before))
    assert table.read().count() == 200 and table.read().filter("what = 'y'").count() == 1


def test_an_open_reader_keeps_its_version(spark, table):
    table.add(batch(spark, ("a", 1, 1, "old"), ("b", 1, 1, "old")), 0)
    table.compact()
    table.add(batch(spark, ("a", 2, 1, "mid")), 1)
    reader = table.read()
    table.compact()
    table.add(batch(spark, ("a", 3, 1, "new")), 2)
    table.compact()
    table.vacuum(versions=3)
    assert rows(reader, "id", "what") == [("a", "mid"), ("b", "old")]
    table.vacuum(versions=1)
    assert rows(table.read(), "id", "what") == [("a", "new"), ("b", "old")]
    assert file_system.folders(spark, f"{table.path}/deltas") == []


def test_repeated_batches_and_racing_compactions(spark, table, monkeypatch):
    table.add(batch(spark, ("a", 1, 1, "x")), 0)
    table.compact()
    table.add(batch(spark, ("a", 9, 9, "again, other rows")), 0)
    assert rows(table.read(), "what") == [("x",)]
    table.add(batch(spark, ("a", 2, 1, "y")), 1)
    number, state = table.version()
    assert table.compact()
    monkeypatch.setattr(table, "version", lambda: (number, state))  # what the slower of two runs saw
    with pytest.raises(RuntimeError, match="another run"):
        table.compact()
    monkeypatch.undo()
    assert rows(table.read(), "what") == [("y",)]


def test_an_empty_table_and_an_unfinished_delta(spark, table):
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.compact() == []
    table.add(batch(spark, ("a", 1, 1, "x")), 0)
    os.makedirs(f"{table.path}/deltas/batch_id=1")  # a batch that died: no _SUCCESS
    assert table.read().count() == 1
    table.add(batch(spark).limit(0), 1)
    assert table.read().count() == 1 and table.compact() != []


def test_merging_does_not_shuffle_the_base(spark, table):
    table.add(batch(spark, *[(f"k{i}", 1, i, "x") for i in range(50)]), 0)
    table.compact()
    table.add(batch(spark, ("k3", 2, 3, "y")), 1)
    plan = plan_of(table.read(), "simple")
    left = plan[:plan.index("LeftAnti")]
    assert "BroadcastHashJoin" in left and "SortMergeJoin" not in left


def test_a_stream_feeds_a_table(spark, folder, table):
    source = f"{folder}/source"
    stream = spark.readStream.schema(SCHEMA)
    for values in ([("a", 1, 1, "x"), ("b", 5, 1, "x")], [("a", 0, 1, "late"), ("b", 6, 1, "y")]):
        batch(spark, *values).write.mode("append").parquet(source)
        table.fed_by(stream.parquet(source), f"{folder}/ck").start().awaitTermination()
        table.compact()
    assert rows(table.read(), "id", "what") == [("a", "x"), ("b", "y")]


def test_a_file_appears_once(spark, folder):
    path = f"{folder}/versions/1.json"
    assert file_system.create_once(spark, path, "one é") and not file_system.create_once(spark, path, "two")
    assert file_system.read_text(spark, path) == "one é" and file_system.folders(spark, f"{folder}/versions") == ["1.json"]
    assert file_system.folders(spark, f"{folder}/none") == []


def test_closed_versions_are_written_once(spark, folder):
    history = History(spark, f"{folder}/history", ["id"], ["what"])
    with pytest.raises(FileNotFoundError):
        history.read()

    def load(as_of, *values):
        return history.load(spark.createDataFrame(values, "id string, what string"), as_of)

    assert load("2024-01-01 00:00:00", ("a", "1"), ("b", "1"), ("c", None))
    assert load("2024-01-02 00:00:00", ("a", "2"), ("c", None))
    closed = [f for f in files(history.path) if "_is_current=false" in f]
    assert load("2024-01-03 00:00:00", ("b", "2"), ("d", "1"))
    assert not load("2024-01-03 00:00:00", ("b", "never"))
    assert load("2024-01-04 00:00:00", ("b", "2"))  # nothing changes
    later = [f for f in files(history.path) if "_is_current=false" in f]
    assert closed and set(closed) < set(later) and not any("load=2024-01-04" in f for f in later)
    assert rows(history.current(), "id", "what") == [("a", "2"), ("b", "2"), ("c", None), ("d", "1")]
    spans = history.read().select("id", "what", F.date_format("_valid_from", "dd"), F.date_format("_valid_until", "yyyy-dd"), "_is_current")
    assert rows(spans) == sorted([
        ("a", "1", "01", "2024-02", False), ("a", "2", "02", "9999-31", True), ("b", "1", "01", "2024-03", False),
        ("b", "2", "03", "9999-31", True), ("c", None, "01", "9999-31", True), ("d", "1", "03", "9999-31", True),
    ], key=repr)


def test_a_load_that_died_is_written_again(spark, folder):
    history = History(spark, f"{folder}/history", ["id"], ["what"])
    history.load(spark.createDataFrame([("a", "1")], "id string, what string"), "2024-01-01 00:00:00")
    spark.createDataFrame([("a", "half", False)], "id string, what string, _is_current boolean").write.partitionBy("_is_current").parquet(f"{history.path}/load=2024-01-02T000000")
    assert history.read().count() == 1
    history.load(spark.createDataFrame([("a", "2")], "id string, what string"), "2024-01-02 00:00:00")
    assert rows(history.read(), "what") == [("1",), ("2",)]
