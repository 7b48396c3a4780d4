"""Expressions at their edges."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from headway.functions import measures as m
from headway.functions import payload as p
from headway.functions import text_time as tt


def values(spark, schema, data, column):
    """Results in input order."""
    df = spark.createDataFrame([(i, *row) for i, row in enumerate(data)], f"i INT, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_occupancy(spark):
    data = [(1, 1, 16), (1, 0, 16), (0, 0, 5), (3, 4, 0), (None, 1, 5), (1, None, 5), (1, 1, None), (9, 3, 10),
            (2**31 - 1, 2**31 - 1, 2**31 - 1), (3, 0, 2000), (1, 0, 8)]
    got = values(spark, "a INT, b INT, c INT", data, m.occupancy_pct(F.col("a"), F.col("b"), F.col("c")))
    assert got == [12.5, 6.3, 0.0, None, None, None, None, 120.0, 200.0, 0.2, 12.5]


def test_fill_and_availability(spark):
    data = [(1, 10), (3, 10), (9, 10), (10, 10), (0, 10), (5, 0), (None, 3), (2, None), (299, 1000), (99, 1000), (901, 1000)]
    a, c = F.col("a"), F.col("c")
    assert values(spark, "a INT, c INT", data, m.fill_pct(a, c))[:6] == [10.0, 30.0, 90.0, 100.0, 0.0, None]
    assert values(spark, "a INT, c INT", data, m.availability_status(a, c)) == [
        "low", "normal", "normal", "full", "critical", "normal", "normal", "normal", "low", "critical", "full"]
    assert values(spark, "a INT, c INT", data, m.at_capacity(a, c))[3:8] == [True, False, False, None, None]


def test_flags_keep_null(spark):
    data = [(0, 0), (0, 1), (None, 0), (0, None)]
    assert values(spark, "a INT, b INT", data, m.holds_nothing(F.col("a"), F.col("b"))) == [True, False, None, None]
    assert values(spark, "a INT, b INT", data, m.holds_nothing(F.col("a"))) == [True, True, None, True]
    assert values(spark, "a INT, b INT", data, m.no_free_dock(F.col("b"))) == [True, False, True, None]
    assert values(spark, "a INT, b INT", data, m.flag(F.col("a") == 0)) == [1, 1, 0, 1]


SECONDS = [(-61,), (-60,), (0,), (60,), (61,), (300,), (301,), (3600,), (None,)]


def test_arrival_measures(spark):
    s = F.col("s")
    assert values(spark, "s INT", SECONDS, m.arrival_status(s)) == [
        "due", "due", "due", "due", "arriving", "arriving", "scheduled", "scheduled", "scheduled"]
    assert values(spark, "s INT", SECONDS, m.has_arrived(s)) == [True, True, True, False, False, False, False, False, None]
    assert values(spark, "s INT", SECONDS, m.floor_at(s)) == [0, 0, 0, 60, 61, 300, 301, 3600, None]


def test_status(spark):
    texts = [("Good Service",), ("Minor Delays",), ("Reduced Service",), ("Closed",), ("good service",), (None,)]
    assert values(spark, "t STRING", texts, m.line_rag(F.col("t"))) == ["green", "amber", "amber", "red", "red", "red"]
    codes = [(5,), (6,), (8,), (9,), (10,), (11,), (19,), (20,), (None,), (0,)]
    source = ["severe", "major", "major", "minor", "good", "major", "major", "major", "unknown", "severe"]
    meant = ["severe", "major", "major", "minor", "good", "major", "planned", "planned", "unknown", "severe"]
    assert values(spark, "c INT", codes, m.status_tone(F.col("c"))) == source
    assert values(spark, "c INT", codes, m.status_tone(F.col("c"), planned_first=True)) == meant


def test_clamp_and_percent(spark):
    data = [(-1.0,), (0.5,), (1.5,), (99.49,), (100.5,), (None,)]
    assert values(spark, "x DOUBLE", data, m.clamp(F.col("x"))) == [0.0, 0.5, 1.5, 99.49, 100.0, None]
    assert values(spark, "x DOUBLE", data, m.whole_percent(m.clamp(F.col("x")))) == [0, 1, 2, 99, 100, None]


def test_times(spark):
    data = [("2024-02-29T23:59:59.123456Z",), ("2024-02-29T23:59:59+01:00",), ("2024-02-29 10:00:00",), ("soon",), (None,), ("2024-02-30T00:00:00Z",)]
    got = values(spark, "t STRING", data, tt.to_time(F.col("t")))
    assert got == [dt.datetime(2024, 2, 29, 23, 59, 59, 123456), dt.datetime(2024, 2, 29, 22, 59, 59),
                   dt.datetime(2024, 2, 29, 10), None, None, None]
    assert values(spark, "t STRING", data[:1], tt.hour_key(tt.to_time(F.col("t")))) == ["2024-02-29T23:00:00"]
    assert values(spark, "t STRING", data[:1], tt.to_millis(tt.to_time(F.col("t")))) == [dt.datetime(2024, 2, 29, 23, 59, 59, 123000)]
    assert values(spark, "t STRING", data[:1], tt.shift(tt.hour_of(tt.to_time(F.col("t"))), "1 hour")) == [dt.datetime(2024, 3, 1)]


def test_text(spark):
    data = [("waterloo-city",), ("DLR",), ("a",), ("",), (None,), ("lONDON-overGround",), ("a.b-c",)]
    assert values(spark, "t STRING", data, tt.slug_title(F.col("t"))) == [
        "Waterloo City", "DLR", "A", "", None, "LONDON OverGround", "A.B C"]
    assert values(spark, "t STRING", [(" a, b ,c",), ("",), (None,)], tt.split_list(F.col("t"))) == [["a", "b", "c"], [""], None]


DOCS = [
    '{"s": "x", "n": 7, "t": "7", "f": 1.5, "b": true, "o": {"a": 1}, "l": [1], "e": null}',
    '{"s": "[not a list]", "n": "seven", "t": 7.9, "f": "1e3", "o": "{}", "l": "[1]"}',
    '{"s": "cut off", "n": 1',
    "nonsense", "[1, 2]", "", None,
    '{"s": "", "n": 99999999999, "o": {}, "l": []}',
]
FIELDS = {
    "s": ("$.s", "string"), "n": ("$.n", "int"), "t": ("$.t", "int"), "f": ("$.f", "double"), "b": ("$.b", "boolean"),
    "o": ("$.o", "string"), "l": ("$.l", "string"), "e": ("$.e", "string"), "deep": ("$.o.a", "int"),
}


def test_extract_json(spark):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)], "i INT, d STRING")
    got = [tuple(r) for r in p.extract_json(df, "d", FIELDS).orderBy("i").select(*FIELDS).collect()]
    empty = (None,) * 9
    assert got[0] == ("x", 7, 7, 1.5, True, None, None, None, 1)
    assert got[1] == ("[not a list]", None, None, 1000.0, None, "{}", "[1]", None, None)
    assert got[2:7] == [empty] * 5
    assert got[7] == ("", None, None, None, None, None, None, None, None)


def test_json_value_and_rejects(spark):
    df = spark.createDataFrame([(d,) for d in DOCS], "d STRING")
    for path in ("$.s", "$.o", "$.l"):
        by_value = df.select(p.json_value(F.col("d"), path))
        by_fields = p.extract_json(df, "d", {"x": (path, "string")}).select("x")
        # a cut-off payload may still yield what came before the cut by path
        readable = ~F.col("d").startswith('{"s": "cut')
        assert rows(by_value.filter(readable)) == rows(by_fields.filter(readable))
    assert tuple(p.cast_rejects(df, "d", FIELDS).first()) == (2, 1, 0, 0, 0)


def test_key_value_arrays(spark):
    pairs = "array<struct<key:string,value:string>>"
    data = [([("a", "1"), ("b", "2"), ("a", "3")],), ([],), (None,), ([("a", "x")],), ([("a", None)],)]
    assert values(spark, f"p {pairs}", data, p.int_of(F.col("p"), "a")) == [3, 0, 0, 0, 0]
    assert values(spark, f"p {pairs}", data, p.pairs_to_map(F.col("p"))) == [
        {"a": "3", "b": "2"}, {}, None, {"a": "x"}, {"a": None}]


def test_arrays_of_structs(spark):
    items = "array<struct<at:string,v:int>>"
    data = [([("b", 1), ("a", 2), (None, 3)],), ([],), (None,)]
    assert values(spark, f"x {items}", data, p.first_or(F.col("x"), "at", "none")) == ["b", "none", "none"]
    head = p.sorted_head(F.col("x"), "at", 2)
    assert values(spark, f"x {items}", data, F.transform(head, lambda e: e["v"])) == [[3, 2], [], None]


@pytest.mark.parametrize("topic,domain", [("a.b.c", "a"), ("plain", "unknown"), (".x", ""), (None, "unknown")])
def test_domain(spark, topic, domain):
    from headway.operators.projections import message_domain

    assert values(spark, "t STRING", [(topic,)], message_domain(F.col("t"))) == [domain]
