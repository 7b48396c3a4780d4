from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from headway.llm import code_compression as cc

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, parts, entries, rounds, scale):
    """(vec_id, code, error, label_error) and the codebooks, by plain loops."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    ints = [[math.floor(x * scale) if abs(x) < 2**53 else int(x) * scale for x in r[1]] for r in rows]
    width = len(ints[0]) // parts if ints else 0
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, list(rows[i][1])))[:entries]
    books = [[ints[i][p * width:(p + 1) * width] for i in first] for p in range(parts)]

    def assign(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))

    def parts_of(v):
        return [v[p * width:(p + 1) * width] for p in range(parts)]

    for _ in range(rounds):
        groups = {}
        for v in ints:
            for p, x in enumerate(parts_of(v)):
                groups.setdefault((p, assign(p, x)[1]), []).append(x)
        for (p, e), xs in groups.items():
            books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out = []
    for r, v in zip(rows, ints):
        found = [assign(p, x) for p, x in enumerate(parts_of(v))]
        out.append((r[0], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), r[2]))
    totals = {}
    for _, _, error, label in out:
        totals[label] = totals.get(label, 0) + error
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return sorted((str(k), c, e, totals[label]) for k, c, e, label in out), hashlib.sha256(flat.encode()).hexdigest()


def vectors(seed, n, dim):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        v = [float(np.float32(r.choice([r.gauss(0, 0.3), 0.0, 0.25]))) for _ in range(dim)]
        kind = r.random()
        if rows and kind < 0.2:
            v = list(r.choice(rows)[1] or v)
        elif kind < 0.25:
            v = r.choice([None, [None] + v[1:], [float("nan")] + v[1:], [float("inf")] + v[1:]])
        if rows and v is not None and any(x is None or not math.isfinite(x) for x in v):
            v = r.choice([None, v])
        rows.append((r.choice([i, i, i, None]) if i > 3 else i, v, r.choice([1, 1, 2, None])))
    return rows


@pytest.mark.parametrize("seed,n,dim,parts,entries,rounds", [(1, 120, 16, 4, 5, 3), (2, 60, 8, 8, 16, 6), (3, 9, 6, 2, 16, 2)])
def test_codes_equal_plain_loops(spark, seed, n, dim, parts, entries, rounds):
    rows = vectors(seed, n, dim)
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    books = cc.fit(df, parts=parts, entries=entries, rounds=rounds)
    found = cc.with_label_error(cc.encode(df, books)).select("vec_id", "code", "error", "label_error").collect()
    expected, sha = brute_codes(rows, parts, entries, rounds, cc.SCALE)
    assert sorted((str(r[0]), *r[1:]) for r in found) == expected
    assert books.sha256() == sha


def test_orchard_search_finds_the_nearest_and_skips_entries():
    r = np.random.RandomState(5)
    centres = r.randint(-3000, 3000, (16, 8))
    centres[7] = centres[3]  # a tie goes to the lower index
    book = cc.Codebook(centres)
    points = centres[r.randint(0, 16, 3000)] + r.randint(-60, 60, (3000, 8))
    best, distance = book.search(points)
    every = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert (best != 7).all()


def test_very_large_components_are_exact(spark):
    rows = [(i, [float(v) for v in (i * 1e30, -i * 1e200, 1.5, i)], i % 2) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    books = cc.fit(df, parts=2, entries=3, rounds=2)
    found = cc.with_label_error(cc.encode(df, books)).collect()
    expected, sha = brute_codes([(r[0], r[1], r[2]) for r in rows], 2, 3, 2, cc.SCALE)
    assert books.sha256() == sha
    fits = {k: (c, e if e < 2**63 else None, t if t < 2**63 else None) for k, c, e, t in expected}
    assert {str(r["vec_id"]): (r["code"], r["error"]) for r in found} == {k: v[:2] for k, v in fits.items()}
    assert all(r["label_error"] is None for r in found)


def test_codes_of_odd_tables(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert cc.fit(empty) is None
    assert cc.with_label_error(cc.encode(empty, None)).count() == 0
    only_bad = spark.createDataFrame([(1, None, 1), (2, [None] * 8, 1)], VECTORS)
    assert cc.encode(only_bad, cc.fit(only_bad)).count() == 0
    one = spark.createDataFrame([(1, [0.5] * 8, None, "x", 7)], VECTORS + ", Code string, error int")
    books = cc.fit(one)
    row = cc.with_label_error(cc.encode(one, books)).collect()[0]
    assert (row["code"], row["error"], row["label_error"]) == ("00" * 8, 0, 0)
    assert cc.decode(cc.encode(one, books), books).collect()[0]["decoded"] == [0.5] * 8
    assert cc.encode(spark.createDataFrame([(1, [], 1), (2, [], 1)], VECTORS), cc.fit(spark.createDataFrame([(1, [], 1), (2, [], 1)], VECTORS))).count() == 2
    uneven = spark.createDataFrame([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], VECTORS)
    with pytest.raises(Exception, match="components|lengths"):
        cc.encode(uneven, cc.fit(uneven)).collect()
