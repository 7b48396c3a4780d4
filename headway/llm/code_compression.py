"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

Components become integers, ``floor(scale * x)``, and vectors are cut into equal parts, each with a
codebook of its own. All arithmetic is on integers, so results do not depend on how rows are dealt.

Orchard's search holds, for every entry of a codebook, the other entries sorted by distance. For a
part it walks the list of the best entry so far, leaves out entries it has seen, jumps to the list of
an entry that is better, and stops where the list goes beyond twice the distance to the best entry:
by the triangle inequality nothing behind it can be as near. Equal distances go to the lower index. A
batch is searched in step: each round of the loop looks at the next entry of every part still searching.

A round of fitting is one narrow stage over all rows. A task adds up its own parts, so what it sends
are at most ``parts * entries`` sums, whatever its rows; Spark adds those up. What comes to the
driver is a codebook: ``entries`` vectors, bounded by the parameters alone.

Rows whose vector is null, or holds null or non-finite components, are left out. Vectors must all
have the same length, a multiple of ``parts`` (0 is one; such vectors are at distance 0); other
lengths raise an error. Large components are calculated with unbounded integers; an error beyond a
long is null, and so is the sum of a label that has one. Null keys come last when the first entries
are picked; rows with the same key go by their vectors. With fewer rows than ``entries`` codebooks
are as short. An empty table gives an empty result. Other columns are kept by ``encode``, but for
those named like its results.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from headway.llm._common import importable, without
from headway.session import run_dir

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Most labels whose sums are sent to every task; with more, rows are joined to them by label.
BROADCAST_LABELS = 100_000
LIMB = 32


def quantized(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as int64, or as Python's integers where distances of int64 could overflow."""
    most = float(np.abs(x).max(initial=0.0)) * scale + 1
    if 16 * max(1, x.shape[1]) * most * most < 2.0**62:
        return np.floor(x * scale).astype(np.int64)
    whole = [[math.floor(v * scale) if abs(v) < 2.0**53 else int(v) * scale for v in row] for row in x.tolist()]
    return np.array(whole, object).reshape(x.shape)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return (difference * difference).sum(axis=-1)


class Codebook:
    """The entries of one part position, and for each the others by distance."""

    def __init__(self, entries: np.ndarray):
        self.entries, k = entries, len(entries)
        gaps = [[int(d) for d in _distances(entries[i], entries)] if entries.size else [0] * k for i in range(k)]
        order = [sorted((j for j in range(k) if j != i), key=lambda j: (gaps[i][j], j)) for i in range(k)]
        self.near = np.array(order, np.int64).reshape(k, max(0, k - 1))
        kind = np.int64 if entries.dtype != object else object
        self.gaps = np.array([[gaps[i][j] for j in order[i]] for i in range(k)], kind).reshape(k, max(0, k - 1))
        self.large = max((abs(int(v)) for v in entries.ravel()), default=0)

    def search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point and the squared distance to it, by Orchard's search."""
        entries, gaps = self.entries, self.gaps
        if points.dtype == object or entries.dtype == object:
            points, entries, gaps = points.astype(object), entries.astype(object), gaps.astype(object)
        n, k = len(points), len(entries)
        best, at, seen = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros((n, k), bool)
        seen[:, 0] = True
        distance = _distances(points, entries[best]) if points.shape[1] else np.zeros(n, np.int64)
        searching = np.arange(n) if k > 1 and points.shape[1] else np.zeros(0, np.int64)
        while len(searching):
            own, place = best[searching], at[searching]
            # Squared: beyond twice the distance is beyond four times its square.
            goes_on = (gaps[own, place] <= 4 * distance[searching]).astype(bool)
            searching, own, place = searching[goes_on], own[goes_on], place[goes_on]
            other = self.near[own, place]
            at[searching] += 1
            new = ~seen[searching, other]
            rows, other = searching[new], other[new]
            seen[rows, other] = True
            found = _distances(points[rows], entries[other])
            better = ((found < distance[rows]) | ((found == distance[rows]) & (other < best[rows]))).astype(bool)
            rows = rows[better]
            best[rows], distance[rows], at[rows] = other[better], found[better], 0
            searching = searching[at[searching] < k - 1]
        return best, distance


class Codebooks:
    """The codebooks of all part positions, in order."""

    def __init__(self, parts: list[np.ndarray], scale: int):
        self.books, self.scale = [Codebook(p) for p in parts], scale

    def __len__(self) -> int:
        return len(self.books[0].entries) if self.books else 0

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        width = self.books[0].entries.shape[1]
        if vectors.shape[1] != width * len(self.books):
            raise ValueError(f"a vector has {vectors.shape[1]} components, others {width * len(self.books)}")
        points = quantized(vectors, self.scale)
        return [points[:, i * width:(i + 1) * width] for i in range(len(self.books))]

    def sha256(self) -> str:
        """Of all components in decimal, by part, entry and position within the part."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.entries.ravel()).encode()).hexdigest()


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows; an error if their lengths differ."""
    lengths = {len(v) for v in vectors}
    if len(lengths) > 1:
        raise ValueError(f"vectors have different lengths: {sorted(lengths)}")
    return np.array(vectors.tolist(), np.float64).reshape(len(vectors), lengths.pop() if lengths else 0)


def _whole(vector: str) -> Column:
    """Whether a vector has finite components only; never null."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fine, F.lit(False))


def kept(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there and whole."""
    return df.where(_whole(vector))


def _limbs(value: int) -> list[int]:
    """A signed integer in pieces that can be added up one by one as longs."""
    pieces = []
    while not -(1 << LIMB - 1) <= value < 1 << LIMB - 1:
        pieces.append(value & (1 << LIMB) - 1)
        value >>= LIMB
    return [*pieces, value]


SUMS = "part int, entry int, place int, limb int, total long"


def _summed(codebooks: Codebooks):
    """A task's sums of the parts at each entry; place -1 holds their number."""

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k, width = len(codebooks), codebooks.books[0].entries.shape[1]
        sums = np.zeros((len(codebooks.books), k, width), object)
        counts = np.zeros((len(codebooks.books), k), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            for i, (book, points) in enumerate(zip(codebooks.books, codebooks.split(_matrix(batch["v"])))):
                best, _ = book.search(points)
                own = np.zeros((k, width), points.dtype)
                np.add.at(own, best, points)
                sums[i] += own.astype(object)
                counts[i] += np.bincount(best, minlength=k)
        rows = [(i, e, -1, 0, int(counts[i, e])) for i, e in zip(*np.nonzero(counts))]
        rows += [(i, e, p, limb, x) for i, e, p in zip(*np.nonzero(sums)) for limb, x in enumerate(_limbs(int(sums[i, e, p]))) if x]
        yield pd.DataFrame(rows, columns=["part", "entry", "place", "limb", "total"])

    return summed


def first_codebooks(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> Codebooks | None:
    """The parts of the rows with the smallest keys, in order; None without rows."""
    v = F.col(vector).cast("array<double>")
    rows = kept(df, vector).select(F.col(key).alias("k"), v.alias("v")).orderBy(F.asc_nulls_last("k"), "v").limit(entries).collect()
    if not rows:
        return None
    points = quantized(_matrix(pd.Series([r["v"] for r in rows])), scale)
    if points.shape[1] % parts:
        raise ValueError(f"{points.shape[1]} components cannot be cut into {parts} equal parts")
    return Codebooks(list(np.split(points, parts, axis=1)), scale)


def improved(df: DataFrame, codebooks: Codebooks, vector: str = "embedding") -> Codebooks:
    """One round: entries become the rounded-down means of their parts; unused entries stay."""
    importable()
    rows = kept(df, vector).select(F.col(vector).cast("array<double>").alias("v")).mapInPandas(_summed(codebooks), SUMS)
    found = rows.groupBy("part", "entry", "place", "limb").agg(F.sum("total").alias("total")).collect()  # as many as a codebook has numbers
    sums: dict[tuple[int, int], dict[int, int]] = {}
    for r in found:
        own = sums.setdefault((r["part"], r["entry"]), {})
        own[r["place"]] = own.get(r["place"], 0) + (r["total"] << LIMB * r["limb"])
    books = [b.entries.astype(object) for b in codebooks.books]
    for (part, entry), own in sums.items():
        books[part][entry] = [own.get(p, 0) // own[-1] for p in range(books[part].shape[1])]
    return Codebooks([_narrow(b) for b in books], codebooks.scale)


def _narrow(entries: np.ndarray) -> np.ndarray:
    most = max((abs(int(v)) for v in entries.ravel()), default=0)
    return entries.astype(np.int64) if 1024 * max(1, entries.shape[1]) * most * most < 2**62 else entries


def fit(df: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks after all rounds, each over all rows; None without rows."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part")
    codebooks = first_codebooks(df, key, vector, parts, entries, scale)
    for _ in range(rounds if codebooks else 0):
        codebooks = improved(df, codebooks, vector)
    return codebooks


def encode(df: DataFrame, codebooks: Codebooks | None, vector: str = "embedding", code: str = "code", error: str = "error") -> DataFrame:
    """Whole rows with all columns, their code (two hex digits a part) and squared error. One narrow stage."""
    importable()
    rows = without(kept(df, vector), {code, error} - {vector})

    @pandas_udf("code string, error long")
    def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for vectors in batches:
            if not len(vectors):
                yield pd.DataFrame({"code": [], "error": []})
                continue
            found = [book.search(points) for book, points in zip(codebooks.books, codebooks.split(_matrix(vectors)))]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            errors = sum(distance.astype(object) for _, distance in found)
            yield pd.DataFrame({"code": [row.tobytes().hex() for row in codes], "error": pd.array([int(e) if e < 2**63 else None for e in errors], "Int64")})

    if codebooks is None:  # then there is no row
        return rows.withColumns({code: F.lit(None).cast("string"), error: F.lit(None).cast("long")})
    names = [c for c in rows.columns if c not in (code, error)]
    both = rows.withColumn("_coded", coded(F.col(vector).cast("array<double>")))
    return both.select(*[F.col(f"`{c}`") for c in names], F.col("_coded.code").alias(code), F.col("_coded.error").alias(error))


def decode(df: DataFrame, codebooks: Codebooks, code: str = "code", vector: str = "decoded") -> DataFrame:
    """Adds the vector that a code stands for."""
    entries = F.array(*[F.array(*[F.array(*[F.lit(int(v) / codebooks.scale) for v in e]) for e in b.entries]) for b in codebooks.books])
    part = F.transform(F.sequence(F.lit(0), F.lit(len(codebooks.books) - 1)), lambda i: entries[i][F.conv(F.substring(F.col(code), 2 * i + 1, F.lit(2)), 16, 10).cast("int")])
    return df.withColumn(vector, F.flatten(part))


def with_label_error(coded: DataFrame, label: str = "label", error: str = "error", name: str = "label_error") -> DataFrame:
    """Adds the sum of errors over equal labels, nulls together.

    Rows are written to the shared folder once, and summed within tasks before the shuffle. The
    sums go to every task where they are few, as counted; else Spark's join splits a hot label.
    """
    spark = coded.sparkSession
    without(coded, [name]).write.parquet(path := run_dir(spark, "codes"))
    rows = spark.read.parquet(path)
    total = F.when(F.count(error) == F.count(F.lit(1)), F.try_sum(error))
    rows.groupBy(F.col(label).alias("_label")).agg(total.alias(name)).write.parquet(path := run_dir(spark, "label-errors"))
    sums = spark.read.parquet(path)
    few = sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return rows.join(F.broadcast(sums) if few else sums, rows[label].eqNullSafe(sums["_label"]), "left").drop("_label")
