"""Exact duplicates by an exchange of Golomb-coded fingerprints.

1. Each block of rows (rows of one input partition) sorts the fingerprints of its texts, drops
   repeats within the block, and sends each owner of a fingerprint range its part as
   Golomb-Rice-coded gaps: some 4 bytes a text.
2. An owner merges the lists of all blocks and answers each block with a bitmap: which of its
   fingerprints occur elsewhere too. A block adds those it had seen twice itself.
3. Only the texts of rows marked so (suspects) are shuffled: the texts are read again and kept where
   their hash is one of a suspect's. Each hash counts once, however many rows have it; up to
   ``BROADCAST_SUSPECTS`` of them, as counted, go to every task, so no other text moves. With more, the
   texts are dealt by key and hash instead. Grouping by the text itself compares the suspects' bytes,
   after copies within a task have been counted together.

The blocks' lists and rows are settled in the shared folder before the answers come, so a lost
executor cannot change which row a bit stands for. A text with a third of all rows is one entry a
block in the exchange, and one row a task in the grouping.

Null texts count as empty. Of equal texts the row with the largest ``key`` stays; a null key is
smaller than any other. Of rows repeated with the same key and text one stays. All are counted in
``group_size``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm._common import importable, settled, shuffle_partitions, without

#: Bits of a fingerprint that are sent. Fewer mean shorter lists and more false suspects, never a wrong result.
FINGERPRINT_BITS = 48
#: Most rows in a block; it bounds a task's memory.
BLOCK_ROWS = 1 << 16
#: Most hashes of suspects that are sent to every task: 8 bytes each, some 100 MB as Spark's hash table.
BROADCAST_SUSPECTS = 2_000_000
MARKS = ("keep_id", "group_size", "kept", "text_sha256")


def golomb_encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct unsigned values below 2**bits as gaps: quotients in unary, then remainders in binary."""
    n = len(values)
    if n == 0:
        return b""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    low = _rice_bits(n, bits)
    quotients = (gaps >> np.uint64(low)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    rest = (gaps[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(unary).tobytes() + np.packbits(rest.astype(np.uint8).ravel()).tobytes()


def golomb_decode(data: bytes, n: int, bits: int) -> np.ndarray:
    if n == 0:
        return np.zeros(0, np.uint64)
    low = _rice_bits(n, bits)
    tail = (n * low + 7) // 8
    stream = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(np.unpackbits(stream[:len(stream) - tail]))[:n]
    quotients = (np.diff(ends, prepend=-1) - 1).astype(np.uint64)
    rest = np.unpackbits(stream[len(stream) - tail:])[:n * low].reshape(n, low).astype(np.uint64)
    gaps = (quotients << np.uint64(low)) + (rest << np.arange(low, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum(gaps, dtype=np.uint64)


def _rice_bits(n: int, bits: int) -> int:
    """Length of the remainders for n values below 2**bits: about the logarithm of 0.7 mean gaps."""
    return max(0, int(np.floor(np.log2(max(1.0, 0.69 * 2.0**bits / n)))))


def _send(bits: int, owners: int):
    """Blocks of (key, fingerprint, sha): a list for each owner, and the block's rows."""
    width = max(1, -(-(1 << bits) // owners))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for block, rows in enumerate(_blocks(batches)):
            name = (part << 32) + block
            prints = rows["print"].to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(64 - bits)
            values, at, counts = np.unique(prints, return_inverse=True, return_counts=True)
            owner = (values // np.uint64(width)).astype(np.int32)
            ends = np.flatnonzero(np.diff(owner, append=-1)) + 1
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            lists = [
                (name, int(owner[a]), int(b - a), golomb_encode(values[a:b] - np.uint64(int(owner[a]) * width), bits), np.packbits(counts[a:b] > 1).tobytes())
                for a, b in zip(starts, ends)
            ]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([x[0] for x in lists] + [name], pa.int64()),
                "owner": pa.array([x[1] for x in lists] + [None], pa.int32()),
                "n": pa.array([x[2] for x in lists] + [len(at)], pa.int32()),
                "data": pa.array([x[3] for x in lists] + [at.astype("<u4").tobytes()], pa.binary()),
                "twice": pa.array([x[4] for x in lists] + [None], pa.binary()),
                "keys": pa.array([None] * len(lists) + [rows["key"].to_pylist()], pa.list_(pa.int64())),
                "shas": pa.array([None] * len(lists) + [b"".join(rows["sha"].to_pylist())], pa.binary()),
            })

    return send


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            yield batch.slice(start, BLOCK_ROWS)


SENT = "block long, owner int, n int, data binary, twice binary, keys array<long>, shas binary"


def _answer(bits: int):
    """An owner's lists of all blocks: for each, a bitmap of the fingerprints that other blocks sent too."""

    def answer(lists: pd.DataFrame) -> pd.DataFrame:
        values = [golomb_decode(d, n, bits) for d, n in zip(lists["data"], lists["n"])]
        every = np.concatenate(values)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        repeated = np.zeros(len(every), bool)
        same = ordered[1:] == ordered[:-1]
        repeated[order[1:][same]] = True
        repeated[order[:-1][same]] = True
        ends = np.cumsum([len(v) for v in values])
        marks = [
            np.packbits(part | np.unpackbits(np.frombuffer(twice, np.uint8))[:len(part)].astype(bool)).tobytes()
            for part, twice in zip(np.split(repeated, ends[:-1]), lists["twice"])
        ]
        return pd.DataFrame({"block": lists["block"], "owner": lists["owner"], "n": lists["n"], "marks": marks})

    return answer


def _receive(rows: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's rows with the bit of each; keys stay in Arrow, where a null among them changes no other."""
    answers = answers.sort_by("owner")
    marks = [np.unpackbits(np.frombuffer(m.as_py(), np.uint8))[:n.as_py()] for m, n in zip(answers["marks"], answers["n"])]
    bits = np.concatenate(marks) if marks else np.zeros(0, np.uint8)
    found = []
    for keys, shas, at in zip(rows["keys"], rows["shas"], rows["data"]):
        shas = shas.as_py()
        found.append(pa.table({
            "key": pa.array(keys.values, pa.int64()), "sha": pa.array([shas[i:i + 32] for i in range(0, len(shas), 32)], pa.binary()),
            "suspect": pa.array(bits[np.frombuffer(at.as_py(), "<u4")].astype(bool)),
        }))
    return pa.concat_tables(found) if found else pa.table({"key": pa.nulls(0, pa.int64()), "sha": pa.nulls(0, pa.binary()), "suspect": pa.nulls(0, pa.bool_())})


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("print"), F.unhex(F.sha2(body, 256)).alias("sha"), body.alias("body"))


def exchange(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """(key, sha, suspect) of every row: whether its fingerprint came more than once."""
    importable()
    owners = shuffle_partitions(docs.sparkSession)
    sent = settled(_keyed(docs, key, text).select("key", "print", "sha").mapInArrow(_send(bits, owners), SENT))
    lists = sent.where(F.col("owner").isNotNull()).select("block", "owner", "n", "data", "twice")
    answers = lists.groupBy("owner").applyInPandas(_answer(bits), "block long, owner int, n int, marks binary")
    own = sent.where(F.col("owner").isNull()).select("block", "keys", "shas", "data")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_receive, "key long, sha binary, suspect boolean")


def _mark(sha: str = "sha") -> Column:
    return F.xxhash64(sha)


def _suspects(rows: DataFrame) -> DataFrame | None:
    """The distinct hashes of suspects, to be sent to every task; None if they are too many for that."""
    marks = settled(rows.where("suspect").select(_mark().alias("mark")).distinct())
    return F.broadcast(marks) if marks.limit(BROADCAST_SUSPECTS + 1).count() <= BROADCAST_SUSPECTS else None


def _only(texts: DataFrame, rows: DataFrame, marks: DataFrame | None) -> DataFrame:
    """The texts (key, sha, ...) of suspects."""
    if marks is not None:
        return texts.join(marks, _mark() == marks["mark"], "left_semi")
    suspects = rows.where("suspect").select("key", "sha").distinct()
    return texts.join(suspects, (texts["key"].eqNullSafe(suspects["key"])) & (texts["sha"] == suspects["sha"]), "left_semi")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """One row per row: key, keep_id (key of the row that stays), group_size, kept, text_sha256."""
    rows = settled(exchange(docs, key, text, bits))
    return _classes(docs, rows, _suspects(rows), key, text)


def _classes(docs: DataFrame, rows: DataFrame, marks: DataFrame | None, key: str, text: str) -> DataFrame:
    # Grouping by the text compares bytes; the sum over a task's copies comes before the shuffle.
    equal = (
        _only(_keyed(docs, key, text), rows, marks)
        .groupBy("body").agg(F.max("key").alias("keep"), F.count("*").alias("size"), F.first("sha").alias("sha"))
        .select(F.col("sha").alias("of"), "keep", "size")
    )
    first = Window.partitionBy("sha", "key").orderBy("sha")
    # Numbered before the join: there, a text with very many copies can be split over tasks.
    rows = rows.withColumn("again", F.row_number().over(first))
    joined = rows.join(equal, rows["suspect"] & (rows["sha"] == F.col("of")), "left")
    size = F.coalesce("size", F.lit(1).cast("long"))
    marked = joined.select("key", "sha", "again", F.when(F.col("of").isNull(), F.col("key")).otherwise(F.col("keep")).alias("keep_id"), size.alias("group_size"))
    stays = F.col("key").eqNullSafe(F.col("keep_id"))
    return marked.select(
        F.col("key").alias(key), "keep_id", "group_size", (stays & (F.col("again") == 1)).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = FINGERPRINT_BITS) -> DataFrame:
    """The rows that stay, with all their columns. Rows that are no suspects stay where they are."""
    rows = settled(exchange(docs, key, text, bits))
    marks = _suspects(rows)
    keep = _classes(docs, rows, marks, key, text).where("kept").select(F.col(key).alias("_key"), F.unhex("text_sha256").alias("_sha"))
    own = docs.withColumn("_own", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))

    def chosen(own: DataFrame) -> DataFrame:
        stays = own[key].cast("long").eqNullSafe(keep["_key"]) & (own["_own"] == keep["_sha"])
        return own.join(keep, stays, "left_semi").dropDuplicates([key, "_own"])

    if marks is None:
        return without(chosen(own), ["_own"])
    own = own.withColumn("_mark", _mark("_own"))
    alone = own.join(marks, own["_mark"] == marks["mark"], "left_anti")
    return without(alone.unionByName(chosen(own.join(marks, own["_mark"] == marks["mark"], "left_semi"))), ["_own", "_mark"])
