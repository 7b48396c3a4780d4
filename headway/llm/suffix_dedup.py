"""Repeated byte strings, found by sorting suffixes.

A suffix is taken up only if the fingerprint of its anchor occurs in more than one document (see
``_repeats``). Splitters, drawn from a bounded sample of documents, range-partition the suffixes
by their leading bytes from the anchor on. A bucket sorts its suffixes by multikey quicksort with
eight bytes as one character: by the first eight bytes, ties that disagree by the next eight, and so
on up to the width; what has no tie is out. No hash decides whether suffixes are equal. Equal runs
tell the smallest document. Equal windows have equal anchors and a border never divides equal
leading bytes, so no run goes on in the next bucket and nothing is left to compare across
boundaries; windows around an anchor that very many documents share are dealt by all their bytes
instead.

``remove_repeats`` removes each byte that a ``width``-byte string covers which also starts in a
document with a smaller key. Matches never cross documents; strings are judged on the input, not
on what is left.

A whole copy of a smaller document loses every window, so copies are told by hashes of their texts
and only the smallest document of them is sent: a group of copies costs as much as one text.

Null texts count as empty. Rows with a null key neither remove nor lose anything. Of rows with
the same key none is smaller, so they don't remove from each other. Texts shorter than ``width``
stay whole. Columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import _repeats
from headway.llm._common import importable, shuffle_partitions, without
from headway.llm._repeats import Tokens

WIDTH = 50
#: Bytes that make up one character of the sort.
CHARACTER = 8
#: Documents that the splitters are drawn from, about. They balance buckets and change no result.
SAMPLED = 2000
#: Leading bytes that splitters have, drawn from each sampled document.
DRAWN = 64
RESULTS = ("kept", "spans", "n_bytes", "n_removed", "n_spans")
_VALUES = np.random.RandomState(20).randint(0, 1 << 63, 256, np.int64).astype(np.uint64) | np.uint64(1)


class Bytes(Tokens):
    """The UTF-8 bytes of a batch of texts."""

    def __init__(self, texts: pa.Array):
        self.bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = self.data[self.bounds[0]:self.bounds[-1]]
        self.bounds = self.bounds - self.bounds[0]

    def values(self, start: int, stop: int) -> np.ndarray:
        return _VALUES[self.data[start:stop]]

    def strings(self, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Array:
        from_ = self.bounds[doc] + start
        body = self.data[np.repeat(from_, count) + _repeats._ramp(count)]
        return _repeats.binary(body, count)


def _leading(strings: pa.Array) -> np.ndarray:
    """The first eight bytes of each string as a number that sorts like them; shorter strings end in zeros."""
    bounds = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1].astype(np.int64)
    data = np.frombuffer(strings.buffers()[2], np.uint8) if len(strings) else np.zeros(0, np.uint8)
    places = bounds[:-1, None] + np.arange(8)
    taken = np.where(places < bounds[1:, None], data[np.minimum(places, max(0, len(data) - 1))], 0) if len(data) else np.zeros(places.shape)
    return np.ascontiguousarray(taken.astype(np.uint8)).view(">u8").ravel().astype(np.uint64)


def _equal_windows(width: int, levels: list[tuple[int, int]] | None = None):
    """Windows of each body, and the suffixes that agree in their first ``width`` bytes, by multikey quicksort."""

    def find(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bounds = np.frombuffer(bodies.buffers()[1], np.int32)[bodies.offset:bodies.offset + len(bodies) + 1].astype(np.int64)
        data = np.frombuffer(bodies.buffers()[2], np.uint8)
        windows = np.diff(bounds) - width + 1
        suffix = np.repeat(bounds[:-1], windows) + _repeats._ramp(windows)
        step = min(CHARACTER, width)
        # The last character begins early, so that it ends with the window: what is read twice agrees.
        depths = [*range(0, width - step, step), width - step]
        keys = [lambda items, skip=skip: _character(data, suffix[items] + skip, step) for skip in depths]
        return windows, *_repeats.equal_classes(len(suffix), keys, levels)

    return find


def _character(data: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes, at most CHARACTER, from each place on as a number that sorts like them."""
    if n == CHARACTER:
        return np.ndarray(len(data) - n + 1, ">u8", data, strides=(1,))[at].astype(np.uint64)
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out << np.uint64(8) | data[at + k]
    return out


def splitters(df: DataFrame, text: str, width: int, k: int, buckets: int) -> np.ndarray:
    """Leading bytes that divide the suffixes into ranges, drawn from about SAMPLED documents."""
    n = df.count()
    share = min(1.0, SAMPLED / max(1, n))
    body = F.coalesce(F.col(text), F.lit(""))
    mine = df.select(body.alias("text")).where(F.pmod(F.xxhash64("text", F.lit("splitters")), F.lit(1_000_000)) < int(share * 1_000_000) + 1)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _repeats.slices(whole)):
            read = Bytes(batch["text"])
            drawn = []
            for _, found in read.pieces(width, k):
                few = np.flatnonzero(found.key % np.uint64(16) == 0)
                drawn.append(_leading(read.strings(found.doc[few], found.start[few] + found.at[few], np.full(len(few), k))))
            drawn = np.unique(np.concatenate(drawn))[:len(batch["text"]) * DRAWN] if drawn else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"lead": pa.array(drawn.view(np.int64), pa.int64())})

    # At most SAMPLED * DRAWN numbers, about.
    drawn = np.sort(mine.mapInArrow(draw, "lead long").toPandas()["lead"].to_numpy(np.int64).view(np.uint64))
    return drawn[np.linspace(0, len(drawn) - 1, buckets + 1).astype(int)[1:-1]] if len(drawn) else drawn


def _bucket_of(borders: np.ndarray, k: int):
    def range_of(read: Bytes, doc: np.ndarray, at: np.ndarray, _keys, _buckets) -> np.ndarray:
        return np.searchsorted(borders, _leading(read.strings(doc, at, np.full(len(doc), k))), "right").astype(np.int32)

    return range_of


def _finish(width: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _repeats.slices(whole)):
            read = Bytes(batch["text"])
            gone = _repeats.covered(read.bounds, batch, width)
            lengths = np.diff(read.bounds)
            total = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
            removed = np.diff(total[read.bounds])
            before = np.concatenate([[False], gone])[:-1] if len(gone) else gone
            firsts = read.bounds[:-1][lengths > 0]
            opens, closes = gone & ~before, np.concatenate([gone[:-1] & ~gone[1:], gone[-1:]]) if len(gone) else gone
            opens[firsts] = gone[firsts]
            ends = read.bounds[1:][lengths > 0] - 1
            closes[ends] = gone[ends]
            opened, closed = np.flatnonzero(opens), np.flatnonzero(closes)
            row = np.searchsorted(read.bounds, opened, "right") - 1
            spans = np.bincount(row, minlength=len(lengths))
            pairs = pa.StructArray.from_arrays([pa.array(opened - read.bounds[row], pa.int64()), pa.array(closed - opened + 1, pa.int64())], ["start", "length"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(spans)]), pa.int32())
            out = batch.drop_columns(["print", "text", "prints", "starts", "masks", "copy"])
            for name, column in (
                ("kept", _repeats.binary(read.data[~gone], lengths - removed)), ("spans", pa.ListArray.from_arrays(offsets, pairs)),
                ("n_bytes", pa.array(lengths, pa.int64())), ("n_removed", pa.array(removed, pa.int64())), ("n_spans", pa.array(spans, pa.int64())),
            ):
                out = out.append_column(name, column)
            yield out

    return finish


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = _repeats.HOT) -> DataFrame:
    """All columns but the text, and: kept (bytes), spans (start, length of removed runs), n_bytes, n_removed, n_spans."""
    importable()
    k = max(1, width // 2 - 1, width - 62)
    buckets = _repeats.FINER * shuffle_partitions(df.sparkSession)
    borders = splitters(df, text, width, k, buckets)
    others = without(df, [key, text, *RESULTS]).columns
    rows = _repeats.known_rows(df, key, text, others)
    marked = _repeats.marked_rows(rows, Bytes, width, k, _bucket_of(borders, k), _equal_windows(width), hot, fold_copies=True)
    schema = _repeats.schema_of(df, others, "kept binary, spans array<struct<start: bigint, length: bigint>>, n_bytes bigint, n_removed bigint, n_spans bigint")
    return _repeats.keyed_again(marked.mapInArrow(_finish(width), schema), df, key)
