"""Repeated word sequences, found with suffix trees over groups of suffixes.

A suffix (here: the words from some word on) is taken up only if the fingerprint of its anchor
occurs in more than one document (see ``_repeats``). Prefixes of variable length split the
suffixes into groups that fit in memory: the anchor's words where few documents share them, all
the words of a window where many do. For each group a suffix tree is grown from the root, level
by level: the suffixes of a node are divided by the next words (as many as fit in a label of 64
bits, each word by its number in the group, so labels are exact), equal ones go on together, and a
suffix that is alone in its node is a leaf and done. A node whose suffixes agree in the next words is
not divided: its edge gets longer. A node as deep as the window that is still shared stands for
a maximal repeat's window; the smallest document below it is the one that keeps its words.

``remove_repeats`` removes each word in a window of ``width`` consecutive words whose sequence
also starts in a document with a smaller key. Windows never cross documents and are judged on the
input, not on what is left. Words are maximal runs of bytes other than ASCII white space, taken
unchanged; kept words are joined by one space.

Null texts have no words. Rows with a null key neither remove nor lose anything; rows with the
same key don't remove from each other. Texts shorter than a window stay whole. Columns named like
the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import _repeats
from headway.llm._common import importable, without
from headway.llm._repeats import Tokens
from headway.llm.suffix_dedup import _VALUES, Bytes

WIDTH = 50
RESULTS = ("kept", "n_words", "n_removed")
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS = np.cumprod(np.full(4096, _repeats.MULTIPLIER))


class Words(Tokens):
    """Words of a batch of texts, and their hashes as values."""

    def __init__(self, texts: pa.Array):
        read = Bytes(texts)
        self.data = read.data
        word = ~_SPACE[self.data]
        edge = np.zeros(len(word) + 1, bool)  # where texts begin, words do not go on
        edge[read.bounds] = True
        self.starts = np.flatnonzero(word & (edge[:-1] | ~np.concatenate([[False], word[:-1]])))
        self.stops = np.flatnonzero(word & (edge[1:] | ~np.concatenate([word[1:], [False]]))) + 1
        self.bounds = np.searchsorted(self.starts, read.bounds)

    def values(self, start: int, stop: int) -> np.ndarray:
        begin = self.starts[start:stop]
        lengths = self.stops[start:stop] - begin
        ramp = _repeats._ramp(lengths)
        with np.errstate(over="ignore"):
            parts = _VALUES[self.data[np.repeat(begin, lengths) + ramp]] * _POWERS[ramp & 4095]
            if len(lengths) and lengths.max() > 4096:
                parts = _repeats.mixed(parts + (ramp >> 12).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            sums = np.add.reduceat(parts, np.cumsum(lengths) - lengths) if len(lengths) else parts
            return _repeats.mixed(sums + lengths.astype(np.uint64))

    def numbered(self) -> tuple[np.ndarray, int]:
        """A number for each word, the same for equal words only, and how many numbers there are."""
        lengths = self.stops - self.starts
        body = self.data[np.repeat(self.starts, lengths) + _repeats._ramp(lengths)]
        coded = _repeats.binary(body, lengths).dictionary_encode()
        return coded.indices.to_numpy().astype(np.uint64), len(coded.dictionary)

    def joined(self, words: np.ndarray, counts: np.ndarray) -> pa.Array:
        """Strings of ``counts`` of the words each, joined by one space."""
        lengths = self.stops[words] - self.starts[words] + 1
        last = (np.cumsum(counts) - 1)[counts > 0]
        ends = np.cumsum(lengths)
        body = self.data[np.minimum(np.repeat(self.starts[words], lengths) + _repeats._ramp(lengths), max(0, len(self.data) - 1))]
        body[ends - 1] = 0x20
        keep = np.ones(len(body), bool)
        keep[ends[last] - 1] = False  # no space behind the last word
        sizes = np.zeros(len(counts), np.int64)
        sizes[counts > 0] = np.diff(ends[last], prepend=0) - 1
        return _repeats.binary(body[keep], sizes)

    def strings(self, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Array:
        return self.joined(np.repeat(self.bounds[doc] + start, count) + _repeats._ramp(count), count)


def _group_of(_read, _doc, _at, keys: np.ndarray, groups: int) -> np.ndarray:
    """Suffixes with the same prefix, the words of the anchor, come to the same group."""
    return _repeats.owner_of(keys, groups)


def _shared_nodes(width: int, levels: list[tuple[int, int]] | None = None):
    """Windows of each body, and the suffixes below nodes of the tree that are ``width`` words deep and shared."""

    def find(bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        read = Words(bodies)
        windows = np.diff(read.bounds) - width + 1
        suffix = np.repeat(read.bounds[:-1], windows) + _repeats._ramp(windows)
        words, kinds = read.numbered()
        bits = max(1, (kinds - 1).bit_length())
        step = min(64 // bits, width)  # as many words as fit in one edge label
        labels = np.zeros(max(0, len(words) - step + 1), np.uint64)
        for k in range(step):
            labels = labels << np.uint64(bits) | words[k:k + len(labels)]
        # The last edge begins early, so that it ends with the window: what is read twice agrees.
        depths = [*range(0, width - step, step), width - step]
        keys = [lambda items, d=d: labels[suffix[items] + d] for d in depths]
        return windows, *_repeats.equal_classes(len(suffix), keys, levels)

    return find


def _finish(width: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in _repeats.slices(whole)):
            read = Words(batch["text"])
            gone = _repeats.covered(read.bounds, batch, width)
            words = np.diff(read.bounds)
            removed = np.diff(np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])[read.bounds])
            kept = read.joined(np.flatnonzero(~gone), words - removed)
            out = batch.drop_columns(["print", "text", "prints", "starts", "masks", "copy"])
            out = out.append_column("kept", kept.view(pa.string()))
            yield out.append_column("n_words", pa.array(words, pa.int64())).append_column("n_removed", pa.array(removed, pa.int64()))

    return finish


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, hot: int = _repeats.HOT) -> DataFrame:
    """All columns but the text, and: kept (the words left, joined by one space), n_words, n_removed."""
    importable()
    k = max(1, width // 6, width - 62)
    others = without(df, [key, text, *RESULTS]).columns
    rows = _repeats.known_rows(df, key, text, others)
    marked = _repeats.marked_rows(rows, Words, width, k, _group_of, _shared_nodes(width), hot)
    schema = _repeats.schema_of(df, others, "kept string, n_words bigint, n_removed bigint")
    return _repeats.keyed_again(marked.mapInArrow(_finish(width), schema), df, key)
