"""Byte-level BPE by prefix dynamic programming.

For every byte prefix of a match, exactly one token can be the last token of that prefix's
encoding. A table of these last tokens *is* the encoding: walking back from the end gives the
ids. The last token of a prefix is the one token that ends there and may follow the encoding of
what stands before it, where "may follow" means that BPE would not merge anything across the
border of the two tokens. Because an entry depends on earlier entries alone, appending bytes
only adds entries (``Prefixes.append``), and after an edit only the entries from the edit on are
computed anew, until the old table is reached again (``Prefixes.replace``).

DataFrame operators: ``encode`` (text to ids) and ``decode`` (ids to bytes). A text is cut into
matches of the tokenizer's pattern and each match is encoded for itself, without special tokens.

Null texts encode as empty; nothing is cut, whatever the length of a text or a match. A column
with the name of the result is replaced, all others stay.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from headway.llm._common import importable

#: Entries a worker keeps of what it has worked out; they bound memory and change no result.
CACHED_PIECES, CACHED_PAIRS = 120_000, 400_000
#: White space as the pattern's \s has it (Unicode White_Space).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Parts between which every match of the pattern ends: words with the space before them, and other white space.
PARTS = rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
NEVER = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of a byte-level BPE, where its tokens end in a text, and which may stand next to each other."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks))
        self.longest = max(map(len, ranks))
        self.halves = {token: self._halves(token) for token in self.bytes_of}
        self.follows: dict[int, bool] = {}  # by left << 32 | right
        self.ends = ahocorasick.Automaton()
        for data, token in ranks.items():
            if self.made_by_merges(token):
                self.ends.add_word(data.decode("latin-1"), (len(data), token))
        self.ends.make_automaton()

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        return cls(read_ranks(path))

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte or a token no merge makes."""
        data, ranks = self.bytes_of[token], self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 2:
            rank, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= token:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (ranks[parts[0]], ranks[parts[1]]) if len(parts) == 2 else None

    def made_by_merges(self, token: int) -> bool:
        return len(self.bytes_of[token]) == 1 or self.halves[token] is not None

    def may_follow(self, left: int, right: int) -> bool:
        """Whether BPE of both tokens' bytes gives these two tokens.

        Undoes the merges inside both tokens, latest first. At each step the two parts that touch
        the border must not merge before the part they went into next did. Of equal merges the
        left one goes first.
        """
        key = left << 32 | right
        if len(self.follows) >= CACHED_PAIRS:
            self.follows.clear()
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self.halves
        left_until = right_until = NEVER
        fits = True
        while True:
            merged = ranks.get(bytes_of[left] + bytes_of[right])
            if merged is not None and merged < left_until and merged <= right_until:
                fits = False
                break
            inner_left, inner_right = halves[left], halves[right]
            if inner_right and (not inner_left or right >= left):
                right_until, right = right, inner_right[0]
            elif inner_left:
                left_until, left = left, inner_left[1]
            else:
                break
        self.follows[key] = fits
        return fits


class Prefixes:
    """Bytes of one match with the last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exact: earlier prefixes keep their last tokens."""
        vocabulary, since, self.data = self.vocabulary, len(self.data), self.data + more
        self.last += [-1] * len(more)
        last, follows, may_follow = self.last, vocabulary.follows, vocabulary.may_follow
        base = max(0, since - vocabulary.longest)
        for end, (length, token) in vocabulary.ends.iter(self.data[base:].decode("latin-1")):
            end += base + 1
            if last[end] < 0:
                start = end - length
                if start == 0 or (known := follows.get(last[start] << 32 | token)) or (known is None and may_follow(last[start], token)):
                    last[end] = token

    def replace(self, start: int, stop: int, by: bytes) -> int:
        """Put ``by`` in place of bytes ``start:stop``; returns how many entries were computed.

        An entry depends on the entries at most one longest token before it. So once that many new
        entries in a row equal the old ones behind the edit, all the rest do.
        """
        old, shift, tail = self.last, len(by) - (stop - start), self.data[stop:]
        step = self.vocabulary.longest
        self.data, self.last = self.data[:start], old[:start + 1]
        self.append(by)
        for at in range(0, len(tail), step):
            self.append(tail[at:at + step])
            end = len(self.data)
            if len(tail) > at + step and self.last[-step:] == old[end - shift - step + 1:end - shift + 1]:
                self.data += tail[at + step:]
                self.last += old[end - shift + 1:]
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[self.last[end]])
        return out[::-1]


class _Pieces(dict):
    """Packed ids by piece; a missing one is worked out when asked for.

    When full, what was used since the last time stays for one more round.
    """

    def __init__(self, work):
        super().__init__()
        self.work, self.before = work, {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.before = dict(self)
            self.clear()
        packed = self.before.get(piece)
        if packed is None:
            packed = self.work(piece)
        self[piece] = packed
        return packed


class Encoder:
    """Ids of whole texts, packed as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.vocabulary = vocabulary
        matches, parts = regex.compile(pattern), re.compile(PARTS)
        by_match = _Pieces(self._match)
        by_part = _Pieces(lambda part: b"".join([by_match[m] for m in matches.findall(part)]))
        self._caches = (by_match, by_part)
        self._encode = lambda text: b"".join(map(by_part.__getitem__, parts.findall(text)))

    def _match(self, match: str) -> bytes:
        data = match.encode()
        whole = self.vocabulary.ranks.get(data)
        ids = Prefixes(self.vocabulary, data).ids() if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __call__(self, text: str) -> bytes:
        return self._encode(text)

    def release(self) -> None:
        """Forget the pieces; the vocabulary stays."""
        for cache in self._caches:
            cache.clear()
            cache.before = {}


@functools.lru_cache(1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(Vocabulary.read(path), pattern)


@functools.lru_cache(1)
def _bytes_of(path: str) -> dict[int, bytes]:
    ranks = read_ranks(path)
    return dict(zip(ranks.values(), ranks))


def ids_of(text: Column | str, ranks: str, pattern: str, packed: bool = True, release: bool = False) -> Column:
    """Ids of a text column, packed or as an array; ``ranks`` is the path of a rank file that every machine has.

    The pattern must end a match wherever a word with the space before it ends; the published
    patterns of byte-level vocabularies do. With ``release`` a worker forgets its pieces at the end of a
    task, for jobs whose other stages run in the same workers and want the memory.
    """
    importable()

    @pandas_udf("binary" if packed else "array<int>")
    def encoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoder(ranks, pattern)
        for texts in batches:
            ids = (encode(t) if t else b"" for t in texts)
            yield pd.Series([i if packed else np.frombuffer(i, "<i4") for i in ids], dtype=object)
        if release:
            encode.release()

    return encoded(text)


def bytes_of(ids: Column | str, ranks: str) -> Column:
    """The bytes that packed ids stand for."""

    importable()

    @pandas_udf("binary")
    def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        token = _bytes_of(ranks).__getitem__
        for packed in batches:
            yield pd.Series([b"".join(map(token, np.frombuffer(p, "<u4").tolist())) if p else b"" for p in packed], dtype=object)

    return unpacked(ids)


def encode(df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", packed: bool = True, release: bool = False) -> DataFrame:
    """All columns and the ids of the text, packed or as an array. One narrow stage, no shuffle."""
    return df.withColumn(ids, ids_of(F.col(text), ranks, pattern, packed, release))


def decode(df: DataFrame, ranks: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """All columns and the bytes of the packed ids (null ids: empty)."""
    return df.withColumn(decoded, bytes_of(F.col(ids), ranks))


def n_ids(ids: Column | str) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
