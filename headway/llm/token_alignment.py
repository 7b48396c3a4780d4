"""Alignment of two tokenizers' tokens, and how often their ids are linked.

``A`` is a byte-level BPE of the tokenizers library, ``B`` a sentencepiece model with byte fallback.
Both encode a text as plain text: A a space and the text, B the text, before which it puts the space.

* **Spans.** Coarse cuts are where the libraries say that tokens end: A's offsets count characters and
  become bytes by the text's own character widths; B's proto has byte spans. A coarse cut is right where the
  bytes since the cut before are as many as the token's own. Where they are not (a token ends inside
  a character, or is one byte of it), the cut is moved on by the decoded bytes of the tokens since the last
  right one. Texts whose tokens, joined as bytes, are not a space and the text have no tokens.
* **Words.** Neither tokenizer joins what stands before a single blank between two other characters with
  what stands behind it, which is checked on its vocabulary; so texts are cut there, and a word is
  aligned once for many documents. A text with a word whose tokens don't join to it is aligned
  as a whole, as all texts are where the check fails.
* **Groups** are cut where tokens of both end. **Links** are the pairs of occurrences of an A and a
  B token whose bytes overlap: one for each stretch between two ends of either.
* **Counts.** An id pair's count is the number of documents that hold it linked. The rows of a task
  are cut into blocks of some megabytes of text. A block sends its distinct pairs, with its number of
  documents for each, to owners by hash: a pair that every document holds is one entry a block.
  Owners add up and answer each block's list; the highest count of each A id (no more than A has ids)
  goes to every task. Then the rows of a block meet its answers: links by count, without an exploded pair.

What blocks found is written to the shared folder before counts are asked for, so a lost executor
cannot change which list an answer belongs to. A task holds one block and a table of words bounded by
characters; a text larger than a block is a block of its own, as tokenizers need it whole.

Null and empty texts have no tokens: zeros, and no groups. Repeated rows are rows of their own and count as
documents of their own; keys may be null. An empty table gives an empty result. Only key and text
of the documents are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from headway.llm._common import importable, shuffle_partitions
from headway.session import run_dir

#: Characters of text in a block, and most rows; characters of words that a task remembers from block to block.
BLOCK_CHARS, BLOCK_ROWS, WORD_CHARS = 4 << 20, 1 << 16, 12 << 20
#: Characters of new words that are aligned in one go.
JOINED_CHARS = 1 << 18
#: A blank between two characters that aren't white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
SPACE, PIECE_SPACE = " ", "▁"


def byte_characters() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves, the others follow 255."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in printable}
    table.update({chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))})
    return table


class Aligned:
    """The tokens of one text: ids, ends in bytes, and the ends that both have."""

    def __init__(self, ids_a: np.ndarray, ends_a: np.ndarray, ids_b: np.ndarray, ends_b: np.ndarray):
        self.ids_a, self.ends_a, self.ids_b, self.ends_b = ids_a, ends_a, ids_b, ends_b
        every = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = every[1:] == every[:-1]
        #: Ends of both, and all ends: tokens have bytes, so those of one are distinct.
        self.common, self.every = every[1:][again], np.append(every[:-1][~again], every[-1:])

    def links(self) -> np.ndarray:
        """A pair of ids for each stretch of bytes between two ends, as a << 32 | b."""
        ends = self.every
        a = self.ids_a[np.searchsorted(self.ends_a, ends)]
        return a.astype(np.int64) << 32 | self.ids_b[np.searchsorted(self.ends_b, ends)]

    def groups(self, names: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``; names are decimal ids as texts."""
        return "".join(self.spelled(names)[:-1])

    def spelled(self, names: np.ndarray) -> list[str]:
        """The tokens of both in the order of groups, and behind each what parts it from the next."""
        if not len(self.common):
            return []
        in_a, in_b = np.searchsorted(self.common, self.ends_a), np.searchsorted(self.common, self.ends_b)
        last_a, last_b = np.searchsorted(self.ends_a, self.common, "right"), np.searchsorted(self.ends_b, self.common, "right")
        out = np.empty((len(in_a) + len(in_b), 2), object)
        # A token stands behind all of A's and B's that come before it, group by group.
        place_a = np.arange(len(in_a)) + np.concatenate([[0], last_b])[in_a]
        place_b = np.arange(len(in_b)) + last_a[in_b]
        out[place_a, 0], out[place_b, 0] = names[self.ids_a], names[self.ids_b]
        out[:, 1] = ","
        out[place_a[last_a - 1], 1] = "|"
        out[place_b[last_b - 1], 1] = ";"
        return out.ravel().tolist()


NOTHING = Aligned(*[np.zeros(0, np.int64)] * 4)


def _refined(coarse: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ends in bytes: coarse ones where a token's own bytes fill the gap, others by decoded bytes since the last such."""
    decoded = np.cumsum(lengths)
    right = np.diff(coarse, prepend=0) == lengths
    since = np.maximum.accumulate(np.where(right, np.arange(len(coarse)), -1))
    return decoded + np.where(since >= 0, (coarse - decoded)[since], 0)


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a, self.b = tokenizers.Tokenizer.from_str(a), sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a.encode_special_tokens = True
        own, file = byte_characters(), json.loads(a)
        added = {t["content"] for t in file.get("added_tokens", [])}
        vocabulary = {i: t.encode() if t in added else bytes(own[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.bytes_a = [vocabulary.get(i, b"") for i in range(max(vocabulary, default=-1) + 1)]
        self.bytes_b = [self._piece(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.lengths_a, self.lengths_b = (np.array([len(t) for t in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.by_word = self._words_apart(file, b)
        self.names = np.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))], object)

    @staticmethod
    def _piece(piece: str) -> bytes:
        single = re.fullmatch("<0x([0-9A-Fa-f]{2})>", piece)
        return bytes([int(single[1], 16)]) if single else piece.replace(PIECE_SPACE, SPACE).encode()

    def _words_apart(self, a: dict, b: bytes) -> bool:
        """Whether no token of either can go over a blank that stands alone."""
        from sentencepiece import sentencepiece_model_pb2

        cutter = a.get("pre_tokenizer") or {}
        plain = all(t["special"] for t in a.get("added_tokens", [])) and a.get("normalizer") is None
        model = sentencepiece_model_pb2.ModelProto.FromString(b)
        rules = model.normalizer_spec
        own = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        split = not any(PIECE_SPACE in p.piece.lstrip(PIECE_SPACE) for p in model.pieces)
        return plain and own and split and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")

    def align(self, text: str | None) -> Aligned:
        if not text:
            return NOTHING
        whole = SPACE + text
        data = whole.encode()
        found = self.a.encode(whole, add_special_tokens=False)
        ids = found.ids
        if b"".join(map(self.bytes_a.__getitem__, ids)) != data:
            return NOTHING
        ids_a, ends = np.array(ids, np.int64), np.array(found.offsets, np.int64).reshape(-1, 2)[:, 1]
        if len(data) != len(whole):
            ends = _character_ends(data)[ends]
        pieces = self.b.encode(text, return_type="proto").pieces
        ids = [p.id for p in pieces]
        if b"".join(map(self.bytes_b.__getitem__, ids)) != data:
            return NOTHING
        # B's spans are of the text, the space before it is of its own making.
        ids_b, spans = np.array(ids, np.int64), np.array([p.end for p in pieces], np.int64) + 1
        return Aligned(ids_a, _refined(ends, self.lengths_a[ids_a]), ids_b, _refined(spans, self.lengths_b[ids_b]))


def _character_ends(data: bytes) -> np.ndarray:
    """For a number of characters, the bytes they take."""
    starts = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(data))


def _shared(spark, a: str, b: str):
    """Both files' contents for every task; they are read where the driver is."""
    with open(a, encoding="utf-8") as first, open(b, "rb") as second:
        return spark.sparkContext.broadcast((first.read(), second.read()))


_loaded: dict[tuple[str, bytes], Tokenizers] = {}


def _tokenizers(shared) -> Tokenizers:
    """A worker loads the tokenizers once, also for later queries; the last pair is kept."""
    if shared.value not in _loaded:
        _loaded.clear()
        _loaded[shared.value] = Tokenizers(*shared.value)
    return _loaded[shared.value]


def aligned(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids_a, ends_a, ids_b, ends_b, groups) of each document. One narrow stage; ``a`` and ``b`` are the tokenizers' files."""
    importable()
    shared = _shared(docs.sparkSession, a, b)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _tokenizers(shared)
        for batch in batches:
            for i, t in enumerate(batch["text"]):
                found = own.align(t.as_py())
                yield pa.RecordBatch.from_arrays([
                    batch["key"].slice(i, 1), *[pa.array([x.tolist()], pa.list_(pa.int64())) for x in (found.ids_a, found.ends_a, found.ids_b, found.ends_b)],
                    pa.array([found.groups(own.names)]),
                ], ["key", "ids_a", "ends_a", "ids_b", "ends_b", "groups"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    arrays = ", ".join(f"{n} array<long>" for n in ("ids_a", "ends_a", "ids_b", "ends_b"))
    return rows.mapInArrow(align, f"key {kind}, {arrays}, groups string").withColumnRenamed("key", key)


class Words(dict):
    """Words by number. Those asked for the first time are aligned when ``learn`` is called, many in one text."""

    def __init__(self, own: Tokenizers):
        self.own, self.chars, self.pending, self.total = own, 0, [], 0
        #: Of each word: its numbers, and where its links begin among all; no tokens where they don't join to it.
        self.table, self.pairs, self.groups = np.zeros((0, len(NUMBERS) + 1), np.int64), np.zeros(0, np.int64), []

    def __missing__(self, word: str) -> int:
        self[word] = number = self.number(len(word))
        self.pending.append((number, word))
        return number

    def number(self, chars: int) -> int:
        self.chars, self.total = self.chars + chars + 32, self.total + 1
        return self.total - 1

    def learn(self) -> None:
        part, chars = [], 0
        for number, word in self.pending:
            if word[0].isspace() or word[-1].isspace():  # joined to others it would be cut differently
                self._align([(number, word)])
                continue
            part.append((number, word))
            chars += len(word)
            if chars >= JOINED_CHARS:
                self._align(part)
                part, chars = [], 0
        if part:
            self._align(part)
        self.pending = []

    def whole(self, text: str) -> int:
        """The number of a text that is aligned as it is."""
        number = self.number(len(text))
        self._align([(number, text)])
        return number

    def _align(self, part: list[tuple[int, str]]) -> None:
        while len(self.table) < self.total:
            self.table = np.concatenate([self.table, np.zeros((max(1024, len(self.table)), self.table.shape[1]), np.int64)])
        self.groups += [""] * (self.total - len(self.groups))
        found = self.own.align(" ".join(word for _, word in part))
        if not len(found.ids_a):
            for half in (part[:len(part) // 2], part[len(part) // 2:]) if len(part) > 1 else ():
                self._align(half)
            return
        ends = np.cumsum([len(word.encode()) + 1 for _, word in part])
        upto = np.stack([np.searchsorted(x, ends, "right") for x in (found.ends_a, found.ends_b, found.common, found.every)], axis=1)
        numbers = np.diff(upto, axis=0, prepend=0)
        at = np.array([number for number, _ in part])
        self.table[at, :-1] = numbers
        self.table[at, -1] = len(self.pairs) + upto[:, 3] - numbers[:, 3]
        self.pairs = np.concatenate([self.pairs, found.links()])
        spelled, start = found.spelled(self.own.names), 0
        for (number, _), end in zip(part, (2 * (upto[:, 0] + upto[:, 1])).tolist()):
            self.groups[number] = "".join(spelled[start:end - 1])
            start = end


class Block:
    """Documents of a task until there are enough: keys, texts, and their words by number."""

    def __init__(self, words: Words):
        self.words, self.keys, self.texts, self.at, self.chars = words, [], [], [], 0

    def add(self, key: pa.Array, text: str) -> None:
        self.keys.append(key)
        self.texts.append(text)
        self.at.append([self.words[w] for w in CUT.split(text)] if text and self.words.own.by_word else [])
        self.chars += len(text)

    def settle(self) -> None:
        """Aligns what is new; a text with a word that has no tokens of its own is aligned as a whole."""
        self.words.learn()
        for i, (text, at) in enumerate(zip(self.texts, self.at)):
            if text and not (at and self.words.table[at, 0].all()):
                self.at[i] = [self.words.whole(text)]

    def groups(self, digest: bool) -> list[str]:
        groups = [";".join(filter(None, map(self.words.groups.__getitem__, at))) for at in self.at]
        return [hashlib.sha256(g.encode()).hexdigest() if g else g for g in groups] if digest else groups

    def counted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of each document; the pairs of all; then, by document, which pairs it holds, how many, and how often each."""
        sizes, at = np.array([len(x) for x in self.at]), np.array([n for x in self.at for n in x], np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        words = self.words.table[at]
        numbers = np.zeros((len(sizes), len(NUMBERS)), np.int64)
        np.add.at(numbers, doc, words[:, :-1])
        pairs, of = np.unique(self.words.pairs, return_inverse=True)
        first, held = words[:, -1], words[:, -2]
        ends = np.cumsum(held)
        places = of[np.repeat(first - (ends - held), held) + np.arange(held.sum())]
        both, times = np.unique(np.repeat(doc, held) * max(1, len(pairs)) + places, return_counts=True)
        doc, which = np.divmod(both, max(1, len(pairs)))
        return numbers, pairs, which, np.bincount(doc, minlength=len(sizes)), times

    def sent(self, block: int, owners: int, digest: bool, key_type: pa.DataType, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, then a list of pairs for each owner; documents name pairs by their place in the lists."""
        self.settle()
        numbers, pairs, which, sizes, times = self.counted()
        counts = np.bincount(which, minlength=len(pairs))
        used = np.flatnonzero(counts)
        owner = _owner(pairs[used], owners)
        order = np.argsort(owner, kind="stable")
        owner, used = owner[order], used[order]
        place = np.zeros(len(pairs), "<u4")
        place[used] = np.arange(len(used))
        pairs, counts = pairs[used], counts[used].astype("<i8")
        ends = np.cumsum(sizes)[:-1]
        places, times = ([x.tobytes() for x in np.split(v.astype("<u4"), ends)] for v in (place[which], times))
        n = len(sizes)
        columns = {
            "block": pa.array([block] * n, pa.int64()), "owner": pa.nulls(n, pa.int32()), "key": pa.concat_arrays(self.keys),
            **{name: pa.array(numbers[:, i]) for i, name in enumerate(NUMBERS)},
            "groups": pa.array(self.groups(digest), pa.string()), "pairs": pa.array(places, pa.binary()), "times": pa.array(times, pa.binary()),
        }
        yield pa.RecordBatch.from_pydict(columns, schema)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        ends = np.append(starts[1:], len(owner))
        n = len(starts)
        if n:
            columns = {
                "block": pa.array([block] * n, pa.int64()), "owner": pa.array(owner[starts], pa.int32()), "key": pa.nulls(n, key_type),
                **{name: pa.nulls(n, pa.int64()) for name in NUMBERS}, "groups": pa.nulls(n, pa.string()),
                "pairs": pa.array([pairs[x:y].astype("<i8").tobytes() for x, y in zip(starts, ends)], pa.binary()),
                "times": pa.array([counts[x:y].tobytes() for x, y in zip(starts, ends)], pa.binary()),
            }
            yield pa.RecordBatch.from_pydict(columns, schema)


NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _owner(pairs: np.ndarray, owners: int) -> np.ndarray:
    mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed ^ (mixed >> np.uint64(29))) % np.uint64(owners)).astype(np.int32)


def _send(shared, owners: int, digest: bool, key_type: pa.DataType, block_chars: int):
    schema = pa.schema([
        ("block", pa.int64()), ("owner", pa.int32()), ("key", key_type), *[(n, pa.int64()) for n in NUMBERS],
        ("groups", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
    ])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = _tokenizers(shared), TaskContext.get().partitionId() << 32
        block = Block(Words(own))
        for batch in batches:
            for i, t in enumerate(batch["text"]):
                text = t.as_py() or ""
                if block.keys and (block.chars + len(text) > block_chars or len(block.keys) == BLOCK_ROWS):
                    yield from block.sent(number, owners, digest, key_type, schema)
                    number, block = number + 1, Block(block.words if block.words.chars < WORD_CHARS else Words(own))
                block.add(batch["key"].slice(i, 1), text)
        if block.keys:
            yield from block.sent(number, owners, digest, key_type, schema)

    return send


def _answer(lists: pa.Table) -> pa.Table:
    """An owner's lists of all blocks: the counts of each list's pairs, and once the highest count of each A id."""
    parts = [np.frombuffer(p.as_py(), "<i8") for p in lists["pairs"]]
    times = np.concatenate([np.frombuffer(t.as_py(), "<i8") for t in lists["times"]])
    pairs, at = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, at, times)
    ids, starts = np.unique(pairs >> 32, return_index=True)
    tops = np.maximum.reduceat(counts, starts)
    ends = np.cumsum([len(p) for p in parts])
    n = lists.num_rows
    return pa.table({
        "block": pa.array([*lists["block"].to_pylist(), None], pa.int64()),
        "owner": pa.array([*lists["owner"].to_pylist(), None], pa.int32()),
        "ids": pa.array([*[(p >> 32).astype("<i4").tobytes() for p in parts], ids.astype("<i4").tobytes()], pa.binary()),
        "counts": pa.array([*[c.astype("<i8").tobytes() for c in np.split(counts[at], ends[:-1])][:n], tops.astype("<i8").tobytes()], pa.binary()),
    })


ANSWERS = "block long, owner int, ids binary, counts binary"


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's highest counts, one row for each A id."""
    best: dict[int, int] = {}
    for batch in batches:
        for ids, counts in zip(batch["ids"], batch["counts"]):
            for i, c in zip(np.frombuffer(ids.as_py(), "<i4").tolist(), np.frombuffer(counts.as_py(), "<i8").tolist()):
                best[i] = max(c, best.get(i, 0))
    yield pa.RecordBatch.from_pydict({"id": pa.array(list(best), pa.int32()), "count": pa.array(list(best.values()), pa.int64())})


def _receive(highest):
    """A block's documents with the counts of their pairs."""

    def receive(docs: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("owner")
        empty = [np.zeros(0, np.int64)]
        ids = np.concatenate([np.frombuffer(x.as_py(), "<i4") for x in answers["ids"]] or empty)
        counts = np.concatenate([np.frombuffer(x.as_py(), "<i8") for x in answers["counts"]] or empty)
        best = counts == highest.value[ids] if len(ids) else np.zeros(0, bool)
        n_best, sums = [], []
        for places, times in zip(docs["pairs"], docs["times"]):
            at, own = np.frombuffer(places.as_py(), "<u4"), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
            n_best.append(int(own[best[at]].sum()))
            sums.append(int((own * counts[at]).sum()))
        return pa.table([
            docs["key"], *[docs[n] for n in NUMBERS], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), docs["groups"],
        ], ["key", *NUMBERS, "n_best", "count_sum", "groups"])

    return receive


def counted(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", digest: bool = False, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each document.

    ``n_best``: links whose pair has the highest count of its A id, ties included; ``count_sum``: of
    the counts of all links. With ``digest`` groups come as their SHA-256 in hex, '' without tokens.
    """
    importable()
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType
    send = _send(_shared(spark, a, b), shuffle_partitions(spark), digest, to_arrow_type(kind), block_chars)
    numbers = ", ".join(f"{n} long" for n in NUMBERS)
    sent = rows.mapInArrow(send, f"block long, owner int, key {kind.simpleString()}, {numbers}, groups string, pairs binary, times binary")
    sent.write.parquet(path := run_dir(spark, "token-blocks"))
    sent = spark.read.schema(sent.schema).parquet(path)

    lists = sent.where(F.col("owner").isNotNull()).select("block", "owner", "pairs", "times")
    lists.groupBy("owner").applyInArrow(_answer, ANSWERS).write.parquet(path := run_dir(spark, "token-counts"))
    answers = spark.read.schema(ANSWERS).parquet(path)
    tops = answers.where(F.col("block").isNull()).select("ids", "counts").mapInArrow(_tops, "id int, count long").groupBy("id").agg(F.max("count").alias("count")).collect()
    highest = np.zeros(max((r["id"] for r in tops), default=-1) + 1, np.int64)  # as many as A has ids
    for r in tops:
        highest[r["id"]] = r["count"]

    own = sent.where(F.col("owner").isNull()).drop("owner")
    answered = answers.where(F.col("block").isNotNull())
    receive = _receive(spark.sparkContext.broadcast(highest))
    found = own.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(receive, f"key {kind.simpleString()}, {numbers}, n_best long, count_sum long, groups string")
    return found.withColumnRenamed("key", key)
