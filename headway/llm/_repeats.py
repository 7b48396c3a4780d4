"""Windows of tokens that repeat across documents: what the two substring operators share.

Every window of ``width`` tokens has an anchor: the first of its k-grams with the smallest hash.
Equal windows have equal anchors. Neighbouring windows with one anchor form a stretch, some 20
windows long, so there are 20 times fewer stretches than windows.

1. ``anchors``: a document's anchor hashes go to the owners of hash ranges. Owners name those that
   more than one document has (``repeated``). All other windows can't repeat and are done with.
2. ``stretches``: the text of the stretches with named anchors, copies within a batch as one row
   with all places, goes to a bucket. All stretches with one anchor meet in one bucket, unless
   ``hot`` documents or more have it; then their windows are dealt one by one by all they hold.
3. ``settle``: a bucket finds equal windows, each operator by its own method, and marks for each
   place the windows whose smallest document is smaller than its own.
4. ``marks``: the marks of a document come back to it.

Hashes only choose what is compared; equal windows are found by the operator itself, from all their bytes or words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm._common import importable, shuffle_partitions

#: Tokens that are worked on at a time; longer documents go in pieces that overlap by a window.
PIECE = 1 << 17
POSITION_BITS = 18
#: Bytes of text that arrays are made for at a time, or one longer document.
SLICE = 1 << 22
#: Anchors that a task gathers before it sends them.
GATHERED = 1 << 20
#: From so many documents with an anchor on, its windows are dealt one by one. Bounds what meets in a bucket.
HOT = 200_000
#: Bits of an anchor that its owner gets. Fewer are sent faster, and more anchors seem to repeat that do not.
KEY_BITS = 48
#: Buckets for each shuffle partition, and owners at most, so that one group is a small part of a task.
FINER = 8
#: Bytes of text, as the planner estimates them, from which an owner gets anchors. A task sends a row to each owner,
#: so more owners than the text needs only make its rows small.
OWNED = 1 << 22
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each number spread over all of it."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A polynomial hash of each k values in a row, put together from those of 1, 2, 4 ... values."""
    done, done_length, part, length, factor = None, 0, values, 1, MULTIPLIER
    with np.errstate(over="ignore"):
        while True:
            if k & length:
                if done is None:
                    done, done_length = part, length
                else:
                    n = len(values) - done_length - length + 1
                    done = done[:n] * factor + part[done_length:done_length + n]
                    done_length += length
                if done_length == k:
                    return done
            part = part[:len(part) - length] * factor + part[length:]
            length, factor = 2 * length, factor * factor


def smallest(values: np.ndarray, w: int) -> np.ndarray:
    """The smallest of each w values in a row."""
    length = 1
    while 2 * length <= w:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = w - length
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


class Stretches:
    """Runs of windows with one anchor: document, first window, number of windows, anchor and its place."""

    def __init__(self, doc, start, count, key, at):
        self.doc, self.start, self.count, self.key, self.at = doc, start, count, key, at

    def __len__(self) -> int:
        return len(self.doc)


def pieces(bounds: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document, first token, token after the last) of pieces that together have at most 2 * PIECE tokens."""
    held, size = [], 0
    for doc in np.flatnonzero(np.diff(bounds) >= width):
        first, last = int(bounds[doc]), int(bounds[doc + 1])
        for start in range(first, max(first + 1, last - width + 1), PIECE - width + 1):
            stop = min(last, start + PIECE)
            held.append((doc, start, stop))
            size += stop - start
            if size >= PIECE:
                yield tuple(np.array(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.array(x) for x in zip(*held))


def stretches_of(values: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, first: np.ndarray, width: int, k: int) -> Stretches:
    """Stretches of the pieces whose tokens stand one after the other in ``values``; ``first``: first tokens of all documents."""
    lengths = stop - start
    hashes = mixed(rolling(values, k))
    place = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64(POSITION_BITS)
    anchor = smallest((hashes >> low << low) | place, width - k + 1)
    begins = np.cumsum(lengths) - lengths
    # A window at p belongs to a piece if its last token does too.
    inside = np.zeros(len(values) + 1, np.int8)
    inside[begins] = 1
    inside[begins + lengths - width + 1] -= 1
    inside = np.cumsum(inside[:len(anchor)], dtype=np.int8).astype(bool)
    new = np.empty(len(anchor), bool)
    new[0], new[1:] = True, anchor[1:] != anchor[:-1]
    new[begins] = True
    edge = new | ~inside
    edges = np.flatnonzero(edge)
    count = np.diff(edges, append=len(anchor))
    real = inside[edges]
    at, count = edges[real], count[real]
    piece = np.searchsorted(begins, at, "right") - 1
    where = (anchor[at] & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    shift = start[piece] - begins[piece]
    # Smallest hashes are all small: mixed again, they spread over all owners.
    return Stretches(doc[piece], at + shift - first[doc[piece]], count, mixed(hashes[where] ^ MULTIPLIER), where - at)


#: Stands for a null key, so that joins see no nulls and all read one exchange of the documents.
NO_KEY = -(1 << 63)


def known_rows(df: DataFrame, key: str, text: str, others: list[str] = ()) -> DataFrame:
    """(doc, print, text, others): a row is known by its key and a hash of its text, as keys may repeat.

    Other columns go in a struct, whatever their names are.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("doc"), F.hash(body).alias("print"), body.alias("text"), *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("others")] if others else []))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about SLICE bytes of text."""
    texts = batch["text"]
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts)].astype(np.int64)
    heads = np.flatnonzero(np.diff((bounds - bounds[:1]) // SLICE, prepend=-1))
    for a, b in zip(heads, np.append(heads[1:], len(texts))):
        yield batch.slice(a, b - a)


class Tokens:
    """Tokens of a batch of texts. Subclasses know bytes and words."""

    bounds: np.ndarray  # first token of each text, and the number of all

    def values(self, start: int, stop: int) -> np.ndarray:
        raise NotImplementedError

    def strings(self, doc: np.ndarray, start: np.ndarray, count: np.ndarray) -> pa.Array:
        """Text of ``count`` tokens from token ``start`` of each document, so that ``windows`` can read it."""
        raise NotImplementedError

    def pieces(self, width: int, k: int) -> Iterator[tuple[np.ndarray, Stretches]]:
        for doc, start, stop in pieces(self.bounds, width):
            values = np.concatenate([self.values(a, b) for a, b in zip(start, stop)])
            yield values, stretches_of(values, doc, start, stop, self.bounds, width, k)


def owner_of(keys: np.ndarray, owners: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int32)


def _short(keys: np.ndarray) -> bytes:
    """The upper KEY_BITS of the keys."""
    return np.ascontiguousarray((keys >> np.uint64(64 - KEY_BITS)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BITS // 8]).tobytes()


def _long(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // KEY_BITS, 8), np.uint8)
    wide[:, :KEY_BITS // 8] = np.frombuffer(data, np.uint8).reshape(len(wide), -1)
    return wide.view("<u8").ravel()


def _named(keys: np.ndarray) -> np.ndarray:
    """What tells the anchors of a document apart when they come back: the lower 32 of the bits sent."""
    return keys.astype(np.uint32)


def _send(tokens: Callable[[pa.Array], Tokens], width: int, k: int, owners: int):
    def out(keys: list, docs: list) -> pa.RecordBatch:
        keys, docs = np.concatenate(keys), np.concatenate(docs)
        owner = owner_of(keys, owners)
        order = np.argsort(owner, kind="stable")  # documents stay in order, so their keys compress
        ends = np.cumsum(np.bincount(owner, minlength=owners))
        parts = [(o, order[a:b]) for o, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
        return pa.RecordBatch.from_pydict({
            "owner": pa.array([o for o, _ in parts], pa.int32()),
            "keys": pa.array([_short(keys[p]) for _, p in parts], pa.binary()),
            "docs": pa.array([docs[p].tobytes() for _, p in parts], pa.binary()),
        })

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, docs, n = [], [], 0
        for batch in (part for whole in batches for part in slices(whole)):
            doc = batch["doc"].to_numpy()
            for _, found in tokens(batch["text"]).pieces(width, k):
                known = doc[found.doc] != NO_KEY  # filtered here, as a filter in the plan would make it read another exchange
                keys.append(found.key[known])
                docs.append(doc[found.doc][known])
                n += len(found)
                if n >= GATHERED:
                    yield out(keys, docs)
                    keys, docs, n = [], [], 0
        if keys:
            yield out(keys, docs)

    return send


def repeated(hot: int):
    """Of an owner's anchors those that more than one document has, once for each document; hot ones in full."""

    def find(sent: pa.Table) -> pa.Table:
        keys = np.concatenate([_long(x) for x in sent["keys"].to_pylist()])
        docs = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in sent["docs"]])
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        once = new | np.concatenate([[True], docs[1:] != docs[:-1]])
        keys, docs, new = keys[once], docs[once], new[once]
        size = np.diff(np.flatnonzero(np.append(new, True)))
        size = np.repeat(size, size)
        many = size > 1
        return pa.table({"doc": docs[many], "key": _named(keys[many]).view(np.int32), "hot": pa.array(keys[many].view(np.int64), mask=size[many] < hot)})

    return find


def anchors(docs: DataFrame, tokens, width: int, k: int, hot: int) -> DataFrame:
    """(doc, keys, hot_keys) of documents with anchors that other documents have too."""
    parts = shuffle_partitions(docs.sparkSession)
    estimate = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    owners = min(FINER * parts, max(parts, estimate // OWNED))
    sent = docs.select("doc", "text").mapInArrow(_send(tokens, width, k, owners), "owner int, keys binary, docs binary")
    named = sent.groupBy("owner").applyInArrow(repeated(hot), "doc long, key int, hot long")
    return named.groupBy(F.col("doc").alias("of")).agg(F.collect_list("key").alias("keys"), F.collect_list("hot").alias("hot_keys"))


def binary(body: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Byte strings of these lengths, one after the other in ``body``."""
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and the row of each."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(), np.repeat(np.arange(len(column)), lengths)


def _pairs(named: pa.Array) -> np.ndarray:
    """The pairs of document and key in the documents' lists, sorted."""
    keys, docs = _lists(named)
    return np.sort(keys.view(np.uint32).astype(np.uint64) + (docs.astype(np.uint64) << np.uint64(32)))


def _hot_pairs(named: pa.Array) -> np.ndarray:
    """The same of hot keys. All their bits count, since every document must deal an anchor the same way."""
    keys, docs = _lists(named)
    return np.sort(keys.view(np.uint64) + (docs.astype(np.uint64) << np.uint64(KEY_BITS)))


def _among(doc: np.ndarray, key: np.ndarray, pairs: np.ndarray, hot: bool = False) -> np.ndarray:
    """Whether documents have the keys in their lists."""
    if not len(pairs):
        return np.zeros(len(doc), bool)
    sent = key >> np.uint64(64 - KEY_BITS)
    own = sent + (doc.astype(np.uint64) << np.uint64(KEY_BITS)) if hot else _named(sent).astype(np.uint64) + (doc.astype(np.uint64) << np.uint64(32))
    return pairs[np.minimum(np.searchsorted(pairs, own), len(pairs) - 1)] == own


#: What a part of a batch sends to a bucket: texts one after the other with their sizes, how many places each has, and these.
ROWS = "bucket int, bodies binary, sizes binary, counts binary, docs binary, prints binary, starts binary"


def _cut(tokens, width: int, k: int, buckets: int, bucket_of: Callable):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            read = tokens(batch["text"])
            doc, start, count, bucket = [], [], [], []
            named, named_hot = _pairs(batch["keys"]), _hot_pairs(batch["hot_keys"])
            for values, found in read.pieces(width, k):
                use = _among(found.doc, found.key, named)
                hot = use & _among(found.doc, found.key, named_hot, hot=True)
                some = np.flatnonzero(use & ~hot)
                doc.append(found.doc[some])
                start.append(found.start[some])
                count.append(found.count[some])
                bucket.append(bucket_of(read, found.doc[some], found.start[some] + found.at[some], found.key[some], buckets))
                if hot.any():  # window by window, dealt by a hash of the whole window
                    some = np.repeat(np.flatnonzero(hot), found.count[hot])
                    own = found.start[some] + _ramp(found.count[hot])
                    doc.append(found.doc[some])
                    start.append(own)
                    count.append(np.ones(len(some), np.int64))
                    whole = [read.values(a, a + width) for a in read.bounds[found.doc[some]] + own]
                    whole = mixed(rolling(np.concatenate(whole), width)[::width])
                    bucket.append(owner_of(whole, buckets))
            if not doc:
                continue
            doc, start, count, bucket = (np.concatenate(x) for x in (doc, start, count, bucket))
            if not len(doc):
                continue
            # Equal texts of a batch are sent once with all their places.
            coded = read.strings(doc, start, count + width - 1).dictionary_encode()
            code = coded.indices.to_numpy()
            of_text = np.empty(len(coded.dictionary), np.int32)
            of_text[code] = bucket
            by_bucket = np.argsort(of_text, kind="stable")
            rank = np.empty(len(by_bucket), np.int64)
            rank[by_bucket] = np.arange(len(by_bucket))
            texts = coded.dictionary.take(pa.array(by_bucket))
            order = np.argsort(rank[code], kind="stable")
            counts = np.bincount(code, minlength=len(by_bucket))[by_bucket]
            text_ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
            body = np.frombuffer(texts.buffers()[2], np.uint8)
            place_ends = np.concatenate([[0], np.cumsum(counts)])
            columns = batch["doc"].to_numpy()[doc[order]], batch["print"].to_numpy()[doc[order]], start[order].astype(np.int32)
            heads = np.flatnonzero(np.diff(of_text[by_bucket], prepend=-1))
            rows = [
                (int(of_text[by_bucket[a]]), body[text_ends[a]:text_ends[b]].tobytes(), np.diff(text_ends[a:b + 1]).astype("<u4").tobytes(),
                 counts[a:b].astype("<u4").tobytes(), *(c[place_ends[a]:place_ends[b]].tobytes() for c in columns))
                for a, b in zip(heads, np.append(heads[1:], len(by_bucket)))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
                names=["bucket", "bodies", "sizes", "counts", "docs", "prints", "starts"])

    return cut


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each length in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def equal_classes(
    n: int, keys: Iterable[Callable[[np.ndarray], np.ndarray]], levels: list[tuple[int, int]] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(members, class of each) of the items that agree with another one in all keys.

    Items are sorted by the first key, then each tie that disagrees in the next key by that, and so on; what has
    no tie is out. ``levels`` takes (items looked at, items sorted) of each key.
    """
    items, tie = np.arange(n), np.zeros(n, np.int64)
    for key in keys:
        if not len(items):
            break
        own = key(items)
        apart = np.flatnonzero((tie[1:] == tie[:-1]) & (own[1:] != own[:-1]))
        disagree = np.zeros(int(tie[-1]) + 1, bool)
        disagree[tie[apart]] = True
        some = np.flatnonzero(disagree[tie])  # whole ties, one after the other
        if levels is not None:
            levels.append((len(items), len(some)))
        if not len(some):
            continue
        order = some[np.lexsort((own[some], tie[some])) if tie[-1] else np.argsort(own[some])]
        items[some], own[some] = items[order], own[order]
        new = np.concatenate([[True], (tie[1:] != tie[:-1]) | (own[1:] != own[:-1])])
        size = np.diff(np.flatnonzero(np.append(new, True)))
        many = np.repeat(size > 1, size)
        items, tie = items[many], np.cumsum(new[many]) - 1
    return (items, tie) if n > 1 else (items[:0], tie[:0])


def settle(classes_of: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]):
    """Marks of a bucket's rows; classes_of(bodies): windows of each body, members and classes of windows that are equal."""

    def run(rows: pa.Table) -> pa.Table:
        bodies, sizes, counts, docs, prints, starts = (
            np.concatenate([np.frombuffer(x, kind) for x in rows[c].to_pylist()])
            for c, kind in (("bodies", np.uint8), ("sizes", "<u4"), ("counts", "<u4"), ("docs", np.int64), ("prints", np.int32), ("starts", np.int32)))
        row = np.repeat(np.arange(len(counts)), counts)
        windows, members, classes = classes_of(binary(bodies, sizes))
        first = np.cumsum(windows) - windows
        smallest_doc = np.minimum.reduceat(docs, np.cumsum(counts, dtype=np.int64) - counts)
        of_window = np.repeat(smallest_doc, windows)
        if len(members):
            order = np.argsort(classes, kind="stable")
            members, classes = members[order], classes[order]
            heads = np.flatnonzero(np.diff(classes, prepend=-1))
            least = np.minimum.reduceat(of_window[members], heads)
            of_window[members] = np.repeat(least, np.diff(np.append(heads, len(members))))
        # For each place, a bit for each window whose smallest document is another, smaller one.
        place, offset = np.repeat(np.arange(len(docs)), windows[row]), _ramp(windows[row])
        bits = (of_window[first[row[place]] + offset] < docs[place]).astype(np.int64) << offset
        mask = np.bitwise_or.reduceat(bits, np.cumsum(windows[row]) - windows[row]) if len(bits) else np.zeros(0, np.int64)
        some = mask != 0
        return pa.table({"doc": docs[some], "print": prints[some], "start": starts[some], "mask": mask[some]})

    return run


def copies_of(docs: DataFrame) -> DataFrame:
    """(copy, copy_prints) of documents whose whole text a smaller document has too (equal by two 64-bit hashes).

    A hash starts from that of the column before, so the salt of the second comes first: two texts
    that share one hash do not share the other by that.
    """
    known = docs.where(F.col("doc") != NO_KEY).select("doc", "print", F.xxhash64("text").alias("one"), F.xxhash64(F.lit(1), "text").alias("two"))
    first = known.groupBy("one", "two").agg(F.min("doc").alias("first"))
    again = known.join(first, ["one", "two"]).where(F.col("doc") > F.col("first"))
    return again.groupBy(F.col("doc").alias("copy")).agg(F.collect_set("print").alias("copy_prints"))


def marked_rows(docs: DataFrame, tokens, width: int, k: int, bucket_of, classes_of, hot: int = HOT, fold_copies: bool = False) -> DataFrame:
    """The rows, with the windows to remove from texts of their key: prints, starts, masks, and whether it is a copy.

    Bit i of a mask stands for the window at start + i of the text with that print. All joins
    deal the documents by key, so their texts are shuffled once and read again. With
    ``fold_copies``, whole copies of smaller documents are counted with those: all their windows
    go, and none of them is sent.
    """
    if width - k + 1 > 63:
        raise ValueError("a stretch must have fewer than 64 windows: take a larger k")
    importable()
    buckets = FINER * shuffle_partitions(docs.sparkSession)
    copy = F.lit(False)
    originals = docs
    if fold_copies:
        copies = copies_of(docs)
        copy = F.coalesce(F.array_contains("copy_prints", F.col("print")), F.lit(False))
        originals = docs.join(copies, docs["doc"] == copies["copy"], "left").where(~copy).select("doc", "text")
    named = anchors(originals, tokens, width, k, hot)
    found = docs.join(named, docs["doc"] == named["of"]).select("doc", "print", "text", "keys", "hot_keys")
    rows = found.mapInArrow(_cut(tokens, width, k, buckets, bucket_of), ROWS)
    marked = rows.groupBy("bucket").applyInArrow(settle(classes_of), "doc long, print int, start int, mask long")
    lists = marked.groupBy(F.col("doc").alias("of")).agg(*[F.collect_list(c).alias(f"{c}s") for c in ("print", "start", "mask")])
    joined = docs.join(lists, docs["doc"] == lists["of"], "left").drop("of")
    if fold_copies:
        joined = joined.join(copies, joined["doc"] == copies["copy"], "left").withColumn("copy", copy).drop("copy_prints")
    else:
        joined = joined.withColumn("copy", copy)
    return joined.withColumns({c: F.coalesce(c, F.array().cast(f"array<{kind}>")) for c, kind in (("prints", "int"), ("starts", "int"), ("masks", "long"))})


def schema_of(df: DataFrame, others: list[str], results: str) -> str:
    """Schema of the finished rows: doc, other columns, results."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    packed = "struct<{}>".format(", ".join(f"`{c}`: {kinds[c]}" for c in others))
    return ", ".join(["doc long", *([f"others {packed}"] if others else []), results])


def keyed_again(found: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """The rows with their key in place of ``doc``."""
    own = F.when(F.col("doc") != NO_KEY, F.col("doc")).cast(df.schema[key].dataType).alias(key)
    return found.select(own, *(["others.*"] if "others" in found.columns else []), *[c for c in found.columns if c not in ("doc", "others")])


def covered(bounds: np.ndarray, batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Whether each token of a batch is in a marked window."""
    begin, row = _lists(batch["starts"])
    mask, _ = _lists(batch["masks"])
    own = _lists(batch["prints"])[0] == batch["print"].to_numpy()[row]
    begin, row, mask = begin[own], row[own], mask[own]
    delta = np.zeros(int(bounds[-1]) + 1, np.int8)
    if len(begin):
        begin = begin + bounds[row]
        gone = np.unique(np.concatenate([begin[mask >> i & 1 == 1] + i for i in range(63)]))
        delta[gone] += 1
        delta[gone + width] -= 1
    gone = np.cumsum(delta[:-1], dtype=np.int8) > 0
    lengths = np.diff(bounds)
    whole = batch["copy"].to_numpy(zero_copy_only=False).astype(bool) & (lengths >= width)
    return gone | np.repeat(whole, lengths) if whole.any() else gone
