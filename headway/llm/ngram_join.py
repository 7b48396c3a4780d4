"""Similarity join on word shingles by partitioning their universe (pigeonhole principle).

Sets are a document's distinct five-word shingles. Two documents link if their Jaccard similarity
is at least ``percent`` / 100.

1. Size bands: a set only links with sets of its own or a neighbouring band. A pair belongs to the
   band of its smaller set; so each set takes part in its own band and in the one below.
2. For a band, hashes divide the universe of shingles into segments. If two sets link, at most H
   shingles are in one of them alone, H following from the band's largest size. So of any H + 1
   segments at least one holds the same shingles of both. The hash of what a segment holds of a
   set is sent to the owner of its hash range (``signatures``). In small bands the hashes of a
   segment's shingles without one (one-deletion neighbourhood) are sent too: two such segments
   meet unless they differ by two shingles, so one segment counts as two.
3. Owners return the signatures that more than one document has, with the length of their lists.
   Sets that share too few segments with others to link are done with. Of the rest, each picks
   the cheapest signatures that add up to H + 1, by these costs (``_allocate``).
   What no other set has costs nothing and counts. There are more segments than H + 1, so
   the few with long lists (empty ones, or the words of a line that many texts have) are left out.
4. Lists that a set looks up are known by their smallest document, the centre. All lists of one
   centre form a group; near copies have few centres, so a set travels once or twice. In a group,
   a set is compared with those it looks up unless links found before already tie both, first by a
   bound (classes of hashes of which one set has an odd and the other an even number are
   differences), then on the whole sets. No pair but a verified link is ever a row.
5. Links become components (``_graph``).

Documents with equal sets are one node from the start, in a task before anything is sent and in
all before anything is verified. Signatures only choose candidates; each link is verified with
both whole sets of shingle hashes (48 bits).

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text with fewer words
than a shingle is one shingle; without words, or null, it has none and links with nothing. Rows
with a null key link with nothing, and their component is null. Rows with one key and different
texts count as linked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm import _repeats
from headway.llm._common import importable, settled, shuffle_partitions
from headway.llm._graph import components
from headway.llm.exact_dedup import golomb_decode, golomb_encode
from headway.llm._repeats import FINER, _ramp, mixed, owner_of, rolling
from headway.llm.substring_dedup import Words

SHINGLE, PERCENT = 5, 80
#: Segments beyond those that the pigeonhole principle asks for, as a share: room to leave out long lists.
SPARE = 8
#: Bands up to this size have one-deletion neighbourhoods for one in DELETED segments.
SMALL, DELETED = 64, 4
#: Words that are worked on at a time, about.
CHUNK = 1 << 17
#: Members of a centre that meet in one group; more are divided into blocks of this size.
MEMBERS = 2000
#: Bits of a shingle's hash by which sets are compared, and classes of the quick test before that.
SET_BITS, PARITY_BITS = 48, 2048
#: Signatures that a task gathers before it sends them.
GATHERED = 1 << 20
BAND_BITS, SEGMENT_BITS = 8, 8
#: Bytes of a signature that are sent.
KEY_BYTES = 7


def band_tops(percent: int, limit: int = 1 << 31) -> np.ndarray:
    """Largest size of each band; no set of a band links with one beyond the next band."""
    tops = [1]
    while tops[-1] < limit:
        tops.append(max(tops[-1] + 1, 100 * tops[-1] // percent))
    return np.array(tops, np.int64)


class Scheme:
    """Bands, segments and needs for a similarity threshold."""

    def __init__(self, percent: int):
        self.percent = percent
        self.tops = band_tops(percent)
        if len(self.tops) >= 1 << BAND_BITS:
            raise ValueError("the threshold is too close to 1 for the bands to be numbered")
        most = self.differing(self.tops)
        self.segments = most + 1 + np.maximum(1, (most + 1) // SPARE)
        self.deleted = np.where(self.tops <= SMALL, np.maximum(1, self.segments // DELETED), 0)

    def differing(self, size):
        """Most shingles that are in one set alone, if the smaller set has this size and both link."""
        return (100 - self.percent) * size // self.percent

    def band(self, n):
        return np.searchsorted(self.tops, n)

    def need(self, n, band):
        return self.differing(np.minimum(n, self.tops[band])) + 1


class ShingleWords(Words):
    """Words with A-Z lower-cased."""

    def __init__(self, texts: pa.Array):
        super().__init__(texts)
        capital = (self.data >= 0x41) & (self.data <= 0x5A)
        self.data = np.where(capital, self.data | 0x20, self.data)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of some documents at a time: (documents, size of each set, hashes of all sets in order)."""
    read = ShingleWords(texts)
    counts = np.diff(read.bounds)
    group = np.cumsum(counts) // CHUNK
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-2)) if len(counts) else np.zeros(0, int)
    for a, b in zip(edges[:-1], edges[1:]):
        docs = np.arange(a, b)
        first, n = read.bounds[a], counts[a:b]
        values = read.values(read.bounds[a], read.bounds[b])
        begin = read.bounds[a:b] - first
        own = np.where(n >= width, n - width + 1, 0)
        where = np.repeat(begin, own) + _ramp(own)
        hashes = mixed(rolling(values, width)[where]) if len(values) >= width else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(b - a), own)
        short = np.flatnonzero((n > 0) & (n < width))
        if len(short):
            with np.errstate(over="ignore"):
                whole = [mixed(rolling(values[begin[i]:begin[i] + n[i]], int(n[i])) + np.uint64(n[i]))[0] for i in short]
            hashes, owner = np.concatenate([hashes, np.array(whole, np.uint64)]), np.concatenate([owner, short])
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        yield docs, np.bincount(owner[new], minlength=b - a), hashes[new]


def _fingerprints(sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit sums of each set."""
    out = []
    for salt in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        sums = np.zeros(len(sizes), np.uint64)
        some = sizes > 0
        if some.any():
            sums[some] = np.add.reduceat(mixed(hashes ^ np.uint64(salt)), (np.cumsum(sizes) - sizes)[some])
        out.append(sums.view(np.int64))
    return out[0], out[1]


def _meta(width: int):
    def meta(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, sizes, hashes in shingle_sets(batch["text"], width):
                one, two = _fingerprints(sizes, hashes)
                yield pa.RecordBatch.from_pydict({
                    "doc": batch["doc"].take(pa.array(docs)), "n": pa.array(sizes, pa.int64()), "one": pa.array(one), "two": pa.array(two)})

    return meta


def signatures_of(scheme: Scheme, sizes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, key) of all signatures. Key: hash, whether a shingle is left out, segment in small bands, band."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    value = mixed(hashes ^ np.uint64(0x6A09E667F3BCC908))
    found = []
    own = scheme.band(sizes)
    for band in (own, own - 1):
        use = (sizes > 0) & (band >= 0)
        band = np.maximum(band, 0)
        segments = np.where(use, scheme.segments[band], 0)
        base = np.cumsum(segments) - segments
        inside = use[owner]
        mine = owner[inside]
        segment = ((hashes[inside] >> np.uint64(32)) * segments[mine].astype(np.uint64)) >> np.uint64(32)
        cell = base[mine] + segment.astype(np.int64)
        held = np.zeros(int(segments.sum()), np.uint64)
        np.add.at(held, cell, value[inside])
        set_of = np.repeat(np.arange(len(sizes)), segments)
        found.append((set_of, _key(held, _ramp(segments), band[set_of], scheme, False)))
        less = segment.astype(np.int64) < scheme.deleted[band][mine]
        if less.any():
            at = cell[less]
            found.append((mine[less], _key(held[at] - value[inside][less], segment.astype(np.int64)[less], band[mine[less]], scheme, True)))
    return np.concatenate([s for s, _ in found]), np.concatenate([k for _, k in found])


def _key(held: np.ndarray, segment: np.ndarray, band: np.ndarray, scheme: Scheme, less: bool) -> np.ndarray:
    place = segment.astype(np.uint64) << np.uint64(BAND_BITS) | band.astype(np.uint64)
    low = np.uint64(BAND_BITS + SEGMENT_BITS)
    hashed = mixed(held + mixed(place)) >> low << low
    small = np.where(scheme.tops[band] <= SMALL, segment, (1 << SEGMENT_BITS) - 1).astype(np.uint64)
    return hashed | small << np.uint64(BAND_BITS) | band.astype(np.uint64)


def short(keys: np.ndarray) -> np.ndarray:
    """Keys without their highest byte, a row of bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES])


def long(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    wide[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(len(wide), KEY_BYTES)
    return wide.view("<u8").ravel()


def _send(width: int, percent: int, owners: int):
    def out(parts: list) -> pa.RecordBatch:
        keys, docs = (np.concatenate(x) for x in zip(*parts))
        owner = owner_of(keys << np.uint64(8), owners)
        order = np.argsort(owner, kind="stable")  # documents stay in order, so their keys compress
        ends = np.cumsum(np.bincount(owner, minlength=owners))
        cuts = [(o, order[a:b]) for o, (a, b) in enumerate(zip([0, *ends[:-1]], ends)) if b > a]
        return pa.RecordBatch.from_pydict({
            "owner": pa.array([o for o, _ in cuts], pa.int32()),
            **{name: pa.array([column[c].tobytes() for _, c in cuts], pa.binary()) for name, column in (("keys", short(keys)), ("docs", docs))},
        })

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme, parts, n = Scheme(percent), [], 0
        for batch in batches:
            doc = batch["doc"].to_numpy()
            for some, sizes, hashes in shingle_sets(batch["text"], width):
                one, two = _fingerprints(sizes, hashes)
                order = np.lexsort((doc[some], two, one))
                again = np.zeros(len(some), bool)
                again[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
                sizes_left = np.where(again, 0, sizes)  # of equal sets the smallest document speaks for all
                set_of, keys = signatures_of(scheme, sizes_left, hashes[~np.repeat(again, sizes)])
                parts.append((keys, doc[some][set_of]))
                n += len(keys)
                if n >= GATHERED:
                    yield out(parts)
                    parts, n = [], 0
        if parts:
            yield out(parts)

    return send


def _lists(sent: pa.Table) -> pa.Table:
    """Of an owner's signatures those that more than one document has, once a document, with the number of documents."""
    keys = np.concatenate([long(x) for x in sent["keys"].to_pylist()])
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in sent["docs"].to_pylist()])
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    once = new | np.concatenate([[True], docs[1:] != docs[:-1]])
    keys, docs, new = keys[once], docs[once], new[once]
    length = np.diff(np.flatnonzero(np.append(new, True)))
    length = np.repeat(length, length)
    many = length > 1
    return pa.table({"doc": docs[many], "key": keys[many].view(np.int64), "cost": length[many].astype(np.int32)})


def _allocate(percent: int):
    """Which of the listed signatures of each set it looks up: the cheapest that are enough.

    Sets that link differ in few segments, so they share the others. A set with fewer listed
    segments than that in a band links with none there, and its signatures go.
    """

    def allocate(rows: pa.Table, sets: pa.Table) -> pa.Table:
        scheme = Scheme(percent)
        order = np.argsort(rows["doc"].to_numpy(), kind="stable")
        listed_doc = rows["doc"].to_numpy()[order]
        first, last = (np.searchsorted(listed_doc, sets["doc"].to_numpy(), side) for side in ("left", "right"))
        where = order[np.repeat(first, last - first) + _ramp(last - first)]
        if not len(where):
            return pa.table({"key": np.zeros(0, np.int64), "node": np.zeros(0, np.int64), "probe": np.zeros(0, bool)})
        doc = np.repeat(np.arange(sets.num_rows), last - first)
        n = sets["n"].to_numpy()[doc]
        cost = rows["cost"].to_numpy()[where].astype(np.int64)
        key = rows["key"].to_numpy()[where].view(np.uint64)
        band = (key & np.uint64((1 << BAND_BITS) - 1)).astype(np.int64)
        segment = (key >> np.uint64(BAND_BITS) & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)
        order = np.lexsort((cost, segment, band, doc))
        doc, n, key, band, segment, cost = (x[order] for x in (doc, n, key, band, segment, cost))
        small = scheme.tops[band] <= SMALL
        new_set = np.concatenate([[True], (doc[1:] != doc[:-1]) | (band[1:] != band[:-1])])
        set_of = np.cumsum(new_set) - 1
        # In small bands a segment with all its keys is one choice; else each key is a segment.
        new_choice = new_set | ~small | np.concatenate([[True], segment[1:] != segment[:-1]])
        choice = np.cumsum(new_choice) - 1
        heads = np.flatnonzero(new_choice)
        owner = set_of[heads]
        # A segment with its neighbourhood finds all that differ by one shingle there, so it counts as two.
        worth = np.where(small[heads] & (segment[heads] < scheme.deleted[band[heads]]), 2, 1)
        price = np.add.reduceat(cost, heads) / worth
        cheap = np.lexsort((price, owner))
        before = np.cumsum(worth[cheap]) - worth[cheap]
        first = np.flatnonzero(np.diff(owner[cheap], prepend=-1))
        before -= np.repeat(before[first], np.diff(np.append(first, len(owner))))
        listed = np.add.reduceat(worth[cheap], first)
        set_heads = np.flatnonzero(new_set)
        of = band[set_heads]
        wanted = scheme.need(n[set_heads], of) - (scheme.segments[of] + scheme.deleted[of] - listed)
        taken = np.empty(len(owner), bool)
        taken[cheap] = before < wanted[owner[cheap]]
        most = scheme.differing(np.minimum(n[set_heads], scheme.tops[of]))
        enough = np.bincount(owner, minlength=len(set_heads)) >= scheme.segments[of] - most
        probe, use = taken[choice], enough[set_of]
        return pa.table({"key": key.view(np.int64)[use], "node": sets["node"].to_numpy()[doc][use], "probe": probe[use]})

    return allocate


def _centres(rows: pa.Table) -> pa.Table:
    """Nodes of the bucket's signatures that several nodes have and one looks up, with the smallest node of each list."""
    key, node = rows["key"].to_numpy(), rows["node"].to_numpy()
    probe = rows["probe"].to_numpy()
    order = np.lexsort((~probe, node, key))
    key, node, probe = key[order], node[order], probe[order]
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    key, node, probe = key[once], node[once], probe[once]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(heads, len(key)))
    use = np.repeat((size > 1) & np.logical_or.reduceat(probe, heads), size)
    centre, node, probe = np.repeat(node[heads], size)[use], node[use], probe[use]
    order = np.lexsort((~probe, node, centre))
    centre, node, probe = centre[order], node[order], probe[order]
    once = np.ones(len(node), bool)
    once[1:] = (centre[1:] != centre[:-1]) | (node[1:] != node[:-1])
    return pa.table({"centre": centre[once], "node": node[once], "probe": probe[once]})


def _spread(width: int):
    """The set of each document to every group in which it is compared, as Golomb-coded hashes."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch["groups"].to_pylist()
            for docs, sizes, hashes in shingle_sets(batch["text"], width):
                rows = []
                for i, own in zip(docs, np.split(hashes >> np.uint64(64 - SET_BITS), np.cumsum(sizes)[:-1])):
                    own = np.unique(own)
                    coded = golomb_encode(own, SET_BITS)
                    doc = batch["doc"][int(i)].as_py()
                    for g in groups[i]:
                        rows += [(g["centre"], low, high, g["block"], doc, g["probe"], len(own), coded) for low, high in (sorted((g["block"], x)) for x in range(g["blocks"]))]
                for start in range(0, len(rows), 2000):
                    kinds = pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary()
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[start:start + 2000]), kinds)], names=GROUPED)

    return spread


GROUPED = ["centre", "low", "high", "block", "doc", "probe", "n", "set"]
GROUPED_TYPES = "centre long, low int, high int, block int, doc long, probe boolean, n int, set binary"


def parity(hashes: np.ndarray) -> np.ndarray:
    """For each of PARITY_BITS classes of hashes, whether it has an odd number of them."""
    return np.packbits((np.bincount(hashes.astype(np.int64) & (PARITY_BITS - 1), minlength=PARITY_BITS) & 1).astype(np.uint8)).view(np.uint64)


def _verify(percent: int):
    """Links between documents of a group of which one looks up the other. Those that already hang together are skipped."""

    def links_of(rows: pa.Table) -> list[tuple[int, int]]:
        docs, block, n = (rows[c].to_numpy() for c in ("doc", "block", "n"))
        probe = rows["probe"].to_numpy()
        low, high = rows["low"][0].as_py(), rows["high"][0].as_py()
        coded = rows["set"].to_pylist()
        sets = [golomb_decode(c, int(k), SET_BITS) for c, k in zip(coded, n)]
        odd = np.stack([parity(s) for s in sets])
        part, found = np.arange(len(docs)), []
        for i in range(len(docs) - 1):
            rest = np.arange(i + 1, len(docs))
            fits = (part[rest] != part[i]) & (probe[rest] | probe[i]) & (docs[rest] != docs[i])
            fits &= 100 * np.minimum(n[rest], n[i]) >= percent * np.maximum(n[rest], n[i])
            if low != high:
                fits &= block[rest] != block[i]
            rest = rest[fits]
            # Two sets differ at least in the classes where one is odd and the other even.
            apart = np.bitwise_count(odd[rest] ^ odd[i]).sum(axis=1, dtype=np.int64)
            for j in rest[apart * (100 + percent) <= (100 - percent) * (n[rest].astype(np.int64) + n[i])]:
                if part[j] != part[i] and _linked(sets[i], sets[j], percent):
                    found.append((docs[i], docs[j]))
                    part[part == part[j]] = part[i]
        return found

    def verify(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("centre", "low", "high", "doc")])
        places = [rows[c].to_numpy() for c in ("centre", "low", "high")]
        heads = np.flatnonzero(np.concatenate([[True], np.any([p[1:] != p[:-1] for p in places], axis=0)]))
        found = [pair for a, b in zip(heads, np.append(heads[1:], rows.num_rows)) if b - a > 1 for pair in links_of(rows.slice(a, b - a).combine_chunks())]
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return verify


def _linked(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have at least the similarity."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


def _links(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """Verified links (a, b) that tie together what links among the members of each centre; ``members``: centre, node, probe."""
    buckets = FINER * shuffle_partitions(docs.sparkSession)
    # A centre with many members is divided into blocks, and each pair of blocks is a group.
    counts = members.groupBy("centre").agg((F.floor(F.count("*") / MEMBERS) + 1).cast("int").alias("blocks")).withColumnRenamed("centre", "of")
    placed = members.join(counts, F.col("centre") == F.col("of")).select("node", "centre", "probe", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    groups = placed.groupBy("node").agg(F.collect_list(F.struct("centre", "probe", "blocks", "block")).alias("groups"))
    needed = docs.join(groups, docs["doc"] == groups["node"]).select("doc", "text", "groups")
    sets = needed.mapInArrow(_spread(width), GROUPED_TYPES)
    bucket = F.pmod(F.xxhash64("centre", "low", "high"), F.lit(buckets)).alias("bucket")
    return sets.groupBy(bucket).applyInArrow(_verify(percent), "a long, b long")


def classes(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row: key, n_shingles, component_id (the smallest key that links lead to)."""
    importable()
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    buckets = FINER * shuffle_partitions(spark)
    meta = settled(docs.mapInArrow(_meta(width), "doc long, n long, one long, two long"))
    # Rows with equal sets are one node, the smallest document of them.
    nodes = meta.where("n > 0 and doc is not null").groupBy("one", "two").agg(F.min("doc").alias("node"))
    of = settled(meta.join(nodes, ["one", "two"], "left").select("doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("node", "doc")).alias("node")))
    own = of.where("n > 0 and doc is not null").select("doc", "node", "n").distinct()

    known = docs.where(F.col("doc").isNotNull())
    sent = known.mapInArrow(_send(width, percent, shuffle_partitions(spark)), "owner int, keys binary, docs binary")
    listed = sent.groupBy("owner").applyInArrow(_lists, "doc long, key long, cost int")
    part = F.pmod(F.xxhash64("doc"), F.lit(buckets)).alias("part")
    keyed = listed.groupBy(part).cogroup(own.groupBy(part)).applyInArrow(_allocate(percent), "key long, node long, probe boolean")
    by_key = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")
    members = keyed.groupBy(by_key).applyInArrow(_centres, "centre long, node long, probe boolean").groupBy("centre", "node").agg(F.max("probe").alias("probe"))
    links = _links(known, settled(members), width, percent)
    # Rows that share a key but not a text.
    same = own.groupBy("doc").agg(F.min("node").alias("a"), F.collect_set("node").alias("all")).where(F.size("all") > 1).select("a", F.explode("all").alias("b"))
    every = components(links.union(same))
    component = F.coalesce("component", of["node"])
    return of.join(every.withColumnRenamed("node", "of"), of["node"] == F.col("of"), "left").select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows whose key is their component's, so one document of each group, with all columns."""
    keep = classes(df, key, text, width, percent).where(F.col("component_id").eqNullSafe(F.col(key))).select(F.col(key).alias("_key")).distinct()
    return df.join(keep, F.col(key).cast("long").eqNullSafe(F.col("_key")), "left_semi")
