"""Plain versions of the operators, without Spark, for small tables."""

from __future__ import annotations

import collections
import hashlib

LOWER = bytes(c | 0x20 if 65 <= c <= 90 else c for c in range(256))


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeats(rows, width):
    """{doc: (tokens removed flags)} for (doc, tokens): windows that start in a smaller document."""
    first = {}
    for doc, tokens in rows:
        if doc is None:
            continue
        for p in range(len(tokens) - width + 1):
            w = tuple(tokens[p:p + width])
            first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, tokens in rows:
        gone = [False] * len(tokens)
        for p in range(len(tokens) - width + 1):
            if doc is not None and first[tuple(tokens[p:p + width])] < doc:
                gone[p:p + width] = [True] * width
        out.append((doc, gone))
    return out


def suffix_rows(rows, width):
    """(doc, n_bytes, n_removed, n_spans, kept) of every row."""
    data = [(d, (t or "").encode()) for d, t in rows]
    out = []
    for (doc, body), (_, gone) in zip(data, repeats(data, width)):
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(body), sum(gone), spans, bytes(b for b, g in zip(body, gone) if not g)))
    return out


def word_rows(rows, width):
    """(doc, n_words, n_removed, kept) of every row."""
    data = [(d, (t or "").encode().split()) for d, t in rows]
    return [(doc, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()) for (doc, words), (_, gone) in zip(data, repeats(data, width))]


def shingles(text, width=5):
    words = (text or "").encode().translate(LOWER).split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def components(rows, width=5, percent=80):
    """{doc: (n_shingles, component)} for documents with distinct ids."""
    sets = {d: shingles(t, width) for d, t in rows if d is not None}
    part = {d: d for d in sets}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    holders = collections.defaultdict(list)
    for d in sorted(sets):
        shared = collections.Counter(o for s in sets[d] for o in holders[s])
        for o, k in shared.items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[o]) - k):
                a, b = sorted((root(d), root(o)))
                part[b] = a
        for s in sets[d]:
            holders[s].append(d)
    return {d: (len(sets[d]), root(d)) for d in sets}


def leaks(docs, items, threshold=0.8, width=5):
    """{(doc, item): best similarity} over all windows of the item's length."""
    import regex

    def words(t):
        return [w for w in regex.sub(r"[^\p{L}\p{N}]+", " ", (t or "").lower()).split(" ") if w]

    found = {}
    for item, text in items:
        own = words(text)
        if not own:
            continue
        size = min(width, len(own))
        want = collections.Counter(tuple(own[i:i + size]) for i in range(len(own) - size + 1))
        for doc, body in docs:
            have = words(body)
            for start in range(max(1, len(have) - len(own) + 1)):
                part = have[start:start + len(own)]
                got = collections.Counter(tuple(part[i:i + size]) for i in range(len(part) - size + 1))
                if not got:
                    continue
                similarity = sum((got & want).values()) / sum((got | want).values())
                if similarity >= threshold:
                    found[doc, item] = max(found.get((doc, item), 0), similarity)
    return found
