from __future__ import annotations

import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows, extra="long"):
    """documents with (doc_id, text) rows, in several partitions."""
    full = [(d, t, "en", "src", len(t or "")) for d, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def prose(seed, n, words=40, long=120):
    """(doc_id, text) with copies, near copies, shared passages, odd white space, nulls and empty texts."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 6))) for _ in range(words)]
    passage = " ".join(r.choice(vocabulary) for _ in range(30))
    rows = []
    for d in range(n):
        kind = r.random()
        if rows and kind < 0.2:
            text = r.choice(rows)[1]
        elif rows and kind < 0.45 and (old := r.choice(rows)[1]):
            own = old.split(" ")
            own[r.randrange(len(own))] = r.choice(vocabulary)
            text = " ".join(own)
        elif kind < 0.5:
            text = r.choice([None, "", " \n\t ", "one", "two words"])
        else:
            text = r.choice([" ", "\n", "  "]).join(r.choice(vocabulary) for _ in range(r.randint(1, long)))
            if r.random() < 0.5:
                text = f"{text} {passage} {text[:20]}"
        rows.append((d * 3 % (3 * n) + 1, text))
    return rows


@pytest.fixture
def make_docs(spark):
    return lambda rows: docs_of(spark, rows)
