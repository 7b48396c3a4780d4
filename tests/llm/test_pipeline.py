from __future__ import annotations

import corpus_pipeline
import pytest

from headway.llm import queries
from tests.llm import brute
from tests.llm.conftest import SMALL

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_whole_pipeline_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(d, t) for d, t in rows if t and any(map(str.isalpha, t))]
    last = {}
    for d, t in sorted(rows):
        last[t] = d
    rows = [(d, t) for t, d in last.items()]
    parts = brute.components(rows)
    rows = [(d, t) for d, t in rows if parts[d][1] == d]
    leaked = {d for d, _ in brute.leaks(rows, items)}
    want = {d: t for d, t in rows if d not in leaked}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) == set(want)
    tokens = {r["doc_id"]: r["n_tokens"] for r in queries.op1_byte_bpe(spark, SMALL).collect()}
    assert all(r["text"] == want[d] and r["n_tokens"] == tokens[d] for d, r in got.items())


def test_stages(spark, make_docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    passage = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    long = " ".join(f"word{i}" for i in range(60))
    docs = make_docs([(1, None), (2, ""), (3, "12 34"), (4, "a clean text"), (5, "a clean text"), (6, long), (7, long + " more"), (8, f"x {passage} y"), (None, "no id"), (9, "b"), (9, "b")])
    left = [{4, 5, 6, 7, 8, None, 9}, {5, 6, 7, 8, None, 9}, {5, 6, 8, None, 9}, {5, 6, None, 9}, {5, 6, None, 9}]
    for (_, stage), want in zip(corpus_pipeline.STAGES, left):
        docs = stage(spark, docs, SMALL).cache()
        got = [r["doc_id"] for r in docs.collect()]
        assert set(got) == want
        if want is not left[0]:
            assert len(got) == len(want)
        assert docs.columns[:5] == COLUMNS
    row = docs.where("doc_id = 5").first()
    assert row["n_tokens"] == len(row["ids"])


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_empty_input(spark, make_docs, stage):
    assert stage(spark, make_docs([(1, "x")]).limit(0), SMALL).count() == 0
