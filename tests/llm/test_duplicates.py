from __future__ import annotations

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from headway.llm import _graph, _repeats, exact_dedup, ngram_join, queries, substring_dedup, suffix_dedup
from tests.conftest import plan_of
from tests.llm import brute
from tests.llm.conftest import SMALL, docs_of, prose


def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]


# Exact duplicates


@pytest.mark.parametrize("bits", [8, 48, 63])
def test_golomb_codes_round_trip(bits):
    r = np.random.RandomState(bits)
    for n in (0, 1, 2, 17, 200):
        values = np.unique(r.randint(0, 1 << bits, n, np.int64).astype(np.uint64))
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(values, bits), len(values), bits) == values).all()


def test_golomb_codes_are_short():
    values = np.unique(np.random.RandomState(3).randint(0, 1 << 48, 50_000, np.int64).astype(np.uint64))
    assert len(exact_dedup.golomb_encode(values, 48)) < 4.6 * len(values)


@pytest.mark.parametrize("bits", [4, 48])
def test_exact_classes_equal_brute_force(spark, make_docs, bits):
    rows = prose(4, 120) + [(None, "lost"), (None, "lost"), (900, "twice"), (900, "twice"), (901, "x" * 100_000), (902, "x" * 100_000)]
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    got = exact_dedup.classes(make_docs(rows).withColumn("kept", F.lit(1)).withColumn("key", F.lit(2)), bits=bits).collect()
    assert len(got) == len(rows)
    want = collections.Counter()
    for text, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        left = [keep]
        for d in ids:
            stays = d in left
            if stays:
                left.remove(d)
            want[d, keep, len(ids), stays, brute.sha(text.encode())] += 1
    assert collections.Counter(tuple(r) for r in got) == want


def test_exact_rows_that_stay(spark, make_docs):
    rows = [(1, "a"), (2, "a"), (2, "a"), (3, None), (4, ""), (None, "b")]
    got = exact_dedup.deduplicate(make_docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(2, "a"), (4, ""), (None, "b")], key=repr)
    assert exact_dedup.classes(make_docs(rows).limit(0)).count() == 0


# Repeated byte strings and word sequences


def found_bytes(df, **how):
    got = suffix_dedup.remove_repeats(df, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return collections.Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got)


def found_words(df, **how):
    return collections.Counter(tuple(r) for r in substring_dedup.remove_repeats(df, **how).select("doc_id", "n_words", "n_removed", "kept").collect())


@pytest.mark.parametrize("width,hot", [(50, 200_000), (50, 3), (12, 4), (1, 2)])
def test_bytes_equal_brute_force(spark, make_docs, width, hot):
    rows = prose(width, 60)
    assert found_bytes(make_docs(rows), width=width, hot=hot) == collections.Counter(brute.suffix_rows(rows, width))


@pytest.mark.parametrize("width,hot", [(50, 200_000), (50, 3), (8, 3), (1, 2)])
def test_words_equal_brute_force(spark, make_docs, width, hot):
    rows = prose(width + 1, 60)
    assert found_words(make_docs(rows), width=width, hot=hot) == collections.Counter(brute.word_rows(rows, width))


def test_long_texts_go_in_pieces(spark, make_docs, monkeypatch):
    import headway.llm._repeats as own

    monkeypatch.setattr(own, "PIECE", 200)
    monkeypatch.setattr(own, "SLICE", 500)
    bounds = np.array([0, 10, 1010, 1010, 1300])
    starts = set()
    for doc, start, stop in own.pieces(bounds, 50):
        for d, a, b in zip(doc, start, stop):
            assert b - a <= 200
            fresh = set(range(a, b - 49))
            assert not fresh & starts
            starts |= fresh
    assert starts == set(range(10, 961)) | set(range(1010, 1251))


@pytest.mark.parametrize("found,rows_of,name", [(found_bytes, brute.suffix_rows, "n_spans"), (found_words, brute.word_rows, "N_WORDS")])
def test_repeats_in_odd_tables(spark, make_docs, found, rows_of, name):
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(5, long), (5, long), (7, long + " more"), (None, long), (8, None), (9, ""), (5, "other " + long[:600])]
    assert found(make_docs(rows).withColumn(name, F.lit("clash")).withColumn("doc", F.lit(1))) == collections.Counter(rows_of(rows, 50))
    assert not found(make_docs(rows).limit(0))


def test_texts_are_shuffled_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = suffix_dedup.remove_repeats(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text"))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
        # One scan of the texts goes into an exchange that the other joins reuse; one more is hashed for copies.
        assert len(re.findall(r"ReusedExchange \[doc#\d+L, print#\d+, text#\d+\]", plan)) == 2
        assert len(re.findall(r"FileScan parquet", plan)) <= 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_op3_and_op6_over_the_table(spark):
    rows = texts(spark)
    got = collections.Counter(map(tuple, queries.op3_suffix_dedup(spark, SMALL).collect()))
    assert got == collections.Counter((*r[:4], brute.sha(r[4])) for r in brute.suffix_rows(rows, 50))
    got = collections.Counter(map(tuple, queries.op6_substring_dedup(spark, SMALL).collect()))
    assert got == collections.Counter((*r[:3], brute.sha(r[3].encode())) for r in brute.word_rows(rows, 50))


def test_kept_spans(spark, make_docs):
    row = suffix_dedup.remove_repeats(make_docs([(1, "a" * 30 + "b" * 40), (2, "x" + "a" * 30 + "b" * 40 + "y")])).where("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(1, 70)] and bytes(row["kept"]) == b"xy"


# Similarity join


@pytest.mark.parametrize("seed,long", [(1, 30), (2, 120), (3, 12)])
def test_links_equal_brute_force(spark, make_docs, seed, long):
    rows = prose(seed, 150, words=400, long=long)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(make_docs(rows)).collect()}
    assert got == brute.components(rows)


@pytest.mark.parametrize("percent,width", [(80, 1), (60, 2), (90, 5)])
def test_other_thresholds(spark, make_docs, percent, width):
    rows = prose(9, 100, words=60, long=25)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(make_docs(rows), width=width, percent=percent).collect()}
    assert got == brute.components(rows, width, percent)


def test_many_members_are_divided(spark, make_docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "MEMBERS", 5)
    words = [f"w{i}" for i in range(60)]
    rows = [(d, " ".join(words[:50] + [f"own{d}"] + words[50:])) for d in range(60)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.classes(make_docs(rows)).collect()}
    assert got == brute.components(rows) and len({c for _, c in got.values()}) == 1


def test_threshold_is_met_exactly(spark, make_docs):
    # 8 of 10 shingles in common links, 7 of 9 does not.
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words[:13])), (2, " ".join(words[1:14])), (11, " ".join(words[20:32])), (12, " ".join(words[21:33]))]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.classes(make_docs(rows)).collect()}
    assert got == {d: c for d, (_, c) in brute.components(rows).items()} == {1: 1, 2: 1, 11: 11, 12: 12}


def test_odd_documents(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(None, text), (4, text), (6, text.upper()), (7, None), (8, " "), (9, "one two"), (10, "ONE\ntwo"), (12, text), (12, "entirely other text with more words in it")]
    got = sorted((tuple(r) for r in ngram_join.classes(make_docs(rows).withColumn("node", F.lit(1))).collect()), key=repr)
    assert got == sorted([(None, 16, None), (4, 16, 4), (6, 16, 4), (7, 0, 7), (8, 0, 8), (9, 1, 9), (10, 1, 9), (12, 16, 4), (12, 4, 4)], key=repr)
    assert ngram_join.classes(make_docs(rows).limit(0)).count() == 0


def test_one_of_each_group_stays(spark, make_docs):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(3, text), (5, text + " more"), (6, "different words altogether, nothing alike"), (7, None)]
    kept = ngram_join.deduplicate(make_docs(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 6, 7] and "source" in kept.columns


def test_op7_over_the_table(spark):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op7_ngram_join(spark, SMALL).collect()}
    assert got == brute.components(texts(spark))


def test_bands_hold_every_pair():
    for percent in (60, 80, 90):
        scheme = ngram_join.Scheme(percent)
        for small in range(1, 400):
            largest = 100 * small // percent
            assert scheme.band(largest) - scheme.band(small) <= 1
            for large in (small, largest):
                differing = large - small if large > small else 0
                assert differing <= scheme.differing(small)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 130)] + [(5, i) for i in range(200, 230)] + [(7, 7)] + [(1, 2), (2, 1)]
    got = {r["node"]: r["component"] for r in _graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, **{i: 5 for i in [5, *range(200, 230)]}, 1: 1, 2: 1}
    assert _graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_null_key_changes_no_other(spark, monkeypatch):
    large = 2**60
    rows = [(None, "one text"), (large + 1, "same"), (large + 3, "same"), (large + 5, "other"), (None, "same"), (large + 7, None), (large + 9, "")]
    docs = docs_of(spark, rows).coalesce(1)  # one block
    kept = {large + 3, large + 5, large + 9, None}
    for limit in (exact_dedup.BROADCAST_SUSPECTS, 0):
        monkeypatch.setattr(exact_dedup, "BROADCAST_SUSPECTS", limit)
        found = exact_dedup.classes(docs).collect()
        assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["kept"]) for r in found) == sorted([
            ("None", "None", 1, True), (str(large + 1), str(large + 3), 3, False), (str(large + 3), str(large + 3), 3, True), (str(large + 5), str(large + 5), 1, True),
            ("None", str(large + 3), 3, False), (str(large + 7), str(large + 9), 2, False), (str(large + 9), str(large + 9), 2, True)])
        assert {r["doc_id"] for r in exact_dedup.deduplicate(docs).collect()} == kept


def test_only_texts_of_suspects_are_dealt(spark, make_docs):
    """The one exchange that carries texts stands behind the join that keeps suspects."""
    plan = plan_of(exact_dedup.classes(make_docs([(1, "a"), (2, "a"), (3, "b")])), "simple")
    carries = [line for line in plan.splitlines() if "Exchange hashpartitioning(body" in line]
    assert len(carries) == 1 and "BroadcastHashJoin" in plan[plan.index(carries[0]):]
    assert "ENSURE_REQUIREMENTS" in plan and "key#" not in "".join(carries)


def test_hot_anchors_are_told_apart_by_all_their_bits():
    key = np.array([5 << 16, (5 + (1 << 40)) << 16], np.uint64)  # equal in the lower 32 of the 48 bits
    pairs = _repeats._hot_pairs(pa.array([[5]], pa.list_(pa.int64())))
    assert _repeats._among(np.zeros(2, np.int64), key, pairs, hot=True).tolist() == [True, False]


def test_copies_are_found_by_two_hashes_of_their_own(spark):
    docs = spark.createDataFrame([(1, 7, "x"), (2, 8, "x"), (3, 9, "y")], "doc long, print long, text string")
    found = _repeats.copies_of(docs)
    assert [(r["copy"], r["copy_prints"]) for r in found.collect()] == [(2, [8])]
    hashes = docs.select(F.xxhash64("text").alias("one"), F.xxhash64(F.lit(1), "text").alias("two"), F.xxhash64("text", F.lit(1)).alias("chained")).first()
    seeded = docs.select(F.xxhash64(F.lit(hashes["one"]))).first()
    assert hashes["two"] != hashes["one"] and seeded is not None


@pytest.mark.parametrize("width", [5, 8, 20])
def test_suffixes_are_sorted_by_their_bytes(width):
    """Classes equal those of a dictionary, and only ties that disagree are sorted again."""
    bodies = [b"ab" * 20, b"ab" * 19 + b"xy", b"q" * 30, b"only here, only now and then never again", "é".encode() * 12]
    levels = []
    windows, members, classes = suffix_dedup._equal_windows(width, levels)(pa.array(bodies, pa.binary()))
    strings = [b[i:i + width] for b in bodies for i in range(len(b) - width + 1)]
    assert windows.tolist() == [max(0, len(b) - width + 1) for b in bodies] and levels[0] == (len(strings), len(strings))
    assert all(held <= looked for looked, held in levels) and (width <= 8 or levels[-1][1] < levels[-1][0] < len(strings))
    assert classes_of(members, classes) == repeats_of(strings)


@pytest.mark.parametrize("width", [3, 20, 70])
def test_nodes_of_the_tree_are_divided_by_words(width):
    vocabulary = [f"w{i}" for i in range(300)]
    same, other = vocabulary[:90], vocabulary[:40] + ["z"] + vocabulary[41:90]
    bodies = [" ".join(words) for words in (same, other, ["la"] * 80, vocabulary[200:], same[3:])]
    levels = []
    windows, members, classes = substring_dedup._shared_nodes(width, levels)(pa.array([b.encode() for b in bodies], pa.binary()))
    words = [b.split(" ") for b in bodies]
    strings = [tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1)]
    assert windows.sum() == len(strings) and classes_of(members, classes) == repeats_of(strings)
    assert levels[0] == (len(strings), len(strings)) and all(held < len(strings) for _, held in levels[1:])


def test_few_and_no_items_have_no_classes():
    for n in (0, 1):
        members, classes = _repeats.equal_classes(n, [lambda items: np.zeros(len(items), np.uint64)])
        assert len(members) == len(classes) == 0


def classes_of(members, classes):
    groups = collections.defaultdict(set)
    for member, own in zip(members.tolist(), classes.tolist()):
        groups[own].add(member)
    return sorted(map(sorted, groups.values()))


def repeats_of(strings):
    groups = collections.defaultdict(list)
    for i, s in enumerate(strings):
        groups[s].append(i)
    return sorted(g for g in groups.values() if len(g) > 1)
