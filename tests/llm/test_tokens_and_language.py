from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from headway.llm import byte_bpe, language_id, queries
from tests.llm.brute import sha
from tests.llm.conftest import SMALL

RANKS, PATTERN = queries.tokenizer()
ODD = ["a", "b", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "'s", "'ll", "1", "23", "é", "ß", "中", "😀", ".", "!!", "the", "The", " and", "​", "\xa0", "aaaa", "====", "é"]


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(RANKS)


@pytest.fixture(scope="module")
def library(vocabulary):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def test_ids_equal_the_librarys(vocabulary, library):
    r, encode = random.Random(1), byte_bpe.Encoder(vocabulary, PATTERN)
    for text in ["", "x" * 3000, "!?" * 500, *("".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(3000))]:
        assert np.frombuffer(encode(text), "<u4").tolist() == library.encode_ordinary(text), text


def test_appending_and_editing_equal_encoding_anew(vocabulary):
    r = random.Random(2)
    for _ in range(300):
        data = "".join(r.choice(ODD) for _ in range(r.randint(1, 200))).encode()
        cut = r.randint(0, len(data))
        prefixes = byte_bpe.Prefixes(vocabulary, data[:cut])
        prefixes.append(data[cut:])
        assert prefixes.last == byte_bpe.Prefixes(vocabulary, data).last
        start = r.randint(0, len(data))
        stop, by = min(len(data), start + r.randint(0, 5)), r.choice(ODD).encode()
        prefixes.replace(start, stop, by)
        assert prefixes.last == byte_bpe.Prefixes(vocabulary, data[:start] + by + data[stop:]).last


def test_an_edit_computes_few_entries_anew(vocabulary):
    prefixes = byte_bpe.Prefixes(vocabulary, b"the of and that is " * 500)
    assert prefixes.replace(100, 103, b"xx") < 1000 < len(prefixes.last)


def test_cached_pieces_are_bounded(vocabulary, monkeypatch, library):
    monkeypatch.setattr(byte_bpe, "CACHED_PIECES", 5)
    monkeypatch.setattr(byte_bpe, "CACHED_PAIRS", 5)
    encode = byte_bpe.Encoder(byte_bpe.Vocabulary(vocabulary.ranks), PATTERN)
    text = " ".join(f"word{i % 13} thing{i % 7}" for i in range(200))
    assert np.frombuffer(encode(text), "<u4").tolist() == library.encode_ordinary(text)


def test_encode_and_decode_frames(spark, make_docs, library):
    rows = [(1, "Hello  there"), (2, None), (3, ""), (3, ""), (None, "ids"), (5, "é" * 2000)]
    docs = make_docs(rows).withColumn("ids", F.lit("clash")).withColumn("Decoded", F.lit(1))
    out = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS)
    assert sorted(c.lower() for c in out.columns) == sorted(c.lower() for c in docs.columns)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert byte_bpe.encode(docs.limit(0), RANKS, PATTERN).count() == 0


def test_op1_over_the_table(spark, library):
    import duckdb

    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall())
    got = queries.op1_byte_bpe(spark, SMALL).collect()
    assert {r["doc_id"] for r in got} == set(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(texts[r["doc_id"]].encode()))


def test_held_out_accuracy(spark):
    import duckdb

    langs = dict(duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    got = [r for r in queries.op2_language_id(spark, "/root/testdata/sf0.01").collect()]
    assert len(got) == len(langs)
    out = [r for r in got if r["held_out"]]
    assert len(out) > 200 and all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in out]) > 0.98


def test_folds_follow_the_checksum(spark):
    import zlib

    got = spark.range(50).select("id", language_id.held_out("id").alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


def test_texts_without_letters_and_odd_tables(spark, make_docs):
    english, german = "the thing and that other thing with them", "und nicht die Straße für der über das"
    docs = make_docs([(i, english if i % 2 else german) for i in range(40)])
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    machines = language_id.fit(docs)
    odd = make_docs([(1, None), (2, ""), (3, "123 !?"), (4, english), (4, english), (None, german)]).withColumn("LANG_PRED", F.lit(0))
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in language_id.predict(odd, machines).collect()}
    assert got[1, None] == got[2, ""] == got[3, "123 !?"] == ("und", 0.0)
    assert got[4, english][0] == "en" and got[None, german][0] == "de"
    assert language_id.predict(odd, machines).count() == 6
    assert language_id.predict(odd.limit(0), machines).count() == 0


def test_no_labels_and_one_language(spark, make_docs):
    docs = make_docs([(i, "some words") for i in range(4)])
    none = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in language_id.predict(docs, none).select("lang_pred", "score").collect()} == {("und", 0.0)}
    one = language_id.fit(docs)
    assert {tuple(r) for r in language_id.predict(docs, one).select("lang_pred", "score").collect()} == {("en", 1.0)}


def test_the_sample_is_bounded(spark, make_docs):
    docs = make_docs([(i, f"word {i}") for i in range(600)]).withColumn("lang", F.when(F.col("doc_id") < 500, "en").otherwise("fr"))
    langs, rows = language_id.sample(docs, "lang", "doc_id", "text", 64)
    assert langs == ["en", "fr"] and rows.count() <= 64
    assert {r["lang"] for r in rows.collect()} == {"en", "fr"}


def test_families_tell_related_languages_apart():
    assert language_id.family_of("de") == language_id.family_of("en") != language_id.family_of("fr")
    assert language_id.family_of("xx") == "xx"


def test_a_sample_has_one_row_a_key_and_both_signs(spark):
    langs = [f"l{i:03}" for i in range(300)]
    rows = [(i, f"{lang} {lang[::-1]} text", lang) for i, lang in enumerate(langs)] + [(0, "l000 again", "l000")] * 50 + [(None, "no key", "l001")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    names, found = language_id.sample(docs, "lang", "doc_id", "text", 2000)
    counts = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
    assert names == langs and counts == dict.fromkeys(langs, 1)


def test_released_pieces_are_worked_out_again(vocabulary):
    encoder = byte_bpe.Encoder(vocabulary, PATTERN)
    before = encoder("the naïve 😀 words, again and again")
    encoder.release()
    assert not any(encoder._caches) and encoder("the naïve 😀 words, again and again") == before
