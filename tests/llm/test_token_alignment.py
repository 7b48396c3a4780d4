from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import plan_of

from headway.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tools():
    return ta.Tokenizers(open(A, encoding="utf-8").read(), open(B, "rb").read())


def brute_tokens(tools, text):
    """[(id, start, end)] of A and of B by decoded bytes alone, or None."""
    import sentencepiece
    import tokenizers

    if not text:
        return None
    plain = tokenizers.Tokenizer.from_file(A)
    plain.encode_special_tokens = True
    out = []
    for ids, table in ((plain.encode(" " + text, add_special_tokens=False).ids, tools.bytes_a), (sentencepiece.SentencePieceProcessor(model_file=B).encode(text), tools.bytes_b)):
        if b"".join(table[i] for i in ids) != (" " + text).encode():
            return None
        at, own = 0, []
        for i in ids:
            own.append((i, at, at + len(table[i])))
            at += len(table[i])
        out.append(own)
    return out


def brute(tools, rows):
    held, each = Counter(), []
    for key, text in rows:
        found = brute_tokens(tools, text)
        if found is None:
            each.append((key, None, None, [], ""))
            continue
        a, b = found
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(x[0]) for x in side if low < x[2] <= cut) for side in (a, b)))
            low = cut
        held.update(set(links))
        each.append((key, a, b, links, ";".join(groups)))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return sorted(
        (str(key), len(a or []), len(b or []), len(groups.split(";")) if groups else 0, len(links), sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links), groups)
        for key, a, b, links, groups in each
    )


ODD = [
    None, "", " ", "\n\t ", "a", "<|endoftext|> and <s></s> <unk>", "héé 😀中x 👩‍👩‍👧 ①", "a▁b", "﷽ ﬁ ﬂ", "a  b\n\tc \x00 z", "日本語のテキスト", "ﾊﾝｶｸ", "é   ​", "🏴󠁧󠁢󠁥󠁮󠁧󠁿", "x" * 300, "😀" * 40,
    "the the the", "<0x0A>", "\r\n\r\n",
]


def texts(seed, n):
    r = random.Random(seed)
    words = ["the", "of", "and", "übermäßig", "naïve", "😀", "中文", "1234567", "don't", "e-mail", "\n", "  ", "ελληνικά", "x" * 9, "‍"]
    rows = [(i, t) for i, t in enumerate(ODD)]
    for i in range(n):
        rows.append((r.choice([100 + i, 100 + i, None, 100]), r.choice([" ", "", "\n"]).join(r.choice(words) for _ in range(r.randint(0, 30)))))
    return rows


def test_spans_are_the_tokens_bytes(tools):
    for _, text in texts(1, 60):
        found, expected = tools.align(text), brute_tokens(tools, text)
        if expected is None:
            assert not len(found.ids_a)
            continue
        assert [(i, e) for i, _, e in expected[0]] == list(zip(found.ids_a.tolist(), found.ends_a.tolist()))
        assert [(i, e) for i, _, e in expected[1]] == list(zip(found.ids_b.tolist(), found.ends_b.tolist()))


@pytest.mark.parametrize("block", [ta.BLOCK_CHARS, 200])
def test_counts_equal_brute_force(spark, tools, block):
    rows = texts(2, 80)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ta.counted(docs, A, B, block_chars=block)
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    expected = brute(tools, rows)
    assert sorted((str(r["doc_id"]), *[r[n] for n in numbers]) for r in found.collect()) == expected
    hashed = ta.counted(docs, A, B, digest=True, block_chars=block).collect()
    assert sorted((str(r["doc_id"]), r["groups"]) for r in hashed) == sorted((r[0], hashlib.sha256(r[-1].encode()).hexdigest() if r[1] else "") for r in expected)


def test_words_of_a_block_are_aligned_as_whole_texts_are(tools):
    assert tools.by_word
    words, rows = ta.Words(tools), texts(3, 120)
    rows += [(0, "a word a  word\ta word 's ' s don't"), (0, " lead a"), (0, "end "), (0, "x \x1c y z"), (0, "a \u0085b c\u2028 d")]
    for by_word in (True, False):
        tools.by_word = by_word
        block = ta.Block(words)
        for i, (_, t) in enumerate(rows):
            block.add(None, t or "")
        block.settle()
        groups = block.groups(False)
        numbers, pairs, which, sizes, times = block.counted()
        held = [dict(zip(pairs[w].tolist(), n.tolist())) for w, n in zip(*(iter(np.split(x, sizes.cumsum()[:-1])) for x in (which, times)))]
        for i, (_, t) in enumerate(rows):
            found = tools.align(t)
            assert numbers[i].tolist() == [len(found.ids_a), len(found.ids_b), len(found.common), len(found.links())]
            assert groups[i] == found.groups(tools.names)
            assert held[i] == dict(Counter(found.links().tolist()))
        tools.by_word = True


def test_words_are_not_cut_for_other_vocabularies(tools):
    import json

    a, b = json.load(open(A, encoding="utf-8")), open(B, "rb").read()
    assert tools._words_apart(a, b)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"added_tokens": [{"content": "a b", "special": False}]}):
        assert not tools._words_apart({**a, **change}, b)


def test_real_outputs_and_odd_tables(spark, tools):
    docs = spark.createDataFrame([(1, "übermäßig 😀", "x", 3)], "doc_id long, text string, groups string, N_A int")
    row = ta.aligned(docs, A, B).collect()[0]
    found = tools.align("übermäßig 😀")
    assert row["ids_a"] == found.ids_a.tolist() and row["ends_b"] == found.ends_b.tolist() and row["groups"] == found.groups(tools.names)
    assert ta.counted(docs, A, B).collect()[0]["groups"] == row["groups"]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ta.counted(empty, A, B).count() == 0 and ta.aligned(empty, A, B).count() == 0
    nothing = spark.createDataFrame([(2**60 + 1, None), (None, "")], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"], r["groups"]) for r in ta.counted(nothing, A, B).collect()) == [(0, 0, 0, ""), (2**60 + 1, 0, 0, "")]
    named = spark.createDataFrame([("k1", "a text")], "doc_id string, text string")
    assert ta.counted(named, A, B).collect()[0]["doc_id"] == "k1"


def test_a_very_long_text(spark, tools):
    text = "word 中 " * 200_000
    row = ta.counted(spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string"), A, B).where("doc_id = 1").collect()[0]
    found = tools.align(text)
    assert (row["n_a"], row["n_links"]) == (len(found.ids_a), len(found.links()))


def test_tokenizers_run_once(spark, make_docs):
    plan = plan_of(ta.counted(make_docs([(1, "a b")]), A, B))
    assert "MapInArrow" not in plan and "Window" not in plan
