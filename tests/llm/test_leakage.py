import random

import numpy as np
import pytest

from tracelake.llm import leakage as L


@pytest.mark.parametrize("seed", range(6))
def test_fm_index_finds_every_place(seed):
    r = np.random.default_rng(seed)
    text = np.concatenate([r.integers(0, 5 if seed < 5 else 900, 800), np.tile(r.integers(1, 4, 7), 20), [0]]).astype(np.int64)
    index = L.FmIndex(text, sample=5)
    grams = np.lib.stride_tricks.sliding_window_view(text, 3)
    phrases = np.concatenate([np.unique(grams, axis=0), [[7, 7, 7], [4, 4, 2000]]])
    low, high = index.search(phrases)
    for p, a, b in zip(phrases, low, high):
        assert sorted(index.locate(np.arange(a, b))) == np.flatnonzero((grams == p).all(axis=1)).tolist()


def test_words():
    assert L.words("Ｆｕｌｌ &amp;amp; Wi​dth <b>bold</b>er<br>next\\nline_a 19.2 [x](http://y.z)") == ["full", "width", "bolder", "next", "line", "a", "19", "2", "x"]
    assert L.words("") == []


@pytest.mark.parametrize("text", ["Ｆｕｌｌ &amp;amp; Wi​dth <b>bold</b>er<br>next\\nline_a 19.2 [x](http://y.z)", "", "plain words, two", "Straße cafe\u0301 ①② ﬁne <!-- a --> &eacute;t&#233; 中文 字", "a&b;c &lt;b&gt; x\\u000ay", "ᄒ\u1161\u11ab 글"])
def test_places_are_those_of_the_words(text):
    at = L.word_places(text)
    assert len(at) == len(L.words(text)) and all(0 <= a < b <= len(text) for a, b in at) and at == sorted(at)
    if text.isascii() and not set("<&\\") & set(text):
        assert [text[a:b].lower() for a, b in at] == L.words(text)
    if "bold" in text:
        assert text[at[2][0] : at[2][1]] == "bold</b>er" and text[at[0][0] : at[0][1]] == "Ｆｕｌｌ"


def test_cut_documents_hold_no_passage(spark):
    r = random.Random(7)
    word = lambda: r.choice(["alpha", "Beta", "gamma,", "<b>del</b>ta", "&eacute;ta"]) if r.random() < 0.9 else f"w{r.randint(0, 30)}"
    items = [(k, " ".join(word() for _ in range(r.randint(0, 14)))) for k in range(30)]
    docs = [(k, " ".join(word() for _ in range(r.randint(0, 60)))) for k in range(60)]
    df = spark.createDataFrame(docs + docs[:3] + [(99, None)], "doc_id long, text string")
    found = L.leaked_spans(df, spark.createDataFrame(items, "item_id long, query string"), least=6)
    cut, spans = dict(docs), {}
    for x in L.removal_spans(df, found).collect():
        spans.setdefault(x.doc_id, []).append((x.start_char, x.end_char, x.n_words))
    assert {d for _, d in brute(docs, items, 6)} == set(spans)
    for d, own in spans.items():
        own.sort()
        assert all(b < c for (_, b, _), (c, _, _) in zip(own, own[1:]))
        assert [len(L.words(cut[d][a:b])) for a, b, _ in own] == [n for _, _, n in own]
        for a, b, _ in reversed(own):
            cut[d] = cut[d][:a] + " | " + cut[d][b:]
    grams = {tuple(w[k : k + 6]) for _, q in items for w in [L.words(q)] for k in range(len(w) - 5)}
    for text in cut.values():
        for part in text.split(" | "):
            w = L.words(part)
            assert not any(tuple(w[k : k + 6]) in grams for k in range(len(w) - 5))


def brute(docs, items, n):
    found = set()
    for i, q in items:
        w = L.words(q or "")
        grams = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for d, t in docs:
            v = L.words(t or "")
            if any(tuple(v[k : k + n]) in grams for k in range(len(v) - n + 1)):
                found.add((i, d))
    return found


@pytest.mark.parametrize("seed, shard, block", [(1, 1 << 21, 2_000_000), (2, 50, 2_000_000), (3, 1 << 21, 40)])
def test_equals_brute_force(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(L, "SHARD", shard)
    monkeypatch.setattr(L, "BLOCK_WORDS", block)
    r = random.Random(seed)
    word = lambda: r.choice(["alpha", "Beta", "gamma,", "delta"]) if r.random() < 0.9 else f"w{r.randint(0, 30)}"
    items = [(k, " ".join(word() for _ in range(r.randint(0, 14)))) for k in range(30)] + [(40, None), (41, "")]
    docs = [(k, " ".join(word() for _ in range(r.randint(0, 60)))) for k in range(60)] + [(70, None), (71, ""), (72, "long " * 50_000)]
    df = spark.createDataFrame(docs + docs[:3] + [(None, docs[0][1])], "doc_id long, text string").selectExpr("*", "1 as item_id", "'x' as query")
    spans = L.leaked_spans(df, spark.createDataFrame(items + items[:2], "item_id long, query string").selectExpr("*", "0 as doc_id"), least=6)
    rows = spans.collect()
    assert {(x.item_id, x.doc_id) for x in rows} == brute(docs, items, 6)
    text = dict(docs)
    for x in rows:
        query = dict(items)[x.item_id]
        assert L.words(text[x.doc_id])[x.doc_word : x.doc_word + x.n_words] == L.words(query)[x.item_word : x.item_word + x.n_words]
        assert x.n_words >= 6
    assert len(rows) == len(set(rows))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, query string")
    assert L.leaked_spans(docs, items).count() == 0
    assert L.leaked_spans(docs, spark.createDataFrame([(1, "a " * 20)], "item_id long, query string")).count() == 0
