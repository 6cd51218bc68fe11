import random

import pytest

from tracelake.llm import shared_spans as S


def brute(texts, n=S.MIN_CHARS):
    windows = {}
    for k, t in texts:
        for i in range(len(t or "") - n + 1):
            windows.setdefault(t[i : i + n], set()).add(k)
    return {(a, b) for ks in windows.values() for a in ks for b in ks if a < b}


def made(seed):
    r = random.Random(seed)
    alphabets = ["abcdefgh ", "äöüß中文字符é ", "ab"]
    word = lambda n, a=0: "".join(r.choice(alphabets[a]) for _ in range(n))
    shared = [word(n, a) for n, a in ((299, 0), (300, 0), (301, 1), (299, 1), (900, 0), (500, 1))]
    rows = []
    for k in range(60):
        parts = [word(r.randint(0, 400), r.choice([0, 1]))]
        for s in r.sample(shared, r.randint(0, 2)):
            parts += [s, word(r.randint(0, 300), r.choice([0, 1]))]
        rows.append((k, "".join(parts)))
    return rows + [(70, None), (71, ""), (72, rows[3][1]), (73, rows[3][1]), (74, "x" * 700), (75, "x" * 650), (None, rows[0][1])]


@pytest.mark.parametrize("seed, fan, bits", [(1, 64, 28), (2, 64, 8), (3, 3, 28), (4, 3, 8)])
def test_pairs_equal_brute_force(spark, monkeypatch, seed, fan, bits):
    monkeypatch.setattr(S, "FAN", fan)
    monkeypatch.setattr(S, "MAX_BITS", bits)  # below 16 no sketch is sent
    rows = made(seed)
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string").selectExpr("*", "1 as entity", "2 as hash")
    found = [tuple(x) for x in S.shared_pairs(df).collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute([x for x in rows if x[0] is not None])


@pytest.mark.parametrize("fan", [64, 2])
def test_shares_cover_the_shared_characters(spark, monkeypatch, fan):
    monkeypatch.setattr(S, "FAN", fan)
    rows = [x for x in made(4) if x[0] is not None]
    seen = {}
    for k, t in rows:
        for i in range(len(t or "") - 299):
            seen.setdefault(t[i : i + 300], []).append((k, i))
    expect = {}
    for at in seen.values():
        if len({k for k, _ in at}) > 1:
            for k, i in at:
                expect.setdefault(k, set()).update(range(i, i + 300))
    got = {x.doc_id: x.shared_chars for x in S.shared_shares(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # within a text of one repeated character only a part of the places is looked at
    assert {k: n for k, n in got.items() if k < 74} == {k: len(v) for k, v in expect.items() if k < 74}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.shared_pairs(df).count() == 0
    assert S.shared_shares(df).count() == 0


def test_very_long_text(spark):
    r = random.Random(9)
    long = "".join(r.choice("abcdefghij ") for _ in range(1_300_000))
    rows = [(1, long), (2, "q" + long[524_200:524_500] + "z" * 10), (3, long[1_299_000:]), (4, "nothing " * 30)]
    found = {tuple(x) for x in S.shared_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(1, 2), (1, 3)}


@pytest.mark.parametrize("fan", [64, 2])
def test_shares_count_every_place_of_a_stretch(spark, monkeypatch, fan):
    monkeypatch.setattr(S, "FAN", fan)
    r = random.Random(7)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    header = word(320)
    # other characters around it in each text
    rows = [(k, (own := "klmnop"[k] * 50) + header + own + header + own) for k in range(6)] + [(74, "x" * 700), (75, "x" * 650)]
    got = {x.doc_id: x.shared_chars for x in S.shared_shares(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{k: 640 for k in range(6)}, 74: 700, 75: 650}


@pytest.mark.parametrize("unit", ["-", " ", "ab", "0123456789" * 40])
def test_pairs_of_periodic_text(spark, monkeypatch, unit):
    monkeypatch.setattr(S, "FAN", 3)
    r = random.Random(11)
    word = lambda n: "".join(r.choice("mnopqrs") for _ in range(n))
    run = (unit * 900)[:900] if len(unit) > 2 else (unit * 400)[:400]
    rows = [(k, word(150) + run + word(150)) for k in range(5)]
    found = {tuple(x) for x in S.shared_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute(rows) == {(a, b) for a in range(5) for b in range(a + 1, 5)}


@pytest.mark.parametrize("fan", [64, 2])
def test_links_are_the_different_texts_that_share(spark, monkeypatch, fan):
    monkeypatch.setattr(S, "FAN", fan)
    rows = [x for x in made(6) if x[0] is not None]
    by = {}
    for a, b in brute([(t, t) for t in {t for _, t in rows if t}]):
        by.setdefault(a, set()).add(b)
        by.setdefault(b, set()).add(a)
    got = {x.doc_id: x.n_links for x in S.shared_shares(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: len(by.get(t, ())) for k, t in rows if k in got} and all(t not in by or k in got for k, t in rows)


def test_few_windows_pass_at_any_width(spark, monkeypatch):
    r = random.Random(12)
    rows = [(k, "".join(r.choice("abcdefghij ") for _ in range(4000))) for k in range(300)]
    rows += [(1000 + k, t[1000:2000]) for k, t in rows[:5]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for bits in (28, 8):  # with the sketch, and at a hundredth of the need and less without one
        monkeypatch.setattr(S, "MAX_BITS", bits)
        assert S.candidates(df, "doc_id", "text").count() <= 0.05 * 300 * 4000 * 2 / S.SPREAD
        assert {tuple(x) for x in S.shared_pairs(df).collect()} == {(k, 1000 + k) for k in range(5)}


def test_pairs_where_a_join_is_read_in_parts(spark):
    """The partitions of a join that turns out to be sent, or is split for its size, hold only a part of the rows of a window."""
    r = random.Random(13)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared = [word(400) for _ in range(40)]
    rows = [(k, word(200) + shared[k % 40] + word(200)) for k in range(240)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = {tuple(x) for x in S.shared_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert found == {(a, b) for a in range(240) for b in range(a + 1, 240) if a % 40 == b % 40}
