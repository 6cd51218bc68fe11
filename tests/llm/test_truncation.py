import random

import pytest

from tracelake.llm import endings as E
from tracelake.llm import truncation as T
from tracelake.llm.endings import COMPLETE, CUT, OPEN, structure
from tracelake.llm.sketch import chooser

WORDS = "the value label chart reads second line under after tool returned points around number region center border table shows axis moved slowly image cropped result".split()


def sentence(r):
    return (" ".join(r.choice(WORDS) for _ in range(r.randint(5, 14)))).capitalize() + r.choice([".", ".", "!", "?"])


@pytest.mark.parametrize(
    "text, state",
    [("<think>abc", CUT), ("<think>abc</think>done.", COMPLETE), ('{"a": [1, {"b": 2}', CUT), ('{"a": 1}', COMPLETE), ("```python\nx = 1", CUT), ("```python\nx = 1\n```", COMPLETE), ("<!doctype html>\n<html><body><p>a</p>", CUT), ("<html><body><p>a<br>b</p></body></html>", COMPLETE), ("abc\n... (truncated)", CUT), ("abc…[+571 chars]", CUT), ("half of the wor�", CUT), ("\\boxed{12", CUT), ("\\boxed{12}", OPEN), ("saved to: /mnt/data/a_b.png", COMPLETE), ("exit 0\n1 2 3.5", COMPLETE), ("", COMPLETE), (" \n", COMPLETE), ("**", COMPLETE), ("Fine.", COMPLETE), ("没有问题。", COMPLETE), ("12.5%", COMPLETE), ("Zalmo", COMPLETE), ("and then the", OPEN), ("[0.1, 0.2]", COMPLETE), ("[0.1, 0.", CUT), ("[20:01:02] crop done.", COMPLETE)],
)
def test_structure(text, state):
    assert structure(text)[0] == state


def made(seed):
    r, rows, true = random.Random(seed), [], set()
    for k in range(900):
        kind = r.random()
        if kind < 0.5:
            text = " ".join(sentence(r) for _ in range(r.randint(1, 6)))
        elif kind < 0.65:
            text = f"the {r.choice(WORDS)} number, {r.randint(1, 999)}"
        elif kind < 0.8:
            text = "\n".join(f"- {r.choice(WORDS)}: {r.randint(1, 99)}" for _ in range(3))
        else:
            text = '{"a": [' + ", ".join(str(r.randint(1, 99)) for _ in range(9)) + "]}"
        if r.random() < 0.1 and (kind < 0.5 or kind >= 0.8):
            end = r.randint(len(text) // 2, len(text) - 2)
            if text[:end].rstrip()[-1:] not in ".!?":
                text = text[:end]
                true.add(str(k))
        rows.append(("t", str(k), text))
    return rows, true


@pytest.mark.parametrize("seed", [1, 2])
def test_held_out_cuts_are_found(spark, seed):
    rows, true = made(seed)
    df = spark.createDataFrame(rows + [("t", "null", None), ("t", "blank", " "), ("t", "long", "word. " * 50_000)], "source_table string, record_id string, text string").selectExpr("*", "1 as state", "'x' as cut")
    found = [x.record_id for x in T.truncated(df).collect()]
    assert len(found) == len(set(found))
    assert len(set(found) & true) >= 0.93 * len(true)
    assert len(set(found) - true) <= 0.05 * len(found)


def copies(spark, texts):
    """The texts that are cut-off near-copies of another one."""
    rows = E.versions(spark.createDataFrame([(x,) for x in texts], "text string"), "text")
    return {x.text for x in T.cut_copies(rows, E.tails(rows)).join(rows, "version").collect()}


def test_cut_copies(spark):
    r = random.Random(5)
    whole = " ".join(sentence(r) for _ in range(12))
    words = whole.split()
    at = next(i for i in range(len(words) - 4, 0, -1) if not words[i - 1].endswith((".", "!", "?")) and not words[i].endswith((".", "!", "?")))
    part = " ".join(words[:at])
    stop = whole.rindex(".", 0, len(whole) - 2) if "." in whole[:-2] else len(whole)
    rows = [whole, part, part + " " + words[at][:2], whole[: stop + 1], " ".join(sentence(r) for _ in range(12)), "a b c", None, whole + "\nAnd a line more."]
    assert copies(spark, rows) == {part, part + " " + words[at][:2]}


def planted(seed, n=300):
    """Sources, and copies of them that were cut behind 10 to 90 % of their length; half of the copies differ in some words."""
    r = random.Random(seed)
    sources, cuts = [], []
    for k in range(n):
        # words with a number are unlike any other text's
        words = " ".join(" ".join(r.choice(WORDS) + (str(r.randint(0, 99)) if r.random() < 0.5 else "") for _ in range(r.randint(6, 14))).capitalize() + "." for _ in range(r.randint(4, 12))).split(" ")
        sources.append(" ".join(words))
        at = max(8, int(len(words) * r.uniform(0.1, 0.9)))
        part = words[:at]
        if k % 2 and at >= 36:  # so that they are similar enough
            for i in range(2, at - 6, 40):
                part[i] = "changed"
        last = part[-1].rstrip(".")
        part[-1] = last[: r.randint(2, len(last))] if len(last) > 2 else last
        cuts.append(" ".join(part))
    return sources, cuts


@pytest.mark.parametrize("most", [T.MAX_BITS, 0])
def test_planted_copies_are_found(spark, monkeypatch, most):
    monkeypatch.setattr(T, "MAX_BITS", most)  # 0: no map is sent, joins choose
    sources, cuts = planted(21)
    found = copies(spark, sources + cuts)
    assert len(found & set(cuts)) >= 0.98 * len(set(cuts)) and found <= set(cuts)


def test_hot_family_meets_in_few_pairs(spark):
    r = random.Random(22)
    words = [r.choice(WORDS) for _ in range(60)]
    full = [" ".join([*words[:20], f"run{k}", *words[20:]]) + "." for k in range(400)]
    cut = [" ".join([*words[:20], f"run{k + 1000}", *words[20:50], words[50][:2]]) for k in range(400)]
    assert copies(spark, full + cut) == set(cut)


def test_empty_table(spark):
    assert T.truncated(spark.createDataFrame([], "source_table string, record_id string, text string")).count() == 0


def test_cut_copies_meet_every_longer_text(spark):
    r = random.Random(8)
    rows, expect = [], set()
    for family in range(4):
        words = [r.choice(WORDS) + str(r.randint(0, 50)) for _ in range(80)]
        whole = " ".join(words) + "."
        part = " ".join(words[:70])
        # longer texts with most of the words that go on differently at the cut: one of them tops each band
        rows += [" ".join([*words[:69], *(f"other{family}x{k}y{i}" for i in range(13))]) + "." for k in range(60)]
        rows += [whole, part]
        expect.add(part)
    assert copies(spark, rows) == expect


@pytest.mark.parametrize("copies", [1, 40])
def test_copies_of_a_cut_text_do_not_vouch_for_its_end(spark, copies):
    r = random.Random(3)
    whole = [" ".join(sentence(r) for _ in range(3)) for _ in range(400)]
    cut = "The value label chart reads second line under after tool returned the"
    whole += [f"{sentence(r)} They returned the {r.choice(WORDS[1:])} again." for _ in range(200)]
    rows = [("t", str(k), x) for k, x in enumerate(whole)] + [("t", f"cut {k}", cut) for k in range(copies)]
    df = spark.createDataFrame(rows, "source_table string, record_id string, text string")
    assert {x.record_id for x in T.truncated(df).collect()} == {f"cut {k}" for k in range(copies)}


def test_letter_counts_do_not_depend_on_partitions(spark):
    r = random.Random(4)
    rows = [(" ".join(r.choice(WORDS) for _ in range(20)) + " image.",) for _ in range(200)]
    df = spark.createDataFrame(rows, "text string")
    keys = E.tail_keys(["under the ima", "the tabl", "x center"])
    wanted = chooser(spark.createDataFrame([(int(k),) for k in set(keys.ravel().tolist()) - {0}], "context long"))
    one, many = ({(x.context, x.n, x.n_end) for x in E.context_counts(df.repartition(n), "text", wanted).collect()} for n in (1, 12))
    assert one == many
    words = [w for t, in rows for w in t[:-1].split()]
    by = {k: (n, e) for k, n, e in one}
    assert by[keys[0, E.ORDERS + E.LETTERS - 2]] == (sum(w.startswith("ima") for w in words), 0)
    assert by[keys[0, -1]] == (sum(a == "the" and b.startswith("ima") for t, in rows for a, b in zip(t.split(), t.split()[1:])), 0)


@pytest.mark.parametrize(
    "end, more",
    [("the ratio rose to about 3.", "5 in the end of it."), ("some of the marks, e.g.", " the red one, are small."), ("saved to /mnt/data/a.b", "_second.png in that run."), ("and these are the numbers of it\n12 14 15", " 17 19 and some more.")],
)
def test_alignment_overrules_the_guess(spark, end, more):
    r = random.Random(12)
    head = " ".join(sentence(r) for _ in range(12)) + " "
    rows = [("t", "cut", head + end), ("t", "whole", head + end + more)]
    df = spark.createDataFrame(rows, "source_table string, record_id string, text string")
    assert structure(rows[0][2])[0] == COMPLETE
    assert [(x.record_id, x.by) for x in T.truncated(df).collect()] == [("cut", "copy")]


def test_cut_copies_of_chinese_texts(spark):
    r = random.Random(13)
    head = "".join(r.choice("图表的数值在整个时期从升到大多项目位于页面第二行下面工具为该标签返回了点") for _ in range(60))
    rows = [(head + "然后读者看到了",), (head + "然后读者看到了红色的线。",), (head + "。",), (head + "。然后没有了。",)]
    assert copies(spark, [x for x, in rows]) == {rows[0][0]}


def test_a_part_of_a_word_at_which_many_are_cut_is_no_end(spark):
    r = random.Random(31)
    some = lambda: " ".join(r.choice(WORDS) for _ in range(r.randint(4, 9)))
    whole = [f"{some()} the marker {some()}." for _ in range(2000)] + [f"{some()} on a mark {some()}." for _ in range(80)] + [f"{some()} outside the box" for _ in range(200)] + [f"the box plot {some()}." for _ in range(40)]
    cut = [f"{some()} the mark" for _ in range(60)]
    df = spark.createDataFrame([("t", str(k), x) for k, x in enumerate(whole + cut)], "source_table string, record_id string, text string")
    found = {int(x.record_id) for x in T.truncated(df).collect()}
    assert found == set(range(len(whole), len(whole) + len(cut)))
