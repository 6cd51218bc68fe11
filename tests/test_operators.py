import random

import pytest
from pyspark.sql import functions as F

from tracelake.operators import convert as C
from tracelake.operators import selection as S
from tracelake.operators import stats as K
from tracelake.operators import traces as R
from tracelake.operators.ordered import running_counts


@pytest.mark.parametrize("text", ["", "3", "-1", "2:5", "-3:", ":-2", "::2", "1:9:3", "-4:-1", "20:30", "5:2", "::-1", "8:2:-3", "-2::-4"])
def test_python_slice(spark, text):
    rows = list(range(10))
    df = spark.createDataFrame([(k,) for k in rows], "k long")
    expect = rows if text == "" else [rows[int(text)]] if ":" not in text else rows[slice(*(int(p) if p else None for p in text.split(":")))]
    expect = sorted(expect)
    text = text or ":"
    assert sorted(r.k for r in S.python_slice(df, text, "k").collect()) == expect


def test_slice_needs_a_step(spark):
    with pytest.raises(ValueError):
        S.python_slice(spark.range(3).toDF("k"), "::0", "k")


def test_gain_verdicts(spark):
    with_tool = [("a", 0.6, 1, True), ("b", None, 1, True), ("c", 0.5, 1, True), ("d", 0.9, 1, True), ("e", 0.1, 1, True), ("f", 0.8, 1, False), ("g", 0.8, 1, True), (None, 0.9, 1, True), ("h", 0.6, 1, None)]
    no_tool = [("a", 0.5), ("b", 0.1), ("d", 0.8), ("e", 0.0), ("f", 0.1), ("g", 0.1), ("h", 0.1)]
    out = S.gain_verdicts(spark.createDataFrame(with_tool, "item_id string, with_tool double, tool_calls int, has_trace boolean"), spark.createDataFrame(no_tool, "item_id string, no_tool double"), least_gain=0.1, most_no_tool=0.75, least_with_tool=0.25)
    # 0.6 - 0.5 is below 0.1 in doubles
    assert {r.item_id: r.verdict for r in out.collect()} == {"a": "below_gain", "b": "invalid_with_tool", "c": "missing_no_tool", "d": "above_most_no_tool", "e": "below_least_with_tool", "f": "missing_trace", "g": "keep", "h": "missing_trace"}


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), (None, 5, "n")], "k string, t int, v string")
    assert {(r.k, r.v) for r in S.last_per_key(df, ["k"], ["t"]).collect()} == {("a", "y"), ("b", "z"), (None, "n")}
    assert {(r.k, r.v) for r in S.first_per_key(df, ["k"], ["t"]).collect()} == {("a", "x"), ("b", "z"), (None, "n")}
    assert {(r.k, r.v) for r in S.one_per_key(df, ["k"], [F.col("t"), F.col("v")]).collect()} == {("a", "x"), ("b", "z"), (None, "n")}


def test_by_key_or_unambiguous_id(spark):
    results = spark.createDataFrame([("x_1", "1"), ("y_9", "2"), ("z_3", "3"), ("q", None)], "task_key string, item_id string")
    reference = spark.createDataFrame([("x_1", "1", "A"), ("x_2", "2", "B"), ("u_3", "3", "C"), ("v_3", "3", "D")], "task_key string, item_id string, answer string")
    got = {r.task_key: (r.matched_by, r.answer) for r in S.by_key_or_unambiguous_id(results, reference, ["answer"]).collect()}
    assert got == {"x_1": ("task_key", "A"), "y_9": ("item_id", "B"), "z_3": (None, None), "q": (None, None)}


def test_rejected_takes_the_first_rule(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, True), (3, False, False), (4, None, True)], "k int, a boolean, b boolean")
    stage, reason = S.rejected([("one", "ra", F.col("a")), ("two", "rb", F.col("b"))])
    rows = df.select("k", stage.alias("stage"), reason.alias("reason"))
    assert {r.k: (r.stage, r.reason) for r in rows.collect()} == {1: ("one", "ra"), 2: ("two", "rb"), 3: (None, None), 4: ("two", "rb")}
    assert {(r.stage, r.reason, r.n) for r in S.rejection_rollup(rows).collect()} == {("one", "ra", 1), ("two", "rb", 2), ("one", None, 1), ("two", None, 2), (None, None, 3)}


@pytest.mark.parametrize("n", [1, 2, 7, 500])
def test_percentiles(spark, n):
    import numpy as np

    r = random.Random(n)
    rows = [(g, float(r.choice([1, 2, 3.5, r.random()]))) for g in "ab" for _ in range(n)] + [("c", None)]
    got = {x.g: (x.low, x.mid) for x in K.percentiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", {"low": 0.025, "mid": 0.5}).collect()}
    for g in "ab":
        assert got[g] == pytest.approx(tuple(np.quantile([v for k, v in rows if k == g], [0.025, 0.5])))
    assert "c" not in got


def test_running_counts_over_ranges(spark):
    r = random.Random(1)
    rows = [("hot" if r.random() < 0.7 else f"g{r.randint(0, 9)}", k, r.randint(0, 3)) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, k long, v int").repartition(5)
    got = {x.k: (x.n, x.s) for x in running_counts(df, "g", [F.col("k")], {"n": F.lit(1), "s": F.col("v")}).collect()}
    seen = {}
    for g, k, v in rows:
        n, s = seen.get(g, (0, 0))
        seen[g] = (n + 1, s + v)
        assert got[k] == seen[g]


def test_bootstrap_interval_covers_and_repeats(spark):
    r = random.Random(2)
    rows = [("a", r.choice([0.0, 0.25, 0.5, 1.0])) for _ in range(400)] + [("b", 0.5)] * 50 + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {x.g: (x.low, x.high) for x in K.bootstrap_ci(df, ["g"], "v", 2000).collect()}
    values = [v for g, v in rows if g == "a" and v is not None]
    mean = sum(values) / len(values)
    assert got["a"][0] < mean < got["a"][1]
    assert got["b"] == (0.5, 0.5) and got[None] == (1.0, 1.0)
    assert {x.g: (x.low, x.high) for x in K.bootstrap_ci(df.repartition(3), ["g"], "v", 2000).collect()} == got
    levels = {x.level: (x.low, x.high) for x in K.stratified_bootstrap(df, "g", "v", 2000).collect()}
    assert set(levels) == {"micro", "macro"} and all(a < b for a, b in levels.values())


@pytest.mark.parametrize("n, ties", [(20, False), (200, False), (2000, True)])
def test_bootstrap_is_as_wide_as_resampling(spark, n, ties):
    import numpy as np

    r = np.random.default_rng(n)
    values = np.round(r.random(n), 1) if ties else r.random(n)
    drawn = np.quantile(values[r.integers(0, n, (20_000, n))].mean(axis=1), [0.025, 0.975])
    got = K.bootstrap_ci(spark.createDataFrame([(float(v),) for v in values], "v double"), [], "v").first()
    assert got.high - got.low == pytest.approx(drawn[1] - drawn[0], rel=0.03)


def test_votes(spark):
    df = spark.createDataFrame([([1, 1, 0],), ([1, 0],), ([None, 1],), ([],)], "v array<int>")
    assert [r[0] for r in df.coalesce(1).select(K.majority(F.col("v"))).collect()] == [True, False, True, False]
    df = spark.createDataFrame([([3.0, 1.0],), ([None, 2.0],), ([],), ([5.0, 1.0, 4.0],)], "v array<double>")
    assert [r[0] for r in df.coalesce(1).select(K.upper_median(F.col("v"))).collect()] == [3.0, 2.0, None, 4.0]
    assert spark.range(1).select(K.snapped(F.lit(0.125)), K.snapped(F.lit(0.9)), K.snapped(F.lit(None).cast("double"))).first()[:] == (0.0, 1.0, None)


EVENT = "event_id long, session_key string, role string, content string, tool_calls string, tool_call_id string, timestamp_iso string"


def rows(spark):
    call = '[{"id": "c1", "function": {"name": "crop", "arguments": "{\\"a\\": 1}"}}, {"id": "c2", "function": {"name": "exec", "arguments": {"b": 2}}}]'
    return R.events(
        spark.createDataFrame(
            [(1, "s", "user", "old", None, None, None), (2, "s", "User ", '[{"type": "image", "image": "x.png"}, {"type": "text", "text": "q"}]', None, None, None), (3, "s", "assistant", "hm", call, None, None), (4, "s", "tool", "[image viewed * 2] Saved to: /a/b.png", None, "c1", None), (5, "s", "tool", "saved to: /a/b.png saved to: /a/c.txt", None, "zz", None), (6, "s", "assistant", "done", None, None, None), (6, "s", "assistant", "done", None, None, None), (7, "t", "assistant", None, '{"id": "d", "name": "list_dir"}', None, None), (8, "t", "assistant", None, '[{"id": ', None, None)],
            EVENT,
        )
    )


def test_traces(spark):
    e = rows(spark)
    assert sorted(r.event_id for r in R.last_user_slice(e).collect()) == [2, 3, 4, 5, 6, 7, 8]
    made = R.calls(e)
    assert {(r.event_id, r.call_no, r.call_id, r.tool, r.arguments) for r in made.collect()} == {(3, 0, "c1", "crop", '{"a": 1}'), (3, 1, "c2", "exec", '{"b":2}'), (7, 0, "d", "list_dir", None)}
    assert {(r.result_id, r.call_event_id, r.tool) for r in R.call_results(e, made).collect()} == {(4, 3, "crop"), (5, None, None)}
    assert {(r.event_id) for r in R.history_window(e, 3).collect()} == {4, 5, 6, 7, 8}  # without a user message all stay
    assert {(r.event_id) for r in R.history_window(e, 5).collect()} == {2, 3, 4, 5, 6, 7, 8}
    told = spark.createDataFrame([("s", 2)], "session_key string, last_consolidated int")
    assert {(r.event_id) for r in R.history_window(e, 9, consolidated=told).collect()} == {3, 4, 5, 6, 7, 8}
    assert [r[0] for r in e.where("event_id = 5").select(R.saved_paths(F.col("content"))).collect()] == [["/a/b.png"]]
    assert {(r.event_id, r.observation_no) for r in R.numbered(e).collect()} == {(k, k) for k in range(1, 7)} | {(7, 1), (8, 2)}
    told = {r.tool: (r.n_calls, r.share, r.coverage) for r in R.tool_distribution(made).collect()}
    assert told["crop"] == (1, 0.333333, 0.5)


def test_sft_messages(spark):
    got = {r.session_key: [(m.role, m.content) for m in r.messages] for r in C.sft_messages(R.last_user_slice(rows(spark)), spark.createDataFrame([("s", "Sys")], "session_key string, prompt string")).collect()}
    assert [m[0] for m in got["s"]] == ["system", "user", "assistant", "tool_call", "tool_response", "tool_response", "assistant"]
    assert got["s"][1][1] == "<image>q" and got["s"][4][1].startswith("<image><image>[image")
    assert [m[0] for m in got["t"]] == ["tool_call", "tool_call"]


def test_text_conversion(spark):
    one = spark.range(1).select(
        C.prompt_text(F.lit("A \n\n---\n\nB")), C.prompt_text(F.lit('[{"type": "text", "text": "P"}]')), C.without_hint(F.lit("[Image file paths — use these in scripts]\n- /a\n- /b\n\nQ")), C.safe_name(F.lit(" a/b c ")), C.virtual_paths(F.lit("/h/x.png"), F.lit("/h")), R.truncated_text(F.lit("abcd"), 3), S.item_key(F.lit(None).cast("string"), F.lit(4))
    ).first()
    assert one[:] == ("A", "P", "Q", "a_b c", "/mnt/data/x.png", "abc\n... [truncated 1 chars]", "index:4")


def test_task_key(spark):
    one = spark.range(1).select(C.task_key(F.lit("a b/"), F.lit("7")), C.task_key(F.lit(None).cast("string"), F.lit("7")), C.task_key(F.lit("//"), F.lit("7"))).first()
    assert one[:] == ("a_b_7", "dataset_7", "dataset_7")


def test_chunks(spark):
    texts = ["", None, "short", "one two three four", "abcdefghijklmno", "line\nsecond line here", "  led by blanks", "ab \n\n  cd 0123456789"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = [r[1] for r in sorted(df.select("k", R.chunked(F.col("t"), 10)).collect())]
    assert got == [[], [], ["short"], ["one two", "three four"], ["abcdefghij", "klmno"], ["line", "second", "line here"], ["  led by", "blanks"], ["ab \n", "cd", "0123456789"]]
    long = spark.createDataFrame([("x" * 300_000,), ("word " * 60_000,)], "t string").select(R.chunked(F.col("t"))).collect()
    assert [len(r[0]) for r in long] == [150, 150] and max(map(len, long[1][0])) <= 2000


def test_sessions_are_judged_in_order(spark):
    event = lambda k, s, role, content=None, calls=None, call_id=None: (k, s, role, content, calls, call_id, None)
    call = lambda name, **a: __import__("json").dumps([{"id": "c", "function": {"name": name, "arguments": a}}])
    data = [
        event(1, "none", "user", "q"),
        event(2, "plain", "assistant", "a"), event(3, "noref", "assistant", "a", call("crop")),
        event(4, "wrong", "assistant", "no", call("crop")), event(5, "low", "assistant", "yes", call("list_dir")),
        event(6, "twice", "assistant", "yes", call("write_file", path="/mnt/data/a.py", content="plt.savefig('/mnt/data/o.png')")), event(7, "twice", "tool", "Saved to: /mnt/data/o.png", None, "c"), event(8, "twice", "assistant", "yes", call("crop")),
        event(9, "host", "assistant", "yes", call("crop", path="/home/u/x.png")), event(10, "fine", "assistant", "yes", call("crop", path="/mnt/data/x.png")),
        event(11, "click", "assistant", None, call("computer_use", action="type")), event(12, "point", "assistant", None, call("crop")), event(13, "point", "assistant", None, call("computer_use", coordinate="[17, 500]")),
    ]
    e = R.events(spark.createDataFrame(data, EVENT))
    made = R.calls(e)
    reference = spark.createDataFrame([(s, "yes") for s in ("none", "plain", "wrong", "low", "twice", "host", "fine", "click", "point")], "session_key string, reference string")
    facts = R.session_facts(e, made, reference)
    stage, reason = S.rejected(R.session_rules((F.col("answer") == F.col("reference")) | F.col("point").isNotNull()))
    got = {r.session_key: r.reason for r in facts.select("session_key", reason.alias("reason")).collect()}
    assert got == {"none": "no_response", "plain": "no_tool_calls", "noref": "no_ref_answer", "wrong": "answer_wrong", "low": "single_list_dir", "twice": "image_overwrite", "host": "host_path_hit", "fine": None, "click": "computer_use_no_coordinate", "point": None}
    assert {r.session_key: (r.point.x, r.point.y) for r in facts.where("point is not null").collect()} == {"point": (17.0, 500.0)}
    assert {r.session_key: r.is_last for r in R.terminator_last(made).where("has_tool").collect()} == {"click": True, "point": True}
    told = R.observations(e, made)
    assert [(r.session_key, r.tool, r.observation_no, r.images) for r in told.collect()] == [("twice", "crop", 1, [])]
    assert R.observation_blocks(told).first().block == "[tool_call #1] crop({})\n[tool_response #1]\nSaved to: /mnt/data/o.png"
    audit = R.prefix_audit(told, spark.createDataFrame([("twice", " o.png ")], "session_key string, reference string")).first()
    assert (audit.n_responses, audit.has_answer, audit.n_channel, audit.tool_counts) == (1, True, 0, {"crop": 1})


def test_summaries(spark):
    rows = spark.createDataFrame([("a", 1, False), ("a", 0, False), ("a", 1, True), ("b", None, True)], "g string, c int, gone boolean")
    assert {r.g: r[1:] for r in K.accuracy(rows, ["g"], F.col("c") == 1, F.col("gone")).collect()} == {"a": (1, 3, 1, 0.3333), "b": (0, 1, 1, 0.0)}
    assert {r.g: r[1:] for r in K.accuracy(rows, ["g"], F.col("c") == 1, F.col("gone"), False).collect()} == {"a": (1, 2, 1, 0.5), "b": (0, 0, 1, 0.0)}
    pages = spark.createDataFrame([("a", True, 90.0), ("a", True, 10.0), ("a", False, None)], "g string, p boolean, s double")
    assert K.html_summary(pages, ["g"], F.col("p"), F.col("s")).first()[:] == ("a", 3, 2, 2, 1, 50.0)
    metrics = spark.createDataFrame([(["b", "a", "c"],), (["a", "b"],)], "m array<string>")
    assert metrics.agg(K.shared_metrics(F.col("m"))).first()[0] == ["a", "b"]
    one = S.intersection_summary(spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "item_id string"), spark.createDataFrame([("1",), ("9",)], "item_id string")).first()
    assert one[:] == (4, 2, 1, 1)
    assert S.checked_conditions(["x"], ["x", "y"]) == ["x"]
    for bad in (["x", "x"], ["z"]):
        with pytest.raises(ValueError):
            S.checked_conditions(bad, ["x", "y"])
    source = spark.createDataFrame([("k", ["p", "q"])], "key string, predictions array<string>")
    take = lambda n: S.at_position(spark.createDataFrame([("k", n)], "key string, i int"), source, "key", "i", "predictions").first().source_value
    assert take(1) == "q"
    with pytest.raises(Exception, match="no element"):
        take(2)
    assert [r.n for r in S.by_count(spark.createDataFrame([("a", 1), ("b", 3)], "r string, n int"), ["r"]).collect()] == [3, 1]
    assert S.completed(spark.createDataFrame([("x",), ("",), (None,)], "error string")).count() == 2
    images = spark.range(1).select(S.device_references(F.array(F.lit("r/desktop.png"), F.lit("logo.png")), F.array(F.lit("/a"), F.lit("/b")))).first()[0]
    assert images == {"desktop": "/a"}
    pairs = S.device_pairs(spark.createDataFrame([("t", "d", 1.0), ("t", "m", 2.0)], "task string, device string, v double"), spark.createDataFrame([("t", "d", 3.0)], "task string, device string, v double"), "task", "device", "v")
    assert S.device_mean(pairs, "task", "device", F.col("made") - F.col("reference")).first()[:] == ("t", 2.0, 1)


def test_conversion_forms(spark):
    one = spark.range(1).select(C.assistant_text(F.lit("r"), F.lit("c")), C.assistant_text(F.lit(None).cast("string"), F.lit(None).cast("string")), C.response_text(F.lit("t"), F.array(F.lit("a"), F.lit("b"))), C.response_text(F.lit("t"), F.array(F.lit("a")), True), C.host_paths(F.lit("/mnt/data/x"), F.lit("/h")), C.chosen_tools(None, F.array(F.lit("b"), F.lit("z"), F.lit("a")), ["a", "b"]), C.chosen_tools(["a", "q"], F.array(), ["a", "b"]), C.chosen_tools(["all"], F.array(), ["a", "b"]), C.chosen_tools([], F.array(), ["a"])).first()
    assert one[:] == ("<think>r</think>c", "", "<image><image>t", "t<image>", "/h/x", ["b", "a"], ["a"], ["a", "b"], [])
    tools = spark.createDataFrame([("s", ["b", "no", "a"])], "session_key string, tools array<string>")
    assert C.tools_json(tools, spark.createDataFrame([("a", '{"n": 1}'), ("b", '{"n": 2}')], "tool string, schema string")).first().tools_json == '[{"n": 2}, {"n": 1}]'


def test_empty_tables(spark):
    e = R.events(spark.createDataFrame([], EVENT))
    assert R.calls(e).count() == R.history_window(e, 3).count() == R.numbered(e).count() == C.sft_messages(e).count() == 0
    assert K.percentiles(spark.createDataFrame([], "g string, v double"), "g", "v", {"m": 0.5}).count() == 0
