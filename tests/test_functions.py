import pandas as pd
import pytest
from pyspark.sql import functions as F

from tracelake.functions import answers as A
from tracelake.functions import geometry as G
from tracelake.functions import text as X
from tracelake.functions import web as H


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_try_float(spark):
    rows = {"12.5%": 12.5, "1_000": 1000.0, "1d": None, "-3e2": -300.0, " 5 ": 5.0, "yes": None, "": None, ".5": 0.5, "5.": 5.0, "0x1": None, "1__0": None, "7%%": 7.0, "inf": float("inf"), "é5": None}
    assert values(spark, [(k,) for k in rows], "a string", A.try_float(F.col("a"))) == list(rows.values())


def test_normalized_answer(spark):
    rows = {" 12.0 ": "12", "5%": "5", "12.5%": "12.5", "YES": "yes", "1e3": "1000.0", "0": "0", "-3.00": "-3", "inf": "inf", None: None, "a12": "a12", "+0012345678.50": "12345678.5", ".25": "0.25"}
    assert values(spark, [(k,) for k in rows], "a string", A.normalized_answer(F.col("a"))) == list(rows.values())


def test_numbers(spark):
    rows = ["a12 and -3.5% or 7e2", "no", "x=1,y=2", None]
    assert values(spark, [(k,) for k in rows], "a string", A.numbers(F.col("a"))) == [[2.0, -3.5, 700.0], [], [1.0, 2.0], None]


def test_boxed():
    f = A.boxed.func
    assert f(pd.Series([r"\boxed{a{b}c} and \boxed{ 5 } \boxed{open", "none", None, r"boxed{1}", r"\\boxed{2}"])).tolist() == [["a{b}c", "5"], [], None, [], ["2"]]


CASES = [
    (r"\boxed{12}", "12.0", 0.0, "boxed"),
    (r"\boxed{0.0}", "0", 0.0, "boxed"),
    (r"\boxed{0.00%}", "0e0", 0.0, "boxed_zero"),
    (r"\boxed{101}", "100", 0.02, "boxed_approx"),
    ("so **12%**", "12", 0.0, "bold"),
    ("so **about 0 units**", "0.0e0", 0.0, "bold_zero"),
    ("so **about 101 units**", "100", 0.02, "bold_approx"),
    ("the answer is 3", "3", 0.0, "literal_contextual"),
    ("there are 3", "3", 0.0, "none"),
    ("it reads Foo Bar here", "foo bar", 0.0, "literal"),
    ("it reads Foobar here", "foo", 0.0, "none"),
    ("we saw 12 of them", "12.0", 0.0, "literal_norm"),
    ("The result was -0 there.", "0e5", 0.0, "numeric_zero"),
    ("it was -0 there", "0e5", 0.0, "numeric_zero_fallback"),
    ("The result was 101 of 7.", "100", 0.02, "numeric_approx"),
    ("it was 101 of 7", "100", 0.02, "numeric_approx_fallback"),
    ("it was 102 of 7", "100", 0.02, "none"),
    ("", "5", 0.0, "none"),
    ("(a+b)", "(a+b)", 0.0, "literal"),
]


def test_match_method(spark):
    for tolerance in {t for _, _, t, _ in CASES}:
        rows = [(k, p, r) for k, (p, r, t, _) in enumerate(CASES) if t == tolerance]
        df = spark.createDataFrame([(*x, 1) for x in rows], "k int, p string, r string, boxes int")
        got = A.with_method(df, "p", "r", tolerance)
        assert got.columns == ["k", "p", "r", "boxes", "method"]
        assert {x.k: x.method for x in got.collect()} == {k: CASES[k][3] for k, _, _ in rows}


def test_match_method_of_null(spark):
    df = spark.createDataFrame([(None, "1"), ("1", None)], "p string, r string")
    assert [r.method for r in A.with_method(df, "p", "r").collect()] == [None, None]


def test_yes_no(spark):
    rows = {"YES.": True, "no, because": False, "I think\nso yes": True, "yes\nfirst no then yes": True, "maybe": None, "x\nyes or no": None, "": None, None: None}
    assert values(spark, [(k,) for k in rows], "a string", A.yes_no(F.col("a"))) == list(rows.values())


def test_instant(spark):
    rows = ["2026-01-05T00:00:01", "2026-01-05 00:00:01.5", "2026-01-05T02:00:01+02:00", "2026-01-04T19:00:01.000001-05:00", "2026-01-05T00:00:01Z", "2026-01-05t00:00:01,25z", "2026-01-05T02:00:01+0200", "nope", "", None, "2026-01-05"]
    base = 1767571200_000_000
    assert values(spark, [(k,) for k in rows], "a string", X.instant(F.col("a"))) == [base + x if x is not None else None for x in (1_000_000, 1_500_000, 1_000_000, 1_000_001, 1_000_000, 1_250_000, 1_000_000, None, None, None, 0)]


def test_parse_reference_and_points():
    assert G.parse_reference("[3, 4]", 2) == [3.0, 4.0]
    assert G.parse_reference("{'point': [1, '2%']}", 2) == [1.0, 2.0]
    assert G.parse_reference("{'x': 1, 'y': 2}", 2) == [1.0, 2.0]
    assert G.parse_reference("at (0.5, 0.25)", 2) == [0.5, 0.25]
    assert G.parse_reference("x: 5 then y = 6", 2) == [5.0, 6.0]
    assert G.parse_reference("left: 1 top: 2 right: 3 bottom: 4", 4) == [1.0, 2.0, 3.0, 4.0]
    assert G.parse_reference("[True, 1]", 2) is None and G.parse_reference(None, 4) is None and G.parse_reference("[1, 2", 2) is None
    assert G.response_points("pyautogui.click(x=3, y=4) and [3, 4] and (5, 6)") == [[3.0, 4.0], [5.0, 6.0]]
    assert G.response_points("x: 1" + " " * 76 + "y: 2") == [[1.0, 2.0]]
    assert G.response_points("x: 1" + " " * 77 + "y: 2") == []
    assert G.response_points(None) == []


def test_geometry_columns(spark):
    one = spark.range(1)
    point = lambda x, y: F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
    box = G.box(*(F.lit(v) for v in (0.5, 0.9, 0.1, 0.2)))
    got = one.select(G.point_in_box(point(0.5, 0.2), box), G.point_in_box(point(0.51, 0.2), box), G.point_close(point(0.1, 0.1), point(0.12, 0.1), 0.02 + 1e-12), G.smart_resize(F.lit(1000.0), F.lit(1414.0)), G.smart_resize(F.lit(10.0), F.lit(10.0)), G.last_click(F.lit("x=1,y=2 <answer>pyautogui.click(x=3, y=4)</answer>")), G.last_click(F.lit("(5, 6) [7, 8]")), G.last_click(F.lit("none")), G.bbox_of(F.lit("[1, 2, 3]")), G.unit_reference(F.lit(50.0), F.lit(10.0), F.lit(100), F.lit(20))).first()
    assert got[0] and not got[1] and got[2]
    assert tuple(got[3]) == (1008, 1400) and tuple(got[4]) == (56, 56)
    assert tuple(got[5]) == (3.0, 4.0) and tuple(got[6]) == (7.0, 8.0) and got[7] is None and got[8] is None
    assert tuple(got[9]) == (0.5, 0.5)


def test_tool_call_block():
    got = G.tool_call_block.func(pd.Series(['<tool_call>{"name": "f", "arguments": {"a": 1}}</tool_call>', "<tool_call><function=g><parameter=x>5</parameter></function></tool_call>", None, "none"]))
    assert got.name.tolist() == ["f", "g", None, None] and got.arguments.tolist()[:2] == ['{"a": 1}', '{"x": "5"}']


def test_html(spark):
    page = "<!doctype html><html><head><style>a{b:c}</style></head><body><div><p>Hello World</p><p>more &amp; text</p></div></body></html>"
    rows = [(f"<think>x</think>```html\n{page}\n```", page), ("see <div>a</div>", page), ("", page), ("plain", page), (None, page)]
    df = spark.createDataFrame(rows, "p string, r string").withColumn("h", H.extracted(F.col("p"))).withColumns({"a": H.html_stats("h"), "b": H.html_stats("r")})
    got = df.select("h", H.rule_check(F.col("h"), F.col("a"), F.col("b")).alias("c")).collect()
    assert got[0].h == page and got[0].c.passed and got[0].c.text_recall == 1.0
    assert got[1].h == "<div>a</div>" and got[1].c.errors == ["too_few_dom_nodes", "dom_too_small", "low_reference_text_coverage", "missing_css"]
    assert got[2].c.errors == got[4].c.errors == ["empty_prediction"] and got[3].c.errors == ["no_html_tags"]
    one = spark.range(1).select(H.score_in(F.lit("score: 87/100")), H.score_in(F.lit("101 or 55.5.")), H.score_in(F.lit("none")), H.viewport(F.lit("1280x720")), H.viewport(F.lit("1280,720")), H.viewport(F.lit("big")), H.with_base(F.lit("<html><head><title>"), "/a"), H.longest_fenced(F.lit("```a<b>```\n```\n<ccc>\n```\n```<ddd>```"))).first()
    assert one[0] == 87.0 and one[1] == 55.5 and one[2] is None and tuple(one[3]) == tuple(one[4]) == (1280, 720) and one[5] is None
    assert one[6] == '<html><head><base href="/a"><title>' and one[7] == "<ccc>"


def test_grounding(spark):
    from tracelake.functions import geometry as G

    texts = ["[1, 2]", "[[3, 4]]", "17, 500", "[5]", "x 1 y 2 z 3", "", None, '["6", "7.5"]', "[1, 2, 3]"]
    got = [r[0] and (r[0].x, r[0].y) for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(G.coordinate(F.col("t"))).collect()]
    assert got == [(1, 2), (3, 4), (17, 500), None, None, None, None, (6, 7.5), None]
    block = "<tool_call><function=computer_use><parameter=action>click</parameter><parameter=coordinate>[{}, 20]</parameter></function></tool_call>"
    answers = [block.format(1) + block.format(10) + "<tool_call><function=computer_use></function></tool_call>", 'so "coordinate": [5, 6]', "none"]
    df = spark.createDataFrame([(t,) for t in answers], "t string").coalesce(1)
    none = F.lit(None).cast("struct<x: double, y: double>")
    assert [r[0] and tuple(r[0]) for r in df.select(G.click_point(none, F.col("t"))).collect()] == [(10, 20, "hermes_text"), (5, 6, "pred_text"), None]
    point = F.struct(F.lit(500.0).alias("x"), F.lit(1000.0).alias("y"))
    click, held = G.click_point(point, F.lit("")), G.bbox_of(F.lit("[100, 50, 20, 10]"))
    one = spark.range(1).select(G.grounding_score(click, held, F.lit(100.0), F.lit(50.0)), G.grounding_score(click, G.bbox_of(F.lit("x")), F.lit(100.0), F.lit(50.0)), G.pixel_score(F.struct(F.lit(0.5).alias("x"), F.lit(0.5).alias("y")), held, F.lit(100.0), F.lit(50.0)), G.pixel_score(F.struct(F.lit(30.0).alias("x"), F.lit(30.0).alias("y")), held, F.lit(56.0), F.lit(28.0))).first()
    assert tuple(one[0]) == (1, 50.0, 50.0, "tool_calls") and tuple(one[1]) == (0, None, None, "tool_calls") and tuple(one[2]) == (1, 50.0, 25.0) and one[3].score == 1
