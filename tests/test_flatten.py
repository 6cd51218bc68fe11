import json
import random

import pyarrow as pa
import pytest

from tracelake.operators import flatten as N


def walk(value, path, out, element=False, first=False, above=None):
    """Adds the path of each object that is an array element, with that of the nearest one above."""
    if isinstance(value, str):
        try:
            inner = json.loads(value)
        except ValueError:
            return
        if isinstance(inner, (dict, list, str)):
            walk(inner, path, out, element, first, above)
    elif isinstance(value, dict):
        if first:
            path += "[0]"
        if element or first:
            out[path] = above
            above = path
        for k, v in value.items():
            walk(v, f"{path}.{k}", out, above=above)
    elif isinstance(value, (list, tuple)):
        for i, v in enumerate(value):
            walk(v, f"{path}[{i}]", out, True, above=above)


def random_json(r, depth=0):
    x = r.random()
    if depth > 4 or x < 0.3:
        return r.choice([1, -2.5, 1e9, True, None, "", "a", 'q"\\x', "ü中\n", "[", "{}", "[1]", '["x"]', " { } ", "\\", '"', "12"])
    if x < 0.5:
        return json.dumps(random_json(r, depth + 1), indent=r.choice([None, 1]), ensure_ascii=r.random() < 0.5)
    if x < 0.75:
        return [random_json(r, depth + 1) for _ in range(r.randint(0, 4))]
    return {r.choice(["a", "b", "k y", "ü", "x\"y", "d"]): random_json(r, depth + 1) for _ in range(r.randint(0, 4))}


def texts(seed, n=400):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        t = json.dumps(random_json(r), indent=r.choice([None, None, 2]), ensure_ascii=r.random() < 0.5)
        if r.random() < 0.3 and t:
            k = r.randrange(len(t))
            t = r.choice([t[:k], t[:k] + t[k + 1 :], t[:k] + r.choice('{}[],:"\\ \t1a') + t[k:], t[:k] + r.choice('{}[],:"') + t[k + 1 :]])
        out.append(t)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_readable_texts_are_those_that_json_reads(seed):
    rows = texts(seed) + ["", " ", "NaN", "01", "[1,]", "[,1]", "{\"a\"}", '{"a":}', '{"a" "b"}', "[1 2]", "{1:2}", "[}", "[1]]", "][", '"\\u12g4"', '"\\q"', '"a\tb"', "tru", "1.", "-", "[\x0b1]", "{},{}", '{"a":1 "b":2}', "[\"a\" : 1]"]
    expect = []
    for t in rows:
        try:
            json.loads(t, parse_constant=lambda _: 1 / 0)
            expect.append(True)
        except (ValueError, ZeroDivisionError):
            expect.append(False)
    got = N.tokens(pa.array(rows)).readable.tolist()
    assert [t for t, a, b in zip(rows, got, expect) if a != b] == []


@pytest.mark.parametrize("seed", range(4))
def test_json_text_equals_walk(spark, seed):
    rows = list(enumerate(texts(seed + 100))) + [(1000, None), (1001, ""), (1002, "[" * 400 + "]" * 400), (1003, '[{"a":"' + "x" * 200_000 + '"}]'), (1004, '["\\ud83d", {"\\ud83d": [{}]}]'), (None, "[{}]")]
    df = spark.createDataFrame(rows + rows[:9], "root_id long, tool_calls string").selectExpr("*", "1 as node_path", "2 as key")
    got = {(x.root_id, x.node_path): x.parent_path for x in N.nodes(df, "root_id", "tool_calls", True).collect()}
    expect, plain = {}, lambda p: p and p.encode("utf-8", "replace").decode()
    for k, t in rows:
        out = {}
        walk(t, "tool_calls", out, first=True)
        expect |= {(str(k), plain(p)): plain(above) for p, above in out.items() if k is not None}
    assert got == expect
    told = N.nodes(df.where("tool_calls is not null"), "root_id", "tool_calls", True, True).collect()
    assert {(x.root_id, x.node_path) for x in told} == set(got)
    for x in told:
        assert isinstance(json.loads(x.value), dict) and x.place == int(x.node_path.rpartition("[")[2][:-1])


def test_nested_columns_equal_walk(spark):
    r = random.Random(5)
    some = lambda make: r.choice([None, [], [make() for _ in range(3)], [make(), None]])
    result = lambda: {"id": "c", "args": r.choice([None, "{}", "{", '{"b": [{"x": [1, {}]}]}', '"[{}]"', "[{}]"])}
    turn = lambda: {"step": 1, "results": some(result)}
    sample = lambda: {"pred": r.choice(["a", None, "[{}, 1]"]), "turns": some(turn), "tags": some(lambda: r.choice(["x", "{}", '{"q": [{}]}']))}
    rows = [(k, some(sample)) for k in range(200)]
    schema = "k long, samples array<struct<pred: string, turns: array<struct<step: int, results: array<struct<id: string, args: string>>>>, tags: array<string>>>"
    got = {(x.root_id, x.node_path): x.parent_path for x in N.nodes(spark.createDataFrame(rows, schema), "k", "samples").collect()}
    expect = {}
    for k, v in rows:
        out = {}
        walk(v, "samples", out)
        expect |= {(str(k), p): above for p, above in out.items()}
    assert got == expect


def test_child_table(spark):
    rows = [(1, [{"a": 5, "t": [{"b": "x"}, None, {"b": "y"}]}, {"a": None, "t": None}, None]), (2, None), (3, []), (1, [{"a": 5, "t": [{"b": "x"}, None, {"b": "y"}]}, {"a": None, "t": None}, None])]
    df = spark.createDataFrame(rows, "k long, s array<struct<a: int, t: array<struct<b: string>>>>")
    assert sorted(map(tuple, N.child_table(df, "k", "s").collect())) == [("1", "s[0]", None, 0, 5), ("1", "s[1]", None, 1, None)]
    assert sorted(map(tuple, N.child_table(df, "k", "s.t").collect())) == [("1", "s[0].t[0]", "s[0]", 0, "x"), ("1", "s[0].t[2]", "s[0]", 2, "y")]


def test_call_table(spark):
    rows = [(1, '[{"id": "a", "function": {"name": "f", "arguments": "{\\"x\\": [{}]}"}}, {"id": "b", "name": "g", "arguments": {"y]": [{"z": 1}]}}]'), (2, '{"id": "c"}'), (3, '[{"id": '), (4, None), (1, '[]')]
    got = sorted(map(tuple, N.call_table(spark.createDataFrame(rows, "k long, tool_calls string"), "k").collect()))
    assert got == [("1", "tool_calls[0]", None, 0, "a", "f", '{"x": [{}]}'), ("1", "tool_calls[1]", None, 1, "b", "g", '{"y]":[{"z":1}]}'), ("2", "tool_calls[0]", None, 0, "c", None, None)]
    links = {x.node_path: x.parent_path for x in N.nodes(spark.createDataFrame(rows, "k long, tool_calls string"), "k", "tool_calls", True).collect() if x.root_id == "1"}
    assert links["tool_calls[1].arguments.y][0]"] == "tool_calls[1]"


def test_empty_table(spark):
    assert N.node_paths(spark.createDataFrame([], "k long, c string"), "k", "c", True).count() == 0
