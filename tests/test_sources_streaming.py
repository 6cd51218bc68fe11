import json

import pytest
from pyspark.sql import functions as F

from tracelake.sources import jsonl as J
from tracelake.streaming import progress as P


def put(folder, name, text):
    at = folder / name
    at.parent.mkdir(parents=True, exist_ok=True)
    at.write_text(text)
    return str(at)


def test_policies(spark, tmp_path):
    good = put(tmp_path, "good.jsonl", '{"id": 1, "q": "a b"}\n\n{"id": 2}\n')
    tail = put(tmp_path, "tail.jsonl", '{"id": 1}\n{"id": 2')
    mid = put(tmp_path, "mid.jsonl", '{"id": 1}\nnope\n[1]\n{"id": 3}\n')
    ids = lambda *a, **k: sorted(r.id for r in J.read_jsonl(spark, *a, **k).collect())
    assert ids(good, "id int, q string") == [1, 2]
    assert {r.line_no for r in J.read_jsonl(spark, good, "id int").collect()} == {0, 2}
    assert ids(tail, "id int", J.PARTIAL_TAIL) == [1]
    assert ids(mid, "id int", J.SKIP) == [1, 3]
    for path, policy in ((tail, J.FAIL), (mid, J.FAIL), (mid, J.PARTIAL_TAIL)):
        with pytest.raises(Exception, match="bad JSON object"):
            J.read_jsonl(spark, path, "id int", policy).select(F.sum("id")).collect()
    with pytest.raises(Exception, match="no q in"):
        J.read_jsonl(spark, good, "id int, q string", required=["q"]).select(F.max("q")).collect()
    with pytest.raises(ValueError):
        J.read_jsonl(spark, good, "id int", "other")
    assert J.malformed_counts(spark, mid).first()[1:] == (4, 2)


def test_sessions(spark, tmp_path):
    meta = '{"_type": "metadata", "key": "k"}\n'
    put(tmp_path, "r/session_1/a.jsonl", meta + '{"role": "user", "content": [{"type": "text", "text": "q"}]}\n{"role": "assistant", "content": null, "tool_calls": [{"id": "c"}]}\n')
    put(tmp_path, "r/session_1_s0/a.jsonl", meta)
    put(tmp_path, "r/session_10/sessions/b.jsonl", meta + "broken\n")
    put(tmp_path, "r/session_x/c.jsonl", meta)
    files = J.session_files(spark, str(tmp_path / "r"))
    assert {(r.session_id, r.variant) for r in files.collect()} == {(1, None), (1, "_s0"), (10, None)}
    assert {r.session_id: r.file.rsplit("/", 2)[-2] for r in J.first_variants(files).collect()} == {1: "session_1", 10: "sessions"}
    got = {(r.role, r.content, r.tool_calls) for r in J.read_sessions(spark, str(tmp_path / "r")).collect()}
    assert {r.session_id: [f.rsplit("/", 2)[-2] for f in r.files] for r in J.first_variants(files).collect()}[1] == ["session_1", "session_1_s0"]
    assert {r.session_id: r.file.rsplit("/", 2)[-2] for r in J.variant_of(files, ("_s0", "")).collect()}[1] == "session_1_s0"
    put(tmp_path, "r/session_2/d.jsonl", meta + '{"role": "user"}\n\n{"role": "user"}\n')
    told = J.read_sessions(spark, str(tmp_path / "r"))
    assert sum(r.role == "parse_error" for r in told.collect()) == 2
    assert J.read_sessions(spark, str(tmp_path / "r"), best_effort=True).where("role = 'parse_error'").count() == 0
    assert [r.session_id for r in J.newest_files(J.session_files(spark, str(tmp_path / "r")), 2).collect()] == [1, 2]
    assert J.newest_files(J.session_files(spark, str(tmp_path / "r"))).count() == 4
    assert {r.key for r in J.session_list(spark, str(tmp_path / "r")).collect()} == {"k"}
    J.write_session(spark.createDataFrame([(1, "assistant", "b"), (0, "user", "a")], "line_no int, role string, content string"), {"key": "n"}, str(tmp_path / "s"))
    lines = "".join(p.read_text() for p in (tmp_path / "s").glob("*.txt")).splitlines()
    assert [json.loads(x).get("content", "meta") for x in lines] == ["meta", "a", "b"]
    assert ("parse_error", None, None) in got and ("user", '[{"text":"q","type":"text"}]', None) in got and ("assistant", None, '[{"id":"c"}]') in got


def test_runs_and_paths(spark, tmp_path):
    put(tmp_path, "run/task_1/result.json", '{"id": 2, "source_dataset": "b", "task_key": "k"}')
    put(tmp_path, "run/task_2/result.json", '{"id": 1, "source_dataset": "a", "task_key": "k"}')
    put(tmp_path, "run/task_3/result.json", '{"id": 1')
    assert [r.id for r in J.run_results(spark, str(tmp_path / "run"), "id int, source_dataset string, task_key string").collect()] == [1, 2]
    good = put(tmp_path, "t/a.jsonl", '{"step": -1}\n{"step": 0, "model": "m"}\n{"step": 1}\n')
    put(tmp_path, "t/b.jsonl", '{"step": 0}\n{"st')
    assert [(r.step, r.model) for r in J.turn_traces(spark, str(tmp_path / "t"), "step int, model string").orderBy("step").collect()] == [(0, "m"), (1, None)]
    assert good
    bench = put(tmp_path, "bench.jsonl", '{"id": 1, "source_dataset": "d", "images": ["a.png"]}\n{"id": 2, "images": null}\n')
    assert [r.images for r in J.read_benchmark(spark, bench, "id int, source_dataset string, images array<string>").orderBy("id").collect()] == [["images/d/a.png"], None]
    there = spark.createDataFrame([("/abs/x.png",), ("/root1/a/y.png",), ("/root2/z.png",), ("/root1/img/w.png",)], "file string")
    wanted = spark.createDataFrame([("1", "/abs/x.png"), ("1", '"a/y.png"'), ("1", "/gone/z.png"), ("1", "old/session_3/img/w.png"), ("1", "no.png"), ("1", None)], "key string, path string")
    got = {r.path: r.file for r in J.resolved_paths(wanted, there, ["/root1", "/root2/"]).collect()}
    assert got == {"/abs/x.png": "/abs/x.png", '"a/y.png"': "/root1/a/y.png", "/gone/z.png": "/root2/z.png", "old/session_3/img/w.png": "/root1/img/w.png", "no.png": None, None: None}
    png = bytearray(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (640).to_bytes(4, "big") + (480).to_bytes(4, "big"))
    sizes = spark.createDataFrame([(3, 4, png), (None, 4, png), (None, None, bytearray(b"x"))], "width int, height int, head binary")
    assert [r.s and r.s[:] for r in sizes.coalesce(1).select(J.image_size([("img_w", "img_h"), ("width", "height")], sizes.columns, F.col("head")).alias("s")).collect()] == [(3, 4), (640, 480), None]
    J.write_jsonl(spark.createDataFrame([(2, "b"), (1, "a"), (2, "b")], "id int, v string"), str(tmp_path / "staged"))
    J.rewrite_sorted(spark, str(tmp_path / "staged"), str(tmp_path / "final"), "id")
    assert [r.id for r in spark.read.json(str(tmp_path / "final")).orderBy("id").collect()] == [1, 2]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "ä"), (3, None)], "id int, t string")
    J.write_jsonl(df, str(tmp_path / "out"), one_file=True, order=["id"])
    lines = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json")).splitlines()
    assert [json.loads(x) for x in lines] == [{"id": 1, "t": "ä"}, {"id": 2, "t": "b"}, {"id": 3}]
    assert J.markdown_table(df.orderBy("id")).splitlines()[2] == "| 1 | ä |"
    with pytest.raises(ValueError):
        J.markdown_table(df, 2)


def test_resumed_stream_equals_batch(spark, tmp_path):
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    row = lambda k, v: (k, v)
    read = lambda: spark.readStream.schema("k long, v long").parquet(str(folder))
    spark.createDataFrame([row(k, 1) for k in range(10)], "k long, v long").write.mode("append").parquet(str(folder))
    P.appended(read(), out, check)
    P.appended(read(), out, check)
    assert spark.read.parquet(out).count() == 10
    spark.createDataFrame([row(k, 2) for k in range(5, 15)], "k long, v long").write.mode("append").parquet(str(folder))
    P.appended(read(), out, check)
    assert spark.read.parquet(out).count() == 20
    P.upserted(read(), ["k"], "v", str(tmp_path / "up"), str(tmp_path / "check2"))
    assert {(r.k, r.v) for r in P.latest(spark, str(tmp_path / "up"), ["k"], "v").collect()} == {(k, 1) for k in range(5)} | {(k, 2) for k in range(5, 15)}


def test_repeats_within_the_watermark(spark, tmp_path):
    folder = tmp_path / "in"
    spark.createDataFrame([(1, "2026-01-05 00:10:00"), (1, "2026-01-05 00:10:00"), (2, "2026-01-05 00:11:00")], "k long, t string").withColumn("t", F.to_timestamp("t")).write.parquet(str(folder))
    stream = spark.readStream.schema("k long, t timestamp").parquet(str(folder))
    P.appended(P.once_within(stream, ["k"], "t", "1 hour"), str(tmp_path / "out"), str(tmp_path / "check"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]


def test_windows(spark):
    df = spark.createDataFrame([("2026-01-05 00:10:00", "a", 1.0), ("2026-01-05 00:50:00", "a", 2.0), ("2026-01-05 01:00:00", "a", 4.0)], "t string, k string, v double").withColumn("t", F.to_timestamp("t"))
    assert sorted((r.n, r.total) for r in P.tumbling(df, "t", "1 hour", ["k"], "v").collect()) == [(1, 4.0), (2, 3.0)]
    assert P.tumbling(df, "t", "1 hour", ["k"], "v", "30 minutes").agg(F.sum("n")).first()[0] == 6
    assert sorted(r.n for r in P.sessions_of(df, "t", "30 minutes", ["k"]).collect()) == [1, 2]
