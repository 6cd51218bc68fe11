import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.functions import audit as A
from tracelake.functions import images as V


def picture(seed=1, h=12, w=17):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), dtype=np.uint8)


def test_plain_kernels():
    im = picture()
    assert (V.flipped(V.flipped(im, "horizontal"), "horizontal") == im).all()
    assert (V.quarter_turned(V.quarter_turned(im, 1), 3) == im).all() and V.quarter_turned(im, 1)[0, -1].tolist() == im[0, 0].tolist()
    assert (V.brightened(im) == im).all() and V.brightened(im, 1, 300).min() == 255
    assert V.region(im, [500, 0, 0, 500]).shape == (6, 8, 3) and V.region(im, None) is im
    assert V.color_at(im, 1000, 1000) == im[-1, -1].tolist()
    assert V.gray(np.full((1, 1, 3), 255, np.uint8))[0, 0] == 255


def test_otsu_and_edges():
    two = np.zeros((4, 8, 3), np.uint8)
    two[:, 4:] = 200
    assert V.otsu(V.gray(two)) == 0 and (V.binarized(two)[:, 4:] == 255).all() and (V.binarized(two)[:, :4] == 0).all()
    e = V.edges(two)
    assert (e[:, 3:5] == 255).all() and (e[:, :3] == 0).all() and (e[:, 5:] == 0).all()
    assert V.edges(np.zeros((3, 3, 3), np.uint8)).max() == 0


def flood(mask, diagonal):
    seen, parts = set(), []
    near = [(0, 1), (1, 0), (0, -1), (-1, 0)] + ([(1, 1), (1, -1), (-1, 1), (-1, -1)] if diagonal else [])
    for y, x in zip(*np.nonzero(mask)):
        if (y, x) not in seen:
            todo, part = [(y, x)], set()
            while todo:
                p = todo.pop()
                if p not in seen and 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p]:
                    seen.add(p), part.add(p)
                    todo += [(p[0] + a, p[1] + b) for a, b in near]
            parts.append(part)
    return parts


@pytest.mark.parametrize("seed", range(8))
def test_components_equal_flood_fill(seed):
    mask = np.random.default_rng(seed).random((15, 21)) < (0.2 + 0.08 * seed)
    for diagonal in (False, True):
        parts = flood(mask, diagonal)
        got = V.components(mask, 1, diagonal)
        assert sorted(c["area"] for c in got) == sorted(map(len, parts))
        assert {(c["x1"], c["y1"], c["x2"], c["y2"], c["area"]) for c in got} == {(min(x for _, x in p), min(y for y, _ in p), max(x for _, x in p) + 1, max(y for y, _ in p) + 1, len(p)) for p in parts}
    assert V.components(np.zeros((2, 2), bool)) == []


def test_colour_ranges():
    im = np.zeros((10, 20, 3), np.uint8)
    im[1:3, 2:6], im[5:8, 10:12], im[9, 19] = [255, 0, 0], [250, 5, 20], [0, 0, 255]
    assert V.hsv(im)[1, 2].tolist() == [0, 255, 255] and V.hsv(im)[9, 19].tolist() == [120, 255, 255] and V.hsv(im)[0, 0].tolist() == [0, 0, 0]
    red = V.range_mask(im, [170, 100, 100], [10, 255, 255])
    assert red.sum() == 8 + 6 and not red[9, 19]
    assert V.range_boxes(im, [170, 100, 100], [10, 255, 255]) == [[100, 100, 300, 300], [500, 500, 600, 800]]
    assert V.range_boxes(im, [170, 100, 100], [10, 255, 255], least=7) == [[100, 100, 300, 300]]
    assert V.range_boxes(im, [200, 0, 0], [255, 50, 50], "bgr") == [[950, 900, 1000, 1000]]


def test_drawing():
    im = np.zeros((100, 100, 3), np.uint8)
    line = V.with_line(im, 0, 500, 1000, 500, [9, 9, 9], 1)
    assert line.any(axis=2).sum() == 100 and line[50].any() and not im.any()
    circle = V.with_circle(im, 500, 500, 300, [1, 2, 3], 1)
    ys, xs = np.nonzero(circle.any(axis=2))
    assert set(np.rint(np.hypot(ys - 50, xs - 50))) == {30} and circle[50, 80].tolist() == [1, 2, 3]
    box = V.with_box(im, [800, 200, 100, 600], [5, 5, 5], 1).any(axis=2)
    assert box[20, 10:81].all() and box[60, 10:81].all() and box[20:61, 10].all() and not box[40, 40]
    ramp = np.repeat(np.arange(100, 110, dtype=np.uint8)[None, :, None], 3, axis=2)
    assert V.equalized(ramp)[0, 0] == 0 and V.equalized(ramp)[0, -1] == 255 and V.equalized(im).max() == 0


def test_template():
    im = picture(3, 40, 50)
    assert V.matches(im, im[10:18, 20:31])[0] == {"x": 20, "y": 10, "score": 1.0}
    assert V.matches(im[:3, :3], im) == []


def test_columns(spark):
    im = np.zeros((4, 4, 3), np.uint8)
    im[:, :1] = 255
    df = spark.createDataFrame([(bytearray(im.tobytes()), 4, 4), (None, 4, 4), (bytearray(b"x"), 4, 4)], "d binary, h int, w int").coalesce(1)
    got = df.select(V.top_colors(F.col("d"), F.col("h"), F.col("w")).alias("c"), V.color_segments(F.col("d"), F.col("h"), F.col("w"), [255, 255, 255], 1.0).alias("s"), V.image_op(lambda x: V.flipped(x, "horizontal"), F.col("d"), F.col("h"), F.col("w")).alias("f")).collect()
    assert [(c.rgb, c.share) for c in got[0].c] == [([0, 0, 0], 0.75), ([248, 248, 248], 0.25)]
    assert got[0].s[0].area == 4 and got[1].c is None and got[2].s is None
    assert bytes(got[0].f) == im[:, ::-1].tobytes()
    heads = spark.createDataFrame([(bytearray(b"\x89PNG\r\n\x1a\n...."), "a"), (bytearray(b"xx"), "b.JPG"), (bytearray(b"xx"), "c")], "d binary, n string").coalesce(1)
    assert [r[0] for r in heads.select(V.mime(F.col("d"), F.col("n"))).collect()] == ["image/png", "image/jpeg", None]
    assert heads.select(V.data_url(F.col("d"), F.col("n"))).collect()[2][0] == "data:application/octet-stream;base64,eHg="


def test_audit(spark):
    rows = {"rm -rf /": "dangerous", "ls": "ok", "cat ../x": "traversal", "cat /etc/passwd": "outside", "cat /work/a": "ok", None: None}
    df = spark.createDataFrame([(k,) for k in rows], "c string").coalesce(1)
    assert [r[0] for r in df.select(A.command_verdict(F.col("c"), cwd="/work")).collect()] == list(rows.values())
    assert [r[0] for r in df.select(A.command_verdict(F.col("c"), ["^ls"])).collect()] == ["dangerous", "ok", "not_allowed", "not_allowed", "not_allowed", None]
    one = spark.range(1).select(A.unsafe_code(F.lit("os.system('x')")), A.unsafe_code(F.lit("print(1)")), A.valid_url(F.lit("https://a.b/c")), A.valid_url(F.lit("ftp://a")), A.without_base64(F.lit("x data:image/png;base64,AAAA= y")), A.image_references(F.lit("[image viewed * 1] saved /a/b.png b.png /a/b.png")), A.image_references(F.lit("/a/b.png")), A.code_blocks(F.lit("```python\nx\n```")), F.size(A.json_array_in(F.lit('so ```json\n[1, {"a": 2}]\n```'))), A.json_array_in(F.lit("[1"))).first()
    assert one[:4] == (True, False, True, False) and one[4] == "x data:image/png;base64,<base64> y" and one[5] == ["/a/b.png", "b.png"] and one[6] == [] and one[7] == ["x\n"] and one[8] == 2 and one[9] is None


def test_code_of_answers(spark):
    one = spark.range(1).select(A.closed_tags(F.lit("a<code>x")), A.closed_tags(F.lit("<code>x</code>")), A.last_code(F.lit("<code>1</code><code>\n```python\nx = 1\n```\n</code>")), A.last_code(F.lit("<code>```py\ny</code>")), A.last_code(F.lit("none")), A.saved_result(F.lit("ab" * 10), 5), A.saved_result(F.lit("data:image/png;base64,AAAA"), 50)).first()
    assert one[:] == ("a<code>x</code>", "<code>x</code>", "x = 1", "y", None, "ababa\n... (truncated)", "data:image/png;base64,...")


def test_settings(monkeypatch):
    monkeypatch.setenv("TL_X", "5")
    assert A.expanded({"a": ["${TL_X}", 1]}) == {"a": ["5", 1]}
    with pytest.raises(KeyError):
        A.expanded("${TL_NOT_SET}")
    assert A.redacted({"api_key": "s", "n": [{"token": "t", "k": 3}]}) == {"api_key": "<redacted>", "n": [{"token": "<redacted>", "k": 3}]}
    assert A.differing({"a": 1, "b": 2}, {"a": 1, "b": 3, "c": 4}, ("c",)) == ["b"]


def test_arguments_and_rejudge(spark):
    schema = {"crop": {"properties": {"path": {"type": "string"}, "box": {"type": "array", "items": {"type": "integer", "minimum": 0}}}, "required": ["path"]}}
    rows = [("crop", '{"path": "a", "box": [1, 2]}'), ("crop", '{"box": [1, -2, "x"]}'), ("crop", "{"), ("other", "{}"), (None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string, a string").coalesce(1).select(A.argument_problems(schema)("t", "a")).collect()]
    assert got == [[], ["$.box[1]: minimum 0", "$.box[2]: type integer", "$: required path"], ["arguments aren't JSON"], ["unknown tool other"], ["unknown tool None"]]
    given = spark.createDataFrame([("crop", '{"path": 7, "box": ["1", "x"]}')], "t string, a string")
    assert given.select(A.argument_problems(schema, True)("t", "a")).first()[0] == ["$.box[1]: type integer"]
    typed = {"properties": {"a": {"type": "boolean"}, "b": {"type": "number"}, "c": {"type": "integer"}, "d": {"type": "string"}}}
    assert A.cast({"a": "Yes", "b": "1.5", "c": "z", "d": None, "e": "1"}, typed) == {"a": True, "b": 1.5, "c": "z", "d": None, "e": "1"}
    assert A._misfits({"a": 1, "b": True, "c": 2}, typed) == ["$.a: type boolean", "$.b: type number"]
    out = A.rejudged(spark.createDataFrame([("a", 0.0), ("b", 1.0)], "k string, score double"), spark.createDataFrame([("a", 1.0)], "k string, score double"), "k", ["score"])
    assert {(r.k, r.score, r.score_prev) for r in out.collect()} == {("a", 1.0, 0.0), ("b", 1.0, None)}
