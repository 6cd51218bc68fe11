from pyspark.sql import functions as F

from tracelake.functions import web as H
from tracelake.plans import queries as Q


def test_html_stats(spark):
    rows = [
        ("<!doctype html><!-- <p>no</p> --><html><head><style>p > a {b: c}</style><script>if (a<b) x('<td>');</script></head><body><p title=\"a > b\">x &amp;lt; y</p><br/><P>z</P></body></html>", {"html": 1, "head": 1, "style": 1, "script": 1, "body": 1, "p": 2, "br": 1}, "x < y z", True, False),
        ("<div style='a'><img src='img/rick.jpg'>t</div>", {"div": 1, "img": 1}, "t", True, True),
        ("<img src=brick.jpg> 1 < 2", {"img": 1}, "1 < 2", False, False),
        ("<p>open", {"p": 1}, "open", False, False),
        ("", {}, "", False, False),
        (None, {}, "", False, False),
        ("<!-- open <p>a</p>", {}, "", False, False),
    ]
    got = spark.createDataFrame([(k, r[0]) for k, r in enumerate(rows)], "k int, t string").select("k", H.html_stats("t").alias("s")).orderBy("k").collect()
    assert [(r.s.tags, r.s.text, r.s.has_css, r.s.has_picture) for r in got] == [r[1:] for r in rows]
    assert [r.s.total_tags for r in got] == [sum(r[1].values()) for r in rows]
    long = spark.createDataFrame([("<a " + "b='c' " * 20_000 + ">" + "<i>x</i>" * 20_000,)], "t string").select(H.html_stats("t").alias("s")).first()
    assert long.s.total_tags == 20_001


def test_extraction_forms(spark):
    texts = ["<think>x <div>no</div>", "say <body><html>a</html></body>", "```html\n<p>1</p>\n```\n```html\n<p>22</p>\n```", "```\nplain\n```", "```\n<b>c</b>\n```", "no markup", "", None]
    got = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", H.extracted_by_position(F.col("t")), H.extracted_by_fence(F.col("t"))).orderBy("k").collect()
    assert [r[1] for r in got] == ["", "<body><html>a</html></body>", "<p>22</p>", "", "<b>c</b>", "", "", ""]
    assert [r[2] for r in got] == [texts[0], texts[1], "<p>1</p>", texts[3], "<b>c</b>", "no markup", "", ""]
    one = spark.range(1).select(H.with_placeholder(F.lit("<img src='rick.jpg'> url(rick.jpg) <img src='a/rick.jpg'>"), "X"), H.markdown_of(F.lit("<h2>T</h2><p>a&amp;b <a class='x' href='/u'>l</a></p><ul><li>1</li><li>2</li></ul><script>x</script>"))).first()
    assert one[:] == ("<img src='X'> url('X') <img src='a/rick.jpg'>", "## T\na&b [l](/u)\n- 1\n- 2")



def test_html_stats_take_pages_of_any_source(spark, tmp_path):
    page = "<html><body><p>a</p></body></html>"
    rows = [(1, page, "page_dump"), (2, page, None), (3, page, "notes"), (4, "plain", "notes"), (5, None, "page_dump"), (6, "<p>part</p>", "page_dump")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {x.doc_id for x in Q.QUERIES["html_stats"](spark, str(tmp_path)).collect()} == {1, 2, 3, 6}
