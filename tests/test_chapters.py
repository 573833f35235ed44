"""Chapter bodies against a plain walk, outlines, reports and sinks."""

import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from quire.functions import html as H
from quire.functions import text as T
from quire.operators import chapters as C
from quire.operators import ledger as L
from quire.sources import files as S
from quire.streaming import ledger as streaming

MARKERS = ["all rights reserved"]


def plain_echo(text, n, title):
    t = " ".join(text.split())
    low, title = t.lower(), " ".join(title.lower().split())
    dash = "[-‐‑‒–—−]"
    if not t or low in (f"chapter {n}: {title}", title):
        return True
    shapes = (r"chapter\s+\d+\s*:", rf"chapter\s+\d+\s*{dash}\s*\d+\s*:", rf"chapter\s+\d+\s*{dash}\s*\d+\s*$")
    return len(t) < 280 and (low in (f"{n} {title}", f"{n}: {title}") or any(re.match(s, low) for s in shapes))


def plain_body(way, blocks, n, title):
    kept = [b for b in blocks if not plain_echo(b, n, title) and (way == "regex" or not any(m in b.lower() for m in MARKERS))]
    return "\n\n".join(b for i, b in enumerate(kept) if way == "regex" or not i or kept[i - 1] != b)


PAGES = [
    (1, "The Door", "<html xmlns='http://www.w3.org/1999/xhtml'><body><h1>x</h1><p>Chapter 1: The Door</p><p>the  DOOR</p><p>Text  one.</p><p>Text one.</p><li><p>in</p></li><nav><p>n</p></nav></body></html>", "xml"),
    (2, "The Door", "<html><head><meta charset=x><title>t</title></head><body><h1>H</h1>stray <p>a &amp; b<br>c</p><script>x('</p>')</script><blockquote>q</blockquote><nav><p>hidden</p></nav><li>l</li><p>All rights reserved.<p>tail</body>", "html"),
    (3, "A", "<r><p>no body</p></r>", "xml"),
    (4, "A", "", "html"),
    (5, "A", None, "html"),
    (6, "A", "<body><p>4 A</p><p>6 A</p><p>6: a</p><p>Chapter 9 - 3</p><p>Chapter 9 - 3 men came</p><p>Chapter 42 – 7: x</p><p>&nbsp;</p></body>", "html"),
    (7, "A", "<x:body xmlns:x='u'><p>root only</p></x:body>", "xml"),
]


def test_chapter_bodies(spark):
    df = spark.createDataFrame([(k, t, h, k) for k, t, h, _ in PAGES], "id int, title string, html string, n int")
    got = {r["id"]: r for r in C.bodies(df, "id", "html", "n", "title", MARKERS).collect()}
    assert {k: r["way"] for k, r in got.items()} == {k: w for k, _, _, w in PAGES}
    for k, title, html, way in PAGES:
        assert got[k]["body"] == plain_body(way, H.read_blocks(html)[1], k, title), k
    assert got[1]["body"] == "Text one.\n\nin\n\nn" and got[2]["body"] == "stray a & bc\n\nq\n\nl"
    assert got[6]["body"] == "4 A\n\nChapter 9 - 3 men came" and got[6]["paragraphs"] == 2
    assert C.bodies(df.limit(0), "id", "html", "n", "title", MARKERS).count() == 0


def test_chapter_bodies_of_pages(spark):
    from quire.plans import media

    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html", F.parse_url("url", F.lit("HOST")).alias("title")).collect()
    got = {r["page_id"]: r["body"] for r in media.chapter_bodies(spark, sf).collect()}
    assert got == {r["page_id"]: plain_body(*H.read_blocks(r["html"]), r["page_id"], r["title"]) for r in rows}


def test_block_readers():
    page = PAGES[1][2]
    assert H.blocks_of(page, compat=True) == []
    assert H.blocks_of("<p>a<script>b</p>c</script>d</p><svg:p>e</svg:p>f") == ["ad", "e", "f"]
    assert H.blocks_of("</h1><h2>x<p>y</p></h2>z<p>") == ["z"]
    assert H.regex_blocks_of("<body><p>a &eacute; <b>c</b></p><style>p</style><pre>d</p></body>") == [f"a {unescape('&eacute;')} c", "d"]


def test_regex_paragraphs(spark):
    df = spark.createDataFrame([("<p>out</p><body><p>a &amp; b</p> <p> </p></body>",), ("<p>x</p>",)], "h string")
    assert [r[0] for r in df.select(H.regex_paragraphs(F.col("h"))).collect()] == [["a & b"], ["x"]]


def plain_spoken(text, rules):
    """One pass for each rule: the reference the column is held against."""
    for word, spoken, owned, free in rules:
        shape = rf"(?<![A-Za-z0-9]){re.escape(word)}{"(?:'s)?" if owned else ''}(?![A-Za-z0-9])"

        def said(m):
            whole, tail = m[0], ""
            if owned and whole.lower() == (word + "'s").lower():
                whole, tail = whole[:-2], "'s"
            if whole.lower() != word.lower():
                return m[0]
            new = spoken.upper() if whole.isupper() else spoken[0].upper() + spoken[1:] if whole[0].isupper() else spoken
            return new + tail

        text = re.sub(shape, said, text, flags=re.IGNORECASE if free else 0)
    return text


@pytest.mark.parametrize("rules", [[("Ann", "Ann Marie", True, True)], [("Ann", "Bob", False, False), ("Bob", "Ann Bob", True, True)], [("a.b", "x$1\\", True, True)], [("X", "ex", True, True)]])
def test_pronounce_takes_one_pass(spark, rules):
    texts = ["Ann left", "ANN left", "ann's ANN'S Ann's ann'sx Anna xAnn Ann", "A.B a.b'S a+b", "Bob and Ann and BOB", "", "X x X's\x00X", "Ann\nAnn", "no match"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    got = [r[0] for r in df.select(T.pronounce(F.col("t"), [T.Spoken(*r) for r in rules])).collect()]
    assert got == [*[plain_spoken(t, rules) for t in texts], None]


def test_outlines(spark):
    raw = [("a", '[{"title": "V1", "page": 1}, [{"title": "C1", "page": 2}, {"no": 1}, [{"title": "S"}]], {"title": "V2", "page": 9}]'), ("b", "[{"), ("c", None)]
    rows = S.flatten_outline(spark.createDataFrame(raw, "path string, outline string"))
    assert [(r["path"], r["seq"], r["title"], r["page"], r["level"]) for r in rows.orderBy("seq").collect()] == [("a", 0, "V1", 1, 0), ("a", 1, "C1", 2, 1), ("a", 2, "S", None, 2), ("a", 3, "V2", 9, 0)]
    assert {r["kind"] for r in C.split_outline(rows, "path").collect()} == {"volume", "chapter"}
    assert {r["kind"] for r in C.split_outline(rows.where("seq > 0"), "path").collect()} == {"single"}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Birds: a", n, f"T {n}?", f"body {n}\nend") for n in (2, 1)], "v int, name string, n int, title string, b string")
    assert S.write_named(C.files(rows, "v", "name", "n", "title", F.lit("S"), "b"), f"file://{tmp_path}/out") == 2
    assert (tmp_path / "out/Volume_1_Birds_a/Chapter_1_T_1.txt").read_text() == "S\nChapter 1: T 1?\n\nbody 1\nend"
    ledger = spark.createDataFrame([("a", "failed"), ("b", "done"), ("c", None)], "k string, state string")
    S.write_ledgers({"completed": ledger.where("state = 'done'"), "all": ledger}, f"file://{tmp_path}/ledgers")
    assert spark.read.json(f"file://{tmp_path}/ledgers/all").count() == 3
    assert L.cleared(ledger).count() == 0 and {r["k"] for r in L.cleared(ledger, F.col("state") == "failed").collect()} == {"b", "c"}
    S.write_report(ledger, ledger.agg(F.count("*").alias("n")), f"file://{tmp_path}/report")
    assert spark.read.json(f"file://{tmp_path}/report/summary").first()["n"] == 3
    S.write_queue(spark.createDataFrame([("x", "t", 1, 2), ("y", "u", 1, 1)], "filename string, title string, volume_number int, chapter_number int"), spark.createDataFrame([("z",)], "filename string"), f"file://{tmp_path}/queue")
    assert [r[0] for r in spark.read.text(f"file://{tmp_path}/queue").collect()] == ["y|u", "x|t"]


def test_sources(spark, tmp_path):
    content = spark.createDataFrame([('[{"a": 1}]',), ('{"rows": [{"a": 2}, {"a": 3}]}',)], "c string")
    assert [[x["a"] for x in r[0]] for r in content.select(S.wrapped_or_bare(F.col("c"), "rows", "struct<a: int>")).collect()] == [[1], [2, 3]]
    files = spark.createDataFrame([("b", "x.png", "b/x.png"), ("a", "y.jpg", "a/y.jpg"), ("a", "x.png", "a/x.png")], "folder string, filename string, path string")
    assert S.by_precedence(files, ["a", "b"], [".png", ".jpg"]).first()["path"] == "a/x.png"
    (tmp_path / "d.csv").write_text("Ch,Sec\n1,2.5\n")
    assert S.durations(spark, str(tmp_path / "d.csv")).first()["Sec"] == 2.5
    ncx = b"<ncx><navMap><navPoint><navLabel><text>One</text></navLabel><content src='a#x'/><navPoint><navLabel><text>Two</text></navLabel><content src='b'/></navPoint></navPoint></navMap></ncx>"
    toc = S.toc_entries(spark.createDataFrame([("p", bytearray(ncx))], "path string, content binary"))
    entries = spark.createDataFrame([("p", "a", bytearray(b"A"))], "path string, href string, content binary")
    got = C.fetch(toc, entries).orderBy("seq").collect()
    assert [(r["href"], r["title"], r["level"], r["content"]) for r in got] == [("a#x", "One", 0, bytearray(b"A")), ("b", "Two", 1, None)]
    docs = spark.createDataFrame([("p", '{"a": {"b": 1}, "c": 2}'), ("q", "{"), ("r", '{"c": 1}')], "name string, content string")
    assert [r["valid"] for r in C.valid_projects(docs, "name", "content", ["a.b", "c"]).collect()] == [True, False, False]


def test_streaming_activity(spark, tmp_path):
    rows = spark.range(10).select((F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 20).cast("int"))).alias("ts"), (F.col("id") % 2).cast("string").alias("kind"))
    rows.write.parquet(str(tmp_path / "in"))
    q = streaming.activity(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "ts", "kind").writeStream.format("memory").queryName("act").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("act").agg(F.sum("n")).first()[0] == 10
