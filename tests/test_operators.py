"""Small cases with known results, and loops in plain Python as references."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import ledger as L
from quire.operators import ordered as O
from quire.operators import relational as R
from quire.sources import files as S
from quire.streaming import ledger as streaming


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} {'int' if isinstance(v, int) else 'double' if isinstance(v, float) else 'string'}" for i, v in enumerate(values)))
    return df.select(make(*[F.col(c) for c in df.columns])).first()[0]


@pytest.mark.parametrize(
    ("said", "spoken"),
    [("Maribel walked.", "Marybell walked."), ("MARIBEL left.", "MARYBELL left."), ("maribel said", "Marybell said"), ("Maribel's coat", "Marybell's coat"), ("MARIBEL'S coat", "MARYBELL's coat"), ("Amaribel", "Amaribel"), ("x Maribel y", "x Marybell y")],
)
def test_pronounce(spark, said, spoken):
    assert one(spark, lambda x: T.pronounce(x, [T.Spoken("Maribel", "Marybell")]), said) == spoken


def test_pronounce_rules_and_none(spark):
    rules = [T.Spoken("Maribel", "Marybell"), T.Spoken("Xyz", "EcksWhyZee")]
    assert one(spark, lambda x: T.pronounce(x, rules), "Maribel and Xyz.") == "Marybell and EcksWhyZee."
    assert one(spark, lambda x: T.pronounce(x, []), "Maribel walked.") == "Maribel walked."


@pytest.mark.parametrize(("line", "number", "title"), [("Chapter 215: Anna's Doubt", 215, "Anna's Doubt"), ("  Chapter 1: Copper  ", 1, "Copper"), ("Lords 2", None, None)])
def test_header(spark, line, number, title):
    assert one(spark, T.header_number, line) == number
    assert one(spark, T.header_title, line) == title


def test_titles(spark):
    assert one(spark, T.title_of_filename, "Chapter_215_Anna_s_Doubt.mp4") == "Anna s Doubt"
    assert one(spark, T.clean_chapter_title, "Chapter 12: 12: Foo") == "Foo"
    assert one(spark, T.clean_chapter_title, "110: Bar") == "Bar"
    assert one(spark, T.clean_chapter_title, '7" Baz') == "Baz"
    assert one(spark, T.clean_chapter_title, "12:") == "12:"
    assert one(spark, T.safe_name, " a/b  c. ") == "a_b_c"
    assert one(spark, T.volume_of_folder, "side_STORIES") == 9 and one(spark, T.volume_of_folder, "My_Side_Stories") == 0


@pytest.mark.parametrize(("seconds", "shown"), [(376.4, "0:06:16"), (0.5, "0:00:00"), (1.5, "0:00:02"), (3661.0, "1:01:01")])
def test_clock(spark, seconds, shown):
    assert one(spark, T.clock, seconds) == shown


def test_echo_and_predicates(spark):
    echo = lambda text: one(spark, T.echoes_title, text, 4, "The Door")
    assert all(map(echo, ["", "Chapter 4: The Door", "the  door", "4 The Door", "4: The Door", "Chapter 4 - 2"]))
    assert echo("Chapter 5: Other") and echo("Chapter 9 − 2")
    assert not any(map(echo, ["The Door opened at last.", "Chapter 4 - 2 men walked in", "Chapter 42 - 7 boats came"]))
    assert one(spark, T.starts_paragraph, '"Wait, I') and not one(spark, T.starts_paragraph, '"Wait," I')
    assert one(spark, lambda x: T.has_number(x, F.lit(12)), "see Chapter 012.") and not one(spark, lambda x: T.has_number(x, F.lit(12)), "Chapter 123")
    assert one(spark, T.xml_escape, "<&>") == "&lt;&amp;&gt;"


def test_ranges(spark):
    volumes = spark.createDataFrame([(1, 1, 109, 1), (2, 110, 263, 2), (8, 1116, 1179, 8)], "pos int, lo int, hi int, v int")
    rows = spark.createDataFrame([(x,) for x in (109, 110, 1179, 1500, 0)], "n int")
    assert {r["n"]: r["v"] for r in R.range_lookup(rows, "n", volumes, ["v"]).collect()} == {109: 1, 110: 2, 1179: 8, 1500: 8, 0: 8}
    assert {r["n"]: r["v"] for r in R.range_lookup(rows, "n", volumes, ["v"], "null").collect()}[1500] is None
    assert R.range_lookup(rows, "n", volumes.limit(0), ["v"]).count() == 5


def test_link_plan(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (4, "d")], "n int, id string")
    got = {r["source"]: r["skip_reason"] for r in R.link_plan(rows, "n", "id", 1, 3).collect()}
    assert got == {1: None, 2: "target missing", 3: "source missing"}


def test_reconcile_null_key(spark):
    got = R.reconcile(spark.createDataFrame([("a",), (None,), ("a",)], "id string"), spark.createDataFrame([("a",), ("b",), (None,)], "id string"), "id")
    assert sorted(r["status"] for r in got.collect()) == ["missing_in_ledger", "missing_on_remote", "verified", "verified"]


def test_fallback_numbers(spark):
    rng = random.Random(5)
    rows, want = [], {}
    for g in range(80):
        following = 1
        for i in range(rng.randint(0, 12)):
            parsed = rng.randint(1, 9) if rng.random() < 0.5 else None
            number = parsed if parsed is not None else following
            following = max(following, number + 1)
            rows.append((g, i, parsed))
            want[g, i] = number
    got = O.fallback_numbers(spark.createDataFrame(rows, "g int, i int, p int"), "g", "i", "p")
    assert {(r["g"], r["i"]): r["number"] for r in got.collect()} == want


def test_paragraphs_and_dedup(spark):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(["", "a b", "c", "", "d", "Ann said hi", "e"])], "doc int, n int, t string")
    got = O.paragraphs(lines, "doc", "n", "t", T.starts_paragraph(F.col("t")))
    assert [r["t"] for r in got.orderBy("par").collect()] == ["a b c", "d", "Ann said hi e"]
    same = spark.createDataFrame([(1, i, x) for i, x in enumerate(["a", "a", "b", "a", None, None])], "doc int, n int, t string")
    assert [r["t"] for r in O.drop_consecutive(same, "doc", "n", "t").orderBy("n").collect()] == ["a", "b", "a", None]


def test_hold_previous_and_batches(spark):
    rows = spark.createDataFrame([(1, 0, None), (1, 1, "x"), (1, 2, None), (2, 0, None), (3, 0, None), (3, 1, "y")], "g int, i int, v string")
    got = O.hold_previous(rows, "g", "i", "v", F.lit("none yet")).orderBy("g", "i").collect()
    assert [r["filled"] for r in got] == ["none yet", "x", "x", "x", "x", "y"]
    sizes = O.batches(spark.range(250), "id", 100).groupBy("batch").count().orderBy("batch").collect()
    assert [r["count"] for r in sizes] == [100, 100, 50]


def test_outline(spark):
    rows = spark.createDataFrame([(1, 0, 1, 1), (1, 1, 1, 1), (1, 2, 4, 1), (1, 3, None, 0), (1, 4, 9, 0)], "doc int, seq int, page int, level int")
    got = O.outline_ends(rows, "doc").orderBy("seq").collect()
    assert [r["end_page"] for r in got] == [0, 3, 0, 8, 999999]


def test_ledger(spark):
    log = spark.createDataFrame([("a", 1, True, "x"), ("a", 2, False, "y"), ("a", 3, False, "z"), ("b", 4, True, "w"), ("c", 5, None, "v")], "id string, seq int, dry boolean, p string")
    assert {r["id"]: r["p"] for r in L.upsert(log, "id", "seq", F.col("dry")).collect()} == {"a": "y", "b": "w", "c": "v"}
    assert {r["id"] for r in L.clear_dry_runs(log, "dry").collect()} == {"a", "c"}
    base = spark.createDataFrame([("a", 1, None)], "id string, x int, y int")
    got = L.merge_fields(base, spark.createDataFrame([("a", 5), ("b", 6)], "id string, y int"), "id", ["y"])
    assert {r["id"]: (r["x"], r["y"]) for r in got.collect()} == {"a": (1, 5), "b": (None, 6)}
    jobs = spark.createDataFrame([("j", ["a", "b"], ["c"])], "job_id string, successful array<string>, failed array<string>")
    assert {r["id"]: r["ok"] for r in L.outcomes(jobs, "id").collect()} == {"a": True, "b": True, "c": False}


def test_files(spark, tmp_path):
    for folder, name, text in (("1_Birds", "Chapter_2_B.txt", "x"), ("1_Birds", "Chapter_1_A.txt", "y"), ("Side_Stories", "Chapter_1_S.txt", "z"), ("1_Birds", "Chapter_3_Empty.txt", " "), ("other", "Chapter_9.txt", "n")):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_text(text)
    got = S.catalogue(S.texts(spark, str(tmp_path))).collect()
    assert [(r["volume_number"], r["chapter_number"], r["chapter_title"]) for r in got] == [(1, 1, "A"), (1, 2, "B"), (9, 1, "S")]
    assert S.artefacts(S.listing(spark, str(tmp_path)), ".txt").count() == 5
    assert S.json_or_empty(spark, str(tmp_path / "none.json"), "a int").count() == 0
    S.write_chapters(spark.createDataFrame([(1, "Birds", 2, "b"), (1, "Birds", 1, "a")], "volume_number int, volume_name string, chapter_number int, content string"), str(tmp_path / "out"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", "b"]


def test_toc():
    nav = b"<html><nav><ol><li><a href='v1'>One</a><ol><li><a href='c1'>C 1</a></li><li><span>no link</span><ol><li><a href='c2'>C 2</a></li></ol></li></ol></li></ol></nav></html>"
    assert [(h, t, n) for _, h, t, n in S.toc_tree(nav)] == [("v1", "One", 0), ("c1", "C 1", 1), ("c2", "C 2", 2)]


def test_streaming_upsert(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, True, "x"), ("a", 2, False, "y"), ("b", 3, True, "w"), ("a", 4, False, "z")], "id string, seq long, dry boolean, payload string")
    rows.write.parquet(str(tmp_path / "log"))
    log = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "log"))
    q = streaming.upsert(log).writeStream.format("memory").queryName("upserted").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {r["id"]: r["payload"] for r in spark.table("upserted").collect()} == {"a": "y", "b": "w"}
