"""Archives, the error channel, named files, tables of contents, labels and scenes against plain versions."""

import io
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chapters as C
from quire.operators import relational as R
from quire.plans import books as B
from quire.sources import archives as A
from quire.sources import channel as K
from quire.sources import files as S
from quire.sources import named as N


def shelf(tmp_path):
    """Archives of many members, and files that aren't archives or are damaged."""
    rng, want = random.Random(3), {}
    for name, n in (("a b.zip", 40), ("é.zip", 1), ("sub/c.zip", 300)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("folder/", b"")
            for i in range(n):
                data = rng.randbytes(rng.choice([0, 1, 5000])) + b"tail" * 200
                z.writestr(f"x/{i}.bin", data, rng.choice([zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED]))
                want[name.split("/")[-1], f"x/{i}.bin"] = data
    whole = (tmp_path / "sub/c.zip").read_bytes()
    (tmp_path / "cut.zip").write_bytes(whole[:-40])
    (tmp_path / "none.zip").write_bytes(b"no archive at all")
    (tmp_path / "other.zip").write_bytes(B.zipped([]))
    damaged = bytearray(B.zipped([("good", b"g" * 100), ("bad", b"b" * 100), ("good2", b"h" * 100)]))
    damaged[damaged.index(b"PK\x01\x02") - 3] ^= 255  # a byte of the last member's data
    (tmp_path / "damaged.zip").write_bytes(damaged)
    return want


@pytest.mark.parametrize("run", [1, 3000, A.RUN])
def test_members(spark, tmp_path, run):
    want = shelf(tmp_path)
    found = A.members(S.listing(spark, f"file://{tmp_path}", "*.zip").select("path"))
    got = A.contents(found, run=run).withColumn("file", F.element_at(F.split("path", "/"), -1)).collect()
    held = {(r["file"], r["member"]): bytes(r["content"]) for r in got if r["status"] == "ok" and r["file"] != "damaged.zip"}
    assert held == want
    assert sorted(r["file"] for r in got if r["status"] == "failed" and r["member"] is None) == ["cut.zip", "none.zip"]
    assert sorted((r["member"], r["status"]) for r in got if r["file"] == "damaged.zip") == [("bad", "ok"), ("good", "ok"), ("good2", "failed")]
    assert all(r["reason"] for r in got if r["status"] == "failed") and not any(r["reason"] for r in got if r["status"] == "ok")


def test_members_are_pruned_and_bounded(spark, tmp_path):
    want = shelf(tmp_path)
    found = A.members(S.listing(spark, f"file://{tmp_path}/sub", "*.zip").select("path"))
    some = A.contents(found.where("member RLIKE '^x/1..bin$'"), run=2000)
    assert {r["member"]: bytes(r["content"]) for r in some.collect()} == {m: d for (f, m), d in want.items() if f == "c.zip" and re.match(r"x/1..bin$", m)}
    large = A.contents(found, most=1000).collect()
    assert {r["member"] for r in large if r["status"] == "failed"} == {m for (f, m), d in want.items() if f == "c.zip" and len(d) > 1000}
    whole = spark.read.format("binaryFile").load(f"file://{tmp_path}/sub").select("path", "content")
    again = A.contents(A.members(whole), whole=whole)
    assert {r["member"]: bytes(r["content"]) for r in again.collect()} == {m: d for (f, m), d in want.items() if f == "c.zip"}


def test_books(spark, tmp_path):
    for g in range(15):
        (tmp_path / f"book_{g}.epub").write_bytes(B.book(g, [(10 * g + i, f"<html>{g} {i}</html>") for i in range(3)]))
    broken = zipfile.ZipFile(tmp_path / "nav.epub", "w")
    whole = zipfile.ZipFile(io.BytesIO(B.book(0, [(1, "x")])))
    for i in whole.infolist():
        broken.writestr(i, b"<nav" if i.filename.endswith("nav.xhtml") else whole.read(i))
    broken.close()
    entries = S.books(spark, f"file://{tmp_path}")
    rows = entries.collect()
    assert sum(r["status"] == "failed" for r in rows) == 6
    texts = {r["member"]: (bytes(r["content"]).decode(), r["spine"]) for r in rows if r["media"] == "application/xhtml+xml" and r["spine"] is not None and "nav.epub" not in r["path"]}
    assert texts == {f"OEBPS/text/p{10 * g + i}.xhtml": (f"<html>{g} {i}</html>", i) for g in range(15) if g % 5 not in (3, 4) for i in range(3)}
    toc = A.tables_of_contents(entries.drop("content")).collect()
    of = lambda g: sorted((r["seq"], r["href"], r["title"]) for r in toc if r["path"].endswith(f"/book_{g}.epub"))
    for g in (0, 1, 2, 5, 6, 7, 10, 11, 12):
        assert of(g) == [(i, f"text/p{10 * g + i}.xhtml" + "#top" * (g % 3 == 0), f"Page {10 * g + i}" + " again" * (g % 3 > 0)) for i in range(3)]
    odd = sorted((str(r["toc"]), r["status"], r["title"]) for r in toc if r["path"].endswith("nav.epub"))
    assert odd == [("OEBPS/nav.xhtml", "failed", None), ("OEBPS/toc.ncx", "ok", "Page 1 again")]


def test_toc_trees():
    nav = b"<html xmlns:e='http://www.idpf.org/2007/ops'><nav e:type='landmarks'><ol><li><a href='l'>L</a></li></ol></nav><nav e:type='toc'><ol><li><a href=' a '> A\n b <i>c</i></a><ol><li><span>none</span><ol><li><a href='d'>D</a></li></ol></li><li><a>no link</a></li><li><a href='e'> </a></li></ol><ol><li><a href='z'>second list</a></li></ol></li></ol></nav></html>"
    assert A.toc_tree(nav) == [(0, "a", "A b c", 0), (1, "d", "D", 2)]
    assert A.toc_tree(b"<html><nav><ol><li><a href='x'>X</a></li></ol></nav><nav><ol><li><a href='y'>Y</a></li></ol></nav></html>") == [(0, "x", "X", 0)]
    assert A.toc_tree(b"<x/>") == A.toc_tree(b"") == A.toc_tree(None) == []


def test_error_channel(spark):
    def parse(n, s):
        for i in range(n):
            if i == 3:
                raise KeyError(s)
            yield i, s * i

    df = spark.createDataFrame([("a", 2, "x", 1), ("b", 5, "y", 2), ("c", 0, "z", 3), (None, 1, None, 4), ("e", 3, "w", 5)], "k string, n int, s string, i int").repartition(3)
    got = K.attempted(df, ["n", "s"], parse, "i int, t string", ["k", "s", "i"])
    assert got.columns == ["k", "s", "i", "t", "status", "reason"]
    assert sorted((str(r["k"]), r["i"], r["t"]) for r in K.good(got).collect()) == [("a", 0, ""), ("a", 1, "x"), ("e", 0, ""), ("e", 1, "w"), ("e", 2, "ww")]
    assert sorted((str(r["k"]), r["reason"]) for r in K.bad(got, ["k"]).collect()) == [("None", "TypeError: unsupported operand type(s) for *: 'NoneType' and 'int'"), ("b", "KeyError: 'y'")]
    many = K.attempted(spark.range(3), ["id"], lambda i: ((j,) for j in range(10_000)), "j int", ["id"])
    assert many.count() == 30_000 and K.attempted(df.limit(0), ["n", "s"], parse, "i int, t string", ["k"]).count() == 0


def test_assigned_by_name(spark, tmp_path):
    rng = random.Random(1)
    names = [f"Chapter_{i}_x.mp3" for i in range(20)]
    answers = []
    for k in range(3):
        rng.shuffle(names)
        (tmp_path / f"{k}").mkdir()
        (tmp_path / f"{k}/job.zip").write_bytes(B.zipped([(f"deep/{k}/{n}", n.encode()) for n in names] + [("extra.mp3", b""), ("a/twice.mp3", b""), ("b/twice.mp3", b"")]))
        (tmp_path / f"{k}/bad.zip").write_bytes(b"bad")
        items = spark.createDataFrame([(i, f"Chapter_{i}_x.txt") for i in range(22)] + [(99, "twice.txt"), (98, None)], "n int, file string")
        got = A.assigned(A.members(S.listing(spark, f"file://{tmp_path}/{k}", "*.zip").select("path")), items, "file").collect()
        answers.append(sorted((str(r["n"]), str(r["member"]).split("/")[-1], r["status"]) for r in got))
    want = [(str(i), f"Chapter_{i}_x.mp3" if i < 20 else "None", "matched" if i < 20 else "missing") for i in range(22)]
    want += [("99", "None", "repeated"), ("None", "twice.mp3", "repeated"), ("None", "twice.mp3", "repeated"), ("None", "extra.mp3", "extra"), ("None", "None", "failed")]
    assert all([a for a in x if a[0] != "98"] == sorted(want) for x in answers)


def test_named_files(spark, tmp_path):
    target = f"file://{tmp_path}/out"
    rows = [(f"v {i % 3}/ü{i}.txt", f"text {i}\nend") for i in range(50)] + [("top.txt", None)]
    df = spark.createDataFrame(rows, "path string, content string").repartition(4)
    read = lambda: {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert N.write_named(df, target) == 51 and read() == {p: c or "" for p, c in rows}
    assert N.write_named(df.where("path = 'top.txt'"), target) == 1 and read() == {"top.txt": ""}
    bad = spark.range(40).repartition(4).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("path"), F.expr("IF(id = 33, raise_error('stop'), 'x')").cast("string").alias("content"))
    with pytest.raises(Exception, match="stop"):
        N.write_named(bad, target)
    for names in (["a", "a"], [None]):
        with pytest.raises(ValueError, match="no name of one file"):
            N.write_named(spark.createDataFrame([(n, "x") for n in names], "path string, content string"), target)
    for name in ("../a", "/a", "a//b", "_a"):
        with pytest.raises(Exception, match="isn't a name below"):
            N.write_named(spark.createDataFrame([(name, "x")], "path string, content string"), target)
    assert read() == {"top.txt": ""} and [p.name for p in tmp_path.iterdir()] == ["out"]  # nothing is left of what failed
    assert N.write_named(df.limit(0), target) == 0 and read() == {}


def test_listings_pass_by_the_driver(spark, tmp_path):
    names = [f"v {i % 7}/{'deep/' * (i % 3)}ü%20{i}.txt" for i in range(300)] + ["top.txt", "x.md", "a=1/_k=2.txt", "_no/a.txt", ".no/a.txt", "v 1/_no.txt", "v 1/.no.txt", "v 1/no.txt._COPYING_", "v 1/[a] {b}.txt"]
    for n in names:
        (tmp_path / n).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / n).write_text(n)
    (tmp_path / "v 1/empty.txt").write_bytes(b"")
    (tmp_path / "v 1/gone.txt").symlink_to(tmp_path / "nowhere")
    (tmp_path / "v 1/none").mkdir()
    for pattern in ("*", "*.txt", "{top,x}.*", "ü?20[12]?.t*"):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(f"file://{tmp_path}")
        want = sorted((r["path"], r["length"], bytes(r["content"])) for r in files.collect())
        listed = S.listing(spark, f"file://{tmp_path}", pattern)
        assert want and sorted((r["path"], r["size"]) for r in listed.collect()) == [w[:2] for w in want]
        assert len(listed.inputFiles()) < 50  # tables of files, not the files, are what the driver knows
        assert sorted((r["path"], r["size"], bytes(r["content"])) for r in S.trees.read_below(spark, f"file://{tmp_path}", pattern).collect()) == want
    assert S.listing(spark, f"{tmp_path}/v 1/none").count() == 0 and S.listing(spark, f"{tmp_path}/top.txt").count() == 1
    assert {r["folder"] for r in S.listing(spark, f"{tmp_path}/v*", "*1.txt").collect()} == {"deep", *[f"v {i}" for i in range(7)]}
    with pytest.raises(FileNotFoundError):
        S.listing(spark, f"{tmp_path}/nowhere")


@pytest.mark.parametrize("query", ["published_files", "json_documents"])
def test_files_read_back_pass_by_the_driver(spark, query):
    from quire.plans import catalogue, trips  # noqa: F401

    got = catalogue.QUERIES[query](spark, "/root/testdata/sf0.001")
    assert not [f for f in got.inputFiles() if not f.endswith(".parquet")]


def test_named_files_are_written_a_few_at_a_time(spark, tmp_path):
    import tracemalloc

    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"path": [f"{i % 3}/{i}" for i in range(400)], "content": pa.array([b"x" * 100_000] * 400, pa.binary())})
    tracemalloc.start()
    done = N.NamedWriter(f"file://{tmp_path}/direct", True).write(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (done.files, done.size) == (400, 40_000_000) and peak < 4_000_000
    # A task isn't handed its part of the table at once, and the setting is as it was.
    def counted(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"path": [f"{i}.txt" for i in b.column(0).to_pylist()], "content": [str(b.num_rows)] * b.num_rows})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert N.write_named(spark.range(0, 3000, 1, 1).mapInArrow(counted, "path string, content string"), f"file://{tmp_path}/out") == 3000
    handed = {int(p.read_text()) for p in (tmp_path / "out").iterdir() if p.suffix == ".txt"}
    assert max(handed) == N.HANDED and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_format_folder(spark, tmp_path):
    texts = {"a/1.txt": "Head\nThe first\n\nline one\nline two\n\n\nnext", "a/b/2.txt": "\n", "c.txt": "one\r\ntwo\r\n", "bad/x.txt": None}
    for name, text in texts.items():
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(b"\xff\xfe" if text is None else text.encode())
    got = S.format_folder(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", ["Head", "The"])
    assert sorted((r["path"], r["status"]) for r in got.collect()) == [("a/1.txt", "ok"), ("a/b/2.txt", "ok"), ("bad/x.txt", "failed"), ("c.txt", "ok")]
    made = {str(p.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("*.txt")}
    assert made == {"a/1.txt": "Head\nThe first\nline one line two\nnext\n", "a/b/2.txt": "", "c.txt": "one two\n"}


def plain_roman(n):
    out = ""
    for v, s in ((1000, "M"), (900, "CM"), (500, "D"), (400, "CD"), (100, "C"), (90, "XC"), (50, "L"), (40, "XL"), (10, "X"), (9, "IX"), (5, "V"), (4, "IV"), (1, "I")):
        out, n = out + s * (n // v), n % v
    return out


def test_roman(spark):
    rows = [(plain_roman(n), n) for n in range(1, 4000)]
    wrong = ["IIII", "VX", "IC", "", "MMMM", "XM", "VV", "IXI", "ABC", "I V", None]
    df = spark.createDataFrame([*rows, *[(r.lower(), n) for r, n in rows[::7]], *[(w, None) for w in wrong]], "r string, n long")
    assert df.where(~T.roman(F.col("r")).eqNullSafe(F.col("n"))).count() == 0


def test_labels(spark):
    rows = [("a", 1, " Volume I: x", 0), ("a", 2, "Chapter 1", 1), ("a", 3, "BOOK 2", 0), ("a", 4, "Volume ii", 0), ("a", 5, "Volume II", 1), ("b", 1, "Part iiii", 0), ("b", 2, None, 0), ("c", 1, "Volumes 3", 0)]
    got = {r["doc"]: tuple(r)[1:] for r in C.label_stats(spark.createDataFrame(rows, "doc string, seq int, title string, level int"), "doc", 3).collect()}
    assert got == {"a": (5, 2, 4, 4, False, ["Volume I: x", "BOOK 2", "Volume ii"]), "b": (2, 0, 1, 0, True, ["Part iiii"]), "c": (1, 0, 0, 0, True, [])}


def test_scenes_and_registry(spark):
    texts = spark.createDataFrame([(1, "One\r\nTWO\nthree"), (2, None)], "n int, t string")
    scenes = spark.createDataFrame([(1, 0, 2), (1, 2, 99), (1, 3, 2), (2, 1, 1), (7, 1, 2), (1, None, 2)], "n int, line_start int, line_end int")
    assert [r["scene_text"] for r in C.scene_texts(scenes, texts, "n", "t").orderBy("n", F.asc_nulls_last("line_start")).collect()] == ["one two", "two three", "", "", "", ""]
    names = spark.createDataFrame([("Ann",), ("Lead",), ("Bob",), ("Mask",)], "name string")
    images = spark.createDataFrame([("Ann", "a.png"), ("Mask", "m.png"), ("Lead", "l.png")], "name string, image string")
    got = R.registry_coverage(names, images, spark.createDataFrame([("Bob", "Mask")], "name string, use string"), ["Lead"], ["Mask"])
    assert {r["name"]: (r["image"], r["has_image"]) for r in got.collect()} == {"Ann": ("a.png", True), "Lead": (None, True), "Bob": (None, False), "Mask": (None, False)}
    pages = spark.createDataFrame([(1, p, f"p{p}") for p in (1, 2, 4)], "d int, page int, text string")
    slices = spark.createDataFrame([(1, "volume", 2, "Volume 2: Birds", 2, "Volume 2: Birds", 1, 4, "ok"), (1, "chapter", 3, "Chapter 3: Wren", 2, "Volume 2: Birds", 3, 4, "moved"), (1, "chapter", 4, "x", 2, "Volume 2: Birds", 5, 4, "failed")], "d int, kind string, number int, title string, volume_number int, volume_title string, clip_start int, clip_end int, status string")
    assert {r["path"]: r["content"] for r in C.paged_files(pages, slices, "d", "S").collect()} == {"1/Volume_2_Birds.txt": "S\nVolume 2: Birds\n\np1\n\np2\n\n\n\np4", "1/Volume_2_Birds/Chapter_3_Wren.txt": "S\nChapter 3\nWren\n\n\n\np4"}
