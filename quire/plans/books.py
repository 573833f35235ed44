"""Queries over archives, named files and tables of contents that Spark makes from the driver's tables."""

from __future__ import annotations

import io
import zipfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import chapters as C
from quire.operators import scans
from quire.plans.catalogue import _LINES, query, table
from quire.sources import archives as A
from quire.sources import files as S

#: Pages of a book, and documents of a result archive.
BOOK, RESULT = 8, 50


def zipped(members: list[tuple[str, bytes]]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for i, (name, data) in enumerate(members):
            z.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_STORED if i % 3 == 0 else zipfile.ZIP_DEFLATED)
    return out.getvalue()


def book(g: int, pages: list[tuple[int, str]]) -> bytes:
    """An EPUB of pages: some list them in the nav document, some in an NCX only; of every five books one is cut off and one has
    no container."""
    listed = [(f"text/p{k}.xhtml", f"Page {k}") for k, _ in pages]
    nav = "".join(f"<li><a href='{h}#top'>{t}</a></li>" for h, t in listed) if g % 3 == 0 else ""
    ncx = "".join(f"<navPoint><navLabel><text>{t}  again</text></navLabel><content src='{h}'/></navPoint>" for h, t in listed)
    items = "".join(f"<item id='p{k}' href='text/p{k}.xhtml' media-type='application/xhtml+xml'/>" for k, _ in pages)
    kind = "application/x-dtbncx+xml" if g % 3 != 1 else "text/xml"
    opf = f"<package xmlns='http://www.idpf.org/2007/opf'><manifest><item id='nav' href='nav.xhtml' media-type='application/xhtml+xml' properties='svg nav'/><item id='ncx' href='toc%2Encx' media-type='{kind}'/>{items}</manifest><spine{' toc=' + repr('ncx') if g % 3 == 1 else ''}>{''.join(f'<itemref idref={chr(39)}p{k}{chr(39)}/>' for k, _ in pages)}</spine></package>"
    members = [
        ("mimetype", b"application/epub+zip"),
        ("META-INF/container.xml", b"<container><rootfiles><rootfile full-path='OEBPS/content.opf'/></rootfiles></container>"),
        ("OEBPS/content.opf", opf.encode()),
        ("OEBPS/nav.xhtml", f"<html xmlns='http://www.w3.org/1999/xhtml' xmlns:epub='http://www.idpf.org/2007/ops'><body><nav epub:type='landmarks'><ol><li><a href='x'>not this</a></li></ol></nav><nav epub:type='toc'><ol>{nav}</ol></nav></body></html>".encode()),
        ("OEBPS/toc.ncx", f"<ncx><navMap>{ncx}</navMap></ncx>".encode()),
        *[(f"OEBPS/text/p{k}.xhtml", x.encode()) for k, x in pages],
    ]
    data = zipped([m for m in members if g % 5 != 3 or m[0] != "META-INF/container.xml"])
    return data[:-30] if g % 5 == 4 else data


def library(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of archives with all pages, BOOK in each, written to the shared folder."""
    pages = table(spark, sf_dir, "pages").select(F.expr(f"page_id div {BOOK}").alias("g"), "page_id", "html")

    def make(part: pa.Table) -> pa.Table:
        g = part.column("g")[0].as_py()
        rows = sorted(zip(part.column("page_id").to_pylist(), part.column("html").to_pylist(), strict=True))
        return pa.table({"path": [f"shelf{g % 4}/book_{g}.epub"], "content": pa.array([book(g, rows)], pa.binary())})

    folder = f"{scans.scratch(spark)}/books"
    S.write_named(pages.groupBy("g").applyInArrow(make, "path string, content binary"), folder)
    return S.listing(spark, folder, "*.epub").select("path", "size")


_BOOKS = f"(select page_id, page_id // {BOOK} as g, row_number() over (partition by page_id // {BOOK} order by page_id) - 1 as place, html from pages)"


@query(f"""
with p as {_BOOKS}
select g as book, 'p' || page_id as id, 'OEBPS/text/p' || page_id || '.xhtml' as member, cast(place as int) as spine, md5(html) as content, strlen(html)::bigint as size, 'ok' as status from p where g % 5 not in (3, 4)
union all select distinct g, null, null, cast(null as int), null, cast(null as bigint), 'failed' from p where g % 5 in (3, 4)
""")
def book_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read back from the archives, by their manifest; unreadable archives say so."""
    found = A.entries(library(spark, sf_dir))
    wanted = found.where("status = 'failed' OR id LIKE 'p%'")
    number = F.regexp_extract("path", r"book_(\d+)\.epub$", 1).cast("long")
    return A.contents(wanted, run=4096).select(number.alias("book"), "id", "member", "spine", F.md5("content").alias("content"), "size", "status")


@query(f"""
with p as {_BOOKS}
select g as book, case when g % 3 = 0 then 'OEBPS/nav.xhtml' else 'OEBPS/toc.ncx' end as toc, place as seq, 'text/p' || page_id || '.xhtml' as bare, case when g % 3 = 0 then 'Page ' || page_id else 'Page ' || page_id || ' again' end as title, 0 as level, md5(html) as content
from p where g % 5 not in (3, 4)
""")
def book_toc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of contents of every book that can be read, and what each entry points to."""
    found = scans.cut(A.entries(library(spark, sf_dir)), scans.scratch(spark), "entries")
    toc = A.tables_of_contents(found).where("status = 'ok'")
    base = F.regexp_replace("toc", "/[^/]*$", "")
    placed = toc.select("path", "toc", "seq", "href", "title", "level").withColumn("member", F.regexp_replace(F.concat_ws("/", base, F.substring_index("href", "#", 1)), "^/", ""))
    held = A.contents(found.where("status = 'ok'").join(placed.select("path", "member").distinct(), ["path", "member"], "left_semi")).select("path", "member", F.md5("content").alias("content"))
    number = F.regexp_extract("path", r"book_(\d+)\.epub$", 1).cast("long")
    return placed.join(held, ["path", "member"], "left").select(number.alias("book"), "toc", "seq", F.substring_index("href", "#", 1).alias("bare"), "title", "level", "content")


@query("""
with d as (select doc_id, case when doc_id % 23 = 0 then 'repeated' when doc_id % 17 = 0 then 'missing' else 'matched' end as status from documents)
select doc_id, 'Chapter_' || doc_id as key, case when status = 'matched' then 'out/' || (doc_id % 3) || '/Chapter_' || doc_id || '.mp3' end as member, status from d
union all select null, 'Chapter_' || doc_id, unnest(['out/a/Chapter_' || doc_id || '.mp3', 'out/b/Chapter_' || doc_id || '.mp3']), 'repeated' from d where status = 'repeated'
union all select null, 'extra_' || doc_id, 'out/extra_' || doc_id || '.mp3', 'extra' from d where doc_id % 19 = 0
""")
def archive_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of result archives, in any order, matched to the documents by name."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")

    def make(part: pa.Table) -> pa.Table:
        members = []
        for k, lang in sorted(zip(part.column("doc_id").to_pylist(), part.column("lang").to_pylist(), strict=True), reverse=True):
            folders = ["out/a", "out/b"] if k % 23 == 0 else [] if k % 17 == 0 else [f"out/{k % 3}"]
            members += [(f"{f}/Chapter_{k}.mp3", (lang or "").encode()) for f in folders] + [(f"out/extra_{k}.mp3", b"x")] * (k % 19 == 0)
        return pa.table({"path": [f"job_{part.column('g')[0].as_py()}.zip"], "content": pa.array([zipped(members)], pa.binary())})

    folder = f"{scans.scratch(spark)}/results"
    S.write_named(docs.withColumn("g", F.expr(f"doc_id div {RESULT}")).groupBy("g").applyInArrow(make, "path string, content binary"), folder)
    found = A.members(S.listing(spark, folder, "*.zip").select("path"))
    items = docs.select("doc_id", F.concat(F.lit("Chapter_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"))
    return A.assigned(found, items, "file").select("doc_id", "key", "member", "status")


@query(r"""
with l as (select doc_id, n, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as line from LINES), h as (select *, n < 3 and (line like 'The%' or line like 'Is%') as head from l),
     s as (select *, line = '' or (regexp_matches(line, '^["“]') and not regexp_matches(line, '^["“].*["”]')) or regexp_matches(line, '^[A-Z][a-z]+ (said|thought|wondered)\b') as b from h where not head),
     i as (select *, sum(case when b then 1 else 0 end) over (partition by doc_id order by n) as par from s),
     r as (select doc_id, n as par, line from h where head union all select doc_id, cast(par + 3 as bigint), string_agg(line, ' ' order by n) from i where line <> '' group by doc_id, par),
     w as (select doc_id, string_agg(line || chr(10), '' order by par) as content from r group by doc_id)
select source || '/d' || doc_id || '.txt' as path, case when doc_id % 13 <> 0 then md5(coalesce(content, '')) end as content, case when doc_id % 13 = 0 then 'failed' else 'ok' end as status from documents left join w using (doc_id)
""".replace("LINES", _LINES))
def formatted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts for speech of every document as a file; those that aren't UTF-8 fail by themselves."""
    docs = table(spark, sf_dir, "documents")
    raw = F.when(F.col("doc_id") % 13 == 0, F.concat(F.unhex(F.lit("C3")), F.encode("text", "UTF-8"))).otherwise(F.encode("text", "UTF-8"))
    path = F.concat(F.lit("file:/in/"), "source", F.lit("/d"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return S.formatted(docs.select(path.alias("path"), raw.alias("content")), "file:/in", ["The", "Is"]).select("path", F.md5("content").alias("content"), "status")


@query(r"""
select 'Volume_' || p_size || '_' || replace(p_brand, '#', '#') || '/Chapter_' || p_partkey || '_' || replace(p_name, ' ', '_') || '.txt' as path, md5('Series' || chr(10) || 'Chapter ' || p_partkey || ': ' || p_name || chr(10) || chr(10) || p_type) as content from part
""")
def published_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter files, published at once and read back."""
    folder = f"{scans.scratch(spark)}/published"
    # The table is a few MB for a million rows: without an exchange one task would write all files.
    parts = table(spark, sf_dir, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    S.write_named(C.files(parts, "p_size", "p_brand", "p_partkey", "p_name", F.lit("Series"), "p_type"), folder)
    files = S.trees.read_below(spark, folder, "*.txt")
    return files.select(F.concat_ws("/", F.slice(F.split("path", "/"), -2, 2)).alias("path"), F.md5("content").alias("content"))


@query("""
with t as (select conv_id, turn, text, conv_id % 20 + 1 as v, turn // 2 as k from conversations),
     a as (select conv_id, v, string_agg(text, chr(10) || chr(10) order by turn) as body from t group by conv_id, v), c as (select conv_id, v, k, string_agg(text, chr(10) || chr(10) order by turn) as body from t group by conv_id, v, k)
select conv_id || '/Volume_' || v || '_Talk_' || conv_id || '.txt' as path, md5('Series' || chr(10) || 'Volume ' || v || ': Talk ' || conv_id || chr(10) || chr(10) || body) as content from a
union all select conv_id || '/Volume_' || v || '_Talk_' || conv_id || '/Chapter_' || k || '_Section_' || k || '.txt', md5('Series' || chr(10) || 'Chapter ' || k || chr(10) || 'Section ' || k || chr(10) || chr(10) || body) from c
""")
def paged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes and chapters of two pages cut from conversations as paged documents."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("page"), "text")
    size = rows.groupBy("conv_id").agg(F.min("page").alias("a"), F.max("page").alias("b"))
    volume, title = (F.col("conv_id") % 20 + 1).cast("int"), F.concat(F.lit("Talk "), F.col("conv_id").cast("string"))
    whole = size.select("conv_id", F.lit("volume").alias("kind"), volume.alias("number"), title.alias("title"), volume.alias("volume_number"), title.alias("volume_title"), "a", "b", F.col("a").alias("start"), F.col("b").alias("end"))
    number = F.expr("page div 2").cast("int")
    each = rows.join(size, "conv_id").groupBy("conv_id", number.alias("number"), "a", "b").agg(F.min("page").alias("start"), F.max("page").alias("end"))
    each = each.select("conv_id", F.lit("chapter").alias("kind"), "number", F.concat(F.lit("Section "), F.col("number").cast("string")).alias("title"), volume.alias("volume_number"), title.alias("volume_title"), "a", "b", "start", "end")
    slices = whole.unionByName(each).withColumnsRenamed({"a": "volume_start", "b": "volume_end"})
    from quire.operators import ordered as O

    return C.paged_files(rows, O.clip_slices(slices), "conv_id", "Series").select("path", F.md5("content").alias("content"))


# Titles by event: labels with numbers that are well-formed or not, and titles without a label.
_TITLES = ["Volume IV", "book 12: x", "Part iiii", "Part mix", "VOLUME XL - y", "Chapter 3", "  part  MCMXCIX", "Volumes 4", "Part 007", "volume vx", "Book C", "Part 99999999999999999999"]


@query(f"""
with t as (select user_id as doc, event_id as seq, event_id % 12 + 1 as i, case when event_type in ('signup', 'error') then 0 else 1 end as level from events),
     k as (select doc, seq, level, {_TITLES}[i] as title, ['volume', 'book', 'part', 'part', 'volume', null, 'part', null, 'part', 'volume', 'book', 'part'][i] as kind, [4, 12, null, 1009, 40, null, 1999, null, 7, null, 100, null][i] as number,
                  lead(level) over (partition by doc order by seq) as below from t),
     f as (select *, kind is not null and number <= last_value(number ignore nulls) over (partition by doc, kind order by seq rows between unbounded preceding and 1 preceding) as falls, row_number() over (partition by doc order by kind is null, seq) as r from k)
select doc, count(*) as entries, count(*) filter (where level = 0 and below > 0) as structural, count(kind) as labels, count(number) as valid, not coalesce(bool_or(falls), false) as rising,
       coalesce(string_agg(trim(title), '|' order by seq) filter (where kind is not null and r <= 15), '') as sample from f group by doc
""")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volume labels in outlines, with their numbers in digits or roman numerals."""
    titles = F.array(*[F.lit(t) for t in _TITLES])
    level = F.when(F.col("event_type").isin("signup", "error"), 0).otherwise(1)
    toc = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("seq"), F.get(titles, (F.col("event_id") % 12).cast("int")).alias("title"), level.alias("level"))
    return C.label_stats(toc, "doc").withColumn("sample", F.array_join("sample", "|"))


@query("""
select doc_id, md5(lower(array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: i between doc_id % 4 and doc_id % 4 + 2), ' '))) as scene_text from documents
""")
def scene_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scenes = docs.select("doc_id", (F.col("doc_id") % 4).alias("line_start"), (F.col("doc_id") % 4 + 2).alias("line_end"))
    return C.scene_texts(scenes, docs, "doc_id", "text").select("doc_id", F.md5("scene_text").alias("scene_text"))
