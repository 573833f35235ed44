"""Registered queries of the core library and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import html as H
from quire.functions import text as T
from quire.operators import gates as G
from quire.operators import ledger as L
from quire.operators import ordered as O
from quire.operators import relational as R

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, line of every document."""
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("n", "line"))


#: SQL for the same rows.
_LINES = "(select doc_id, unnest(range(len(s))) as n, unnest(s) as line from (select doc_id, string_split(text, chr(10)) as s from documents))"


# Progress and pending work


@query("""
select source as grp, count(*) as total, count(l.doc_id) as done_a, round(100.0 * count(l.doc_id) / count(*), 4) as pct_a,
       count(*) filter (where l.quality = 1) as done_b, round(100.0 * count(*) filter (where l.quality = 1) / count(*), 4) as pct_b
from documents d left join labels l using (doc_id) group by source
""")
def progress_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("grp"))
    return R.progress(docs, table(spark, sf_dir, "labels"), ["doc_id"], ["grp"], {"a": F.lit(True), "b": F.col("quality") == 1})


@query("""
select count(*) as total, count(l.doc_id) as done_a, round(100.0 * count(l.doc_id) / count(*), 4) as pct_a,
       count(*) filter (where l.toxic = 0) as done_b, round(100.0 * count(*) filter (where l.toxic = 0) / count(*), 4) as pct_b,
       count(distinct source) as groups
from documents d left join labels l using (doc_id)
""")
def progress_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    whole = R.progress(docs.select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"], [], {"a": F.lit(True), "b": F.col("toxic") == 0})
    return whole.crossJoin(docs.agg(F.countDistinct("source").alias("groups")))


@query("""
select doc_id, source from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id) order by doc_id limit 20
""")
def pending_next_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return R.pending(docs, table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"]).orderBy("doc_id").limit(20)


@query("""
select doc_id, n_chars from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id and quality = 1)
   or not exists (select 1 from labels l where l.doc_id = d.doc_id and toxic = 0) order by doc_id limit 25
""")
def pending_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "labels")
    sets = [made.where("quality = 1").select("doc_id"), made.where("toxic = 0").select("doc_id")]
    return R.next_pending(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), sets, ["doc_id"], ["doc_id"], 25)


@query("select doc_id from labels where quality = 1 intersect select doc_id from labels where toxic = 0")
def completed_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "labels")
    return R.in_all([made.where("quality = 1").select("doc_id"), made.where("toxic = 0").select("doc_id")])


@query("select d.doc_id, d.lang from documents d where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)")
def completed_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.present(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels").where("quality = 1"), ["doc_id"])


@query("""
select doc_id from documents except (select doc_id from labels where quality = 1 union select doc_id from labels where toxic = 1)
""")
def unused_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "labels")
    used = R.union_distinct(made.where("quality = 1").select("doc_id"), made.where("toxic = 1").select("doc_id"))
    return R.difference(table(spark, sf_dir, "documents").select("doc_id"), used)


@query("select doc_id, n_chars from documents where doc_id >= 100 and doc_id <= 160 order by doc_id limit 30")
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.in_range(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", 100, 160, ["doc_id"], 30)


# Range lookups


@query("""
with r(pos, lo, hi, vol) as (values (1, 1, 109, 'v1'), (2, 110, 263, 'v2'), (3, 264, 300, 'v3'), (4, 400, 700, 'v4'))
select doc_id, coalesce((select arg_min(vol, pos) from r where d.doc_id between lo and hi), 'v4') as vol from documents d
""")
def range_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = spark.createDataFrame([(1, 1, 109, "v1"), (2, 110, 263, "v2"), (3, 264, 300, "v3"), (4, 400, 700, "v4")], "pos int, lo int, hi int, vol string")
    return R.range_lookup(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", ranges, ["vol"])


@query("""
with r(pos, spec, image) as (values (1, '1-10', 'a'), (2, '5-20', 'b'), (3, '33', 'c'), (4, 'x-y', 'd'), (5, '30-40', 'e')),
     s as (select pos, image, try_cast(split_part(spec, '-', 1) as int) as lo,
                  case when contains(spec, '-') then try_cast(split_part(spec, '-', 2) as int) else try_cast(spec as int) end as hi from r)
select p_partkey, coalesce((select arg_min(image, pos) from s where p_size between lo and hi), 'fallback') as image from part
""")
def range_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = spark.createDataFrame([(1, "1-10", "a"), (2, "5-20", "b"), (3, "33", "c"), (4, "x-y", "d"), (5, "30-40", "e")], "pos int, spec string, image string")
    lo, hi = T.parse_range(F.col("spec"))
    got = R.range_lookup(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", specs.select("pos", lo.alias("lo"), hi.alias("hi"), "image"), ["image"], "null")
    return got.select("p_partkey", F.coalesce("image", F.lit("fallback")).alias("image"))


@query("""
with r as (select c_custkey as pos, c_acctbal as lo, c_acctbal + c_nationkey * 7.5 as hi, c_name from customer)
select o_orderkey, arg_min(c_name, pos) as c_name from (select o_orderkey, o_totalprice / 40 - 900 as x from orders) left join r on x between lo and hi group by o_orderkey
""")
def range_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of overlapping ranges of balances, negative ones too, that holds a price."""
    ranges = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.col("c_acctbal").alias("lo"), (F.col("c_acctbal") + F.col("c_nationkey") * 7.5).alias("hi"), "c_name")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_totalprice") / 40 - 900).alias("x"))
    return R.range_lookup(rows, "x", ranges, ["c_name"], "null").select("o_orderkey", "c_name")


@query("""
select p_partkey, case when p_size <= 10 then 'small' when p_size <= 30 then 'medium' when p_size <= 45 then 'large' else 'huge' end as kind from part
""")
def legacy_case_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", R.case_ranges(F.col("p_size"), [(10, "small"), (30, "medium"), (45, "large")], "huge").alias("kind"))


# Batches


@query("""
select b as batch, count(*) as n, round(sum(o_totalprice), 2) as total, min(o_orderkey) as first_key
from (select o_orderkey, o_totalprice, (row_number() over (order by o_orderkey) - 1) // 100 as b from orders) group by b
""")
def batches_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = O.batches(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey", 100)
    return rows.groupBy("batch").agg(F.count("*").alias("n"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).cast("double").alias("total"), F.min("o_orderkey").alias("first_key"))


# Scalar text functions

@query(r"""
select p_partkey, substr(regexp_replace(regexp_replace(replace(regexp_replace(trim(regexp_replace(x, '\s+', ' ', 'g')), '[<>:"/\\|?*]', '_', 'g'), ' ', '_'), '_+', '_', 'g'),
       '^[._]+|[._]+$', '', 'g'), 1, 120) as safe from (select p_partkey, '. ' || p_name || ': a/b  "' || p_type || '"?' as x from part)
""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.concat(F.lit(". "), F.col("p_name"), F.lit(': a/b  "'), F.col("p_type"), F.lit('"?'))
    return table(spark, sf_dir, "part").select("p_partkey", T.safe_name(x).alias("safe"))


@query(r"""
select page_id, substr(regexp_replace(replace(regexp_replace(regexp_replace(x, '[^\x00-\x7F]', '?', 'g'), '[<>:"/\\|?*]', '_', 'g'), ' ', '_'), '[^A-Za-z0-9_.\-]', '_', 'g'), 1, 30) as safe
from (select page_id, 'é' || url as x from pages)
""")
def safe_ascii_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", T.safe_ascii(F.concat(F.lit("é"), F.col("url"))).alias("safe"))


@query(r"""
with t as (select p_partkey, p_size, 'Chapter ' || p_size || ': ' || p_size || ': ' || p_name as x, p_size || ': ' || p_name as y, 'Volume ' || p_size || ' - ' || p_name as z from part)
select p_partkey,
       trim(regexp_replace(regexp_replace(x, '(?i)^chapter\s+\d+\s*[:\-]?\s*', ''), '^(?:\s*\d+\s*[:"]\s*)+', '')) as chapter_title,
       regexp_replace(z, '(?i)^\s*(?:chapter|ch\.|vol\.|volume|book|part)\s*\d+\s*[:\-]?\s*', '') as pdf_title,
       trim(regexp_replace(z, '(?i)^(?:volume|book)\s+\d+\s*[:\-]?\s*', '')) as volume_name,
       coalesce(try_cast(nullif(regexp_extract(x, '^\s*(\d+)\s*:', 1), '') as int), try_cast(nullif(regexp_extract(x, '(?i)^\s*chapter\s+(\d+)\b', 1), '') as int)) as from_header,
       coalesce(try_cast(nullif(regexp_extract(y, '^\s*(\d+)\s*:', 1), '') as int), try_cast(nullif(regexp_extract(y, '(?i)^\s*chapter\s+(\d+)\b', 1), '') as int)) as from_number,
       coalesce(nullif(regexp_extract(x, '(?i)chapter\s+(\d+)', 1), ''), nullif(regexp_extract(x, '^\s*(\d+)', 1), ''), '1') as chapter_text,
       coalesce(nullif(regexp_extract(z, '(?i)volume\s+(\d+)', 1), ''), case when contains(lower(z), 'side') and contains(lower(z), 'stories') then 'Side Stories' end, nullif(regexp_extract(z, '^\s*(\d+)', 1), ''), '1') as volume_text from t
""")
def clean_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, name = F.col("p_size").cast("string"), F.col("p_name")
    x, y = F.concat(F.lit("Chapter "), n, F.lit(": "), n, F.lit(": "), name), F.concat(n, F.lit(": "), name)
    z = F.concat(F.lit("Volume "), n, F.lit(" - "), name)
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        T.clean_chapter_title(x).alias("chapter_title"),
        T.clean_title(z).alias("pdf_title"),
        T.clean_volume_name(z).alias("volume_name"),
        T.leading_number(x).alias("from_header"),
        T.leading_number(y).alias("from_number"),
        T.chapter_number_text(x).alias("chapter_text"),
        T.volume_number_text(z).alias("volume_text"),
    )


@query(r"""
select l_orderkey, l_linenumber, case when l_linenumber <= 5 then printf('%02d_%03d_%s', l_linenumber, l_orderkey, l_returnflag) else l_returnflag end as id from lineitem
""")
def chapter_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.when(F.col("l_linenumber") <= 5, F.col("l_linenumber"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.chapter_id(n, F.col("l_orderkey"), F.col("l_returnflag")).alias("id"))


@query(r"""
with t as (select doc_id, n, regexp_extract_all(line, '[A-Za-z0-9]+|[^A-Za-z0-9]+') as ts from LINES),
     c as (select doc_id, n, array_to_string(list_transform(ts, lambda t, i: case
       when t in ('the', 'tHe', 'thE', 'tHE') then 'thee the' when t in ('The', 'THe', 'ThE') then 'Thee the' when t = 'THE' then 'THEE THE'
       when t = 'S' and i > 2 and ts[i - 1] = chr(39) and lower(ts[i - 2]) = 'the' then 's' else t end), '') as out from t)
select doc_id, n, md5(out) as spoken from c
""".replace("LINES", _LINES))
def pronounce(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = lines_of(spark, sf_dir).select("doc_id", F.col("n").cast("long").alias("n"), T.pronounce(F.col("line"), [T.Spoken("the", "thee the")]).alias("out"))
    return got.select("doc_id", "n", F.md5("out").alias("spoken"))


@query("select doc_id, md5(substr(text, 1, 500)) as head, length(substr(text, 1, 500)) as n from documents")
def truncate_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = T.truncate(F.col("text"), 500)
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(cut).alias("head"), F.length(cut).alias("n"))


@query("""
select c_custkey, c_mktsegment || ' - Chapter ' || c_nationkey || ': ' || c_name as title,
       '<speak version=''1.0'' xml:lang=''en-US''><voice name=''v1''>' || replace(replace(replace(c_name || ' <&>', '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</voice></speak>' as ssml from customer
""")
def template_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = T.template("{series} - Chapter {number}: {title}", {"series": F.col("c_mktsegment"), "number": F.col("c_nationkey"), "title": F.col("c_name")})
    return table(spark, sf_dir, "customer").select("c_custkey", title.alias("title"), T.ssml(F.concat(F.col("c_name"), F.lit(" <&>")), "v1").alias("ssml"))


@query(r"""
select o_orderkey, printf('%d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) as clock,
       case o_custkey % 7 when 0 then 'hold-previous' when 1 then 'single' when 5 then 'grid(5)' when 6 then 'grid(6)' else 'row(' || (o_custkey % 7) || ')' end as layout
from (select o_orderkey, o_custkey, cast(round_even(o_totalprice / 4, 0) as bigint) as s from orders)
""")
def clock_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", T.clock(F.col("o_totalprice") / 4).alias("clock"), T.layout(F.col("o_custkey") % 7).alias("layout"))


@query(r"""
select page_id, lower(regexp_replace(x, '[^A-Za-z0-9_ -]', '', 'g')) as slug, regexp_replace('base/' || u, '^[./]+', '') as href, split_part(u, '#', 1) as bare
from (select page_id, url as x, 'a+b c/' || page_id || '.html#f' as u from pages)
""")
def slug_href(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.concat(F.lit("a+b%20c/"), F.col("page_id").cast("string"), F.lit(".html#f"))
    whole = T.resolve_href(F.lit("base/"), u)
    return table(spark, sf_dir, "pages").select("page_id", T.slug(F.col("url")).alias("slug"), whole.alias("href"), F.regexp_replace(T.drop_fragment(whole), "^base/", "").alias("bare"))


# Lines and paragraphs


@query(r"""
with h as (select doc_id, list_filter(string_split(text, chr(10))[1:10], lambda x: regexp_matches(x, '^([A-Z][a-z]+) ([a-z]+)')) as f from documents)
select doc_id, nullif(regexp_extract(f[1], '^([A-Z][a-z]+) ([a-z]+)', 2), '') as second from h
""")
def header_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = r"^([A-Z][a-z]+) ([a-z]+)"
    first = F.try_element_at(F.filter(F.slice(F.split("text", "\n"), 1, 10), lambda x: x.rlike(pattern)), F.lit(1))
    return table(spark, sf_dir, "documents").select("doc_id", T.group(first, pattern, 2).alias("second"))


@query(r"""
with t as (select doc_id, 'Series' || chr(10) || case when doc_id % 3 = 0 then 'Chapter 0: Before' || chr(10) else '' end || '  Chapter ' || (doc_id + case when doc_id % 5 = 0 then 1 else 0 end) || ' : T ' || lang || ' ' || chr(10) || text as text from documents),
     h as (select doc_id, list_filter(string_split(text, chr(10))[1:10], lambda x: regexp_matches(x, '^\s*Chapter\s+(\d+)\s*:\s*(.+?)\s*$') and try_cast(regexp_extract(x, 'Chapter\s+(\d+)', 1) as int) = doc_id)[1] as hit from t)
select doc_id, try_cast(nullif(regexp_extract(hit, 'Chapter\s+(\d+)', 1), '') as int) as header_number, nullif(regexp_extract(hit, '^\s*Chapter\s+\d+\s*:\s*(.+?)\s*$', 1), '') as header_title from h
""")
def header_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    n = (F.col("doc_id") + F.when(F.col("doc_id") % 5 == 0, 1).otherwise(0)).cast("string")
    text = F.concat(F.lit("Series\n"), F.when(F.col("doc_id") % 3 == 0, "Chapter 0: Before\n").otherwise(""), F.lit("  Chapter "), n, F.lit(" : T "), F.col("lang"), F.lit(" \n"), F.col("text"))
    return O.header_scan(docs.select("doc_id", text.alias("text")), "text", r"^\s*Chapter\s+(\d+)\s*:\s*(.+?)\s*$", F.col("doc_id")).select("doc_id", "header_number", "header_title")


@query("""
select doc_id, cast(n as int) as n, contains(lower(line), 'all rights reserved') as legal, contains(lower(line), ' the ') as common
from LINES where contains(lower(line), 'all rights reserved') or contains(lower(line), ' the ')
""".replace("LINES", _LINES))
def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("line")
    return lines_of(spark, sf_dir).where(T.is_noise_line(line, ["all rights reserved", " the "])).select("doc_id", "n", T.is_noise_line(line, ["all rights reserved"]).alias("legal"), T.is_noise_line(line, [" the "]).alias("common"))


@query("""
select doc_id, cast(n as int) as n, md5(line) as h from (select *, lag(line) over (partition by doc_id order by n) as b from LINES) where b is distinct from line
""".replace("LINES", _LINES))
def consecutive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.drop_consecutive(lines_of(spark, sf_dir), "doc_id", "n", "line").select("doc_id", "n", F.md5("line").alias("h"))


@query("""
select doc_id, count(*) as kept, min(n) as first_line from (select *, max(case when length(line) >= 40 then 1 else 0 end) over (partition by doc_id order by n) as seen from LINES)
where seen = 1 group by doc_id
""".replace("LINES", _LINES))
def leading_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = O.trim_leading(lines_of(spark, sf_dir), "doc_id", "n", F.length("line") < 40)
    return kept.groupBy("doc_id").agg(F.count("*").alias("kept"), F.min("n").cast("long").alias("first_line"))


@query(r"""
with l as (select doc_id, n, trim(line) as line, regexp_matches(line, '^[A-Z][a-z]+ (said|thought|wondered)') or length(line) % 3 = 0 as b from LINES),
     i as (select *, sum(case when b or line = '' then 1 else 0 end) over (partition by doc_id order by n) as par from l)
select doc_id, cast(par as bigint) as par, md5(string_agg(line, ' ' order by n)) as h from i where line <> '' group by doc_id, par
""".replace("LINES", _LINES))
def paragraph_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    starts = F.col("line").rlike(r"^[A-Z][a-z]+ (said|thought|wondered)") | (F.length("line") % 3 == 0)
    return O.paragraphs(lines_of(spark, sf_dir), "doc_id", "n", "line", starts).select("doc_id", "par", F.md5("line").alias("h"))


@query(r"""
with w as (select page_id, coalesce(nullif(regexp_extract(html, '(?is)<body[^>]*>(.*)</body>', 1), ''), html) as html from pages),
     b as (select page_id, regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', ' ', 'g') as x from w),
     p as (select page_id, regexp_extract_all(x, '(?is)<p[^>]*>(.*?)</p>', 1) as ps from b),
     t as (select page_id, list_filter(list_transform(ps, lambda q: trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(q, '<[^>]+>', ' ', 'g'),
          '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n\f]+', ' ', 'g'))), lambda q: q <> '') as ps from p)
select page_id, cast(unnest(range(len(ps))) as int) as seq, md5(unnest(ps)) as h from t
""")
def html_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return H.block_rows(table(spark, sf_dir, "pages"), "page_id", H.regex_paragraphs(F.col("html"))).select("page_id", "seq", F.md5("text").alias("h"))


@query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = H.block_rows(table(spark, sf_dir, "pages"), "page_id", H.body_blocks(F.col("html"))["blocks"])
    kept = O.drop_consecutive(rows.where(~T.is_noise_line(F.col("text"), ["all rights reserved"])), "page_id", "seq", "text")
    return kept.select("page_id", "seq", "text")


# Timelines


@query("""
with w as (select conv_id, turn, greatest(1, length(trim(text))) as w from conversations),
     c as (select *, sum(w) over (partition by conv_id order by turn) as e, sum(w) over (partition by conv_id) as t from w),
     k as (select conv_id, 600.0 * (row_number() over (order by conv_id) - 1) as base from (select distinct conv_id from conversations))
select conv_id, turn, round(600.0 * w / t, 4) as share, round(base + 600.0 * (e - w) / t, 4) as start_s, round(base + 600.0 * e / t, 4) as end_s from c join k using (conv_id)
""")
def timeline_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.greatest(F.lit(1), F.length(F.trim("text"))).cast("long").alias("w"))
    totals = rows.groupBy("conv_id").agg(F.sum("w").alias("t"))
    # Whole-number weights are summed, and scaled once, so that the clock doesn't depend on the order of additions.
    clock = O.running_clock(rows.join(totals, "conv_id"), "conv_id", "turn", F.col("w"), totals.select("conv_id", F.lit(0).cast("long").alias("total")))
    base = O.numbered(totals.select("conv_id"), "conv_id").select("conv_id", (F.col("n") * 600.0).alias("base"))
    s = lambda x: F.round(F.col("base") + x * 600.0 / F.col("t"), 4)
    clock = O.allocate(clock, "conv_id", F.col("w"), F.lit(600.0))
    return clock.join(base, "conv_id").select("conv_id", "turn", F.round("share", 4).alias("share"), s(F.col("start")).alias("start_s"), s(F.col("end")).alias("end_s"))


@query("""
select conv_id, turn, coalesce(last_value(v ignore nulls) over (order by conv_id, turn), '(hold previous frame)') as frame
from (select conv_id, turn, case when length(text) % 3 = 0 then substr(text, 1, 12) end as v from conversations)
""")
def hold_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.length("text") % 3 == 0, F.substring("text", 1, 12)).alias("v"))
    return O.hold_previous(rows, "conv_id", "turn", "v", F.lit("(hold previous frame)")).select("conv_id", "turn", F.col("filled").alias("frame"))


@query("""
with r as (select conv_id, turn, role, row_number() over (partition by conv_id order by turn) as k from conversations),
     b as (select conv_id + 1 as conv_id, 'c' || conv_id as extra from (select distinct conv_id from conversations where conv_id % 3 <> 0))
select r.conv_id, turn, case when k = 1 and extra is not null then role || ',' || extra else role end as cast_names from r left join b using (conv_id)
""")
def carry_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    carried = conv.where("conv_id % 3 <> 0").select("conv_id").distinct().select("conv_id", F.array(F.concat(F.lit("c"), F.col("conv_id").cast("string"))).alias("carried"))
    got = O.carry_first(conv.select("conv_id", "turn", F.array("role").alias("names")), carried, "conv_id", "turn", "names")
    return got.select("conv_id", "turn", F.array_join("names", ",").alias("cast_names"))


@query("""
select event_type, count(*) as scenes, min(user_id) as first_user, max(user_id) as last_user, count(distinct user_id) as users,
       array_to_string(list_sort(list(distinct user_id))[1:3], ', ') as some from events group by event_type
""")
def participation(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_type", "user_id")
    counts = events.groupBy("event_type").agg(F.count("*").alias("scenes"), F.min("user_id").alias("first_user"), F.max("user_id").alias("last_user"), F.countDistinct("user_id").alias("users"))
    some = R.first_k(events.distinct(), ["event_type"], ["user_id"], 3).groupBy("event_type").agg(F.array_join(F.transform(F.sort_array(F.collect_list("user_id")), lambda x: x.cast("string")), ", ").alias("some"))
    return counts.join(some, "event_type")


@query("""
with r as (select role, conv_id, turn, substr(text, 1, 5) as setting from conversations),
     f as (select role, conv_id, setting, min(turn) as t from r group by all)
select conv_id, role, count(*) as scenes, array_to_string(list_sort(list(distinct turn)), ',') as chapters,
       (select string_agg(setting, '|' order by t, setting) from f where f.role = r.role and f.conv_id = r.conv_id) as settings
from r group by conv_id, role
""")
def participation_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.struct("conv_id", "role").alias("name"), "turn", F.substring("text", 1, 5).alias("setting"))
    got = R.participation(rows, "name", "turn", "turn", "setting")
    return got.select("name.conv_id", "name.role", "scenes", F.array_join(F.transform("chapters", lambda x: x.cast("string")), ",").alias("chapters"), F.array_join("settings", "|").alias("settings"))


@query("""
select status, count(*) as n, min(doc_id) as first_doc from (select doc_id, case when l.doc_id is not null then 'have' when lang = 'en' and n_chars < 500 then 'background'
   when source in ('src1', 'src2') then 'minor' when n_chars > 5000 then 'declined' else 'need' end as status from documents d left join labels l using (doc_id)) group by status
""")
def status_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("_have"))
    name = F.when((F.col("lang") == "en") & (F.col("n_chars") < 500), "[x]").otherwise("x")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars", "source").join(made, "doc_id", "left")
    status = T.status(F.coalesce("_have", F.lit(False)), name, ~F.col("source").isin("src1", "src2"), F.col("n_chars") > 5000)
    return rows.select("doc_id", status.alias("status")).groupBy("status").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("""
with t as (select conv_id, turn, split_part(text, ' ', 1) as name from conversations), b as (select conv_id, text from conversations where turn = 1)
select t.conv_id, turn, coalesce(contains(lower(b.text), lower(name)), false) as exact,
       coalesce(len(list_filter(regexp_extract_all(lower(name), '[a-z'']+'), lambda w: length(w) > 2 and contains(lower(b.text), w))) > 0, false) as by_word
from t left join b using (conv_id)
""")
def grounding_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    tags = conv.select("conv_id", "turn", F.substring_index("text", " ", 1).alias("name"))
    return R.grounded(tags, conv.where("turn = 1").select("conv_id", "text"), "conv_id", "name", "text").select("conv_id", "turn", "exact", "by_word")


# Ledgers


@query("""
with r as (select user_id, event_id, event_type, value, row_number() over (partition by user_id order by case when event_type = 'purchase' then 0 else 1 end, event_id) as k
           from events where event_type in ('purchase', 'view'))
select user_id, event_id, event_type, round(value, 6) as value from r where k = 1
""")
def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "view")).select("user_id", "event_id", "event_type", F.round("value", 6).alias("value"))
    return L.upsert(log, "user_id", "event_id", F.col("event_type") == "view")


@query("""
select user_id, count(*) filter (where event_type = 'error') as n_failures, min(event_id) filter (where event_type = 'error') as first_failure
from events group by user_id having count(*) filter (where event_type = 'error') between 1 and 15 and count(*) filter (where event_type = 'purchase' and value > 190) = 0
""")
def ledger_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return L.retryable(table(spark, sf_dir, "events"), "user_id", "event_id", (kind == "purchase") & (F.col("value") > 190), kind == "error", 16)


@query("""
select user_id, bool_or(event_type = 'purchase') as completed, bool_or(event_type = 'purchase' and value > 50) as completed_real,
       bool_or(event_type = 'purchase' and value <= 50) as dry_run_completed, count(*) filter (where event_type = 'error') as n_failures,
       count(*) filter (where event_type = 'error') > 0 and not bool_or(event_type = 'purchase') as failed from events group by user_id
""")
def ledger_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return L.states(table(spark, sf_dir, "events"), "user_id", kind == "purchase", F.col("value") <= 50, kind == "error")


@query("""
select event_id, user_id, row_number() over (partition by user_id order by event_id) - 1 as retry_count from events where event_type = 'error'
""")
def ledger_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id")
    return L.failures(log, "user_id", "event_id").withColumn("retry_count", F.col("retry_count").cast("long"))


@query("""
select c_custkey, c_name from customer c where not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_orderstatus = 'F')
  and not exists (select 1 from orders o where o.o_custkey = c.c_custkey and o_totalprice > 100000) order by c_custkey limit 1
""")
def ledger_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return L.next_item(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), orders.where("o_orderstatus = 'F'"), orders.where("o_totalprice > 100000"), ["c_custkey"], ["c_custkey"])


#: SQL for a gate with a gap in seconds: KEY's events one after the other.
_GATE = """
with recursive e as (select event_id, KEY as k, ts, row_number() over (partition by KEY order by ts, event_id) as i from events),
     a as (select k, i, ts from e where i = 1 union all select a.k, n.i, n.ts from a join lateral (select e.i, e.ts from e where e.k = a.k and e.ts >= a.ts + to_seconds(GAP) order by e.i limit 1) n on true),
     g as (select e.event_id, e.ts, a.i is not null as allowed, last_value(a.ts ignore nulls) over (partition by e.k order by e.i) as l from e left join a on a.k = e.k and a.i = e.i)
select event_id, allowed, case when allowed then 0 else (GAP * 1000000::bigint - (epoch_us(ts) - epoch_us(l))) / 1e6 end as wait_seconds from g
"""


@query(_GATE.replace("KEY", "user_id").replace("GAP", "600"))
def rate_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = G.rate_gate(table(spark, sf_dir, "events").select("event_id", "user_id", "ts"), "user_id", "ts", None, ("event_id",))
    return got.select("event_id", "allowed", "wait_seconds")


@query(_GATE.replace("KEY", "event_type").replace("GAP", "43200"))
def gated_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One event of each type in twelve hours, and how long the others wait."""
    got = G.rate_gate(table(spark, sf_dir, "events").select("event_id", "event_type", "ts"), "event_type", "ts", 1 / 12, ("event_id",))
    return got.select("event_id", "allowed", "wait_seconds")


@query("""
select coalesce(a.doc_id, b.doc_id) as doc_id, case when a.doc_id is not null and b.doc_id is not null then 'verified' when b.doc_id is null then 'missing_on_remote' else 'missing_in_ledger' end as status
from (select doc_id + 3 as doc_id from documents) a full outer join (select doc_id from labels) b on a.doc_id = b.doc_id
""")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.reconcile(table(spark, sf_dir, "documents").select((F.col("doc_id") + 3).alias("doc_id")), table(spark, sf_dir, "labels"), "doc_id")


@query("""
select s.range as source, a.doc_id is not null as has_source, b.doc_id is not null as has_target,
       case when a.doc_id is null then 'source missing' when b.doc_id is null then 'target missing' end as skip_reason
from (select unnest(range(min(doc_id), max(doc_id) + 1)) as range from labels) s left join labels a on a.doc_id = s.range left join labels b on b.doc_id = s.range + 1
""")
def link_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    lo, hi = labels.agg(F.min("doc_id"), F.max("doc_id")).first()
    got = R.link_plan(labels, "doc_id", "quality", lo or 0, -1 if hi is None else hi)
    return got.select("source", F.col("source_value").isNotNull().alias("has_source"), F.col("target_value").isNotNull().alias("has_target"), "skip_reason")


# Outlines and numbering

_OUTLINE = "(select user_id as doc, event_id as seq, cast(floor(value) as int) as page, case when event_type in ('signup', 'error') then 0 else 1 end as level from events)"


def outline_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("event_type").isin("signup", "error"), 0).otherwise(1)
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("seq"), F.floor("value").cast("int").alias("page"), level.alias("level"))


@query("""
with o as OUTLINE
select doc, seq, coalesce((select arg_min(n.page, n.seq) - 1 from o n where n.doc = o.doc and n.seq > o.seq and n.level <= o.level), 999999) as end_page,
       (select max(n.seq) from o n where n.doc = o.doc and n.seq <= o.seq and n.level = 0) as volume_seq from o
""".replace("OUTLINE", _OUTLINE))
def outline_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.outline_ends(O.volumes_of(outline_of(spark, sf_dir), "doc"), "doc").select("doc", "seq", "end_page", "volume_seq")


@query("""
with o as OUTLINE select doc, seq, case when page < 10 or page > 40 then 10 else page end as clip_start, least(page + level * 3, 40) as clip_end,
  case when (case when page < 10 or page > 40 then 10 else page end) > least(page + level * 3, 40) then 'failed' when page < 10 or page > 40 then 'moved' else 'ok' end as status from o
""".replace("OUTLINE", _OUTLINE))
def outline_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outline_of(spark, sf_dir).withColumns({"start": F.col("page"), "end": F.col("page") + F.col("level") * 3, "volume_start": F.lit(10), "volume_end": F.lit(40)})
    return O.clip_slices(rows).select("doc", "seq", "clip_start", "clip_end", "status")


@query("""
with o as (select *, lead(level) over (partition by doc order by seq) as nx from OUTLINE)
select count(*) as entries, count(*) filter (where level = 0) as top_level, count(*) filter (where level = 0 and nx > 0) as structural, count(*) filter (where level > 0) as chapters from o
""".replace("OUTLINE", _OUTLINE))
def toc_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = outline_of(spark, sf_dir).withColumn("nx", F.lead("level").over(W.partitionBy("doc").orderBy("seq")))
    return rows.agg(F.count("*").alias("entries"), F.count_if(F.col("level") == 0).alias("top_level"), F.count_if((F.col("level") == 0) & (F.col("nx") > 0)).alias("structural"), F.count_if(F.col("level") > 0).alias("chapters"))


@query("""
with f as (select user_id, event_id, case when event_type = 'signup' then 1 else 0 end as h from events),
     g as (select *, lag(h) over (partition by user_id order by event_id) as b from f),
     v as (select *, 1 + sum(case when h = 1 and b = 0 then 1 else 0 end) over (partition by user_id order by event_id) as volume from g)
select user_id, event_id, cast(volume as int) as volume, cast(row_number() over (partition by user_id, volume order by event_id) as int) as chapter from v where h = 0
""")
def stateful_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type")
    return O.restart_numbers(rows, "user_id", "event_id", F.col("event_type") == "signup").select("user_id", "event_id", "volume", "chapter")


@query("""
with e as (select user_id, event_id, case when value > 100 then cast(floor(value) as bigint) end as p from events),
     u as (select *, coalesce(sum(case when p is null then 1 else 0 end) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) as u from e)
select user_id, event_id, cast(coalesce(p, u + greatest(1, coalesce(max(p + 1 - u) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 1))) as bigint) as number from u
""")
def fallback_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("value") > 100, F.floor("value").cast("long")).alias("p"))
    return O.fallback_numbers(rows, "user_id", "event_id", "p").select("user_id", "event_id", "number")


@query("""
select coalesce(a.doc_id, b.doc_id) as name, coalesce(b.quality = 1, a.n_chars > 1000) as available from documents a full outer join labels b on a.doc_id = b.doc_id
""")
def image_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    scraped = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("name"), (F.col("n_chars") > 1000).alias("viable"))
    curated = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("name"), (F.col("quality") == 1).alias("viable"))
    return R.availability(scraped, curated)


@query("""
select source, doc_id, cast(k as int) as rank from (select source, doc_id, row_number() over (partition by source order by doc_id) as k from documents) where k <= 3
""")
def top_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.first_k(table(spark, sf_dir, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 3)


@query("select o_custkey, count(*) as n from orders group by o_custkey having count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.duplicates(table(spark, sf_dir, "orders"), ["o_custkey"])


@query("""
select c.c_custkey, coalesce(n.n_name, c.c_mktsegment) as label from (select c_custkey, c_mktsegment, case when c_custkey % 2 = 0 then c_nationkey end as k from customer) c left join nation n on n.n_nationkey = c.k
""")
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.col("c_mktsegment")).alias("label"))
    return R.lookup(rows, "label", table(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey").cast("string")), "k", "n_name")


@query("""
select c_custkey, coalesce(a.n_name, b.r_name) as label, coalesce(a.n_name, b.r_name) is null as to_create from (select c_custkey, c_nationkey + 10 as k from customer) c
left join (select n_nationkey as k, n_name from nation) a using (k) left join (select r_regionkey + 30 as k, r_name from region) b using (k)
""")
def resolve_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_nationkey") + 10).alias("k"))
    a = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("label"))
    b = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 30).alias("k"), F.col("r_name").alias("label"))
    return R.resolve_in_order(rows, "k", [a, b], "label").select("c_custkey", "label", "to_create")


@query(r"""
with t as (select c_custkey, c_nationkey as k, case when c_nationkey % 4 = 0 then c_mktsegment else 'Chapter ' || c_nationkey || ': ' || c_name end as title from customer)
select c_custkey, title, regexp_replace(lower(trim(case when k = 3 then '  Title   Page' else title end)), '\s+', ' ', 'g') in ('information', 'cover', 'copyright', 'metadata', 'title page') as noise,
       regexp_matches(title, '(?i)\bchapter\b|\d') as chapter, regexp_matches(case when k = 5 then 'Volume 2 ' || title when k = 6 then 'The Book of ' || title else title end, '(?i)^\s*volume\s+\d+')
       or (k % 2 = 0 and regexp_matches(case when k = 6 then 'The Book of ' || title else title end, '(?i)\b(?:volume|book)\b')) as volume from t
""")
def toc_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_nationkey")
    title = F.when(k % 4 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("Chapter "), k.cast("string"), F.lit(": "), F.col("c_name")))
    front = F.when(k == 3, "  Title   Page").otherwise(title)
    head = F.when(k == 5, F.concat(F.lit("Volume 2 "), title)).when(k == 6, F.concat(F.lit("The Book of "), title)).otherwise(title)
    return table(spark, sf_dir, "customer").select("c_custkey", title.alias("title"), T.is_toc_noise(front).alias("noise"), T.looks_like_chapter(title).alias("chapter"), T.is_volume_title(head, k % 2).alias("volume"))
