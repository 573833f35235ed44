"""Queries over derived listings: files, images, jobs and registries made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chapters as C
from quire.operators import ledger as L
from quire.operators import names as N
from quire.operators import relational as R
from quire.plans.catalogue import _LINES, lines_of, query, table
from quire.sources import files as S


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing: a folder for each source, a file for each document."""
    docs = table(spark, sf_dir, "documents")
    n = F.col("doc_id").cast("string")
    folder = F.when(F.col("source") == "src3", "Side_Stories").when(F.col("source") == "src4", "notes").otherwise(F.concat(F.substring("source", 4, 3), F.lit("_"), F.col("lang")))
    name = F.when(F.col("doc_id") % 11 == 0, F.concat(F.lit("readme_"), n, F.lit(".txt"))).when(F.col("doc_id") % 13 == 0, F.concat(F.lit("Chapter_"), n, F.lit(".md"))).otherwise(F.concat(F.lit("Chapter_"), n, F.lit("_The_"), F.col("lang"), F.lit(".txt")))
    return docs.select(folder.alias("folder"), name.alias("filename"), F.concat(folder, F.lit("/"), name).alias("path"), F.octet_length("text").cast("long").alias("size"), F.col("text").alias("content"))


_FILES = """(select folder, filename, folder || '/' || filename as path, size from (select case when source = 'src3' then 'Side_Stories' when source = 'src4' then 'notes' else substr(source, 4, 3) || '_' || lang end as folder,
  case when doc_id % 11 = 0 then 'readme_' || doc_id || '.txt' when doc_id % 13 = 0 then 'Chapter_' || doc_id || '.md' else 'Chapter_' || doc_id || '_The_' || lang || '.txt' end as filename,
  strlen(text) as size from documents))"""


@query(r"""
select filename, path as file_path, case when folder = 'Side_Stories' then 9 else try_cast(regexp_extract(folder, '^(\d+)', 1) as int) end as volume_number,
       cast(regexp_extract(filename, '(?i)Chapter_(\d+)', 1) as int) as chapter_number, 'The ' || regexp_extract(filename, '_The_([a-z]+)', 1) as chapter_title, size as file_size
from FILES where filename like 'Chapter%.txt' and folder <> 'notes'
""".replace("FILES", _FILES))
def discover_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.catalogue(_listing(spark, sf_dir)).drop("volume_name", "is_readable")


@query("select distinct regexp_replace(filename, '\\.md$', '.txt') as filename from FILES where size > 0 and filename like '%.md'".replace("FILES", _FILES))
def artefact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.artefacts(_listing(spark, sf_dir), ".md")


@query(r"""
select regexp_replace(filename, '\.txt$', '.mp4') as filename, coalesce(try_cast(nullif(regexp_extract(filename, '(?i)Chapter_(\d+)', 1), '') as int), 0) as chapter_number,
       case when regexp_matches(folder, '^\d+_') then cast(regexp_extract(folder, '^(\d+)_', 1) as int) else 1 end as volume_number,
       case when regexp_matches(folder, '^\d+_') then regexp_extract(folder, '^\d+_(.+)$', 1) else 'Unknown' end as volume_name
from FILES where filename like '%.txt'
""".replace("FILES", _FILES))
def video_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    swapped = _listing(spark, sf_dir).withColumn("filename", T.swap_extension(F.col("filename"), ".txt", ".mp4"))
    return S.videos(swapped).select("filename", "chapter_number", "volume_number", "volume_name")


@query(r"""
with i as (select p_partkey, p_size as width, cast(floor(p_retailprice) as int) % 60 as height, case when p_partkey % 5 = 0 then replace(p_name, ' ', '_') || '_Official_(Crop).png'
   when p_partkey % 3 = 0 then replace(p_name, ' ', '_') || '_Official.jpg' else p_name || '.gif' end as f from part)
select p_partkey, replace(regexp_extract(f, '^(.+)_Official\.', 1), '_', ' ') as name, height >= width as row_viable from i where regexp_matches(f, '_Official\.(jpg|jpeg|png)$')
""")
def official_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    plain = F.translate("p_name", " ", "_")
    f = F.when(F.col("p_partkey") % 5 == 0, F.concat(plain, F.lit("_Official_(Crop).png"))).when(F.col("p_partkey") % 3 == 0, F.concat(plain, F.lit("_Official.jpg"))).otherwise(F.concat("p_name", F.lit(".gif")))
    rows = part.select("p_partkey", F.col("p_size").alias("width"), (F.floor("p_retailprice").cast("int") % 60).alias("height"), f.alias("file"))
    return R.official_images(rows, "file", ["no such name"]).select("p_partkey", "name", "row_viable")


@query("""
select o_orderkey, case when o_custkey % 10 = 0 then 'unresolved' when o_orderstatus = 'F' or o_orderkey in (5, 6, 7) then null else 'not unlisted' end as skip_reason from orders
""")
def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "unlisted").otherwise("public")
    return table(spark, sf_dir, "orders").select("o_orderkey", R.eligible(status, F.col("o_orderkey"), [5, 6, 7], F.col("o_custkey") % 10 != 0).alias("skip_reason"))


@query(r"""
select c_custkey, len(list_filter(regexp_extract_all('see Chapter 00' || c_nationkey || ', chapter' || (c_nationkey + 1) || '9 page 3', '(?i)Chapter\s*(\d+)', 1), lambda x: cast(x as int) = c_custkey % 25)) > 0 as hit from customer
""")
def label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("see Chapter 00"), F.col("c_nationkey").cast("string"), F.lit(", chapter"), (F.col("c_nationkey") + 1).cast("string"), F.lit("9 page 3"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.has_number(text, (F.col("c_custkey") % 25).cast("int")).alias("hit"))


@query("""
select user_id as job_id, event_id as item, event_type <> 'error' as ok from events where event_type in ('error', 'view', 'purchase')
""")
def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    jobs = table(spark, sf_dir, "events").where(kind.isin("error", "view", "purchase")).groupBy(F.col("user_id").alias("job_id")).agg(F.collect_list(F.when(kind != "error", F.col("event_id"))).alias("successful"), F.collect_list(F.when(kind == "error", F.col("event_id"))).alias("failed"))
    return L.outcomes(jobs, "item").select("job_id", "item", "ok")


@query("""
select user_id, arg_max(event_type, event_id) as event_type, max(event_id) as event_id from events group by user_id
""")
def latest_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type").withColumn("seq", F.col("event_id"))
    return L.latest(log, "user_id", "seq").select("user_id", "event_type", "event_id")


@query("""
with l as (select user_id, arg_max(case event_type when 'purchase' then 'Succeeded' when 'error' then 'Failed' else 'Running' end, event_id) as status, min(ts) as started from events group by user_id)
select user_id, status, status in ('Succeeded', 'Failed') as finished, status = 'Succeeded' as succeeded, status = 'Running' and (epoch_us(timestamp '2024-01-30') - epoch_us(started)) / 6e7 > 41700 as timed_out from l
""")
def job_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("event_type") == "purchase", "Succeeded").when(F.col("event_type") == "error", "Failed").otherwise("Running")
    log = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", status.alias("state"))
    got = L.job_states(log, "user_id", "event_id", "state", F.lit("2024-01-30 00:00:00").cast("timestamp_ntz"), "ts", 41700)
    return got.select("user_id", "status", "finished", "succeeded", "timed_out")


@query("""
select coalesce(d.doc_id, l.doc_id) as doc_id, d.lang, coalesce(l.quality, 0 * d.doc_id) as quality from documents d full outer join (select doc_id + 5 as doc_id, quality from labels) l using (doc_id)
""")
def partial_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(0).cast("long").alias("quality"))
    update = table(spark, sf_dir, "labels").select((F.col("doc_id") + 5).alias("doc_id"), F.col("quality").cast("long").alias("quality"))
    return L.merge_fields(base, update, "doc_id", ["quality"])


@query("""
with n as (select distinct c_mktsegment as name from customer), i as (select r_name as name, 'img' || r_regionkey as image from region),
     o as (select * from (values ('BUILDING', 'ASIA'), ('MACHINERY', 'EUROPE'), ('FURNITURE', 'nowhere')) t(name, use))
select n.name, i.image, i.image is not null as has_image from n left join o using (name) left join i on i.name = coalesce(o.use, n.name)
""")
def registry_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name")).distinct()
    images = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.concat(F.lit("img"), F.col("r_regionkey").cast("string")).alias("image"))
    return R.registry_coverage(names, images, spark.createDataFrame([("BUILDING", "ASIA"), ("MACHINERY", "EUROPE"), ("FURNITURE", "nowhere")], "name string, use string"))


@query("""
select c.c_custkey, min(o.o_orderkey) as o_orderkey from customer c left join orders o on o.o_custkey = c.c_custkey group by c.c_custkey
""")
def source_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return R.first_source(table(spark, sf_dir, "customer").select("c_custkey"), orders, ["c_custkey"], "o_orderkey")


@query("""
with a as (select user_id, event_id, 0 as p from events where event_type = 'signup' and value > 190), b as (select user_id, event_id, 1 as p from events where event_type = 'purchase'), u as (select * from a union all select * from b)
select user_id, event_id from u where p = (select min(p) from u v where v.user_id = u.user_id)
""")
def toc_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    first = events.where("event_type = 'signup' AND value > 190").select("user_id", "event_id")
    return R.first_non_empty([first, events.where("event_type = 'purchase'").select("user_id", "event_id")], ["user_id"])


@query("""
select count(*) as records, sum(o_totalprice > 300000) as large, round(sum(size) / 1048576.0, 2) as mb, arg_max(o_orderkey, size) as largest
from (select o_orderkey, o_totalprice, o_orderkey * 1000 as size from orders)
""")
def ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderkey") * 1000).alias("size"))
    return rows.agg(F.count("*").alias("records"), F.count_if(F.col("o_totalprice") > 300000).alias("large"), T.megabytes(F.sum("size")).alias("mb"), F.max_by("o_orderkey", "size").alias("largest"))


@query("""
select 'Chapter ' || doc_id || ': ' || lang as header, md5('Series' || chr(10) || 'Chapter ' || doc_id || ': ' || lang || chr(10) || '' || chr(10) || text) as content from documents
""")
def chapter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select(T.header_line(F.col("doc_id"), F.col("lang")).alias("header"), F.md5(S.chapter_content(F.lit("Series"), F.col("doc_id"), F.col("lang"), F.col("text"))).alias("content"))


@query("""
select '| ' || n_nationkey || ' | ' || n_name || ' | ' || coalesce(nullif(n_regionkey, 0)::varchar, '–') || ' |' as line from nation
""")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.nullif("n_regionkey", F.lit(0)).alias("region"))
    return S.markdown_rows(rows, ["n_nationkey", "n_name", "region"])


# Chapters


_ECHO = """case c_custkey % 11 when 0 then 'Chapter 5: Other' when 1 then 'Chapter ' || c_nationkey || ' - 2 men walked in' when 2 then 'CHAPTER 4 ' || chr(8722) || ' 2' when 3 then ' ' || lower(c_mktsegment) || '  '
  when 4 then c_nationkey || ' ' || c_mktsegment when 5 then c_nationkey || ': ' || c_mktsegment when 6 then 'Chapter 4 ' || chr(8211) || ' 7: x' when 7 then 'Chapter 5: ' || repeat('long ', 60) when 8 then c_mktsegment || ' and more'
  when 9 then '   ' else 'chapter  ' || c_nationkey || ': ' || c_mktsegment end"""


@query(r"""
with t as (select c_custkey, c_nationkey as n, c_mktsegment as title, ECHO as text from customer), s as (select *, trim(regexp_replace(text, '\s+', ' ', 'g')) as p from t)
select c_custkey, p = '' or (length(p) < 280 and (regexp_matches(p, '(?i)^chapter\s+\d+\s*:') or regexp_matches(p, '(?i)^chapter\s+\d+\s*[\-\x{2010}-\x{2014}\x{2212}]\s*\d+\s*(?::|$)') or lower(p) in (lower(n || ' ' || title), lower(n || ': ' || title))))
       or lower(p) in (lower(title), lower('chapter ' || n || ': ' || title)) as echo from s
""".replace("ECHO", _ECHO))
def echo_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", T.echoes_title(F.expr(_ECHO.replace("chr(8722)", "decode(unhex('E28892'), 'UTF-8')").replace("chr(8211)", "decode(unhex('E28093'), 'UTF-8')")), F.col("c_nationkey"), F.col("c_mktsegment")).alias("echo"))


@query()
def chapter_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The body of every page as a chapter, with its host as the title."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html", F.parse_url("url", F.lit("HOST")).alias("title"))
    return C.bodies(pages, "page_id", "html", "page_id", "title", ["all rights reserved"])


@query(r"""
select 'Volume_' || p_size || '_' || replace(p_brand, '#', '#') || '/Chapter_' || p_partkey || '_' || replace(p_name, ' ', '_') || '.txt' as path, md5('Series' || chr(10) || 'Chapter ' || p_partkey || ': ' || p_name || chr(10) || chr(10) || p_type) as content from part
""")
def chapter_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = C.files(table(spark, sf_dir, "part"), "p_size", "p_brand", "p_partkey", "p_name", F.lit("Series"), "p_type")
    return got.select("path", F.md5("content").alias("content"))


_TITLED = "(select user_id as doc, event_id as seq, case when event_type = 'view' then 'Cover ' else 'Part ' end || event_id as title, case when event_type in ('signup', 'view') and user_id % 3 > 0 then 0 else 1 end as level from events)"


@query("""
with o as (select *, case when level = 0 and not contains(lower(title), 'cover') then 'volume' when level > 0 then 'chapter' end as k from OUTLINE),
     h as (select doc, count(*) filter (where k = 'volume') > 1 and count(*) filter (where k = 'chapter') > 0 as h from o group by doc)
select doc, seq, case when h then k else 'single' end as kind from o join h using (doc)
""".replace("OUTLINE", _TITLED))
def outline_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    title = F.concat(F.when(kind == "view", "Cover ").otherwise("Part "), F.col("event_id").cast("string"))
    level = F.when(kind.isin("signup", "view") & (F.col("user_id") % 3 > 0), 0).otherwise(1)
    return C.split_outline(table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("seq"), title.alias("title"), level.alias("level")), "doc").select("doc", "seq", "kind")


@query("select doc_id, cast(n + 1 as int) as scene, md5(line) as h from LINES".replace("LINES", _LINES))
def scene_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("line"))).alias("scenes"))
    return C.scenes(docs, "doc_id", "scenes").select("doc_id", "scene", F.md5("line").alias("h"))


@query("""
select case when event_type like 'p%' then 'p' else event_type end as name, count(*) as scenes, min(event_id) as first from events group by 1
""")
def scene_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = C.scene_index(table(spark, sf_dir, "events").select(F.col("event_type").alias("name"), "event_id"), "name", "p", ["event_id"])
    return got.select("name", "scenes", F.col("first.event_id").alias("first"))


_TAGS = "(select conv_id, turn, case when turn % 5 = 4 then '[' || role || ']' when turn % 5 = 3 then 'nobody here' else split_part(text, ' ', 2) || ' zzz' end as name from conversations)"


@query(r"""
with t as TAGS, r as (select *, case when name = 'nobody here' and conv_id % 2 = 0 then 'Qqq' else name end as n from t), b as (select conv_id, lower(text) as b from conversations where turn = 0),
     j as (select r.*, coalesce(b, '') as b, regexp_extract_all(n, '[A-Za-z'']+') as ws from r left join b using (conv_id)),
     v as (select case when name like '[%' then 'skipped' when contains(b, lower(n)) then 'grounded' when len(list_filter(ws, lambda w: length(w) > 2 and contains(b, lower(w)))) > 0 then case when n in (select split_part(text, ' ', 2) || ' zzz' from conversations where turn = 1) then 'canonical' else 'invented' end
       when name = 'nobody here' and conv_id % 4 = 0 then 'verified' else 'notfound' end as k from j)
select count(*) filter (where k = 'grounded') as grounded, count(*) filter (where k = 'canonical') as canonical, count(*) filter (where k = 'verified') as verified, count(*) filter (where k = 'invented') as invented,
       count(*) filter (where k = 'notfound') as notfound, count(*) filter (where k = 'skipped') as skipped, count(*) filter (where k <> 'skipped') as total from v
""".replace("TAGS", _TAGS))
def verify_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations")
    second = F.concat(F.split_part("text", F.lit(" "), F.lit(2)), F.lit(" zzz"))
    name = F.when(F.col("turn") % 5 == 4, F.concat(F.lit("["), F.col("role"), F.lit("]"))).when(F.col("turn") % 5 == 3, "nobody here").otherwise(second)
    tags = conv.select("conv_id", "turn", name.alias("name"), (F.col("conv_id") % 2 == 0).alias("_even"))
    # An alias holds in even conversations only; the tag is renamed before, so that both names come through the table of aliases.
    tags = tags.withColumn("name", F.when((F.col("name") == "nobody here") & F.col("_even"), "somebody").otherwise(F.col("name"))).drop("_even")
    aliases = spark.createDataFrame([("somebody", "Qqq")], "alias string, canonical string")
    confirmed = conv.where("conv_id % 4 = 0").select("conv_id", F.lit("somebody").alias("name"))
    known = conv.where("turn = 1").select(second.alias("name"))
    return C.tally(C.verify_tags(tags, conv.where("turn = 0").select("conv_id", "text"), ["conv_id"], "name", "text", aliases, [], known, confirmed))


@query("select event_id from events where coalesce(event_type <> 'error', true)")
def ledger_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.cleared(table(spark, sf_dir, "events"), F.col("event_type") == "error").select("event_id")


@query("""
with d as (select doc_id, lang, cast(null as varchar) as video from documents), u as (select doc_id + 5 as doc_id, 'v' || quality as video from labels), a as (select doc_id, 'audio' as lang from (select distinct doc_id + 2 as doc_id from labels))
select coalesce(d.doc_id, u.doc_id) as doc_id, case when d.doc_id is null then a.lang else d.lang end as lang, u.video from d full outer join u on d.doc_id = u.doc_id left join a on a.doc_id = coalesce(d.doc_id, u.doc_id)
""")
def video_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(None).cast("string").alias("video"))
    labels = table(spark, sf_dir, "labels")
    update = labels.select((F.col("doc_id") + 5).alias("doc_id"), F.concat(F.lit("v"), F.col("quality").cast("string")).alias("video"))
    audio = labels.select((F.col("doc_id") + 2).alias("doc_id"), F.lit("audio").alias("lang"))
    return L.finished_videos(base, update, audio, "doc_id", ["video"], ["lang"])


@query("""
select n_name, cast(row_number() over (order by case n_regionkey when 2 then 1 when 0 then 2 else 3 end, n_nationkey % 3 desc, lower(n_name), n_name) - 1 as bigint) as place from nation
""")
def report_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").select("n_name", F.col("n_regionkey").cast("string").alias("status"), (F.col("n_nationkey") % 3).alias("n"))
    placed = C.report_order(rows, "status", ["2", "0"], "n", "n_name").coalesce(1).withColumn("place", F.monotonically_increasing_id())  # 25 rows
    return placed.select("n_name", "place")


@query("select doc_id from documents except select doc_id from labels")
def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.download_plan(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@query("select o_custkey, cast((dense_rank() over (order by o_custkey) - 1) // 50 as bigint) as batch from (select distinct o_custkey from orders)")
def fetch_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.fetch_batches(table(spark, sf_dir, "orders"), "o_custkey").select("o_custkey", "batch")


@query(r"""
with l as (select doc_id, n, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') as line from LINES), h as (select *, n < 3 and (line like 'The%' or line like 'Is%') as head from l),
     s as (select *, line = '' or (regexp_matches(line, '^["“]') and not regexp_matches(line, '^["“].*["”]')) or regexp_matches(line, '^[A-Z][a-z]+ (said|thought|wondered)\b') as b from h where not head),
     i as (select *, sum(case when b then 1 else 0 end) over (partition by doc_id order by n) as par from s)
select doc_id, n as par, md5(line) as h, true as head from h where head union all select doc_id, cast(par + 3 as bigint), md5(string_agg(line, ' ' order by n)), false from i where line <> '' group by doc_id, par
""".replace("LINES", _LINES))
def spoken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = C.spoken_lines(lines_of(spark, sf_dir), "doc_id", "n", "line", ["The", "Is"])
    return got.select("doc_id", "par", F.md5("line").alias("h"), "head")


@query(r"""
with t as (select conv_id, turn, turn * 70 as a, turn * 70 + 65 as b, case when turn % 2 = 0 then [role, 'x'] else [] end as names from conversations)
select '| ' || printf('%d:%02d:%02d', a // 3600, a % 3600 // 60, a % 60) || '–' || printf('%d:%02d:%02d', b // 3600, b % 3600 // 60, b % 60) || ' | ' || turn || ' | ' || case when len(names) = 0 then '–' else array_to_string(names, ', ') end
       || ' | ' || case when len(names) = 0 then 'hold-previous' else 'row(2)' end || ' | c' || conv_id || ' |' as line from t
""")
def timeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    rows = table(spark, sf_dir, "conversations").select((turn * 70).alias("a"), (turn * 70 + 65).alias("b"), turn.alias("scene"), F.when(turn % 2 == 0, F.array("role", F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("names"), F.concat(F.lit("c"), F.col("conv_id").cast("string")).alias("setting"))
    return C.timeline_rows(rows, "a", "b", "scene", "names", "setting")


@query("""select '{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":"' || role || '"}' as line from conversations""")
def timeline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.timeline_json(table(spark, sf_dir, "conversations"), ["conv_id", "turn", "role"])


@query("""
select r_name as name, 'img' || r_regionkey as image from region where r_name not in ('AFRICA') and r_regionkey not in (select n_regionkey from nation where n_nationkey % 2 = 0 and n_regionkey < 2)
""")
def unused_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.concat(F.lit("img"), F.col("r_regionkey").cast("string")).alias("image"))
    used = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0 AND n_regionkey < 2").select(F.concat(F.lit("img"), F.col("n_regionkey").cast("string")).alias("image"))
    return R.unused_images(images, used, ["AFRICA"])


@query("""
select doc_id, coalesce(c, lang) as lang from documents left join (values ('de', 'german'), ('fr', 'french')) a(l, c) on a.l = lang where coalesce(c, lang) <> 'es'
""")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = spark.createDataFrame([("de", "german"), ("fr", "french")], "alias string, canonical string")
    return R.aliased(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", aliases, ["es"])


@query(r"""
with t as (select p_partkey, p_size, p_name, case when p_partkey % 7 = 0 then 'The Side and Other Stories' else 'Vol. 2: ' || p_name end as title from part),
     n as (select *, substr(regexp_replace(replace(regexp_replace(regexp_replace(title, '(?i)^\s*(?:chapter|ch\.|vol\.|volume|book|part)\s*\d+\s*[:\-]?\s*', ''), '[<>:"/\\|?*]', '_', 'g'), ' ', '_'), '[^A-Za-z0-9_.\-]', '_', 'g'), 1, 30) as safe from t)
select p_partkey, case when p_size % 2 = 0 and p_partkey % 7 = 0 then 'Side_Stories.txt' when p_size % 2 = 0 then 'Volume_' || p_size || '_' || safe || '.txt' else 'Chapter_' || p_partkey || '_' || safe || '.txt' end as file,
       case when p_partkey % 7 = 0 then 'Side_Stories' else 'Volume_' || p_size || '_' || safe end as folder, replace(p_name, ' ', '_') || case p_size % 3 when 0 then '.png' when 1 then '.webp' else '.jpg' end as asset,
       p_name || '_1920x1080.png' as resized, 'tool|-i|' || p_name || '.png|size=' || p_size as command from n
""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key, name = F.col("p_size"), F.col("p_partkey"), F.col("p_name")
    title = F.when(key % 7 == 0, "The Side and Other Stories").otherwise(F.concat(F.lit("Vol. 2: "), name))
    mime = F.when(size % 3 == 0, "image/png").when(size % 3 == 1, "image/webp").otherwise("image/jpeg")
    command = T.media_command("tool", ["-i", "{name}.png", "size={size}"], {"name": name, "size": size})
    return table(spark, sf_dir, "part").select("p_partkey", T.chapter_file(title, key, size % 2, size).alias("file"), T.volume_folder(title, size).alias("folder"), T.asset_name(name, mime).alias("asset"), T.resized(F.concat(name, F.lit(".png"))).alias("resized"), F.array_join(command, "|").alias("command"))


@query(r"""
with n as (select o_custkey, list_sort(list(distinct o_orderkey)) as ks from orders group by o_custkey)
select c_custkey, coalesce(case when c_nationkey > 12 then c_mktsegment end, case when c_custkey < 17 then 'young' else 'old' end) as persona,
       case when len(ks) > 4 then ks[1] || '–' || ks[-1] || ' (' || len(ks) || ')' else array_to_string(ks, ', ') end as numbers,
       case when length(substr(c_name || repeat('x', 50), 1, 55) || '; ' || substr(c_mktsegment || repeat('y', 60), 1, 55)) > 110 then substr(substr(c_name || repeat('x', 50), 1, 55) || '; ' || substr(c_mktsegment || repeat('y', 60), 1, 55), 1, 110) || '…'
         else substr(c_name || repeat('x', 50), 1, 55) || '; ' || substr(c_mktsegment || repeat('y', 60), 1, 55) end as context,
       regexp_matches(c_name || case when c_custkey % 2 = 0 then '."  ' else ', ' end, '[.!?]["”’]?\s*$') as ends, len(list_filter(regexp_extract_all(c_mktsegment || ' of the ab it''s', '[A-Za-z'']+'), lambda w: length(w) > 2)) as words
from customer join n on c_custkey = o_custkey
""")
def report_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sort_array(F.collect_set("o_orderkey")).alias("ks"))
    settings = F.array(F.concat("c_name", F.lit("x" * 50)), F.concat("c_mktsegment", F.lit("y" * 60)), F.lit("third"))
    tail = F.when(F.col("c_custkey") % 2 == 0, '."  ').otherwise(", ")
    return table(spark, sf_dir, "customer").join(numbers, "c_custkey").select(
        "c_custkey",
        T.persona(F.when(F.col("c_nationkey") > 12, F.col("c_mktsegment")), F.col("c_custkey"), "young", "old").alias("persona"),
        T.compact_numbers(F.col("ks")).alias("numbers"),
        T.context_of(settings).alias("context"),
        T.ends_sentence(F.concat("c_name", tail)).alias("ends"),
        F.size(T.tokens(F.concat("c_mktsegment", F.lit(" of the ab it's")))).cast("long").alias("words"),
    )


@query(r"""
with o as (select o_orderkey, o_custkey % 10 as part, o_custkey % 7 as whole, o_totalprice as elapsed from orders)
select o_orderkey, case when whole > 0 then round(part * 100.0 / whole, 6) else 0 end as pct, case when part > 0 then round(elapsed * whole / part - elapsed, 6) end as remaining, part > 2 and whole > 0 and elapsed > 50000 as valid,
       coalesce(try_cast(nullif(regexp_extract(case when part = 3 then 'Chapter_' || whole || '_x.txt' else 'y.txt' end, '(?i)chapter_(\d+)', 1), '') as int), cast(part as int)) as chapter, case when part = 1 then 'head' when part = 2 then 'file' else 'Chapter ' || whole end as title from o
""")
def progress_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 10).alias("part"), (F.col("o_custkey") % 7).alias("whole"), F.col("o_totalprice").alias("elapsed"))
    part, whole = F.col("part"), F.col("whole")
    file = F.when(part == 3, F.concat(F.lit("Chapter_"), whole.cast("string"), F.lit("_x.txt"))).otherwise("y.txt")
    return rows.select(
        "o_orderkey",
        F.round(T.percent(part, whole), 6).alias("pct"),
        F.round(T.remaining(F.col("elapsed"), part, whole), 6).alias("remaining"),
        R.valid_artefact(part > 2, whole, F.col("elapsed") - 50000).alias("valid"),
        T.chapter_of_row(file, part.cast("int")).alias("chapter"),
        T.title_or_default(F.when(part == 1, "head"), F.when(part == 2, "file"), whole).alias("title"),
    )


@query("""
with a as (select n_name, row_number() over (order by n_nationkey) as position from nation), b as (select r_name, row_number() over (order by r_regionkey desc) as position from region)
select cast(position as int) as position, n_name, r_name from a join b using (position)
""")
def pair_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pair_by_position(table(spark, sf_dir, "nation").select("n_name", "n_nationkey"), "n_nationkey", table(spark, sf_dir, "region").select("r_name", (-F.col("r_regionkey")).alias("o")), "o").select("position", "n_name", "r_name")


@query("""
select count(*) filter (where event_type <> 'error') as successful, count(*) filter (where event_type = 'error') as failed, round(count(distinct user_id) * 30.0 / count(*), 9) as mean_seconds from events
""")
def batch_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    jobs = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_list(F.when(kind != "error", F.col("event_id"))).alias("ok"), F.collect_list(F.when(kind == "error", F.col("event_id"))).alias("bad"))
    return R.batch_totals(jobs.withColumn("seconds", F.lit(30.0)), "ok", "bad", "seconds").withColumn("mean_seconds", F.round("mean_seconds", 9))


@query("""
select lang as status, count(*) as n, array_to_string(list_sort(list(distinct source))[1:3], ',') as names from documents group by lang
""")
def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = R.status_histogram(table(spark, sf_dir, "documents"), "lang", "source")
    return got.select(F.col("lang").alias("status"), "n", F.array_join("names", ",").alias("names"))


@query("""
with r as (select c_custkey as pos, c_custkey * 10 - 7 as lo, c_custkey * 10 + c_nationkey as hi, c_name from customer)
select o_orderkey, arg_min(c_name, pos) as c_name from orders left join r on o_orderkey between lo and hi group by o_orderkey
""")
def range_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    ranges = table(spark, sf_dir, "customer").select(key.alias("pos"), (key * 10 - 7).alias("lo"), (key * 10 + F.col("c_nationkey")).alias("hi"), "c_name")
    return R.range_lookup(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", ranges, ["c_name"], "null")


@query("select folder from FILES where filename like '%.md' group by folder".replace("FILES", _FILES))
def project_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _listing(spark, sf_dir).withColumn("filename", F.when(F.col("filename").endswith(".md"), "project.json").otherwise(F.col("filename")))
    return S.projects(files)


@query(r"""
with n as (select distinct lower(unnest(regexp_extract_all(text, '[A-Za-z]{4,}'))) as name from benchmark), t as (select conv_id, turn, lower(text) as low from conversations)
select conv_id, turn, name, strpos(low, name) - 1 as first from t, n where contains(low, name)
""")
def names_in_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the benchmark that each message holds, also as parts of words."""
    names = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), F.lit(0))).alias("name"))
    return N.occurrences(table(spark, sf_dir, "conversations"), names, ["conv_id", "turn"]).select("conv_id", "turn", "name", "first")
