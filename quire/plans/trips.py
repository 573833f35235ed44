"""Queries that write what they make and read it back: sinks, sources and documents in JSON or CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import chapters as C
from quire.operators import ledger as L
from quire.operators import relational as R
from quire.operators import scans
from quire.plans.catalogue import query, table
from quire.plans.media import _FILES, _listing
from quire.sources import files as S


@query("select conv_id, row_number() over (partition by conv_id order by turn) - 1 as seq, 'T' || turn as title, cast(turn as int) as page, cast(turn % 2 as int) as level from conversations")
def outline_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as JSON outlines in which odd turns are nested, flattened again."""
    one = F.to_json(F.struct(F.concat(F.lit("T"), F.col("turn").cast("string")).alias("title"), F.col("turn").alias("page")))
    item = F.when(F.col("turn") % 2 == 0, one).otherwise(F.concat(F.lit("["), one, F.lit(', {"page": 1}]')))
    rows = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").cast("string").alias("path")).agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", item.alias("x")))), lambda y: y["x"]).alias("items"))
    docs = rows.select("path", F.concat(F.lit("["), F.array_join("items", ", "), F.lit("]")).alias("outline"))
    return S.flatten_outline(docs).select(F.col("path").cast("long").alias("conv_id"), "seq", "title", "page", "level")


@query("select l.doc_id, d.lang as title, md5(d.text) as content from labels l left join documents d on d.doc_id = l.doc_id + 1")
def chapter_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each entry of a table of contents points to, if it is there."""
    toc = table(spark, sf_dir, "labels").select(F.lit("book").alias("path"), "doc_id", F.concat(F.lit("text/"), (F.col("doc_id") + 1).cast("string"), F.lit(".xhtml#top")).alias("href"))
    entries = table(spark, sf_dir, "documents").select(F.lit("book").alias("path"), F.concat(F.lit("text/"), F.col("doc_id").cast("string"), F.lit(".xhtml")).alias("href"), F.struct("lang", "text").alias("content"))
    return C.fetch(toc, entries).select("doc_id", F.col("content.lang").alias("title"), F.md5("content.text").alias("content"))


_FIRST = """(select arg_min(path, case folder when 'Side_Stories' then 1 when 'notes' then 2 end * 1000000000000 + case when filename like '%.md' then 1 else 2 end * 100000000000 + rank) from (select *, row_number() over (order by filename) as rank from FILES) where folder in ('Side_Stories', 'notes'))""".replace("FILES", _FILES)


@query(f"select 'first' as pick, {_FIRST} as path union all select 'none', null")
def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of all files by folder, then extension, then name; none of a folder that isn't there."""
    files = _listing(spark, sf_dir)
    first = S.by_precedence(files, ["Side_Stories", "notes"], [".md", ".txt"]).select(F.lit("first").alias("pick"), "path")
    return first.unionByName(S.by_precedence(files, ["nowhere"], [".md"]).select(F.lit("none").alias("pick"), "path"))


@query("select doc_id, quality, toxic from labels")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records in JSON files that are bare arrays or wrapped in an object, read by one schema; a missing file has none."""
    rows = table(spark, sf_dir, "labels").withColumn("g", F.expr("doc_id div 100"))
    items = rows.groupBy("g").agg(F.to_json(F.collect_list(F.struct("doc_id", "quality", "toxic"))).alias("items"))
    text = F.when(F.col("g") % 2 == 0, F.col("items")).otherwise(F.concat(F.lit('{"version": 2, "records": '), F.col("items"), F.lit("}")))
    folder = f"{scans.scratch(spark)}/json"
    S.write_named(items.select(F.format_string("part_%d.json", "g").alias("path"), text.alias("content")), folder)
    files = S.trees.read_below(spark, folder, "*.json")
    read = files.select(F.explode(S.wrapped_or_bare(F.col("content").cast("string"), "records", "struct<doc_id: bigint, quality: int, toxic: int>")).alias("r")).select("r.*")
    return read.unionByName(S.json_or_empty(spark, f"{folder}/none.json", "doc_id long, quality int, toxic int"))


@query("""select o_custkey as "Ch", sum(cast(o_totalprice * 100 as bigint)) / 100 as "Sec" from orders group by o_custkey""")
def durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds by chapter, written as CSV and read back."""
    cents = F.sum((F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("long"))
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").cast("int").alias("Ch")).agg((cents / 100).alias("Sec"))
    folder = f"{scans.scratch(spark)}/csv"
    rows.write.csv(folder, header=True)
    return S.durations(spark, folder).select(F.col("Ch").cast("long").alias("Ch"), "Sec")


@query("select doc_id, case doc_id % 5 when 0 then false when 1 then false when 2 then lang <> 'en' else true end as valid from documents")
def project_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which project documents have all required fields; some are malformed, some lack a field or have it null."""
    k = F.col("doc_id") % 5
    whole = F.to_json(F.struct(F.struct("source", "lang").alias("project"), "n_chars"))
    text = F.when(k == 0, F.substring(whole, 1, 9)).when(k == 1, F.to_json(F.struct(F.struct("source").alias("project"), "n_chars"))).when((k == 2) & (F.col("lang") == "en"), F.to_json(F.struct(F.struct("source", "lang").alias("project")))).otherwise(whole)
    rows = table(spark, sf_dir, "documents").select("doc_id", text.alias("content"))
    return C.valid_projects(rows, "doc_id", "content", ["project.source", "project.lang", "n_chars"])


@query("select event_id from events where value <= 100 or event_type = 'view'")
def dry_runs_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger without dry runs; a missing flag counts as real."""
    dry = F.when(F.col("event_type") != "view", F.col("value") > 100)
    return L.clear_dry_runs(table(spark, sf_dir, "events").withColumn("dry_run", dry)).select("event_id")


@query("""
with u as (select user_id % 97 as file, max(event_id) as seq, arg_max(case when event_type = 'view' then user_id end, event_id) as p from events group by 1)
select cast(file as varchar) as file, seq, (select event_type from events e where e.event_id = seq) as kind from u
union all select 'total ' || count(*) || ' in playlist ' || count(p), max(seq), null from (select user_id % 97 as file, max(event_id) as seq, max_by(p, event_id) as p from (select *, case when event_type = 'view' then coalesce(user_id, 0) else null end as p from events) group by 1)
""".replace("max_by(p, event_id)", "(array_agg(p order by event_id desc))[1]"))
def upload_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last upload of each file, and the totals."""
    log = table(spark, sf_dir, "events").select((F.col("user_id") % 97).cast("string").alias("file"), F.col("event_id").alias("seq"), F.col("event_type").alias("kind"), F.when(F.col("event_type") == "view", F.col("user_id")).alias("playlist"))
    held, total = L.uploads(log, "file", "seq", "playlist")
    shown = total.select(F.format_string("total %d in playlist %d", "total_uploaded", "in_playlist").alias("file"), F.col("last_upload").alias("seq"), F.lit(None).cast("string").alias("kind"))
    return held.select("file", "seq", "kind").unionByName(shown)


@query("""
select 'queue' as part, filename || '|' || doc_id as line from (select doc_id, 'Chapter_' || doc_id || '.txt' as filename from documents) where doc_id not in (select doc_id from labels)
union all select 'summary', 'n=' || count(*) from labels union all select 'record', doc_id || '=' || coalesce(quality, -1) from labels
union all select 'completed', cast(doc_id as varchar) from labels where quality = 1 union all select 'failed', cast(doc_id as varchar) from labels where toxic = 1
""")
def written_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A queue, a report and ledgers, written and read back."""
    folder, labels = scans.scratch(spark), table(spark, sf_dir, "labels")
    name = lambda df: df.withColumn("filename", F.concat(F.lit("Chapter_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    rows = name(table(spark, sf_dir, "documents")).select("filename", F.col("doc_id").cast("string").alias("title"), F.lit(1).alias("volume_number"), F.col("doc_id").alias("chapter_number"))
    S.write_queue(rows, name(labels), f"{folder}/queue")
    S.write_report(labels, labels.agg(F.count("*").alias("n")), f"{folder}/report")
    for which in (labels.limit(0), labels):  # the second takes the place of the first
        S.write_ledgers({"completed": which.where("quality = 1"), "failed": which.where("toxic = 1")}, f"{folder}/ledgers")
    read = lambda at: spark.read.schema(labels.schema).json(f"{folder}/{at}")
    line = lambda df, part, column: df.select(F.lit(part).alias("part"), column.cast("string").alias("line"))
    out = line(spark.read.text(f"{folder}/queue"), "queue", F.col("value"))
    out = out.unionByName(line(spark.read.schema("n long").json(f"{folder}/report/summary"), "summary", F.concat(F.lit("n="), F.col("n").cast("string"))))
    out = out.unionByName(line(read("report/records"), "record", F.concat_ws("=", "doc_id", F.coalesce("quality", F.lit(-1)))))
    return out.unionByName(line(read("ledgers/completed"), "completed", F.col("doc_id"))).unionByName(line(read("ledgers/failed"), "failed", F.col("doc_id")))


@query(r"""
select path, case when doc_id % 7 = 0 then 'missing' when filename like '%.md' then 'wrong type' end as problem from (select *, cast(regexp_extract(filename, '(\d+)', 1) as bigint) as doc_id from FILES)
""".replace("FILES", _FILES))
def input_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an input can't be taken: it isn't there, or not of the type."""
    files = _listing(spark, sf_dir).select("path", "filename", "size")
    there = files.where(F.regexp_extract("filename", r"(\d+)", 1).cast("long") % 7 != 0)
    return S.checked_inputs(files.select("path"), there, ".TXT")


@query(r"""
select o_orderpriority as status, count(*) as n, cast(row_number() over (order by case o_orderpriority when '1-URGENT' then 1 when '5-LOW' then 2 else 3 end, count(*) desc, lower(o_orderpriority), o_orderpriority) as bigint) as place from orders group by o_orderpriority
""")
def report_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of a report, as numbers."""
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("status")).agg(F.count("*").alias("n"))
    at = F.array_position(F.array(F.lit("1-URGENT"), F.lit("5-LOW")), F.col("status"))
    rank = F.when(at == 0, 3).otherwise(at)
    return scans.numbered(rows, [rank, F.desc("n"), F.lower("status"), "status"], "place").withColumn("place", F.col("place") + 1)


@query("""
select i as position, p_name, c_name from (select p_name, p_partkey, row_number() over (order by p_partkey) as i from part) join (select c_name, row_number() over (order by c_acctbal desc, c_custkey) as i from customer) using (i)
""")
def pair_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two long lists paired by position."""
    customers = table(spark, sf_dir, "customer").select("c_name", F.struct((-F.col("c_acctbal")).alias("b"), "c_custkey").alias("o"))
    return R.pair_by_position(table(spark, sf_dir, "part").select("p_name", "p_partkey"), "p_partkey", customers, "o").select("position", "p_name", "c_name")


@query(r"""
select path as file_path, row_number() over (order by volume_number, chapter_number, filename) as place from (
  select filename, path, case when folder = 'Side_Stories' then 9 else try_cast(regexp_extract(folder, '^(\d+)', 1) as int) end as volume_number, cast(regexp_extract(filename, '(?i)Chapter_(\d+)', 1) as int) as chapter_number
  from FILES where filename like 'Chapter%.txt' and folder <> 'notes')
""".replace("FILES", _FILES))
def catalogue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every chapter in the order of the catalogue."""
    found = S.catalogue(_listing(spark, sf_dir))
    return scans.numbered(found, ["volume_number", "chapter_number", "filename"], "place").select("file_path", (F.col("place") + 1).alias("place"))
