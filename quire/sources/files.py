"""File sources with explicit schemas, and sinks. Paths go through Spark's readers and writers only."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators.scans import cut, scratch
from quire.sources import archives, trees
from quire.sources.archives import toc_tree  # noqa: F401
from quire.sources.channel import attempted
from quire.sources.named import write_named

SCENES = "chapter INT, scenes ARRAY<STRUCT<line_start INT, line_end INT, protagonist_present BOOLEAN, protagonist_persona STRING, other_characters ARRAY<STRING>, setting STRING, text_anchor STRING>>"
DURATIONS = "Ch INT, Sec DOUBLE"
LEDGER = "timestamp STRING, chapter_info STRUCT<filename STRING, file_path STRING, volume_number INT, volume_name STRING, chapter_number INT, chapter_title STRING, file_size BIGINT, is_readable BOOLEAN>, audio_file_path STRING, audio_file_size BIGINT, audio_completed BOOLEAN, video_completed BOOLEAN, dry_run BOOLEAN"
MANIFEST = "title STRING, name STRING, kind STRING, row_viable BOOLEAN, url STRING, width INT, height INT, mime STRING"


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, folder, filename and size of files below `path`; contents aren't read. Files of zero bytes aren't listed, as by Spark."""
    name = F.element_at(F.split("path", "/"), -1)
    return trees.below(spark, path, pattern).select("path", F.element_at(F.split("path", "/"), -2).alias("folder"), name.alias("filename"), "size")


def projects(files: DataFrame) -> DataFrame:
    """The folders of a listing that hold a project.json, in order."""
    return files.where("filename = 'project.json'").select("folder").distinct().orderBy("folder")


def flatten_outline(rows: DataFrame) -> DataFrame:
    """path, seq, title, page, level from rows (path, outline: JSON text): a nested list is one level deeper than the item before
    it. Items that aren't objects with a title are skipped; malformed JSON gives no rows."""
    import json

    def walk(items, level):
        for x in items if isinstance(items, list) else []:
            if isinstance(x, list):
                yield from walk(x, level + 1)
            elif isinstance(x, dict) and x.get("title") is not None:
                yield str(x["title"]), x.get("page") if isinstance(x.get("page"), int) else None, level

    def read(text):
        try:
            return list(walk(json.loads(text or "[]"), 0))
        except ValueError:
            return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("path", pa.string()), ("seq", pa.int64()), ("title", pa.string()), ("page", pa.int32()), ("level", pa.int32())])
        for batch in batches:
            found = [{"path": p, "seq": i, "title": t, "page": g, "level": n} for p, o in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, (t, g, n) in enumerate(read(o))]
            yield pa.RecordBatch.from_pylist(found, schema=kinds)

    return rows.select("path", "outline").mapInArrow(run, "path string, seq long, title string, page int, level int")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """path, folder, filename, size and content of text files, a row each."""
    meta = trees.read_below(spark, path, "*.txt").select("path", "size", F.col("content").cast("string").alias("content"))
    return meta.withColumn("folder", F.element_at(F.split("path", "/"), -2)).withColumn("filename", F.element_at(F.split("path", "/"), -1))


def readable(size: Column, content: Column) -> Column:
    return (size > 0) & (T.strip(F.substring(content, 1, 100)) != "")


def catalogue(files: DataFrame, chapter_pattern: str = r"(?i)Chapter_(\d+)", volume_pattern: str = r"^(\d+)") -> DataFrame:
    """The chapter catalogue of files (folder, filename, path, size, content): volume folders and numbered .txt files only."""
    folder = F.col("folder")
    volume = T.volume_of_folder(folder, volume_pattern)
    number = T.number(F.col("filename"), chapter_pattern)
    kept = files.where((F.regexp_like(folder, F.lit(f"^(?:{volume_pattern})")) | (F.lower(folder) == "side_stories")) & F.col("filename").endswith(".txt") & readable(F.col("size"), F.col("content")))
    return kept.select("filename", F.col("path").alias("file_path"), volume.alias("volume_number"), folder.alias("volume_name"), number.alias("chapter_number"), T.title_of_filename(F.col("filename")).alias("chapter_title"), F.col("size").alias("file_size"), F.lit(True).alias("is_readable")).where("chapter_number is not null").orderBy("volume_number", "chapter_number", "filename")


def artefacts(files: DataFrame, extension: str) -> DataFrame:
    """Text file names for which a non-empty artefact exists, once each."""
    kept = files.where((F.col("size") > 0) & F.col("filename").endswith(extension))
    return kept.select(F.regexp_replace("filename", r"\.[^.]+$", ".txt").alias("filename")).distinct()


def videos(files: DataFrame, patterns: tuple[str, str] = (r"^Volume_(\d+)_(.+)$", r"^(\d+)_(.+)$")) -> DataFrame:
    """Videos with chapter number and volume by either folder layout (1, Unknown without one)."""
    folder = F.col("folder")
    number = F.coalesce(*[T.number(folder, p) for p in patterns], F.lit(1))
    name = F.coalesce(*[T.group(folder, p, 2) for p in patterns], F.lit("Unknown"))
    return files.where(F.col("filename").endswith(".mp4")).select("filename", F.col("path").alias("filepath"), F.coalesce(T.number(F.col("filename"), r"(?i)Chapter_(\d+)"), F.lit(0)).alias("chapter_number"), T.title_of_filename(F.col("filename")).alias("chapter_title"), number.alias("volume_number"), F.translate(name, "_", " ").alias("volume_name"))


def by_precedence(files: DataFrame, folders: list[str], extensions: list[str]) -> DataFrame:
    """The first file by folder, then extension, of those listed."""
    rank = lambda column, values: F.array_position(F.array(*[F.lit(v) for v in values]), column)
    ext = F.regexp_extract("filename", r"(\.[^.]+)$", 1)
    ranked = files.withColumn("_f", rank(F.col("folder"), folders)).withColumn("_e", rank(ext, extensions)).where("_f > 0 and _e > 0")
    return ranked.agg(F.min_by("path", F.struct("_f", "_e", "filename")).alias("path"))


def json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents; a missing path gives no rows, malformed documents become nulls."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(path)


def wrapped_or_bare(content: Column, field: str, item: str) -> Column:
    """Records of a JSON text that is either an array of items or an object with the array in `field`."""
    wrapped = F.from_json(content, f"`{field}` array<{item}>")[field]
    bare = F.from_json(content, f"array<{item}>")
    return F.when(F.ltrim(content).startswith("["), bare).otherwise(wrapped)


def durations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=DURATIONS)


def books(spark: SparkSession, path: str) -> DataFrame:
    """Entries of EPUB archives with their content: the columns of archives.BOOK, path, content, status and reason."""
    return archives.contents(archives.entries(listing(spark, path)))


def toc_entries(rows: DataFrame) -> DataFrame:
    """path, seq, href, title, level from rows (path, content) of tables of contents; malformed ones give a row with the reason."""
    return attempted(rows, ["content"], archives.toc_tree, "seq long, href string, title string, level int", ["path"])


def formatted(files: DataFrame, root: str, heads: list[str]) -> DataFrame:
    """Texts for speech of files (path, content: bytes) below `root`: path relative to it, content, status and reason.

    Lines are those of C.spoken_lines, each ended by a line feed. A file that isn't UTF-8 has no content and says so; one without
    words becomes empty.
    """
    from quire.operators import chapters as C

    name = F.expr(f"substring(path, length('{root.rstrip('/')}') + 2)") if root else F.col("path")
    read = attempted(files.select(name.alias("path"), F.col("content").alias("raw")), ["raw"], lambda raw: [((raw or b"").decode(),)], "text string", ["path"])
    lines = read.where("status = 'ok'").select("path", F.posexplode(F.split("text", "\n")).alias("n", "line")).withColumn("line", F.regexp_replace("line", "\r$", ""))
    spoken = C.spoken_lines(lines, "path", "n", "line", heads)
    each = F.transform(F.sort_array(F.collect_list(F.struct("par", "line"))), lambda x: F.concat(x["line"], F.lit("\n")))
    whole = spoken.groupBy("path").agg(F.array_join(each, "").alias("content"))
    return read.join(whole, "path", "left").select("path", F.when(F.col("status") == "ok", F.coalesce("content", F.lit(""))).alias("content"), "status", "reason")


def format_folder(spark: SparkSession, source: str, target: str, heads: list[str]) -> DataFrame:
    """Write the texts for speech of all .txt files below `source` to the same relative paths below `target`; the status of each."""
    files = trees.read_below(spark, source, "*.txt").select("path", "content")
    top = spark._jvm.org.apache.hadoop.fs.Path(source)
    root = top.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(top).toString()
    done = cut(formatted(files, root, heads), scratch(spark), "formatted")
    write_named(done.where("status = 'ok'").select("path", "content"), target)
    return done.select("path", "status", "reason")


# Sinks


def chapter_content(series: Column, chapter: Column, title: Column, body: Column) -> Column:
    return F.concat_ws("\n", series, T.header_line(chapter, title), F.lit(""), body)


def write_chapters(rows: DataFrame, path: str) -> None:
    """One text file set per volume folder: rows have volume_number, volume_name, chapter_number and content.

    Spark writes part files in order of chapters; a large volume is spread over several tasks. write_named gives a file each.
    """
    folder = F.format_string("Volume_%s_%s", "volume_number", T.safe_name(F.col("volume_name")))
    rows.select(folder.alias("volume_dir"), "chapter_number", F.col("content").alias("value")).repartitionByRange("volume_dir", "chapter_number").sortWithinPartitions("volume_dir", "chapter_number").select("volume_dir", "value").write.mode("overwrite").partitionBy("volume_dir").text(path)


def write_queue(rows: DataFrame, made: DataFrame, path: str) -> None:
    """The pending rows as delimited text: filename|title."""
    pending = rows.join(made, "filename", "left_anti").orderBy("volume_number", "chapter_number")
    pending.select(F.concat_ws("|", "filename", "title").alias("value")).write.mode("overwrite").text(path)


def publish(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    """Each table as JSON lines in a folder of its name below `path`, all at once: they are written beside it, and one rename puts
    them in the place of what was there. If one can't be written, what was there stays."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, staging, old = (hadoop.Path(path.rstrip("/") + end) for end in ("", f"-{uuid.uuid4().hex}", f"-{uuid.uuid4().hex}-old"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        for name, rows in tables.items():
            rows.write.json(f"{staging}/{name}")
        if fs.exists(target):
            fs.rename(target, old)
        fs.mkdirs(target.getParent())
        if not fs.rename(staging, target):
            raise OSError(f"{path} can't be published")
        fs.delete(old, True)
    finally:
        fs.delete(staging, True)


def write_report(records: DataFrame, summary: DataFrame, path: str) -> None:
    """A JSON report: the summary row in `summary`, the records in `records`, a document each line."""
    publish(records.sparkSession, {"summary": summary, "records": records}, path)


def write_ledgers(ledgers: dict[str, DataFrame], path: str) -> None:
    """Each ledger (progress, completed, failed, ...) as JSON in a folder of its name, replacing what was there as a whole."""
    if ledgers:
        publish(next(iter(ledgers.values())).sparkSession, ledgers, path)


def checked_inputs(wanted: DataFrame, files: DataFrame, extension: str, key: str = "path") -> DataFrame:
    """wanted (key) with `problem`: missing, empty, wrong type (not the extension, in any case), or null for a file that is there."""
    held = files.select(F.col("path").alias(key), F.col("size").alias("_size")).dropDuplicates([key])
    wrong = ~F.lower(F.col(key)).endswith(extension.lower())
    problem = F.when(F.col("_size").isNull(), "missing").when(wrong, "wrong type").when(F.col("_size") == 0, "empty")
    return wanted.join(held, key, "left").withColumn("problem", problem).drop("_size")


def markdown_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("–")) for c in columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
