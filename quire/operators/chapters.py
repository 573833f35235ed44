"""Chapters: from documents to bodies, files and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.functions import html as H
from quire.functions import text as T
from quire.operators import names as N
from quire.operators import ordered as O


def fetch(toc: DataFrame, entries: DataFrame) -> DataFrame:
    """toc (path, href, ...) with `content`, that of the book's entry at the href without its fragment (null: no such entry)."""
    held = entries.select("path", F.col("href").alias("_at"), "content").dropDuplicates(["path", "_at"])
    return toc.withColumn("_at", T.drop_fragment(F.col("href"))).join(held, ["path", "_at"], "left").drop("_at")


def bodies(rows: DataFrame, key: str, source: str, chapter: str, title: str, markers: list[str], compat: bool = False) -> DataFrame:
    """key, body, paragraphs and way of each document: its blocks without noise lines, echoes of the title and repeats of the line
    before, from the first paragraph on that isn't an echo, joined by blank lines.

    Documents read by regular expressions keep noise lines and repeats. A document without paragraphs has an empty body.
    """
    read = rows.select(key, chapter, title, H.body_blocks(F.col(source), compat).alias("_b"))
    # All in the document's row: its blocks are parsed once and need no shuffle.
    held = read.select(key, F.col("_b.way").alias("way"), F.col(chapter).alias("_n"), F.col(title).alias("_t"), F.coalesce("_b.blocks", F.array().cast("array<string>")).alias("_x"))
    plain = F.col("way") != "regex"
    kept = F.filter("_x", lambda x: x.isNotNull() & ~T.echoes_title(x, F.col("_n"), F.col("_t")) & ~(plain & T.is_noise_line(x, markers)))
    marked = held.withColumn("_k", kept)
    once = F.filter("_k", lambda x, i: ~plain | (i == 0) | (F.get("_k", i - 1) != x))
    return marked.withColumn("_o", once).select(key, F.array_join("_o", "\n\n").alias("body"), F.size("_o").cast("long").alias("paragraphs"), "way")


def files(rows: DataFrame, volume: str, volume_name: str, chapter: str, title: str, series: Column, body: str) -> DataFrame:
    """path (`Volume_<n>_<name>/Chapter_<n>_<title>.txt`) and content (series, header, blank line, body) of each chapter."""
    from quire.sources.files import chapter_content

    folder = F.format_string("Volume_%d_%s", volume, T.safe_name(F.col(volume_name)))
    name = F.format_string("Chapter_%d_%s.txt", chapter, T.safe_name(F.col(title)))
    return rows.select(F.concat(folder, F.lit("/"), name).alias("path"), chapter_content(series, F.col(chapter), F.col(title), F.col(body)).alias("content"))


def paged_files(pages: DataFrame, slices: DataFrame, doc: str, series: str) -> DataFrame:
    """path and content of volumes and chapters cut from pages (doc, page, text), from slices as O.clip_slices gives them.

    slices: doc, kind (volume or chapter), number, title, volume_number, volume_title, clip_start, clip_end, status. A failed slice
    has no file; a page that is missing is empty. A volume's file lies beside the folder of its chapters.
    """
    cut = slices.where("status <> 'failed'").withColumn("page", F.explode(F.sequence("clip_start", "clip_end")))
    held = cut.join(pages.select(doc, "page", "text"), [doc, "page"], "left")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", F.coalesce("text", F.lit("")).alias("text")))), lambda x: x["text"]), "\n\n")
    whole = held.groupBy(doc, "kind", "number", "title", "volume_number", "volume_title").agg(joined.alias("body"))
    name, number = T.clean_title(F.col("title")), F.col("number").cast("string")
    head = F.when(F.col("kind") == "volume", F.concat(F.lit("Volume "), number, F.lit(": "), name)).otherwise(F.concat(F.lit("Chapter "), number, F.lit("\n"), name))
    folder = F.when(F.col("kind") == "volume", "").otherwise(F.concat(T.volume_folder(F.col("volume_title"), F.col("volume_number")), F.lit("/")))
    file = T.chapter_file(F.col("title"), F.col("number"), F.when(F.col("kind") == "volume", 0).otherwise(1), F.col("volume_number"))
    return whole.select(doc, F.concat(F.col(doc).cast("string"), F.lit("/"), folder, file).alias("path"), F.concat(F.lit(f"{series}\n"), head, F.lit("\n\n"), "body").alias("content"))


def label_stats(toc: DataFrame, doc: str, most: int = 15) -> DataFrame:
    """Volume labels in tables of contents (doc, seq, title, level), per document: entries, structural (top entries with entries
    below them), labels, valid (labels with a number, in digits or a well-formed roman numeral), rising (whether each valid
    label of a kind has a greater number than the one before) and sample, the first `most` labels."""
    inside = W.partitionBy(doc).orderBy("seq")
    below = F.lead("level").over(inside)
    kind, number = T.volume_label(F.col("title"))
    rows = toc.select(doc, "seq", "title", "level", kind.alias("kind"), number.alias("number"), below.alias("_below"))
    before = F.last("number", ignorenulls=True).over(W.partitionBy(doc, "kind").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("_falls", F.col("kind").isNotNull() & (F.col("number") <= before))
    rank = F.row_number().over(W.partitionBy(doc).orderBy(F.col("kind").isNull(), "seq"))
    shown = F.when(F.col("kind").isNotNull() & (F.col("_rank") <= most), F.struct("seq", F.trim("title").alias("title")))
    return rows.withColumn("_rank", rank).groupBy(doc).agg(
        F.count("*").alias("entries"),
        F.count_if((F.col("level") == 0) & (F.col("_below") > 0)).alias("structural"),
        F.count("kind").alias("labels"),
        F.count_if(F.col("kind").isNotNull() & F.col("number").isNotNull()).alias("valid"),
        (F.count_if("_falls") == 0).alias("rising"),
        F.transform(F.sort_array(F.collect_list(shown)), lambda x: x["title"]).alias("sample"),
    )


def scene_texts(scenes: DataFrame, texts: DataFrame, key: str, text: str) -> DataFrame:
    """scenes (key, line_start, line_end, ...) with `scene_text`: the chapter's lines from start to end, counted from 1, joined by
    spaces in lower case; lines outside the chapter aren't there, and a scene without a chapter has the empty text."""
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"\r\n|\r|\n"), lambda x: x)
    held = scenes.join(texts.select(key, text), key, "left").withColumn("_l", lines)
    kept = F.filter("_l", lambda x, i: (i + 1).between(F.col("line_start"), F.col("line_end")))
    return held.withColumn("scene_text", F.lower(F.array_join(kept, " "))).select(*scenes.columns, "scene_text")


def split_outline(outline: DataFrame, doc: str) -> DataFrame:
    """Outline rows (doc, seq, title, level) with `kind`: volume, chapter, or null for covers; all rows of a document without
    two volumes and a chapter are `single`, to be written as one text."""
    volume = (F.col("level") == 0) & ~F.lower("title").contains("cover")
    marked = outline.withColumn("kind", F.when(volume, "volume").when(F.col("level") > 0, "chapter"))
    whole = marked.groupBy(doc).agg(((F.count_if(F.col("kind") == "volume") > 1) & (F.count_if(F.col("kind") == "chapter") > 0)).alias("_h"))
    return marked.join(whole, doc).withColumn("kind", F.when(F.col("_h"), F.col("kind")).otherwise("single")).drop("_h")


def scenes(rows: DataFrame, key: str, array: str) -> DataFrame:
    """One row for each scene of an array column, with `scene` counting from 1 within the key."""
    others = [c for c in rows.columns if c != array]
    return rows.select(*others, F.posexplode(array).alias("_p", "_s")).select(*others, (F.col("_p") + 1).alias("scene"), "_s.*")


def scene_index(rows: DataFrame, name: str, lead: str, order: list[str]) -> DataFrame:
    """Per character: scenes and the first of them; names that start with `lead` are one character."""
    who = F.when(F.col(name).startswith(lead), F.lit(lead)).otherwise(F.col(name))
    return rows.groupBy(who.alias(name)).agg(F.count("*").alias("scenes"), F.min(F.struct(*order)).alias("first"))


def verify_tags(tags: DataFrame, texts: DataFrame, on: list[str], name: str, text: str, aliases: DataFrame, excluded: list[str], known: DataFrame, confirmed: DataFrame) -> DataFrame:
    """tags with `verdict`: skipped (bracketed or excluded), grounded (the name is in the text), canonical (a word of it is, and
    it is a known name), invented (a word of it is, and it isn't), verified (confirmed by hand) or notfound.

    aliases: alias, canonical. known: name. confirmed: on and the name as tagged. texts: on and the text, a row each.
    """
    renamed = aliases.select(F.col("alias").alias(name), F.col("canonical").alias("_c")).dropDuplicates([name])
    got = tags.join(renamed, name, "left").withColumn("_n", F.coalesce("_c", name))
    low = F.lower("_n")
    words = F.transform(T.tokens(F.col("_n")), lambda w: F.lower(w))
    got = N.held(got, texts, on, text, F.concat(F.array(low), F.coalesce(words, F.array().cast("array<string>"))), "_h")
    got = got.join(known.select(F.col("name").alias("_n")).distinct().withColumn("_k", F.lit(True)), "_n", "left")
    got = got.join(confirmed.select(*on, name).distinct().withColumn("_v", F.lit(True)), [*on, name], "left")
    word = F.coalesce(F.arrays_overlap("_h", words), F.lit(False))
    exact = F.coalesce(F.array_contains("_h", low), low == "")  # without a text only the empty name is there
    verdict = F.when(F.col(name).startswith("[") | F.col("_n").isin(*excluded, "\0"), "skipped").when(exact, "grounded").when(word & F.col("_k").isNotNull(), "canonical").when(word, "invented").when(F.col("_v").isNotNull(), "verified").otherwise("notfound")
    return got.withColumn("verdict", verdict).select(*tags.columns, "verdict")


def tally(tags: DataFrame) -> DataFrame:
    """One row: how many tags have each verdict, and the total without the skipped ones."""
    kinds = ("grounded", "canonical", "verified", "invented", "notfound", "skipped")
    return tags.agg(*[F.count_if(F.col("verdict") == k).alias(k) for k in kinds], F.count_if(F.col("verdict") != "skipped").alias("total"))


def timeline_json(rows: DataFrame, columns: list[str]) -> DataFrame:
    """A JSON document for each scene."""
    return rows.select(F.to_json(F.struct(*columns)).alias("line"))


def timeline_rows(rows: DataFrame, start: str, end: str, scene: str, names: str, setting: str) -> DataFrame:
    """A Markdown row for each scene: clock times, number, cast and layout, setting."""
    cast = F.coalesce(F.nullif(F.array_join(names, ", "), F.lit("")), F.lit("–"))
    return rows.select(F.format_string("| %s–%s | %d | %s | %s | %s |", T.clock(F.col(start)), T.clock(F.col(end)), F.col(scene), cast, T.layout(F.size(names)), F.coalesce(setting, F.lit("–"))).alias("line"))


def report_order(rows: DataFrame, status: str, ranks: list[str], count: str, name: str) -> DataFrame:
    """Rows by the rank of their status, then falling count, then name without regard to case."""
    rank = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col(status))
    return rows.orderBy(F.when(rank == 0, len(ranks) + 1).otherwise(rank), F.desc(count), F.lower(name), name)


def download_plan(wanted: DataFrame, existing: DataFrame, name: str, force: bool = False) -> DataFrame:
    """What is to be fetched: rows whose name doesn't exist yet, or all with `force`."""
    return wanted if force else wanted.join(existing.select(name).distinct(), name, "left_anti")


def fetch_batches(ids: DataFrame, key: str, size: int = 50) -> DataFrame:
    """The distinct ids with the number of the request that asks for them, `size` in each."""
    return O.batches(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, size)


def spoken_lines(lines: DataFrame, doc: str, order: str, text: str, heads: list[str], first: int = 3) -> DataFrame:
    """Lines for speech: of the first lines (order counts from 0) those that begin with one of `heads` stand alone, the others
    are joined into paragraphs by T.starts_paragraph. Columns doc, par, text, head."""
    plain = T.strip(F.col(text))
    head = (F.col(order) < first) & F.greatest(*[plain.startswith(h).cast("int") for h in [*heads, *heads]]).cast("boolean")
    top = lines.where(head).select(doc, F.col(order).cast("long").alias("par"), plain.alias(text), F.lit(True).alias("head"))
    rest = O.paragraphs(lines.where(~head), doc, order, text, T.starts_paragraph(F.col(text)))
    return top.unionByName(rest.select(doc, (F.col("par") + first).cast("long").alias("par"), text, F.lit(False).alias("head")))


def valid_projects(documents: DataFrame, name: str, content: str, required: list[str]) -> DataFrame:
    """name and `valid` of each project document (JSON text): whether all required fields are there; malformed: not valid."""
    there = [F.get_json_object(F.col(content), f"$.{f}").isNotNull() for f in required]
    ok = there[0]
    for x in there[1:]:
        ok = ok & x
    return documents.select(name, F.coalesce(ok, F.lit(False)).alias("valid")).orderBy(name)
