"""Catalogue, range, reconciliation and report operators (DataFrame to DataFrame)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators.names import held
from quire.operators.ranges import range_lookup  # noqa: F401
from quire.operators.scans import numbered


# Filters, pending work and set membership


def in_range(rows: DataFrame, column: str, lo: int | None = None, hi: int | None = None, order: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Rows with lo <= column <= hi (either bound optional), the first `most` in order."""
    if lo is not None:
        rows = rows.where(F.col(column) >= lo)
    if hi is not None:
        rows = rows.where(F.col(column) <= hi)
    rows = rows.orderBy(*order) if order else rows
    return rows.limit(most) if most is not None else rows


def pending(rows: DataFrame, made: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(made, on, "left_anti")


def present(rows: DataFrame, made: DataFrame, on: list[str]) -> DataFrame:
    return rows.join(made, on, "left_semi")


def next_pending(rows: DataFrame, made: list[DataFrame], on: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows, in order, that one of the artefact sets lacks."""
    flags = [m.select(*on).distinct().withColumn(f"_has{i}", F.lit(True)) for i, m in enumerate(made)]
    out = rows
    for f in flags:
        out = out.join(f, on, "left")
    missing = F.lit(False)
    for i in range(len(flags)):
        missing = missing | F.col(f"_has{i}").isNull()
    return out.where(missing).select(rows.columns).orderBy(*order).limit(n)


def in_all(sets: list[DataFrame]) -> DataFrame:
    out = sets[0]
    for s in sets[1:]:
        out = out.intersect(s)
    return out


def difference(a: DataFrame, *others: DataFrame) -> DataFrame:
    out = a.distinct()
    for o in others:
        out = out.join(o, out.columns, "left_anti")
    return out


def union_distinct(*sets: DataFrame) -> DataFrame:
    out = sets[0]
    for s in sets[1:]:
        out = out.unionByName(s)
    return out.distinct()


# Range lookups (of ranges in a table: quire.operators.ranges)


def case_ranges(number: Column, limits: list[tuple[int, object]], otherwise: object) -> Column:
    """The value of the first limit that the number doesn't exceed; a null number gets the first value."""
    out = F.when(number.isNull(), F.lit(limits[0][1]))
    for limit, value in limits:
        out = out.when(number <= limit, F.lit(value))
    return out.otherwise(F.lit(otherwise))


# Lookups and reconciliation


def lookup(rows: DataFrame, column: str, table: DataFrame, key: str, value: str) -> DataFrame:
    """rows with `column` replaced by the table's value where the table has it."""
    t = table.select(F.col(key).alias("_k"), F.col(value).alias("_v")).dropDuplicates(["_k"])
    out = rows.join(t, rows[column] == t["_k"], "left")
    return out.withColumn(column, F.coalesce("_v", column)).drop("_k", "_v")


def reconcile(ledger: DataFrame, remote: DataFrame, key: str) -> DataFrame:
    """A status for each row of either side: verified, missing_on_remote (also a null key) or missing_in_ledger."""
    a = ledger.withColumn("_a", F.lit(1))
    b = remote.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_b", F.lit(1))
    status = F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), "verified").when(F.col("_b").isNull(), "missing_on_remote").otherwise("missing_in_ledger")
    return a.join(b, key, "full_outer").withColumn("status", status).drop("_a", "_b")


def link_plan(rows: DataFrame, number: str, value: str, lo: int, hi: int) -> DataFrame:
    """Links from each number in lo..hi to the next, with the reason why one can't be made (the source's comes first)."""
    wanted = rows.sparkSession.range(lo, hi + 1).select(F.col("id").alias("source"), (F.col("id") + 1).alias("target"))
    known = rows.where(F.col(number).between(lo, hi + 1)).groupBy(F.col(number).cast("long").alias("_n")).agg(F.min(value).alias("_v"))
    a = known.select(F.col("_n").alias("source"), F.col("_v").alias("source_value"))
    b = known.select(F.col("_n").alias("target"), F.col("_v").alias("target_value"))
    got = wanted.join(a, "source", "left").join(b, "target", "left")
    reason = F.when(F.col("source_value").isNull(), "source missing").when(F.col("target_value").isNull(), "target missing")
    return got.select("source", "source_value", "target", "target_value", reason.alias("skip_reason"))


def resolve_in_order(rows: DataFrame, key: str, tables: list[DataFrame], value: str) -> DataFrame:
    """rows with the value of the first table (key, value) that has the key, and whether it must be created."""
    out = rows
    for i, t in enumerate(tables):
        out = out.join(t.select(key, F.col(value).alias(f"_v{i}")).dropDuplicates([key]), key, "left")
    picked = F.coalesce(*[F.col(f"_v{i}") for i in range(len(tables))])
    return out.select(*rows.columns, picked.alias(value), picked.isNull().alias("to_create"))


def pair_by_position(a: DataFrame, a_order: str, b: DataFrame, b_order: str) -> DataFrame:
    """The i-th row of a with the i-th of b, from 1 on."""
    n = lambda df, by: numbered(df, [by], "position").withColumn("position", F.col("position") + 1)
    return n(a, a_order).join(n(b, b_order), "position")


def grounded(tags: DataFrame, texts: DataFrame, key: str, name: str, text: str) -> DataFrame:
    """Tags with whether the name, or one of its words of more than two letters, occurs in the text of the same key."""
    words = F.filter(F.regexp_extract_all(F.lower(F.col(name)), F.lit("[a-z']+"), F.lit(0)), lambda w: F.length(w) > 2)
    needles = F.concat(F.array(F.lower(F.col(name))), F.coalesce(words, F.array().cast("array<string>")))
    got = held(tags, texts, [key], text, needles, "_held")
    none = F.lit(False)
    return got.withColumn("exact", F.coalesce(F.array_contains("_held", F.lower(F.col(name))), none)).withColumn("by_word", F.coalesce(F.arrays_overlap("_held", words), none)).drop("_held")


def availability(scraped: DataFrame, curated: DataFrame) -> DataFrame:
    """name, available from scraped (name, viable) overridden by curated (name, viable)."""
    a, b = scraped.select("name", F.col("viable").alias("_s")), curated.select("name", F.col("viable").alias("_c"))
    return a.join(b, "name", "full_outer").select("name", F.coalesce("_c", "_s").alias("available"))


# Aggregations


def progress(rows: DataFrame, made: DataFrame, on: list[str], by: list[str], flags: dict[str, Column]) -> DataFrame:
    """Per group (or overall): total, and the count and percentage of members with each flag of the artefacts."""
    marks = made.select(*on, *[c.cast("int").alias(f"_{n}") for n, c in flags.items()])
    joined = rows.select(*dict.fromkeys([*by, *on])).join(marks, on, "left")
    total = F.count("*")
    out = [total.alias("total")]
    for n in flags:
        done = F.count(F.when(F.col(f"_{n}") == 1, 1))
        out += [done.alias(f"done_{n}"), F.when(total > 0, F.round(done * 100.0 / total, 4)).otherwise(0.0).alias(f"pct_{n}")]
    return joined.groupBy(*by).agg(*out)


def participation(rows: DataFrame, name: str, chapter: str, order: str, setting: str) -> DataFrame:
    """Per name: scenes, sorted chapters, settings in order of first sight.

    Rows are reduced to one of each name, chapter and setting before any list is made.
    """
    pre = rows.groupBy(name, chapter, setting).agg(F.count("*").alias("_n"), F.min(order).alias("_o"))
    seen = pre.groupBy(name, setting).agg(F.min("_o").alias("_o"))
    shown = seen.groupBy(name).agg(F.transform(F.sort_array(F.collect_list(F.struct("_o", setting))), lambda x: x[setting]).alias("settings"))
    return pre.groupBy(name).agg(F.sum("_n").alias("scenes"), F.sort_array(F.collect_set(chapter)).alias("chapters")).join(shown, name)


def aliased(rows: DataFrame, name: str, aliases: DataFrame, excluded: list[str]) -> DataFrame:
    """rows under their canonical names (aliases: alias, canonical), without the excluded ones."""
    return lookup(rows, name, aliases, "alias", "canonical").where(~F.col(name).isin(*excluded, "\0"))


def first_k(rows: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each group. Spark prunes each task's rows by rank before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def duplicates(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def status_histogram(rows: DataFrame, status: str, name: str, most: int = 3) -> DataFrame:
    """Per status: how many rows, and the first `most` names in order."""
    top = first_k(rows.select(status, name).distinct(), [status], [name], most)
    shown = top.groupBy(status).agg(F.sort_array(F.collect_list(name)).alias("names"))
    return rows.groupBy(status).agg(F.count("*").alias("n")).join(shown, status, "left")


def batch_totals(batches: DataFrame, ok: str, failed: str, seconds: str) -> DataFrame:
    done = F.sum(F.size(ok))
    return batches.agg(done.alias("successful"), F.sum(F.size(failed)).alias("failed"), F.coalesce(F.try_divide(F.sum(seconds), done + F.sum(F.size(failed))), F.lit(0.0)).alias("mean_seconds"))


# Media plans: artefacts, images and registries as tables


def valid_artefact(exists: Column, size: Column, seconds: Column) -> Column:
    return F.coalesce(exists & (size > 0) & (seconds > 0), F.lit(False))


def eligible(status: Column, number: Column, allowed: list[int], found: Column) -> Column:
    """Why a row is left out: null where it is unlisted or allowed by number, else the reason."""
    return F.when(~found, "unresolved").when((status == "unlisted") | number.isin(*allowed), F.lit(None).cast("string")).otherwise("not unlisted")


def official_images(files: DataFrame, file: str, bad: list[str]) -> DataFrame:
    """Files named `<Name>_Official.(jpg|jpeg|png)`, with the name and whether a row of portraits can show them."""
    kept = files.where(F.col(file).rlike(r"_Official\.(jpg|jpeg|png)$") & ~F.col(file).rlike(r"_Official_\((Crop|Cropped|Full)\)\."))
    name = F.translate(F.regexp_extract(file, r"^(.+)_Official\.", 1), "_", " ")
    viable = ~name.isin(*bad) & (F.coalesce("height", F.lit(0)) >= F.coalesce("width", F.lit(0)))
    return kept.withColumn("name", name).withColumn("row_viable", viable)


def registry_coverage(names: DataFrame, images: DataFrame, override: DataFrame, protagonists: list[str] | None = None, personas: list[str] | None = None) -> DataFrame:
    """names (name) with the image found under the override's name (name, use) or their own, if any.

    Protagonists count as having an image, that of one of their personas, which differs by scene and isn't named here; a
    persona's image is nobody else's.
    """
    leads, worn = F.col("name").isin(*(protagonists or []), "\0"), F.col("name").isin(*(personas or []), "\0")
    use = names.join(override, "name", "left").withColumn("_n", F.coalesce("use", "name"))
    held = images.where(~worn).select(F.col("name").alias("_n"), "image").dropDuplicates(["_n"])
    got = use.join(held, "_n", "left").select("name", F.when(~leads, F.col("image")).alias("image"))
    return got.withColumn("has_image", leads | F.col("image").isNotNull())


def unused_images(images: DataFrame, covered: DataFrame, personas: list[str]) -> DataFrame:
    """The images (name, image) that no name uses and that aren't a persona's."""
    return images.join(covered.where("image is not null").select("image").distinct(), "image", "left_anti").where(~F.col("name").isin(*personas, "\0"))


def first_source(rows: DataFrame, files: DataFrame, on: list[str], path: str) -> DataFrame:
    """rows with the first file (by path) that has the same keys, null where there is none."""
    return rows.join(files.groupBy(*on).agg(F.min(path).alias(path)), on, "left")


def first_non_empty(sources: list[DataFrame], by: list[str]) -> DataFrame:
    """The rows of the first source that has any for a group."""
    rows = None
    for i, s in enumerate(sources):
        s = s.withColumn("_p", F.lit(i))
        rows = s if rows is None else rows.unionByName(s)
    best = rows.groupBy(*by).agg(F.min("_p").alias("_best"))
    return rows.join(best, by).where("_p = _best").drop("_p", "_best")
