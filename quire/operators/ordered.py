"""Ordered operators: allocation, clocks, fills, islands, numbering and outlines as windows within a group.

Each window is partitioned by its group. Where the order runs over all rows (a clock, a fill, a number), the rows are scanned in
chunks of bounded size (quire.operators.scans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.operators import scans as S


def allocate(rows: DataFrame, group: str, weight: Column, total: Column) -> DataFrame:
    """rows with `share`, the group's total divided in proportion to max(1, weight)."""
    w = F.greatest(F.lit(1), weight)
    return rows.withColumn("share", total * w / F.sum(w).over(W.partitionBy(group)))


def running_clock(rows: DataFrame, group: str, order: str, amount: Column, group_total: DataFrame) -> DataFrame:
    """rows with start and end on a clock that runs through the groups in order. group_total: group, total (a row each)."""
    run = S.scan(group_total.select(group, "total"), [group], {"_base": S.Running("sum", F.col("total"))})
    base = run.select(group, (F.col("_base") - F.col("total")).alias("_base"))
    inside = W.partitionBy(group).orderBy(order)
    end = F.sum(amount).over(inside.rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("_end", end).join(base, group).withColumn("end", F.col("_base") + F.col("_end")).withColumn("start", F.col("end") - amount).drop("_base", "_end")


def hold_previous(rows: DataFrame, group: str, order: str, value: str, missing: Column) -> DataFrame:
    """rows with null values filled from the last one before, across groups in order; `missing` where there is none."""
    filled = S.scan(rows, [group, order], {"filled": S.Running("last", F.col(value))})
    return filled.withColumn("filled", F.coalesce("filled", missing))


def carry_first(rows: DataFrame, carried: DataFrame, group: str, order: str, names: str) -> DataFrame:
    """rows whose group's first row also gets the names carried over from the group before. carried: group (before), carried."""
    over = carried.select((F.col(group) + 1).alias(group), "carried")
    first = F.row_number().over(W.partitionBy(group).orderBy(order)) == 1
    got = rows.withColumn("_first", first).join(over, group, "left")
    add = F.when(F.col("_first") & F.col("carried").isNotNull(), F.col("carried")).otherwise(F.array().cast("array<string>"))
    return got.withColumn(names, F.array_union(names, add)).drop("_first", "carried")


def drop_consecutive(rows: DataFrame, group: str, order: str, value: str, only: Column | None = None) -> DataFrame:
    """Rows whose value isn't that of the row before; with `only`, rows for which it doesn't hold stay."""
    before = F.lag(value).over(W.partitionBy(group).orderBy(order))
    first = F.lag(F.lit(1)).over(W.partitionBy(group).orderBy(order)).isNull()
    keep = first | ~before.eqNullSafe(F.col(value))
    return rows.withColumn("_keep", keep if only is None else keep | ~only).where("_keep").drop("_keep")


def trim_leading(rows: DataFrame, group: str, order: str, echo: Column) -> DataFrame:
    """Rows from the first one on that isn't an echo."""
    seen = F.max((~echo).cast("int")).over(W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return rows.withColumn("_seen", seen).where("_seen = 1").drop("_seen")


def numbered(rows: DataFrame, order: str) -> DataFrame:
    """rows with `n` = 0, 1, ... in order of a column."""
    return S.numbered(rows, [order])


def batches(rows: DataFrame, order: str, size: int) -> DataFrame:
    return numbered(rows, order).withColumn("batch", F.floor(F.col("n") / size).cast("long")).drop("n")


def restart_numbers(rows: DataFrame, group: str, order: str, is_header: Column) -> DataFrame:
    """The rows that aren't headers, with volume and chapter: a header starts a volume only if a row came before it."""
    w = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    flagged = rows.withColumn("_h", is_header.cast("int"))
    # Headers in a row, or before any row, count once: one counts where the row before it isn't a header.
    before = F.lag("_h").over(W.partitionBy(group).orderBy(order))
    counts = flagged.withColumn("_v", F.when((F.col("_h") == 1) & (before == 0), 1).otherwise(0))
    counts = counts.withColumn("volume", (F.sum("_v").over(w) + 1).cast("int")).where("_h = 0")
    chapter = F.row_number().over(W.partitionBy(group, "volume").orderBy(order))
    return counts.withColumn("chapter", chapter).drop("_h", "_v")


def fallback_numbers(rows: DataFrame, group: str, order: str, parsed: str) -> DataFrame:
    """rows with `number`: the parsed one, or the next after the largest number so far (from 1)."""
    before = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    gaps = rows.withColumn("_u", F.coalesce(F.sum(F.col(parsed).isNull().cast("int")).over(before), F.lit(0)))
    top = F.max(F.when(F.col(parsed).isNotNull(), F.col(parsed) + 1 - F.col("_u"))).over(before)
    return gaps.withColumn("number", F.coalesce(F.col(parsed), F.col("_u") + F.greatest(F.lit(1), F.coalesce(top, F.lit(1))))).drop("_u")


def volumes_of(outline: DataFrame, doc: str) -> DataFrame:
    """Outline rows (doc, seq, title, page, level) with the seq of the level-0 item they are below."""
    w = W.partitionBy(doc).orderBy("seq").rowsBetween(W.unboundedPreceding, 0)
    return outline.withColumn("volume_seq", F.last(F.when(F.col("level") == 0, F.col("seq")), ignorenulls=True).over(w))


def outline_ends(outline: DataFrame, doc: str, last: int = 999_999) -> DataFrame:
    """Outline rows with end_page: the page before the next item of no deeper level (0 if that has no page), else `last`.

    For each level that occurs, a running window from the end of the document holds the last item seen of that level or above; all
    share one sort, so the work is rows times levels.
    """
    deepest = outline.agg(F.max("level")).first()[0]
    w = W.partitionBy(doc).orderBy(F.desc("seq")).rowsBetween(W.unboundedPreceding, -1)
    hit = F.lit(None).cast("struct<page:int>")
    for n in range((deepest if deepest is not None else -1) + 1):
        after = F.last(F.when(F.col("level") <= n, F.struct(F.col("page").cast("int").alias("page"))), ignorenulls=True).over(w)
        hit = F.when(F.col("level") == n, after).otherwise(hit)
    return outline.withColumn("_hit", hit).withColumn("end_page", F.when(F.col("_hit").isNull(), last).otherwise(F.coalesce(F.col("_hit.page") - 1, F.lit(0)))).drop("_hit")


def clip_slices(rows: DataFrame) -> DataFrame:
    """start, end within volume_start..volume_end, with a status: ok, moved (start was outside) or failed (start after end)."""
    outside = F.col("start").isNull() | (F.col("start") < F.col("volume_start")) | (F.col("start") > F.col("volume_end"))
    start = F.when(outside, F.col("volume_start")).otherwise(F.col("start"))
    end = F.least("end", "volume_end")
    moved = F.col("start").isNotNull() & outside
    status = F.when(start > end, "failed").when(moved, "moved").otherwise("ok")
    return rows.withColumn("clip_start", start).withColumn("clip_end", end).withColumn("status", status)


def paragraphs(lines: DataFrame, doc: str, order: str, text: str, starts: Column) -> DataFrame:
    """Lines joined by spaces into paragraphs: a blank line ends one, a line that `starts` one begins one. Columns doc, par, text."""
    blank = F.trim(F.col(text)) == ""
    w = W.partitionBy(doc).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    island = F.sum((blank | starts).cast("int")).over(w)
    kept = lines.withColumn("par", island).where(~blank)
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(order), F.trim(F.col(text)).alias("t")))), lambda x: x["t"]), " ")
    return kept.groupBy(doc, "par").agg(joined.alias(text))


def header_scan(rows: DataFrame, text: str, pattern: str, expected: Column | None = None, first: int = 10) -> DataFrame:
    """rows with the number and title of the first of the first lines that match (and have the expected number)."""
    lines = F.slice(F.split(F.col(text), "\n"), 1, first)
    number = lambda line: F.regexp_extract(line, pattern, 1).try_cast("int")
    good = F.filter(lines, lambda x: number(x).isNotNull() & (F.lit(True) if expected is None else number(x) == expected))
    hit = F.try_element_at(good, F.lit(1))
    return rows.withColumn("header_number", number(hit)).withColumn("header_title", F.nullif(F.regexp_extract(hit, pattern, 2), F.lit("")))
