"""Range lookups: the first of many, possibly overlapping, ranges that holds a value.

Ranges may be of any type that Spark orders. Few are looked up in place. Many are swept: the ends of all ranges are sorted
(quire.operators.scans) and each part of the order is swept by itself, with a heap of the ranges that hold the place, the first
by position on top. A range that ends in a part and starts before it is known from its end; of those that reach across a whole
part only the first matters, which is found over dyadic blocks of parts. So each range costs its two ends and two blocks of
each size at most. What the sweep gives is the winner from each end on; values are put among the ends and take the last winner.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import scans as S

#: Ranges up to this number are looked up in place, as one literal; the rows are the same.
FEW = 1000


def sweep(places: list[int], kinds: list[int], ranks: list[int], before: int | None) -> Iterator[tuple[int, int | None]]:
    """From the ends of ranges in order (kind 0: a range starts, 2: it ends), of one part: indices at which the winner changes,
    and the winner's rank. before: the first range that reaches across the whole part."""
    started, ended = ({r for k, r in zip(kinds, ranks, strict=True) if k == kind} for kind in (0, 2))
    heap = list(ended - started) + ([] if before is None else [before])
    heapq.heapify(heap)
    gone, last = set(), ()
    for i in range(len(places)):
        if kinds[i] == 0:
            heapq.heappush(heap, ranks[i])
        else:
            gone.add(ranks[i])
        while heap and heap[0] in gone:
            gone.discard(heapq.heappop(heap))
        winner = heap[0] if heap else None
        if winner != last:
            yield i, winner
            last = winner


def across(ends: DataFrame) -> DataFrame:
    """p and `best`, the first of the ranges that reach across all of part p. ends: p, kind, rank."""
    spans = ends.groupBy("rank").agg((F.min("p") + 1).alias("a"), (F.max("p") - 1).alias("b")).where("a <= b")
    level = spans.withColumn("level", F.explode(F.expr("sequence(0, CAST(floor(log2(b - a + 1)) AS INT))")))
    block = level.withColumn("block", F.explode(F.expr("array_distinct(array(shiftright(a + shiftleft(1L, level) - 1, level), shiftright(b + 1, level) - 1))")))
    inside = lambda b, n: f"(shiftleft({b}, {n}) >= a AND shiftleft({b} + 1, {n}) - 1 <= b)"
    blocks = block.where(f"{inside('block', 'level')} AND NOT {inside('shiftright(block, 1)', '(level + 1)')}").groupBy("level", "block").agg(F.min("rank").alias("best"))
    parts = ends.select("p").distinct().withColumn("level", F.explode(F.expr("sequence(0, 31)"))).withColumn("block", F.expr("shiftright(p, level)"))
    return parts.join(blocks, ["level", "block"]).groupBy("p").agg(F.min("best").alias("best"))


def winners(ranges: DataFrame) -> DataFrame:
    """v, k, m and rank: from the place (v, k, m) on, the first of the ranges (lo, hi, rank: unique) that hold it (null: none)."""
    folder = S.scratch(ranges.sparkSession)
    both = F.explode(F.array(F.struct(F.col("lo").alias("v"), F.lit(0).alias("k")), F.struct(F.col("hi").alias("v"), F.lit(2).alias("k"))))
    ends = S.sorted_table(ranges.select("rank", both.alias("_e")).select("_e.v", "_e.k", "rank"), ["v", "k"], folder, "ends").withColumn("p", F.shiftright("_m", 33))
    best = S.cut(across(ends), folder, "across")
    schema = T.StructType([ends.schema["v"], T.StructField("k", T.IntegerType()), T.StructField("m", T.LongType()), T.StructField("rank", T.LongType())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_m")
        found = list(sweep(table.column("_m").to_pylist(), table.column("k").to_pylist(), table.column("rank").to_pylist(), table.column("best")[0].as_py()))
        at = pa.array([i for i, _ in found], pa.int64())
        return pa.table({"v": table.column("v").take(at), "k": table.column("k").take(at), "m": table.column("_m").take(at), "rank": pa.array([w for _, w in found], pa.int64())})

    return ends.join(best, "p", "left").groupBy("p").applyInArrow(run, schema)


def first_holding(values: DataFrame, ranges: DataFrame) -> DataFrame:
    """v and rank of the first range that holds each of the values (v, distinct). Values and ends are compared in one type."""
    common = values.select("v").union(ranges.select("lo")).union(ranges.select("hi")).schema["v"].dataType
    changes = winners(ranges.select(F.col("lo").cast(common).alias("lo"), F.col("hi").cast(common).alias("hi"), "rank"))
    none = F.lit(None).cast("struct<rank:bigint>")
    rows = changes.select("v", "k", "m", F.struct("rank").alias("w")).unionByName(values.select(F.col("v").cast(common).alias("v"), F.lit(1).alias("k"), F.lit(0).cast("long").alias("m"), none.alias("w")))
    rows = S.cut(rows, S.scratch(values.sparkSession), "marks")  # counted, sampled and sorted: written once
    got = S.scan(rows, ["v", "k", "m"], {"w": S.Running("last", F.col("w"))})
    return got.where("k = 1").select(F.col("v"), F.col("w.rank").alias("rank")).where("rank is not null")


def range_lookup(rows: DataFrame, number: str, ranges: DataFrame, values: list[str], otherwise: str = "last", few: int = FEW) -> DataFrame:
    """rows with the values of the first range (pos, lo, hi, values) in order of pos that holds `number`; ties of pos go by lo,
    hi and values.

    otherwise: what a number without a range gets, the values of the `last` range or `null`. A null number has no range, a
    range with a null end or with lo > hi holds nothing. Up to `few` ranges become one row that is broadcast, and each row is
    looked up in place; more are swept. Number and ends may be of any ordered type and are compared as Spark compares them.
    """
    names = ["pos", "lo", "hi", *values]
    if ranges.limit(few + 1).count() <= few:
        table = ranges.agg(F.sort_array(F.collect_list(F.struct(*names))).alias("_ranges"))
        hit = F.try_element_at(F.filter("_ranges", lambda r: F.col(number).between(r["lo"], r["hi"])), F.lit(1))
        found = F.coalesce(hit, F.try_element_at("_ranges", F.lit(-1))) if otherwise == "last" else hit
        got = rows.join(F.broadcast(table), F.lit(True), "left").withColumn("_hit", found)
    else:
        folder = S.scratch(rows.sparkSession)
        kept = S.cut(S.numbered(ranges.where("lo <= hi").select(*names), names, "rank"), folder, "ranges")
        values_ = rows.select(F.col(number).alias("v")).where("v is not null").distinct()
        held = first_holding(values_, kept).join(kept.select("rank", F.struct(*values).alias("_hit")), "rank").select(F.col("v").alias("_v"), "_hit")
        got = rows.join(held, F.col(number).cast(held.schema["_v"].dataType) == F.col("_v"), "left")
        if otherwise == "last":
            final = ranges.agg(F.max(F.struct(*names)).alias("_final"))  # one row
            got = got.join(F.broadcast(final), F.lit(True), "left").withColumn("_hit", F.coalesce("_hit", F.struct(*[F.col("_final")[v].alias(v) for v in values])))
    return got.select(*[F.col(c) for c in rows.columns], *[F.col("_hit")[v].alias(v) for v in values])
