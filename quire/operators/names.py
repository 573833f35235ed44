"""All names in all texts: one pass of an automaton over each text, whatever the number of names.

The distinct names are cut into blocks of bounded bytes (a running sum over all names), and each block's Aho-Corasick automaton
goes over the texts once. A text is never paired with names that it doesn't hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import scans as S

#: UTF-8 bytes of the names of one automaton, which takes about a hundred times as much memory.
BLOCK = 1 << 20


def found_in(automaton, text: str) -> dict[str, tuple[int, int]]:
    """How often each name occurs in the text, overlaps too, and where it starts first."""
    out: dict[str, tuple[int, int]] = {}
    for end, name in automaton.iter(text):
        n, first = out.get(name, (0, end - len(name) + 1))
        out[name] = n + 1, first
    return out


def occurrences(texts: DataFrame, names: DataFrame, keep: list[str], text: str = "text", name: str = "name", block: int = BLOCK) -> DataFrame:
    """The columns `keep` of texts, name, n and first: a row for each different name that a text holds, in any case of letters.

    name is the name in lower case, n how often it occurs as a part of the text (overlaps too), first the place of the first
    letter of its first occurrence in the lower-cased text. Null and empty names and texts hold and are held by nothing; names that
    differ only in case are one; rows of texts that repeat are answered for each.
    """
    import ahocorasick  # noqa: F401  (missing here is better than in every task)

    spark = texts.sparkSession
    lowered = names.select(low(F.col(name).cast("string")).alias("n")).where("n is not null and n <> ''").distinct()
    sizes = S.scan(lowered, ["n"], {"_s": S.Running("sum", F.octet_length("n").cast("long"))}).withColumn("_b", F.expr(f"(_s - octet_length(n)) div {block}"))
    held = S.cut(sizes.select("n", "_b"), S.scratch(spark), "names")
    kept = [c for c in keep if c not in ("name", "n", "first")]
    fields = T.StructType([*[texts.schema[c] for c in kept], T.StructField("name", T.StringType()), T.StructField("n", T.LongType()), T.StructField("first", T.LongType())])
    out = spark.createDataFrame([], fields)
    for r in held.select("_b").distinct().orderBy("_b").collect():
        words = [x["n"] for x in held.where(F.col("_b") == r["_b"]).collect()]  # `block` bytes and one name at most
        out = out.unionByName(texts.select(*kept, F.col(text).alias("_t")).mapInArrow(searcher(spark.sparkContext.broadcast(words), fields), fields))
    return out


@F.arrow_udf(T.StringType())
def low(column: pa.Array) -> pa.Array:
    """Lower case, as the texts are lowered."""
    return pa.array([None if x is None else x.lower() for x in column.to_pylist()], pa.string())


def searcher(words, fields: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for w in words.value:
            automaton.add_word(w, w)
        automaton.make_automaton()
        for batch in batches:
            of, rows = [], []
            for i, t in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                got = found_in(automaton, (t or "").lower())
                of += [i] * len(got)
                rows += [(n, *v) for n, v in got.items()]
                if len(rows) > 1 << 14:
                    yield answer(batch, of, rows, fields)
                    of, rows = [], []
            if rows:
                yield answer(batch, of, rows, fields)

    return run


def answer(batch: pa.RecordBatch, of: list[int], rows: list[tuple], fields: T.StructType) -> pa.RecordBatch:
    at, kinds = pa.array(of), (pa.string(), pa.int64(), pa.int64())
    made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays([*[batch.column(j).take(at) for j in range(batch.num_columns - 1)], *made], names=fields.names)


def held(tags: DataFrame, texts: DataFrame, on: list[str], text: str, needles: Column, name: str = "held") -> DataFrame:
    """tags with `name`: which of its needles (an array of lower-case strings) the text with the same keys `on` holds, null where
    there is no such text. texts: a row for each key. Each text is read once, however many tags it has."""
    asked = tags.withColumn("_needles", F.array_sort(F.array_distinct(F.filter(needles, lambda x: x.isNotNull()))))
    wanted = asked.select(F.explode("_needles").alias("name"))
    found = occurrences(texts, wanted, on, text).select(*on, F.col("name").alias("_x"))
    each = asked.select(*on, "_needles").distinct().withColumn("_x", F.explode("_needles")).join(found, [*on, "_x"]).groupBy(*on, "_needles").agg(F.collect_set("_x").alias("_found"))
    there = texts.where(F.col(text).isNotNull()).select(*on, F.lit(True).alias("_there"))
    got = asked.join(each, [*on, "_needles"], "left").join(there, on, "left")
    # Every text holds the empty needle.
    whole = F.concat(F.coalesce("_found", F.array().cast("array<string>")), F.filter("_needles", lambda x: x == ""))
    return got.withColumn(name, F.when(F.col("_there"), whole)).drop("_needles", "_found", "_there")
