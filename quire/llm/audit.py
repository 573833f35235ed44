"""How filters interact: what each removes in every order, and what it would have removed anyway.

Texts are scanned in the buffers that Arrow delivers. A table of byte classes marks word bytes, capitals, symbols and first
bytes of characters; prefix sums over a block of texts give each text's counts at its two ends. Words are named by hashes that
are sorted within each text; neighbours with equal hashes are verified (names of up to 15 bytes are reversible, longer words are
compared byte by byte), and a text in which two words share a hash is counted again by the words themselves. So each text is
reduced to the letters of the filters that it fails, and the letters are counted by part. Orders and Shapley values come from
these counts, at most 2 ** 5 sets of letters for each part and label, never from the rows.

Filters: A, too few words; B, too few distinct words; C, too many capitals; D, a symbol; E, the text of a smaller key.

Defined cases: null text is the empty text; a null or empty part is the part ''; rows that repeat a key and its text are no
copies of each other, but of smaller keys' rows; a row with a null key copies nothing and is copied by none, and has no labels;
labels that repeat count if one of them does; an empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import SHORT, SPACE, chunked, cut, scratch, word_names

LETTERS = "ABCDE"
#: A: fewest words. B: distinct words of 100 words, at least. C: capitals of 100 characters, at most. D: symbols.
WORDS, DISTINCT, CAPITALS, SYMBOLS = 200, 50, 3, b"#$%&*|"
#: Bytes of text scanned at a time.
BLOCK = 2 << 20
_CAPITAL = np.zeros(256, dtype=bool)
_CAPITAL[65:91] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the place where each text starts (and the last ends), without a copy; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    places = np.frombuffer(places, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", dtype=np.uint8), places


def between(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set from each bound to the next, by prefix sums."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[bounds])


def distinct(data: bytes, start: np.ndarray, end: np.ndarray, of: np.ndarray, texts: int) -> np.ndarray:
    """The number of different words of each text; words are given by their first and last + 1 byte and their text, in order."""
    count = np.bincount(of, minlength=texts)
    if not len(start):
        return count
    names = word_names(data, start, end)
    key = of.astype(np.uint64) << np.uint64(44) | names[0] >> np.uint64(20)  # chunked gives a block fewer than 2 ** 20 texts
    order = np.argsort(key)
    a, b = order[:-1], order[1:]
    alike = key[a] == key[b]
    a, b = a[alike], b[alike]
    same = (names[:, a] == names[:, b]).all(axis=0)
    for i in np.flatnonzero(same & (end[a] - start[a] > SHORT)).tolist():
        same[i] = data[start[a[i]] : end[a[i]]] == data[start[b[i]] : end[b[i]]]
    count -= np.bincount(of[a], minlength=texts)
    for t in np.unique(of[a[~same]]).tolist():
        lo, hi = np.searchsorted(of, [t, t + 1])
        count[t] = len({data[x:y] for x, y in zip(start[lo:hi].tolist(), end[lo:hi].tolist(), strict=True)})
    return count


def scan(column: pa.Array, block: int = BLOCK) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    """Row ranges of a string column with the words, distinct words, capitals, characters and symbols of each text."""
    symbol = np.zeros(256, dtype=bool)
    symbol[list(SYMBOLS)] = True
    whole, places = buffers(column)
    for lo, hi in chunked(np.diff(places).tolist(), block, (1 << 20) - 1):
        data, bounds = whole[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
        inside = ~SPACE[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edge = bounds[:-1][bounds[:-1] < len(data)]  # words end with their text
        first[edge] = inside[edge]
        edge = bounds[1:][bounds[1:] > 0] - 1
        last[edge] = inside[edge]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        of = np.searchsorted(bounds, start, side="right") - 1
        yield lo, hi, {
            "words": between(first, bounds),
            "distinct": distinct(data.tobytes(), start, end, of, hi - lo),
            "capitals": between(_CAPITAL[data], bounds),
            "characters": between(_HEAD[data], bounds),
            "symbols": between(symbol[data], bounds),
        }


def own_failures(found: dict[str, np.ndarray]) -> np.ndarray:
    """A mask of the filters A to D that each text fails."""
    a = found["words"] < WORDS
    b = 100 * found["distinct"] < DISTINCT * found["words"]
    c = 100 * found["capitals"] > CAPITALS * found["characters"]
    return a + 2 * b + 4 * c + 8 * (found["symbols"] > 0)


def failures(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang", good: str = "quality", bad: str = "toxic") -> DataFrame:
    """A row for each document: k, part, fails (the letters of the filters that it fails), good and bad (whether a label says so)."""
    sets = np.array(["".join(x for i, x in enumerate(LETTERS) if m >> i & 1) for m in range(16)])
    fields = T.StructType([T.StructField("k", docs.schema[key].dataType), T.StructField("part", T.StringType()), T.StructField("own", T.StringType()), T.StructField("same", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, found in scan(batch.column(2)):
                rows = batch.slice(lo, hi - lo)
                whole, places = buffers(rows.column(2))
                view = memoryview(whole)
                same = [sha256(view[a:b]).digest() for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(sets[own_failures(found)], pa.string()), pa.array(same, pa.binary())], names=["k", "part", "own", "same"])

    wanted = docs.select(F.col(key).alias("k"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text).alias("text"))
    rows = cut(wanted.mapInArrow(run, fields), scratch(docs.sparkSession), "rows")
    keyed = rows.where("k is not null")
    # The first of equal texts is found by its text and key, so that no task gets all rows of one text.
    first = keyed.groupBy("same").agg(F.min("k").alias("k")).withColumn("first", F.lit(True))
    marked = keyed.join(first, ["k", "same"], "left").select("k", "part", F.concat("own", F.when(F.col("first"), "").otherwise("E")).alias("fails"))
    known = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(*[F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in ((good, "good"), (bad, "bad"))])
    no = F.lit(False)
    marked = marked.join(known, "k", "left").select("k", "part", "fails", F.coalesce("good", no).alias("good"), F.coalesce("bad", no).alias("bad"))
    return marked.unionByName(rows.where("k is null").select("k", "part", F.col("own").alias("fails"), no.alias("good"), no.alias("bad")))


def interactions(rows: DataFrame) -> DataFrame:
    """From failures: for each part, order of the filters and step what the step's filter does. Columns part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley (removed by the filter, over all orders)."""
    sets = rows.groupBy("part", "fails").agg(F.count("*").alias("n"), F.count_if("good").alias("n_good"), F.count_if("bad").alias("n_bad"))
    orders = ",".join("".join(p) for p in permutations(LETTERS))
    each = sets.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
    letter = F.expr("substring(filter_order, step, 1)")
    fails, still = F.contains("fails", letter), F.expr("translate(fails, substring(filter_order, 1, step - 1), '') = fails")
    total = lambda on, n="n": F.coalesce(F.sum(F.when(on, F.col(n))), F.lit(0)).alias
    # Of all orders, the filter comes first among the n filters that a text fails in one of n.
    share = F.when(fails, F.col("n") * F.try_divide(F.lit(len(orders.split(","))), F.length("fails")).cast("long")).otherwise(0)
    return each.groupBy("part", "filter_order", "step").agg(
        total(still & ~fails)("kept"),
        total(still & fails)("removed"),
        total(~still & fails)("redundant"),
        total(F.col("fails") == letter)("unique_fails"),
        total(still & fails, "n_good")("good_lost"),
        total(still & fails, "n_bad")("toxic_lost"),
        F.sum(share).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters does at every place of every order, for each language of the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return interactions(failures(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


OP12_SQL = r"""
with w as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
     f as (select doc_id, part, case when len(ws) < 200 then 'A' else '' end || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
           || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) then 'C' else '' end || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
           || case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end as fails from w),
     c as (select part, fails, count(*) as n, count(*) filter (where doc_id in (select doc_id from labels where quality = 1)) as g, count(*) filter (where doc_id in (select doc_id from labels where toxic = 1)) as x from f group by all),
     l(l) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
     o as (select a.l || b.l || c.l || d.l || e.l as o from l a, l b, l c, l d, l e where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
     s as (select o, cast(step as int) as step, substr(o, step, 1) as f, substr(o, 1, step - 1) as p from o, (select unnest(range(1, 6)) as step)),
     j as (select part, o, step, f, fails, n, g, x, contains(fails, f) as hit, translate(fails, p, '') = fails as still from c, s)
select part, o as filter_order, step, coalesce(sum(n) filter (where still and not hit), 0)::bigint as kept, coalesce(sum(n) filter (where still and hit), 0)::bigint as removed,
       coalesce(sum(n) filter (where hit and not still), 0)::bigint as redundant, coalesce(sum(n) filter (where fails = f), 0)::bigint as unique_fails, coalesce(sum(g) filter (where still and hit), 0)::bigint as good_lost,
       coalesce(sum(x) filter (where still and hit), 0)::bigint as toxic_lost, coalesce(sum(n * (120 // greatest(length(fails), 1))) filter (where hit), 0)::bigint as shapley from j group by part, o, step
"""
