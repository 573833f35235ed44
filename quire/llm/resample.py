"""Importance resampling towards a target: hashed word runs, weights by their frequency ratio, and a weighted draw.

Features are the runs of 1 to `most` consecutive words; a feature's bucket is the CRC-32 of its text modulo BUCKETS. Counts of
buckets over all documents and over the target texts give each bucket a gain, and a document's weight is the mean gain of its
features. A document's score adds Gumbel noise from its key's hash, so that the highest scores are a draw without replacement.

Long texts are skewed work, so they are split at word boundaries into chunks of about CHUNK bytes, with the `most` - 1 words that
follow carried along. A chunk owns the runs that start in it. Chunks are dealt to tasks and written once; counts are summed over
chunks, and weights by document. Short texts are read where they are. CRCs are advanced for all words of a block together.

Each task sends its counts of buckets once. The summed counts (BUCKETS rows) are all that reaches the driver. Ranks come from
range partitions of the scores: only the number of rows of each partition reaches the driver.

Defined cases: null and empty texts and texts without a word have no features and weight 0; a null key hashes as the empty key;
rows that repeat are scored each, ties go to the smaller key and then to the order of the input; without target texts all
target counts are 0; an empty table gives no rows. Other columns don't matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import chunked, cut, parts, scratch, utf8

#: Most words of a run, buckets, fewest words of a document that can be drawn, percent drawn, and the seed of the draw.
MOST, BUCKETS, LEAST, PERCENT, SEED = 1, 10_000, 20, 10, 2024
#: Bytes of a chunk, of a block handled at a time, and of words whose CRCs are advanced together.
CHUNK, BLOCK, TOGETHER = 256 << 10, 1 << 20, 48
#: Lower case of A-Z, and the bytes of words: digits, a-z and all of other characters.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def crc_table() -> np.ndarray:
    """The CRC-32 of each byte, by its polynomial."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, out >> 1 ^ np.uint32(0xEDB88320), out >> 1).astype(np.uint32)
    return out


_CRC = crc_table()


def advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states after the bytes start to end each: byte by byte for all at once, the few long ones by themselves."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    state, start, size = state[order], start[order], size[order]
    long = int(np.searchsorted(-size, -TOGETHER, side="left"))
    for i in range(long):
        state[i] = zlib.crc32(data[start[i] : start[i] + size[i]].tobytes(), int(~state[i])) ^ 0xFFFFFFFF
    state_, start, size = state[long:], start[long:], size[long:]
    for j in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -j, side="left"))  # those longer than j
        state_[:n] = _CRC[(state_[:n] ^ data[start[:n] + j]) & np.uint32(255)] ^ state_[:n] >> np.uint32(8)
    out = np.empty_like(state)
    out[order] = state
    return out


def features(texts: list[bytes], own: np.ndarray, most: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... `most` words that start in the first `own` bytes of each text: their buckets and their texts."""
    data = _LOWER[np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)]
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[1:] = _WORD[data]
    step = np.diff(inside)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    base = np.cumsum(np.array([0, *[len(t) + 1 for t in texts]], dtype=np.int64))
    of = np.searchsorted(base, start, side="right") - 1
    mine = np.flatnonzero(start - base[of] < own[of])
    state = advance(np.full(len(mine), 0xFFFFFFFF, dtype=np.uint32), data, start[mine], end[mine])
    for m in range(1, most + 1):
        if m > 1:
            on = np.flatnonzero(mine + m - 1 < len(start))
            on = on[of[mine[on] + m - 1] == of[mine[on]]]
            mine, state = mine[on], state[on]
            state = _CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ state >> np.uint32(8)
            state = advance(state, data, start[mine + m - 1], end[mine + m - 1])
        yield (~state).astype(np.int64) % buckets, of[mine]


def split(text: bytes, size: int, carry: int) -> list[tuple[int, int, int]]:
    """Chunks of a text: first byte, last + 1 byte of the part that it owns, and of the part that it carries."""
    word = _WORD[_LOWER[np.frombuffer(text, dtype=np.uint8)]]
    gaps = np.flatnonzero(~word)
    ends = np.flatnonzero(np.diff(np.append(word, False).astype(np.int8)) == -1) + 1 if carry else gaps
    out, at = [], 0
    while at < len(text):
        g = int(np.searchsorted(gaps, at + size))
        stop = int(gaps[g]) if g < len(gaps) else len(text)
        stop = max(stop, at + 1)
        e = int(np.searchsorted(ends, stop, side="right")) + carry - 1
        out.append((at, stop, stop if not carry else int(ends[e]) if e < len(ends) else len(text)))
        at = stop
    return out


def pieces(docs: DataFrame, text: str, key: str, most: int, chunk: int) -> tuple[DataFrame, DataFrame]:
    """Short texts and the chunks of long ones: k, u (a number for each long text, null for short ones), own, piece (bytes)."""
    rows = docs.select(F.col(key).alias("k"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("piece"))
    size = F.octet_length("piece")
    short = rows.where(size <= chunk).select("k", F.lit(None).cast("long").alias("u"), size.cast("long").alias("own"), "piece")
    schema = T.StructType([T.StructField("k", docs.schema[key].dataType), T.StructField("u", T.LongType()), T.StructField("own", T.LongType()), T.StructField("piece", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(2).to_pylist()):
                found = split(t, chunk, most - 1)
                for lo in range(0, len(found), 16):
                    some = found[lo : lo + 16]
                    at = pa.array([i] * len(some))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([b - a for a, b, _ in some], pa.int64()), pa.array([t[a:c] for a, _, c in some], pa.binary())], names=schema.names)

    long = rows.where(size > chunk).select("k", F.monotonically_increasing_id().alias("u"), "piece").mapInArrow(run, schema)
    return short, cut(long.repartition(parts(docs.sparkSession), "u", F.xxhash64("piece")), scratch(docs.sparkSession), "chunks")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray]]:
    """Batches cut to blocks, with texts (the last column) and how many bytes of each are owned (the one before)."""
    for batch in batches:
        texts = utf8(batch.column(batch.num_columns - 1))
        own = batch.column(batch.num_columns - 2).to_numpy(zero_copy_only=False)
        for lo, hi in chunked(list(map(len, texts)), BLOCK):
            yield batch.slice(lo, hi - lo), texts[lo:hi], own[lo:hi]


def counts(rows: DataFrame, most: int, buckets: int) -> np.ndarray:
    """How many features of all pieces are in each bucket; a task sends each bucket once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, texts, own in blocks(batches):
            for found, _ in features(texts, own, most, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    summed = rows.select("own", "piece").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in summed.collect():  # a row for each bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's share of the target by its share of the source, both smoothed by one, floored."""
    n, big_s, big_t = len(source), float(source.sum() + len(source)), float(target.sum() + len(target))
    ratio = ((float(target[i]) + 1) * big_s / ((float(source[i]) + 1) * big_t) for i in range(n))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weighed(rows: DataFrame, gain: np.ndarray, most: int) -> DataFrame:
    """k, u, n_words, n_features and total (of the gains) of each piece."""
    schema = T.StructType([rows.schema["k"], rows.schema["u"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "total")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, own in blocks(batches):
            sums = np.zeros((3, len(texts)), dtype=np.int64)
            for m, (found, of) in enumerate(features(texts, own, most, len(gain))):
                n = np.bincount(of, minlength=len(texts))
                sums[0] += n * (m == 0)
                sums[1] += n
                before = np.concatenate([[0], np.cumsum(gain[found])])
                ends = np.cumsum(n)
                sums[2] += before[ends] - before[ends - n]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x) for x in sums]], names=schema.names)

    return rows.select("k", "u", "own", "piece").mapInArrow(run, schema)


def gumbel(key: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise from the key's hash, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """rows with `place`, 1, 2, ... in order: range partitions are sorted, and each starts at the rows of those before it."""
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(max(16, parts(spark)), *order).sortWithinPartitions(*order)
    placed = cut(ranged.withColumn("_m", F.monotonically_increasing_id()), folder, "ranged")  # partition << 33 and place in it
    p = F.shiftright("_m", 33).cast("int")
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(p.alias("p")).agg(F.count("*").alias("n")).collect())
    before, starts = 0, []
    for i, n in sizes:
        starts.append((i, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(starts, "_p int, _b long"))  # a row for each partition
    at = F.col("_b") + F.expr("_m & ((1L << 33) - 1)") + 1
    return placed.withColumn("_p", p).join(starts, "_p").withColumn("place", at).drop("_p", "_m", "_b")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", most: int = MOST, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: int = SEED, chunk: int = CHUNK) -> DataFrame:
    """key, n_features, weight, score and rank (null: not drawn) of each row of docs. target: texts in a column of the same name."""
    folder = scratch(docs.sparkSession)
    short, long = pieces(docs, text, key, most, chunk)
    source = counts(short.unionByName(long), most, buckets)
    few, many = pieces(target.select(text, F.lit(0).alias("_k")), text, "_k", most, chunk)
    gain = gains(source, counts(few.unionByName(many), most, buckets))
    sums = weighed(long, gain, most).groupBy("u").agg(F.first("k").alias("k"), *[F.sum(c).alias(c) for c in ("n_words", "n_features", "total")])
    whole = weighed(short, gain, most).unionByName(sums)
    weight = F.expr("IF(n_features = 0, 0L, (total - pmod(total, n_features)) div n_features)")
    scored = whole.withColumn("weight", weight).withColumn("score", F.col("weight") + gumbel(F.col("k"), seed)).withColumn("_t", F.monotonically_increasing_id())
    scored = cut(scored.select("k", "n_words", "n_features", "weight", "score", "_t"), folder, "scored")
    able = scored.where(F.col("n_words") >= least)
    drawn = able.count() * percent // 100
    got = ranked(able, [F.desc("score"), F.asc("k"), F.asc("_t")], folder).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
    rest = scored.where(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    names = [F.col("k").alias(key), "n_features", "weight", "score", "rank"]
    return got.select(*names).unionByName(rest.select(*names))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw of a tenth of the documents, weighted towards the benchmark's words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return resample(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text"))
