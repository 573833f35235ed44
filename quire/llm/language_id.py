"""Language identification by prediction by partial matching (PPM).

One byte context tree per language, of orders 0 to ORDER, with frozen counts and method-C escapes: in a context with n
counted bytes, of which d differ, a byte seen c times costs -log2(c / (n + d)) and an escape to the next shorter context
-log2(d / (n + d)); below order 0 all 256 bytes are alike. A context ends at the last white space before its byte, so the
exact code length of a text is a sum over its bytes that NumPy takes in blocks, without a loop over bytes.
A text gets the language with the shortest code; the score is that language's share when code lengths per byte become
probabilities.

The trees learn from a sample of labelled rows: up to SAMPLE rows of each language in expectation, chosen by a hash of the
key. Prediction reads whole texts.

Defined cases: null text and text without a letter give `und` and score 0; equal code lengths give the language that is
first in order of name; with no learned language every text is `und`. Columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import SPACE, Table, chunked

#: Longest context in bytes.
ORDER = 4
#: Rows learned from, per language.
SAMPLE = 1500
#: Bytes that are coded at a time.
BLOCK = 1 << 18
UNDETERMINED = "und"
_HAS_LETTER = r"\p{L}"


def spread(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coded bytes of texts, each after one space: the byte with the `order` bytes before it packed into one number,
    the length of its context (0 for white space, which also ends contexts) and the ends of the texts."""
    data = np.frombuffer(b"".join([b" " + t for t in texts]), dtype=np.uint8)
    gap = SPACE[data]
    data = np.where(gap, np.uint8(32), data).astype(np.int64)
    index = np.arange(len(data))
    place = np.minimum(index - np.maximum.accumulate(np.where(gap, index, 0)), order)
    packed = data.copy()
    for k in range(1, order + 1):
        packed[k:] |= data[:-k] << (8 * k)
    return packed, place, np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)))


def node(packed: np.ndarray, order: int) -> np.ndarray:
    """The tree node of a byte in its context of length `order`: the order, the context and the byte."""
    return packed & ((1 << 8 * (order + 1)) - 1) | (order + 1) << 48


class Trees:
    """Frozen context trees of all languages. cost: of each known (context, byte), with all escapes; escape: of each context."""

    def __init__(self, langs: list[str], nodes: np.ndarray, counts: np.ndarray, order: int = ORDER):
        """nodes: sorted; counts: a row for each node, a column for each language."""
        self.langs, self.order, n = langs, order, len(langs)
        at_order = (nodes >> 48) - 1
        parent = nodes >> 8 & (1 << 40) - 1 | nodes >> 48 << 40
        contexts, at = np.unique(parent, return_inverse=True)
        total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
        np.add.at(total, at, counts)
        np.add.at(kinds, at, counts > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(counts > 0, -np.log2(counts / (total + kinds)[at]), 0)
            self.escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0).astype(np.float32)
        self.contexts = Table(contexts, np.arange(len(contexts), dtype=np.int64))
        self.nodes = Table(nodes, np.arange(len(nodes), dtype=np.int64))
        self.cost = np.zeros((len(nodes), n), dtype=np.float32)
        for k in range(order + 1):
            rows = np.flatnonzero(at_order == k)
            shorter = self._bits(nodes[rows], np.full(len(rows), k - 1), k - 1)
            self.cost[rows] = np.where(counts[rows] > 0, own[rows], self.escape[at[rows]] + shorter)

    def _bits(self, packed: np.ndarray, place: np.ndarray, order: int) -> np.ndarray:
        """Bits of each byte in each language, from its context of length `place` and the shorter ones."""
        bits, waiting = np.zeros((len(packed), len(self.langs)), dtype=np.float32), np.zeros(0, dtype=np.int64)
        for k in range(order, -1, -1):
            rows = np.concatenate([waiting, np.flatnonzero(place == k)])
            want = node(packed[rows], k)
            found = self.nodes.get(want)
            hit = found >= 0
            bits[rows[hit]] += self.cost[found[hit]]
            waiting = rows[~hit]
            up = self.contexts.get(want[~hit] >> 8 & (1 << 40) - 1 | (k + 1) << 40)
            bits[waiting[up >= 0]] += self.escape[up[up >= 0]]
        bits[waiting if order >= 0 else slice(None)] += np.float32(8)
        return bits

    def measure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each whole text in each language, and the bytes coded."""
        out, size = np.zeros((len(texts), len(self.langs))), np.array([len(t) + 1 for t in texts], dtype=float)
        for lo, hi in chunked([len(t) + 1 for t in texts], BLOCK):
            packed, place, ends = spread(texts[lo:hi], self.order)
            begin = np.concatenate([[0], ends])
            for a in range(0, len(packed), BLOCK):  # a single long text goes through in blocks
                bits = self._bits(packed[a : a + BLOCK], place[a : a + BLOCK], self.order)
                total = np.concatenate([np.zeros((1, len(self.langs))), np.cumsum(bits, axis=0, dtype=float)])
                cut = np.clip(begin - a, 0, len(bits))
                out[lo:hi] += total[cut[1:]] - total[cut[:-1]]
        return out, size


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", sample: int = SAMPLE, order: int = ORDER) -> Trees:
    """Context trees from the rows of df whose language isn't null.

    Counts of rows by language come from all rows; texts come from `sample` rows of each language in expectation. The trees
    reach the driver as one row of counts for each context and byte of that bounded sample.
    """
    rows = df.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).cast("string").alias("l"))
    sizes = {r["l"]: r["n"] for r in df.where(F.col(lang).isNotNull()).groupBy(F.col(lang).cast("string").alias("l")).agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Trees([], np.zeros(0, np.uint64), np.zeros((0, 0)), order)
    share = F.create_map(*[x for v in langs for x in (F.lit(v), F.lit(min(1.0, sample / sizes[v])))])
    draw = F.pmod(F.xxhash64(F.col("k").cast("string")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = rows.where(draw < share[F.col("l")]).select("t", "l")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, of = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in sorted(set(of)):
                packed, place, _ = spread([t.encode() for t, x in zip(texts, of, strict=True) if x == name], order)
                found = [np.unique(node(packed[place >= k], k), return_counts=True) for k in range(order + 1)]
                flat = np.concatenate([x for x, _ in found])
                counts = np.concatenate([x for _, x in found]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(flat)), pa.array(flat), pa.array(counts)], names=["l", "node", "n"])

    got = chosen.mapInArrow(count, "l string, node long, n long").groupBy("node", "l").agg(F.sum("n").alias("n")).toArrow()
    nodes, at = np.unique(got.column("node").to_numpy(), return_inverse=True)
    which = {v: i for i, v in enumerate(langs)}
    counts = np.zeros((len(nodes), len(langs)))
    np.add.at(counts, (at, np.array([which[x] for x in got.column("l").to_pylist()], dtype=int)), got.column("n").to_numpy())
    return Trees(langs, nodes, counts, order)


def score_column(spark: SparkSession, trees: Trees, text: str | Column) -> Column:
    """A struct column: lang, score, bits (the shortest code) and raw_bits (8 for each byte coded) of each whole text."""
    cast = spark.sparkContext.broadcast(trees)
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits", T.DoubleType()), T.StructField("raw_bits", T.DoubleType())])

    @F.arrow_udf(kind)
    def run(column: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        model = cast.value
        texts = [x if x is not None else b"" for x in pc.cast(column, pa.binary()).to_pylist()]
        lettered = pc.fill_null(pc.match_substring_regex(column, _HAS_LETTER), False).to_pylist()
        langs, scores, least, raw = [], [], [], []
        for lo, hi in chunked(list(map(len, texts)), 4 << 20):
            bits, size = model.measure(texts[lo:hi])
            for b, n, ok in zip(bits, size, lettered[lo:hi], strict=True):
                if not ok or not len(b):
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    least.append(float(b.min()) if len(b) else 8 * n)
                else:
                    i = int(b.argmin())
                    langs.append(model.langs[i])
                    scores.append(float(1 / np.exp2(-np.minimum((b - b[i]) / max(n, 1) * 8, 60)).sum()))
                    least.append(float(b[i]))
                raw.append(8.0 * n)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(least, pa.float64()), pa.array(raw, pa.float64())], names=["lang", "score", "bits", "raw_bits"])

    return run(text)


def predict(df: DataFrame, trees: Trees, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """df with the predicted language and its score."""
    got = df.withColumn("_ppm", score_column(df.sparkSession, trees, F.col(text)))
    return got.withColumn(out, F.col("_ppm.lang")).withColumn(score, F.col("_ppm.score")).drop("_ppm")


def reject(df: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """The rows of df whose text some language accounts for: not `und`, and coded in fewer bits than its bytes have."""
    got = df.withColumn("_ppm", score_column(df.sparkSession, trees, F.col(text)))
    return got.where((F.col("_ppm.lang") != UNDETERMINED) & (F.col("_ppm.bits") < F.col("_ppm.raw_bits"))).drop("_ppm")


def held_out(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(3)) == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from two thirds of the documents and predict the language of all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = learn(docs.where(~F.coalesce(held_out(), F.lit(False))))
    return predict(docs.select("doc_id", "text", held_out().alias("held_out")), trees).select("doc_id", "held_out", "lang_pred", "score")
