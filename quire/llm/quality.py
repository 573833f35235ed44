"""Quality scores from two compressors.

Two zstandard dictionaries are trained, one on text labelled good and one on text labelled bad. A text is cut into blocks,
each block is compressed with either dictionary, and x = (bytes with the bad one - bytes with the good one) / bytes of the
text says which class it resembles. A logistic curve fitted on labelled rows that made no dictionary turns x into a
calibrated score.

Learning uses a sample: up to SAMPLE labelled rows of each class in expectation, chosen by a hash of the key, and of their
blocks up to BLOCKS in expectation for a dictionary. The driver gets those blocks (BLOCKS * BLOCK bytes a class) and a number
for each row that fits the curve, never texts. Scoring reads whole texts.

Defined cases: null and empty texts have x = 0; labels that repeat count each; with one class only every score is that class's
label, with none it is 0.5. A column that has the output's name is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import WORD_BASE, cut, mix, scratch

#: Labelled rows learned from, per class, and blocks that train a dictionary.
SAMPLE, BLOCKS = 3000, 8000
#: Bytes of a block and of a dictionary, and the compression level.
BLOCK, DICTIONARY, LEVEL = 1024, 32 << 10, 3
#: Score from which a text counts as good.
THRESHOLD = 0.3


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)]


class Model:
    """Two dictionaries (bytes, None if a class is missing) and the logistic curve's slope and offset."""

    def __init__(self, good: bytes | None, bad: bytes | None, slope: float, offset: float):
        self.good, self.bad, self.slope, self.offset = good, bad, slope, offset
        self._made = None

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "slope": self.slope, "offset": self.offset, "_made": None}

    def difference(self, texts: list[bytes]) -> np.ndarray:
        if self.good is None or self.bad is None:
            return np.zeros(len(texts))
        if self._made is None:
            import zstandard as z

            self._made = []
            for raw in (self.good, self.bad):
                d = z.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                self._made.append(z.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False))
        good, bad = (c.compress for c in self._made)
        out = np.zeros(len(texts))
        for i, t in enumerate(texts):
            if t:
                out[i] = sum(len(bad(b)) - len(good(b)) for b in blocks(t)) / len(t)
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(texts) + self.offset, -60, 60)))


def dictionary(pieces: list[bytes]) -> bytes:
    """A dictionary from blocks of a class; raw content where there are too few for training."""
    import zstandard as z

    pieces = [p for p in pieces if len(p) >= 8]
    try:
        return z.train_dictionary(DICTIONARY, pieces).as_bytes()
    except z.ZstdError:
        return b"".join(pieces)[-DICTIONARY:] or b"\0" * 8


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton's method with a small ridge on the slope of the standardised x."""
    mean, scale = float(x.mean()), float(x.std()) or 1.0
    a = np.stack([(x - mean) / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (p - y) + np.array([ridge * w[0], 0]) * len(x)
        hessian = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag([ridge * len(x), 1e-9])
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


def learn(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", sample: int = SAMPLE) -> Model:
    """A model from docs joined to labels (key, label 0 or 1; other labels and null are left out)."""
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(None, None, 0.0, 0.0)
    share = F.when(F.col("y") == 1, min(1.0, sample / sizes.get(1, 1))).otherwise(min(1.0, sample / sizes.get(0, 1)))
    h = F.xxhash64(F.col("k").cast("string"))
    draw = F.pmod(h, F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = known.where(draw < share).select("k", "y", F.pmod(F.shiftright(h, 24), F.lit(2)).alias("half"))
    # The sample has 2 * SAMPLE rows in expectation, whatever the size of the labels, so sending it everywhere is bounded.
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where(F.col("t").isNotNull()).join(F.broadcast(chosen), "k")
    rows = cut(rows.select("k", "t", "y", "half"), scratch(docs.sparkSession), "sample")
    parts = F.ceil(F.octet_length("t") / BLOCK)
    held = {(r["y"], r["half"]): (r["n"], r["blocks"]) for r in rows.groupBy("y", "half").agg(F.count("*").alias("n"), F.sum(parts).alias("blocks")).collect()}
    classes = {y for y, _ in held}
    if len(classes) < 2:
        return Model(None, None, 0.0, 60.0 if classes == {1} else -60.0 if classes else 0.0)
    # One half makes the dictionaries and the other fits the curve; a class that lacks a half gives all its rows to both.
    halves = {c: [0] if (c, 0) in held else [0, 1] for c in classes}
    share = {}
    for c in classes:
        total = sum(held.get((c, h), (0, 0))[1] for h in halves[c])
        share[c] = min(1.0, BLOCKS / max(1, total))
    part = F.lit(False)
    for c in classes:
        part = part | ((F.col("y") == c) & F.col("half").isin(*halves[c]))
    got = sampled_blocks(rows.where(part), share).orderBy("y", "h", "i").toArrow()
    made = {c: dictionary([b for y, b in zip(got.column("y").to_pylist(), got.column("b").to_pylist(), strict=True) if y == c]) for c in (0, 1)}
    model = Model(made[1], made[0], 0.0, 0.0)
    both = all((c, 1) in held for c in classes)
    fit = (rows.where("half = 1") if both else rows).select("y", difference_column(docs.sparkSession, model, "t").alias("x")).toArrow()
    x, y = fit.column("x").to_numpy(), fit.column("y").to_numpy()
    # The classes' shares among all labels weigh the sampled rows, so that the score is a probability among labelled rows.
    sampled = {c: sum(n for (k, _), (n, _) in held.items() if k == c) for c in classes}
    model.slope, offset = logistic(x, y)
    model.offset = offset + float(np.log((sizes[1] / sampled[1]) / (sizes[0] / sampled[0])))
    return model


def sampled_blocks(rows: DataFrame, share: dict[int, float]) -> DataFrame:
    """y, h, i and b: of the texts (t) of each class the share of their blocks, drawn by a hash of the key (k) and the block's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        kinds = {"y": pa.int32(), "h": pa.int64(), "i": pa.int32(), "b": pa.binary()}
        for batch in batches:
            for y, h, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pc.cast(batch.column(2), pa.binary()).to_pylist(), strict=True):
                i = np.arange(max(1, -(-len(t) // BLOCK)))
                draw = mix(np.uint64(h & (1 << 64) - 1) + i.astype(np.uint64) * WORD_BASE) >> np.uint64(44)
                i = i[draw < share[y] * (1 << 20)].tolist()
                columns = [[y] * len(i), [h] * len(i), i, [t[j * BLOCK : (j + 1) * BLOCK] for j in i]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return rows.select("y", F.xxhash64(F.col("k").cast("string")).alias("h"), "t").mapInArrow(run, "y int, h long, i int, b binary")


def difference_column(spark: SparkSession, model: Model, text: str | Column) -> Column:
    cast = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def run(column: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        return pa.array(cast.value.difference([x or b"" for x in pc.cast(column, pa.binary()).to_pylist()]), type=pa.float64())

    return run(text)


def score_column(spark: SparkSession, model: Model, text: str | Column) -> Column:
    cast = spark.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def run(column: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        return pa.array(cast.value.score([x or b"" for x in pc.cast(column, pa.binary()).to_pylist()]), type=pa.float64())

    return run(text)


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    return df.withColumn(out, score_column(df.sparkSession, model, F.col(text)))


def held_out(key: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from the labels of four fifths of the documents and score all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = learn(docs, labels.where(~held_out()))
    got = score(docs.select("doc_id", "text", held_out().alias("held_out")), model)
    return got.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
