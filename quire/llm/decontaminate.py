"""Benchmark decontamination by SimHash windows.

For every benchmark item each text is read in windows of the item's length in words. A window has a 64-bit SimHash of its
five-word shingles; a multi-index over 16 blocks of 4 bits finds all items whose SimHash is within RADIUS bits (of at most
RADIUS < 32 differing bits some block has one at most, and every block value within one bit of an item's is listed). The
found pairs are verified by exact weighted-shingle similarity: with shingle counts as weights, the sum of the smaller counts
over the sum of the larger ones.

A window without any shingle of an item has similarity 0 with it, so windows are made only where a text has a shingle of an
item of that length; nothing that could pass is left out. Items are a stated query set. They are taken in blocks of at most
ITEMS bytes, and only such a block is broadcast.

Defined cases: words are compared in lower case; an item with fewer than five words is one shingle; a text shorter than an
item is one window, with its own number of shingles; null and empty texts and items match nothing; equal items are all
reported; an item or text that repeats is reported for each row; rows with a null key are searched, and cleaned, like others.
Extra columns don't matter.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm._common import Table, Words, chunked, grams

SHINGLE, SIMILARITY, RADIUS = 5, 0.8, 22
#: Bytes of items in a broadcast block, bytes of text handled at a time, and words over which window sums are taken at once.
ITEMS, BLOCK, SPAN = 8 << 20, 1 << 20, 8192
_BITS, _BLOCKS = 4, 16


def bits_of(names: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(names).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def simhash(sums: np.ndarray, count: int | np.ndarray) -> np.ndarray:
    """Fingerprints from the ones of each bit (rows x 64) over `count` shingles."""
    return np.packbits(2 * sums > np.reshape(count, (-1, 1)), axis=1, bitorder="little").view("<u8").ravel()


class MultiIndex:
    """Items of one length by every block value within one bit of theirs."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.lists: list[list[np.ndarray]] = []
        for b in range(_BLOCKS):
            value = (prints >> np.uint64(_BITS * b) & np.uint64(15)).astype(np.uint8)
            self.lists.append([np.flatnonzero(np.bitwise_count(value ^ np.uint8(v)) <= 1) for v in range(16)])

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (row of prints, item) within RADIUS bits."""
        rows, items = [], []
        for b in range(_BLOCKS):
            value = (prints >> np.uint64(_BITS * b) & np.uint64(15)).astype(np.int64)
            for v in range(16):
                at, listed = np.flatnonzero(value == v), self.lists[b][v]
                rows.append(np.repeat(at, len(listed)))
                items.append(np.tile(listed, len(at)))
        pairs = np.unique(np.concatenate(rows) * len(self.prints) + np.concatenate(items))
        r, i = pairs // len(self.prints), pairs % len(self.prints)
        on = np.bitwise_count(prints[r] ^ self.prints[i]) <= RADIUS
        return r[on], i[on]


class Benchmark:
    """A block of items, by length."""

    def __init__(self, ids: list, texts: list[str]):
        self.lengths: dict[int, dict] = {}
        by_length, shingles = defaultdict(list), defaultdict(lambda: defaultdict(set))
        words = [Words([t.lower().encode()]).name for t in texts]
        for i, name in enumerate(words):
            if len(name):
                by_length[len(name)].append(i)
        for length, members in sorted(by_length.items()):
            n = min(SHINGLE, length)
            rows = [grams(words[i], n) for i in members]
            prints = simhash(np.stack([bits_of(r).sum(axis=0, dtype=np.int64) for r in rows]), length - n + 1)
            self.lengths[length] = {"n": n, "ids": [ids[i] for i in members], "counts": [Counter(r.tolist()) for r in rows], "index": MultiIndex(prints)}
            for name in {x for r in rows for x in r.tolist()}:
                shingles[n][name].add(length)
        self.known = {}
        for n, found in shingles.items():
            names = np.array(sorted(found), dtype=np.uint64)
            self.known[n] = Table((names >> np.uint64(1)).astype(np.int64), np.arange(len(names))), names, [sorted(found[x]) for x in names.tolist()]

    def windows(self, words: Words, shingled: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length, the starts of the windows that have a shingle of an item of that length, and the shorter texts that
        have one and enough others to be similar."""
        spots = defaultdict(list)
        for n, (table, names, lengths) in self.known.items():
            g = shingled[n]
            if not len(g):
                continue
            found = table.get((g >> np.uint64(1)).astype(np.int64))
            at = np.flatnonzero(found >= 0)
            at = at[(names[found[at]] == g[at]) & (words.doc[at] == words.doc[at + n - 1])]
            for p in at.tolist():
                for length in lengths[found[p]]:
                    spots[length].append(p)
        last = words.first + words.count
        for length, ps in spots.items():
            n, p = self.lengths[length]["n"], np.array(ps)
            lo = np.maximum(p - (length - n), words.first[words.doc[p]])
            hi = np.minimum(p, last[words.doc[p]] - length)
            step = np.zeros(len(words.name) + 2, dtype=np.int64)
            on = lo <= hi
            np.add.at(step, lo[on], 1)
            np.add.at(step, hi[on] + 1, -1)
            starts = np.flatnonzero(np.cumsum(step) > 0)
            count = words.count[words.doc[p]]
            whole = np.unique(words.doc[p][(count < length) & (count - n + 1 >= SIMILARITY * (length - n + 1))])
            if len(starts) or len(whole):
                yield length, starts, whole

    def search(self, texts: list[bytes]) -> list[tuple[int, object, int, int, float]]:
        """(text, item id, first word, words, similarity) of the best window for each text and item that pass."""
        words = Words(texts)
        shingled = {n: grams(words.name, n) for n in self.known}
        best: dict[tuple[int, int, int], tuple[float, int, int]] = {}
        for length, starts, whole in self.windows(words, shingled):
            kind = self.lengths[length]
            g, size = shingled[kind["n"]], length - kind["n"] + 1
            for d in whole.tolist():
                count = int(words.count[d])
                mine = g[words.first[d] : words.first[d] + count - kind["n"] + 1]
                for i in kind["index"].near(simhash(bits_of(mine).sum(axis=0, dtype=np.int64)[None], len(mine)))[1].tolist():
                    shared = sum((Counter(mine.tolist()) & kind["counts"][i]).values())
                    if shared / (len(mine) + size - shared) >= SIMILARITY:
                        best[d, length, i] = shared / (len(mine) + size - shared), 0, count
            for lo in range(0, len(starts), SPAN):
                part = starts[lo : lo + SPAN]
                for a, b in chunked([int(x) for x in np.diff(part, prepend=part[0])], SPAN):
                    run = part[a:b]
                    sums = np.zeros((run[-1] - run[0] + size + 1, 64), dtype=np.int32)
                    np.cumsum(bits_of(g[run[0] : run[-1] + size]), axis=0, out=sums[1:], dtype=np.int32)
                    at = run - run[0]
                    r, items = kind["index"].near(simhash(sums[at + size] - sums[at], size))
                    for s, i in zip(run[r].tolist(), items.tolist(), strict=True):
                        mine, theirs = Counter(g[s : s + size].tolist()), kind["counts"][i]
                        shared = sum((mine & theirs).values())
                        value = shared / (2 * size - shared)
                        key = (int(words.doc[s]), length, i)
                        if value >= SIMILARITY and (key not in best or value > best[key][0]):
                            best[key] = value, s - int(words.first[words.doc[s]]), length
        return [(d, self.lengths[n]["ids"][i], s, m, v) for (d, n, i), (v, s, m) in sorted(best.items())]


def blocks_of_items(items: DataFrame, text: str, key: str) -> Iterator[Benchmark]:
    """The items in blocks of ITEMS bytes or so, dealt by a hash; one block at a time reaches the driver."""
    rows = items.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = max(1, -(-total // ITEMS))
    for b in range(blocks):
        got = rows.where(F.pmod(F.xxhash64("t", F.col("k").cast("string")), F.lit(blocks)) == b).orderBy("k").collect()
        if got:
            yield Benchmark([r["k"] for r in got], [r["t"] for r in got])


def matches(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """One row for each text and item that pass: key, item_key, first_word, n_words and similarity of the best window."""
    spark, found_ids = docs.sparkSession, to_arrow_type(items.schema[item_key].dataType)
    kind, item_kind = docs.schema[key].dataType, items.schema[item_key].dataType
    schema = f"`{key}` {kind.simpleString()}, `{item_key}` {item_kind.simpleString()}, first_word long, n_words long, similarity double"
    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    out = None
    for block in blocks_of_items(items, item_text, item_key):
        cast = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], cast=cast) -> Iterator[pa.RecordBatch]:
            bench, names = cast.value, [key, item_key, "first_word", "n_words", "similarity"]
            for batch in batches:
                texts = [(t or "").lower().encode() for t in batch.column(1).to_pylist()]
                for lo, hi in chunked([len(t) + 1 for t in texts], BLOCK):
                    found = bench.search(texts[lo:hi])
                    if found:
                        d, i, s, n, v = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([lo + x for x in d])), pa.array(i, found_ids), pa.array(s, pa.int64()), pa.array(n, pa.int64()), pa.array(v, pa.float64())], names=names)

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The rows of docs that match no item. Each row is judged by itself, without a join, so keys don't matter."""
    place = docs.columns.index(text)
    for block in blocks_of_items(items, item_text, item_key):
        cast = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], cast=cast) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [(t or "").lower().encode() for t in batch.column(place).to_pylist()]
                keep = np.ones(len(texts), dtype=bool)
                for lo, hi in chunked([len(t) + 1 for t in texts], BLOCK):
                    keep[[lo + x[0] for x in cast.value.search(texts[lo:hi])]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with a window that is a benchmark item or nearly one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return matches(docs, items)
