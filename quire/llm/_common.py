"""Shared helpers: folders and vectorised word arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from xxhash import xxh3_128_digest

from quire.operators.scans import cut, scratch  # noqa: F401

#: Odd multipliers of the polynomial word hash and its finaliser (arbitrary fixed values).
WORD_BASE = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xFF51AFD7ED558CCD)
MIX_B = np.uint64(0xC4CEB9FE1A85EC53)


def drop_path(spark: SparkSession, path: str) -> None:
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(33))
    h = h * MIX_A
    h = h ^ (h >> np.uint64(33))
    h = h * MIX_B
    return h ^ (h >> np.uint64(33))


#: Masks that keep the first 0 to 8 bytes of a little-endian number.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)
#: The longest word that two lanes hold with its length.
SHORT = 15


def word_names(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Names of words as two 64-bit lanes: of up to SHORT bytes the bytes themselves and their number, mixed reversibly, so
    that different short words never share a name; of longer words a 128-bit digest."""
    size = end - start
    raw = data + bytes(16)
    view = np.ndarray((len(data) + 8,), "<u8", raw, strides=(1,))  # the eight bytes from each place on
    a = view[start] & KEEP[np.minimum(size, 8)]
    b = view[start + np.minimum(size, 8)] & KEEP[np.clip(size - 8, 0, 7)] | size.astype(np.uint64) << np.uint64(56)
    a ^= mix(b + WORD_BASE)
    b ^= mix(a + MIX_A)
    a ^= mix(b + MIX_B)
    out = np.stack([a, b])
    for i in np.flatnonzero(size > SHORT).tolist():
        out[:, i] = np.frombuffer(xxh3_128_digest(data[start[i] : end[i]]), dtype="<u8")
    return out


#: Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of a run of texts: start and end bytes, text number and 128-bit name of each, as two lanes.

    Equal words have equal names everywhere. Most users take the first lane, `name`; `names` has both, and words of equal
    names count as equal.
    """

    __slots__ = ("data", "start", "end", "doc", "names", "name", "first", "count")

    def __init__(self, texts: list[bytes]):
        self.data = b" ".join(texts) + b" "
        buf = np.frombuffer(self.data, dtype=np.uint8)
        gap = SPACE[buf]
        inside = np.zeros(len(buf) + 1, dtype=np.int8)
        inside[1:] = ~gap
        step = np.diff(inside)
        self.start = np.flatnonzero(step == 1)
        self.end = np.flatnonzero(step == -1)
        ends = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64)) if texts else np.zeros(0, np.int64)
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.count = np.bincount(self.doc, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.count)])[: len(texts)] if texts else np.zeros(0, np.int64)
        self.names = word_names(self.data, self.start, self.end)
        self.name = self.names[0]


def grams(name: np.ndarray, n: int) -> np.ndarray:
    """Names of the n-word windows that start at each of the first len - n + 1 words (documents aren't told apart)."""
    m = len(name) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for k in range(n):
        out = out * WORD_BASE + name[k : k + m]
    return mix(out)


def chunked(sizes: list[int], most_bytes: int, most_rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to most_bytes at most (a single larger item stands alone)."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and (total + n > most_bytes or i - lo >= most_rows):
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def utf8(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    return [b"" if x is None else x for x in pc.cast(column, pa.binary()).to_pylist()]


class Table:
    """A map from non-negative int64 keys to ints that looks up whole arrays (open addressing)."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(8 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, -1, dtype=np.int64)
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slot = (self._slot(keys[left]) + probe) & ((1 << self.bits) - 1)
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[left[put]], values[left[put]]
            left, probe = np.delete(left, put), probe + 1
        self.probes = probe

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * WORD_BASE) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for keys that aren't there."""
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.values[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            slot_ = (slot[open_] + probe) & ((1 << self.bits) - 1)
            held = self.keys[slot_]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[slot_[hit]]
            open_ = open_[~hit & (held >= 0)]
        return out
