"""Repeated substrings by recompression.

Each text is a sequence of word names. A round of recompression names maximal runs of a symbol, then pairs: a hash of the
name makes each symbol a left or a right one, and a left symbol with a right one after it becomes one symbol. Names are
128 bits made from what they stand for (the bytes of a word, the parts of a run or pair), so they are the same in all tasks
without a dictionary, and equal substrings get the same symbols except near their ends. How far the ends reach is followed
exactly: after each step the consistent interior of a window starts at the next symbol start after the last one and ends at
the symbol end before it.

Two Spark rounds find which names several texts share:

1. Symbols of all levels. Rounds go on until a symbol has LONG windows' words; then it is a tile. A tile that also occurs
   earlier verifies that each window in it does: equal names stand for equal words. Symbols after ROUNDS rounds are the anchors of
   short repeats: every window of WINDOW words picks the symbol of least hash in its interior, with MARGIN words on either side
   (a window without interior, as within a long run, is its own anchor). Equal windows pick equal anchors, so only windows
   whose anchor occurs twice can repeat.
2. The windows that share an anchor and lie in no repeated tile, by 128-bit names made from their words' names. All but the
   first occurrence, by key and start, are repeats.

The words of repeated windows are removed. A wrong removal needs different words or symbols of one 128-bit name.

Names travel as packed arrays, in buckets of BUCKET bytes of text each on average. Each task first settles what it can among
its own rows and sends one row of each name, so a name that a third of all texts share costs a bucket no more than one row for
each task. The texts are shuffled once (by key) and read twice. Nothing is collected, and no table is broadcast.

Defined cases: null text has no words and stays null; texts shorter than a window lose nothing; rows with a null key lose
nothing and repeat nothing. Rows of one key follow each other by a hash of their text; rows equal in both follow each other in the
order of the input. Where keys repeat or aren't whole numbers, the rows are sorted and numbered first, which costs a further
shuffle of the texts. Columns named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import MIX_A, WORD_BASE, Words, chunked, cut, grams, mix, parts, scratch, utf8

#: Words of a window, rounds of runs and pairs up to an anchor, words of context on either side of an anchor.
WINDOW, ROUNDS, MARGIN = 20, 2, 4
#: Windows that a tile is long at least, and most rounds up to a tile.
LONG, TOP = 2, 24
#: Bytes of text handled at a time, rows gathered before they are settled and sent, and bytes of text for each bucket.
BLOCK, FLUSH, BUCKET = 1 << 20, 1 << 20, 64 << 20
_PACKED = "bucket int, name binary, extra binary, doc binary, at binary, span binary"


def recompress(names: np.ndarray, doc: np.ndarray, rounds: int, most: int | None = None, sure: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """After each step (runs, pairs, runs, ...): the symbols (lanes x symbols) and the first and last + 1 word of each.

    most: symbols of so many words or more stay as they are. Steps end early where nothing can join any more, but not in the
    first `sure` rounds: how many steps these have must not depend on the other texts of a block.
    """
    n = names.shape[1]
    sym, start, end = names, np.arange(n), np.arange(1, n + 1)
    for r in range(rounds):
        free = np.ones(len(start), dtype=bool) if most is None else end - start < most
        head = np.ones(len(start), dtype=bool)
        head[1:] = (sym[0, 1:] != sym[0, :-1]) | (sym[1, 1:] != sym[1, :-1]) | (doc[start[1:]] != doc[start[:-1]]) | ~free[1:]
        if not head.all():
            first = np.flatnonzero(head)
            count = np.diff(np.append(first, len(start)))
            end = end[first + count - 1]
            sym, start = sym[:, first], start[first]
            run = np.flatnonzero(count > 1)
            sym[:, run] = mix(sym[:, run] * WORD_BASE + count[run].astype(np.uint64) + np.uint64(4 * r + 1))
        yield sym, start, end
        free = np.ones(len(start), dtype=bool) if most is None else end - start < most
        may = np.zeros(len(start), dtype=bool)
        may[:-1] = free[:-1] & free[1:] & (doc[start[1:]] == doc[start[:-1]])
        if most is not None and r >= sure and not may.any():
            return
        right = (mix(sym[0] ^ np.uint64((2 * r + 1) << 40)) & np.uint64(1)).astype(bool)
        joins = may
        joins[:-1] &= ~right[:-1] & right[1:]
        at = np.flatnonzero(joins)
        end = end.copy()
        end[at] = end[at + 1]
        sym = sym.copy()
        sym[:, at] = mix((sym[:, at] * WORD_BASE + sym[:, at + 1]) * WORD_BASE + np.uint64(4 * r + 2))
        keep = np.ones(len(start), dtype=bool)
        keep[at + 1] = False
        sym, start, end = sym[:, keep], start[keep], end[keep]
        yield sym, start, end


def symbols(words: Words, rounds: int, least: int) -> tuple[list, tuple]:
    """The steps of the first `rounds` rounds, and of the symbols that first have `least` words the names (lanes x tiles), first
    words and numbers of words."""
    steps, last = [], None
    for last in recompress(words.names, words.doc, TOP, least, rounds):
        if len(steps) < 2 * rounds:
            steps.append(last)
    sym, start, end = last
    long = np.flatnonzero(end - start >= least)
    return steps, (sym[:, long], start[long], (end - start)[long])


def anchors(words: Words, steps: list, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the steps of recompression, of each window: its first word, and its anchor's name and code (twice the anchor's first word; for a window that is
    its own anchor twice its first word plus 1)."""
    n = len(words.name)
    starts = np.arange(max(0, n - window + 1))
    starts = starts[words.doc[starts] == words.doc[starts + window - 1]] if len(starts) else starts
    if not len(starts):
        return starts, np.zeros(0, np.uint64), starts
    lo, hi = starts, starts + window
    for names, start, end in steps:
        sym = names[0]
        after = np.full(n + 1, n, dtype=np.int64)  # the next symbol start after a word
        after[start[1:] - 1] = start[1:]
        after = np.minimum.accumulate(after[::-1])[::-1]
        before = np.full(n + 1, -1, dtype=np.int64)  # the symbol end before a word boundary
        before[end[:-1] + 1] = end[:-1]
        before = np.maximum.accumulate(before)
        lo, hi = after[np.minimum(lo, n)], before[np.maximum(hi, 0)]
    own = lo >= hi
    i = np.searchsorted(start, lo[~own])
    j = np.searchsorted(end, hi[~own])
    rank = mix(sym ^ MIX_A)
    tables, k = [np.arange(len(sym))], 1
    while 2 * k <= window:
        t = tables[-1]
        other = t[np.minimum(np.arange(len(t)) + k, len(t) - 1)]
        tables.append(np.where(rank[t] <= rank[other], t, other))
        k *= 2
    level = np.frompyfunc(lambda m: int(m).bit_length() - 1, 1, 1)(np.arange(window + 2)).astype(np.int64)[j - i + 1]
    table = np.stack(tables)
    a, b = table[level, i], table[level, j - (1 << level) + 1]
    best = np.where(rank[a] <= rank[b], a, b)
    near = grams(words.name, MARGIN)
    picked, back = np.unique(best, return_inverse=True)
    picked_name = mix((near[start[picked] - MARGIN] * WORD_BASE + sym[picked]) * WORD_BASE + near[end[picked]])
    name, code = np.zeros(len(starts), dtype=np.uint64), np.zeros(len(starts), dtype=np.int64)
    name[~own], code[~own] = picked_name[back], 2 * start[picked][back]
    if own.any():
        name[own], code[own] = window_names(words.name, starts[own], window) ^ MIX_A, 2 * starts[own] + 1
    return starts, name, code


def window_names(name: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(window):
        out = out * WORD_BASE + name[starts + k]
    return mix(out)


def packed(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket, the values of its rows (name, extra, doc, at, span) as bytes; empty columns are left out."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
    columns = [x[order] if len(x) else x for x in columns]
    cut = [pa.array([c[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary()) for c in columns]
    yield pa.RecordBatch.from_arrays([pa.array(bucket[first[:-1]], pa.int32()), *cut], names=["bucket", "name", "extra", "doc", "at", "span"])


def unpacked(table: pa.Table) -> list[np.ndarray]:
    """name, extra, doc, at and span of all rows."""
    kinds = {"name": "<u8", "extra": "<u8", "doc": "<i8", "at": "<i4", "span": "<i4"}
    return [np.frombuffer(b"".join(table.column(c).to_pylist()), dtype=k) for c, k in kinds.items()]


def in_bucket(name: np.ndarray, buckets: int) -> np.ndarray:
    return ((name >> np.uint64(24)) % np.uint64(buckets)).astype(np.int32)


def settled(doc: np.ndarray, at: np.ndarray, span: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows that are known to count, by key, in buckets below zero."""
    bucket = -1 - (mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((at, doc))
    none = np.zeros(0, np.uint64)
    yield from packed(bucket[order], none, none, doc[order], at[order].astype(np.int32), span[order].astype(np.int32))


def settle(name: np.ndarray, extra: np.ndarray, doc: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows in order of name, extra, doc, at; the number of each row's name group; and the first row of each group."""
    order = np.lexsort((at, doc, extra, name))
    n, e = name[order], extra[order]
    head = np.append(True, (n[1:] != n[:-1]) | (e[1:] != e[:-1])) if len(n) else np.zeros(0, bool)
    return order, np.cumsum(head) - 1, np.flatnonzero(head)


def shared(rows: list[np.ndarray], buckets: int, send: bool) -> Iterator[pa.RecordBatch]:
    """Settle all occurrences of the names that occur twice, and with `send` pass on one row of each name: its own if the name
    occurs once here, else one at -1."""
    order, group, first = settle(*rows[:4])
    name, _, doc, at, span = (x[order] for x in rows)
    many = (np.bincount(group, minlength=len(first)) > 1) | (np.minimum.reduceat(at, first) < 0) if len(first) else np.zeros(0, bool)
    on = many[group] & (at >= 0)
    yield from settled(doc[on], at[on], span[on], buckets)
    if send:
        yield from packed(in_bucket(name[first], buckets), name[first], rows[1][order][first], doc[first], np.where(many, -1, at[first]).astype(np.int32), span[first])


def repeated(rows: list[np.ndarray], buckets: int, send: bool) -> Iterator[pa.RecordBatch]:
    """Settle all occurrences of a name but the first, and with `send` pass on the first."""
    order, group, first = settle(*rows[:4])
    name, extra, doc, at, span = (x[order] if len(x) else x for x in rows)
    on = (doc != doc[first][group]) | (at != at[first][group])
    yield from settled(doc[on], at[on], span[on] if len(span) else np.zeros(int(on.sum()), np.int32), buckets)
    if send:
        yield from packed(in_bucket(name[first], buckets), name[first], extra[first], doc[first], at[first], span[first] if len(span) else span)


class Gather:
    """Rows (name, extra, doc, at, span) gathered over blocks and sent by the million."""

    def __init__(self, send, buckets: int):
        self.send, self.buckets, self.rows, self.count = send, buckets, [], 0

    def add(self, *row: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(row[0]):
            self.rows.append(row)
            self.count += len(row[0])
        if self.count >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            columns = [np.concatenate(x) for x in zip(*self.rows, strict=True)]
            self.rows, self.count = [], 0
            yield from self.send(columns, self.buckets, True)


def blocks_of(key: pa.Array, text: pa.Array, wanted: list[bool], block: int) -> Iterator[tuple[int, int, np.ndarray, Words]]:
    """Index ranges of a batch with keys and words; rows that aren't wanted have no words here."""
    keys = np.array(key.fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    texts = [t if ok else b"" for t, ok in zip(utf8(text), wanted, strict=True)]
    for lo, hi in chunked([len(t) + 1 for t in texts], block):
        yield lo, hi, keys[lo:hi], Words(texts[lo:hi])


def repeats(docs: DataFrame, text: str, buckets: int, window: int = WINDOW, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """k and `starts` (int32 bytes): windows of each text, by first word, that also start earlier and cover all such.

    docs: _k long (the key, unique and not null), the text and any other columns. The join below carries all of them and keeps
    rows without spots, so that a join of docs by _k afterwards has the same exchange and Spark shuffles the texts once.
    """
    place = docs.columns.index(text), docs.columns.index("_k")
    none = np.zeros(0, np.int32)

    def name_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short, long = Gather(shared, buckets), Gather(repeated, buckets)
        for batch in batches:
            for _, _, keys, words in blocks_of(batch.column(0), batch.column(1), [True] * batch.num_rows, block):
                if not len(words.name):
                    continue
                steps, (names, at, span) = symbols(words, rounds, LONG * window)
                starts, name, code = anchors(words, steps, window)
                if len(starts):
                    code, pick = np.unique(code, return_index=True)
                    name, of = name[pick], words.doc[starts[pick]]
                    yield from short.add(name, np.zeros(len(name), np.uint64), keys[of], (code - 2 * words.first[of]).astype(np.int32), np.zeros(len(name), np.int32))
                of = words.doc[at]
                yield from long.add(names[0], names[1], keys[of], (at - words.first[of]).astype(np.int32), span.astype(np.int32))
        yield from short.flush()
        yield from long.flush()

    def judge_symbols(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        rows = unpacked(table)
        long = rows[4] > 0
        found = [*shared([x[~long] for x in rows], buckets, False), *repeated([x[long] for x in rows], buckets, False)]
        return pa.Table.from_batches(found, schema=table.schema)

    def judge_windows(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return table
        return pa.Table.from_batches(list(repeated(unpacked(table), buckets, False)), schema=table.schema)

    def by_doc(table: pa.Table) -> pa.Table:
        _, _, doc, at, span = unpacked(table)
        order = np.lexsort((at, span, doc))
        doc, both = doc[order], np.stack([at[order], span[order]], axis=1)
        first = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(doc)) if len(doc) else np.zeros(1, int)
        return pa.table({"k": pa.array(doc[first[:-1]]), "spots": pa.array([both[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)], pa.binary())})

    def name_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gather = Gather(repeated, buckets)
        for batch in batches:
            spots = batch.column(batch.num_columns - 1).to_pylist()
            for lo, _, keys, words in blocks_of(batch.column(place[1]), batch.column(place[0]), [x is not None for x in spots], block):
                n = len(words.name)
                if not n:
                    continue
                held = [np.frombuffer(s or b"", dtype="<i4").reshape(-1, 2) for s in spots[lo : lo + len(keys)]]
                owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
                at, span = np.concatenate(held).T
                small = span == 0
                wanted = at[small] + 2 * words.first[owner[small]]
                owner, at, span = owner[~small], at[~small].astype(np.int64), span[~small].astype(np.int64)
                # A repeated tile settles all windows in it; windows at each WINDOW words and its last one cover it.
                inside = np.zeros(n + 1, dtype=np.int64)
                np.add.at(inside, at + words.first[owner], 1)
                np.add.at(inside, at + words.first[owner] + span - window + 1, -1)
                steps = -(-span // window)
                tile = np.repeat(np.arange(len(at)), steps)
                step = np.arange(len(tile)) - np.repeat(np.cumsum(steps) - steps, steps)
                cover = at[tile] + np.minimum(step * window, (span - window)[tile])
                yield from settled(keys[owner[tile]], cover, np.zeros(len(tile), np.int32), buckets)
                starts, _, code = anchors(words, list(recompress(words.names, words.doc, rounds, LONG * window, rounds)), window)
                at = starts[np.isin(code, wanted) & (np.cumsum(inside)[starts] == 0)]
                if len(at):
                    of = words.doc[at]
                    yield from gather.add(window_names(words.names[0], at, window), window_names(words.names[1], at, window), keys[of], (at - words.first[of]).astype(np.int32), none)
        yield from gather.flush()

    found = docs.select("_k", text).mapInArrow(name_symbols, _PACKED).groupBy("bucket").applyInArrow(judge_symbols, _PACKED)
    spots = found.groupBy("bucket").applyInArrow(by_doc, "k long, spots binary")
    candidates = docs.join(spots.withColumnRenamed("k", "_k").hint("merge"), "_k", "left").select(*docs.columns, "spots")
    again = candidates.mapInArrow(name_windows, _PACKED).groupBy("bucket").applyInArrow(judge_windows, _PACKED)
    return again.groupBy("bucket").applyInArrow(by_doc, "k long, spots binary").withColumnRenamed("spots", "starts")


def ordered(df: DataFrame, text: str, key: str) -> DataFrame:
    """df with _k, a unique whole number in the order of the keys (null for a null key)."""
    whole = df.schema[key].dataType.typeName() in ("byte", "short", "integer", "long")
    if whole and not df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").limit(1).count():
        return df.withColumn("_k", F.col(key).cast("long"))
    # The input's own order parts rows that are equal in key and text, so that no range holds all of them.
    tie = df.withColumn("_h", F.xxhash64(F.coalesce(F.col(text), F.lit("")))).withColumn("_t", F.monotonically_increasing_id())
    n = max(16, parts(df.sparkSession))
    ranged = tie.repartitionByRange(n, key, "_h", "_t").sortWithinPartitions(key, "_h", "_t")
    return cut(ranged.withColumn("_k", F.when(F.col(key).isNotNull(), F.monotonically_increasing_id())), scratch(df.sparkSession), "ordered").drop("_h", "_t")


def remove(df: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """df with the words of repeated windows removed.

    Adds n_words, n_removed, kept_words (the kept words joined by one space) and kept_text (the text without the removed
    words and the white space after each; a text that loses nothing is unchanged).
    """
    made = ("n_words", "n_removed", "kept_words", "kept_text")
    rows = df.drop(*made)
    whole = ordered(rows, text, key)
    docs = whole.where("_k is not null")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(parts(df.sparkSession), -(-size // BUCKET))
    found = repeats(docs, text, buckets, window, rounds, block).select(F.col("k").alias("_k"), F.col("starts").alias("_starts"))
    joined = docs.join(found.hint("merge"), "_k", "left")
    joined = joined.unionByName(whole.where("_k is null").withColumn("_starts", F.lit(None).cast("binary")))
    schema = T.StructType([*rows.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_words", T.StringType()), T.StructField("kept_text", T.StringType())])
    names, place = rows.columns, rows.columns.index(text)

    def cut(raw: bytes | None, starts: bytes | None) -> tuple[int, int, bytes, bytes | None]:
        words = (raw or b"").split()
        if not starts:
            return len(words), 0, b" ".join(words), raw
        at = np.frombuffer(starts, dtype="<i4")[::2]
        step = np.zeros(len(words) + 1, dtype=np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, np.minimum(at + window, len(words)), -1)
        gone = np.cumsum(step)[:-1] > 0
        spans = Words([raw])
        pieces, last = [], 0
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            pieces.append(raw[last : spans.start[a]])
            last = int(spans.start[b]) if b < len(words) else len(raw)
        pieces.append(raw[last:])
        kept = b"".join(pieces)
        return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for whole in batches:
            size = [len(names) and (x or 0) for x in pc.binary_length(whole.column(place)).to_pylist()]
            for lo, hi in chunked(size, 4 << 20):
                batch = whole.slice(lo, hi - lo)
                texts = pc.cast(batch.column(place), pa.binary()).to_pylist()
                out = [cut(t, s) for t, s in zip(texts, batch.column(len(names)).to_pylist(), strict=True)]
                columns = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())]
                columns += [pc.cast(pa.array([x[i] for x in out], pa.binary()), pa.string()) for i in (2, 3)]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], *columns], names=[*names, *made])

    return joined.select(*names, "_starts").mapInArrow(run, schema)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and the digest of what every document keeps."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_words", 256).alias("kept_sha256"))
