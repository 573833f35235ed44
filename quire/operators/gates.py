"""Gated schedules: of each key's events, those that a rate lets pass one after the other.

An event is allowed if the gap has passed since the last allowed one, so what is allowed depends on all events before it. Each
event points to the first one that could follow it; the allowed events are those that pointers reach from a key's first.
Events are sorted by key and time and cut into chunks of bounded size (quire.operators.scans). Within a chunk pointers are
followed in place. Of pointers that leave a chunk only its possible last events matter; their successors are found by one scan,
and which of them are reached by binary lifting: each round doubles the pointers' length. So a key with any number of events
takes as many rounds as its number of chunks has binary digits, and never one task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators import scans as S

#: Events handled by one task at a time, as a power of two.
CHUNK = 17


def segments(keys: pa.ChunkedArray) -> np.ndarray:
    """Where runs of equal keys start, and the end of the last; null is a key."""
    codes = keys.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.append(np.flatnonzero(np.append(True, codes[1:] != codes[:-1])), len(codes))


def pointers(at: np.ndarray, starts: np.ndarray, gap: int) -> np.ndarray:
    """Of each event the first of its run of keys that could follow it, itself if there is none here."""
    out = np.arange(len(at))
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        found = a + np.searchsorted(at[a:b], at[a:b] + gap)
        out[a:b] = np.where(found < b, found, out[a:b])
    return out


def allowed_here(follow: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Marks of the events that pointers reach from the entries."""
    out = np.zeros(len(follow), dtype=bool)
    for i in entries.tolist():
        while not out[i]:
            out[i] = True
            i = follow[i]
    return out


def entries_of(table: DataFrame, key: str, gap: int, folder: str) -> DataFrame:
    """_m of the allowed events that are the first allowed ones of their key in their chunk. table: key, _t, _m, _c."""
    fields = T.StructType([table.schema[key], *[T.StructField(n, T.LongType()) for n in ("_m", "exit", "exit_t")], T.StructField("open", T.BooleanType())])

    def leave(part: pa.Table) -> pa.Table:
        part = part.sort_by("_m")
        at, m, starts = part.column("_t").to_numpy(), part.column("_m").to_numpy(), segments(part.column(key))
        last = pointers(at, starts, gap)
        while not np.array_equal(last, last[last]):
            last = last[last]
        return pa.table({key: part.column(key), "_m": m, "exit": m[last], "exit_t": at[last], "open": np.arange(len(at)) >= starts[-2]})

    exits = S.cut(table.select(key, "_t", "_m", "_c").groupBy("_c").applyInArrow(leave, fields), folder, "exits")
    first = exits.groupBy(key).agg(F.min("_m").alias("_m"), F.min_by("exit", "_m").alias("exit"))
    probes = exits.where("open").select(key, F.col("exit").alias("_from"), (F.col("exit_t") + gap).alias("_t")).distinct()
    none = F.lit(None).cast("long")
    both = table.select(key, "_t", "_m", none.alias("_from")).unionByName(probes.select(key, "_t", none.alias("_m"), "_from"))
    held = F.when(F.col("_m").isNotNull(), F.struct(F.col(key).alias("k"), F.col("_m").alias("m")))
    # In falling order the last event seen is the first one from the probe's time on.
    seen = S.scan(both, [F.desc(key), F.desc("_t"), F.col("_from").isNotNull(), F.desc("_m")], {"_w": S.Running("last", held)})
    follow = seen.where(F.col("_from").isNotNull() & F.col("_w.k").eqNullSafe(F.col(key))).select(F.col("_from").alias("u"), F.col("_w.m").alias("_m"))
    follow = S.cut(follow, folder, "follow")
    jump = S.cut(follow.join(exits.select("_m", F.col("exit").alias("v")), "_m").select("u", "v"), folder, "jump0")
    reached, step = S.cut(first.select(F.col("exit").alias("u")), folder, "reached0"), 0
    while jump.limit(1).count():
        step += 1
        reached = S.cut(reached.unionByName(reached.join(jump, "u").select(F.col("v").alias("u"))).distinct(), folder, f"reached{step}")
        far = jump.select(F.col("u").alias("v"), F.col("v").alias("w"))
        jump = S.cut(jump.join(far, "v").select("u", F.col("w").alias("v")), folder, f"jump{step}")
    return first.select("_m").unionByName(follow.join(reached, "u").select("_m")).distinct()


def rate_gate(rows: DataFrame, key: str, ts: str, per_hour: float | None, tie: tuple[str, ...] = (), chunk: int = CHUNK) -> DataFrame:
    """rows with allowed and wait_seconds: an event may follow the last allowed one of its key after an hour / rate, or ten
    minutes by default; others wait for the rest of it.

    Events of one time come in order of `tie`, then of their hash. A null key is a key; a row with a null time is no event and
    has null for both.
    """
    gap = round(3_600_000_000 / per_hour) if per_hour else 600_000_000
    timed = rows.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    folder = S.scratch(rows.sparkSession)
    table = S.sorted_table(timed.where("_t is not null"), [key, "_t", *tie], folder).withColumn("_c", F.shiftright("_m", chunk))
    begins = S.cut(entries_of(table, key, gap, folder), folder, "begins").withColumn("_in", F.lit(True))
    schema = T.StructType([*table.schema.fields, T.StructField("allowed", T.BooleanType())])

    def mark(part: pa.Table) -> pa.Table:
        part = part.sort_by("_m")
        follow = pointers(part.column("_t").to_numpy(), segments(part.column(key)), gap)
        at = np.flatnonzero(part.column("_in").is_valid().to_numpy())
        return part.drop_columns(["_in"]).append_column("allowed", pa.array(allowed_here(follow, at)))

    marked = S.cut(table.join(begins, "_m", "left").select(*table.columns, "_in").groupBy("_c").applyInArrow(mark, schema), folder, "marked")
    last = S.run_over(marked, "_m", {"_l": S.Running("last", F.when(F.col("allowed"), F.col("_t")))}, folder, chunk)
    got = last.select(*rows.columns, "allowed", F.when(F.col("allowed"), 0.0).otherwise((gap - F.col("_t") + F.col("_l")) / 1e6).alias("wait_seconds"))
    no = timed.where("_t is null").select(*rows.columns, F.lit(None).cast("boolean").alias("allowed"), F.lit(None).cast("double").alias("wait_seconds"))
    return got.unionByName(no)
