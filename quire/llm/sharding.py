"""Sharding by vector bin packing.

A group (rows with equal texts) is a vector of bytes, tokens and rows; a shard is a bin with equal capacity in each. Groups
go in falling order of size to the shard where the dot product of the group with the shard's residual capacity is highest.

At scale the packing has two levels. Groups larger than 1/(SPLIT * shards) of the total in any dimension are a few thousand
at most whatever the input, and the driver packs them first. All others are dealt into lanes by a hash; each lane packs its
own groups against its share of the residual capacity, so no task sees more than about LANE groups and the loads add up to
nearly equal shards. Only a group that no empty shard can hold, larger than 1/shards of the total in some dimension, is cut,
into pieces of 1/(SPLIT * shards).

Defined cases: null text is the empty text; equal texts share a shard unless no shard can hold them all; an empty table
gives no rows. Input columns other than the key and the text don't matter. Rows whose key is null or repeats are all placed
and numbered; slots follow a hash of the key and the row's place in the input.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm._common import cut, scratch

#: Groups above 1 / (SPLIT * shards) of the total are packed first; groups of a lane; rows of a numbering chunk.
SPLIT, LANE, CHUNK = 48, 2000, 20_000
DIMENSIONS = ("bytes", "tokens", "rows")


def pack(items: np.ndarray, residual: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """The shard of each item (a row of bytes, tokens, rows); residual (shards x 3) is used up in place.

    Largest items first; each goes where item . residual, both in units of the capacity, is highest (ties: the first).
    """
    unit = np.where(capacity > 0, capacity, 1)
    scaled, left = items / unit, residual / unit
    out = np.zeros(len(items), dtype=np.int32)
    for i in np.argsort(-scaled.max(axis=1), kind="stable"):
        s = int((left @ scaled[i]).argmax())
        left[s] -= scaled[i]
        out[i] = s
    residual[:] = left * unit
    return out


def assign(docs: DataFrame, shards: int = 16, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, size (UTF-8 bytes + 1), text_crc32, shard and slot (0, 1, ... within the shard) for each row of docs."""
    spark = docs.sparkSession
    folder = scratch(spark)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = cut(
        docs.select(
            F.col(key).alias("k"),
            (F.octet_length(body) + 1).cast("long").alias("bytes"),
            F.regexp_count(body, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
            F.crc32(body.cast("binary")).alias("crc"),
            F.xxhash64(body).alias("g"),
            F.pmod(F.xxhash64(F.col(key), F.monotonically_increasing_id()), F.lit(1 << 30)).alias("salt"),
        ),
        folder,
        "rows",
    )
    groups = cut(rows.groupBy("g", "crc", "bytes").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens")).select("g", "crc", "bytes", "rows", "tokens"), folder, "groups")
    total = groups.agg(F.count("*").alias("n"), F.sum(F.col("bytes") * F.col("rows")).alias("bytes"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).first()
    if not total["n"]:
        return rows.select(F.col("k").alias(key), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    all_of = np.array([total[d] for d in DIMENSIONS], dtype=float)
    limit = all_of / (SPLIT * shards)
    share = F.greatest(*[x / F.lit(max(float(m), 1.0)) for x, m in zip((F.col("bytes") * F.col("rows"), F.col("tokens"), F.col("rows")), limit, strict=True)])
    # At most 3 * SPLIT * shards groups have more than the limit in some dimension, and their pieces are no more than twice that.
    # A group that has more than a shard's part (SPLIT limits) can't stay whole.
    large = groups.withColumn("pieces", F.when((share > SPLIT) & (F.col("rows") > 1), F.least(F.ceil(share), F.col("rows"))).otherwise(1)).where(share > 1)
    hot = F.broadcast(large.select("g", "crc", "bytes", "pieces"))
    tagged = rows.join(hot, ["g", "crc", "bytes"], "left").withColumn("piece", F.when(F.col("pieces").isNotNull(), F.pmod(F.col("salt"), F.col("pieces"))).otherwise(F.lit(-1)).cast("int"))
    heavy = tagged.where("piece >= 0").groupBy("g", "crc", "bytes", "piece").agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens")).orderBy("g", "crc", "bytes", "piece").toPandas()
    residual = np.tile(all_of / shards, (shards, 1))
    placed = pack(np.stack([heavy["bytes"] * heavy["rows"], heavy["tokens"], heavy["rows"]], axis=1).astype(float), residual, all_of / shards)
    heavy_total = np.array([(heavy["bytes"] * heavy["rows"]).sum(), heavy["tokens"].sum(), heavy["rows"].sum()], dtype=float)
    rest = np.where(all_of > heavy_total, all_of - heavy_total, 1)
    lanes = max(1, -(-total["n"] // LANE))

    def deal(frames: pd.DataFrame) -> pd.DataFrame:
        f = frames.sort_values(["g", "crc", "bytes"])
        items = np.stack([f["bytes"] * f["rows"], f["tokens"], f["rows"]], axis=1).astype(float)
        own = np.maximum(residual, 0) * (items.sum(axis=0) / rest)
        turn = int(f["g"].iloc[0]) % shards  # lanes break ties from different shards on
        own = np.roll(own, turn, axis=0)
        f["shard"] = ((pack(items, own, items.sum(axis=0) / shards) - turn) % shards).astype(np.int32)
        return f[["g", "crc", "bytes", "shard"]]

    small = groups.where(share <= 1).withColumn("lane", F.pmod(F.xxhash64("g", "crc"), F.lit(lanes)))
    dealt = small.groupBy("lane").applyInPandas(deal, "g long, crc long, bytes long, shard int")
    pieces = spark.createDataFrame(heavy[["g", "crc", "bytes", "piece"]].assign(shard=placed), "g long, crc long, bytes long, piece int, shard int")
    few = tagged.where("piece >= 0").join(F.broadcast(pieces), ["g", "crc", "bytes", "piece"])
    many = tagged.where("piece < 0").join(dealt, ["g", "crc", "bytes"])
    cols = ["k", "bytes", "crc", "salt", "shard"]
    found = cut(few.select(cols).unionByName(many.select(cols)), folder, "placed")
    return number(found, total["rows"]).select(F.col("k").alias(key), F.col("bytes").alias("size"), F.col("crc").alias("text_crc32"), "shard", "slot")


def number(found: DataFrame, rows: int) -> DataFrame:
    """A gapless slot within each shard: shards are cut into chunks by a hash, chunks are counted, and ranks within a chunk
    start at the sum of the chunks before it."""
    chunks = max(16, -(-rows // CHUNK))
    dealt = found.withColumn("chunk", F.pmod(F.col("salt"), F.lit(chunks)).cast("int"))
    counts = dealt.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = counts.select("shard", "chunk", (F.sum("n").over(W.partitionBy("shard").orderBy("chunk")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("shard", "chunk").orderBy("salt", "k"))
    return dealt.withColumn("rank", rank).join(before, ["shard", "chunk"]).withColumn("slot", (F.col("rank") - 1 + F.col("before")).cast("long"))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of nearly equal bytes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = assign(docs, 16)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
