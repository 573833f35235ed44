"""Streaming forms of the ledger: the same results from an unbounded log (an extension beyond batch parity)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(log: DataFrame, key: str = "id", seq: str = "seq", dry: str = "dry") -> DataFrame:
    """The first real record of each key, or its first dry run; state is one record for each key (output mode complete or update)."""
    rank = F.struct(F.when(F.coalesce(F.col(dry), F.lit(False)), 1).otherwise(0).alias("d"), F.col(seq).alias("s"))
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("_r")).select(key, "_r.*")


def activity(events: DataFrame, ts: str, kind: str, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Counts by kind in tumbling windows; events later than `late` behind the newest are left out (watermark)."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), kind).agg(F.count("*").alias("n"))
