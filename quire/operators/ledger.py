"""Ledger operators over event logs (key, seq, ...): state is always derived, never stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(log: DataFrame, key: str, seq: str, dry: Column) -> DataFrame:
    """One row per key: the first real record, or without one the first dry run. Partial aggregation, no sort."""
    rank = F.struct(F.when(F.coalesce(dry, F.lit(False)), 1).otherwise(0).alias("dry"), F.col(seq).alias("seq"))
    picked = log.groupBy(key).agg(F.min_by(F.struct(*[c for c in log.columns if c != key]), rank).alias("_r"))
    return picked.select(key, "_r.*")


def merge_fields(base: DataFrame, update: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """base with the update's fields where the update has the key; keys of the update only are added."""
    u = update.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    out = base.join(u, key, "full_outer")
    return out.select(key, *[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns if c != key])


def failures(log: DataFrame, key: str, seq: str) -> DataFrame:
    """Failure records with retry_count, the failures of the key before."""
    from pyspark.sql import Window as W

    return log.withColumn("retry_count", F.row_number().over(W.partitionBy(key).orderBy(seq)) - 1)


def states(log: DataFrame, key: str, done: Column, dry: Column, failed: Column) -> DataFrame:
    """Per key: completed, completed_real, dry_run_completed, failed (ever failed and not completed), n_failures."""
    flag = lambda c: F.coalesce(F.max(c.cast("int")), F.lit(0)) == 1
    out = log.groupBy(key).agg(flag(done).alias("completed"), flag(done & ~F.coalesce(dry, F.lit(False))).alias("completed_real"), flag(done & F.coalesce(dry, F.lit(False))).alias("dry_run_completed"), F.count(F.when(failed, 1)).alias("n_failures"))
    return out.withColumn("failed", (F.col("n_failures") > 0) & ~F.col("completed"))


def retryable(log: DataFrame, key: str, seq: str, done: Column, failed: Column, most: int = 3) -> DataFrame:
    """Keys that failed fewer than `most` times and never completed, with their first failure, by its order."""
    out = log.groupBy(key).agg(F.count(F.when(failed, 1)).alias("n_failures"), F.max(done.cast("int")).alias("_done"), F.min(F.when(failed, F.col(seq))).alias("first_failure"))
    return out.where((F.col("n_failures").between(1, most - 1)) & (F.coalesce("_done", F.lit(0)) == 0)).drop("_done")


def next_item(catalogue: DataFrame, done: DataFrame, failed: DataFrame, on: list[str], order: list[str]) -> DataFrame:
    return catalogue.join(done, on, "left_anti").join(failed, on, "left_anti").orderBy(*order).limit(1)


def clear_dry_runs(ledger: DataFrame, dry: str = "dry_run") -> DataFrame:
    return ledger.where(~F.coalesce(F.col(dry), F.lit(False)))


def cleared(ledger: DataFrame, which: Column | None = None) -> DataFrame:
    """The ledger without the rows for which `which` holds (the failed ones, say); without it, reset to no rows."""
    return ledger.limit(0) if which is None else ledger.where(~F.coalesce(which, F.lit(False)))


def finished_videos(base: DataFrame, update: DataFrame, audio: DataFrame, key: str, fields: list[str], looked_up: list[str]) -> DataFrame:
    """merge_fields, with the audio's `looked_up` fields for keys that only the update has."""
    known = base.select(key).distinct().withColumn("_old", F.lit(True))
    found = audio.select(key, *[F.col(c).alias(f"_a_{c}") for c in looked_up]).dropDuplicates([key])
    got = merge_fields(base, update, key, fields).join(known, key, "left").join(found, key, "left")
    fill = {c: F.when(F.col("_old").isNull(), F.coalesce(F.col(c), F.col(f"_a_{c}"))).otherwise(F.col(c)) for c in looked_up}
    return got.withColumns(fill).select(base.columns)


def uploads(log: DataFrame, filename: str, seq: str, playlist: str) -> tuple[DataFrame, DataFrame]:
    """The upload ledger, the last record of each file (without a playlist that is null: `playlist` then is null), and its totals:
    total_uploaded (files), in_playlist and last_upload (the greatest seq)."""
    held = latest(log.where(F.col(filename).isNotNull()), filename, seq)
    return held, held.agg(F.count("*").alias("total_uploaded"), F.count(playlist).alias("in_playlist"), F.max(seq).alias("last_upload"))


def latest(log: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key: the last record."""
    picked = log.groupBy(key).agg(F.max_by(F.struct(*[c for c in log.columns if c != key]), F.col(seq)).alias("_r"))
    return picked.select(key, "_r.*")


def outcomes(batches: DataFrame, key: str) -> DataFrame:
    """One row per item of batch results (job_id, successful array, failed array)."""
    ok = batches.select("job_id", F.explode("successful").alias(key)).withColumn("ok", F.lit(True))
    return ok.unionByName(batches.select("job_id", F.explode("failed").alias(key)).withColumn("ok", F.lit(False)))


def job_states(log: DataFrame, job: str, seq: str, status: str, now: Column, started: str, timeout_minutes: int) -> DataFrame:
    """Per job: the last status, and whether it is finished, succeeded or timed out at `now`."""
    last = log.groupBy(job).agg(F.max_by(status, seq).alias("status"), F.min(started).alias("started"))
    over = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 6e7 > timeout_minutes
    finished = F.col("status").isin("Succeeded", "Failed")
    return last.withColumn("finished", finished).withColumn("succeeded", F.col("status") == "Succeeded").withColumn("timed_out", ~finished & over)
