"""A corpus pipeline over `documents`: five stages, each written as Parquet and read again by the next.

Every stage but the last returns the columns of documents. ORACLE_SQL is None: language models, fingerprints and BPE aren't
expressible in SQL. Tests compare the stages of near-duplicates, passages, decontamination and BPE with brute-force versions
on the rows that reach them, and the language stage with its rule by a plain model.

All stages: null keys and texts, empty and very long texts, repeated rows, empty tables and extra columns don't stop a stage; the
operators' docstrings give the results. Rows that repeat a key are judged each by itself, but for near-duplicates by key: of
those with a key that goes, all go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import bpe, decontaminate, language_id, simhash, substring
from quire.llm._common import cut, scratch

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the texts that some learned language accounts for: those with letters that code in fewer bits than they have."""
    return language_id.reject(docs, language_id.learn(docs)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document (by doc_id) of each group of near-duplicates: those that share 0.8 of their distinct five-word shingles."""
    return simhash.keep_one(docs).select(docs.columns)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words of 20-word windows that also start earlier; documents of which nothing is left go."""
    kept = substring.remove(docs).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    out = kept.withColumn("n_chars", F.when(changed, F.length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))) if "n_chars" in docs.columns else kept
    return out.withColumn("text", text).select(docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item, or nearly."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text; round_trip says whether they decode to the text."""
    coded = bpe.encode(docs, bpe.default_vocabulary(), decoded="decoded")
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select(*docs.columns, "token_ids", F.size("token_ids").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("bpe", encode_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of sf_dir; each stage's output is a table in the shared folder."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch(spark)
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), folder, name)
    return docs
