"""Token counts of sections by offset-mapped attribution.

A whole text is encoded once. The tokens' byte lengths give their character spans, which are joined with the sections' spans
by interval; a token that crosses a section boundary is allocated by a rule:

- start: to the section of its first character (to none if that is in a gap);
- end: to the section of its last character;
- most: to the section with most of its characters, of equal ones the first;
- split: to every section it touches, in proportion to its characters there.

Sections are arrays of (name, start, stop) in code points, disjoint and in order of start; gaps may lie between them.
Lines are the default; `fields` lays the columns of a row end to end.

Defined cases: a null or empty text has no tokens, its sections count 0; without given sections an empty text has one empty
line and a null text no row; a null array of sections gives no rows; a token of which several make up one character (as for rare scripts) covers that
character; rows that repeat are counted each. Extra columns don't matter except for the ids asked for; an id named like an output
is given as `<name>_id`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import chunked
from quire.llm.bpe import BATCH_BYTES, Shipped, default_vocabulary, held

RULES = ("start", "end", "most", "split")


def token_spans(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 character of each token of `sizes` bytes."""
    head = (np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80
    char = np.cumsum(head) - 1
    stop = np.cumsum(sizes)
    return char[stop - sizes], char[stop - 1] + 1


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, stop: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and the tokens that lie in it only in part."""
    n, full = np.zeros(len(start)), np.zeros(len(start), dtype=np.int64)
    if not len(start) or not len(first):
        return n, full
    # The sections that a token touches: from the first that ends after its start to the last that starts before its end.
    lo, hi = np.searchsorted(stop, first, side="right"), np.searchsorted(start, last, side="left")
    touched = np.maximum(hi - lo, 0)
    token = np.repeat(np.arange(len(first)), touched)
    section = np.repeat(lo, touched) + np.arange(len(token)) - np.repeat(np.cumsum(touched) - touched, touched)
    shared = np.minimum(last[token], stop[section]) - np.maximum(first[token], start[section])
    on = shared > 0
    token, section, shared = token[on], section[on], shared[on]
    size = (last - first)[token]
    full += np.bincount(section[shared < size], minlength=len(start))
    if rule == "split":
        return n + np.bincount(section, weights=shared / size, minlength=len(start)), full
    if rule == "start":
        pick = (start[section] <= first[token]) & (first[token] < stop[section])
    elif rule == "end":
        pick = (start[section] < last[token]) & (last[token] <= stop[section])
    else:
        order = np.lexsort((section, -shared, token))
        pick = np.zeros(len(token), dtype=bool)
        pick[order[np.append(True, np.diff(token[order]) != 0)]] = True if len(order) else False
    return n + np.bincount(section[pick], minlength=len(start)), full


def lines(texts: list[str | None]) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Sections of texts, each line with the line feed that ends it: names ("0", "1", ...), starts, stops, and how many each
    text has (null: none)."""
    rows = [[] if t is None else [len(x) + 1 for x in t.split("\n")] for t in texts]
    count = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
    size = np.fromiter((n for r in rows for n in r), dtype=np.int64, count=int(count.sum()))
    if len(size):
        size[(np.cumsum(count) - 1)[count > 0]] -= 1  # the last line has no line feed
    done, owner = np.cumsum(size), np.repeat(np.arange(len(rows)), count)
    base = np.concatenate([[0], done])[np.cumsum(count) - count][owner]
    names = np.arange(len(size)) - np.repeat(np.cumsum(count) - count, count)
    return pa.array(names).cast(pa.string()), done - size - base, done - base, count


def fields(df: DataFrame, columns: list[str], text: str = "text", sections: str = "sections") -> DataFrame:
    """df with the columns laid end to end as one text, and a section for each."""
    body = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    at, spans = F.lit(0), []
    for c, b in zip(columns, body, strict=True):
        spans.append(F.struct(F.lit(c).alias("name"), at.alias("start"), (at + F.length(b)).alias("stop")))
        at = at + F.length(b)
    return df.withColumn(sections, F.array(*spans)).withColumn(text, F.concat(*body))


def attribute(df: DataFrame, ids: list[str], vocabulary: str, text: str = "text", sections: str | None = None, rule: str = "start") -> DataFrame:
    """One row for each section of each row of df: ids, section, first_char, n_chars, n_tokens (double), n_partial.

    sections: a column of sections; without one each line is a section.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    source = Shipped(df.sparkSession, vocabulary)
    made = ["section", "first_char", "n_chars", "n_tokens", "n_partial"]
    names_of = [f"{c}_id" if c in made else c for c in ids]
    kept = [T.StructField(n, df.schema[c].dataType) for n, c in zip(names_of, ids, strict=True)]
    schema = T.StructType([*kept, T.StructField("section", T.StringType()), T.StructField("first_char", T.LongType()), T.StructField("n_chars", T.LongType()), T.StructField("n_tokens", T.DoubleType()), T.StructField("n_partial", T.LongType())])
    place = len(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(source)
        size = np.fromiter(map(len, known.bytes), dtype=np.int64, count=known.size)
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            for lo, hi in chunked(list(map(len, texts)), BATCH_BYTES):
                part = batch.slice(lo, hi - lo)
                if sections is None:
                    names, start, stop, count = lines(part.column(place).to_pylist())
                else:
                    spans = part.column(place + 1)
                    flat, count = spans.flatten(), np.array([x or 0 for x in pc.list_value_length(spans).to_pylist()], dtype=np.int64)
                    start, stop = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("start", "stop"))
                    names = flat.field("name").cast(pa.string())
                ends = np.cumsum(count)
                tokens, partial = np.zeros(len(start)), np.zeros(len(start), dtype=np.int64)
                for t, found, a, b in zip(texts[lo:hi], known.encode(texts[lo:hi]), (ends - count).tolist(), ends.tolist(), strict=True):
                    if len(found) and b > a:
                        first, last = token_spans(t.encode(), size[found])
                        tokens[a:b], partial[a:b] = allocate(first, last, start[a:b], stop[a:b], rule)
                rows = pa.array(np.repeat(np.arange(hi - lo), count))
                columns = [part.column(i).take(rows) for i in range(place)]
                columns += [names, pa.array(start), pa.array(stop - start), pa.array(tokens), pa.array(partial)]
                yield pa.RecordBatch.from_arrays(columns, names=[*names_of, *made])

    spans = [F.col(sections).alias("_sections")] if sections is not None else []
    return df.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(ids)], F.col(text).alias("_text"), *spans).mapInArrow(run, schema)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token belongs to the line of its first character."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = attribute(docs, ["doc_id"], default_vocabulary())
    return got.select("doc_id", F.col("section").cast("long").alias("line"), "n_chars", F.col("n_tokens").cast("long").alias("n_tokens"), "n_partial")
