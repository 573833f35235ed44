"""An error channel for Arrow parsers: a malformed input costs its own row, not the job.

`attempted` runs a plain parser over each row in one pass. What it gives are rows with status `ok`; where it raises, there is one
row with null values, status `failed` and the reason, and nothing that it had given before. `good` and `bad` split the two.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Rows of a batch that is passed on.
ROWS = 4096


def attempted(rows: DataFrame, inputs: list[str], parse: Callable[..., Iterable[tuple]], schema: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of rows, those of `schema` (DDL) for each tuple that parse(*inputs) gives, status and reason.

    A row for which the parser gives nothing has no row. Columns of the schema stand for those of the same name in `keep`.
    """
    made = T.StructType.fromDDL(schema)
    keep = [c for c in keep if c not in made.names]
    fields = T.StructType([*[rows.schema[c] for c in keep], *made.fields, T.StructField("status", T.StringType()), T.StructField("reason", T.StringType())])
    kinds = [to_arrow_type(f.dataType) for f in made.fields]
    none = (None,) * len(kinds)

    def answers(values: tuple) -> list[tuple]:
        try:
            return [(*x, "ok", None) for x in parse(*values)]
        except Exception as e:  # whatever is wrong with one input is its own result
            return [(*none, "failed", f"{type(e).__name__}: {e}"[:500])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [*made.names, "status", "reason"], [*kinds, pa.string(), pa.string()]
        for batch in batches:
            columns = [batch.column(len(keep) + i) for i in range(len(inputs))]
            of, found = [], []
            for i in range(batch.num_rows):
                got = answers(tuple(c[i].as_py() for c in columns))
                of += [i] * len(got)
                found += got
                if len(found) >= ROWS or i == batch.num_rows - 1:
                    for lo in range(0, len(found), ROWS):
                        some = list(zip(*found[lo : lo + ROWS], strict=True))
                        at = pa.array(of[lo : lo + ROWS])
                        yield pa.RecordBatch.from_arrays([*[batch.column(j).take(at) for j in range(len(keep))], *[pa.array(c, k) for c, k in zip(some, types, strict=True)]], names=[*keep, *names])
                    of, found = [], []

    return rows.select(*keep, *[F.col(c).alias(f"_in{i}") for i, c in enumerate(inputs)]).mapInArrow(run, fields)


def good(df: DataFrame) -> DataFrame:
    return df.where("status = 'ok'").drop("status", "reason")


def bad(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.where("status = 'failed'").select(*keys, "reason")
