"""Scans over a total order of all rows: running sums, counts, extremes and last values without one task for all rows.

Rows are range-partitioned by their order (with the hash of a row as the last key, so that many equal keys spread) and sorted;
the sorted table is written once, with a number `_m` that rises with the order: partition << 33 and the place in it. A chunk is
CHUNK consecutive numbers. Windows run within a chunk, so no distribution of the keys makes one larger. Each chunk's totals are
one row; these are scanned in the same way, level by level, until one chunk holds them all, and each row adds what stands before
its chunk. Keys may be of any types that Spark orders, descending too.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a chunk as a power of two.
CHUNK = 18


def scratch(spark: SparkSession) -> str:
    """A fresh folder under the shared folder of spark.checkpoint.dir; on a local master without one, a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quire-")
    path = f"{root.rstrip('/')}/quire-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def cut(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it again, which ends its lineage."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def columns_of(order: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sorted_table(rows: DataFrame, order: list[str | Column], folder: str | None = None, name: str = "sorted") -> DataFrame:
    """rows, written, with `_m`, a number that rises with the order. Rows equal in the order follow each other by their hash."""
    spark = rows.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Doubles' hashes tell -0.0 from 0.0, which only decides the order of rows that are equal otherwise.
    keys = [*columns_of(order), F.col("_h")]
    hashed = rows.withColumn("_h", F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in rows.dtypes]))
    ranged = hashed.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()).drop("_h")
    return cut(ranged, folder or scratch(spark), name)


class Running:
    """What a scan adds: how a column's values run together, up to and with each row."""

    def __init__(self, kind: str, value: Column | None = None):
        if kind not in ("sum", "count", "last", "max", "min"):
            raise ValueError(f"a scan can't run {kind!r}")
        self.kind, self.value = kind, F.lit(1).cast("long") if value is None else value

    def total(self, value: Column, place: Column) -> Column:
        """The aggregate over a chunk; `place` orders its rows."""
        if self.kind == "last":
            return F.max_by(value, F.when(value.isNotNull(), place))
        return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[self.kind](value)

    def over(self, value: Column, window) -> Column:
        if self.kind == "last":
            return F.last(value, ignorenulls=True).over(window)
        return {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}[self.kind](value).over(window)

    def join(self, before: Column, own: Column) -> Column:
        if self.kind == "last":
            return F.coalesce(own, before)
        if self.kind in ("max", "min"):
            return (F.greatest if self.kind == "max" else F.least)(before, own)
        return F.coalesce(before + own, own, before)


def run_over(table: DataFrame, place: str, adds: dict[str, Running], folder: str, chunk: int = CHUNK) -> DataFrame:
    """A sorted table with a column for each of `adds`, up to and with each row in order of its number."""
    return _running(table.withColumns({n: r.value for n, r in adds.items()}), place, adds, folder, 0, chunk, True)


def _running(table: DataFrame, place: str, adds: dict[str, Running], folder: str, level: int, chunk: int, inclusive: bool) -> DataFrame:
    """table with the columns of `adds` (which hold the values) run together in order of the unique `place`."""
    upto = 0 if inclusive else -1
    if level and table.limit((1 << chunk) + 1).count() <= 1 << chunk:
        window = W.orderBy(place).rowsBetween(W.unboundedPreceding, upto)  # 1 << chunk rows at most
        return table.withColumns({n: r.over(F.col(n), window) for n, r in adds.items()})
    c = f"_c{level}"
    dealt = table.withColumn(c, F.shiftright(place, chunk))
    totals = cut(dealt.groupBy(c).agg(*[r.total(F.col(n), F.col(place)).alias(n) for n, r in adds.items()]), folder, f"totals{level}")
    before = _running(totals, c, adds, folder, level + 1, chunk, False).select(c, *[F.col(n).alias(f"_b_{n}") for n in adds])
    window = W.partitionBy(c).orderBy(place).rowsBetween(W.unboundedPreceding, upto)
    own = dealt.withColumns({n: r.over(F.col(n), window) for n, r in adds.items()}).join(before, c)
    return own.withColumns({n: r.join(F.col(f"_b_{n}"), F.col(n)) for n, r in adds.items()}).drop(c, *[f"_b_{n}" for n in adds])


def scan(rows: DataFrame, order: list[str | Column], adds: dict[str, Running], chunk: int = CHUNK) -> DataFrame:
    """rows with a column for each of `adds`, run together over all rows in order up to and with each row.

    Sums skip nulls and are null before the first value; `last` is the last value that isn't null. Rows equal in the order come in
    the order of their hash. An input of one chunk needs one window only; the rows are the same. No rows give none.
    """
    held = rows.withColumns({n: r.value for n, r in adds.items()})
    if rows.limit((1 << chunk) + 1).count() <= 1 << chunk:
        tie = F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in held.dtypes])
        window = W.orderBy(*columns_of(order), tie).rowsBetween(W.unboundedPreceding, 0)  # 1 << chunk rows at most
        return held.withColumns({n: r.over(F.col(n), window) for n, r in adds.items()})
    folder = scratch(rows.sparkSession)
    return _running(sorted_table(held, order, folder), "_m", adds, folder, 0, chunk, True).drop("_m")


def numbered(rows: DataFrame, order: list[str | Column], name: str = "n", chunk: int = CHUNK) -> DataFrame:
    """rows with `name` = 0, 1, ... in order."""
    return scan(rows, order, {name: Running("count")}, chunk).withColumn(name, F.col(name) - 1)
