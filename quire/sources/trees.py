"""Files below a folder and their contents, listed and read by tasks.

Spark's own listing gathers the status of every file in the driver and deals the files out from there, so it grows with their
number. Here each task lists folders and writes what they hold to the shared folder; the folders found are the next round's, so there
are as many rounds as the tree is deep. The driver handles the number of files of each level and no names.

Local and shared folders are listed entry by entry, other stores through Arrow's file systems, a folder at a time; one that these
can't open is listed by Spark.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.operators.scans import scratch

#: Rows and bytes of a batch that is passed on, and files of a task at least.
ROWS, BYTES, FILES = 4096, 8 << 20, 32
FOUND = "path string, size long, is_folder boolean"


def is_local(path: str) -> bool:
    scheme, _, rest = path.partition(":")
    return scheme == "file" or not rest


def inside(path: str) -> str:
    """A local path without its scheme."""
    _, _, rest = path.partition(":")
    return "/" + rest.lstrip("/") if rest else path


def shown(name: str) -> bool:
    """Spark's rule of names that its readers see."""
    return not (name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_"))


def held_by(folder: str) -> Iterator[tuple[str, int, bool]]:
    """Name, size and whether it is a folder of what a folder holds; what goes meanwhile or leads nowhere is left out."""
    from pyarrow import fs

    if is_local(folder):
        with os.scandir(inside(folder)) as found:
            for x in found:
                try:
                    size, is_folder = x.stat().st_size, x.is_dir()
                except FileNotFoundError:
                    continue
                yield os.fsencode(x.name).decode("utf-8", "replace"), size, is_folder
    else:
        system, at = fs.FileSystem.from_uri(quote(folder, safe=":/@?&=%+,"))
        for x in system.get_file_info(fs.FileSelector(at)):
            yield x.base_name, x.size or 0, x.type == fs.FileType.Directory


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.schema([("path", pa.string()), ("size", pa.int64()), ("is_folder", pa.bool_())])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)
    rows: list[tuple] = []
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            for name, size, is_folder in held_by(folder):
                if shown(name) and (is_folder or size > 0):
                    rows.append((f"{folder.rstrip('/')}/{name}", size, is_folder))
                if len(rows) >= ROWS:
                    yield batch_of(rows)
                    rows = []
    if rows:
        yield batch_of(rows)


def spread(rows: DataFrame, n: int) -> DataFrame:
    """n rows dealt to tasks of FILES at least, as many as a shuffle has partitions at most."""
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(1, min(most, n // FILES)), "path")


def opens(path: str) -> bool:
    from pyarrow import fs

    try:
        return is_local(path) or bool(fs.FileSystem.from_uri(quote(path, safe=":/@?&=%+,")))
    except Exception:  # no such store here
        return False


def by_spark(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)


def below(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and size of the files below `path` (a folder, a file or a glob) whose names match a glob. Files of zero bytes and
    hidden names are left out, as by Spark's readers."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    system = top.getFileSystem(spark._jsc.hadoopConfiguration())
    tops = list(system.globStatus(top) or [])
    if not tops:
        raise FileNotFoundError(f"{path} does not exist")
    roots = [(x.getPath().toString(), x.getLen(), x.isDirectory()) for x in tops]
    if not all(opens(p) for p, _, _ in roots):
        return by_spark(spark, path, pattern).select("path", F.col("length").alias("size"))
    target, depth = scratch(spark), 0
    level = spark.createDataFrame(roots, FOUND)
    level.write.parquet(f"{target}/level0")
    # Each round lists the folders that the last one found.
    while n := (folders := level.where("is_folder").select("path")).count():
        depth += 1
        spread(folders, n * FILES).mapInArrow(listed, FOUND).write.parquet(f"{target}/level{depth}")
        level = spark.read.schema(FOUND).parquet(f"{target}/level{depth}")
    found = spark.read.schema(FOUND).parquet(*[f"{target}/level{k}" for k in range(depth + 1)])
    matches = f"(?s)^(?:{hadoop.GlobPattern(pattern).compiled().pattern()})$"
    kept = found.where(~F.col("is_folder") & (F.col("size") > 0) & F.element_at(F.split("path", "/"), -1).rlike(matches)).select("path", "size")
    return spread(kept, kept.count())


def whole(files: DataFrame) -> DataFrame:
    """files (path and more) with their `content`, read a few at a time; one that can't be read is an error."""
    from quire.sources.archives import opened

    rows = files.select("path", *[c for c in files.columns if c != "path"])
    fields = T.StructType([*rows.schema.fields, T.StructField("content", T.BinaryType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, lo, held = [], 0, 0
            for i, path in enumerate(batch.column(0).to_pylist()):
                with opened(path) as f:
                    out.append(f.read())
                held += len(out[-1])
                if held > BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*batch.slice(lo, i + 1 - lo).columns, pa.array(out, pa.binary())], names=fields.names)
                    out, lo, held = [], i + 1, 0

    return rows.mapInArrow(read, fields)


def read_below(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, size and content of the files below `path`."""
    if not opens(path):
        return by_spark(spark, path, pattern).select("path", F.col("length").alias("size"), "content")
    return whole(below(spark, path, pattern))
