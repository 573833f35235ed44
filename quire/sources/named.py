"""Files with given names, published all at once.

A batch data source writer: each task writes its rows' files, under their final names, below a staging folder next to the target.
The commit renames that folder to the target, so a reader sees all files or none; an abort deletes it, and a failed task
leaves nothing. The driver handles two paths, however many files there are.

Files are written through Arrow's file systems (local and shared folders, HDFS, object stores). Where a store has no rename of
folders, publishing is as atomic as its copy.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SCHEMA = "path string, content binary"
#: Rows that a task is handed at once: a task holds so many contents, whatever its part of the table.
HANDED = 256


def system_of(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        return fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest else path
    return fs.FileSystem.from_uri(path)


def checked(name: str) -> str:
    """A relative path of plain names."""
    parts = (name or "").split("/")
    if not all(p and p not in (".", "..") for p in parts) or any(p.startswith("_") for p in parts[:1]):
        raise ValueError(f"{name!r} isn't a name below the target")
    return name


class Written(WriterCommitMessage):
    def __init__(self, files: int, size: int):
        self.files, self.size = files, size


class NamedWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{self.path.rpartition('/')[0]}/.{self.path.rpartition('/')[2]}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        system, top = system_of(self.staging)
        made, files, size = set(), 0, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                # A content at a time: a copy of the batch as a list would double it.
                name, content = (batch.column(c)[i].as_py() for c in (0, 1))
                folder = f"{top}/{checked(name)}".rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                # An attempt that is repeated or runs twice writes the same bytes; a rename replaces them whole.
                part = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(part) as out:
                    out.write(content or b"")
                system.move(part, f"{top}/{name}")
                files, size = files + 1, size + len(content or b"")
            del batch  # not beside the next one
        return Written(files, size)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, top = system_of(self.staging)
        target = system_of(self.path)[1]
        system.create_dir(top, recursive=True)
        with system.open_output_stream(f"{top}/_published.json") as out:
            out.write(b'{"files": %d, "bytes": %d}\n' % (sum(m.files for m in messages if m), sum(m.size for m in messages if m)))
        there = system.get_file_info(target).type != fs.FileType.NotFound
        if there and not self.overwrite:
            system.delete_dir(top)
            raise ValueError(f"{self.path} exists")
        old = f"{top}-old"
        if there:
            system.move(target, old)
        system.move(top, target)
        if there:
            system.delete_dir(old)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        from pyarrow import fs

        system, top = system_of(self.staging)
        if system.get_file_info(top).type != fs.FileType.NotFound:
            system.delete_dir(top)


class NamedFiles(DataSource):
    """Write format `named_files`: rows (path below the target, content) become files."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> NamedWriter:
        return NamedWriter(self.options["path"], overwrite)


def write_named(rows: DataFrame, path: str) -> int:
    """A file for each of rows (path: a relative name, unique; content: text or bytes) below `path`, which is replaced as a
    whole; returns how many. Repeated or null names raise an error before anything is written."""
    spark: SparkSession = rows.sparkSession
    twice = rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1 OR path IS NULL").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0]['path']!r} is no name of one file")
    spark.dataSource.register(NamedFiles)
    key, named = "spark.sql.execution.arrow.maxRecordsPerBatch", rows.select(F.col("path").cast("string"), F.col("content").cast("binary"))
    before = spark.conf.get(key)
    spark.conf.set(key, HANDED)
    try:
        named.write.format("named_files").mode("overwrite").save(path)
    finally:
        spark.conf.set(key, before)
    system, top = system_of(path.rstrip("/"))
    with system.open_input_stream(f"{top}/_published.json") as f:
        return json.loads(f.read())["files"]
