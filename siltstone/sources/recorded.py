"""Files with what is recorded of them (address, page and file they were found on), as a Spark data source.

``spark.read.format("recorded")`` makes one partition of each directory; filters on ext and length are told before any file is
opened, where the session pushes filters to Python sources (``PUSH``). ``df.write.format("recorded")`` writes each file and then its record beside it,
each by way of a name of its own and a rename, so a task that runs again leaves the same files. Paths go through pyarrow's file systems.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

RECORD = ("original_url", "source_page_url", "source_html_path")
SCHEMA = "path string, dir string, ext string, length long, content binary, original_url string, source_page_url string, source_html_path string"
MARK = ".record.json"
BATCH = 8 << 20
PUSH = "spark.sql.python.filterPushdown.enabled"


def opened(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def suffix(name: str) -> str:
    return posixpath.splitext(name)[1].lower()


@dataclass
class Directory(InputPartition):
    path: str


class Reader(DataSourceReader):
    def __init__(self, root: str, schema: StructType):
        self.root, self.names = root, schema.fieldNames()
        self.suffixes: set[str] | None = None
        self.least, self.most = 0, 1 << 62

    def partitions(self) -> list[Directory]:
        files, root = opened(self.root)
        found = files.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return [Directory(d) for d in sorted({posixpath.dirname(x.path) for x in found if x.type == fs.FileType.File})]

    def read(self, partition: Directory | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # there is no directory
            return
        files, root = opened(self.root)
        held, size = [], 0
        for x in files.get_file_info(fs.FileSelector(partition.path)):
            name = x.base_name
            wanted = x.type == fs.FileType.File and not name.startswith(".") and self.least <= x.size <= self.most
            if not wanted or (self.suffixes is not None and suffix(name) not in self.suffixes):
                continue
            with files.open_input_stream(x.path) as f:
                body = f.read()
            record = {}
            mark = posixpath.join(partition.path, f".{name}{MARK}")
            if files.get_file_info(mark).type == fs.FileType.File:
                with files.open_input_stream(mark) as f:
                    record = json.loads(f.read())
            path = posixpath.relpath(x.path, root)
            held.append({"path": path, "dir": posixpath.dirname(path), "ext": suffix(name), "length": len(body), "content": body, **{k: record.get(k) for k in RECORD}})
            size += len(body)
            if size > BATCH:
                yield self.batch(held)
                held, size = [], 0
        if held:
            yield self.batch(held)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {"length": pa.int64(), "content": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in self.names], self.names)


class Pushed(Reader):
    """The reader that is told the filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name == "ext" and isinstance(f, (EqualTo, In)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.suffixes = own if self.suffixes is None else self.suffixes & own
            elif name == "length" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.least = max(self.least, f.value + isinstance(f, GreaterThan))
            elif name == "length" and isinstance(f, (LessThan, LessThanOrEqual)):
                self.most = min(self.most, f.value - isinstance(f, LessThan))
            else:
                yield f


class Writer(DataSourceWriter):
    def __init__(self, root: str):
        self.root = root

    def write(self, rows) -> WriterCommitMessage:
        files, root = opened(self.root)
        made = set()
        for r in rows:
            path = posixpath.normpath(r["path"])
            if path.startswith(("/", "..")) or posixpath.basename(path).startswith("."):
                raise ValueError(f"not a path below the folder: {r['path']}")
            at = posixpath.join(root, path)
            folder, name = posixpath.split(at)
            if folder not in made:
                files.create_dir(folder, recursive=True)
                made.add(folder)
            record = {k: r[k] for k in RECORD if k in r and r[k] is not None}
            mark = posixpath.join(folder, f".{name}{MARK}")
            parts = [(at, bytes(r["content"] or b""))]
            if record:
                parts.append((mark, json.dumps(record, ensure_ascii=False).encode()))
            elif files.get_file_info(mark).type == fs.FileType.File:
                files.delete_file(mark)  # of a file that was written before
            for target, body in parts:
                own = posixpath.join(folder, f".{uuid.uuid4().hex}")
                with files.open_output_stream(own) as f:
                    f.write(body)
                files.move(own, target)
        return WriterCommitMessage()


class LineWriter(DataSourceWriter):
    """Writes rows (path, line) that come in the order of path; a file takes the place of all that its folder held before."""

    def __init__(self, root: str):
        self.root = root

    def write(self, rows) -> WriterCommitMessage:
        files, root = opened(self.root)
        for path, lines in groupby(rows, lambda r: r["path"]):
            at = posixpath.join(root, path)
            folder = posixpath.dirname(at)
            files.create_dir(folder, recursive=True)
            own = posixpath.join(folder, f".{uuid.uuid4().hex}")
            with files.open_output_stream(own) as f:
                for r in lines:
                    f.write(r["line"].encode() + b"\n")
            files.move(own, at)
            for x in files.get_file_info(fs.FileSelector(folder)):
                if x.type == fs.FileType.File and x.base_name != posixpath.basename(at):
                    files.delete_file(x.path)
        return WriterCommitMessage()


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "lines"

    def schema(self) -> str:
        return "path string, line string"

    def writer(self, schema: StructType, overwrite: bool) -> LineWriter:
        return LineWriter(self.options["path"])


class Recorded(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recorded"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> Reader:
        return (Pushed if self.options.get("push") == "true" else Reader)(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"])


def recorded(spark: SparkSession, path: str) -> DataFrame:
    """path, dir, ext, length, content and the record of each file below ``path``; files whose names begin with a dot are none."""
    spark.dataSource.register(Recorded)
    return spark.read.format("recorded").option("push", spark.conf.get(PUSH)).load(path)


def record(df: DataFrame, path: str) -> None:
    """Write ``df`` (path, content, and any of original_url, source_page_url, source_html_path) as files with their records."""
    df.sparkSession.dataSource.register(Recorded)
    df.write.format("recorded").mode("append").save(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """Write ``rows`` (path, line) as files below ``path``, each alone in its folder. Tasks rename files themselves, so nothing is left for the driver to move."""
    rows.sparkSession.dataSource.register(Lines)
    rows.select("path", "line").repartition("path").sortWithinPartitions("path").write.format("lines").mode("append").save(path)
