"""Typed pages as a data source: spark.read.format("grid").load(path), and the same as a stream.

A page is one file whose name holds its number; partitions are files, several small ones together. A filter on page is taken by the source, which then opens
only the pages asked for. A stream gives the files that are new since the last batch, in order of their times. Files are opened through Arrow's file
systems, so a path may be a URI of any store that Arrow reads; what only Spark reads goes through files.read_pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from .files import parse_line, split_ornament

SCHEMA = "page int, k int, text string, underlines array<struct<a: int, b: int>>, ornament string"
#: Bytes of files that one partition reads.
PARTITION_BYTES = 32 << 20


class Files(InputPartition):
    def __init__(self, paths: list[tuple[str, str]]) -> None:
        self.paths = paths


def page_of(path: str) -> int | None:
    found = re.search("[0-9]+", path.rsplit("/", 1)[-1])
    return int(found[0]) if found else None


def listed(path: str) -> list[tuple[int, str, str, int]]:
    """(time, root, path, size) of the files at a path, a folder or one file."""
    system, at = pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}" if path.startswith("/") else path)
    root = path[: len(path) - len(at)] if "://" in path else ""
    info = system.get_file_info(at)
    every = system.get_file_info(pafs.FileSelector(at, recursive=False)) if info.type == pafs.FileType.Directory else [info]
    return sorted((f.mtime_ns or 0, root, f.path, f.size or 0) for f in every if f.type == pafs.FileType.File and page_of(f.path) is not None and not f.base_name.startswith(("_", ".")))


def grouped(files: list[tuple[int, str, str, int]], limit: int) -> list[Files]:
    out, size = [], limit
    for _, root, path, n in files:
        if size + n > limit:
            out.append(Files([]))
            size = 0
        out[-1].paths.append((root, path))
        size += n
    return out


def rows_of(root: str, path: str) -> Iterator[tuple]:
    """The rows of one page: its lines are \\l{…}, padded to the widest."""
    system, at = pafs.FileSystem.from_uri(f"{root}{path}" if root else f"file://{path}")
    with system.open_input_file(at) as f:
        text = f.read().decode("utf-8")
    out = []
    for line in (x for x in text.split("\n") if x.startswith("\\l{")):
        ornament, rest = split_ornament(re.sub(r"\}\s*$", "", line[3:]))
        out.append((*parse_line(rest), ornament))
    width = max([1, *(len(t) for t, _, _ in out)])
    for k, (t, spans, ornament) in enumerate(out):
        yield page_of(path), k, t.ljust(width), [(s["a"], s["b"]) for s in spans], ornament


class Reader(DataSourceReader):
    def __init__(self, path: str, limit: int) -> None:
        self.path, self.limit, self.wanted = path, limit, []

    def pushFilters(self, filters):
        """Takes comparisons of page with values; others are left to Spark."""
        tests = {EqualTo: lambda v: lambda p: p == v, GreaterThan: lambda v: lambda p: p > v, GreaterThanOrEqual: lambda v: lambda p: p >= v, LessThan: lambda v: lambda p: p < v, LessThanOrEqual: lambda v: lambda p: p <= v, In: lambda v: lambda p: p in v}
        for f in filters:
            if type(f) in tests and f.attribute == ("page",):
                self.wanted.append(tests[type(f)](f.value))
            else:
                yield f

    def partitions(self):
        return grouped([f for f in listed(self.path) if all(t(page_of(f[2])) for t in self.wanted)], self.limit)

    def read(self, partition):
        for root, path in partition.paths if partition else []:
            yield from rows_of(root, path)


class StreamReader(DataSourceStreamReader):
    def __init__(self, path: str, limit: int) -> None:
        self.path, self.limit = path, limit

    def initialOffset(self) -> dict:
        return {"files": 0}

    def latestOffset(self) -> dict:
        return {"files": len(listed(self.path))}

    def partitions(self, start: dict, end: dict):
        return grouped(listed(self.path)[start["files"] : end["files"]], self.limit)

    def read(self, partition):
        for root, path in partition.paths:
            yield from rows_of(root, path)


class Grid(DataSource):
    """Options: path, and partition_bytes."""

    @classmethod
    def name(cls) -> str:
        return "grid"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(self.options["path"], int(self.options.get("partition_bytes", PARTITION_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with filters handed to the source."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Grid)
