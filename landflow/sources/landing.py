"""Landed files as a table: a Python data source that lists folders and reads first lines.

Planning names folders only, one partition for each (or several, if ``slices`` asks for it); the tasks
list the files.  A first line is read in small pieces up to its line break, so the rest of a file is
never fetched.  Empty files are rows like any other.
"""

from __future__ import annotations

import csv
import fnmatch
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes fetched at once while a first line is looked for.
PIECE = 4096
#: Rows of a batch that a task hands over.
ROWS = 1000

_LISTED = "path string, length bigint, modificationTime timestamp"


def opened(path: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a path, the path within it, and what stands before that in full names."""
    if re.match(r"file:/|/", path):
        return fs.LocalFileSystem(), re.sub(r"^(file:)?/+", "/", path), "file:"
    found, inner = fs.FileSystem.from_uri(path)
    return found, inner, path[: path.find(inner)] if inner in path else f"{path.split(':')[0]}://"


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


class Folder(InputPartition):
    """Files of one folder whose names match, or one slice of them."""

    def __init__(self, root: str, inner: str, names: str, nth: int, of: int):
        super().__init__((root, inner, names, nth, of))
        self.root, self.inner, self.names, self.nth, self.of = root, inner, names, nth, of


def folders_of(root: str, glob: str) -> Iterator[tuple[str, str]]:
    """Folders (with the names wanted there) that a path with wildcards stands for, subfolders included."""
    store, inner, _ = opened(root)
    fixed, wild = [], inner.split("/")
    while wild and not re.search(r"[*?\[]", wild[0]):
        fixed.append(wild.pop(0))

    def below(folder: str) -> Iterator[str]:
        yield folder
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.type == fs.FileType.Directory and not _hidden(info.base_name):
                yield from below(info.path)

    def matching(folder: str, rest: list[str]) -> Iterator[tuple[str, str]]:
        if not rest:
            yield from ((f, glob) for f in below(folder))
            return
        if len(rest) == 1:
            yield folder, rest[0]  # files of that name, beside folders
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.type == fs.FileType.Directory and not _hidden(info.base_name) and fnmatch.fnmatchcase(info.base_name, rest[0]):
                yield from matching(info.path, rest[1:])

    start = "/".join(fixed) or "/"
    kind = store.get_file_info(start).type
    if kind == fs.FileType.NotFound:
        raise FileNotFoundError(root)
    if kind == fs.FileType.File:
        folder, _, name = start.rpartition("/")
        yield folder or "/", re.sub(r"([*?\[])", r"[\1]", name)
    else:
        yield from matching(start, wild)


def first_line(store: fs.FileSystem, path: str) -> bytes:
    """The bytes before the first line break (decompressed, where the name says so)."""
    found = bytearray()
    with store.open_input_stream(path) as stream:
        while piece := stream.read(PIECE):
            at = piece.find(b"\n")
            found += piece if at < 0 else piece[:at]
            if at >= 0:
                break
    return bytes(found).removesuffix(b"\r")


class LandingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.roots = json.loads(options["paths"])
        self.glob, self.head = options.get("glob", "*"), options.get("head") == "true"
        self.sep, self.encoding = options.get("sep", ","), options.get("encoding", "UTF-8")
        self.slices = int(options.get("slices", "1"))

    def partitions(self) -> list[Folder]:
        found = dict.fromkeys((root, *f) for root in self.roots for f in folders_of(root, self.glob))
        return [Folder(*f, nth, self.slices) for f in found for nth in range(self.slices)] or [Folder("", "", "", 0, 1)]

    def names_in(self, store: fs.FileSystem, path: str) -> list[str]:
        line = first_line(store, path).decode(self.encoding, "replace").removeprefix("﻿")
        return next(csv.reader([line], delimiter=self.sep), [])

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        if not partition.root:
            return
        store, _, before = opened(partition.root)
        files = [
            f
            for f in store.get_file_info(fs.FileSelector(partition.inner))
            if f.type == fs.FileType.File and not _hidden(f.base_name)
            and fnmatch.fnmatchcase(f.base_name, partition.names) and fnmatch.fnmatchcase(f.base_name, self.glob)
            and zlib.crc32(f.base_name.encode()) % partition.of == partition.nth
        ]
        for start in range(0, len(files), ROWS):
            some = files[start : start + ROWS]
            columns = {
                "path": pa.array([before + f.path for f in some], pa.string()),
                "length": pa.array([f.size for f in some], pa.int64()),
                "modificationTime": pa.array([f.mtime_ns // 1000 if f.mtime_ns else None for f in some], pa.int64()).cast(pa.timestamp("us", "UTC")),
            }
            if self.head:
                columns["header"] = pa.array([self.names_in(store, f.path) for f in some], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(columns)


class LandedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def schema(self) -> str:
        return _LISTED + (", header array<string>" if self.options.get("head") == "true" else "")

    def reader(self, schema) -> LandingReader:
        return LandingReader(dict(self.options))


def landed_files(
    spark: SparkSession, path: str | list[str], glob: str = "*", head: bool = False, sep: str = ",",
    encoding: str = "UTF-8", slices: int = 1,
) -> DataFrame:
    """``path, length, modificationTime`` of every file, with ``head`` the names in its first line as well."""
    spark.dataSource.register(LandedFiles)
    options = {
        "paths": json.dumps([path] if isinstance(path, str) else list(path)), "glob": glob, "sep": sep,
        "head": str(head).lower(), "encoding": encoding, "slices": str(slices),
    }
    return spark.read.format("landed_files").options(**options).load()
