"""Landed CSV files as a data source: one scan, each byte read once.

``spark.read.format("landed_csv")`` and ``spark.readStream.format("landed_csv")`` give a row for
every record and one for every file's header. A file is read by one task, as
quoted cells may hold line breaks, and its columns are bound by the names in its own
header. A task lists its source's folder itself and takes its share of the files, so
planning hands out folders and shares, never names.
"""

from __future__ import annotations

import csv
import io
import itertools
import time
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "landed_csv"
_ROWS = 2000  # records of an Arrow batch
_SHARE_BYTES = 64 << 20  # bytes of files that a task should read
_SETTLE = 10.0  # seconds after which no older file appears


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address and the path within it."""
    if path.startswith("s3a:"):
        path = "s3:" + path.removeprefix("s3a:")
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def landed(folder: str, after: int = -1, upto: int | None = None) -> Iterator[fs.FileInfo]:
    """CSV files of a folder that were changed after one time and up to another, in nanoseconds."""
    system, path = place(folder)
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=True)):
        inside = info.path.removeprefix(path)
        hidden = any(name.startswith(("_", ".")) for name in inside.split("/"))
        if info.is_file and info.path.endswith(".csv") and not hidden and info.mtime_ns > after and (upto is None or info.mtime_ns <= upto):
            yield info


@dataclass(frozen=True)
class Share(InputPartition):
    """The files of a folder whose names fall to one of several shares."""

    source: str
    folder: str
    number: int
    shares: int
    after: int = -1
    upto: int | None = None


class _Landing:
    def __init__(self, options: dict[str, str]):
        self.root = options["path"].rstrip("/")
        self.sources = options["sources"].split(",")
        self.required = options["required"].split(",")
        self.settle = float(options.get("settle", _SETTLE))

    def folders(self) -> Iterator[tuple[str, str]]:
        """Folders named by a source, plain or as a partition."""
        for source in self.sources:
            yield source, f"{self.root}/{source}"
            yield source, f"{self.root}/source={source}"

    def shares(self, after: int = -1, upto: int | None = None) -> list[Share]:
        found = []
        for source, folder in self.folders():
            files = total = 0
            for info in landed(folder, after, upto):
                files, total = files + 1, total + info.size
            n = min(files, max(1, -(-total // _SHARE_BYTES)))
            found += [Share(source, folder, i, n, after, upto) for i in range(n)]
        return found

    def rows(self, share: Share | None) -> Iterator[pa.RecordBatch]:
        if share is None:  # nothing has landed
            return
        system, _ = place(share.folder)
        for info in landed(share.folder, share.after, share.upto):
            if zlib.crc32(info.path.encode()) % share.shares == share.number:
                yield from _file(system, info.path, share.source, self.required)


def _file(system: fs.FileSystem, path: str, source: str, required: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The header's row, which has line 0 and tells the columns that lack, and the records of a complete file."""
    csv.field_size_limit(2**31 - 1)
    with system.open_input_stream(path) as stream, io.TextIOWrapper(stream, encoding="utf-8-sig", errors="replace", newline="") as text:
        records = (record for record in csv.reader(text) if record)
        header = next(records, None)
        lacking = [] if header is None else [name for name in required if name not in header]
        yield _batch([[None] * len(required)], [path], [source], [0], [False], [lacking], required)
        if header is None or lacking:
            return
        at = [header.index(name) for name in required]
        widest = max(at) + 1
        for first in itertools.count(1, _ROWS):
            some = list(itertools.islice(records, _ROWS))
            if not some:
                return
            cells = [record if len(record) >= widest else record + [None] * (widest - len(record)) for record in some]
            n = len(some)
            surplus = [len(record) > len(header) for record in some]
            yield _batch([[record[i] for i in at] for record in cells], [path] * n, [source] * n, range(first, first + n), surplus, [None] * n, required)


def _batch(cells, path, source, line, surplus, lacking, required) -> pa.RecordBatch:
    columns = [pa.array(column, pa.string()) for column in zip(*cells, strict=True)]
    columns += [pa.array(path, pa.string()), pa.array(source, pa.string()), pa.array(line, pa.int64()), pa.array(surplus, pa.bool_())]
    return pa.RecordBatch.from_arrays([*columns, pa.array(lacking, pa.list_(pa.string()))], [*required, "file", "source", "line", "surplus", "lacking"])


class LandingSource(DataSource):
    """Options: ``path`` (folder of the sources' folders), ``sources`` and ``required`` (names, by commas), ``settle`` (streams).

    Columns: the required ones as text, ``file``, ``source``, ``line`` (record number, 0 for a
    header), ``surplus`` (more cells than the header) and ``lacking`` (columns that a header lacks; null for records). A
    file that lacks a column gives its header only.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        cells = ", ".join(f"`{name}` string" for name in self.options["required"].split(","))
        return f"{cells}, file string, source string, line bigint, surplus boolean, lacking array<string>"

    def reader(self, schema) -> DataSourceReader:
        return LandingReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LandingStreamReader(dict(self.options))


class LandingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.landing = _Landing(options)

    def partitions(self) -> list[Share]:
        return self.landing.shares()

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return self.landing.rows(partition)


class LandingStreamReader(DataSourceStreamReader):
    """Files in the order of their times; an offset is the time up to which files are taken.

    A time counts once it is ``settle`` seconds old: files must not appear later with an older one.
    """

    def __init__(self, options: dict[str, str]):
        self.landing = _Landing(options)

    def initialOffset(self) -> dict:
        return {"upto": -1}

    def latestOffset(self) -> dict:
        now = time.time_ns() - int(self.landing.settle * 1e9)
        times = (info.mtime_ns for _, folder in self.landing.folders() for info in landed(folder, upto=now))
        return {"upto": max(times, default=-1)}

    def partitions(self, start: dict, end: dict) -> list[Share]:
        return self.landing.shares(start["upto"], end["upto"])

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        return self.landing.rows(partition)

    def commit(self, end: dict) -> None:
        pass
