"""Files as bytes, read on executors in chunks: a listing with links and empty files, digests, headers, byte ranges.

Any store that pyarrow reads by its address (file, hdfs, s3, gs) will do. Nothing here holds a whole file.
"""

from __future__ import annotations

import hashlib
import posixpath
from collections.abc import Iterator
from fnmatch import fnmatch

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK = 1 << 20
#: A header and its line end have to lie in so many bytes.
HEADER_BYTES = 65_536


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def chunks(path: str, start: int = 0, end: int | None = None, size: int = CHUNK) -> Iterator[bytes]:
    """The bytes of a file from start to end, `size` at a time."""
    store, at = store_of(path)
    with store.open_input_file(at) as f:
        f.seek(start)
        while end is None or start < end:
            got = f.read(size if end is None else min(size, end - start))
            if not got:
                return
            start += len(got)
            yield got


def is_link(path: str) -> bool:
    """Whether a file of a local store is a symbolic link; other stores have none."""
    store, at = store_of(path)
    if not isinstance(store, pafs.LocalFileSystem):
        return False
    from pathlib import Path

    return Path(at).is_symlink()


def entries(folder: str, pattern: str = "*") -> list[tuple[str, int]]:
    """Address and bytes of all files below a folder (or of the one file), with empty and linked ones, without hidden ones.

    It is the driver's listing of names, as any reader of files makes it.
    """
    store, at = store_of(folder)
    head = folder[: len(folder) - len(at)] if folder.endswith(at) else f"{folder.split(':', 1)[0]}://"
    top = store.get_file_info(at)
    found = [top] if top.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(at, recursive=True))
    names = [(i, posixpath.relpath(i.path, at).split("/")) for i in found if i.type == pafs.FileType.File]
    return sorted((head + i.path, i.size) for i, parts in names if fnmatch(i.base_name, pattern) and not any(p.startswith(("_", ".")) and p not in (".", "..") for p in parts))


class _File(InputPartition):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size


class _Identities(DataSourceReader):
    def __init__(self, options):
        self.folder, self.pattern = options["path"], options.get("pattern", "*")

    def partitions(self):
        return [_File(*e) for e in entries(self.folder, self.pattern)] or [_File("", -1)]

    def read(self, partition: _File):
        if partition.size < 0:
            return
        linked = is_link(partition.path)
        digest, size, head = hashlib.sha256(), 0, b""
        # what a link points to is not read
        for got in [] if linked else chunks(partition.path):
            head = head or got[: HEADER_BYTES + 1]
            size += len(got)
            digest.update(got)
        end = head.find(b"\n")
        names = None if linked else _header(head[:end]) if end >= 0 else None
        yield partition.path, posixpath.basename(partition.path), size, None if linked else digest.hexdigest(), linked, names


def _header(line: bytes) -> list[str] | None:
    import csv

    try:
        return next(csv.reader([line.rstrip(b"\r").decode("utf-8-sig")]), None)
    except (UnicodeDecodeError, csv.Error):
        return None


class FileIdentities(DataSource):
    """spark.read.format("file_identities"): path, file_name, n_bytes, sha256, linked and header of each file of a folder.

    A partition is a file, which is read once in chunks. header is null if the first line doesn't end in HEADER_BYTES, isn't UTF-8
    or isn't a CSV record. Links are told and not followed.
    """

    @classmethod
    def name(cls) -> str:
        return "file_identities"

    def schema(self) -> str:
        return "path string, file_name string, n_bytes bigint, sha256 string, linked boolean, header array<string>"

    def reader(self, schema) -> DataSourceReader:
        return _Identities(self.options)


def count_ranges(folder: str, pattern: str = "*", range_bytes: int = 128 << 20) -> int:
    """Number of ranges that `ranges` gives, by the listing alone; 1 at least."""
    return max(sum(-(-max(n, 1) // range_bytes) for _, n in entries(folder, pattern)), 1)


class _Range(InputPartition):
    def __init__(self, path: str, size: int, start: int, end: int):
        self.path, self.size, self.start, self.end = path, size, start, end


class _Ranges(DataSourceReader):
    def __init__(self, options):
        self.folder, self.pattern, self.most = options["path"], options.get("pattern", "*"), int(options.get("rangeBytes", 128 << 20))
        if self.most < 1:
            raise ValueError("rangeBytes must be 1 or more")

    def partitions(self):
        return [_Range(p, n, s, min(s + self.most, n)) for p, n in entries(self.folder, self.pattern) for s in range(0, max(n, 1), self.most)] or [_Range("", 0, 0, -1)]

    def read(self, partition: _Range):
        """Line ends are counted one byte late, so that those counted open the lines that begin in the range."""
        if partition.end < 0:
            return
        import numpy as np

        quotes, ends = 0, [0, 0]
        for got in chunks(partition.path, max(partition.start - 1, 0), partition.end - 1) if partition.end else []:
            x = np.frombuffer(got, np.uint8)
            inside = (np.cumsum(x == 0x22) + quotes) % 2
            line_ends = inside[x == 0x0A]
            quotes += int(np.count_nonzero(x == 0x22))
            for k in (0, 1):
                ends[k] += int(np.count_nonzero(line_ends == k))
        yield partition.path, partition.size, partition.start, partition.end, quotes, ends[0], ends[1]


class FileRanges(DataSource):
    """spark.read.format("file_ranges"): byte ranges of the files of a folder, and what a splitter of quoted lines has to know of each.

    path, size, start and end; of the bytes from start - 1 to end - 1: the quotes, and the line ends behind an even and an odd
    number of these quotes. Options: path, pattern, rangeBytes. An empty file has one empty range.
    """

    @classmethod
    def name(cls) -> str:
        return "file_ranges"

    def schema(self) -> str:
        return "path string, size bigint, start bigint, end bigint, quotes bigint, even_ends bigint, odd_ends bigint"

    def reader(self, schema) -> DataSourceReader:
        return _Ranges(self.options)


def registered(spark: SparkSession) -> SparkSession:
    """The session, which now knows these sources by name."""
    spark.dataSource.register(FileIdentities)
    spark.dataSource.register(FileRanges)
    return spark


def identities(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    return registered(spark).read.format("file_identities").options(path=folder, pattern=pattern).load()


def ranges(spark: SparkSession, folder: str, pattern: str = "*", range_bytes: int = 128 << 20) -> DataFrame:
    return registered(spark).read.format("file_ranges").options(path=folder, pattern=pattern, rangeBytes=range_bytes).load()
