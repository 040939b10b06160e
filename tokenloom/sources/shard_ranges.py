"""Splittable binary source: a folder of shard files read in byte ranges.

Spark's ``binaryFile`` reads one file into one row, whole, and passes over
files of zero length. Here a partition is a byte range (or several small files
together), so a shard of any size is read by many tasks in rows of bounded
size, and an empty shard is one row without bytes.

Files are listed and opened through ``pyarrow.fs`` (local and shared folders,
HDFS, S3, GCS). The listing is metadata of one row per file, as in Spark's own
file index.
"""

from __future__ import annotations

import fnmatch
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import file_basename

FORMAT = "shard_ranges"
RANGE_BYTES = 64 << 20    # bytes a task reads
ROW_BYTES = 4 << 20       # bytes a row holds
FILE_COST = 4 << 20       # what opening a file counts as
LISTED_FILES = 4096       # files per task where only sizes are wanted


@dataclass
class Ranges(InputPartition):
    """Pieces ``(path, size, start, length)`` of one task."""
    pieces: list


def open_fs(path: str):
    """The file system of a path and the path inside it."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def list_files(path: str, glob: str, recursive: bool) -> list[tuple[str, int]]:
    """``(path, size)`` of the matching files, in name order; hidden ones (``_``, ``.``) are not data."""
    from pyarrow import fs
    where, inner = open_fs(path)
    root = inner.rstrip("/")
    found = []
    for i in where.get_file_info(fs.FileSelector(root, recursive=recursive)):
        parts = i.path[len(root) + 1:].split("/")
        if i.type == fs.FileType.File and fnmatch.fnmatchcase(parts[-1], glob) and not any(p[0] in "_." for p in parts):
            found.append((i.path, i.size))
    return sorted(found)


def cut_ranges(files: list[tuple[str, int]], range_bytes: int, tasks: int = 1, width: int = 1) -> list[Ranges]:
    """Files -> ranges of at most ``range_bytes``: long files in several, short ones together.

    As in Spark's own file scans, opening a file counts as ``FILE_COST`` bytes,
    and a small input is dealt over about ``tasks`` ranges."""
    cost = sum(size + FILE_COST for _, size in files)
    most = min(range_bytes, max(FILE_COST, cost // tasks)) // width * width
    ranges, now, room = [], [], most
    for path, size in files:
        start = 0
        while True:
            if now and room <= 0:
                ranges.append(Ranges(now))
                now, room = [], most
            length = min(size - start, room)
            now.append((path, size, start, length))
            room = (room - length - FILE_COST) // width * width
            start += length
            if start >= size:
                break
    return [*ranges, Ranges(now)] if now else ranges


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.glob = options.get("glob", "*")
        self.recursive = options.get("recursive", "false") == "true"
        self.content = options.get("content", "true") == "true"
        self.width = width = int(options.get("width", 1))
        self.tasks = int(options.get("tasks", 1))
        # ranges and rows end between tokens
        self.range_bytes = max(width, int(options.get("rangebytes", RANGE_BYTES)) // width * width)
        self.row_bytes = max(width, int(options.get("rowbytes", ROW_BYTES)) // width * width)

    def partitions(self):
        files = list_files(self.path, self.glob, self.recursive)
        if self.content:
            return cut_ranges(files, self.range_bytes, self.tasks, self.width) or [Ranges([])]
        pieces = [(p, size, 0, 0) for p, size in files]
        return [Ranges(pieces[i:i + LISTED_FILES]) for i in range(0, max(1, len(pieces)), LISTED_FILES)]

    def read(self, partition):
        where, _ = open_fs(self.path)
        for path, size, start, length in partition.pieces:
            if not length:
                yield path, size, start, b"" if self.content else None
                continue
            with where.open_input_file(path) as f:
                f.seek(start)
                left = length
                while left:
                    data = f.read(min(self.row_bytes, left))
                    if not data:
                        raise OSError(f"{path} ended {left} bytes before its listed size {size}")
                    yield path, size, start + length - left, data
                    left -= len(data)


class ShardRanges(DataSource):
    """``spark.read.format("shard_ranges")``; options ``path``, ``glob``, ``recursive``, ``width``,
    ``rangeBytes``, ``rowBytes``, ``tasks`` (a small input is dealt over about as many) and ``content`` (``false``: one row per file, nothing opened)."""

    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return "path STRING, size BIGINT, start BIGINT, data BINARY"

    def reader(self, schema):
        return _Reader(self.options)


def scan_ranges(spark: SparkSession, path: str, glob: str = "*", recursive: bool = False, content: bool = True,
                width: int = 1, range_bytes: int = RANGE_BYTES, row_bytes: int = ROW_BYTES) -> DataFrame:
    """``(path, file, size, start, data)``: every matching file in pieces, ``start`` bytes into the file.

    An empty file is one row with empty ``data``. Without ``content`` it is one
    row per file, ``data`` null. A folder that does not exist is an error."""
    spark.dataSource.register(ShardRanges)
    yes = {True: "true", False: "false"}
    df = (spark.read.format(FORMAT).option("glob", glob).option("recursive", yes[recursive])
          .option("content", yes[content]).option("width", width).option("rangeBytes", range_bytes)
          .option("rowBytes", row_bytes).option("tasks", spark.sparkContext.defaultParallelism).load(path))
    return df.select("path", file_basename(F.col("path")).alias("file"), "size", "start", "data")
