"""Landed files (C1, C3, A7): a Spark data source of file facts, and line counts that stop early.

``landed_files`` is a Python data source: ``spark.read.format("landed_files").load(root)`` has a row per file and directory
below ``root``. Its partitions are shares of subtrees. Planning opens directories from the top until there
are enough of them, but none of more than WIDE subdirectories: such a one is a directory in SHARES shares, each of which lists it and
walks the subdirectories whose name falls to it. So one job lists trees of any depth, no task walks all of
it, and the driver holds a bounded number of directory names and no file. Listing goes through Arrow's file systems
(local and mounted paths, HDFS, S3, GCS); unlike a Spark file scan this sees zero-length files and empty directories.

Line counts read byte ranges in tasks over a table of paths. ``lines_up_to`` stops a file's reading at the line that
decides, ``line_counts`` splits large files into ranges that tasks count side by side.
"""

from __future__ import annotations

import os
import zlib
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: partitions that planning aims at, subdirectories it opens a directory for, and shares of a wider one
PARTITIONS, WIDE, SHARES = 32, 1000, 8
#: bytes that a reader asks for at a time, and bytes of a range of a large file
CHUNK, RANGE = 1 << 16, 64 << 20

KIND = "path string, dir string, name string, length bigint, ms bigint, is_dir boolean, depth int"


def _norm(uri: str) -> str:
    """One spelling per file: local files as plain paths (``file:///x`` and ``file:/x`` become
    ``/x``), other file systems as URIs."""
    if uri.startswith("file://"):
        return uri[len("file://"):]
    if uri.startswith("file:"):
        return uri[len("file:"):]
    return uri


def _filesystem(uri: str):
    """(Arrow file system, path in it)."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + quote(uri))


def _entries(uri: str) -> list:
    """A directory's entries; a missing one has none."""
    from pyarrow import fs
    files, path = _filesystem(uri)
    return files.get_file_info(fs.FileSelector(path, allow_not_found=True))


def _is_dir(entry) -> bool:
    from pyarrow import fs
    return entry.type == fs.FileType.Directory


class Subtree(InputPartition):
    """Share ``share`` of ``shares`` of a directory's entries; with ``deep``, all below its subdirectories too."""

    def __init__(self, uri: str, depth: int, deep: bool, share: int = 0, shares: int = 1):
        super().__init__(uri)
        self.uri, self.depth, self.deep, self.share, self.shares = uri, depth, deep, share, shares

    def rows(self):
        stack = [(self.uri, self.depth, self.share, self.shares)]
        while stack:
            uri, depth, share, shares = stack.pop()
            for x in _entries(uri):
                if shares > 1 and zlib.crc32(x.base_name.encode()) % shares != share:
                    continue
                child, is_dir = f"{uri.rstrip('/')}/{x.base_name}", _is_dir(x)
                yield (child, uri.rstrip("/"), x.base_name, 0 if is_dir else x.size,
                       x.mtime_ns // 1_000_000 if x.mtime_ns else 0, is_dir, depth + 1)
                if is_dir and self.deep:
                    stack.append((child, depth + 1, 0, 1))


class Several(InputPartition):
    """A few subtrees that one task walks."""

    def __init__(self, parts: list[Subtree]):
        super().__init__(parts)
        self.parts = parts


class LandedReader(DataSourceReader):
    def __init__(self, root: str, wanted: int):
        self.root, self.wanted = _norm(root.rstrip("/")) or "/", wanted

    def partitions(self):
        parts, level = [], [(self.root, 0)]
        while level and len(level) < self.wanted:
            below = []
            for uri, depth in level:
                dirs = [x.base_name for x in _entries(uri) if _is_dir(x)]
                if len(dirs) > WIDE:
                    parts += [Subtree(uri, depth, True, i, SHARES) for i in range(SHARES)]
                else:
                    parts.append(Subtree(uri, depth, False))
                    below += [(f"{uri.rstrip('/')}/{d}", depth + 1) for d in dirs]
            level = below
        parts += [Subtree(uri, depth, True) for uri, depth in level]
        dealt = min(len(parts), 4 * self.wanted)
        return [Several(parts[i::dealt]) for i in range(dealt)]

    def read(self, partition):
        for part in partition.parts:
            yield from part.rows()


class LandedFiles(DataSource):
    """Options: ``path``, and ``partitions`` (how many to aim at)."""

    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def schema(self) -> str:
        return KIND

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options["path"], int(self.options.get("partitions", PARTITIONS)))


def workers_can_import(spark: SparkSession) -> None:
    """Python workers run this package's task code: where it is not installed, the folder that the driver has it
    in joins their search path."""
    folder = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [folder, known]))


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """All files and directories under ``root``; a missing root has none."""
    workers_can_import(spark)
    spark.dataSource.register(LandedFiles)
    return spark.read.format("landed_files").load(root)


def list_tree(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """All files and all directories under ``root`` (recursive), as two DataFrames."""
    found = landed_files(spark, root)
    return (found.where("NOT is_dir").select("path", "dir", "name", "length", F.timestamp_millis("ms").alias("mtime")),
            found.where("is_dir").select(F.col("path").alias("dir"), "name", "depth"))


# ---------------------------------------------------------------------------------------------
# lines


def lines_of(chunks, at_most: int | None = None) -> int:
    """Lines of consecutive byte strings (``\\n``, ``\\r\\n`` or ``\\r`` separated; a last line without an end counts), at
    most ``at_most``, after which nothing more is asked for."""
    lines, last = 0, b""
    for chunk in chunks:
        # a \r\n split by two chunks is one end
        lines += chunk.count(b"\n") + chunk.count(b"\r") - chunk.count(b"\r\n") - (last == b"\r" and chunk[:1] == b"\n")
        last = chunk[-1:] or last
        if at_most is not None and lines >= at_most:
            return at_most
    return lines + (last not in (b"", b"\n", b"\r"))


def _chunks(uri: str, read=None):
    from pyarrow import fs
    files, path = _filesystem(uri)
    if files.get_file_info(path).type != fs.FileType.File:
        return
    with files.open_input_file(path) as f:
        while True:
            chunk = f.read(CHUNK)
            if not chunk:
                return
            if read is not None:
                read(len(chunk))
            yield chunk


def lines_up_to(paths: DataFrame, at_most: int) -> DataFrame:
    """(path, lines) of the files in ``paths(path)``: their lines, or ``at_most`` of those with more. A file is
    read only as far as that takes. Missing files have 0."""
    workers_can_import(paths.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, type=pa.string()), pa.array([lines_of(_chunks(p), at_most) for p in names], type=pa.int64())],
                ["path", "lines"])

    return paths.select("path").distinct().mapInArrow(run, "path string, lines bigint")


def line_counts(files: DataFrame) -> DataFrame:
    """(path, lines) of all ``files(path, length)``, each counted in ranges of RANGE bytes."""
    workers_can_import(files.sparkSession)
    ranges = files.select("path", "length").distinct().select(
        "path", "length", F.explode(F.expr(f"sequence(0L, greatest(0L, length - 1), {RANGE}L)")).alias("start"))

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            found = []
            for uri, length, start in zip(*(batch.column(i).to_pylist() for i in range(3))):
                files, path = _filesystem(uri)
                lines, at, end = 0, start, min(start + RANGE, length)
                with files.open_input_file(path) as f:
                    f.seek(max(0, start - 1))
                    last = f.read(1) if start else b""
                    while at < end:
                        chunk = f.read(min(CHUNK, end - at))
                        if not chunk:
                            break
                        at += len(chunk)
                        lines += chunk.count(b"\n") + chunk.count(b"\r") - chunk.count(b"\r\n") - (
                            last == b"\r" and chunk[:1] == b"\n")
                        last = chunk[-1:]
                found.append(lines + (end == length > 0 and last not in (b"\n", b"\r")))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, type=pa.int64())], ["path", "lines"])

    return (ranges.repartition("path", "start").mapInArrow(run, "path string, lines bigint")
            .groupBy("path").agg(F.sum("lines").alias("lines")))
