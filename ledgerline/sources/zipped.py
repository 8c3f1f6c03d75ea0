"""Zip exports (S7): a Python data source that writes and reads CSV inside zip files.

``df.write.format("zip_csv").mode("overwrite").save(folder)`` writes ``part-<n>-<id>.zip`` in the folder, one for each task with
rows, each holding one ``part-<n>.csv``: a zip file cannot be appended to by several tasks, so a report that has to be one file
is one partition. A task streams its rows through the compressor and holds none. It writes into a hidden folder; the
commit moves the files of the successful attempts to their places and, in overwrite mode, then removes the older ones.
An aborted job, and attempts that failed, leave nothing. The first task always writes its file, so an export without rows
has a header.

Columns are text (``export_zip`` formats them with Spark's expressions). Fields are separated by ``sep``, all quoted, with
quotes doubled; NULL is an empty field without quotes, characters that the encoding lacks are ``?``. Reading takes a partition per zip file and yields text; the header of a
file names its columns. Paths go through Arrow's file systems, as in ``files``: the folder has to be one that all executors see.
"""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from .files import _entries, _filesystem, _is_dir, _norm, workers_can_import
from .sinks import CSV_OPTIONS, export_dir

#: characters of text given to the compressor at a time
PIECE = 1 << 16


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, if it has one, and its rows."""
    name: str | None
    rows: int


def _field(value: str | None) -> str:
    return "" if value is None else '"' + value.replace('"', '""') + '"'


def _zips(folder: str) -> list[str]:
    return sorted(x.base_name for x in _entries(folder)
                  if not _is_dir(x) and x.base_name.startswith("part-") and x.base_name.endswith(".zip"))


class ZipWriter(DataSourceWriter):
    def __init__(self, folder: str, names: list[str], overwrite: bool, sep: str, encoding: str):
        self.folder, self.names, self.overwrite, self.sep, self.encoding = folder, names, overwrite, sep, encoding
        self.job = uuid.uuid4().hex
        self.hidden = f"{folder}/_writing-{self.job}"
        files, hidden = _filesystem(self.hidden)
        files.create_dir(hidden, recursive=True)                # not in the tasks: one that outlives an abort would make it again

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext
        task = TaskContext.get()
        number = task.partitionId()
        first = next(iterator, None)
        if first is None and number:
            return Written(None, 0)
        name = f"part-{number:05d}-{task.taskAttemptId()}.zip"
        files, folder = _filesystem(self.hidden)
        rows, held, size = 0, [], 0
        with files.open_output_stream(f"{folder}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zipped, \
                zipped.open(f"part-{number:05d}.csv", "w", force_zip64=True) as member:
            member.write((self.sep.join(map(_field, self.names)) + "\n").encode(self.encoding, "replace"))
            row = first
            while row is not None:
                line = self.sep.join(map(_field, row)) + "\n"
                held.append(line)
                size, rows = size + len(line), rows + 1
                if size >= PIECE:
                    member.write("".join(held).encode(self.encoding, "replace"))
                    held, size = [], 0
                row = next(iterator, None)
            member.write("".join(held).encode(self.encoding, "replace"))
        return Written(name, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, folder = _filesystem(self.folder)
        files.create_dir(folder, recursive=True)
        old = _zips(self.folder) if self.overwrite else []
        for name in sorted(m.name for m in messages if m is not None and m.name):
            files.move(f"{folder}/_writing-{self.job}/{name}", f"{folder}/{name.rsplit('-', 1)[0]}-{self.job}.zip")
        for name in old:
            files.delete_file(f"{folder}/{name}")
        self._forget()

    def abort(self, messages: list[Written | None]) -> None:
        self._forget()

    def _forget(self) -> None:
        from pyarrow import fs
        files, folder = _filesystem(self.hidden)
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)


class ZipPart(InputPartition):
    def __init__(self, uri: str):
        super().__init__(uri)
        self.uri = uri


def _records(uri: str, sep: str, encoding: str, skip: int) -> Iterator[tuple]:
    """The rows of all members of a zip file, without the first ``skip`` of each."""
    csv.field_size_limit((1 << 31) - 1)                     # whole texts, of up to 2 GB
    files, path = _filesystem(uri)
    with files.open_input_file(path) as raw, zipfile.ZipFile(raw) as zipped:
        for member in zipped.namelist():
            with zipped.open(member) as data:
                rows = csv.reader(io.TextIOWrapper(data, encoding=encoding, newline=""), delimiter=sep, quoting=csv.QUOTE_NOTNULL)
                for row in islice(rows, skip, None):
                    yield tuple(row) or (None,)              # an empty line is a NULL in a single column


class ZipReader(DataSourceReader):
    def __init__(self, folder: str, sep: str, encoding: str):
        self.folder, self.sep, self.encoding = folder, sep, encoding

    def partitions(self) -> list[ZipPart]:
        return [ZipPart(f"{self.folder}/{name}") for name in _zips(self.folder)]

    def read(self, partition: ZipPart) -> Iterator[tuple]:
        return _records(partition.uri, self.sep, self.encoding, 1)


class ZipCsv(DataSource):
    """Options: ``path``, ``sep`` and ``encoding``."""

    @classmethod
    def name(cls) -> str:
        return "zip_csv"

    @property
    def _format(self) -> tuple[str, str]:
        return self.options.get("sep", CSV_OPTIONS["sep"]), self.options.get("encoding", CSV_OPTIONS["encoding"])

    @property
    def _folder(self) -> str:
        return _norm(self.options["path"]).rstrip("/")

    def schema(self) -> T.StructType:
        names = _zips(self._folder)
        if not names:
            raise FileNotFoundError(f"{self._folder} has no zip export")
        header = next(_records(f"{self._folder}/{names[0]}", *self._format, 0))
        return T.StructType([T.StructField(c, T.StringType()) for c in header])

    def reader(self, schema) -> ZipReader:
        return ZipReader(self._folder, *self._format)

    def writer(self, schema: T.StructType, overwrite: bool) -> ZipWriter:
        other = [f.name for f in schema if not isinstance(f.dataType, T.StringType)]
        if other:
            raise TypeError(f"zip_csv writes text columns; format these first: {', '.join(other)}")
        return ZipWriter(self._folder, schema.names, overwrite, *self._format)


def _register(spark: SparkSession) -> None:
    workers_can_import(spark)
    spark.dataSource.register(ZipCsv)


def _as_text(field: T.StructField):
    name = "`" + field.name.replace("`", "``") + "`"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(name, CSV_OPTIONS["timestampFormat"]).alias(field.name)
    return F.col(name).cast("string").alias(field.name)


def export_zip(df: DataFrame, base: str, name: str, as_of, *, single_file: bool = False, encoding: str = "windows-1251") -> str:
    """The zipped form of ``sinks.export_csv``: the report for ``as_of`` in its dated folder, which is returned. Order is kept
    across part files in name order when ``df`` is sorted. ``single_file`` only for reports of bounded size."""
    _register(df.sparkSession)
    out = export_dir(base, name, as_of)
    text = df.select(*[_as_text(f) for f in df.schema])
    (text.coalesce(1) if single_file else text).write.format("zip_csv").option("encoding", encoding).mode("overwrite").save(out)
    return out


def read_zip(spark: SparkSession, folder: str, encoding: str = "windows-1251") -> DataFrame:
    """The rows of an export, as text columns."""
    _register(spark)
    return spark.read.format("zip_csv").option("encoding", encoding).load(folder)
