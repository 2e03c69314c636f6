"""Headers of chart files: a few KB of text before a raster of any size, of which nothing is read; and many small text files."""

from __future__ import annotations

import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.steps import dealt
from .volumes import local_path

END = b"\x1a"
BLOCK = 16_384  # bytes read at a time
FILES = 500  # in a task
FOLDERS = 1024  # that many files are dealt to


def files_below(paths: list[str]) -> Iterator[str]:
    """Files of all folders below, without those that begin with a dot or an underscore."""
    for path in paths:
        if os.path.isdir(path):
            entries = sorted((e for e in os.scandir(path) if e.name[0] not in "._"), key=lambda e: e.name)
            yield from files_below([e.path for e in entries])
        elif os.path.exists(path):
            yield path
        else:
            raise FileNotFoundError(path)


def read_header(path: str, block: int = BLOCK) -> bytes:
    """What stands before the first byte 0x1A, and that byte: block by block, so a raster behind it is never read."""
    parts = []
    with open(path, "rb", buffering=0) as file:
        while part := file.read(block):
            head, end, _ = part.partition(END)
            parts.append(head + end)
            if end:
                break
    return b"".join(parts)


def lines_of(header: bytes) -> list[str]:
    """The whole lines of a header; bytes that are not ASCII are dropped, and so is the line that the byte 0x1A cuts short."""
    lines = header.partition(END)[0].decode("ascii", "ignore").split("\n")
    return lines[:-1] if END in header or lines[-1] == "" else lines


def all_lines(path: str) -> list[str]:
    """The lines of a whole text file."""
    with open(path, "rb") as file:
        return re.split("\r?\n", file.read().decode("utf-8", "replace"))


def write_files(rows: DataFrame, folder: str, folders: int = FOLDERS) -> None:
    """A text file for each row (name, value), in folders below the given one, which all machines must share. Tasks write them without
    a committer, whose folder, rename and listing a file cost more than the file. A name has one place, by its checksum, and
    is given once the file is whole, so a task that runs twice does no harm."""
    top = local_path(folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, value in zip(*(batch.column(c).to_pylist() for c in ("name", "value")), strict=True):
                place = os.path.join(top, f"{zlib.crc32(name.encode()) % folders:04d}")
                part = os.path.join(place, f".{uuid.uuid4().hex}")
                os.makedirs(place, exist_ok=True)
                with open(part, "wb") as file:
                    file.write(value.encode())
                os.replace(part, os.path.join(place, name))
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    os.makedirs(top, exist_ok=True)
    dealt(rows.select("name", F.coalesce("value", F.lit("")).alias("value"))).mapInArrow(write, "n long").agg(F.sum("n")).collect()


class HeaderReader(DataSourceReader):
    def __init__(self, paths: list[str], files: int, whole: bool):
        self.paths, self.files, self.whole = paths, files, whole

    def partitions(self) -> list[InputPartition]:
        """Names by folder, so that the driver has no long path a file."""
        by_folder = lambda some: [(d, [os.path.basename(f) for f in g]) for d, g in itertools.groupby(some, os.path.dirname)]
        return [InputPartition(by_folder(some)) for some in itertools.batched(files_below(self.paths), self.files)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        found = (os.path.join(d, n) for d, names in partition.value for n in names)
        lines = all_lines if self.whole else lambda f: lines_of(read_header(f))
        for some in itertools.batched(found, 100):
            names = [f"file:{os.path.abspath(f)}" for f in some]
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([lines(f) for f in some], pa.list_(pa.string()))], ["path", "lines"])


class ChartHeaders(DataSource):
    """spark.read.format("chart_headers").option("paths", folders or files, a line each): path, lines. Option whole: all lines of text
    files."""

    @classmethod
    def name(cls) -> str:
        return "chart_headers"

    def schema(self) -> str:
        return "path string, lines array<string>"

    def reader(self, schema) -> HeaderReader:
        return HeaderReader([local_path(p) for p in self.options["paths"].split("\n")], int(self.options.get("files", FILES)), self.options.get("whole") == "true")
