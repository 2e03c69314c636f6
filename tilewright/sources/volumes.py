"""Archives as the byte files that other programs open: `name`, `name-1`, ...

A task writes its pieces straight to their places in the volumes, so tiles need not be shuffled or sorted for it, and a volume
may be the work of many tasks. Until the job commits, all of it lies in files of other names. The reader follows nothing
but the header. Both use plain files, so the archive's folder must be one that all machines share."""

from __future__ import annotations

import contextlib
import os
import re
import shutil
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

TILES = "source string, z int, x long, y long, content binary"
RANGE = struct.Struct(">6IQ")  # zoom, x and y from and to, source, where its index entries lie
ENTRY = np.dtype([("offset", ">u8"), ("size", ">u4")])


def local_path(path: str) -> str:
    """A path or file: address as a path of the shared file system."""
    found = urlparse(path)
    if found.scheme not in ("", "file"):
        raise ValueError(f"volumes are written in place, which needs a mounted folder, not {found.scheme}:")
    return unquote(found.path) if found.scheme else path


def volume_path(path: str, volume: int) -> str:
    return f"{path}-{volume}" if volume else path


def volumes_of(path: str) -> list[str]:
    """The files of an archive in order."""
    folder, name = os.path.split(path)
    found = [m for m in (re.fullmatch(re.escape(name) + r"(?:-([0-9]+))?", f) for f in os.listdir(folder or ".")) if m]
    return [os.path.join(folder, m[0]) for m in sorted(found, key=lambda m: int(m[1] or 0))]


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote, by volume: bytes, and where the last of them ends."""

    volumes: dict[int, tuple[int, int]]


class VolumeWriter(DataSourceArrowWriter):
    """Rows (volume, at, bytes) at their places. A task that runs twice writes the same bytes to the same places."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.folder = path, overwrite, f"{path}.{uuid.uuid4().hex}.writing"
        os.makedirs(self.folder)  # by the driver alone: once it is gone, a task that is being killed can't begin a file

    def staged(self, volume: int) -> str:
        return os.path.join(self.folder, str(volume))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        done: dict[int, tuple[int, int]] = {}
        with contextlib.ExitStack() as stack:
            files: dict[int, int] = {}
            for batch in iterator:
                for volume, at, data in zip(*(batch.column(c).to_pylist() for c in ("volume", "at", "bytes")), strict=True):
                    if volume not in files:
                        files[volume] = os.open(self.staged(volume), os.O_WRONLY | os.O_CREAT, 0o644)
                        stack.callback(os.close, files[volume])
                    size, end = done.get(volume, (0, 0))
                    done[volume] = (size + len(data), max(end, at + len(data)))
                    while data:
                        n = os.pwrite(files[volume], data, at)
                        data, at = data[n:], at + n
            for file in files.values():
                os.fsync(file)
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        """Gives the volumes their names, the one with the header last, if no byte of any is missing."""
        total: dict[int, tuple[int, int]] = {}
        for m in messages:
            for volume, (size, end) in (m.volumes if m else {}).items():
                a, b = total.get(volume, (0, 0))
                total[volume] = (a + size, max(b, end))
        holes = [v for v, (size, end) in total.items() if size != end]
        there = volumes_of(self.path)
        if holes or sorted(total) != list(range(len(total))) or (there and not self.overwrite):
            self.abort(messages)
            raise ValueError(f"{self.path} exists" if there and not self.overwrite else f"bytes of volumes {holes or sorted(total)} are missing or overlap")
        for old in there:  # its header goes first, so nobody reads half of either archive
            os.remove(old)
        for volume in sorted(total, reverse=True):
            os.replace(self.staged(volume), volume_path(self.path, volume))
        shutil.rmtree(self.folder)

    def abort(self, messages: list[Written | None]) -> None:
        while os.path.isdir(self.folder):
            shutil.rmtree(self.folder, ignore_errors=True)


class RangePart(InputPartition):
    """Stretches (source, zoom, first x, rows of a column, first y, first place, where their index begins, tiles) of ranges."""

    def __init__(self, stretches: list[tuple]):
        super().__init__(stretches)


class VolumeReader(DataSourceReader):
    """The tiles of an archive; each partition has about so many, however large a range is."""

    def __init__(self, path: str, tiles: int, uid: int):
        self.path, self.tiles, self.uid = path, tiles, uid

    def partitions(self) -> list[RangePart]:
        with open(self.path, "rb") as file:
            number = lambda: struct.unpack(">I", file.read(4))[0]
            file.seek(self.uid)
            version, _ = number(), number()
            if version != 4:
                raise ValueError(f"{self.path} is no archive of version 4")
            names = {}
            for _ in range(number()):
                index = number()
                names[index] = file.read(number()).decode("ascii", "ignore")
            parts, some, room = [], [], self.tiles
            for _ in range(number()):
                z, x0, x1, y0, y1, source, at = RANGE.unpack(file.read(RANGE.size))
                rows = y1 - y0 + 1
                first, left = 0, (x1 - x0 + 1) * rows
                while left:
                    n = min(left, room)
                    some.append((names[source], z, x0, rows, y0, first, at + first * ENTRY.itemsize, n))
                    first, left, room = first + n, left - n, room - n
                    if not room:
                        parts.append(RangePart(some))
                        some, room = [], self.tiles
        return [*parts, RangePart(some)] if some else parts

    def read(self, partition: RangePart) -> Iterator[pa.RecordBatch]:
        files = volumes_of(self.path)
        upto = np.cumsum([os.path.getsize(f) for f in files])
        with contextlib.ExitStack() as stack:
            opened = [os.open(f, os.O_RDONLY) for f in files]
            for f in opened:
                stack.callback(os.close, f)
            for name, z, x0, rows, y0, first, at, n in partition.value:
                for low in range(0, n, 256):
                    some = min(256, n - low)
                    entries = np.frombuffer(os.pread(opened[0], some * ENTRY.itemsize, at + low * ENTRY.itemsize), ENTRY)
                    contents = []
                    for offset, size in entries.tolist():
                        v = int(np.searchsorted(upto, offset, side="right")) if size else 0
                        contents.append(os.pread(opened[v], size, offset - (int(upto[v - 1]) if v else 0)))
                    place = first + low + np.arange(some)
                    columns = [pa.array([name] * some, pa.string()), pa.array([z] * some, pa.int32()), pa.array(x0 + place // rows), pa.array(y0 + place % rows), pa.array(contents, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["source", "z", "x", "y", "content"])


class TileArchive(DataSource):
    """spark.read.format("tile_archive").option("path", ...): TILES. Writing takes rows (volume, at, bytes); see archive_rows."""

    @classmethod
    def name(cls) -> str:
        return "tile_archive"

    def schema(self) -> str:
        return TILES

    def reader(self, schema) -> VolumeReader:
        return VolumeReader(local_path(self.options["path"]), int(self.options.get("tiles", 65_536)), int(self.options.get("uid", 0)))

    def writer(self, schema, overwrite: bool) -> VolumeWriter:
        return VolumeWriter(local_path(self.options["path"]), overwrite)


def write_volumes(rows: DataFrame, path: str) -> None:
    """rows (volume, at, bytes) as files path, path-1, ...; an archive of that name is replaced when all is written."""
    rows.sparkSession.dataSource.register(TileArchive)
    rows.select("volume", "at", "bytes").write.format("tile_archive").option("path", path).mode("overwrite").save()


def read_volumes(spark: SparkSession, path: str, tiles: int = 65_536, uid: int = 0) -> DataFrame:
    """source, z, x, y, content of all tiles of an archive, found by its header alone. tiles: about so many a task. uid: bytes that
    stand before the header."""
    spark.dataSource.register(TileArchive)
    return spark.read.format("tile_archive").option("path", path).option("tiles", tiles).option("uid", uid).load()
