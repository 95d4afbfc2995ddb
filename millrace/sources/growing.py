"""Lines of files that grow, as a stream whose offsets are (file, byte).

A file's offset is always behind a line end, so a line counts once it is whole, is given once,
and is not given again after a restart: the offsets are in the query's checkpoint.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_lines"
#: Bytes read by one task, and looked through at once for the last line end.
TASK_BYTES = 32 << 20
LOOK_BYTES = 64 << 10


class GrowingLines(DataSource):
    """Options: ``path`` (a file or a folder, by any address that Arrow's file systems know), ``task_bytes``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, file string, offset long"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], int(self.options.get("task_bytes", TASK_BYTES)))


class _Range(InputPartition):
    def __init__(self, file: str, start: int, begin: int, end: int):
        """Lines whose first byte is in [begin, end); ``start`` is a line start at or before ``begin``."""
        self.file, self.start, self.begin, self.end = file, start, begin, end


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, task_bytes: int):
        self.path, self.task_bytes, self.ends = path, task_bytes, {}

    def _open(self) -> tuple[pafs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return pafs.FileSystem.from_uri(self.path.replace("file:/", "file:///", 1) if self.path.startswith("file:/") and
                                            not self.path.startswith("file://") else self.path)
        return pafs.LocalFileSystem(), self.path

    def _files(self, fs, path) -> list[pafs.FileInfo]:
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [info]
        found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return [f for f in found if f.type == pafs.FileType.File and not posixpath.basename(f.path).startswith((".", "_"))]

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        fs, path = self._open()
        ends = {}
        for info in self._files(fs, path):
            end = self._line_end(fs, info, self.ends.get(info.path, 0))
            if end:
                ends[info.path] = end
        self.ends = ends
        return ends

    @staticmethod
    def _line_end(fs, info, known: int) -> int:
        """The place behind the last line end, looked for from the end of the file backwards."""
        high, low = info.size, known if known <= info.size else 0
        with fs.open_input_file(info.path) as file:
            while high > low:
                begin = max(low, high - LOOK_BYTES)
                at = file.read_at(high - begin, begin).rfind(b"\n")
                if at >= 0:
                    return begin + at + 1
                high = begin
        return low

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out = []
        for file, to in end.items():
            low = start.get(file, 0)
            low = low if low <= to else 0  # a file that has become shorter is another one
            out += [_Range(file, low, at, min(at + self.task_bytes, to)) for at in range(low, to, self.task_bytes)]
        return out

    def read(self, part: _Range) -> Iterator[tuple]:
        fs, _ = self._open()
        with fs.open_input_file(part.file) as raw:
            at = part.begin
            if at > part.start:
                at = _behind_line(raw, at - 1)
            raw.seek(at)
            rest = b""
            while at < part.end:
                block = raw.read(LOOK_BYTES)
                if not block:
                    return
                *lines, rest = (rest + block).split(b"\n")
                for line in lines:
                    if at >= part.end:
                        return
                    yield line.removesuffix(b"\r").decode("utf-8", "replace"), part.file, at
                    at += len(line) + 1

    def commit(self, end: dict) -> None:
        pass


def _behind_line(raw, at: int) -> int:
    """The place behind the first line end at or after ``at``."""
    while block := raw.read_at(LOOK_BYTES, at):
        found = block.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(block)
    return at


def growing_lines(spark: SparkSession, path: str, task_bytes: int = TASK_BYTES) -> DataFrame:
    """A stream of (value, file, offset): each line of the files in ``path`` once it has its line end.

    The files have to be reached at the same address from the driver and every executor. A
    last line without an end waits for it. A file that became shorter is read from its start.
    """
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format(FORMAT).option("path", path).option("task_bytes", str(task_bytes)).load()
