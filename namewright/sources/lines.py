"""Lines of text files of any size, read by byte ranges and numbered by counts per range."""

from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .store import LASTING, Store

RANGE_BYTES = 64 << 20
# A task reads neighbouring ranges up to these bytes, so that small ranges are not a task each.
_TASK_BYTES = 4 << 20
# A batch of lines is handed on at so many lines or bytes.
_BATCH_LINES, _BATCH_BYTES = 10_000, 4 << 20
_BLOCK = 1 << 16


class ByteRange(NamedTuple):
    """The lines of a file whose line end lies in ``start`` to ``stop``; ``last``: also what stands behind the last line end."""

    path: str
    start: int
    stop: int
    last: bool


class RangePartition(InputPartition):
    def __init__(self, value: list[ByteRange]):
        self.value = value


def split_pattern(path: str) -> tuple[str, list[str]]:
    """The folder before the first wildcard, and the patterns of the names below it."""
    parts = path.rstrip("/").split("/")
    wild = next((i for i, part in enumerate(parts) if any(c in part for c in "*?[")), len(parts))
    return "/".join(parts[:wild]), parts[wild:]


def visible_files(store: Store, root: str, pattern: list[str]) -> Iterator[tuple[str, int]]:
    """(path, bytes) of all files below ``root`` that fit the pattern; names that start with ``_`` or ``.`` are passed over."""
    folders = [root]
    while folders:
        for is_folder, path, size in store.entries(folders.pop()):
            inner = path[len(root) + 1 :].split("/")
            if inner[-1][0] in "_." or not all(map(fnmatchcase, inner, pattern)):
                continue
            if is_folder:
                folders.append(path)
            elif len(inner) >= len(pattern):
                yield path, size


def line_start(file, at: int) -> int:
    """Where the line that holds byte ``at`` starts, looked for backwards."""
    while at > 0:
        low = max(0, at - _BLOCK)
        file.seek(low)
        found = file.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return 0


def lines_of_range(file, start: int, stop: int, last: bool = False) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines whose line end lies between ``start`` and ``stop``.

    Every line of a file belongs to exactly one of its ranges, and what was read once
    stays as it is when the file grows. With ``last`` what follows the last line end is a line, too.
    """
    at = line_start(file, start)
    file.seek(at)
    while at < stop:
        line = file.readline(stop - at)
        if not line.endswith(b"\n"):
            if last and line:
                yield at, line
            return
        yield at, line
        at += len(line)


class NumberedLines(DataSource):
    """Rows (path, range, place, value): the lines of all files below ``path``, by ranges of ``rangeBytes`` bytes.

    ``range`` numbers a file's ranges and ``place`` the lines of a range, both from 0. Files of
    any size are split; no value is larger than its line. The driver lists files and sizes only.
    """

    @classmethod
    def name(cls):
        return "numbered_lines"

    def schema(self):
        return "path string, range long, place long, value string"

    def reader(self, schema):
        return NumberedLinesReader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)))


class NumberedLinesReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def partitions(self) -> list[RangePartition]:
        store = Store()
        found = sorted(visible_files(store, *split_pattern(self.path)))
        tasks, room = [], 0
        for path, size in found:
            for low in range(0, size, self.range_bytes):
                part = ByteRange(path, low, min(size, low + self.range_bytes), low + self.range_bytes >= size)
                if part.stop - low > room:
                    tasks.append([])
                    room = _TASK_BYTES
                tasks[-1].append(part)
                room -= part.stop - low
        return [RangePartition(parts) for parts in tasks] or [RangePartition([])]

    def read(self, partition: RangePartition) -> Iterator[pa.RecordBatch]:
        for path, parts in groupby(partition.value, key=lambda part: part.path):
            try:
                file = Store().open(path)
            except LASTING as error:
                raise ValueError(f"{path} has gone before its lines were read") from error
            with file:
                for _, start, stop, last in parts:
                    number, first, size, values = start // self.range_bytes, 0, 0, []
                    for place, (_, line) in enumerate(lines_of_range(file, start, stop, last), 1):
                        values.append(line.rstrip(b"\r\n").decode("utf-8", "replace"))
                        size += len(line)
                        if len(values) >= _BATCH_LINES or size >= _BATCH_BYTES:
                            yield self._batch(path, number, first, values)
                            first, size, values = place, 0, []
                    if values:
                        yield self._batch(path, number, first, values)

    @staticmethod
    def _batch(path: str, number: int, first: int, values: list[str]) -> pa.RecordBatch:
        n = len(values)
        columns = [
            pa.array([path] * n, pa.string()), pa.array([number] * n, pa.int64()),
            pa.array(range(first, first + n), pa.int64()), pa.array(values, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["path", "range", "place", "value"])


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, range, place, value) of the lines of all files below ``path``."""
    spark.dataSource.register(NumberedLines)
    return spark.read.format(NumberedLines.name()).options(path=path, rangeBytes=range_bytes).load()


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line``, the line's number in its file from 0, to rows (path, range, place).

    Only the counts of the ranges are summed up, one small row per range; a file of any size is numbered by many tasks.
    """
    counts = lines.groupBy("path", "range").agg(F.count("*").alias("_count"))
    before = Window.partitionBy("path").orderBy("range")
    starts = counts.select("path", "range", (F.sum("_count").over(before) - F.col("_count")).alias("_before"))
    return lines.join(starts, ["path", "range"]).withColumn("line", F.col("_before") + F.col("place")).drop("_before")


def records(lines: DataFrame, is_head) -> DataFrame:
    """(path, record, value): a line for which ``is_head`` is true begins a record, the lines up to the next one belong to it.

    ``lines`` are numbered. The last head before a line is looked up in its range; a range that starts inside
    a record takes the last head of the ranges before it, found among one row per range. ``record`` is the number of
    the head's line; lines before any head are records of their own, with negative numbers. A record is one value.
    """
    marked = lines.withColumn("_head", F.when(is_head, F.col("line")))
    along = Window.partitionBy("path", "range").orderBy("place")
    inner = marked.withColumn("_inner", F.max("_head").over(along))
    last = marked.groupBy("path", "range").agg(F.max("_head").alias("_last"))
    earlier = Window.partitionBy("path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("path", "range", F.max("_last").over(earlier).alias("_carried"))
    owned = inner.join(carried, ["path", "range"]).withColumn("record", F.coalesce("_inner", "_carried", -1 - F.col("line")))
    grouped = owned.groupBy("path", "record").agg(F.sort_array(F.collect_list(F.struct("line", "value"))).alias("_lines"))
    return grouped.select("path", "record", F.array_join(F.col("_lines")["value"], "\n").alias("value"))
