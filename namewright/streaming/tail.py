"""A streaming source of the lines of files that grow in place."""

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader

from ..sources.lines import RANGE_BYTES, ByteRange, RangePartition, lines_of_range, split_pattern, visible_files
from ..sources.store import LASTING, Store


class LineTail(DataSource):
    """Rows (path, value), one per finished line, of all files below ``path``, old and new.

    The offset of the stream is the size seen per file, kept in the checkpoint. A batch reads the lines whose
    line end lies between two sizes, so a line appended to a known file is read in the next batch, once, and a line
    without its line end waits. A file that has become shorter was rewritten, not
    appended to, and ends the stream with an error; so does one that has gone with lines unread.
    Names that start with ``_`` or ``.`` are passed over. ``path`` may hold wildcards.
    The driver lists files and keeps one number for each; it opens none.

    With ``bytesPerTrigger`` a batch takes at most so many bytes, shared among the files that have unread
    ones, so a long backlog is worked off in batches of one size and no file waits for another. With
    ``untilNow`` the end is frozen at the sizes that the first listing finds. Spark runs one batch of a
    Python source for ``availableNow``; a bounded stream takes a trigger by time, see ``jobs.append_bounded``.
    """

    @classmethod
    def name(cls):
        return "line_tail"

    def schema(self):
        return "path string, value string"

    def streamReader(self, schema):
        options = self.options
        limit = options.get("bytesPerTrigger")
        return LineTailReader(
            options["path"],
            int(options.get("rangeBytes", RANGE_BYTES)),
            None if limit is None else int(limit),
            str(options.get("untilNow", False)).lower() == "true",
        )


def admitted(reached: dict, sizes: dict, limit: int) -> dict:
    """The offset that lies up to ``limit`` bytes after ``reached``, no further than ``sizes``.

    Files with little to read are taken whole, the others get equal shares of what is left. A file that has
    become shorter keeps its new size, so that the planning of the batch finds it.
    """
    offset = {path: size for path, size in sizes.items() if size <= reached.get(path, 0)}
    waiting = sorted((size - reached.get(path, 0), path) for path, size in sizes.items() if path not in offset)
    for place, (unread, path) in enumerate(waiting):
        if limit <= 0:
            break
        taken = min(unread, max(1, limit // (len(waiting) - place)))
        offset[path] = reached.get(path, 0) + taken
        limit -= taken
    for path, size in reached.items():
        if path in sizes:
            offset.setdefault(path, size)
    return offset


class LineTailReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int, limit: int | None = None, until_now: bool = False):
        if limit is not None and limit < 1:
            raise ValueError("bytesPerTrigger must be at least 1")
        self.root, self.pattern = split_pattern(path)
        self.range_bytes, self.limit, self.until_now = range_bytes, limit, until_now
        self.reached: dict = {}
        self.listed: dict | None = None

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        if self.listed is None or not self.until_now:
            sizes = dict(visible_files(Store(), self.root, self.pattern))
            for path, size in (self.listed or {}).items():
                if path not in sizes and size > self.reached.get(path, 0):
                    raise ValueError(f"{path} has gone before its lines were read")
            self.listed = sizes
        return dict(self.listed) if self.limit is None else admitted(self.reached, self.listed, self.limit)

    def partitions(self, start: dict, end: dict) -> list[RangePartition]:
        # Spark plans each batch here, and after a restart first an empty one at the end of the last batch.
        self.reached = end
        for path, before in start.items():
            if end.get(path, before) < before:
                raise ValueError(f"{path} is shorter than what was read of it; logs may only be appended to")
        return [
            RangePartition(ByteRange(path, low, min(stop, low + self.range_bytes), False))
            for path, stop in sorted(end.items())
            for low in range(start.get(path, 0), stop, self.range_bytes)
        ]

    def read(self, partition: RangePartition) -> Iterator[tuple]:
        path, start, stop, last = partition.value
        try:
            file = Store().open(path)
        except LASTING as error:
            raise ValueError(f"{path} has gone before its lines were read") from error
        with file:
            if file.seek(0, 2) < stop:
                raise ValueError(f"{path} was shortened while it was read")
            for _, line in lines_of_range(file, start, stop, last):
                yield path, line.rstrip(b"\r\n").decode("utf-8", "replace")


def follow_lines(spark: SparkSession, path: str, **options):
    """A stream of rows (path, value) from files that grow in place."""
    spark.dataSource.register(LineTail)
    return spark.readStream.format(LineTail.name()).options(path=path, **options).load()
