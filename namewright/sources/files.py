"""Scan of source files below repository folders.

Spark's own file readers silently leave out every path that starts with ``_`` or
``.``, and with them each ``__init__.py``. So the folders are listed and the files
read by tasks on the executors, from a file system all of them can reach.
"""

from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import EXTENSIONS, language_of
from ..session import stage
from .store import LASTING, Store, patiently

# Flush a result batch after this many bytes of text.
_BATCH_BYTES = 4 * 1024 * 1024
# A folder's entries are taken up and handed on so many at a time.
_ENTRIES_PER_BATCH = 10_000
# A task leaves the folders that are still to be listed to other tasks after this many entries.
_ENTRIES_AT_ONCE = 10_000


def _fields(frame: DataFrame, names) -> str:
    return "".join(f"`{name}` {frame.schema[name].dataType.simpleString()}, " for name in names)


def list_sources(repos: DataFrame, languages=tuple(EXTENSIONS), entries_at_once: int = _ENTRIES_AT_ONCE) -> DataFrame:
    """All files of the wanted languages below each repository's ``root`` column.

    A task that has met ``entries_at_once`` entries below a folder hands the folders it has not
    opened yet to the next round, where they are spread over all tasks; so a repository
    with all its code below one folder keeps many tasks busy. Each round is a stored table.
    A folder that is missing or may not be read is a row of its own, with the reason in
    ``error`` and without a language; other faults of the storage end the job.
    """
    endings = tuple(EXTENSIONS[language] for language in languages)
    keep = [name for name in repos.columns if name != "root"]
    names = [*keep, "root", "full_path", "is_folder", "error"]
    schema = f"{_fields(repos, keep)}root string, full_path string, is_folder boolean, error string"

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store()

        def opened(folder):
            entries = store.entries(folder)
            return entries, list(islice(entries, _ENTRIES_PER_BATCH))

        for batch in batches:
            for row in batch.itertuples(index=False):
                same = [*(getattr(row, name) for name in keep), row.root]
                rows, folders, met = [], [row.full_path], 0
                while folders and met < entries_at_once:
                    folder = folders.pop()
                    found, error = patiently(lambda folder=folder: opened(folder))
                    entries, block = found or (None, [])
                    while block:
                        met += len(block)
                        for is_folder, path, _ in block:
                            if is_folder and met < entries_at_once:
                                folders.append(path)
                            elif is_folder or path.endswith(endings):
                                rows.append([*same, path, is_folder, None])
                        if len(rows) >= _ENTRIES_PER_BATCH:
                            yield pd.DataFrame(rows, columns=names)
                            rows = []
                        try:
                            block = list(islice(entries, _ENTRIES_PER_BATCH))
                        except LASTING as lasting:  # what was met before stays
                            block, error = [], type(lasting).__name__
                    if error:
                        rows.append([*same, folder, False, error])
                rows += [[*same, folder, True, None] for folder in folders]
                yield pd.DataFrame(rows, columns=names)

    tasks = repos.sparkSession.sparkContext.defaultParallelism
    todo, listed = repos.withColumn("full_path", F.col("root")), None
    while True:
        found = stage(todo.repartition(4 * tasks, "full_path").mapInPandas(walk, schema), "listed")
        files = found.filter(~F.col("is_folder"))
        listed = files if listed is None else listed.unionByName(files)
        todo = found.filter("is_folder").select(*keep, "root", "full_path")
        if todo.isEmpty():
            break
    relative = F.substring("full_path", F.length(F.rtrim("root", F.lit("/"))) + 2, F.length("full_path"))
    language = F.when(F.col("error").isNull(), language_of(F.col("full_path")))
    return listed.select(*keep, relative.alias("path"), "full_path", language.alias("language"), "error")


def read_sources(listed: DataFrame, partitions: int | None = None) -> DataFrame:
    """Read the listed files: lenient UTF-8, LF line ends.

    A file that is missing or may not be read has an empty text and the reason in ``error``;
    other faults of the storage end the job. Paths are spread by hash first, so no task owns
    a whole repository.
    """
    keep = [name for name in listed.columns if name not in ("full_path", "error")]
    told = listed if "error" in listed.columns else listed.withColumn("error", F.lit(None).cast("string"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store()

        def bytes_of(path):
            with store.open(path) as stream:
                return stream.read()

        for batch in batches:
            start, size, texts, errors = 0, 0, [], []
            paths, known = batch.pop("full_path").tolist(), batch.pop("error").tolist()
            for place, (path, error) in enumerate(zip(paths, known), 1):
                raw = None
                if not isinstance(error, str):
                    raw, error = patiently(lambda path=path: bytes_of(path))
                texts.append((raw or b"").decode("utf-8", "ignore").replace("\r\n", "\n").replace("\r", "\n"))
                errors.append(error)
                size += len(texts[-1])
                if size >= _BATCH_BYTES or place == len(paths):
                    yield batch.iloc[start:place].assign(content=texts, error=errors)
                    start, size, texts, errors = place, 0, [], []

    count = partitions or 4 * listed.sparkSession.sparkContext.defaultParallelism
    ordered = told.select(*keep, "full_path", "error").repartition(count, "full_path")
    return ordered.mapInPandas(read, f"{_fields(told, keep)}content string, error string")


def scan_sources(repos: DataFrame, languages=tuple(EXTENSIONS), partitions: int | None = None) -> DataFrame:
    """``repo_ord, repo, path, language, content, error`` of every source file.

    ``repos`` has ``repo_ord``, ``repo`` and ``root``, the checked-out folder. Folders that
    could not be opened are rows with an ``error`` and no language, which yield no examples.
    """
    return read_sources(list_sources(repos, languages), partitions)


def scan_accounts(files: DataFrame) -> DataFrame:
    """Per repository: files read, files that could not be read, folders that could not be opened."""
    failed = F.col("error").isNotNull()
    return files.groupBy("repo").agg(
        F.count_if(~failed).alias("files"),
        F.count_if(failed & F.col("language").isNotNull()).alias("unread_files"),
        F.count_if(failed & F.col("language").isNull()).alias("unread_folders"),
    )


def ingest_status(repos: DataFrame, languages=tuple(EXTENSIONS)) -> DataFrame:
    """Whether each listed repository could be opened, per language."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store()
        for batch in batches:
            opened = [
                patiently(lambda root=root: next(store.entries(root), None))[1] is None for root in batch["root"]
            ]
            yield batch[["repo_ord", "repo"]].assign(ok=opened)

    checked = repos.select("repo_ord", "repo", "root").mapInPandas(check, "repo_ord bigint, repo string, ok boolean")
    return checked.withColumn("language", F.explode(F.array(*[F.lit(language) for language in languages])))
