"""The published layout as a sink: one file ``<language>/<split>.jsonl`` each, all of them or none."""

import uuid
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Store

# The splits every language folder has a file of.
SPLITS = ("train", "valid", "test")
# A task that puts a file together writes so many bytes of it, in such blocks.
_SLICE_BYTES, _BLOCK = 64 << 20, 4 << 20


class Part(NamedTuple):
    """What one task has of a target, still under a name of its attempt."""

    language: str
    split: str
    task: int
    path: str
    size: int


def _write_parts(lines: DataFrame, hidden: str) -> list[Part]:
    """Every task writes its sorted rows (language, split, value), a file for each target it has rows of."""

    def write(batches):
        context, parts, out = TaskContext.get(), [], None
        store, attempt, task = Store(), context.taskAttemptId(), context.partitionId()
        try:
            for language, split, told in _runs(batches):
                if not parts or parts[-1][:2] != [language, split]:
                    if out:
                        out.close()
                    parts.append([language, split, task, f"{hidden}/{language}/{split}.jsonl.{attempt}", 0])
                    out = store.create(parts[-1][3])
                out.write(told)
                parts[-1][4] += len(told)
        finally:
            if out:
                out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part[i] for part in parts], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()))],
            list(Part._fields),
        )

    found = lines.mapInArrow(write, "language string, split string, task long, path string, size long")
    return sorted(Part(*row) for row in found.collect())


def _copy(store: Store, pieces, out) -> None:
    """Write bytes ``start`` to ``stop`` of each piece (path, start, stop) to an open file."""
    for path, start, stop in pieces:
        with store.open(path) as file:
            file.seek(start)
            while start < stop:
                block = file.read(min(_BLOCK, stop - start))
                if not block:
                    raise OSError(f"{path} is shorter than it was")
                out.write(block)
                start += len(block)


def slices(parts: list[Part], slice_bytes: int = _SLICE_BYTES) -> list[tuple[int, list[tuple[str, int, int]]]]:
    """(at, pieces) of a target that its parts make in their order: where a slice begins, and what it is made of."""
    cut, at = [], 0
    for part in parts:
        start = 0
        while start < part.size:
            if at % slice_bytes == 0:
                cut.append((at, []))
            step = min(part.size - start, slice_bytes - at % slice_bytes)
            cut[-1][1].append((part.path, start, start + step))
            start, at = start + step, at + step
    return cut


def _put_together(spark, targets: dict[str, list[Part]]) -> None:
    """Make each target of its parts: by slices, side by side, or by one task that streams them where files can only be appended to."""
    store, rows = Store(), []
    for target, parts in targets.items():
        if store.writes_anywhere(target):
            store.create_sized(target, sum(part.size for part in parts))
            rows += [(target, at, pieces) for at, pieces in slices(parts)]
        else:
            rows.append((target, None, [(part.path, 0, part.size) for part in parts]))
    if not rows:
        return

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store()
        for batch in batches:
            for target, at, pieces in zip(batch["target"], batch["at"], batch["pieces"]):
                with store.create(target) if pd.isna(at) else store.update(target, int(at)) as out:
                    _copy(store, [(p["path"], int(p["start"]), int(p["stop"])) for p in pieces], out)
            yield pd.DataFrame({"written": [len(batch)]})

    table = spark.createDataFrame(rows, "target string, at long, pieces array<struct<path: string, start: long, stop: long>>")
    tasks = min(len(rows), 4 * spark.sparkContext.defaultParallelism)
    table.repartition(tasks).mapInPandas(put, "written long").agg(F.sum("written")).collect()


def _runs(batches) -> Iterator[tuple[str, str, bytes]]:
    """Language, split and joined lines of neighbouring rows."""
    for batch in batches:
        languages, splits, lines = (batch.column(i).to_pylist() for i in range(3))
        start = 0
        for at in range(1, len(lines) + 1):
            if at == len(lines) or (languages[at], splits[at]) != (languages[start], splits[start]):
                for name in (languages[start], splits[start]):
                    if not name or "/" in name or name[0] in "._":
                        raise ValueError(f"{name!r} cannot name a file")
                yield languages[start], splits[start], "".join(line + "\n" for line in lines[start:at]).encode()
                start = at


def write_flat(examples: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write split examples as ``<language>/{train,valid,test}.jsonl``, in the order of repository, path and span.

    A split without rows is an empty file. Rows are dealt out by ranges, so a target of any size is sorted
    by many tasks, which write its parts below a hidden folder beside the path; further tasks put each
    target's file together by slices. All files appear at once, by one rename, or none does: a failed job removes
    the hidden folder; a driver that dies leaves it, under a name that readers pass over. Without ``overwrite`` an
    existing path is an error.
    """
    path, store, spark = path.rstrip("/"), Store(), examples.sparkSession
    parent, _, name = path.rpartition("/")
    hidden = f"{parent}/.{name}-{uuid.uuid4().hex}"
    complete = f"{hidden}/complete"
    if not overwrite and store.exists(path):
        raise ValueError(f"{path} exists")
    order = ["language", "split", "repo", "path", "class_span"]
    fields = [name for name in examples.columns if name != "split"]
    line = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value")
    lines = examples.repartitionByRange(*order).sortWithinPartitions(*order).select("language", "split", line)
    try:
        made = defaultdict(list)
        for part in _write_parts(lines, hidden):
            made[part.language, part.split].append(part)
        for language in {language for language, _ in made}:
            for split in SPLITS:
                if (language, split) not in made:
                    store.write(f"{complete}/{language}/{split}.jsonl", b"")
        several = {}
        for (language, split), parts in made.items():
            target = f"{complete}/{language}/{split}.jsonl"
            if len(parts) == 1:
                store.move(parts[0].path, target)
            else:
                several[target] = parts
        _put_together(spark, several)
        if not made:
            store.make_folder(complete)
        if overwrite and store.exists(path):
            store.move(path, f"{hidden}/replaced")
        store.move(complete, path)
    finally:
        store.delete(hidden)
