"""A caller's own aggregates: partial states per Arrow batch, merged in a tree."""

import pickle
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any, NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

FAN = 32
GROUPS_IN_MEMORY = 4096


class Aggregate(NamedTuple):
    """A score over all rows that no mean of per-row scores gives.

    ``zero()`` is the state of no rows, ``update(state, frame)`` takes in a pandas frame of the
    asked columns, ``merge(state, state)`` joins two states and ``finish(state)`` gives a
    dictionary of the columns that ``result`` defines. Merging must not depend on order,
    and a state should stay small, whatever it has seen: it is pickled and shuffled.
    """

    zero: Callable[[], Any]
    update: Callable[[Any, pd.DataFrame], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], dict]
    result: str


def _groups(batch: pa.RecordBatch, n_keys: int) -> Iterator[tuple[tuple, list[int]]]:
    """Each key of a batch and the places of its rows."""
    if not n_keys:
        yield (), list(range(batch.num_rows))
        return
    places: dict[tuple, list[int]] = {}
    for place, key in enumerate(zip(*[batch.column(i).to_pylist() for i in range(n_keys)])):
        places.setdefault(key, []).append(place)
    yield from places.items()


def partial_states(rows: DataFrame, aggregate: Aggregate, columns, by=(), groups_in_memory: int = GROUPS_IN_MEMORY) -> DataFrame:
    """(*by, _part, _state): the states of each task's rows, ``_part`` is the task's number.

    A task keeps the states of a bounded number of groups and sends them on when there are more.
    """
    by, columns = list(by), list(columns)
    kinds = ", ".join(f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in by)

    def run(batches):
        states, keys, schema = {}, [], None
        part = TaskContext.get().partitionId()

        def flush():
            listed = list(states)
            out = [pa.array([key[i] for key in listed], schema.field(i).type) for i in range(len(by))]
            out += [pa.array([part] * len(listed), pa.int64()), pa.array([pickle.dumps(s) for s in states.values()], pa.binary())]
            states.clear()
            return pa.RecordBatch.from_arrays(out, [*by, "_part", "_state"])

        for batch in batches:
            schema = batch.schema
            frame = batch.select(range(len(by), batch.num_columns)).to_pandas()
            frame.columns = columns
            for key, places in _groups(batch, len(by)):
                state = states[key] if key in states else aggregate.zero()
                states[key] = aggregate.update(state, frame.iloc[places] if by else frame)
            if len(states) > groups_in_memory:
                yield flush()
        if states:
            yield flush()

    asked = rows.select(*by, *[F.col(name).alias(f"_column_{i}") for i, name in enumerate(columns)])
    return asked.mapInArrow(run, f"{kinds}{', ' if by else ''}_part long, _state binary")


def merged_states(partials: DataFrame, aggregate: Aggregate, by=(), fan: int = FAN) -> DataFrame:
    """One state per group: in every round the states of ``fan`` neighbouring parts become one.

    So a group that all tasks have, however many, is never merged by one task alone, and the
    rounds grow with the logarithm of the number of tasks.
    """
    by = list(by)

    def merge(table: pa.Table) -> pa.Table:
        state = reduce(aggregate.merge, map(pickle.loads, table.column("_state").to_pylist()))
        first = table.slice(0, 1)
        place = first.schema.get_field_index("_state")
        return first.set_column(place, first.schema.field(place), pa.array([pickle.dumps(state)], pa.binary()))

    partials = stage(partials, "states")
    parts = partials.agg(F.max("_part")).first()[0] or 0
    while True:
        numbered = partials.withColumn("_part", F.expr(f"_part div {int(fan)}"))
        partials = numbered.groupBy(*by, "_part").applyInArrow(merge, partials.schema)
        parts //= fan
        if not parts:
            return partials
        partials = stage(partials, "states")


def aggregate_rows(rows: DataFrame, aggregate: Aggregate, columns, by=(), fan: int = FAN, **options) -> DataFrame:
    """(*by, *result) of a caller's aggregate over ``columns``, one row per group of ``by``.

    Missing group values form a group. Without ``by`` there is one row, also of a table without rows.
    """
    partials = partial_states(rows, aggregate, columns, by, **options)
    if not by:
        empty = pickle.dumps(aggregate.zero())
        partials = partials.unionAll(rows.sparkSession.range(1).select(F.lit(0).cast("long"), F.lit(empty)))

    @F.pandas_udf(f"struct<{aggregate.result}>")
    def finished(states: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([aggregate.finish(pickle.loads(state)) for state in states])

    return merged_states(partials, aggregate, by, fan).select(*by, finished("_state").alias("_result")).select(*by, "_result.*")


def character_fscore() -> Aggregate:
    """Micro-averaged precision, recall and F1 over the characters that truth and guess share, repeats counted."""

    def update(state, frame):
        from collections import Counter

        common, guessed, true = state
        for truth, guess in zip(*[frame[name].fillna("") for name in frame.columns]):
            common += (Counter(truth) & Counter(guess)).total()
            guessed += len(guess)
            true += len(truth)
        return common, guessed, true

    def finish(state):
        common, guessed, true = state
        return {
            "precision": common / guessed if guessed else 0.0,
            "recall": common / true if true else 0.0,
            "f1": 2 * common / (guessed + true) if guessed + true else 0.0,
        }

    return Aggregate(
        lambda: (0, 0, 0), update, lambda a, b: tuple(x + y for x, y in zip(a, b)), finish, "precision double, recall double, f1 double"
    )
