"""Joins that lose no row for a missing key."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, names, how: str = "inner", small: bool = False) -> DataFrame:
    """Equi-join in which a missing key matches a missing key.

    ``small`` broadcasts the right side; the caller vouches for a bound on its size.
    """
    renamed = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in names])
    joined = left.join(F.broadcast(renamed) if small else renamed, same, how)
    return joined.drop(*[f"_right_{name}" for name in names])
