"""Keep the first of equal rows without moving the text for it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_on


def first_of_copies(rows: DataFrame, key: str, order, within=("language",), carry=()) -> DataFrame:
    """One narrow row per group and key, with the order columns of its first copy.

    Copies are reduced on the map side, so a key that fills a third of the table
    reaches the shuffle once per task. Small columns to ``carry`` along follow the
    unique order in the minimum, where they cannot change it.
    """
    columns = [*order, *carry]
    smallest = F.min(F.col(columns[0]) if len(columns) == 1 else F.struct(*columns)).alias("_first")
    first = rows.groupBy(*within, key).agg(smallest)
    if len(columns) == 1:
        return first.withColumnRenamed("_first", columns[0])
    return first.select(*within, key, "_first.*")


def join_first(rows: DataFrame, first: DataFrame, key: str, order, within=("language",), how="left_semi") -> DataFrame:
    """Join rows to their narrow counterparts on group, key and order.

    The order columns make every row's join key its own, so copies spread evenly.
    Missing values match each other, so no row is lost for a missing group or order.
    """
    return join_on(rows, first, [*within, key, *order], how)


def keep_first(rows: DataFrame, key: str, order, within=("language",)) -> DataFrame:
    """Drop all but the first row of each group and key; ``order`` must be unique there."""
    return join_first(rows, first_of_copies(rows, key, order, within), key, order, within)
