"""Small helpers the corpus operators share."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# The characters that count as white space between words.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


def whole_text(text: str = "text") -> Column:
    """The text, with a missing one as the empty string."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def without_blanks(text: Column) -> Column:
    """Delete all white space; six byte searches instead of a pattern."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def as_map(value: Column, function) -> Column:
    """``function`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def two_hashes(value: Column) -> list[Column]:
    """128 bits that name a value; two different values share them with odds of 2**-128."""
    return [F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")]


def range_ranked(rows: DataFrame, group: str, order, name: str, rank: str = "rank") -> DataFrame:
    """Store ``rows`` sorted by group and order and number them from 0 within each group.

    The table is dealt out by ranges of (group, order), so a group that holds a third of
    all rows spreads over many tasks. Row numbers are the places within a task; what
    lies before a task comes from one count per task and group.
    """
    sorted_rows = stage(
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumn("_place", F.monotonically_increasing_id()),
        name,
    )
    task = F.shiftright("_place", 33)
    parts = sorted_rows.groupBy(group, task.alias("_task")).agg(
        F.min("_place").alias("_first"), F.count("*").alias("_count")
    )
    before = Window.partitionBy(group).orderBy("_task")
    starts = parts.select(
        F.col(group).alias("_group"),
        "_task",
        (F.sum("_count").over(before) - F.col("_count") - F.col("_first")).alias("_shift"),
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (task == F.col("_task"))
    return (
        sorted_rows.join(starts, same)
        .withColumn(rank, F.col("_place") + F.col("_shift"))
        .drop("_place", "_shift", "_group", "_task")
    )
