"""Seeded order, exact splits and row numbers without a one-task window."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import join_on

# Rows that a bucket should hold, and the hex digits up to which bucket counts are broadcast (65,536 rows).
BUCKET_ROWS = 100_000
BROADCAST_DIGITS = 4


def bucket_digits(rows: int, least: int = 3) -> int:
    """Leading hex digits by which a seeded order is cut, so that buckets stay small at any number of rows."""
    digits = least
    while rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def seeded_hash(key: Column, seed: int = 42) -> Column:
    """The sort key of a seeded shuffle: same seed and key, same place."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(key.cast("string"), F.lit(""))))


def _with_bucket(rows: DataFrame, key: str, seed: int, digits: int) -> DataFrame:
    """Add the row's hash and the bucket its leading hex digits name."""
    return rows.withColumn("_hash", seeded_hash(F.col(key), seed)).withColumn("_bucket", F.left("_hash", F.lit(digits)))


def _bucket_offsets(keyed: DataFrame, groups) -> DataFrame:
    """Rows per bucket, rows before the bucket, and rows of the whole group."""
    per_group = Window.partitionBy(*groups)
    counts = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_count"))
    return counts.select(
        *groups,
        "_bucket",
        "_count",
        (F.sum("_count").over(per_group.orderBy("_bucket")) - F.col("_count")).alias("_before"),
        F.sum("_count").over(per_group).alias("_total"),
    )


def _bucketed_rank(keyed: DataFrame, groups, order: str, bounded: bool) -> DataFrame:
    """``rank`` from 1 by ``order``, where ``_bucket`` rises with ``order``.

    ``bounded`` says that there are so few buckets that their counts may be broadcast.
    """
    offsets = _bucket_offsets(keyed, groups).select(*groups, "_bucket", "_before")
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy(order)
    return (
        join_on(keyed, offsets, [*groups, "_bucket"], small=bounded)
        .withColumn("rank", F.col("_before") + F.row_number().over(in_bucket))
        .drop("_before", "_bucket")
    )


def seeded_rank(rows: DataFrame, key: str, seed: int = 42, digits: int | None = None) -> DataFrame:
    """Add ``rank``, the row's place in the seeded order; keys must be unique.

    The leading hex digits of the hash form even buckets, each numbered on its own; only
    their counts are summed up. Without ``digits`` the rows are counted first.
    """
    digits = digits or bucket_digits(rows.count())
    keyed = _with_bucket(rows, key, seed, digits).withColumn("_all", F.length("_hash"))
    return _bucketed_rank(keyed, ["_all"], "_hash", bounded=digits <= BROADCAST_DIGITS).drop("_hash", "_all")


def position_rank(rows: DataFrame, position: str, within, width: int = 65536) -> DataFrame:
    """Number rows from 1 per group by a whole-number position, unique in its group.

    A group of any size is cut into ranges of ``width`` positions.
    """
    keyed = rows.withColumn("_bucket", F.expr(f"`{position}` div {int(width)}"))
    return _bucketed_rank(keyed, list(within), position, bounded=False)


def with_batch(ranked: DataFrame, batch_size: int) -> DataFrame:
    """Number the batches from 0; only the last one may be short."""
    return ranked.withColumn("batch_id", F.expr(f"(rank - 1) div {int(batch_size)}"))


def assign_split(
    rows: DataFrame,
    key: str,
    train: float = 0.8,
    valid: float = 0.1,
    seed: int = 42,
    within=("language",),
    digits: int | None = None,
) -> DataFrame:
    """Add ``split`` with exact sizes: both ratios truncate, test takes the rest.

    Keys must be unique in their group. Only the two cut points of the seeded order
    are looked up: bucket counts find the bucket each cut falls into, those buckets
    alone are numbered, and every row is compared with the two cut hashes. So no row
    is shuffled but the few in the cut buckets. The cuts, one row per group, are
    broadcast if there is one group; else Spark decides by their size.
    ``rows`` is read up to four times, so it should be a narrow stored table; without
    ``digits`` it is counted first.
    """
    groups = list(within) or ["_all"]
    few = not within
    digits = digits or bucket_digits(rows.count())
    keyed = _with_bucket(rows, key, seed, digits)
    if not within:
        keyed = keyed.withColumn("_all", F.length("_hash"))  # one group: all hashes are as long
    n_train = F.floor(F.col("_total") * F.lit(train).cast("double"))
    n_valid = F.floor(F.col("_total") * F.lit(valid).cast("double"))
    offsets = (
        _bucket_offsets(keyed.select(*groups, "_bucket"), groups)
        .withColumn("_cut_train", n_train - F.col("_before"))
        .withColumn("_cut_valid", n_train + n_valid - F.col("_before"))
    )
    edges = offsets.filter(
        F.col("_cut_train").between(1, F.col("_count")) | F.col("_cut_valid").between(1, F.col("_count"))
    ).select(*groups, "_bucket", "_cut_train", "_cut_valid")
    in_bucket = Window.partitionBy(*groups, "_bucket").orderBy("_hash")
    numbered = join_on(
        keyed.select(*groups, "_bucket", "_hash"), edges, [*groups, "_bucket"], small=few
    ).withColumn("_row", F.row_number().over(in_bucket))
    cuts = numbered.groupBy(*groups).agg(
        F.max(F.when(F.col("_row") == F.col("_cut_train"), F.col("_hash"))).alias("_last_train"),
        F.max(F.when(F.col("_row") == F.col("_cut_valid"), F.col("_hash"))).alias("_last_valid"),
    )
    split = (
        F.when(F.col("_hash") <= F.col("_last_train"), "train")
        .when(F.col("_hash") <= F.col("_last_valid"), "valid")
        .otherwise("test")
    )
    return (
        join_on(keyed, cuts, groups, "left", small=few)
        .withColumn("split", split)
        .drop("_hash", "_bucket", "_last_train", "_last_valid", "_all")
    )
