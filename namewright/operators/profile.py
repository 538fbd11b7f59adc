"""Profiles and accounts of datasets."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Split names as stored and as published.
SPLITS = ("train", "valid", "test")
PUBLISHED_NAMES = {"train": "train", "valid": "validation", "test": "test"}


def _constant_rows(spark: SparkSession, columns, rows) -> DataFrame:
    """A few fixed rows, made in the JVM."""
    structs = [F.struct(*[F.lit(value).alias(name) for name, value in zip(columns, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def split_stats(examples: DataFrame) -> DataFrame:
    """Rows and different repositories per split."""
    return examples.groupBy("split").agg(
        F.count(F.lit(1)).alias("count"), F.countDistinct("repo").alias("repos")
    )


def language_histogram(examples: DataFrame) -> DataFrame:
    """Rows per split and language."""
    return examples.groupBy("split", "language").agg(F.count(F.lit(1)).alias("count"))


def dataset_totals(examples: DataFrame) -> DataFrame:
    """Rows, share in percent and repositories per split, and an ``(all)`` row."""
    counted = examples.rollup("split").agg(
        F.grouping("split").alias("_level"),
        F.count(F.lit(1)).alias("count"),
        F.countDistinct("repo").alias("repos"),
    )
    # The total is the rollup's own top row; this window sees one row per split.
    total = F.max(F.when(F.col("_level") == 1, F.col("count"))).over(Window.partitionBy(F.lit(0)))
    share = F.try_divide(F.col("count").cast("double"), total) * 100
    return counted.select(
        F.when(F.col("_level") == 1, F.lit("(all)")).otherwise(F.col("split")).alias("split"),
        "count",
        "repos",
        F.round(share, 1).alias("percent"),
    )


def label_profile(examples: DataFrame) -> DataFrame:
    """Rows and different labels per split."""
    return examples.groupBy("split").agg(
        F.count(F.lit(1)).alias("count"), F.countDistinct("target").alias("labels")
    )


def top_labels(examples: DataFrame, order, n: int = 5) -> DataFrame:
    """The most common labels; equally common ones in the order they are first seen."""
    order = list(order)
    first = F.min(F.col(order[0]) if len(order) == 1 else F.struct(*order)).alias("_first")
    return (
        examples.groupBy("target")
        .agg(F.count(F.lit(1)).alias("count"), first)
        .orderBy(F.desc("count"), "_first")
        .limit(n)
        .drop("_first")
    )


def missing_splits(examples: DataFrame) -> DataFrame:
    """Required splits that have no row."""
    required = _constant_rows(examples.sparkSession, ["split"], [(name,) for name in SPLITS])
    return required.join(examples.select("split").distinct(), "split", "left_anti")


def rename_splits(examples: DataFrame, to_published: bool, splits=None) -> DataFrame:
    """Translate the split names; absent and unselected splits give no rows.

    ``splits`` selects by the name in the input.
    """
    pairs = [(name, PUBLISHED_NAMES[name]) for name in SPLITS]
    if not to_published:
        pairs = [(published, name) for name, published in pairs]
    if splits:
        pairs = [pair for pair in pairs if pair[0] in splits]
    names = _constant_rows(examples.sparkSession, ["split", "_renamed"], pairs)
    return examples.join(F.broadcast(names), "split").withColumn("split", F.col("_renamed")).drop("_renamed")


def repo_accounts(examples: DataFrame) -> DataFrame:
    """Files with examples and examples per repository and language."""
    return examples.groupBy("repo", "language").agg(
        F.countDistinct("path").alias("files"), F.count(F.lit(1)).alias("examples")
    )


def language_accounts(examples: DataFrame, first: DataFrame, ingest: DataFrame | None = None) -> DataFrame:
    """Examples before and after de-duplication per language, with the repositories read.

    ``first`` has one row per kept example. ``ingest`` has ``repo_ord``, ``language``
    and ``ok`` per listed repository.
    """
    before = examples.groupBy("language").agg(F.count(F.lit(1)).alias("examples"))
    after = first.groupBy("language").agg(F.count(F.lit(1)).alias("unique_examples"))
    accounts = before.join(after, "language", "left")
    if ingest is not None:
        repos = ingest.groupBy("language").agg(
            F.count_if("ok").alias("repos_ok"), F.count_if(~F.col("ok")).alias("repos_failed")
        )
        accounts = repos.join(accounts, "language", "left").fillna(0)
    return accounts
