"""From generated beams to prediction lists."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import ordered_distinct
from .scoring import share


def rank_beams(beams: DataFrame, k: int, key: str = "sample_id", order: str = "beam") -> DataFrame:
    """Number the first ``k`` beams of each sample from 1; no later one is ever used.

    Spark applies the limit before the shuffle, so a sample with very many rows
    sends at most ``k`` per task.
    """
    ranked = beams.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(order)))
    return ranked.filter(F.col("rank") <= k)


def group_beams(beams: DataFrame, k: int, key: str = "sample_id", rank: str = "beam", text: str = "text") -> DataFrame:
    """One ordered list of at most ``k`` texts per sample from ranks 1 to ``k``.

    There is one slot per rank, so the state of a sample is bounded even if its rows
    come more than once.
    """
    slots = [F.min(F.when(F.col(rank) == place, F.col(text))).alias(f"_{place}") for place in range(1, k + 1)]
    listed = F.array_compact(F.array(*[F.col(f"_{place}") for place in range(1, k + 1)]))
    return (
        beams.filter(F.col(rank).between(1, k)).groupBy(key).agg(*slots).select(key, listed.alias("predictions"))
    )


def unique_predictions(rows: DataFrame, k: int, drop_empty: bool = False) -> DataFrame:
    """The first ``k`` different predictions of each sample."""
    return rows.withColumn("predictions", ordered_distinct(F.col("predictions"), k, drop_empty))


def attach_predictions(rows: DataFrame) -> DataFrame:
    """Add the best prediction and whether it is the target."""
    best = F.coalesce(F.try_element_at("predictions", F.lit(1)), F.lit(""))
    return rows.withColumn("predicted_name", best).withColumn(
        "correct", F.coalesce(F.col("target"), F.lit("")) == F.col("predicted_name")
    )


def batch_accuracy(predicted: DataFrame) -> DataFrame:
    """Examples, correct ones and accuracy, 0 for none."""
    return predicted.agg(
        F.count(F.lit(1)).alias("total"),
        F.coalesce(F.sum(F.col("correct").cast("bigint")), F.lit(0)).alias("correct"),
        share(F.col("correct")).alias("accuracy"),
    )


def best_and_alternatives(rows: DataFrame) -> DataFrame:
    """The best prediction and the others on one line."""
    others = F.array_join(F.slice("predictions", 2, F.greatest(F.size("predictions"), F.lit(1))), ", ")
    return rows.withColumn(
        "best", F.coalesce(F.try_element_at("predictions", F.lit(1)), F.lit(""))
    ).withColumn("alts", others)
