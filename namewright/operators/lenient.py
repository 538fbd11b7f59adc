"""The lenient test report: names are compared stripped and lower-cased."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_unknown, trim_ws


def lenient(name: Column) -> Column:
    """The form in which the test report compares names."""
    return F.lower(trim_ws(name))


def compare_leniently(predictions: DataFrame) -> DataFrame:
    """Add ``truth``, ``guess``, ``hit`` and ``edit_distance`` once for all statistics.

    A missing prediction counts as an empty one, so that no rate leaves its row out.
    """
    predicted = F.coalesce(F.col("predicted"), F.lit(""))
    return predictions.withColumns(
        {
            "truth": lenient(F.col("target")),
            "guess": lenient(predicted),
            "edit_distance": F.levenshtein(trim_ws(F.col("target")), trim_ws(predicted)),
        }
    ).withColumn("hit", F.col("truth") == F.col("guess"))


def lenient_topk(compared: DataFrame, order: str, k: int = 5) -> Column:
    """Aggregate: share of rows whose truth is among the lower-cased top ``k``.

    Zero unless the first row in order has a list at all; a missing list is a miss.
    """
    if "topk_predictions" not in compared.columns:
        return F.lit(0.0)
    found = F.exists(F.slice("topk_predictions", 1, k), lambda name: F.lower(name) == F.col("truth"))
    rate = F.avg(F.coalesce(found, F.lit(False)).cast("double"))
    first_has = F.min_by(F.col("topk_predictions").isNotNull(), F.col(order))
    return F.when(first_has, rate).otherwise(F.lit(0.0))


def report_metrics(compared: DataFrame, order: str, k: int = 5) -> DataFrame:
    """One row of the report's scalar metrics; the rates of no rows at all are NULL.

    The exact match of this report already ignores case, so both rates are equal.
    """
    hit = F.avg(F.col("hit").cast("double"))
    return compared.agg(
        F.count(F.lit(1)).alias("n"),
        hit.alias("exact_match"),
        hit.alias("exact_match_case_insensitive"),
        lenient_topk(compared, order, k).alias("topk_accuracy"),
        F.avg("edit_distance").alias("avg_edit_distance"),
        F.avg(F.length("predicted")).alias("avg_prediction_length"),
        F.avg(F.length("target")).alias("avg_target_length"),
        F.coalesce(F.sum(F.col("hit").cast("bigint")), F.lit(0)).alias("correct_predictions"),
    ).withColumn("k", F.lit(k))


def class_distribution(compared: DataFrame, approximate: bool = False) -> DataFrame:
    """How many different names occur as truth or guess."""
    names = compared.select(F.explode(F.array("truth", "guess")).alias("name"))
    counted = F.approx_count_distinct("name") if approximate else F.countDistinct("name")
    return names.agg(counted.alias("class_distribution"))


def language_stats(compared: DataFrame, overall: bool = False) -> DataFrame:
    """Total, correct and accuracy per language, with an ``(all)`` row on demand."""
    named = compared.withColumn("language", or_unknown(F.col("language")))
    grouped = named.rollup("language") if overall else named.groupBy("language")
    keys = [F.grouping("language").alias("_level")] if overall else []
    stats = grouped.agg(
        *keys,
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("hit").cast("bigint")).alias("correct"),
        F.avg(F.col("hit").cast("double")).alias("accuracy"),
    )
    if overall:
        name = F.when(F.col("_level") == 1, F.lit("(all)")).otherwise(F.col("language"))
        stats = stats.filter((F.col("total") > 0)).withColumn("language", name).drop("_level")
    return stats.withColumns({"correct_ci": F.col("correct"), "accuracy_ci": F.col("accuracy")})
