"""Precision, recall and F1 per label and over all labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(part: Column, whole: Column) -> Column:
    """A share that is 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def label_counts(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """Support, predictions and true positives per label, in one shuffle, without a join."""
    hit = (F.col(truth) == F.col(guess)).cast("bigint")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col(truth).alias("label"), one.alias("support"), zero.alias("predicted"), hit.alias("tp")),
        F.struct(F.col(guess).alias("label"), zero.alias("support"), one.alias("predicted"), zero.alias("tp")),
    )
    return (
        pairs.select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    )


def label_scores(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of every label in truth or guess."""
    return label_counts(pairs, truth, guess).select(
        "label",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "tp",
    )


def _weighted(metric: str) -> Column:
    return _ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))


def weighted_scores(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """Accuracy and the support-weighted scores in one row; all 0 without rows."""
    return label_scores(pairs, truth, guess).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("precision"),
        _weighted("recall").alias("recall"),
        _weighted("f1_score").alias("f1_score"),
    )


def classification_report(pairs: DataFrame, truth: str, guess: str) -> DataFrame:
    """The label rows, then accuracy, macro average and weighted average.

    ``kind`` tells a summary row from a label of the same name. Accuracy stands in
    the F1 column alone.
    """
    scores = label_scores(pairs, truth, guess)
    labels = scores.select(F.lit("label").alias("kind"), F.col("label").cast("string").alias("label"), *_COLUMNS)
    totals = scores.agg(
        F.coalesce(F.sum("support"), F.lit(0)).alias("support"),
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.coalesce(F.avg(name), F.lit(0.0)).alias(f"macro_{name}") for name in _COLUMNS[:3]],
        *[_weighted(name).alias(f"weighted_{name}") for name in _COLUMNS[:3]],
    )
    missing = F.lit(None).cast("double")
    rows = F.array(
        _summary("accuracy", [missing, missing, F.col("accuracy")]),
        _summary("macro avg", [F.col(f"macro_{name}") for name in _COLUMNS[:3]]),
        _summary("weighted avg", [F.col(f"weighted_{name}") for name in _COLUMNS[:3]]),
    )
    return labels.unionByName(totals.select(F.inline(rows)))


_COLUMNS = ["precision", "recall", "f1_score", "support"]


def _summary(name: str, values: list[Column]) -> Column:
    named = [value.alias(column) for column, value in zip(_COLUMNS, [*values, F.col("support")])]
    return F.struct(F.lit("summary").alias("kind"), F.lit(name).alias("label"), *named)
