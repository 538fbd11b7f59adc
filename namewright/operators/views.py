"""Metrics and samples prepared for reading."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed, percent


def metrics_display(metrics: DataFrame) -> DataFrame:
    """Each metrics row as ``(place, label, value)`` rows of text.

    Time and speed appear only where they were measured.
    """
    lines = [
        (F.lit("Exact Match"), percent(F.coalesce("exact_match", F.lit(0.0)))),
        (F.lit("Case-Insensitive Match"), percent(F.coalesce("exact_match_case_insensitive", F.lit(0.0)))),
        (F.concat(F.lit("Top-"), F.col("k").cast("string"), F.lit(" Accuracy")),
         percent(F.coalesce("topk_accuracy", F.lit(0.0)))),
        (F.lit("Avg Levenshtein Distance"), fixed(F.coalesce("avg_levenshtein", F.lit(0.0)), 2)),
        (F.lit("Samples Evaluated"), F.format_number("n", 0)),
    ]
    if "elapsed_time_seconds" in metrics.columns:
        minutes = fixed(F.col("elapsed_time_seconds") / 60, 1)
        lines.append((F.lit("Evaluation Time"), F.concat(minutes, F.lit(" minutes"))))
        lines.append((F.lit("Speed"), F.concat(fixed(F.col("samples_per_second"), 2), F.lit(" samples/sec"))))
    rows = F.array(
        *[
            F.struct(F.lit(place).alias("place"), label.alias("label"), value.alias("value"))
            for place, (label, value) in enumerate(lines, 1)
        ]
    )
    return metrics.select(F.inline(rows)).filter(F.col("value").isNotNull())


def sample_view(results: DataFrame, order, n: int = 10) -> DataFrame:
    """The first ``n`` detailed results with up to five predictions on one line."""
    return (
        results.orderBy(*order)
        .limit(n)
        .select(
            *order,
            "target",
            F.array_join(F.slice("predictions", 1, 5), ", ").alias("predictions"),
            "exact_match",
            "in_topk",
            F.size("predictions").alias("k"),
        )
    )
