"""Per-sample flags and headline metrics of top-k predictions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_token, trim_ws

# Two ways the evaluators clean a prediction before they compare it.
NORMALIZERS = {"first_token": first_token, "strip": trim_ws}


def align_predictions(gold: DataFrame, predictions: DataFrame, k: int, key: str = "sample_id") -> DataFrame:
    """Give every gold row its predictions; a row without any gets ``k`` empty ones."""
    none = F.array_repeat(F.lit(""), k)
    return gold.join(predictions, key, "left").withColumn("predictions", F.coalesce(F.col("predictions"), none))


def in_top_k(predictions: Column, gold: Column, k: int) -> Column:
    """Is the gold name one of the first ``k`` predictions? A missing one is a miss."""
    return F.array_contains(F.array_compact(F.slice(predictions, 1, k)), gold)


def score_rows(rows: DataFrame, k: int = 5, normalize: str = "first_token") -> DataFrame:
    """Add ``top_prediction``, the match flags and the edit distance to each sample.

    A sample without predictions never matches in ``first_token`` mode; in ``strip``
    mode it counts as an empty prediction.
    """
    clean = NORMALIZERS[normalize]
    cleaned = F.transform(F.coalesce("predictions", F.array().cast("array<string>")), clean)
    scored = rows.withColumn("predictions", cleaned).withColumn(
        "top_prediction", F.coalesce(F.try_element_at("predictions", F.lit(1)), F.lit(""))
    )
    top, gold = F.col("top_prediction"), F.col("target")
    given = F.size("predictions") > 0 if normalize == "first_token" else F.lit(True)
    return scored.withColumns(
        {
            "exact_match": given & (top == gold),
            "exact_match_ci": given & (F.lower(top) == F.lower(gold)),
            "in_topk": in_top_k(F.col("predictions"), gold, k),
            "edit_distance": F.levenshtein(top, gold),
        }
    )


def share(flag: Column) -> Column:
    """Share of true rows, 0 without rows."""
    return F.coalesce(F.avg(flag.cast("double")), F.lit(0.0))


def headline_metrics(scored: DataFrame, k: int = 5, device: str = "cpu", batch_size: int = 8) -> DataFrame:
    """One row: sample count, match rates, top-k rate and mean edit distance.

    Samples whose batch failed count as misses; where ``failed`` tells which, they are also counted.
    """
    failed = [F.count_if("failed").alias("failed")] if "failed" in scored.columns else []
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        *failed,
        share(F.col("exact_match")).alias("exact_match"),
        share(F.col("exact_match_ci")).alias("exact_match_case_insensitive"),
        share(F.col("in_topk")).alias("topk_accuracy"),
        F.coalesce(F.avg("edit_distance"), F.lit(0.0)).alias("avg_levenshtein"),
    ).withColumns({"k": F.lit(k), "device": F.lit(device), "batch_size": F.lit(batch_size)})


def caller_metrics(scored: DataFrame, metrics: dict, by=()) -> DataFrame:
    """Sample counts and means of a caller's own scores, per group on demand.

    ``metrics`` maps a name to (function, columns). The function gets these columns of one
    Arrow batch as pandas Series and returns a number per row; sums are formed by
    Spark, so no group meets in one task. A missing score counts as 0. A metric that
    Spark can express needs no function: aggregate ``scored`` itself.
    """
    scores = {name: F.pandas_udf(function, "double")(*columns) for name, (function, columns) in metrics.items()}
    marked = scored.select(*by, *[column.alias(f"_{name}") for name, column in scores.items()])
    means = [F.avg(F.coalesce(F.col(f"_{name}"), F.lit(0.0))).alias(name) for name in metrics]
    return marked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *means)


def with_throughput(metrics: DataFrame, elapsed_seconds: float) -> DataFrame:
    """Add the wall-clock time of the job and the samples per second, 0 for no time."""
    speed = F.coalesce(F.try_divide(F.col("n").cast("double"), F.lit(float(elapsed_seconds))), F.lit(0.0))
    return metrics.withColumns(
        {"elapsed_time_seconds": F.lit(float(elapsed_seconds)), "samples_per_second": speed}
    )


def edit_distance_stats(distances: DataFrame, column: str = "edit_distance") -> DataFrame:
    """Minimum, maximum, mean, population deviation and interpolated median.

    The median counts equal distances together, and a distance is never longer than
    the longer of its two names, so the state stays small for any number of rows.
    """
    value = F.col(column)
    return distances.agg(
        *[
            F.coalesce(stat.cast("double"), F.lit(0.0)).alias(name)
            for name, stat in {
                "min": F.min(value),
                "max": F.max(value),
                "mean": F.avg(value),
                "std": F.stddev_pop(value),
                "median": F.percentile(value, F.lit(0.5)),
            }.items()
        ]
    )
