"""Writers of detailed results, metrics and test summaries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.examples import without_large_fields


def write_results(rows: DataFrame, path: str) -> None:
    """JSON Lines, one line per sample, without the token arrays."""
    without_large_fields(rows).write.json(path)


def write_metrics(metrics: DataFrame, path: str, run: str) -> None:
    """Store a run's metrics under the last part of its path, in place of older ones."""
    name = run.rstrip("/").rsplit("/", 1)[-1]
    (
        metrics.withColumn("run", F.lit(name))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run")
        .parquet(path)
    )


def summary_row(
    metrics: DataFrame, scores: DataFrame, distances: DataFrame, classes: DataFrame, timestamp: str, **job
) -> DataFrame:
    """The nested one-row summary of a test from its one-row parts.

    ``job`` gives the constants ``model_path``, ``test_data_path``, ``device``,
    ``batch_size`` and ``elapsed_time_seconds``.
    """
    parts = None
    for one_row in (metrics, scores, distances, classes):
        keyed = one_row.withColumn("_row", F.lit(1))
        parts = keyed if parts is None else parts.join(F.broadcast(keyed), "_row")
    elapsed = F.lit(float(job["elapsed_time_seconds"]))
    speed = F.coalesce(F.try_divide(F.col("n").cast("double"), elapsed), F.lit(0.0))
    return parts.select(
        F.lit(timestamp).alias("timestamp"),
        F.lit(job["model_path"]).alias("model_path"),
        F.lit(job["test_data_path"]).alias("test_data_path"),
        F.struct(
            "n",
            "exact_match",
            "exact_match_case_insensitive",
            "topk_accuracy",
            "avg_edit_distance",
            "k",
            F.lit(job["device"]).alias("device"),
            F.lit(job["batch_size"]).alias("batch_size"),
            elapsed.alias("elapsed_time_seconds"),
            speed.alias("samples_per_second"),
        ).alias("performance_metrics"),
        F.struct(
            F.col("accuracy").alias("sklearn_accuracy"),
            "precision",
            "recall",
            "f1_score",
            "avg_prediction_length",
            "avg_target_length",
            "correct_predictions",
            "class_distribution",
        ).alias("traditional_metrics"),
        F.struct("min", "max", "mean", "std", "median").alias("edit_distance_stats"),
    )


def run_timestamp(spark: SparkSession) -> str:
    """The current time as used in result names."""
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss"))
    return now.first()[0]


def write_summary(summary: DataFrame, tables: dict[str, DataFrame], path: str, timestamp: str) -> str:
    """Write a test's summary and its long tables under a time-stamped folder.

    The per-language and per-label results are tables, not maps in the summary, as
    their number grows with the data.
    """
    folder = f"{path.rstrip('/')}/test_{timestamp}"
    summary.write.json(f"{folder}/summary")
    for name, table in tables.items():
        without_large_fields(table).write.json(f"{folder}/{name}")
    return folder
