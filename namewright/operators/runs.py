"""Training runs, their checkpoints, metrics and artifacts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def checkpoint_summary(log: DataFrame, metric: str = "eval_loss") -> DataFrame:
    """Per run: step and value of the best evaluation, and the final step.

    Of equal values the earliest step wins. Works on a batch and on a stream.
    """
    evaluated = F.col("metric") == metric
    best = F.min(F.when(evaluated, F.struct("value", "step")))
    return (
        log.groupBy("run")
        .agg(best.alias("_best"), F.max("step").alias("final_step"))
        .select("run", F.col("_best.step").alias("best_step"), F.col("_best.value").alias("best_value"), "final_step")
    )


def latest_checkpoint(artifacts: DataFrame) -> DataFrame:
    """The checkpoint with the highest step of each run."""
    return artifacts.groupBy("run").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))


def with_checkpoint_step(artifacts: DataFrame) -> DataFrame:
    """Checkpoint folders only, with the step their name ends in."""
    step = F.regexp_extract("path", r"(?:\A|/)checkpoint-([0-9]+)/?\z", 1)
    return artifacts.filter(step != "").withColumn("step", step.cast("bigint"))


def keep_newest(checkpoints: DataFrame, n: int = 2) -> DataFrame:
    """The newest ``n`` checkpoints of each run."""
    newest = Window.partitionBy("run").orderBy(F.desc("step"))
    return checkpoints.withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= n).drop("age")


def first_available(candidates: DataFrame) -> DataFrame:
    """The existing candidate of the highest priority (lowest number) per run."""
    return (
        candidates.filter(F.col("available"))
        .groupBy("run")
        .agg(F.min_by("path", "priority").alias("path"), F.min("priority").alias("priority"))
    )


def artifact_listing(files: DataFrame) -> DataFrame:
    """Files by folder, both in alphabetic order; files without a folder are in ``root``."""
    path = F.col("path")
    nested = path.contains("/")
    folder = F.when(nested, F.regexp_extract(path, r"(?s)\A(.*)/", 1)).otherwise(F.lit("root"))
    name = F.when(nested, F.substring_index(path, "/", -1)).otherwise(path)
    return files.select(folder.alias("folder"), name.alias("name")).orderBy("folder", "name")
