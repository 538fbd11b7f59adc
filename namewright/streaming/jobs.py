"""Streaming jobs over append-only logs and arriving predictions.

Nothing here has an event-time rule: the logs are followed as they grow, and the
aggregates keep one row per run, or one row in all.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.runs import checkpoint_summary
from ..operators.scoring import share
from ..sources.logs import error_lines, parse_run_log, run_of_file, training_log_rows
from .tail import follow_lines

# Take all that has come so far, then stop; ``{"processingTime": "10 seconds"}`` goes on.
ALL_SO_FAR = {"availableNow": True}


def follow_training_log(spark: SparkSession, path: str, layouts: list[list[str]], **options) -> DataFrame:
    """A stream of long rows from the training logs below ``path``, also from lines appended later.

    ``options`` are those of the line source, such as ``bytesPerTrigger`` and ``untilNow``.
    """
    lines = follow_lines(spark, path, **options).select(run_of_file(F.col("path")).alias("run"), "value")
    return training_log_rows(lines, layouts)


def best_so_far(log: DataFrame) -> DataFrame:
    """Running best evaluation per run; the same aggregate as for a batch."""
    return checkpoint_summary(log)


def follow_errors(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the run-log lines that speak of an error, also of lines appended later."""
    return error_lines(parse_run_log(follow_lines(spark, path).select("value")))


def running_scores(scored: DataFrame) -> DataFrame:
    """Running sums and rates over all scored samples so far."""
    flags = {"em": "exact_match", "em_ci": "exact_match_ci", "topk": "in_topk"}
    counters = [F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0)).alias(name) for name, flag in flags.items()]
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        *counters,
        F.coalesce(F.sum("edit_distance"), F.lit(0)).alias("lev_sum"),
        share(F.col("exact_match")).alias("exact_match"),
    )


def append_log_events(log: DataFrame, path: str, checkpoint: str, trigger=ALL_SO_FAR):
    """Write each arriving log event to a table, once even after a restart."""
    return (
        log.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .format("parquet")
        .start(path)
    )


def append_bounded(log: DataFrame, path: str, checkpoint: str):
    """Write all log events of a stream with ``bytesPerTrigger`` and ``untilNow`` to a table, batch by batch, then stop.

    Returns the stopped query. What was appended meanwhile is left to the next call, which goes on at the checkpoint.
    """
    query = append_log_events(log, path, checkpoint, {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def on_log_events(log: DataFrame, callback, checkpoint: str, trigger=ALL_SO_FAR):
    """Call ``callback(rows, batch_id)`` with the DataFrame of each batch of events."""
    return (
        log.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(callback)
        .start()
    )


def keep_latest(aggregate: DataFrame, path: str, checkpoint: str, trigger=ALL_SO_FAR):
    """Write the whole result of a running aggregate anew after each batch.

    Two folders take turns, so the result before stays readable while the next is written,
    a batch that is run again after a failure replaces its own output only, and no more than
    two results are kept; ``read_latest`` takes the newest. An empty result stands there
    before any data has come.
    """
    empty = aggregate.withColumn("_batch", F.lit(-1).cast("bigint")).schema
    aggregate.sparkSession.createDataFrame([], empty).write.mode("ignore").parquet(f"{path}/_turn=-1")

    def save(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        numbered.write.mode("overwrite").parquet(f"{path}/_turn={batch_id % 2}")

    return (
        aggregate.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(save)
        .start()
    )


def read_latest(spark: SparkSession, path: str, schema) -> DataFrame:
    """The result of the last finished batch of ``keep_latest``."""
    numbered = T.StructType([*schema.fields, T.StructField("_batch", T.LongType()), T.StructField("_turn", T.IntegerType())])
    rows = spark.read.schema(numbered).parquet(path)
    newest = rows.agg(F.max("_batch").alias("_batch"))
    return rows.join(F.broadcast(newest), "_batch", "left_semi").drop("_batch", "_turn")
