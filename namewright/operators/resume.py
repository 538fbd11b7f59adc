"""Inference that goes on where an earlier job stopped, by a ledger of answered samples."""

import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .inference import made_once

ROWS_PER_TASK = 10_000


class InferenceStopped(RuntimeError):
    """The model failed; what it answered before is in the ledger."""


def read_ledger(spark: SparkSession, folder: str, key_kind: str) -> DataFrame:
    """(key, predictions) of all answered samples, each once; empty before the first job.

    A task's answers are one file that appears whole when the task ends.
    """
    schema = f"key {key_kind}, predictions array<string>"
    try:
        rows = spark.read.schema(schema).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.filter("predictions is not null").groupBy("key").agg(F.first("predictions").alias("predictions"))


def ask(waiting: DataFrame, make_predict, batch_size: int, portion: int | None = None) -> DataFrame:
    """(key, predictions, error) of rows (key, prompt); at the first failure a portion ends with one row that tells it.

    A portion is ``portion`` neighbouring rows of a task, or all its rows. What was answered before the
    failure stays, what comes after it in the portion is not asked.
    """
    token = uuid.uuid4().hex
    kind = waiting.schema["key"].dataType.simpleString()

    def run(batches):
        predict, seen, resume = None, 0, 0  # rows met so far; the row from which on is asked
        for batch in batches:
            keys = batch.schema.field(0).type
            prompts = batch.column(1).to_pylist()
            start = 0
            while start < len(prompts):
                left = len(prompts) - start if portion is None else min(len(prompts) - start, portion - (seen + start) % portion)
                if seen + start < resume:
                    start += left
                    continue
                answers, failure = [], None
                for at in range(start, start + left, batch_size):
                    part = prompts[at : min(at + batch_size, start + left)]
                    try:
                        predict = predict or made_once(token, make_predict)
                        found = [list(answer) for answer in predict(part)]
                        if len(found) != len(part):
                            raise ValueError(f"{len(found)} answers for {len(part)} prompts")
                    except Exception as error:
                        failure = f"{type(error).__name__}: {error}"
                        break
                    answers += found
                told = [batch.column(0).slice(start, len(answers)), pa.array(answers, pa.list_(pa.string())), pa.nulls(len(answers), pa.string())]
                yield pa.RecordBatch.from_arrays(told, ["key", "predictions", "error"])
                if failure:
                    row = [pa.nulls(1, keys), pa.nulls(1, pa.list_(pa.string())), pa.array([failure])]
                    yield pa.RecordBatch.from_arrays(row, ["key", "predictions", "error"])
                    if portion is None:
                        return
                    resume = ((seen + start) // portion + 1) * portion
                start += left
            seen += len(prompts)

    return waiting.mapInArrow(run, f"key {kind}, predictions array<string>, error string")


def task_rows(spark: SparkSession, n_waiting: int, rows_per_task: int) -> int:
    """How many rows a Spark task takes: several portions of ``rows_per_task`` where these would be more tasks than pay off.

    Tasks that take more than ``ROWS_PER_TASK`` rows are never made for that, so a job that dies loses no more.
    """
    enough = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(rows_per_task, min(ROWS_PER_TASK, -(-n_waiting // enough)))


def resumed_inference(
    rows: DataFrame, prompt: Column, make_predict, folder: str, key: str = "sample_id", batch_size: int = 16,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``predictions`` to rows with unique keys, asking the model only for samples without an answer in ``folder``.

    Every task commits its answers by itself when it ends (the committer's second algorithm), so a job
    whose driver or executors die loses the running tasks alone. A model that raises ends its task, not the
    others; their answers are kept, and then ``InferenceStopped`` tells the error. Called again
    with the same folder the job goes on. Rows without a key are never asked and get no answer.
    Where ``rows_per_task`` would make very many tasks, a task takes several portions of so many rows;
    then a model that raises ends its portion.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    asked = rows.select(F.col(key).alias("key"), prompt.alias("prompt")).filter("key is not null")
    waiting = asked.join(read_ledger(spark, folder, kind).select("key"), "key", "left_anti")
    n_waiting = waiting.count()
    if n_waiting:
        taken = task_rows(spark, n_waiting, rows_per_task)
        tasks, portion = -(-n_waiting // taken), rows_per_task if taken > rows_per_task else None
        before = _failures(spark, folder, kind)
        (
            ask(waiting.repartition(tasks, "key"), make_predict, batch_size, portion)
            .withColumn("run", F.lit(uuid.uuid4().hex))
            .write.mode("append")
            .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
            .parquet(folder)
        )
        failures = _failures(spark, folder, kind)
        if failures["n"] > before["n"]:
            raise InferenceStopped(f"{failures['n'] - before['n']} tasks stopped, one at {failures['error']}")
    answers = read_ledger(spark, folder, kind).withColumnRenamed("key", "_key")
    return rows.join(answers, F.col(key) == F.col("_key"), "left").drop("_key")


def _failures(spark: SparkSession, folder: str, kind: str) -> dict:
    """How many tasks of all jobs on a ledger were stopped by the model, and one of their errors."""
    try:
        rows = spark.read.schema(f"key {kind}, error string, run string").parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {"n": 0, "error": None}
    told = rows.filter("error is not null")
    return told.agg(F.count("*").alias("n"), F.any_value("error").alias("error")).first().asDict()
