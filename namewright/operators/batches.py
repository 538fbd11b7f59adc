"""Training arrays: truncation, label masks, batches and padding."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arrays import IGNORED, attention_mask, mask_prompt, pad_right, truncate
from ..session import stage
from .joins import join_on
from .ranking import seeded_rank, with_batch


def causal_labels(encoded: DataFrame, max_length: int | None = None) -> DataFrame:
    """Derive ``labels`` that ignore the prompt, from ids truncated if a length is given.

    The prompt is truncated by the same length before it is measured.
    """
    if max_length is not None:
        encoded = encoded.withColumns(
            {
                "input_ids": truncate(F.col("input_ids"), max_length),
                "prompt_len": F.least(F.col("prompt_len"), F.lit(max_length)).cast("int"),
            }
        )
    return encoded.withColumn("labels", mask_prompt(F.col("input_ids"), F.col("prompt_len")))


def seq2seq_pair(encoded: DataFrame, max_source: int = 1024, max_target: int = 32) -> DataFrame:
    """Prompt ids become ``input_ids``, target ids become ``labels``."""
    return (
        encoded.withColumn("input_ids", truncate(F.col("prompt_ids"), max_source))
        .withColumn("labels", truncate(F.col("target_ids"), max_target))
        .drop("prompt_ids", "target_ids")
    )


def form_batches(encoded: DataFrame, key: str, batch_size: int, seed: int = 42) -> DataFrame:
    """Add ``rank``, ``batch_id`` and ``longest``, the most ids of a row of the batch, in the seeded order.

    The rows are stored once with their lengths, so a tokenizer above them runs once. Only keys and lengths are
    read to count and order. The numbered keys are stored, too, so Spark knows their size when it plans the one join in
    which the arrays meet their batch: where they are small the arrays stay in the tasks that read them. Keys are unique.
    """
    stored = stage(encoded.withColumn("_size", F.size("input_ids")), "encoded")
    ranked = with_batch(seeded_rank(stored.select(key, "_size"), key, seed), batch_size)
    longest = F.max("_size").over(Window.partitionBy("batch_id"))
    numbered = stage(ranked.withColumn("longest", longest).drop("_size"), "batches")
    return join_on(stored.drop("_size"), numbered, [key])


def collate(batched: DataFrame, pad_id: int = 0) -> DataFrame:
    """Pad ids, mask and labels to the ``longest`` row of each batch."""
    return _padded(batched.withColumnRenamed("longest", "_length"), pad_id).drop("_length")


def pad_to(encoded: DataFrame, length: int, pad_id: int = 0) -> DataFrame:
    """Truncate and pad all rows to one fixed length, without a shuffle."""
    cut = encoded.withColumn("input_ids", truncate(F.col("input_ids"), length))
    if "labels" in cut.columns:
        cut = cut.withColumn("labels", truncate(F.col("labels"), length))
    return _padded(cut.withColumn("_length", F.lit(length)), pad_id).drop("_length")


def _padded(rows: DataFrame, pad_id: int) -> DataFrame:
    length = F.col("_length")
    rows = rows.withColumn("attention_mask", attention_mask(F.col("input_ids"), length))
    rows = rows.withColumn("input_ids", pad_right(F.col("input_ids"), length, pad_id))
    if "labels" in rows.columns:
        rows = rows.withColumn("labels", pad_right(F.col("labels"), length, IGNORED))
    return rows


def token_accuracy(rows: DataFrame, predicted: str = "predicted_ids", labels: str = "labels") -> DataFrame:
    """Correct, counted and accuracy over all labels that are not ignored."""
    pairs = F.arrays_zip(F.col(predicted).alias("guess"), F.col(labels).alias("label"))
    counted = rows.select(F.inline(pairs)).filter(F.col("label") != IGNORED)
    sums = counted.agg(
        F.count_if(F.col("guess") == F.col("label")).alias("correct"), F.count(F.lit(1)).alias("total")
    )
    return sums.withColumn(
        "token_accuracy", F.coalesce(F.try_divide(F.col("correct").cast("double"), F.col("total")), F.lit(0.0))
    )


def observe_rows(rows: DataFrame, observation, name: str = "rows") -> DataFrame:
    """Count the rows as they pass, without another pass over them."""
    return rows.observe(observation, F.count(F.lit(1)).alias(name))


def planned_steps(split_counts: DataFrame, batch_size: int, grad_accum: int, epochs: int) -> DataFrame:
    """Optimiser steps and evaluation batches that follow from the split sizes."""
    effective = int(batch_size) * int(grad_accum)
    return split_counts.withColumn("steps", F.expr(f"(`count` div {effective}) * {int(epochs)}")).withColumn(
        "batches", F.expr(f"(`count` + {int(batch_size) - 1}) div {int(batch_size)}")
    )
