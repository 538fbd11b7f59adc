"""From examples to padded training batches."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import render_prompt, training_text
from ..operators.batches import causal_labels, collate, form_batches, seq2seq_pair
from ..operators.inference import encode_batch


def causal_examples(examples: DataFrame, make_encode, make_encode_prompt, max_length: int = 512) -> DataFrame:
    """Token ids of prompt and answer, labels on the answer alone.

    The prompt is encoded apart, without special tokens, only to learn its length.
    """
    encoded = encode_batch(examples, training_text(F.col("source"), F.col("target")), make_encode)
    prompts = render_prompt(F.col("source"), "causal")
    encoded = encode_batch(encoded, prompts, make_encode_prompt, "prompt_ids")
    sized = encoded.withColumn("prompt_len", F.size("prompt_ids"))
    return causal_labels(sized, max_length).select("sample_id", "input_ids", "labels")


def seq2seq_examples(
    examples: DataFrame, make_encode, max_source: int = 1024, max_target: int = 32
) -> DataFrame:
    """Token ids of the prompt as input and of the target as labels."""
    encoded = encode_batch(examples, render_prompt(F.col("source"), "seq2seq"), make_encode, "prompt_ids")
    encoded = encode_batch(encoded, F.col("target"), make_encode, "target_ids")
    return seq2seq_pair(encoded, max_source, max_target).select("sample_id", "input_ids", "labels")


def training_batches(encoded: DataFrame, batch_size: int, pad_id: int = 0, seed: int = 42) -> DataFrame:
    """Seeded batches, padded to the longest row of each."""
    return collate(form_batches(encoded, "sample_id", batch_size, seed), pad_id)
