"""Run a caller's model or tokenizer over a table in batches."""

import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


MODELS_IN_MEMORY = 2
_models: OrderedDict[str, Callable] = OrderedDict()


def made_once(token: str, make: Callable) -> Callable:
    """What ``make()`` gives, made once per worker process for all tasks that know it by ``token``; the last two are kept."""
    if token not in _models:
        while len(_models) >= MODELS_IN_MEMORY:
            _models.popitem(last=False)
        _models[token] = make()
    _models.move_to_end(token)
    return _models[token]


def predictor(make_predict, k: int, batch_size: int = 16, on_error: str = "empty"):
    """A column function from prompts to (predictions, failed).

    ``make_predict()`` runs once per worker process and returns a function from a list of
    prompts to one list of texts per prompt. Only the prompt column travels to
    Python; the other columns stay in the JVM. A batch that fails gives ``k`` empty
    texts per prompt and marks them as failed, or ends the job with ``on_error="raise"``.
    """
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = made_once(token, make_predict)
        for prompts in batches:
            texts = prompts.tolist()
            results, failed = [], []
            for start in range(0, len(texts), batch_size):
                part = texts[start : start + batch_size]
                try:
                    answers = [list(answer) for answer in predict(part)]
                    if len(answers) != len(part):
                        raise ValueError(f"{len(answers)} answers for {len(part)} prompts")
                    failed += [False] * len(part)
                except Exception:
                    if on_error == "raise":
                        raise
                    answers = [[""] * k for _ in part]
                    failed += [True] * len(part)
                results.extend(answers)
            yield pd.DataFrame({"predictions": pd.Series(results, dtype=object), "failed": pd.Series(failed, dtype=bool)})

    return F.pandas_udf(run, "struct<predictions: array<string>, failed: boolean>")


def predict_batch(
    rows: DataFrame, prompt: Column, make_predict, k: int, batch_size: int = 16, on_error: str = "empty"
) -> DataFrame:
    """Add ``predictions``, the model's texts for each row's prompt, and ``failed``."""
    answered = rows.withColumn("_answer", predictor(make_predict, k, batch_size, on_error)(prompt))
    return answered.withColumns(
        {"predictions": F.col("_answer.predictions"), "failed": F.col("_answer.failed")}
    ).drop("_answer")


def prediction_accounts(predicted: DataFrame) -> DataFrame:
    """How many prompts were asked, and how many have no answer because their batch failed."""
    return predicted.agg(F.count(F.lit(1)).alias("prompts"), F.count_if("failed").alias("failed"))


def encode_batch(rows: DataFrame, text: Column, make_encode, output: str = "input_ids") -> DataFrame:
    """Add token ids from a caller's tokenizer, made once per worker process: list of texts to list of id lists."""
    token = uuid.uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = made_once(token, make_encode)
        for texts in batches:
            yield pd.Series([list(ids) for ids in encode(texts.tolist())], dtype=object)

    return rows.withColumn(output, F.pandas_udf(run, T.ArrayType(T.IntegerType()))(text))
