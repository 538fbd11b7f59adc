"""From a test split and a model to metrics."""

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import completion_line, completion_token, render_prompt
from ..operators.classification import classification_report, weighted_scores
from ..operators.examples import drop_empty, with_defaults
from ..operators.inference import predict_batch, prediction_accounts
from ..operators.lenient import class_distribution, compare_leniently, language_stats, report_metrics
from ..operators.scoring import edit_distance_stats, headline_metrics, score_rows, with_throughput
from ..session import stage
from ..sources.results import run_timestamp, summary_row, write_metrics, write_results, write_summary


def evaluate(
    examples: DataFrame,
    make_predict,
    out: str,
    run: str,
    k: int = 5,
    template: str = "seq2seq",
    batch_size: int = 16,
    device: str = "cpu",
) -> DataFrame:
    """Ask the model, score every sample, write results and metrics.

    The model runs once per sample: its answers are written with the scores, and the
    metrics are computed from that table.
    """
    started = time.monotonic()
    prompt = render_prompt(F.col("source"), template)
    if template == "causal":
        asked = predict_batch(examples, prompt, make_predict, k, batch_size)
        cleaned = F.transform("predictions", lambda raw: completion_token(raw, prompt))
        scored = score_rows(asked.withColumn("predictions", cleaned), k, "strip")
    else:
        asked = predict_batch(examples, prompt, make_predict, k, batch_size, on_error="raise")
        scored = score_rows(asked, k, "first_token")
    results = stage(scored, "results")
    write_results(results.drop("edit_distance"), f"{out}/{run.rstrip('/').rsplit('/', 1)[-1]}/detailed_results")
    metrics = stage(headline_metrics(results, k, device, batch_size), "metrics")
    timed = with_throughput(metrics, time.monotonic() - started)
    write_metrics(timed, f"{out}/metrics", run)
    return timed


def report(
    examples: DataFrame,
    make_predict,
    out: str,
    model_path: str,
    test_data_path: str,
    k: int = 5,
    make_topk=None,
    batch_size: int = 1,
    device: str = "cpu",
) -> str:
    """The full report of a test: summary, per-language and per-label tables.

    ``make_topk`` gives the ``k`` sampled answers of the optional top-k accuracy.
    """
    started = time.monotonic()
    spark = examples.sparkSession
    prompt = render_prompt(F.col("source"), "causal")

    def answers(rows, factory, count):
        asked = predict_batch(rows, prompt, factory, count, batch_size)
        return asked.withColumn("predictions", F.transform("predictions", lambda raw: completion_line(raw, prompt)))

    predicted = answers(with_defaults(drop_empty(examples)), make_predict, 1)
    best = F.coalesce(F.try_element_at("predictions", F.lit(1)), F.lit(""))
    predicted = predicted.withColumns({"predicted": best, "timestamp": F.current_timestamp()}).drop("predictions")
    if make_topk is not None:
        first = predicted.withColumnRenamed("failed", "_failed")
        predicted = answers(first, make_topk, k).withColumnRenamed("predictions", "topk_predictions")
        predicted = predicted.withColumn("failed", F.col("failed") | F.col("_failed")).drop("_failed")
    rows = stage(predicted, "predicted")
    compared = compare_leniently(rows)
    stamp = run_timestamp(spark)
    summary = summary_row(
        report_metrics(compared, "sample_id", k),
        weighted_scores(compared, "truth", "guess"),
        edit_distance_stats(compared),
        class_distribution(compared),
        stamp,
        model_path=model_path,
        test_data_path=test_data_path,
        device=device,
        batch_size=batch_size,
        elapsed_time_seconds=time.monotonic() - started,
    )
    tables = {
        "predictions": rows,
        "prediction_accounts": prediction_accounts(rows),
        "language_stats": language_stats(compared),
        "classification_report": classification_report(compared, "truth", "guess"),
    }
    return write_summary(summary, tables, out, stamp)
