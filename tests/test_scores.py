import math
import random
import re
import statistics

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from namewright.functions import arrays
from namewright.operators import batches, classification, generations, lenient, ranking, scoring, views
from namewright.operators.inference import encode_batch, predict_batch
from namewright.plans import evaluate, prepare


def score(spark, data, **options):
    table = spark.createDataFrame(data, "sample_id int, target string, predictions array<string>")
    return scoring.score_rows(table, **options)


def test_score_rows(spark):
    data = [(1, "Foo", ["Foo x", "Bar"]), (2, "Foo", ["foo"]), (3, "Foo", ["", "a", "Foo"]), (4, "Foo", []), (5, "Foo", None)]
    rows = score(spark, data, k=2).orderBy("sample_id").collect()
    got = [(r.top_prediction, r.exact_match, r.exact_match_ci, r.in_topk, r.edit_distance) for r in rows]
    assert got == [
        ("Foo", True, True, True, 0),
        ("foo", False, True, False, 1),
        ("", False, False, False, 3),
        ("", False, False, False, 3),
        ("", False, False, False, 3),
    ]
    assert score(spark, data, k=3).filter("sample_id = 3").first().in_topk
    assert score(spark, [(1, "A b", [" A b "])], normalize="strip").first().exact_match


def test_metrics_of_the_caller(spark):
    data = [(1, "Ab", ["Abc"]), (2, "Ab", ["x"]), (3, "B", ["B"]), (4, None, ["B"])]
    scored = score(spark, data)
    first = lambda target, top: (target.str[0] == top.str[0]).astype(float).where(target.notna())
    metrics = {"first": (first, ["target", "top_prediction"])}
    assert tuple(scoring.caller_metrics(scored, metrics).first()) == (4, 0.5)  # without a target no score, which counts as 0
    by_target = scoring.caller_metrics(scored, metrics, by=["target"]).orderBy("target").collect()
    assert [tuple(row) for row in by_target] == [(None, 1, 0.0), ("Ab", 2, 0.5), ("B", 1, 1.0)]
    assert scoring.caller_metrics(scored.limit(0), metrics, by=["target"]).count() == 0


def test_headline_of_nothing_is_zero(spark):
    row = scoring.headline_metrics(score(spark, [])).first()
    assert (row.n, row.exact_match, row.topk_accuracy, row.avg_levenshtein) == (0, 0.0, 0.0, 0.0)


def test_missing_predictions_become_empty(spark):
    gold = spark.createDataFrame([(1, "A"), (2, "B")], "sample_id int, target string")
    given = spark.createDataFrame([(1, ["A"])], "sample_id int, predictions array<string>")
    rows = scoring.align_predictions(gold, given, 3).orderBy("sample_id").collect()
    assert [r.predictions for r in rows] == [["A"], ["", "", ""]]


def test_topk_is_at_least_exact_match(spark):
    dice = random.Random(3)
    names = ["A", "b", "B", "Cc", ""]
    data = [(i, dice.choice(names[:4]), [dice.choice(names) for _ in range(3)]) for i in range(200)]
    row = scoring.headline_metrics(score(spark, data, k=3)).first()
    assert row.topk_accuracy >= row.exact_match
    assert row.exact_match_case_insensitive >= row.exact_match


def test_edit_distance_stats(spark):
    numbers = [3, 0, 7, 7, 1, 2]
    table = spark.createDataFrame([(n,) for n in numbers], "edit_distance int")
    row = scoring.edit_distance_stats(table).first()
    assert (row.min, row.max, row.median) == (0.0, 7.0, 2.5)
    assert math.isclose(row["std"], statistics.pstdev(numbers)) and math.isclose(row.mean, 20 / 6)
    assert tuple(scoring.edit_distance_stats(table.limit(0)).first()) == (0.0,) * 5


def test_edit_distance_counts_code_points(spark):
    assert score(spark, [(1, "é", ["e"])]).first().edit_distance == 1


def by_hand(pairs):
    labels = sorted({t for t, _ in pairs} | {p for _, p in pairs})
    scores = {}
    for label in labels:
        tp = sum(t == p == label for t, p in pairs)
        support, predicted = sum(t == label for t, _ in pairs), sum(p == label for _, p in pairs)
        precision, recall = (tp / predicted if predicted else 0.0), (tp / support if support else 0.0)
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        scores[label] = (precision, recall, f1, support)
    return scores


def test_classification(spark):
    dice = random.Random(1)
    pairs = [(dice.choice("abcd"), dice.choice("abce")) for _ in range(300)] + [("accuracy", "accuracy")]
    table = spark.createDataFrame(pairs, "t string, p string")
    rows = {(r.kind, r.label): r for r in classification.classification_report(table, "t", "p").collect()}
    hand = by_hand(pairs)
    for label, expected in hand.items():
        row = rows["label", label]
        assert (row.precision, row.recall, row.f1_score, row.support) == pytest.approx(expected)
    accuracy = sum(t == p for t, p in pairs) / len(pairs)
    assert rows["summary", "accuracy"].f1_score == pytest.approx(accuracy)
    assert rows["summary", "macro avg"].precision == pytest.approx(statistics.mean(s[0] for s in hand.values()))
    weighted = classification.weighted_scores(table, "t", "p").first()
    assert weighted.recall == pytest.approx(weighted.accuracy)
    assert weighted.f1_score == pytest.approx(sum(s[2] * s[3] for s in hand.values()) / len(pairs))
    assert tuple(classification.weighted_scores(table.limit(0), "t", "p").first()) == (0.0,) * 4


def test_lenient_report(spark):
    data = [(1, " Foo ", "foo", "python", ["FOO"]), (2, "Bar", "Baz", None, None), (3, "Qux", "", "java", ["x", "qux"])]
    table = spark.createDataFrame(
        data, "sample_id int, target string, predicted string, language string, topk_predictions array<string>"
    )
    compared = lenient.compare_leniently(table)
    row = lenient.report_metrics(compared, "sample_id", k=2).first()
    assert (row.n, row.correct_predictions) == (3, 1)
    assert row.exact_match == row.exact_match_case_insensitive == pytest.approx(1 / 3)
    assert row.topk_accuracy == pytest.approx(2 / 3)
    assert row.avg_target_length == pytest.approx(11 / 3)
    assert row.avg_edit_distance == pytest.approx((1 + 1 + 3) / 3)
    assert lenient.report_metrics(compared.filter("sample_id > 1"), "sample_id", 2).first().topk_accuracy == 0.0
    assert lenient.report_metrics(compared.drop("topk_predictions"), "sample_id").first().topk_accuracy == 0.0
    assert lenient.report_metrics(compared.limit(0), "sample_id").first().exact_match is None
    assert lenient.class_distribution(compared).first()[0] == 5
    stats = {r.language: (r.total, r.correct) for r in lenient.language_stats(compared, overall=True).collect()}
    assert stats == {"python": (1, 1), "unknown": (1, 0), "java": (1, 0), "(all)": (3, 1)}


def test_beams(spark):
    beams = spark.createDataFrame(
        [(1, 2, "b"), (1, 1, "a"), (1, 3, "a"), (2, 1, ""), (1, 9, "z"), (2, 2, "x")], "sample_id int, beam int, text string"
    )
    grouped = generations.group_beams(beams, 3)
    assert {r.sample_id: r.predictions for r in grouped.collect()} == {1: ["a", "b", "a"], 2: ["", "x"]}
    unique = generations.unique_predictions(grouped, 3)
    assert {r.sample_id: r.predictions for r in unique.collect()} == {1: ["a", "b"], 2: ["", "x"]}
    filled = generations.unique_predictions(grouped, 3, drop_empty=True)
    assert {r.sample_id: r.predictions for r in filled.collect()} == {1: ["a", "b"], 2: ["x"]}
    shown = {r.sample_id: (r.best, r.alts) for r in generations.best_and_alternatives(unique).collect()}
    assert shown == {1: ("a", "b"), 2: ("", "x")}


def test_metrics_display(spark):
    metrics = scoring.headline_metrics(score(spark, [(1, "A", ["A"]), (2, "B", ["x"]), (3, "C", ["x"])]), k=5)
    shown = {r.label: r.value for r in views.metrics_display(metrics).collect()}
    assert shown == {
        "Exact Match": "33.33%", "Case-Insensitive Match": "33.33%", "Top-5 Accuracy": "33.33%",
        "Avg Levenshtein Distance": "0.67", "Samples Evaluated": "3",
    }
    timed = views.metrics_display(scoring.with_throughput(metrics, 0.0))
    assert {r.label: r.value for r in timed.collect()}["Speed"] == "0.00 samples/sec"


def token_rows(spark, data):
    return spark.createDataFrame(data, "sample_id int, input_ids array<int>, prompt_len int")


def test_prompt_masking(spark):
    rows = token_rows(spark, [(1, [5, 6, 7], 2), (2, [5, 6], 2), (3, [5, 6], 9), (4, [], 0), (5, [1, 2, 3, 4], 1)])
    got = {r.sample_id: r.labels for r in batches.causal_labels(rows, 3).collect()}
    assert got == {1: [-100, -100, 7], 2: [5, 6], 3: [5, 6], 4: [], 5: [-100, 2, 3]}


def test_arrays_are_shuffled_once_for_batches(spark, tmp_path, capsys):
    token_rows(spark, [(i, [1] * i, 1) for i in range(50)]).write.parquet(str(tmp_path / "tokens"))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        rows = batches.causal_labels(spark.read.parquet(str(tmp_path / "tokens")))
        made = batches.collate(batches.form_batches(rows, "sample_id", 8))
        made.explain("formatted")
    finally:
        spark.conf.set(threshold, before)
    moved = re.findall(r"\(\d+\) Exchange\s+Input \[\d+\]: \[(.*)\]", capsys.readouterr().out)
    assert len(moved) > 1 and sum("input_ids" in columns for columns in moved) == 1


def test_bucket_digits_follow_the_rows():
    assert [ranking.bucket_digits(n) for n in (0, 10**8, 10**9, 10**12)] == [3, 3, 4, 6]


def test_collation_pads_to_the_longest_of_each_batch(spark):
    rows = batches.causal_labels(token_rows(spark, [(i, list(range(1, i + 2)), 1) for i in range(20)]), 512)
    padded = batches.collate(batches.form_batches(rows, "sample_id", 6), pad_id=0).collect()
    sizes = {}
    for row in padded:
        n = row.sample_id + 1
        assert row.input_ids[:n] == list(range(1, n + 1)) and set(row.input_ids[n:]) <= {0}
        assert row.attention_mask == [1] * n + [0] * (len(row.input_ids) - n)
        assert len(row.labels) == len(row.input_ids) and set(row.labels[n:]) <= {-100}
        sizes.setdefault(row.batch_id, set()).add((len(row.input_ids), ))
    assert all(len(s) == 1 for s in sizes.values()) and sorted(sizes) == [0, 1, 2, 3]
    fixed = batches.pad_to(rows, 8).collect()
    assert {len(r.input_ids) for r in fixed} == {len(r.labels) for r in fixed} == {8}


def test_rows_are_counted_as_they_pass(spark):
    seen = Observation()
    assert len(batches.observe_rows(spark.range(7), seen).collect()) == 7
    assert seen.get == {"rows": 7}


def test_planned_steps(spark):
    sizes = spark.createDataFrame([("train", 85)], "split string, count bigint")
    row = batches.planned_steps(sizes, 10, 4, 3).first()
    assert (row.steps, row.batches) == (6, 9)


def test_token_accuracy_and_argmax(spark):
    rows = spark.createDataFrame([([1, 2, 3], [-100, 2, 4]), ([9], [-100])], "predicted_ids array<int>, labels array<int>")
    assert tuple(batches.token_accuracy(rows).first()) == (1, 2, 0.5)
    assert batches.token_accuracy(rows.limit(0)).first().token_accuracy == 0.0
    vectors = spark.createDataFrame([([0.5, 2.0, 2.0],)], "v array<float>")
    assert vectors.select(arrays.argmax(F.col("v"))).first()[0] == 1


def test_failing_batches_give_empty_predictions(spark):
    def make():
        def predict(prompts):
            if any("bad" in prompt for prompt in prompts):
                raise RuntimeError("out of memory")
            return [[prompt.upper(), "x"] for prompt in prompts]

        return predict

    rows = spark.createDataFrame([(i, "bad" if i == 3 else f"p{i}") for i in range(6)], "id int, prompt string").coalesce(1)
    got = predict_batch(rows, F.col("prompt"), make, k=2, batch_size=2).orderBy("id").collect()
    assert [r.predictions for r in got] == [["P0", "x"], ["P1", "x"], ["", ""], ["", ""], ["P4", "x"], ["P5", "x"]]
    assert [r.failed for r in got] == [False, False, True, True, False, False]
    with pytest.raises(Exception, match="out of memory"):
        predict_batch(rows, F.col("prompt"), make, k=2, on_error="raise").collect()


def in_task(function):
    """A factory of the function; both travel to the tasks by value."""
    return lambda: function


def test_training_preparation(spark):
    make_words = in_task(lambda texts: [[len(word) for word in text.split()] for text in texts])
    rows = spark.createDataFrame([("s1", "class ____: x", "Foo")], "sample_id string, source string, target string")
    causal = prepare.causal_examples(rows, make_words, make_words).first()
    assert causal.input_ids == [5, 5, 1, 5, 5, 16] and causal.labels == [-100] * 5 + [16]
    pair = prepare.seq2seq_examples(rows, make_words).first()
    assert pair.input_ids == [7, 5, 5, 5, 5, 1, 5] and pair.labels == [3]
    assert encode_batch(rows, F.col("target"), make_words).first().input_ids == [3]
    batched = prepare.training_batches(prepare.causal_examples(rows, make_words, make_words), 4)
    assert batched.first().batch_id == 0


def test_evaluation_end_to_end(spark, tmp_path):
    make_guess = in_task(lambda prompts: [["Foo", "Bar"] for _ in prompts])
    make_causal_guess = in_task(lambda prompts: [[prompt + " Foo.\n<|endoftext|>"] for prompt in prompts])
    rows = spark.createDataFrame(
        [("1", "class ____", "Foo", "java", "r"), ("2", "class ____", "Bar", "java", "r"), ("3", "", "X", None, None)],
        "sample_id string, source string, target string, language string, repo string",
    )
    metrics = evaluate.evaluate(rows, make_guess, str(tmp_path), "model/run1/", k=2).first()
    assert (metrics.n, metrics.exact_match, metrics.topk_accuracy) == (3, pytest.approx(1 / 3), pytest.approx(2 / 3))
    assert spark.read.parquet(str(tmp_path / "metrics")).filter("run = 'run1'").count() == 1
    assert spark.read.json(str(tmp_path / "run1/detailed_results")).count() == 3
    causal = evaluate.evaluate(rows, make_causal_guess, str(tmp_path), "run2", k=1, template="causal").first()
    assert causal.exact_match == pytest.approx(1 / 3)
    folder = evaluate.report(rows, make_causal_guess, str(tmp_path), "m", "d", make_topk=make_causal_guess)
    summary = spark.read.json(f"{folder}/summary").first()
    assert summary.performance_metrics.n == 2 and summary.performance_metrics.exact_match == 0.5
    assert summary.performance_metrics.topk_accuracy == 0.5
    assert spark.read.json(f"{folder}/classification_report").filter("kind = 'label'").count() == 2
    assert spark.read.json(f"{folder}/language_stats").first().total == 2
