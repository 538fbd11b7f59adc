"""The quality classifier: its optimum, its parts by hand, and held-out accuracy."""

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import DATA

from namewright.llm import quality_model, queries


def read(name, folder=DATA):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


@pytest.mark.parametrize("folder", [DATA, "/root/testdata/sf0.01"])
def test_held_out_accuracy(spark, folder):
    got = {r.doc_id: r for r in queries.op11_quality_classifier(spark, folder).collect()}
    assert len(got) == len(read("documents", folder))
    assert all(r.held_out == (zlib.crc32(str(key).encode()) % 3 == 1) for key, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    unseen = [(got[r["doc_id"]].predicted, r["quality"]) for r in read("labels", folder) if got[r["doc_id"]].held_out]
    assert sum(p == q for p, q in unseen) >= 0.97 * len(unseen)
    assert {q for _, q in unseen} == {0, 1}


def test_held_out_labels_and_other_columns_change_nothing(spark):
    """Nor do repeated label rows of other keys; missing and empty texts, missing keys and repeated rows are scored."""
    rows = [(d["doc_id"], d["text"]) for d in read("documents")] + [(None, None), (None, "a text"), (0, "zero"), (-1, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' as score", "1 as predicted", "doc_id as quality")
    labels = [(r["doc_id"], r["quality"]) for r in read("labels")]
    turned = [(k, 1 - q if zlib.crc32(str(k).encode()) % 3 == 1 else q) for k, q in labels] + [(10**9, 0), (None, 1), (3, None), (4, 7)]
    results = []
    for known in (labels, turned):
        table = spark.createDataFrame(known, "doc_id long, quality long")
        scored = quality_model.score_documents(docs, quality_model.fit(docs, table)).collect()
        assert len(scored) == len(rows) and all(r._doc.score == "s" for r in scored)
        results.append(sorted((r._doc.doc_id or 0, r._doc.text or "", r.score) for r in scored))
    assert np.allclose([r[2] for r in results[0]], [r[2] for r in results[1]], atol=1e-9)


def test_without_labels_and_with_one_class(spark):
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(30)], "doc_id long, text string")
    label = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    score = lambda labels: [r.score for r in quality_model.score_documents(docs, quality_model.fit(docs, labels)).collect()]
    assert set(score(label([]))) == {0.5}
    assert min(score(label([(i, 1) for i in range(30)]))) > 0.5
    assert quality_model.score_documents(docs.limit(0), quality_model.fit(docs.limit(0), label([]))).collect() == []


def test_sample_is_bounded_and_ratios_are_not(spark):
    """The ratios come from all labelled texts, also those outside of the sample."""
    rows = [(i, f"{'good' if i % 2 else 'bad'} common x{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    small, whole = (quality_model.fit(docs, labels, sample_rows=n, broadcast_rows=n) for n in (4, 8192))
    assert np.array_equal(small.ratios, whole.ratios)
    learned = [t for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    sums = np.ones((2, 1 << quality_model.FEATURE_BITS))
    for text in learned:
        sums[int(text.startswith("good"))][quality_model.indicators(text)] += 1
    shares = sums / sums.sum(axis=1, keepdims=True)
    assert np.allclose(whole.ratios, np.log(shares[1] / shares[0]), atol=1e-5)
    assert np.count_nonzero(small.weights) < np.count_nonzero(whole.weights)


def test_descent_reaches_the_optimum():
    """The duality gap closes: primal and dual objective agree."""
    draw = np.random.default_rng(0)
    size, n = 40, 120
    rows = [np.sort(draw.choice(size, 8, replace=False)) for _ in range(n)]
    values = [draw.normal(size=8) for _ in range(n)]
    labels = np.where(draw.random(n) < 0.7, 1, -1)
    weights, bias = quality_model.dual_coordinate_descent(rows, values, labels, size, epochs=4000, tolerance=1e-10)
    dense = np.zeros((n, size + 1))
    for i, (at, x) in enumerate(zip(rows, values)):
        dense[i, at] = x
    dense[:, size] = 1
    costs = np.where(labels == 1, n / (2 * (labels == 1).sum()), n / (2 * (labels == -1).sum()))
    best = np.append(weights, bias)

    def primal(w):
        return w @ w / 2 + (costs * np.maximum(0, 1 - labels * (dense @ w))).sum()

    reached = primal(best)
    for _ in range(300):  # no step in any direction makes the convex objective smaller
        assert primal(best + draw.normal(size=size + 1) * 10.0 ** draw.uniform(-6, 0)) >= reached - 1e-9
    slopes = dense * (labels * costs)[:, None]
    sure, edge = labels * (dense @ best) < 1 - 1e-7, np.abs(labels * (dense @ best) - 1) <= 1e-7
    rest = best - slopes[sure].sum(axis=0)  # must be a mix of the rows on the edge, each between 0 and its cost
    mix, *_ = np.linalg.lstsq(slopes[edge].T, rest, rcond=None)
    assert np.allclose(slopes[edge].T @ mix, rest, atol=1e-5) and (mix > -1e-5).all() and (mix < 1 + 1e-5).all()


def test_indicators_read_the_whole_text():
    one = set(quality_model.indicators("a b"))
    assert set(quality_model.indicators("A b")) & one and len(quality_model.indicators("")) > 0
    long = "word " * 100_000
    tail = set(quality_model.indicators("### end"))
    assert tail & set(quality_model.indicators(long + "### end")) > tail & set(quality_model.indicators(long))
    kinds = {t: quality_model.shape(t) for t in ("word", "Word", "WORD", "W", "9th", "&&&&", "_x", "日本")}
    assert kinds == {"word": "a", "Word": "A", "WORD": "X", "W": "A", "9th": "9", "&&&&": "&&&", "_x": "_x", "日本": "a"}
