"""A linear quality classifier: n-gram indicators scaled by class log-count ratios, a hinge loss, dual coordinate descent."""

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_text

FEATURE_BITS = 18
SAMPLE_ROWS = 8192
BROADCAST_ROWS = 1 << 20
COST = 1.0
EPOCHS = 30
TOLERANCE = 1e-3
SEED = 42
STEEPNESS = 2.0
WORDS_IN_MEMORY = 1 << 17
LONGEST_REMEMBERED = 64
_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")
_START, _END, _SAME = (np.uint32(xxhash.xxh32_intdigest(mark)) for mark in ("start", "end", "same"))
_FACTOR = np.uint32(0x9E3779B1)
_known: dict[str, tuple[int, int]] = {}


def shape(token: str) -> str:
    """What a token looks like: its case or kind, or the first three signs of a run of signs."""
    if token[0].isdigit():
        return "9"
    if not token[0].isalnum():
        return token[:3]
    if token.islower() or not token[0].isupper():
        return "a"
    return "X" if len(token) > 1 and token.isupper() else "A"


def _named(token: str) -> tuple[int, int]:
    return xxhash.xxh32_intdigest(token.lower()), xxhash.xxh32_intdigest(shape(token), 1)


def _hashes(tokens: list[str]) -> list[tuple[int, int]]:
    if len(_known) > WORDS_IN_MEMORY:
        _known.clear()
    out = []
    for token in tokens:
        pair = _known.get(token)
        if pair is None:
            pair = _named(token)
            if len(token) <= LONGEST_REMEMBERED:
                _known[token] = pair
        out.append(pair)
    return out


def indicators(text: str, bits: int = FEATURE_BITS) -> np.ndarray:
    """Sorted numbers below 2**bits of the n-grams that a text has, however often.

    One or two words, without regard to case, and one to three shapes between marks for the text's start
    and end, where a word that repeats the word before it has a mark of its own. So an
    empty text has n-grams, too. The whole text is read.
    """
    pairs = np.array(_hashes(_TOKEN.findall(text)), dtype=np.uint32).reshape(-1, 2)
    words, shapes = pairs[:, 0], pairs[:, 1].copy()
    shapes[1:][words[1:] == words[:-1]] ^= _SAME
    shapes = np.concatenate(([_START], shapes, [_END])).astype(np.uint32)
    grams = [words, (words[:-1] * _FACTOR) ^ words[1:]] if len(words) else []
    two = (shapes[:-1] * _FACTOR) ^ shapes[1:]
    grams += [shapes, two, (two[:-1] * _FACTOR) ^ shapes[2:]]
    mixed = np.concatenate([(g + np.uint32(n)) * _FACTOR for n, g in enumerate(grams)])
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x85EBCA77)
    return np.unique(mixed >> np.uint32(32 - bits)).astype(np.int32)


class Model(NamedTuple):
    """A weight per feature, with its log-count ratio already in it, and a bias.

    ``ratios`` are kept because a text's indicators are scaled to length one by them.
    """

    weights: np.ndarray
    ratios: np.ndarray
    bias: float

    def margin(self, features: np.ndarray) -> float:
        size = float(np.sqrt(np.square(self.ratios[features], dtype=np.float64).sum()))
        return self.bias + (float(self.weights[features].sum(dtype=np.float64)) / size if size else 0.0)


def log_count_ratios(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """log of how much likelier each feature is in the positive class, one added to every count."""
    p, q = positive + 1.0, negative + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, size: int,
    cost: float = COST, epochs: int = EPOCHS, tolerance: float = TOLERANCE, seed: int = SEED,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2 / 2 + sum of cost_i * max(0, 1 - y_i (w x_i + b)), b a weight of a constant one.

    One dual variable per row, between 0 and its cost, is moved to its best value with all
    others fixed; rows come in a new seeded order each epoch, until no projected gradient of an
    epoch is over the tolerance. Each class has half of the whole cost.
    """
    weights, bias = np.zeros(size), 0.0
    n = len(rows)
    share = {y: n / (2 * max(1, int((labels == y).sum()))) for y in (-1, 1)}
    costs = np.array([cost * share[int(y)] for y in labels])
    curvature = np.array([float(v @ v) + 1.0 for v in values])
    alphas = np.zeros(n)
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(n):
            y, at, x = labels[i], rows[i], values[i]
            gradient = y * (float(weights[at] @ x) + bias) - 1.0
            alpha = min(max(alphas[i] - gradient / curvature[i], 0.0), costs[i])
            step = alpha - alphas[i]
            worst = max(worst, abs(step) * curvature[i])
            if step:
                alphas[i] = alpha
                weights[at] += step * y * x
                bias += step * y
        if worst < tolerance:
            break
    return weights, bias


def held_out(key: str = "doc_id"):
    """Rows whose label is never learned: crc32 of the key as text, modulo 3, is 1."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(3)) == 1


def class_counts(labelled: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """How many labelled texts of each class have each feature; every task sends at most 2**bits sums."""

    def counted(batches):
        sums = np.zeros((2, 1 << bits), dtype=np.int64)
        for batch in batches:
            for text, quality in zip(batch.column(0), batch.column(1).to_pylist()):
                sums[quality][indicators(text.as_py(), bits)] += 1
        seen = np.nonzero(sums.any(axis=0))[0]
        columns = [pa.array(seen), pa.array(sums[1][seen]), pa.array(sums[0][seen])]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "positive", "negative"])

    per_task = labelled.select("_text", "_label").mapInArrow(counted, "feature long, positive long, negative long")
    totals = per_task.groupBy("feature").agg(F.sum("positive").alias("p"), F.sum("negative").alias("n")).toArrow()
    positive, negative = np.zeros(1 << bits), np.zeros(1 << bits)
    at = totals.column("feature").to_numpy()
    positive[at], negative[at] = totals.column("p").to_numpy(), totals.column("n").to_numpy()
    return positive, negative


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS, bits: int = FEATURE_BITS, broadcast_rows: int = BROADCAST_ROWS,
) -> Model:
    """Learn from the labelled rows of ``docs`` that are not held out.

    Log-count ratios come from all of them. The hinge-loss model is fitted in one task on a
    sample of at most ``sample_rows`` keys, those with the smallest hashes, one text each; keys with both labels
    count as the lower one there. Labels other than 0 and 1 are passed over. Without
    labels the model scores every text 0.5. Up to ``broadcast_rows`` labels go to every task; more
    are joined by a shuffle of keys and texts.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).filter("_label in (0, 1)")
    texts = docs.filter(~held_out(key)).select(F.col(key).alias("_key"), whole_text(text).alias("_text"))
    few = known.limit(broadcast_rows + 1).count() <= broadcast_rows
    positive, negative = class_counts(texts.join(F.broadcast(known) if few else known, "_key"), bits)
    ratios = log_count_ratios(positive, negative).astype(np.float32)
    shared = spark.sparkContext.broadcast(ratios)

    drawn = known.groupBy("_key").agg(F.min("_label").alias("_label"))
    drawn = texts.select("_key").distinct().join(drawn, "_key").orderBy(F.xxhash64("_key"), "_key").limit(sample_rows)
    sample = texts.join(F.broadcast(drawn), "_key").groupBy("_key").agg(F.min(F.struct("_text", "_label")).alias("_row"))

    def fitted(batches):
        rows, classes = [], []
        for batch in batches:
            rows += [indicators(raw.as_py(), bits) for raw in batch.column(0)]
            classes += batch.column(1).to_pylist()
        values = []
        for features in rows:
            x = shared.value[features].astype(np.float64)
            values.append(x / (np.sqrt(x @ x) or 1.0))
        weights, bias = dual_coordinate_descent(rows, values, np.array(classes) * 2 - 1, 1 << bits)
        columns = [pa.array([weights.astype("<f8").tobytes()], pa.binary()), pa.array([bias], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["weights", "bias"])

    ordered = sample.select("_key", "_row.*").repartition(1).sortWithinPartitions("_key").select("_text", "_label")
    row = ordered.mapInArrow(fitted, "weights binary, bias double").first()
    weights = np.frombuffer(row.weights, dtype="<f8") if row else np.zeros(1 << bits)
    return Model((weights * ratios).astype(np.float32), ratios, row.bias if row else 0.0)


def score_documents(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", bits: int = FEATURE_BITS) -> DataFrame:
    """Each row with all its columns as (_doc, held_out, score, predicted), from its text alone.

    The score lies between 0 and 1, 0.5 on the dividing plane; a missing text is empty, and empty
    texts have a score. The model is broadcast: 2 MB for 2**18 features, whatever the size of the tables.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        margins = np.array([shared.value.margin(indicators(t.as_py(), bits)) for t in texts], dtype=np.float64)
        return pa.array(1.0 / (1.0 + np.exp(-STEEPNESS * margins)))

    scored = docs.select(F.struct("*").alias("_doc"), held_out(key).alias("held_out"), score(whole_text(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
