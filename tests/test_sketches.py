"""Summaries that merge, against exact counts, and gold and predictions as streams."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from namewright.operators import profile, sketches
from namewright.session import shared_folder
from namewright.streaming import jobs
from namewright.streaming.align import align_streams


def test_overlap_of_many_values(spark):
    rows = spark.range(300_000).selectExpr(
        "if(id < 200000, 'train', 'test') as split", "id % 3 as language", "cast(if(id < 200000, id, id - 50000) as string) as repo"
    )
    by_language = sketches.value_sketches(rows, ["split", "language"])
    got = sketches.split_overlap(by_language).first()
    want = {"both": 50_000, "either": 250_000, "only_split": 50_000, "only_other": 150_000}
    assert (got.split, got.other) == ("test", "train")
    for name, count in want.items():
        assert abs(got[name] - count) < 3 * 250_000 / 2**7
    grown = sketches.merge_sketches(
        by_language.unionAll(sketches.value_sketches(rows.filter("id < 10"), ["split", "language"])), ["split"]
    )
    sizes = {r.split: r.distinct for r in sketches.distinct_estimates(grown).collect()}
    assert abs(sizes["train"] - 200_000) < 3 * 200_000 / 2**7 and abs(sizes["test"] - 100_000) < 3 * 100_000 / 2**7


def test_overlap_of_few_and_missing_values(spark):
    rows = spark.createDataFrame(
        [("train", "a"), ("train", "a"), ("train", "b"), ("valid", "b"), ("valid", None), ("test", None)], "split string, repo string"
    )
    got = {tuple(r) for r in sketches.split_overlap(sketches.value_sketches(rows, ["split"])).collect()}
    assert got == {("train", "valid", 1, 2, 1, 0), ("test", "train", 0, 2, 0, 2), ("test", "valid", 0, 1, 0, 1)}
    assert sketches.split_overlap(sketches.value_sketches(rows.limit(0), ["split"])).collect() == []


def _rows(got):
    return [tuple(r) for r in got.collect()]


@pytest.mark.parametrize("tracked", [16, 1 << 14])
@pytest.mark.parametrize("rare", [0, 20_000])
def test_heavy_labels_are_exact(spark, tracked, rare):
    heavy = spark.range(30_000).selectExpr("if(id % 2 = 0, concat('h', cast(sqrt(id) as int) % 7), null) as target", "id as place")
    rows = heavy.unionAll(spark.range(rare).selectExpr("concat('r', id) as target", "id + 30000 as place"))
    want = _rows(profile.top_labels(rows, ["place"]))
    assert _rows(sketches.heavy_labels(rows, ["place"], tracked=tracked)) == want
    assert want[0] == (None, 15_000)


@pytest.mark.parametrize("n", [0, 3, 3_000])
def test_rare_labels_and_ties(spark, n):
    rows = spark.range(n).selectExpr("cast(id as string) as target", f"{n} - id as place", "id % 2 as other")
    want = _rows(profile.top_labels(rows, ["other", "place"]))
    assert _rows(sketches.heavy_labels(rows, ["other", "place"], tracked=64)) == want


def test_heavy_labels_shuffle_no_rare_label(spark, monkeypatch):
    grouped = []
    ranked = sketches._ranked
    monkeypatch.setattr(sketches, "_ranked", lambda rows, *a: grouped.append(rows) or ranked(rows, *a))
    rows = spark.range(40_000).selectExpr("if(id % 2 = 0, 'a', concat('r', id)) as target", "id as place")
    assert _rows(sketches.heavy_labels(rows, ["place"], n=1, tracked=256)) == [("a", 20_000)]
    assert Counter(r.target for r in grouped[0].collect())["a"] == 20_000 and grouped[0].count() < 21_000


def _at(hour):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hour)


def test_alignment_over_a_restart(spark):
    folder = shared_folder(spark, "align")
    gold_schema, told_schema = "sample_id string, at timestamp, target string", "sample_id string, at timestamp, predictions array<string>"

    def send(name, schema, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")

    def look():
        gold = spark.readStream.schema(gold_schema).parquet(f"{folder}/gold")
        told = spark.readStream.schema(told_schema).parquet(f"{folder}/told")
        aligned = align_streams(gold, told, 2, wait="3 hours", delay="2 hours")
        jobs.append_log_events(aligned, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        found = spark.read.schema(aligned.schema).parquet(f"{folder}/out").collect()
        return sorted((r.sample_id, r.target, tuple(r.predictions), r.answered) for r in found)

    send("gold", gold_schema, [("a", _at(0), "A"), ("b", _at(1), "B"), ("c", _at(2), "C"), ("a", _at(0), "A"), (None, _at(1), "N"), ("x", None, "X")])
    send("told", told_schema, [("a", _at(1), ["A", "Q"]), ("a", _at(1), ["A", "Q"]), ("b", _at(9), ["B"]), (None, _at(1), ["N"])])
    first = look()
    assert ("a", "A", ("A", "Q"), True) in first and len(first) == 1  # the watermark waits for the slower stream
    send("gold", gold_schema, [("d", _at(8), "D"), ("e", _at(20), "E")])
    send("told", told_schema, [("c", _at(4), ["C", "R"]), ("d", _at(11), ["D"]), ("z", _at(30), ["Z"])])
    second = look()
    assert second == [("a", "A", ("A", "Q"), True), ("b", "B", ("", ""), False), ("c", "C", ("C", "R"), True), ("d", "D", ("D",), True)]
    send("gold", gold_schema, [("b", _at(1), "B"), ("f", _at(60), "F")])
    send("told", told_schema, [("e", _at(21), ["E"]), ("b", _at(2), ["B"]), ("y", _at(60), ["Y"])])
    third = look()
    assert third == [*second, ("e", "E", ("E",), True)]
