import hashlib
import os

import pytest
from pyspark.sql import functions as F

from namewright.operators import dedup, examples, profile, ranking, runs
from namewright.operators.extract import extract_examples
from namewright.plans import build
from namewright.session import scratch, shared_root
from namewright.sources.examples import read_splits, write_examples


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_first_copy_by_list_order_then_path_then_start(spark):
    data = [("python", "k", 1, "a", 0), ("python", "k", 0, "b", 9), ("python", "k", 0, "b", 3), ("java", "k", 5, "z", 1)]
    table = rows(spark, data, "language string, dedup_key string, repo_ord int, path string, span_start int")
    kept = dedup.keep_first(table, "dedup_key", ["repo_ord", "path", "span_start"])
    assert sorted(tuple(r) for r in kept.collect()) == [("java", "k", 5, "z", 1), ("python", "k", 0, "b", 3)]
    again = dedup.keep_first(kept, "dedup_key", ["repo_ord", "path", "span_start"])
    assert again.count() == 2


def test_missing_group_values_are_kept(spark):
    table = rows(spark, [(None, "k", 1), (None, "k", 2), ("x", None, 3)], "language string, dedup_key string, n int")
    assert sorted(r.n for r in dedup.keep_first(table, "dedup_key", ["n"]).collect()) == [1, 3]


def test_copies_equal_but_for_the_name(spark):
    text = "class {}:\n    pass\n    # end"
    data = [(0, "r", "a.py", "python", text.format("A")), (1, "s", "b.py", "python", text.format("B"))]
    table = rows(spark, data, "repo_ord int, repo string, path string, language string, content string")
    kept = build.unique_examples(extract_examples(table)).collect()
    assert [row.target for row in kept] == ["A"]
    assert build.unique_examples(extract_examples(table, mask=False)).count() == 2


def test_a_third_of_all_rows_in_one_key(spark):
    table = spark.range(30000).select(
        F.lit("python").alias("language"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("dedup_key"),
        F.col("id").alias("n"),
    )
    kept = dedup.keep_first(table, "dedup_key", ["n"])
    assert kept.count() == 20001
    assert kept.filter("dedup_key = 'hot'").first().n == 0


def split_by_hand(keys, train, valid, seed=42):
    order = sorted(keys, key=lambda key: hashlib.md5(f"{seed}|{key}".encode()).hexdigest())
    n_train, n_valid = int(len(order) * train), int(len(order) * valid)
    return {
        key: "train" if i < n_train else "valid" if i < n_train + n_valid else "test" for i, key in enumerate(order)
    }


@pytest.mark.parametrize(
    "n, train, valid", [(100, 0.29, 0.1), (0, 0.8, 0.1), (1, 0.8, 0.1), (7, 0.0, 0.5), (9, 1.0, 0.0), (5, 0.6, 0.4)]
)
def test_split_sizes_truncate(spark, n, train, valid):
    keys = [f"key{i}" for i in range(n)]
    table = rows(spark, [("python", key) for key in keys], "language string, dedup_key string")
    got = {r.dedup_key: r.split for r in ranking.assign_split(table, "dedup_key", train, valid).collect()}
    assert got == split_by_hand(keys, train, valid)
    if n == 100:
        assert list(got.values()).count("train") == 28


@pytest.mark.parametrize("digits", [1, 3])
def test_split_does_not_depend_on_partitions(spark, digits):
    data = [(language, f"k{i}") for language, n in (("python", 500), ("java", 33)) for i in range(n)]
    expected = {}
    for language, n in (("python", 500), ("java", 33)):
        for key, split in split_by_hand([f"k{i}" for i in range(n)], 0.8, 0.1).items():
            expected[language, key] = split
    for count in (1, 13):
        table = rows(spark, data, "language string, dedup_key string").repartition(count)
        got = ranking.assign_split(table, "dedup_key", digits=digits).collect()
        assert {(r.language, r.dedup_key): r.split for r in got} == expected


def test_rank_is_the_place_in_the_seeded_order(spark):
    keys = [f"k{i}" for i in range(300)]
    order = sorted(keys, key=lambda key: hashlib.md5(f"7|{key}".encode()).hexdigest())
    ranked = ranking.seeded_rank(rows(spark, [(k,) for k in keys], "key string"), "key", seed=7, digits=2)
    batched = ranking.with_batch(ranked, 64).collect()
    assert {r.key: r["rank"] for r in batched} == {key: i for i, key in enumerate(order, 1)}
    assert {r.key: r.batch_id for r in batched} == {key: i // 64 for i, key in enumerate(order)}


def test_position_rank(spark):
    data = [("a", 5), ("a", 70000), ("a", 65536), ("b", 1), ("a", 0)]
    got = ranking.position_rank(rows(spark, data, "run string, line bigint"), "line", ["run"]).collect()
    assert {(r.run, r.line): r["rank"] for r in got} == {("a", 0): 1, ("a", 5): 2, ("a", 65536): 3, ("a", 70000): 4, ("b", 1): 1}


def test_row_clean_up(spark):
    table = rows(spark, [("s", "t", None), ("", "t", "java"), ("s", None, "java")], "source string, target string, language string")
    cleaned = examples.with_defaults(examples.drop_empty(table)).collect()
    assert [(r.source, r.language, r.repo) for r in cleaned] == [("s", "unknown", "unknown")]
    named = rows(spark, [("c", "l"), (None, "l")], "class_name string, label string")
    assert sorted(r.target for r in examples.resolve_label(named).collect()) == ["c", "l"]
    with pytest.raises(ValueError):
        examples.resolve_label(rows(spark, [("x",)], "name string"))


def test_profiles(spark):
    data = [("train", "r1", "python", "A"), ("train", "r1", "java", "B"), ("train", "r2", "java", "B"), ("test", "r2", "java", "A")]
    table = rows(spark, data, "split string, repo string, language string, target string").withColumn("n", F.monotonically_increasing_id())
    totals = {r.split: (r["count"], r.repos, r.percent) for r in profile.dataset_totals(table).collect()}
    assert totals == {"train": (3, 2, 75.0), "test": (1, 1, 25.0), "(all)": (4, 2, 100.0)}
    assert [r.split for r in profile.missing_splits(table).collect()] == ["valid"]
    assert {r.split: r.labels for r in profile.label_profile(table).collect()} == {"train": 2, "test": 1}
    top = profile.top_labels(table, ["n"]).collect()
    assert [(r.target, r["count"]) for r in top] == [("A", 2), ("B", 2)]
    renamed = profile.rename_splits(table, to_published=True, splits=["train", "valid"])
    assert renamed.groupBy("split").count().collect()[0].asDict() == {"split": "train", "count": 3}


def test_build_dataset_end_to_end(spark, tmp_path):
    data = [
        (i % 3, f"r{i % 3}", f"f{i}.py", "python", f"class C{i}:\n    x = {i // 2}\n    y = 1\n") for i in range(40)
    ]
    table = rows(spark, data, "repo_ord int, repo string, path string, language string, content string")
    accounts = build.build_dataset(table, str(tmp_path / "out"))
    sizes = {r.split: r["count"] for r in accounts["splits"].collect()}
    assert sizes == {"train": 16, "valid": 2, "test": 2}
    language = accounts["languages"].first()
    assert (language.examples, language.unique_examples) == (40, 20)
    back = read_splits(spark, str(tmp_path / "out"), ("train", "valid", "test"))
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == sizes
    assert back.select("source").distinct().count() == 20
    plan = back.filter("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan


def test_a_build_in_a_scratch_block_leaves_its_output_only(spark, tmp_path):
    shared = shared_root(spark).removeprefix("file:")
    before = set(os.listdir(shared))
    data = [(0, "r", f"f{i}.py", "python", f"class C{i}:\n    x = {i}\n    y = 1\n") for i in range(10)]
    table = rows(spark, data, "repo_ord int, repo string, path string, language string, content string")
    with scratch(spark) as folder:
        accounts = build.build_dataset(table, str(tmp_path / "out"))
        assert sum(r["count"] for r in accounts["splits"].collect()) == 10
        assert os.listdir(folder.removeprefix("file:"))
    assert set(os.listdir(shared)) == before
    assert read_splits(spark, str(tmp_path / "out"), ("train", "valid", "test")).count() == 10


def test_copies_in_repositories_of_one_place_are_dropped(spark):
    """Also if two repositories have the same number, path and place of a class."""
    body = "class C:\n    x = 1\n    y = 1\n"
    table = rows(spark, [(0, repo, "f.py", "python", body) for repo in ("b", "a", "c")],
                 "repo_ord int, repo string, path string, language string, content string")
    assert [r.repo for r in build.unique_examples(extract_examples(table)).collect()] == ["a"]


def test_accounts_with_failed_repositories(spark):
    found = rows(spark, [("python", "k", 0, "a", 1)], "language string, dedup_key string, repo_ord int, path string, span_start int")
    first = dedup.first_of_copies(found, "dedup_key", ["repo_ord", "path", "span_start"])
    ingest = rows(spark, [(0, "python", True), (1, "python", False), (0, "java", True)], "repo_ord int, language string, ok boolean")
    got = {r.language: r.asDict() for r in profile.language_accounts(found, first, ingest).collect()}
    assert got["python"] == {"language": "python", "repos_ok": 1, "repos_failed": 1, "examples": 1, "unique_examples": 1}
    assert got["java"] == {"language": "java", "repos_ok": 1, "repos_failed": 0, "examples": 0, "unique_examples": 0}


def test_mask_sources_is_optional(spark):
    table = rows(spark, [("class A:", "python")], "source string, language string")
    assert examples.mask_sources(table).first().source == "class ____:"
    assert examples.mask_sources(table, mask=False).first().source == "class A:"


def test_missing_keys_survive_ranking(spark):
    table = rows(spark, [(None, "a", 1), (None, "b", 2), ("x", None, 3)], "run string, key string, line bigint")
    assert ranking.position_rank(table, "line", ["run"]).count() == 3
    assert ranking.seeded_rank(table, "key").count() == 3
    split = ranking.assign_split(table, "key", 0.5, 0.0, within=("run",))
    assert sorted(r.split for r in split.collect()) == ["test", "test", "train"]


def test_rebalanced_write(spark, tmp_path):
    table = rows(spark, [("java", "train", i) for i in range(50)], "language string, split string, n int").repartition(5)
    write_examples(table, str(tmp_path / "t"), rebalance=True)
    assert len(list((tmp_path / "t").glob("*/*/*.json"))) == 1


def test_runs(spark):
    log = rows(
        spark,
        [("a", 1, "eval_loss", 0.5), ("a", 2, "eval_loss", 0.3), ("a", 3, "eval_loss", 0.3), ("a", 9, "loss", 0.1), ("b", 1, "loss", 1.0)],
        "run string, step bigint, metric string, value double",
    )
    got = {r.run: (r.best_step, r.best_value, r.final_step) for r in runs.checkpoint_summary(log).collect()}
    assert got == {"a": (2, 0.3, 9), "b": (None, None, 1)}
    paths = rows(spark, [("a", f"o/checkpoint-{n}") for n in (2, 10, 9)] + [("a", "o/x")], "run string, path string")
    steps = runs.with_checkpoint_step(paths)
    assert runs.latest_checkpoint(steps).first().path == "o/checkpoint-10"
    assert sorted(r.step for r in runs.keep_newest(steps).collect()) == [9, 10]
    files = rows(spark, [("b/y",), ("a.txt",), ("b/x",), ("b/c/z",)], "path string")
    listed = [(r.folder, r.name) for r in runs.artifact_listing(files).collect()]
    assert listed == [("b", "x"), ("b", "y"), ("b/c", "z"), ("root", "a.txt")]
