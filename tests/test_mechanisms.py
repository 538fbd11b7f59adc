"""Callers' aggregates, resumed inference, numbered lines, records of several lines and the flat sink."""

import json
import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from namewright.operators import batches
from namewright.operators.aggregates import Aggregate, aggregate_rows, character_fscore
from namewright.operators.extract import extract_declarations
from namewright.operators.inference import encode_batch
from namewright.operators.resume import InferenceStopped, resumed_inference
from namewright.operators.sqlfunctions import register_extract_classes
from namewright.sources import examples, flat, lines, logs
from namewright.sources.store import Store

# Aggregates


def fscore(pairs):
    common = sum((Counter(t) & Counter(p)).total() for t, p in pairs)
    guessed, true = sum(len(p) for _, p in pairs), sum(len(t) for t, _ in pairs)
    return tuple(round(x, 9) for x in (common / guessed, common / true, 2 * common / (guessed + true)))


@pytest.mark.parametrize("parts, fan, groups", [(1, 32, 4096), (7, 2, 1), (40, 3, 2)])
def test_aggregate_is_the_same_for_any_partitioning(spark, parts, fan, groups):
    """Also with one group in nearly all rows, a missing group, and tasks that send states on early."""
    draw = random.Random(parts)
    rows = [(draw.choice(["a", "a", "a", "a", "b", None]), f"t{i % 31}é", f"{i % 17}t") for i in range(600)]
    table = spark.createDataFrame(rows, "lang string, truth string, guess string").repartition(parts)
    want = defaultdict(list)
    for lang, truth, guess in rows:
        want[lang].append((truth, guess))
    made = aggregate_rows(table, character_fscore(), ["truth", "guess"], by=["lang"], fan=fan, groups_in_memory=groups)
    got = {r.lang: tuple(round(x, 9) for x in tuple(r)[1:]) for r in made.collect()}
    assert got == {lang: fscore(pairs) for lang, pairs in want.items()}
    (whole,) = aggregate_rows(table, character_fscore(), ["truth", "guess"], fan=fan).collect()
    assert tuple(round(x, 9) for x in whole) == fscore([pair for pairs in want.values() for pair in pairs])


def test_aggregate_of_no_rows_and_of_several_keys(spark):
    table = spark.createDataFrame([(1, "x", 2.0), (None, "x", 5.0), (1, "x", 7.0)], "k long, g string, v double")
    largest = Aggregate(lambda: [], lambda s, f: [max([*s, *f["v"]])], lambda a, b: [max(a + b)] if a + b else [], lambda s: {"top": s[0] if s else None}, "top double")
    assert {tuple(r) for r in aggregate_rows(table, largest, ["v"], by=["k", "g"]).collect()} == {(1, "x", 7.0), (None, "x", 5.0)}
    assert [r.top for r in aggregate_rows(table.limit(0), largest, ["v"]).collect()] == [None]
    assert aggregate_rows(table.limit(0), largest, ["v"], by=["k"]).collect() == []


# The SQL function


def test_sql_function_lists_offsets_of_very_many_declarations(spark):
    """Fifty thousand in one file, as many as the DataFrame operator finds, and files without any."""
    content = "head\n" + "".join(f"class K{i}:\n    é{i}\n" for i in range(50_000))
    files = [("a", "r", "python", content), ("b", "r", "python", "none"), ("c", "r", "python", ""), ("d", "r", "ruby", "class X"), ("e", "r", "python", None)]
    table = spark.createDataFrame(files, "path string, repo string, language string, content string")
    register_extract_classes(spark)
    table.createOrReplaceTempView("very_many")
    found = spark.sql("select path, c.* from (select path, extract_classes(content, language) as found from very_many) lateral view inline(found) c")
    got = [(r.span_start, r.span_end, r.target) for r in found.orderBy("path", "span_start").collect()]
    want = extract_declarations(table).select("span_start", "span_end", "target", "path").orderBy("path", "span_start").collect()
    assert len(got) == 50_000 and got == [tuple(r)[:3] for r in want]
    assert all(content[a:b].startswith(f"class {name}:") for a, b, name in got[::997])


# Inference


def model(calls, made, dies):
    """Writes down which texts it is asked, and how often it is made."""

    def make_predict():
        with open(made, "a") as out:
            out.write(f"{os.getpid()}\n")

        def predict(asked):
            if any(dies(text) for text in asked):
                raise RuntimeError("gone")
            with open(calls, "a") as out:
                out.write("".join(f"{text}\n" for text in asked))
            return [[text.upper(), "b"] for text in asked]

        return predict

    return make_predict


def test_resumed_inference_asks_every_sample_once(spark, tmp_path):
    """The first job dies in some tasks, the second goes on, the third asks nothing."""
    calls, made, folder = str(tmp_path / "calls"), str(tmp_path / "made"), str(tmp_path / "ledger")
    rows = [(f"k{i}", f"text{i}") for i in range(200)] + [(None, "no key")]
    table = spark.createDataFrame(rows, "sample_id string, prompt string")
    ask = lambda dies: resumed_inference(table, F.col("prompt"), model(calls, made, dies), folder, batch_size=4, rows_per_task=20)
    with pytest.raises(InferenceStopped, match="gone"):
        ask(lambda text: text in ("text7", "text90"))
    first = open(calls).read().split()
    assert 20 < len(first) < 200 and "text7" not in first
    answered = {r.sample_id: r.predictions for r in ask(lambda text: False).collect()}
    assert answered == {k: [t.upper(), "b"] if k else None for k, t in rows}
    assert Counter(open(calls).read().split()) == Counter(t for k, t in rows if k)
    ask(lambda text: True).collect()
    processes = Counter(open(made).read().split())
    assert max(processes.values()) <= 3  # at most once per job and worker process, though a job has ten tasks


def test_ledger_keeps_whole_tasks_of_a_job_that_was_killed(spark, tmp_path):
    """A worker process that dies ends the job; tasks that had ended keep their answers."""
    calls, made, folder = str(tmp_path / "calls"), str(tmp_path / "made"), str(tmp_path / "ledger")
    table = spark.createDataFrame([(i, f"text{i}") for i in range(64)], "sample_id long, prompt string")

    def make_predict():
        def predict(asked):
            import time

            if "text5" in asked:
                time.sleep(8)
                os._exit(1)
            return [[text] for text in asked]

        return predict

    with pytest.raises(Exception):
        resumed_inference(table, F.col("prompt"), make_predict, folder, batch_size=64, rows_per_task=4)
    kept = spark.read.parquet(folder).count()
    assert 0 < kept < 64
    resumed = resumed_inference(table, F.col("prompt"), model(calls, made, lambda text: False), folder)
    assert resumed.filter("predictions is null").count() == 0
    assert len(open(calls).read().split()) == 64 - kept


def test_many_small_portions_are_few_tasks(spark, tmp_path):
    """Two hundred portions are no more than 32 files; a model that raises ends its portion, not the rest of the task."""
    calls, made, folder = str(tmp_path / "calls"), str(tmp_path / "made"), str(tmp_path / "ledger")
    table = spark.createDataFrame([(i, f"text{i}") for i in range(2000)], "sample_id long, prompt string")
    ask = lambda dies: resumed_inference(table, F.col("prompt"), model(calls, made, dies), folder, batch_size=4, rows_per_task=10)
    with pytest.raises(InferenceStopped, match="gone"):
        ask(lambda text: text.endswith("00"))
    assert len([name for name in os.listdir(folder) if name.endswith(".parquet")]) <= 32
    first = open(calls).read().split()
    assert 2000 - 20 * 10 <= len(first) < 2000 and not any(text.endswith("00") for text in first)
    assert ask(lambda text: False).filter("predictions[0] = upper(prompt)").count() == 2000
    assert Counter(open(calls).read().split()) == Counter(f"text{i}" for i in range(2000))


def test_batches_call_the_tokenizer_once_a_row(spark, tmp_path):
    calls = str(tmp_path / "calls")

    def make_encode():
        def encode(texts):
            with open(calls, "a") as out:
                out.write("".join(f"{text}\n" for text in texts))
            return [[len(text)] * len(text) for text in texts]

        return encode

    rows = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(30)], "sample_id long, text string").repartition(3)
    batched = batches.collate(batches.form_batches(encode_batch(rows, F.col("text"), make_encode), "sample_id", 8))
    found = batched.groupBy("batch_id").agg(F.min(F.size("input_ids")).alias("low"), F.max(F.size("input_ids")).alias("high"), F.count("*").alias("n"))
    assert all(r.low == r.high for r in found.collect()) and batched.count() == 30
    assert Counter(open(calls).read().split()) == Counter("x" * (i + 1) for i in range(30))


# Lines


def test_lines_are_numbered_for_any_range(spark, tmp_path):
    """Ranges that cut lines, lines longer than ranges, empty lines and files, no line end at the end, hidden files."""
    draw = random.Random(3)
    files = {
        "run1/a.log": [("é" * draw.randrange(12)) + str(i) for i in range(60)] + ["", "", "x" * 300, "end"],
        "run1/b.log": [],
        "run2/c.log": ["only"],
        "run2/d.log": ["", "a", ""],
    }
    for name, values in files.items():
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_bytes(("\r\n" if "a" in name else "\n").join(values).encode())
    (tmp_path / "run2/_hidden").write_text("no\n")
    want = {(name, i, v) for name, values in files.items() for i, v in enumerate(values) if v or i < len(values) - 1}
    for size in (1, 7, 64, 1 << 20):
        read = lines.number_lines(lines.read_lines(spark, str(tmp_path), size)).collect()
        got = [("/".join(r.path.split("/")[-2:]), r.line, r.value) for r in read]
        assert len(got) == len(want) and set(got) == want
    assert lines.read_lines(spark, str(tmp_path / "run1" / "b*")).collect() == []


def test_small_ranges_share_a_task(tmp_path):
    """Neighbouring ranges of all files are read by one task up to its bytes; large ranges are a task each."""
    for name in "abc":
        (tmp_path / f"{name}.log").write_text("a line\n" * 10_000)
    tasks = lines.NumberedLinesReader(str(tmp_path), 100).partitions()
    assert len(tasks) == 1 and len(tasks[0].value) == 3 * 700
    read = [row for batch in lines.NumberedLinesReader(str(tmp_path), 100).read(tasks[0]) for row in batch.to_pylist()]
    assert len(read) == 30_000 and {row["value"] for row in read} == {"a line"}
    (tmp_path / "big.log").write_bytes(b"x" * (9 << 20))
    assert len(lines.NumberedLinesReader(str(tmp_path / "big*"), 3 << 20).partitions()) == 3


def test_records_cross_ranges(spark, tmp_path):
    """Tracebacks longer than several ranges, lines before the first head, two files."""
    head = "2024-01-02 03:04:05 - eval - ERROR - failed {}"
    texts = {
        "a.log": ["stray", "line"] + [x for i in range(5) for x in [head.format(i), *[f"  File {i} {k}" * 9 for k in range(i * 4)]]],
        "b.log": [head.format("b")],
    }
    for name, values in texts.items():
        (tmp_path / name).write_text("\n".join(values) + "\n")
    want = {("a.log", -1, None, "stray"), ("a.log", -2, None, "line"), ("b.log", 0, "eval", "failed b")}
    place = 2
    for i in range(5):
        want.add(("a.log", place, "eval", "\n".join([f"failed {i}", *[f"  File {i} {k}" * 9 for k in range(i * 4)]])))
        place += 1 + i * 4
    for size in (10, 500, 1 << 20):
        rows = logs.read_log_records(spark, str(tmp_path), size).collect()
        assert len(rows) == len(want)
        assert {(r.path.rsplit("/", 1)[-1], r.record, r.script, r.message) for r in rows} == want


def test_files_of_arrow_file_systems_are_read_by_lines(tmp_path):
    """As remote stores are: through Arrow, here on a local folder."""
    import pyarrow.fs as fs

    class Mounted(Store):
        def _remote(self, uri):
            return fs.LocalFileSystem(), uri.split("://", 1)[1]

    store, root = Mounted(), f"far://{tmp_path}"
    store.write(f"{root}/x/a.txt", b"one\ntwo\nrest")
    store.append(f"{root}/x/a.txt", b"\n")
    with store.open(f"{root}/x/a.txt") as file:
        assert [line for _, line in lines.lines_of_range(file, 2, 9)] == [b"one\n", b"two\n"]
    store.move(f"{root}/x", f"{root}/y/z")
    assert store.exists(f"{root}/y/z/a.txt") and not store.exists(f"{root}/x")
    store.delete(f"{root}/y")
    assert not store.exists(f"{root}/y")


# The flat sink


def example_rows(spark, n=40):
    rows = [("java" if i % 4 else "python", f"r{i % 3}", f"p{i:03}", (i, i + 5), f"classe é{i}\n x", f"N{i}" if i % 5 else None,
             ["train", "valid", "train"][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, examples.SPLIT_SCHEMA).repartition(6), rows


def test_flat_sink_writes_one_file_per_language_and_split(spark, tmp_path):
    table, rows = example_rows(spark)
    path = str(tmp_path / "data")
    flat.write_flat(table, path)
    files = sorted(os.path.relpath(os.path.join(at, name), path) for at, _, names in os.walk(path) for name in names)
    assert files == [f"{lang}/{split}.jsonl" for lang in ("java", "python") for split in ("test", "train", "valid")]
    assert os.listdir(tmp_path) == ["data"] and os.path.getsize(f"{path}/java/test.jsonl") == 0
    told = [json.loads(line) for line in open(f"{path}/java/train.jsonl", encoding="utf-8")]
    assert [r["path"] for r in told] == [r["path"] for r in sorted(told, key=lambda r: (r["repo"], r["path"]))]
    assert list(told[0]) == ["language", "repo", "path", "class_span", "source", "target"] and "é" in open(f"{path}/java/train.jsonl", encoding="utf-8").read()
    back = examples.read_splits(spark, f"{path}/*", ("train", "valid", "test")).collect()
    assert {(r.language, r.path, tuple(r.class_span), r.source, r.target, r.split) for r in back} == {(r[0], r[2], *r[3:]) for r in rows}
    with pytest.raises(Exception, match="exists"):
        flat.write_flat(table, path)
    flat.write_flat(table.filter("language = 'java'"), path, overwrite=True)
    assert os.listdir(path) == ["java"] and os.listdir(tmp_path) == ["data"]


@pytest.mark.parametrize("bad", ["assert_true(path <> 'p017')", "language <> 'java' or path <> 'p017'"])
def test_flat_sink_leaves_nothing_after_a_failure(spark, tmp_path, bad):
    """A task that fails, and a language that cannot name a folder; an older table stays as it was."""
    table, _ = example_rows(spark)
    if bad.startswith("assert"):
        broken = table.withColumn("source", F.expr(f"concat(source, coalesce(cast({bad} as string), ''))"))
    else:
        broken = table.withColumn("language", F.when(F.expr(bad), F.col("language")).otherwise("../up"))
    with pytest.raises(Exception):
        flat.write_flat(broken, str(tmp_path / "new"))
    assert os.listdir(tmp_path) == []
    flat.write_flat(table, str(tmp_path / "old"))
    with pytest.raises(Exception):
        flat.write_flat(broken, str(tmp_path / "old"), overwrite=True)
    assert os.listdir(tmp_path) == ["old"] and sorted(os.listdir(tmp_path / "old")) == ["java", "python"]
    flat.write_flat(table.limit(0), str(tmp_path / "none"))
    assert os.listdir(tmp_path / "none") == []


def test_flat_sink_sorts_a_target_in_many_tasks(spark, tmp_path, monkeypatch):
    """One target of 8 MB: no task gets most of it, and its slices make one file in order."""
    rows = spark.range(8000).select(
        F.lit("java").alias("language"), F.lit("r").alias("repo"), F.format_string("p%05d", "id").alias("path"),
        F.expr("named_struct('start', id, 'end', id + 5)").alias("class_span"), F.expr("array_join(transform(sequence(0, 29), k -> md5(cast(id * 30 + k as string))), '')").alias("source"),
        F.lit("N").alias("target"), F.lit("train").alias("split"),
    )
    parts = []
    made = flat._put_together
    monkeypatch.setattr(flat, "_put_together", lambda spark, targets: (parts.extend(p for ps in targets.values() for p in ps), made(spark, targets)))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        flat.write_flat(rows, str(tmp_path / "data"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    told = [json.loads(line)["path"] for line in open(tmp_path / "data/java/train.jsonl")]
    assert told == [f"p{i:05}" for i in range(8000)] and len(parts) > 2
    assert max(part.size for part in parts) < sum(part.size for part in parts) / 2
    assert flat.slices([flat.Part("a", "b", 0, "x", 5), flat.Part("a", "b", 1, "y", 7)], 4) == [
        (0, [("x", 0, 4)]), (4, [("x", 4, 5), ("y", 0, 3)]), (8, [("y", 3, 7)]),
    ]
