import os

import pytest
from pyspark.sql import functions as F

from namewright.operators import ranking
from namewright.sources import examples, files, logs, repos, store
from namewright.sources.files import ingest_status, list_sources, scan_accounts, scan_sources
from namewright.streaming import jobs
from namewright.streaming.tail import LineTailReader, admitted, follow_lines


def put(root, path, content):
    place = os.path.join(root, path)
    os.makedirs(os.path.dirname(place), exist_ok=True)
    with open(place, "wb") as out:
        out.write(content)


def test_repo_list_keeps_order_and_duplicates(spark, tmp_path):
    put(tmp_path, "repos.txt", b"# list\nhttps://h/o/r.git\n\n  https://h/a/b/  \r\n #x\nhttps://h/o/r.git\n")
    rows = repos.read_repo_list(spark, str(tmp_path / "repos.txt")).orderBy("repo_ord").collect()
    assert [(r.repo_ord, r.repo) for r in rows] == [(0, "o__r"), (1, "a__b"), (2, "o__r")]


def test_scan_finds_hidden_paths_and_reads_leniently(spark, tmp_path):
    root = str(tmp_path / "one")
    sources = {
        "pkg/__init__.py": b"class A:\r\n  pass\r",
        "_priv/b.py": b"caf\xe9 \xff ok",
        "pkg/.hid/c.py": b"",
        ".d.java": "é\ufffd".encode(),
        "deep/er/x.cs": b"x",
    }
    for path, content in sources.items():
        put(root, path, content)
    put(root, "pkg/readme.md", b"no")
    os.symlink(root, os.path.join(root, "loop"))
    os.symlink(os.path.join(root, "nowhere"), os.path.join(root, "broken.py"))
    table = spark.createDataFrame(
        [(0, "one", root), (1, "gone", str(tmp_path / "gone"))], "repo_ord bigint, repo string, root string"
    )
    scanned = scan_sources(table)
    rows = {r.path: (r.language, r.content) for r in scanned.filter("language is not null").collect()}
    assert {r.path: r.error for r in scanned.filter("error is not null").collect()} == {
        "": "FileNotFoundError", "broken.py": "FileNotFoundError",
    }
    counts = {tuple(r) for r in scan_accounts(scanned).collect()}
    assert counts == {("one", 5, 1, 0), ("gone", 0, 0, 1)}
    assert rows == {
        "pkg/__init__.py": ("python", "class A:\n  pass\n"),
        "_priv/b.py": ("python", "caf  ok"),
        "pkg/.hid/c.py": ("python", ""),
        ".d.java": ("java", "é\ufffd"),
        "deep/er/x.cs": ("csharp", "x"),
        "broken.py": ("python", ""),
    }
    assert list_sources(table, ["java"]).filter("error is null").count() == 1
    by_uri = table.withColumn("root", F.concat(F.lit("file://"), "root"))
    for rounds in (1, 10_000):  # also where every task hands its folders on
        found = list_sources(by_uri, entries_at_once=rounds).filter("error is null").collect()
        assert {r.path for r in found} == set(rows)
        assert all(r.full_path == f"file://{root}/{r.path}" for r in found)
    status = {(r.repo, r.language): r.ok for r in ingest_status(table, ["java"]).collect()}
    assert status == {("one", "java"): True, ("gone", "java"): False}


def test_large_folders_are_listed_in_blocks(spark, tmp_path, monkeypatch):
    """No frame of a task holds more than a block of a folder's entries; nothing is lost between blocks."""
    for i in range(95):
        put(tmp_path, f"one/f{i:02}.py", b"x")
    put(tmp_path, "one/sub/g.py", b"x")
    monkeypatch.setattr(files, "_ENTRIES_PER_BATCH", 10)
    taken = []
    repos_table = spark.createDataFrame([(0, "one", str(tmp_path / "one"))], "repo_ord bigint, repo string, root string")

    class Seen:
        """Runs a task's function here, to look at the frames it makes."""

        def __init__(self, frame):
            self.frame = frame

        def __getattr__(self, name):
            return getattr(self.frame, name)

        def withColumn(self, *args):
            return Seen(self.frame.withColumn(*args))

        def repartition(self, *args):
            return Seen(self.frame)

        def mapInPandas(self, function, schema):
            taken.extend(len(frame) for frame in function(iter([self.frame.toPandas()])))
            return self.frame.mapInPandas(function, schema)

    found = list_sources(Seen(repos_table)).filter("error is null").collect()
    assert sorted(r.path for r in found) == [*(f"f{i:02}.py" for i in range(95)), "sub/g.py"]
    assert sum(taken) == 96 and max(taken) < 20


def test_strict_and_tolerant_scans(spark, tmp_path):
    good = '{"language":"java","repo":"r","path":"p","class_span":{"start":0,"end":5},"source":"é","target":"T"}\n'
    put(tmp_path, "x.jsonl", (good + "\n" + '{"language": "ja\n' + good).encode())
    path = str(tmp_path / "x.jsonl")
    tolerant = examples.read_examples(spark, path, tolerant=True)
    assert [(r.source, r.class_span.end) for r in tolerant.collect()] == [("é", 5)] * 2
    assert tolerant.select("language").count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        examples.read_examples(spark, path).collect()


def test_splits_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("java", "train", "é"), ("java", "valid", "b"), ("python", "test", "c")], "language string, split string, source string"
    )
    counts = {r.split: r["count"] for r in examples.export_splits(rows, str(tmp_path / "hub")).collect()}
    assert counts == {"train": 1, "validation": 1, "test": 1}
    text = "".join(open(os.path.join(d, f), encoding="utf-8").read() for d, _, fs in os.walk(tmp_path) for f in fs if f.endswith(".json"))
    assert "é" in text
    hub = spark.read.schema("source string, language string, split string").json(str(tmp_path / "hub"))
    back = examples.import_splits(hub, str(tmp_path / "local"), splits=["validation"])
    assert [(r.split, r["count"]) for r in back.collect()] == [("valid", 1)]


CSV = b"loss,epoch,step\n0.5,0.1,10\n0.3,20\nloss,epoch,step\n0.4,0.2,30\n1,2,3,40\n"
LAYOUTS = [["loss", "epoch", "step"], ["eval_loss", "step"]]


def test_training_log_with_changing_columns(spark, tmp_path):
    put(tmp_path, "run1/training_log.csv", CSV)
    rows = logs.read_training_log(spark, str(tmp_path / "run1"), LAYOUTS)
    got = sorted((r.run, r.step, r.metric, r.value) for r in rows.collect())
    assert got == [
        ("run1", 10, "epoch", 0.1), ("run1", 10, "loss", 0.5), ("run1", 20, "eval_loss", 0.3),
        ("run1", 30, "epoch", 0.2), ("run1", 30, "loss", 0.4),
        ("run1", 40, "column_1", 1.0), ("run1", 40, "column_2", 2.0), ("run1", 40, "column_3", 3.0),
    ]
    placed = logs.read_training_log(spark, str(tmp_path / "run1"), LAYOUTS, with_position=True)
    losses = ranking.position_rank(placed.filter("metric = 'loss'"), "line", ["run"]).orderBy("rank").collect()
    assert [(r["rank"], r.value) for r in losses] == [(1, 0.5), (2, 0.4)]


LOG = (
    b"2031-05-06 07:08:09 - score_run - INFO - Using device: X - Y\n"
    b"2031-05-07 00:00:00 - train - ERROR - Failed\n"
    b"Traceback: some Error\n"
    b"2031-05-07 00:00:01 - train - INFO - completed\n"
)


def test_run_logs(spark, tmp_path):
    put(tmp_path, "score_run_20310506_070809.log", LOG)
    rows = logs.read_run_logs(spark, str(tmp_path))
    first = rows.filter("message like 'Using%'").first()
    assert (first.log_script, str(first.started), str(first.ts)) == ("score_run", "2031-05-06 07:08:09", "2031-05-06 07:08:09")
    assert (first.script, first.level, first.message) == ("score_run", "INFO", "Using device: X - Y")
    assert sorted(r.message for r in logs.error_lines(rows).collect()) == ["Failed", "Traceback: some Error"]
    assert logs.select_logs(rows, day="2031-05-07").count() == 2
    assert logs.select_logs(rows, script="score_").count() == 1
    assert logs.select_logs(rows, phrase="completed").count() == 1


def test_stream_of_training_logs_restarts_without_double_counting(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    put(source, "run1/b.csv", b"0.9,5\n0.2,7\n")
    log = jobs.follow_training_log(spark, f"{source}/*", LAYOUTS)
    best = jobs.best_so_far(log)
    jobs.keep_latest(best, out, checkpoint).awaitTermination()
    first = jobs.read_latest(spark, out, best.schema).collect()
    assert [(r.run, r.best_step, r.best_value, r.final_step) for r in first] == [("run1", 7, 0.2, 7)]
    put(source, "run2/a.csv", b"0.5,3\n")
    put(source, "run1/c.csv", b"loss,epoch,step\n0.1,0.2,0.3,9\n0.2,6\n")
    best = jobs.best_so_far(jobs.follow_training_log(spark, f"{source}/*", LAYOUTS))
    jobs.keep_latest(best, out, checkpoint).awaitTermination()
    rows = {r.run: (r.best_step, r.best_value, r.final_step) for r in jobs.read_latest(spark, out, best.schema).collect()}
    assert rows == {"run1": (6, 0.2, 9), "run2": (3, 0.5, 3)}
    batch = logs.read_training_log(spark, f"{source}/*", LAYOUTS)
    assert {r.run: r.best_step for r in jobs.best_so_far(batch).collect()} == {"run1": 6, "run2": 3}


def test_stream_of_errors_appends_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    put(source, "a.log", LOG)
    for expected in (2, 2, 4):
        if expected == 4:
            put(source, "b.log", LOG)
        jobs.append_log_events(jobs.follow_errors(spark, source), out, checkpoint).awaitTermination()
        assert spark.read.parquet(out).count() == expected


def test_store_writes_below_any_root(tmp_path):
    files = store.Store()
    for root in (str(tmp_path / "a"), f"file:{tmp_path}/b", f"file://{tmp_path}/c"):
        files.write(f"{root}/_x/.y", b"1\n")
        files.write(f"{root}/_x/.y", b"2\n")
        with files.open(f"{root}/_x/.y") as file:
            assert file.read() == b"2\n"
    assert sorted(os.listdir(tmp_path)) == ["a", "b", "c"]


def test_a_faulty_store_ends_the_scan():
    tries = []

    def fail():
        tries.append(1)
        raise TimeoutError

    with pytest.raises(TimeoutError):
        store.patiently(fail)
    assert len(tries) == 3


def test_a_stream_follows_files_that_grow(spark, tmp_path):
    """Each finished line comes once, across restarts and however a file is cut; a rewritten file is an error."""
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def run(range_bytes):
        lines = follow_lines(spark, f"{source}/*/log*", rangeBytes=range_bytes)
        jobs.append_log_events(lines.select("value"), out, checkpoint).awaitTermination()
        return sorted(r.value for r in spark.read.parquet(out).collect())

    put(source, "a/log1", b"one\ntwo\r\nthr")
    put(source, "a/other", b"no\n")
    put(source, "a/.log", b"no\n")
    assert run(3) == ["one", "two"]
    with open(os.path.join(source, "a/log1"), "ab") as log:
        log.write("ee\n\nélan\n".encode())
    put(source, "b/log2", b"x" * 100 + b"\nlast\n")
    want = sorted(["one", "two", "three", "", "élan", "x" * 100, "last"])
    assert run(7) == want == run(1)
    put(source, "a/log1", b"one\n")
    with pytest.raises(Exception, match="shorter"):
        run(7)


def test_shares_of_a_bounded_batch():
    sizes = {"a": 100, "b": 3, "c": 50, "d": 7}
    assert admitted({"d": 7}, sizes, 23) == {"a": 10, "b": 3, "c": 10, "d": 7}
    assert admitted({}, {"a": 5, "b": 5, "c": 5}, 2) == {"a": 1, "b": 1}
    assert admitted({"a": 5, "gone": 4}, {"a": 4}, 10) == {"a": 4}
    reached, steps = {}, 0
    while reached != sizes:
        after = admitted(reached, sizes, 9)
        assert 0 < sum(after.values()) - sum(reached.values()) <= 9
        reached, steps = after, steps + 1
    assert steps == 18


def test_a_bounded_stream_works_off_a_backlog(spark, tmp_path):
    """Batches are small, restarts go on where the last batch ended, also within a line, and the end is frozen."""
    source, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def run(limit):
        lines = follow_lines(spark, source, bytesPerTrigger=limit, untilNow=True)
        query = jobs.append_bounded(lines.select("value"), out, checkpoint)
        batches = {p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]}
        return batches, sorted(r.value for r in spark.read.parquet(out).collect())

    first = [f"line {n}" for n in range(20)]
    put(source, "long", "".join(f"{line}\n" for line in first).encode() + b"begun ")
    put(source, "short", b"one\n")
    batches, values = run(48)
    assert values == sorted([*first, "one"])
    assert len(batches) >= 4 and max(batches.values()) <= 8
    with open(os.path.join(source, "long"), "ab") as log:
        log.write(b"and ended, " + b"x" * 60 + b"\nlast\n")
    put(source, "new", b"two\nthree\n")
    want = sorted([*first, "one", "two", "three", "begun and ended, " + "x" * 60, "last"])
    assert run(40)[1] == want
    assert run(1 << 20) == ({}, want)


def test_a_log_that_goes_with_lines_unread_ends_a_bounded_stream(tmp_path):
    put(tmp_path, "a", b"one\ntwo\n")
    reader = LineTailReader(str(tmp_path), 64, 4)
    offset = reader.latestOffset()
    assert offset == reader.latestOffset() and list(offset.values()) == [4]
    reader.partitions({}, offset)
    (tmp_path / "a").rename(tmp_path / ".a")
    with pytest.raises(ValueError, match="gone"):
        reader.latestOffset()
    with pytest.raises(ValueError):
        LineTailReader(str(tmp_path), 64, 0)


def test_callback_per_batch_of_log_events(spark, tmp_path):
    put(tmp_path / "in", "run1/a.csv", b"0.5,0.1,10\n")
    seen = []
    log = jobs.follow_training_log(spark, f"{tmp_path}/in/*", LAYOUTS)
    jobs.on_log_events(log, lambda rows, batch: seen.append((batch, rows.count())), str(tmp_path / "c")).awaitTermination()
    assert seen == [(0, 2)]


def test_a_stream_without_data_has_an_empty_result(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    best = jobs.best_so_far(jobs.follow_training_log(spark, str(tmp_path / "in"), LAYOUTS))
    jobs.keep_latest(best, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert jobs.read_latest(spark, str(tmp_path / "out"), best.schema).count() == 0


def test_flat_splits_and_missing_ones(spark, tmp_path):
    row = '{"language": "java", "repo": "r", "path": "p", "source": "s", "target": "T"}\n'
    for name, lines in {"train": 3, "valid": 2, "test": 1}.items():
        put(tmp_path, f"java/{name}.jsonl", (row * lines).encode())
    root = str(tmp_path / "java")
    assert examples.read_examples(spark, root, split="valid").count() == 2
    assert sorted(r.split for r in examples.read_splits(spark, root).collect()) == ["train"] * 3 + ["valid"] * 2
    with pytest.raises(ValueError):
        examples.read_examples(spark, root, split="dev")


def test_lists_follow_each_other(spark, tmp_path):
    put(tmp_path, "lists/a.txt", b"https://h/o/one\nhttps://h/o/two\n")
    put(tmp_path, "lists/b.txt", b"https://h/o/three\n")
    listed = repos.read_repo_list(spark, str(tmp_path / "lists")).orderBy("repo_ord").collect()
    assert [r.repo for r in listed] == ["o__one", "o__two", "o__three"]


def test_layouts_of_one_length(spark):
    lines = spark.createDataFrame([("r", "1,2")], "run string, value string")
    with pytest.raises(ValueError):
        logs.training_log_rows(lines, [["loss", "step"], ["rate", "step"]])
