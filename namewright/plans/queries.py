"""The registered queries: each takes a session and the folder of the given tables."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, prompts, text
from ..functions.declarations import mask_header as masked_header
from ..operators import batches, classification, examples as rows_of, extract, generations, lenient, profile
from ..operators import ranking, runs, scoring, views
from ..operators.aggregates import aggregate_rows, character_fscore
from ..operators.dedup import first_of_copies
from ..operators.inference import encode_batch, predict_batch, prediction_accounts
from ..operators.resume import InferenceStopped, resumed_inference
from ..operators.sketches import heavy_labels as heaviest, split_overlap as overlap, value_sketches
from ..operators.sqlfunctions import register_extract_classes
from ..session import shared_folder, stage
from ..sources import examples as example_files
from ..sources import logs
from ..sources.flat import write_flat
from ..sources.files import scan_accounts, scan_sources
from ..sources.repos import read_repo_list
from ..sources.results import summary_row, write_metrics, write_results, write_summary
from ..sources.store import Store
from ..streaming import jobs
from ..streaming.align import align_streams
from . import build, tables

K = 3


def _joined(values: Column) -> Column:
    """An array as one line of text, for comparison across engines."""
    return F.array_join(values.cast("array<string>"), ",")


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, to compare across engines."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, 6) for name in doubles})


def _examples(spark: SparkSession, sf_dir: str, mask: bool = True) -> DataFrame:
    return extract.extract_examples(tables.code_files(spark, sf_dir), mask=mask)


def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split examples without their text."""
    return build.split_of_first(_examples(spark, sf_dir), carry=("target",))


# Extraction


def _extract(language: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        files = tables.code_files(spark, sf_dir).filter(F.col("language") == language)
        return extract.extract_declarations(files).select(
            "repo", "path", "span_start", "span_end", "target", "snippet"
        )

    return query


def extract_sql(spark, sf_dir):
    """All declarations through the SQL function."""
    register_extract_classes(spark)
    files = tables.code_files(spark, sf_dir)
    found = files.select("language", "path", F.expr("extract_classes(content, language)").alias("found"))
    return found.select("language", "path", F.inline("found"))


def examples_masked(spark, sf_dir):
    return _examples(spark, sf_dir).select("language", "repo", "path", "span_start", "span_end", "source", "target")


def examples_unmasked(spark, sf_dir):
    """The mask is a choice: here names stay, unlike in the headers that are masked afterwards."""
    found = rows_of.mask_sources(_examples(spark, sf_dir, mask=False), mask=False)
    return found.select("path", "span_start", "source", "target")


def sample_ids(spark, sf_dir):
    return _examples(spark, sf_dir).select("path", "span_start", "sample_id")


def repo_list(spark, sf_dir):
    """Two lists with comments and blank lines, one per parity of the page, read in the order of their names."""
    folder = shared_folder(spark, "lists")
    pages = tables.table(spark, sf_dir, "pages").select("page_id", "url")
    entry = F.concat(F.lit("# page "), F.col("page_id").cast("string"), F.lit("\n\n  "), F.col("url"), F.lit(" "))
    for name, rest in {"a": 0, "b": 1}.items():
        listed = pages.filter(F.col("page_id") % 2 == rest).repartitionByRange("page_id").sortWithinPartitions("page_id")
        listed.select(entry.alias("value")).write.text(f"{folder}/{name}")
    return read_repo_list(spark, f"{folder}/*")


def mask_header(spark, sf_dir):
    files = tables.code_files(spark, sf_dir)
    return files.select("language", "path", masked_header(F.col("content"), F.col("language")).alias("masked"))


def repo_slug(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.repo_slug(F.col("url")).alias("repo"))


def decode_source(spark, sf_dir):
    """Line ends of every kind and a byte that is no UTF-8 are put into each text first."""
    docs = tables.documents(spark, sf_dir, "text")
    raw = F.concat(F.encode(F.replace("text", F.lit("\n"), F.lit("\r\n")), "utf-8"), F.expr("X'0DFF41'"))
    return docs.select("doc_id", text.decode_source(raw).alias("content"))


def text_columns(spark, sf_dir):
    docs = tables.documents(spark, sf_dir, "text")
    body = F.col("text")
    return docs.select(
        "doc_id",
        text.first_token(body).alias("first_token"),
        text.count_lines(body).cast("bigint").alias("lines"),
        text.preview(body).alias("preview"),
        text.normalize_source(body).alias("normalized"),
        text.language_of(F.concat(F.lit("dir/f"), F.col("doc_id").cast("string"), F.expr(
            "case doc_id % 4 when 0 then '.py' when 1 then '.java' when 2 then '.cs' else '.txt' end"
        ))).alias("language"),
    )


def clean_examples(spark, sf_dir):
    docs = tables.documents(spark, sf_dir, "text", "source", "lang")
    raw = docs.select(
        "doc_id",
        F.expr("case lang when 'fr' then '' when 'de' then null else text end").alias("source"),
        F.expr("case when doc_id % 3 = 0 then 'N' || cast(doc_id as string) end").alias("class_name"),
        F.expr("case when doc_id % 3 = 1 then 'L' || cast(doc_id as string) end").alias("label"),
        F.expr("case when doc_id % 2 = 0 then source end").alias("repo"),
    )
    cleaned = rows_of.with_defaults(rows_of.drop_empty(rows_of.resolve_label(raw)))
    return cleaned.select("doc_id", "source", "target", "language", "repo")


def _prompt(render):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _examples(spark, sf_dir).select("path", "span_start", render().alias("prompt"))

    return query


# De-duplication and splits


def dedup_examples(spark, sf_dir):
    kept = build.unique_examples(_examples(spark, sf_dir))
    return kept.select("language", "repo", "path", "span_start", "target", "source")


def _first_documents(spark, sf_dir):
    docs = tables.documents(spark, sf_dir, "text")
    keyed = docs.select("doc_id", F.sha2(text.normalize_source(F.col("text")), 256).alias("dedup_key"))
    return first_of_copies(keyed, "dedup_key", ["doc_id"], within=())


def dedup_documents(spark, sf_dir):
    return _first_documents(spark, sf_dir).select("doc_id", "dedup_key")


def split_documents(spark, sf_dir):
    split = ranking.assign_split(stage(_first_documents(spark, sf_dir), "first"), "dedup_key", within=())
    return split.select("doc_id", "split")


def seeded_order(spark, sf_dir):
    ranked = ranking.seeded_rank(stage(_first_documents(spark, sf_dir), "first"), "dedup_key")
    return ranking.with_batch(ranked, 16).select("doc_id", F.col("rank").cast("bigint").alias("rank"), "batch_id")


def split_sizes(spark, sf_dir):
    """How large are the splits of each language? Files to counts in one plan."""
    chosen = build.split_of_first(_examples(spark, sf_dir))
    return chosen.groupBy("language", "split").agg(F.count(F.lit(1)).alias("count"))


def split_assignment(spark, sf_dir):
    return _splits(spark, sf_dir).select("language", "repo", "path", "span_start", "target", "split")


def batch_numbers(spark, sf_dir):
    """Row numbers per source in the order of the ids, in ranges of 1,000 ids."""
    docs = tables.documents(spark, sf_dir, "source")
    return ranking.position_rank(docs, "doc_id", ["source"], width=1000).select("source", "doc_id", "rank")


# Accounts


def dataset_stats(spark, sf_dir):
    return profile.split_stats(_splits(spark, sf_dir))


def language_histogram(spark, sf_dir):
    return profile.language_histogram(_splits(spark, sf_dir))


def split_percent(spark, sf_dir):
    return profile.dataset_totals(_splits(spark, sf_dir))


def label_profile(spark, sf_dir):
    return profile.label_profile(_splits(spark, sf_dir))


def top_labels(spark, sf_dir):
    return profile.top_labels(tables.gold(_examples(spark, sf_dir)), ["sample_id"])


def heavy_labels(spark, sf_dir):
    """The same as top_labels, without a shuffle of all labels."""
    gold = stage(tables.gold(_examples(spark, sf_dir)).select("target", "sample_id"), "gold")
    return heaviest(gold, ["sample_id"])


def split_overlap(spark, sf_dir):
    """Repositories in two splits, from stored sketches of each split and language."""
    sketches = stage(value_sketches(_splits(spark, sf_dir), ["split", "language"]), "sketches")
    return overlap(sketches)


def build_accounting(spark, sf_dir):
    return profile.repo_accounts(_examples(spark, sf_dir))


def language_accounting(spark, sf_dir):
    found = _examples(spark, sf_dir).select("language", "dedup_key", *extract.EXAMPLE_ORDER)
    found = stage(found, "found")
    first = first_of_copies(found, "dedup_key", extract.EXAMPLE_ORDER)
    return profile.language_accounts(found, first)


def _named_splits(spark, sf_dir, second: str):
    docs = tables.documents(spark, sf_dir, "lang")
    return docs.select("doc_id", F.expr(f"case lang when 'es' then '{second}' else 'train' end").alias("split"))


def missing_splits(spark, sf_dir):
    return profile.missing_splits(_named_splits(spark, sf_dir, "valid"))


def split_rename(spark, sf_dir):
    renamed = profile.rename_splits(_named_splits(spark, sf_dir, "validation"), to_published=False)
    return renamed.groupBy("split").agg(F.count(F.lit(1)).alias("count"))


def split_rename_selected(spark, sf_dir):
    chosen = profile.rename_splits(_named_splits(spark, sf_dir, "valid"), to_published=True, splits=["valid"])
    return chosen.select("doc_id", "split")


def planned_steps(spark, sf_dir):
    sizes = _named_splits(spark, sf_dir, "valid").groupBy("split").agg(F.count(F.lit(1)).alias("count"))
    return batches.planned_steps(sizes, batch_size=10, grad_accum=4, epochs=5)


# Generated text


def _completion(clean):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = tables.completions(_examples(spark, sf_dir))
        return raw.select("sample_id", F.col("beam").cast("bigint").alias("beam"), clean(F.col("raw")).alias("text"))

    return query


def _unique(spark, sf_dir, drop_empty):
    raw = tables.completions(_examples(spark, sf_dir))
    cleaned = raw.withColumn("text", prompts.completion_token(F.col("raw")))
    grouped = generations.group_beams(cleaned, K)
    return generations.unique_predictions(grouped, K, drop_empty)


def topk_unique(spark, sf_dir):
    return _unique(spark, sf_dir, True).select("sample_id", F.array_join("predictions", ",").alias("predictions"))


def best_alternatives(spark, sf_dir):
    best = generations.best_and_alternatives(_unique(spark, sf_dir, False))
    return best.select("sample_id", "best", "alts")


def beam_ranks(spark, sf_dir):
    beams = tables.beams(_examples(spark, sf_dir)).withColumn("score", -F.col("beam"))
    ranked = generations.rank_beams(beams, K, order="score")
    return ranked.select("sample_id", "text", F.col("rank").cast("bigint").alias("rank"))


# Scores


def _grouped(spark, sf_dir):
    beams = stage(tables.beams(_examples(spark, sf_dir), "language", "target"), "beams")
    lists = generations.group_beams(beams, K)
    return scoring.align_predictions(tables.gold(beams.filter("beam = 1")), lists, K)


def _scored(spark, sf_dir):
    return scoring.score_rows(_grouped(spark, sf_dir), K)


def eval_rows(spark, sf_dir):
    return _scored(spark, sf_dir).select(
        "sample_id",
        "target",
        F.array_join("predictions", ",").alias("predictions"),
        "top_prediction",
        "exact_match",
        "exact_match_ci",
        "in_topk",
        F.col("edit_distance").cast("bigint").alias("edit_distance"),
    )


def eval_headline(spark, sf_dir):
    return _rounded(scoring.headline_metrics(_scored(spark, sf_dir), K)).drop("k", "device", "batch_size")


def eval_fallback(spark, sf_dir):
    """No beams at all for the examples of one language."""
    found = _examples(spark, sf_dir)
    lists = generations.group_beams(tables.beams(found.filter("language <> 'java'")), K)
    scored = scoring.score_rows(scoring.align_predictions(tables.gold(found), lists, K), K, "strip")
    return _rounded(scoring.headline_metrics(scored, K)).drop("k", "device", "batch_size")


def edit_distance_stats(spark, sf_dir):
    return _rounded(scoring.edit_distance_stats(_scored(spark, sf_dir)))


def _compared(spark, sf_dir):
    rows = tables.prediction_lists(_examples(spark, sf_dir))
    rows = rows.withColumn("predicted", F.element_at("predictions", 1))
    return lenient.compare_leniently(rows.withColumnRenamed("predictions", "topk_predictions"))


def test_mode_metrics(spark, sf_dir):
    return _rounded(lenient.report_metrics(_compared(spark, sf_dir), "sample_id", K)).drop("k")


def class_distribution(spark, sf_dir):
    return lenient.class_distribution(_compared(spark, sf_dir))


def language_stats(spark, sf_dir):
    return _rounded(lenient.language_stats(_compared(spark, sf_dir), overall=True))


def caller_metric(spark, sf_dir):
    """A caller's own score: do target and answer begin with the same two letters?"""

    def same_start(target, top):
        return (target.str[:2] == top.str[:2]).astype(float)

    metrics = {"same_start": (same_start, ["target", "top_prediction"])}
    return _rounded(scoring.caller_metrics(_scored(spark, sf_dir), metrics, by=["language"]))


def caller_fmeasure(spark, sf_dir):
    """A caller's aggregate that is no mean of rows: micro F1 over the characters of target and answer."""
    scored = _scored(spark, sf_dir)
    return _rounded(aggregate_rows(scored, character_fscore(), ["target", "top_prediction"], by=["language"]))


def summary_sink(spark, sf_dir):
    """The nested summary of a test, written and read again."""
    compared = _compared(spark, sf_dir)
    job = dict(model_path="m", test_data_path="t", device="cpu", batch_size=8, elapsed_time_seconds=90.0)
    summary = summary_row(
        lenient.report_metrics(compared, "sample_id", K),
        classification.weighted_scores(compared, "truth", "guess"),
        scoring.edit_distance_stats(compared),
        lenient.class_distribution(compared),
        "20240102_030405",
        **job,
    )
    tables_of = {"per_language": lenient.language_stats(compared)}
    folder = write_summary(summary, tables_of, shared_folder(spark, "tests"), "20240102_030405")
    back = spark.read.schema(summary.schema).json(f"{folder}/summary")
    flat = back.select(
        "timestamp", "model_path", "performance_metrics.*",
        *[f"traditional_metrics.{name}" for name in ("precision", "recall", "f1_score", "correct_predictions",
                                                     "class_distribution")],
        *[F.col(f"edit_distance_stats.{name}").alias(f"distance_{name}") for name in ("min", "max", "mean", "median")],
    )
    return _rounded(flat).drop("k", "batch_size")


def _label_pairs(spark, sf_dir):
    return tables.table(spark, sf_dir, "labels").select("quality", "toxic")


def classification_report(spark, sf_dir):
    return _rounded(classification.classification_report(_label_pairs(spark, sf_dir), "quality", "toxic"))


def weighted_prf(spark, sf_dir):
    return _rounded(classification.weighted_scores(_label_pairs(spark, sf_dir), "quality", "toxic"))


def name_report(spark, sf_dir):
    """The report over names: one label per target and prediction."""
    return _rounded(classification.classification_report(_compared(spark, sf_dir), "truth", "guess"))


def metrics_display(spark, sf_dir):
    metrics = scoring.headline_metrics(_scored(spark, sf_dir), K)
    shown = views.metrics_display(scoring.with_throughput(metrics, 90.0))
    return shown.select("label", "value")


def sample_view(spark, sf_dir):
    view = views.sample_view(_scored(spark, sf_dir), ["sample_id"])
    return view.withColumn("k", F.col("k").cast("bigint"))


def first_samples(spark, sf_dir):
    return rows_of.first_samples(tables.gold(_examples(spark, sf_dir)), 100, ["sample_id"])


def batch_inference(spark, sf_dir):
    """A stand-in for a model answers from the prompt alone."""

    def make_predict():
        def predict(asked):
            answers = []
            for prompt in asked:
                lines = prompt.split("\n")
                answers.append(["Name: " + lines[2].strip(" ").split(" ")[0], str(len(prompt))])
            return answers

        return predict

    found = _examples(spark, sf_dir)
    asked = predict_batch(found, prompts.render_prompt(F.col("source"), "seq2seq"), make_predict, k=2)
    cleaned = asked.withColumn("predictions", F.transform("predictions", prompts.completion_identifier))
    named = generations.attach_predictions(generations.unique_predictions(cleaned, 2, drop_empty=True))
    return named.select("path", "span_start", "target", "predicted_name", "correct")


def failed_batches(spark, sf_dir):
    """A model that breaks on some texts, asked one by one: the broken ones are counted, not scored as empty."""

    def make_predict():
        def predict(asked):
            if len(asked[0]) % 3 == 0:
                raise RuntimeError("no answer")
            return [[asked[0]]]

        return predict

    docs = tables.documents(spark, sf_dir, "text")
    return prediction_accounts(predict_batch(docs, F.col("text"), make_predict, k=1, batch_size=1))


def resumed_answers(spark, sf_dir):
    """A model that dies on some texts in its first job and is asked again; every text is answered once in all."""
    folder = shared_folder(spark, "answers")
    docs = tables.documents(spark, sf_dir, "text")

    def model(dies):
        def make_predict():
            def predict(asked):
                if dies and len(asked[0]) % 50 == 0:
                    raise RuntimeError("out of memory")
                return [[text[:20], str(len(text))] for text in asked]

            return predict

        return make_predict

    try:
        resumed_inference(docs, F.col("text"), model(True), folder, "doc_id", batch_size=1, rows_per_task=50)
    except InferenceStopped:
        pass
    answered = resumed_inference(docs, F.col("text"), model(False), folder, "doc_id")
    asked = spark.read.parquet(folder).filter("error is null").groupBy("key").agg(F.count("*").alias("asked"))
    met = answered.join(asked, F.col("doc_id") == F.col("key"))
    return met.select("doc_id", F.get("predictions", F.lit(0)).alias("first"), F.get("predictions", F.lit(1)).alias("second"), "asked")


def batch_accuracy(spark, sf_dir):
    rows = tables.prediction_lists(_examples(spark, sf_dir))
    return _rounded(generations.batch_accuracy(generations.attach_predictions(rows)))


# Training arrays


def encode_texts(spark, sf_dir):
    """A caller's tokenizer: here the code points of the target names."""

    def make_encode():
        return lambda texts: [[ord(letter) for letter in text] for text in texts]

    rows = tables.gold(_examples(spark, sf_dir))
    encoded = encode_batch(rows, F.col("target"), make_encode)
    return encoded.select("sample_id", _joined(F.col("input_ids")).alias("input_ids"))


def row_accounting(spark, sf_dir):
    """Rows counted while they pass on to a sink."""
    seen = Observation()
    batches.observe_rows(batches.causal_labels(tables.tokens(spark, sf_dir)), seen).write.format("noop").mode(
        "overwrite"
    ).save()
    return spark.createDataFrame([(seen.get["rows"],)], "rows bigint")


def label_mask(spark, sf_dir):
    rows = batches.causal_labels(tables.tokens(spark, sf_dir), max_length=512)
    return rows.select(
        "sample_id", _joined(F.col("input_ids")).alias("input_ids"), _joined(F.col("labels")).alias("labels")
    )


def seq2seq_arrays(spark, sf_dir):
    rows = tables.tokens(spark, sf_dir).select(
        "sample_id", F.col("input_ids").alias("prompt_ids"), F.reverse("input_ids").alias("target_ids")
    )
    pair = batches.seq2seq_pair(rows)
    return pair.select(
        "sample_id", _joined(F.col("input_ids")).alias("input_ids"), _joined(F.col("labels")).alias("labels")
    )


def _padded_rows(rows: DataFrame, *keys: str) -> DataFrame:
    lists = [_joined(F.col(name)).alias(name) for name in ("input_ids", "attention_mask", "labels")]
    return rows.select("sample_id", *keys, *lists)


def collate_batches(spark, sf_dir):
    rows = batches.causal_labels(tables.tokens(spark, sf_dir))
    return _padded_rows(batches.collate(batches.form_batches(rows, "sample_id", 8)), "batch_id")


def pad_fixed(spark, sf_dir):
    rows = batches.causal_labels(tables.tokens(spark, sf_dir))
    return _padded_rows(batches.pad_to(rows, 512))


def token_accuracy(spark, sf_dir):
    rows = batches.causal_labels(tables.tokens(spark, sf_dir))
    guess = F.transform("input_ids", lambda x, i: F.when(i % 3 == 0, x + 1).otherwise(x))
    return _rounded(batches.token_accuracy(rows.withColumn("predicted_ids", guess)))


def argmax(spark, sf_dir):
    vectors = tables.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    halves = F.array(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32))
    return vectors.select(
        "vec_id",
        arrays.argmax(F.col("embedding")).cast("bigint").alias("place"),
        _joined(arrays.argmax_each(halves)).alias("halves"),
    )


# Runs and logs


def _training_log(spark, sf_dir):
    return tables.training_log(tables.table(spark, sf_dir, "events"))


def best_checkpoint(spark, sf_dir):
    return runs.checkpoint_summary(_training_log(spark, sf_dir))


def loss_curve(spark, sf_dir):
    return logs.loss_curve(_training_log(spark, sf_dir), metrics=("loss", "eval_loss"))


def curve_positions(spark, sf_dir):
    """The x-axis of logs without a step: the row's number in its run."""
    rows = _training_log(spark, sf_dir).select("run", F.col("step").alias("line"), "metric", "value")
    return ranking.position_rank(rows, "line", ["run"]).select(
        "run", "line", (F.col("rank") - 1).cast("bigint").alias("x"), "value"
    )


LAYOUTS = [["loss", "epoch", "step"], ["eval_loss", "step"]]


def _training_lines(spark, sf_dir, *columns):
    """Loss and evaluation rows of different width under one repeated header."""
    events = tables.table(spark, sf_dir, "events").filter("event_type in ('view', 'error', 'click')")
    line = F.expr("""case event_type
        when 'view' then concat(cast(value as string), ',0.5,', cast(event_id as string))
        when 'error' then concat(cast(value as string), ',', cast(event_id as string))
        else 'loss,epoch,step' end""")
    run = F.expr("'run' || cast(user_id % 3 as string)")
    return events.select(run.alias("run"), line.alias("value"), (F.col("event_id") % 2).alias("part"), *columns)


def training_log_csv(spark, sf_dir):
    return logs.training_log_rows(_training_lines(spark, sf_dir).drop("part"), LAYOUTS)


def _folder_run() -> Column:
    """Runs lie in folders named run=..."""
    return F.regexp_replace("run", "\\Arun=", "")


def training_log_files(spark, sf_dir):
    """The same rows from files, one folder per run."""
    folder = shared_folder(spark, "logs")
    _training_lines(spark, sf_dir).select("run", "value").write.partitionBy("run").text(folder)
    return logs.read_training_log(spark, f"{folder}/*", LAYOUTS).withColumn("run", _folder_run())


def _written_in_order(rows: DataFrame, key: str, folder: str) -> None:
    """One log file per run, its lines (value) in the order of ``key``."""
    sorted_rows = rows.repartition("run").sortWithinPartitions("run", key)
    sorted_rows.select("run", "value").write.partitionBy("run").text(folder)


def log_positions(spark, sf_dir):
    """The rows of written training logs with their line numbers, read by ranges of 64 KB."""
    folder = shared_folder(spark, "logs")
    _written_in_order(_training_lines(spark, sf_dir, "event_id"), "event_id", folder)
    rows = logs.read_training_log(spark, f"{folder}/*", LAYOUTS, with_position=True, range_bytes=1 << 16)
    return rows.withColumn("run", _folder_run())


def log_records(spark, sf_dir):
    """Run logs with tracebacks, written and read by ranges of 64 KB: a record is all lines up to the next head."""
    folder = shared_folder(spark, "logs")
    events = tables.table(spark, sf_dir, "events")
    trace = F.expr("case when event_id % 3 = 0 then concat(chr(10), 'Traceback: ', event_type, chr(10), '  in line ', cast(event_id as string)) else '' end")
    lines = tables.log_lines(events.withColumn("trace", trace), "trace as more", "event_id as place", "user_id % 5 as run")
    _written_in_order(lines.withColumn("value", F.concat("value", "more")), "place", folder)
    found = logs.read_log_records(spark, folder, range_bytes=1 << 16)
    run = F.regexp_extract("path", "run=([0-9]+)/", 1).cast("bigint").alias("run")
    return found.select(run, "record", F.col("ts").cast("string").alias("ts"), "script", "level", "message")


def _artifacts(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    path = F.concat(F.lit("out/checkpoint-"), F.col("event_id").cast("string"))
    return events.select(F.expr("'run' || cast(user_id % 3 as string)").alias("run"), path.alias("path"))


def latest_checkpoint(spark, sf_dir):
    return runs.latest_checkpoint(runs.with_checkpoint_step(_artifacts(spark, sf_dir)))


def keep_last_two(spark, sf_dir):
    return runs.keep_newest(runs.with_checkpoint_step(_artifacts(spark, sf_dir)))


def first_metrics(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    candidates = events.select(
        F.expr("'user' || cast(user_id as string)").alias("run"),
        F.expr("'p' || cast(event_id as string) || '/metrics.json'").alias("path"),
        F.col("event_id").alias("priority"),
        (F.col("event_type") == "error").alias("available"),
    )
    return runs.first_available(candidates)


def artifact_listing(spark, sf_dir):
    pages = tables.table(spark, sf_dir, "pages")
    path = F.regexp_extract("url", r"\Ahttps?://[^/]*/(.*)\z", 1)
    return runs.artifact_listing(pages.select(path.alias("path")))


def _log_lines(spark, sf_dir):
    return logs.parse_run_log(tables.log_lines(tables.table(spark, sf_dir, "events")))


def _log_columns(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("ts").cast("string").alias("ts"), "script", "level", "message")


def parse_run_logs(spark, sf_dir):
    return _log_columns(_log_lines(spark, sf_dir))


def log_errors(spark, sf_dir):
    return _log_columns(logs.error_lines(_log_lines(spark, sf_dir)))


def log_selection(spark, sf_dir):
    chosen = logs.select_logs(_log_lines(spark, sf_dir), day="2024-01-02", script="cl", phrase="value")
    return _log_columns(chosen)


# Round trips through the sources and sinks


def examples_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "examples")
    rows = extract.to_example_rows(build.split_examples(_examples(spark, sf_dir)), "split")
    example_files.write_examples(rows, folder)
    back = example_files.read_splits(spark, folder, ("train", "valid", "test"))
    return back.select(
        "language", "split", "repo", "path", F.col("class_span.start").alias("span_start"),
        F.col("class_span.end").alias("span_end"), "source", "target",
    )


def flat_split_roundtrip(spark, sf_dir):
    """The published layout: one file per language and split, written at once and read by its file names."""
    folder = shared_folder(spark, "flat")
    write_flat(extract.to_example_rows(build.split_examples(_examples(spark, sf_dir)), "split"), folder)
    back = example_files.read_splits(spark, f"{folder}/*", ("train", "valid", "test"))
    return back.select(
        "language", "split", "repo", "path", F.col("class_span.start").alias("span_start"),
        F.col("class_span.end").alias("span_end"), "source", "target",
    )


def test_split_scan(spark, sf_dir):
    folder = shared_folder(spark, "examples")
    rows = extract.to_example_rows(build.split_examples(_examples(spark, sf_dir)), "split")
    example_files.write_examples(rows, folder)
    return example_files.read_examples(spark, folder, split="test").select("language", "repo", "path", "target")


def tolerant_scan(spark, sf_dir):
    """The lines of one language are cut short before they are written."""
    rows = tables.documents(spark, sf_dir, "text", "source", "lang").select(
        F.col("source").alias("repo"),
        F.col("text").alias("source"),
        F.col("doc_id").cast("string").alias("target"),
        "lang",
    )
    line = F.to_json(F.struct("repo", "source", "target"))
    broken = F.when(F.col("lang") == "fr", F.left(line, F.length(line) - 5)).otherwise(line)
    folder = shared_folder(spark, "lines")
    rows.select(broken.alias("value")).write.text(folder)
    return example_files.read_examples(spark, folder, tolerant=True).select("repo", "source", "target")


def export_import_splits(spark, sf_dir):
    split = ranking.assign_split(stage(_first_documents(spark, sf_dir), "first"), "dedup_key", within=())
    rows = split.select(F.lit("text").alias("language"), "doc_id", "split")
    first, second = shared_folder(spark, "published"), shared_folder(spark, "local")
    example_files.export_splits(rows, first)
    published = spark.read.schema("doc_id bigint, language string, split string").json(first)
    return example_files.import_splits(published, second, splits=["train", "validation"])


def results_roundtrip(spark, sf_dir):
    folder = shared_folder(spark, "results")
    scored = _scored(spark, sf_dir).withColumn("input_ids", F.array(F.lit(1)))
    write_results(scored, folder)
    schema = "sample_id string, target string, top_prediction string, exact_match boolean, in_topk boolean"
    return spark.read.schema(schema).json(folder)


def metrics_roundtrip(spark, sf_dir):
    """The second write of a run takes the place of the first."""
    folder = shared_folder(spark, "metrics")
    metrics = scoring.headline_metrics(_scored(spark, sf_dir), K)
    write_metrics(metrics.withColumn("n", F.lit(0).cast("bigint")), folder, "model/run1")
    write_metrics(metrics, folder, "model/run1/")
    write_metrics(metrics, folder, "run2")
    return _rounded(spark.read.parquet(folder).select("run", "n", "exact_match", "topk_accuracy"))


def _written_repos(spark, sf_dir):
    """The code files written as files, hidden paths among them, and a repository that isn't there."""
    folder = shared_folder(spark, "repos")
    endings = "case language when 'python' then '.py' when 'java' then '.java' else '.cs' end"
    files = tables.code_files(spark, sf_dir).select(
        "repo", F.concat(F.lit("_pkg/.d/__"), F.col("path"), F.expr(endings)).alias("path"), "content"
    )

    def save(batches):
        import pandas as pd

        store = Store()
        for batch in batches:
            for repo, path, content in batch.itertuples(index=False):
                store.write(f"{folder}/{repo}/{path}", content.replace("\n", "\r\n").encode())
            yield pd.DataFrame({"written": [len(batch)]})

    files.mapInPandas(save, "written bigint").agg(F.sum("written")).collect()
    root = F.concat(F.lit(f"{folder}/"), "repo")
    repos = files.select("repo").distinct().unionAll(spark.createDataFrame([("gone",)], "repo string"))
    return repos.select(F.lit(0).cast("bigint").alias("repo_ord"), "repo", root.alias("root"))


def scan_files(spark, sf_dir):
    found = scan_sources(_written_repos(spark, sf_dir)).filter("error is null")
    return found.select("language", "repo", "path", "content")


def scan_counts(spark, sf_dir):
    return scan_accounts(scan_sources(_written_repos(spark, sf_dir)))


# Streams


def _in_two_parts(lines: DataFrame, folder: str, look) -> None:
    """Write one part of the log lines and look at them, then the other; the second look is a restart."""
    for part in (0, 1):
        grown = lines.filter(F.col("part") == part).drop("part")
        keys = [name for name in grown.columns if name != "value"]
        grown.write.mode("append").partitionBy(*keys).text(folder)
        look().awaitTermination()


def stream_training_log(spark, sf_dir):
    """A job follows logs, stops, and goes on after more has been written."""
    folder = shared_folder(spark, "stream")
    best = jobs.best_so_far(jobs.follow_training_log(spark, f"{folder}/logs", LAYOUTS))
    look = lambda: jobs.keep_latest(best, f"{folder}/result", f"{folder}/checkpoint")
    _in_two_parts(_training_lines(spark, sf_dir), f"{folder}/logs", look)
    return jobs.read_latest(spark, f"{folder}/result", best.schema).withColumn("run", _folder_run())


def stream_bounded(spark, sf_dir):
    """A backlog of logs is worked off in batches of a quarter of it at most; more logs come between two runs."""
    folder = shared_folder(spark, "stream")
    lines = _training_lines(spark, sf_dir)
    for part in (0, 1):
        grown = lines.filter(F.col("part") == part).drop("part")
        keys = [name for name in grown.columns if name != "value"]
        grown.write.mode("append").partitionBy(*keys).text(f"{folder}/logs")
        backlog = grown.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
        log = jobs.follow_training_log(
            spark, f"{folder}/logs", LAYOUTS, bytesPerTrigger=backlog // 4 + 1, untilNow=True
        )
        jobs.append_bounded(log, f"{folder}/result", f"{folder}/checkpoint")
    found = spark.read.schema(log.schema).parquet(f"{folder}/result").withColumn("run", _folder_run())
    return found.select("run", "step", "metric", "value")


def stream_scores(spark, sf_dir):
    files = tables.as_code_files(tables.table_stream(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    rows = tables.prediction_lists(extract.extract_examples(files))
    return _finished(spark, _rounded(jobs.running_scores(scoring.score_rows(rows, K))))


def _finished(spark, aggregate: DataFrame) -> DataFrame:
    """Run a running aggregate over all that has arrived and read its last result."""
    folder = shared_folder(spark, "stream")
    jobs.keep_latest(aggregate, f"{folder}/result", f"{folder}/checkpoint").awaitTermination()
    return jobs.read_latest(spark, f"{folder}/result", aggregate.schema)


def stream_alignment(spark, sf_dir):
    """Gold and predictions both arrive in two parts, with repeats, late answers and a restart between the parts.

    A document stands for an hour. Its answers come 0 to 7 hours later, of which 5 count. Answers of
    every seventh document of the first part come with the second, too late except near its end.
    The last row of each stream stands far ahead, so that all others are decided.
    """
    rows = tables.prediction_lists(_examples(spark, sf_dir), "cast(substring(path, 2) as bigint) as doc_id")
    rows = stage(rows, "arriving")
    cut = (rows.agg(F.max("doc_id")).first()[0] or 0) // 2
    hours = lambda hour: F.timestamp_seconds((F.expr(hour) + 1) * 3600).alias("at")
    part = f"doc_id >= {cut}"
    late = f"({part} or doc_id % 7 = 0 and doc_id < {cut} - 100)"
    ahead = spark.range(1).select(F.lit("ahead").alias("sample_id"), hours("100000000L"))
    gold = rows.select("sample_id", hours("doc_id"), "target", F.expr(f"{part} as second"), "doc_id")
    gold = gold.unionAll(gold.filter("doc_id % 11 = 0").withColumn("second", F.lit(True))).drop("doc_id")
    told = rows.select("sample_id", hours("doc_id + doc_id % 8"), "predictions", F.expr(f"{late} as second"), "doc_id")
    told = told.unionAll(told.filter("doc_id % 5 = 0")).drop("doc_id")
    folder = shared_folder(spark, "stream")
    sides = {name: side.unionByName(ahead.selectExpr("*", "true as second", *extra)) for name, side, extra in (
        ("gold", gold, ["'' as target"]), ("told", told, ["array('') as predictions"]))}
    streams = {}
    for name, side in sides.items():
        schema = side.drop("second").schema
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}")
        streams[name] = spark.readStream.schema(schema).parquet(f"{folder}/{name}")
    streams["told"] = streams["told"].withColumn("sample_id", F.expr("if(sample_id = 'ahead', 'ahead of told', sample_id)"))
    aligned = align_streams(streams["gold"], streams["told"], K, wait="5 hours", delay="10 hours")
    for second in (False, True):
        for name, side in sides.items():
            side.filter(F.col("second") == second).drop("second").write.mode("append").parquet(f"{folder}/{name}")
        jobs.append_log_events(aligned, f"{folder}/result", f"{folder}/checkpoint").awaitTermination()
    found = spark.read.schema(aligned.schema).parquet(f"{folder}/result")
    return found.select("sample_id", "target", _joined(F.col("predictions")).alias("predictions"), "answered")


def stream_log_errors(spark, sf_dir):
    """Error lines of growing run logs, each once although the job is restarted."""
    folder = shared_folder(spark, "stream")
    events = tables.table(spark, sf_dir, "events")
    errors = _log_columns(jobs.follow_errors(spark, f"{folder}/logs"))
    look = lambda: jobs.append_log_events(errors, f"{folder}/result", f"{folder}/checkpoint")
    _in_two_parts(tables.log_lines(events, "event_id % 2 as part"), f"{folder}/logs", look)
    return spark.read.schema(errors.schema).parquet(f"{folder}/result")


def stream_callback(spark, sf_dir):
    """A callback gets the rows of each batch of log events; this one stores them under the batch's number."""
    folder = shared_folder(spark, "stream")
    log = tables.training_log(tables.table_stream(spark, sf_dir, "events"))

    def store(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{folder}/result/batch={batch_id}")

    jobs.on_log_events(log, store, f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{folder}/result").select(*log.columns)


QUERIES = {
    "extract_python": _extract("python"),
    "extract_java": _extract("java"),
    "extract_csharp": _extract("csharp"),
    "extract_sql": extract_sql,
    "examples_masked": examples_masked,
    "sample_ids": sample_ids,
    "examples_unmasked": examples_unmasked,
    "mask_header": mask_header,
    "repo_slug": repo_slug,
    "repo_list": repo_list,
    "decode_source": decode_source,
    "text_columns": text_columns,
    "clean_examples": clean_examples,
    "prompt_seq2seq": _prompt(lambda: prompts.render_prompt(F.col("source"), "seq2seq")),
    "prompt_causal": _prompt(lambda: prompts.render_prompt(F.col("source"), "causal")),
    "prompt_training_text": _prompt(lambda: prompts.training_text(F.col("source"), F.col("target"))),
    "dedup_examples": dedup_examples,
    "dedup_documents": dedup_documents,
    "split_sizes": split_sizes,
    "split_assignment": split_assignment,
    "split_documents": split_documents,
    "seeded_order": seeded_order,
    "batch_numbers": batch_numbers,
    "dataset_stats": dataset_stats,
    "language_histogram": language_histogram,
    "split_percent": split_percent,
    "label_profile": label_profile,
    "top_labels": top_labels,
    "heavy_labels": heavy_labels,
    "split_overlap": split_overlap,
    "build_accounting": build_accounting,
    "language_accounting": language_accounting,
    "missing_splits": missing_splits,
    "split_rename": split_rename,
    "split_rename_selected": split_rename_selected,
    "planned_steps": planned_steps,
    "extract_completion_first": _completion(prompts.completion_token),
    "extract_completion_line": _completion(prompts.completion_line),
    "extract_identifier": _completion(prompts.completion_identifier),
    "extract_probe": _completion(prompts.completion_probe),
    "topk_unique": topk_unique,
    "best_alternatives": best_alternatives,
    "beam_ranks": beam_ranks,
    "eval_rows": eval_rows,
    "eval_headline": eval_headline,
    "eval_fallback": eval_fallback,
    "edit_distance_stats": edit_distance_stats,
    "test_mode_metrics": test_mode_metrics,
    "class_distribution": class_distribution,
    "language_stats": language_stats,
    "classification_report": classification_report,
    "weighted_prf": weighted_prf,
    "name_report": name_report,
    "caller_metric": caller_metric,
    "caller_fmeasure": caller_fmeasure,
    "summary_sink": summary_sink,
    "metrics_display": metrics_display,
    "sample_view": sample_view,
    "first_samples": first_samples,
    "batch_inference": batch_inference,
    "failed_batches": failed_batches,
    "resumed_answers": resumed_answers,
    "batch_accuracy": batch_accuracy,
    "encode_texts": encode_texts,
    "row_accounting": row_accounting,
    "label_mask": label_mask,
    "seq2seq_arrays": seq2seq_arrays,
    "collate_batches": collate_batches,
    "pad_fixed": pad_fixed,
    "token_accuracy": token_accuracy,
    "argmax": argmax,
    "best_checkpoint": best_checkpoint,
    "latest_checkpoint": latest_checkpoint,
    "keep_last_two": keep_last_two,
    "first_metrics": first_metrics,
    "loss_curve": loss_curve,
    "curve_positions": curve_positions,
    "training_log_csv": training_log_csv,
    "training_log_files": training_log_files,
    "log_positions": log_positions,
    "log_records": log_records,
    "artifact_listing": artifact_listing,
    "parse_run_logs": parse_run_logs,
    "log_errors": log_errors,
    "log_selection": log_selection,
    "examples_roundtrip": examples_roundtrip,
    "flat_split_roundtrip": flat_split_roundtrip,
    "test_split_scan": test_split_scan,
    "tolerant_scan": tolerant_scan,
    "export_import_splits": export_import_splits,
    "results_roundtrip": results_roundtrip,
    "metrics_roundtrip": metrics_roundtrip,
    "scan_files": scan_files,
    "scan_accounts": scan_counts,
    "stream_training_log": stream_training_log,
    "stream_bounded": stream_bounded,
    "stream_scores": stream_scores,
    "stream_alignment": stream_alignment,
    "stream_log_errors": stream_log_errors,
    "stream_callback": stream_callback,
}
