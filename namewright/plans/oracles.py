"""The same queries in SQL for DuckDB, over the given tables."""

# Shared views

CODE_FILES = r"""code_files as (
  select source as repo, 'f' || doc_id as path,
    case doc_id % 3 when 0 then 'python' when 1 then 'java' else 'csharp' end as language,
    array_to_string(list_transform(string_split(text, chr(10)), lambda x, i:
      case when (i - 1) % 4 = 0 then
          (case doc_id % 3 when 0 then 'class K' when 1 then 'public class K' else 'public sealed class K' end)
          || regexp_extract(x, '[A-Za-z]+') || (case doc_id % 3 when 0 then '(Base):' else ' {' end) || chr(10) || '    ' || x
        else '    ' || x end), chr(10)) as content
  from documents)"""

# Names and declaration keywords of the languages.
_NAME = "[A-Za-z_][A-Za-z0-9_]*"
_JAVA = "class|interface|enum"
_CSHARP = "class|interface|struct|enum|record"
_LEAD = r"(?:public|private|internal|protected)?\s*(?:static|sealed|abstract|partial)?\s*"

DECLARATIONS = (
    CODE_FILES
    + rf""", pieces as (
  select language, repo, path, string_split(case language
    when 'python' then regexp_replace(content, '(?m)(^class\s+{_NAME})', chr(1) || '\1', 'g')
    when 'java' then regexp_replace(content, '(\b(?:{_JAVA})\s+{_NAME}\b)', chr(1) || '\1', 'g')
    else regexp_replace(content, '(\b{_LEAD}(?:{_CSHARP})\s+{_NAME}\b)', chr(1) || '\1', 'g') end, chr(1)) as p
  from code_files),
 cut as (
  select language, repo, path, p[i] as snippet,
    coalesce(list_sum(list_transform(p[1:i - 1], lambda x: length(x))), 0)::bigint as span_start
  from pieces, unnest(range(2, len(p) + 1)) as t(i)),
 declarations as (
  select language, repo, path, span_start, span_start + length(snippet) as span_end, snippet,
    regexp_extract(snippet, '^{_LEAD}(?:{_CSHARP})\s+({_NAME})', 1) as target
  from cut)"""
)

_NORMALIZED = r"regexp_replace(trim({0}, ' ' || chr(9) || chr(10) || chr(13)), '\s+', ' ', 'g')"

EXAMPLES = (
    DECLARATIONS
    + rf""", masked as (
  select language, repo, path, span_start, span_end, target,
    regexp_replace(snippet, '^({_LEAD}(?:{_CSHARP})\s+){_NAME}', '\1____') as source
  from declarations
  where length(snippet) - length(replace(snippet, chr(10), '')) + 1 >= 3),
 examples as (
  select *, sha256({_NORMALIZED.format("source")}) as dedup_key,
    sha256(language || '|' || length(repo) || '|' || repo || '|' || span_start || '|' || path) as sample_id
  from masked)"""
)

FIRST = (
    EXAMPLES
    + """, first_copies as (
  select * exclude (n) from (
    select *, row_number() over (partition by language, dedup_key order by repo, path, span_start) as n from examples)
  where n = 1)"""
)

SPLIT = (
    FIRST
    + """, ranked as (
  select *, row_number() over (partition by language order by md5('42|' || dedup_key)) as n,
    count(*) over (partition by language) as total from first_copies),
 split as (
  select * exclude (n, total), case
    when n <= floor(total * cast(0.8 as double)) then 'train'
    when n <= floor(total * cast(0.8 as double)) + floor(total * cast(0.1 as double)) then 'valid'
    else 'test' end as split from ranked)"""
)

FIRST_DOCUMENTS = f"""keyed as (select doc_id, sha256({_NORMALIZED.format("text")}) as dedup_key from documents),
 first_documents as (select min(doc_id) as doc_id, dedup_key from keyed group by dedup_key),
 ranked_documents as (
  select *, row_number() over (order by md5('42|' || dedup_key)) as n, count(*) over () as total from first_documents),
 split_documents as (
  select doc_id, dedup_key, case
    when n <= floor(total * cast(0.8 as double)) then 'train'
    when n <= floor(total * cast(0.8 as double)) + floor(total * cast(0.1 as double)) then 'valid'
    else 'test' end as split from ranked_documents)"""

BEAMS = (
    EXAMPLES
    + """, gold as (select sample_id, language, target from examples),
 named_words as (
  select sample_id, source, body, length(source) as n, regexp_extract_all(body, '[A-Za-z]+') as w
  from (select *, substr(source, instr(source, chr(10)) + 1) as body from examples)),
 beams as (
  select sample_id, source, body, n, beam,
    case n % 5 when 3 then '' when 1 then lower('K' || coalesce(w[(beam + n) % 3 + 1], ''))
      else 'K' || coalesce(w[(beam + n) % 3 + 1], '') end as text
  from named_words, (values (1), (2), (3)) as b(beam))"""
)

LISTS = (
    BEAMS
    + """, lists as (
  select g.sample_id, g.language, g.target, b.predictions
  from gold g join (select sample_id, list(text order by beam) as predictions from beams group by 1) b using (sample_id))"""
)

SCORED = (
    LISTS
    + """, scored as (
  select *, predictions[1] as top_prediction, predictions[1] = target as exact_match,
    lower(predictions[1]) = lower(target) as exact_match_ci, list_contains(predictions, target) as in_topk,
    case when predictions[1] = '' then length(target) else levenshtein(predictions[1], target) end as edit_distance
  from lists)"""
)

COMPARED = (
    LISTS
    + """, compared as (
  select *, predictions[1] as predicted, lower(target) as truth, lower(predictions[1]) as guess,
    lower(target) = lower(predictions[1]) as hit,
    case when predictions[1] = '' then length(target) else levenshtein(predictions[1], target) end as edit_distance
  from lists)"""
)

COMPLETIONS = (
    BEAMS
    + """, completions as (
  select sample_id, beam, case (n + beam) % 6
    when 0 then source || chr(10) || 'Class name: ' || text || ' ;x:' || chr(10) || 'next<|endoftext|>tail'
    when 1 then text || chr(10) || body
    when 2 then 'Class name: Other' || chr(10) || 'Class name: ' || text || '.;,'
    when 3 then ''
    when 4 then 'Name: ' || text || ':,<|endoftext|>' || body
    else 'class ____:' || chr(10) || 'Class name: ' || text || '<|endoftext|>' end as raw from beams)"""
)

_ENDS = "' ' || chr(9) || chr(10) || chr(13)"
_ANSWER = f"trim(split_part(string_split(raw, 'Class name:')[-1], '<|endoftext|>', 1), {_ENDS})"
_LINE = f"trim(split_part({_ANSWER}, chr(10), 1), {_ENDS})"
_TOKEN = rf"regexp_extract(rtrim({_LINE}, '.:;,'), '^\s*(\S*)', 1)"
_CLEANED = f"trim(rtrim({_ANSWER}, '.:;,' || chr(10) || chr(9)), {_ENDS})"
_AFTER_NAME = "substr(raw, instr(raw, 'Name:') + 5)"

UNIQUE = (
    COMPLETIONS
    + f""", cleaned as (select sample_id, beam, {_TOKEN} as text from completions),
 firsts as (select sample_id, text, min(beam) as beam from cleaned group by 1, 2)"""
)

_TOKEN_VIEWS = """tokens as (
  select doc_id as sample_id, {0} as input_ids, {1} as prompt_len
  from (select doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) as ids,
    case when doc_id % 7 = 0 then len(string_split(text, ' ')) + 1 else doc_id % 10 end as prompt from documents)),
 labelled as (
  select *, case when prompt_len < len(input_ids)
    then list_transform(input_ids, lambda x, i: case when i <= prompt_len then -100 else x end)
    else input_ids end as labels
  from tokens)"""
TOKENS = _TOKEN_VIEWS.format("ids", "prompt")
SHORT_TOKENS = _TOKEN_VIEWS.format("ids[1:512]", "least(prompt, 512)")

TRAINING_LOG = """training_log as (
  select 'run' || cast(user_id % 3 as varchar) as run, event_id as step,
    case event_type when 'view' then 'loss' else 'eval_loss' end as metric, value
  from events where event_type in ('view', 'error'))"""

LOGS = """logs as (
  select strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, event_type as script,
    case event_type when 'error' then 'ERROR' else 'INFO' end as level, 'value ' || event_id as message
  from events)"""

CHECKPOINTS = """checkpoints as (
  select 'run' || cast(user_id % 3 as varchar) as run, 'out/checkpoint-' || event_id as path, event_id as step
  from events)"""


def _report(pairs: str, truth: str, guess: str) -> str:
    """Label counts and scores of a truth and a guess column."""
    return f"""sides as (
  select {truth} as label, 1 as s, 0 as p, ({truth} = {guess})::int as t from {pairs}
  union all select {guess}, 0, 1, 0 from {pairs}),
 counts as (select label, sum(s)::bigint as support, sum(p)::bigint as predicted, sum(t)::bigint as tp from sides group by label),
 scores as (
  select label, support, tp, case when predicted = 0 then 0.0::double else tp / predicted::double end as precision,
    case when support = 0 then 0.0::double else tp / support::double end as recall,
    2 * tp / (support + predicted)::double as f1_score from counts),
 report as (
  select 'label' as kind, label::varchar as label, precision, recall, f1_score, support from scores
  union all select 'summary', 'accuracy', null, null, sum(tp) / sum(support)::double, sum(support)::bigint from scores
  union all select 'summary', 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support)::bigint from scores
  union all select 'summary', 'weighted avg', sum(precision * support) / sum(support)::double,
    sum(recall * support) / sum(support)::double, sum(f1_score * support) / sum(support)::double, sum(support)::bigint
  from scores)"""


_REPORT_COLUMNS = (
    "kind, label, round(precision, 6) as precision, round(recall, 6) as recall, "
    "round(f1_score, 6) as f1_score, support"
)


def _with(views: str, body: str) -> str:
    return f"with {views}\n{body}"


def _list_text(expression: str) -> str:
    return f"array_to_string({expression}, ',')"


def _extract(language: str) -> str:
    return _with(
        DECLARATIONS,
        f"select repo, path, span_start, span_end, target, snippet from declarations where language = '{language}'",
    )


def _rates(scored: str) -> str:
    return f"""select count(*) as n, round(avg(exact_match::int), 6) as exact_match,
  round(avg(exact_match_ci::int), 6) as exact_match_case_insensitive,
  round(avg(in_topk::int), 6) as topk_accuracy, round(avg(edit_distance), 6) as avg_levenshtein from {scored}"""


_PADDED = """select sample_id, {key}
  array_to_string(list_concat(input_ids, list_transform(range(greatest({length} - len(input_ids), 0)), lambda x: 0)), ',') as input_ids,
  array_to_string(list_concat(list_transform(input_ids, lambda x: 1),
    list_transform(range(greatest({length} - len(input_ids), 0)), lambda x: 0)), ',') as attention_mask,
  array_to_string(list_concat(labels, list_transform(range(greatest({length} - len(input_ids), 0)), lambda x: -100)), ',') as labels
from {rows}"""

_BEST = """select run, arg_min(step, (value, step)) filter (where metric = 'eval_loss') as best_step,
  min(value) filter (where metric = 'eval_loss') as best_value, max(step) as final_step
from training_log group by run"""

_ALL_METRICS = """select run, step, metric, value from training_log
union all select run, step, 'epoch', 0.5::double from training_log where metric = 'loss'"""

_NAMED = "named as (select doc_id, case lang when 'es' then '{0}' else 'train' end as split from documents)"

_TOP_LABELS = _with(
    BEAMS,
    """select target, count from (
  select target, count(*) as count, min(sample_id) as seen from gold group by target) order by count desc, seen limit 5""",
)

ORACLES = {
    "extract_python": _extract("python"),
    "extract_java": _extract("java"),
    "extract_csharp": _extract("csharp"),
    "extract_sql": _with(
        DECLARATIONS, "select language, path, span_start, span_end, snippet, target from declarations"
    ),
    "examples_masked": _with(
        EXAMPLES, "select language, repo, path, span_start, span_end, source, target from examples"
    ),
    "examples_unmasked": _with(
        DECLARATIONS,
        """select path, span_start, snippet as source, target from declarations
where length(snippet) - length(replace(snippet, chr(10), '')) + 1 >= 3""",
    ),
    "repo_list": rf"""select row_number() over (order by page_id % 2, page_id) - 1 as repo_ord, url,
  case when len(parts) >= 2 then parts[-2] || '__' || parts[-1] else parts[-1] end as repo
from (select page_id, url, string_split(regexp_replace(rtrim(url, '/'), '\.git$', ''), '/') as parts from pages)""",
    "sample_ids": _with(EXAMPLES, "select path, span_start, sample_id from examples"),
    "mask_header": _with(
        CODE_FILES,
        rf"""select language, path, case language
  when 'python' then regexp_replace(content, '(class\s+)' || regexp_extract(content, '(?m)^class\s+({_NAME})', 1), '\1____')
  when 'java' then regexp_replace(content, '(\b(?:{_JAVA})\s+){_NAME}\b', '\1____')
  else content end as masked from code_files""",
    ),
    "repo_slug": r"""select page_id, case when len(parts) >= 2 then parts[-2] || '__' || parts[-1] else parts[-1] end as repo
from (select page_id, string_split(regexp_replace(rtrim(url, '/'), '\.git$', ''), '/') as parts from pages)""",
    "decode_source": "select doc_id, text || chr(10) || 'A' as content from documents",
    "text_columns": rf"""select doc_id, regexp_extract(text, '^\s*(\S*)', 1) as first_token,
  length(text) - length(replace(text, chr(10), '')) + 1 as lines,
  case when length(text) > 100 then left(text, 100) || '...' else text end as preview,
  {_NORMALIZED.format("text")} as normalized,
  case doc_id % 4 when 0 then 'python' when 1 then 'java' when 2 then 'csharp' end as language from documents""",
    "clean_examples": """select doc_id, text as source, (case when doc_id % 3 = 0 then 'N' else 'L' end) || doc_id as target,
  'unknown' as language, case when doc_id % 2 = 0 then source else 'unknown' end as repo
from documents where lang not in ('fr', 'de') and doc_id % 3 < 2 and length(text) > 0""",
    "prompt_seq2seq": _with(
        EXAMPLES,
        "select path, span_start, 'Predict class name:' || chr(10) || source || chr(10) || 'Name:' as prompt from examples",
    ),
    "prompt_causal": _with(
        EXAMPLES, "select path, span_start, source || chr(10) || 'Class name:' as prompt from examples"
    ),
    "prompt_training_text": _with(
        EXAMPLES,
        "select path, span_start, source || chr(10) || 'Class name: ' || target || '<|endoftext|>' as prompt from examples",
    ),
    "dedup_examples": _with(FIRST, "select language, repo, path, span_start, target, source from first_copies"),
    "dedup_documents": _with(FIRST_DOCUMENTS, "select doc_id, dedup_key from first_documents"),
    "split_sizes": _with(SPLIT, "select language, split, count(*) as count from split group by 1, 2"),
    "split_assignment": _with(SPLIT, "select language, repo, path, span_start, target, split from split"),
    "split_documents": _with(FIRST_DOCUMENTS, "select doc_id, split from split_documents"),
    "seeded_order": _with(
        FIRST_DOCUMENTS, "select doc_id, n as rank, (n - 1) // 16 as batch_id from ranked_documents"
    ),
    "batch_numbers": "select source, doc_id, row_number() over (partition by source order by doc_id) as rank from documents",
    "dataset_stats": _with(
        SPLIT, "select split, count(*) as count, count(distinct repo) as repos from split group by split"
    ),
    "language_histogram": _with(SPLIT, "select split, language, count(*) as count from split group by 1, 2"),
    "split_percent": _with(
        SPLIT,
        """select coalesce(split, '(all)') as split, count(*) as count, count(distinct repo) as repos,
  round(count(*) / (select count(*) from split)::double * 100, 1) as percent from split group by rollup(split)""",
    ),
    "label_profile": _with(
        SPLIT, "select split, count(*) as count, count(distinct target) as labels from split group by split"
    ),
    "top_labels": _TOP_LABELS,
    "heavy_labels": _TOP_LABELS,
    "split_overlap": _with(
        SPLIT
        + """, held as (select repo, split from split where repo is not null group by 1, 2),
 names as (select distinct split from split),
 pairs as (select a.split, b.split as other from names a join names b on a.split < b.split),
 sides as (
  select p.split, p.other, h.repo, bool_or(h.split = p.split) as here, bool_or(h.split = p.other) as there
  from pairs p join held h on h.split in (p.split, p.other) group by 1, 2, 3)""",
        """select split, other, count(*) filter (where here and there) as both, count(*) as either,
  count(*) filter (where not there) as only_split, count(*) filter (where not here) as only_other
from sides group by 1, 2""",
    ),
    "build_accounting": _with(
        EXAMPLES,
        "select repo, language, count(distinct path) as files, count(*) as examples from examples group by 1, 2",
    ),
    "language_accounting": _with(
        FIRST,
        """select language, count(*) as examples, count(distinct dedup_key) as unique_examples
from examples group by language""",
    ),
    "missing_splits": _with(
        _NAMED.format("valid"),
        "select split from (values ('train'), ('valid'), ('test')) r(split) where split not in (select split from named)",
    ),
    "split_rename": _with(
        _NAMED.format("validation"),
        """select case split when 'validation' then 'valid' else split end as split, count(*) as count
from named group by 1""",
    ),
    "split_rename_selected": _with(
        _NAMED.format("valid"), "select doc_id, 'validation' as split from named where split = 'valid'"
    ),
    "planned_steps": _with(
        _NAMED.format("valid"),
        """select split, count(*) as count, count(*) // 40 * 5 as steps, (count(*) + 9) // 10 as batches
from named group by split""",
    ),
    "extract_completion_first": _with(
        COMPLETIONS, f"select sample_id, beam::bigint as beam, {_TOKEN} as text from completions"
    ),
    "extract_completion_line": _with(
        COMPLETIONS,
        f"""select sample_id, beam::bigint as beam, case when contains(raw, 'Class name:')
  then trim(split_part({_CLEANED}, chr(10), 1), {_ENDS}) else {_CLEANED} end as text from completions""",
    ),
    "extract_identifier": _with(
        COMPLETIONS,
        rf"""select sample_id, beam::bigint as beam, case when contains(raw, 'Name:')
    and regexp_matches({_AFTER_NAME}, '^\s*{_NAME}') then regexp_extract({_AFTER_NAME}, '^\s*({_NAME})', 1)
  else regexp_extract(raw, '^\s*({_NAME})', 1) end as text from completions""",
    ),
    "extract_probe": _with(
        COMPLETIONS,
        rf"""select sample_id, beam::bigint as beam, case when contains(raw, 'Name:')
  then coalesce(nullif(regexp_extract({_AFTER_NAME}, '^\s*(\S*)', 1), ''), 'EMPTY') end as text from completions""",
    ),
    "topk_unique": _with(
        UNIQUE,
        """select sample_id, coalesce(string_agg(text, ',' order by beam) filter (where text <> ''), '') as predictions
from firsts group by sample_id""",
    ),
    "best_alternatives": _with(
        UNIQUE,
        """select sample_id, list(text order by beam)[1] as best,
  array_to_string(list(text order by beam)[2:], ', ') as alts from firsts group by sample_id""",
    ),
    "beam_ranks": _with(BEAMS, "select sample_id, text, (4 - beam)::bigint as rank from beams"),
    "eval_rows": _with(
        SCORED,
        f"""select sample_id, target, {_list_text("predictions")} as predictions, top_prediction, exact_match,
  exact_match_ci, in_topk, edit_distance from scored""",
    ),
    "eval_headline": _with(SCORED, _rates("scored")),
    "eval_fallback": _with(
        SCORED
        + """, fallback as (
  select exact_match and language <> 'java' as exact_match, exact_match_ci and language <> 'java' as exact_match_ci,
    in_topk and language <> 'java' as in_topk,
    case when language = 'java' then length(target) else edit_distance end as edit_distance from scored)""",
        _rates("fallback"),
    ),
    "edit_distance_stats": _with(
        SCORED,
        """select min(edit_distance)::double as min, max(edit_distance)::double as max,
  round(avg(edit_distance), 6) as mean, round(stddev_pop(edit_distance), 6) as std,
  round(quantile_cont(edit_distance, 0.5)::double, 6) as median from scored""",
    ),
    "test_mode_metrics": _with(
        COMPARED,
        """select count(*) as n, round(avg(hit::int), 6) as exact_match, round(avg(hit::int), 6) as exact_match_case_insensitive,
  round(avg(list_contains(list_transform(predictions, lambda x: lower(x)), truth)::int), 6) as topk_accuracy,
  round(avg(edit_distance), 6) as avg_edit_distance, round(avg(length(predicted)), 6) as avg_prediction_length,
  round(avg(length(target)), 6) as avg_target_length, sum(hit::int)::bigint as correct_predictions from compared""",
    ),
    "class_distribution": _with(
        COMPARED,
        """select count(distinct name) as class_distribution
from (select truth as name from compared union all select guess from compared)""",
    ),
    "language_stats": _with(
        COMPARED,
        """select coalesce(language, '(all)') as language, count(*) as total, sum(hit::int)::bigint as correct,
  round(avg(hit::int), 6) as accuracy, sum(hit::int)::bigint as correct_ci, round(avg(hit::int), 6) as accuracy_ci
from compared group by rollup(language)""",
    ),
    "classification_report": _with(
        _report("labels", "quality", "toxic"), f"select {_REPORT_COLUMNS} from report"
    ),
    "weighted_prf": _with(
        _report("labels", "quality", "toxic"),
        """select round(sum(tp) / sum(support)::double, 6) as accuracy,
  round(sum(precision * support) / sum(support)::double, 6) as precision,
  round(sum(recall * support) / sum(support)::double, 6) as recall,
  round(sum(f1_score * support) / sum(support)::double, 6) as f1_score from scores""",
    ),
    "name_report": _with(
        COMPARED + ", " + _report("compared", "truth", "guess"), f"select {_REPORT_COLUMNS} from report"
    ),
    "caller_metric": _with(
        SCORED,
        """select language, count(*) as n, round(avg((left(target, 2) = left(top_prediction, 2))::int), 6) as same_start
from scored group by language""",
    ),
    "caller_fmeasure": _with(
        SCORED
        + """, letters as (
  select language, regexp_extract_all(target, '(?s).') as t, regexp_extract_all(top_prediction, '(?s).') as p from scored),
 shared as (
  select language, len(t) as n_true, len(p) as n_guessed,
    coalesce(list_sum(list_transform(list_distinct(t), lambda x: least(
      len(list_filter(t, lambda y: y = x)), len(list_filter(p, lambda y: y = x))))), 0) as n_common from letters)""",
        """select language, round(sum(n_common) / sum(n_guessed)::double, 6) as precision,
  round(sum(n_common) / sum(n_true)::double, 6) as recall,
  round(2 * sum(n_common) / (sum(n_true) + sum(n_guessed))::double, 6) as f1 from shared group by language""",
    ),
    "summary_sink": _with(
        COMPARED + ", " + _report("compared", "truth", "guess"),
        """select '20240102_030405' as timestamp, 'm' as model_path, 'cpu' as device, 90.0::double as elapsed_time_seconds,
  count(*) as n, round(avg(hit::int), 6) as exact_match, round(avg(hit::int), 6) as exact_match_case_insensitive,
  round(avg(list_contains(list_transform(predictions, lambda x: lower(x)), truth)::int), 6) as topk_accuracy,
  round(avg(edit_distance), 6) as avg_edit_distance, round(count(*) / 90.0::double, 6) as samples_per_second,
  (select round(sum(precision * support) / sum(support)::double, 6) from scores) as precision,
  (select round(sum(recall * support) / sum(support)::double, 6) from scores) as recall,
  (select round(sum(f1_score * support) / sum(support)::double, 6) from scores) as f1_score,
  sum(hit::int)::bigint as correct_predictions,
  (select count(distinct name) from (select truth as name from compared union all select guess from compared))
    as class_distribution,
  min(edit_distance)::double as distance_min, max(edit_distance)::double as distance_max,
  round(avg(edit_distance), 6) as distance_mean, round(quantile_cont(edit_distance, 0.5)::double, 6) as distance_median
from compared""",
    ),
    "metrics_display": _with(
        SCORED,
        """, m as (select count(*) as n, avg(exact_match::int) as em, avg(exact_match_ci::int) as ci,
  avg(in_topk::int) as topk, avg(edit_distance) as lev from scored)
select label, value from (
  select 'Exact Match' as label, printf('%.2f%%', em * 100) as value from m
  union all select 'Case-Insensitive Match', printf('%.2f%%', ci * 100) from m
  union all select 'Top-3 Accuracy', printf('%.2f%%', topk * 100) from m
  union all select 'Avg Levenshtein Distance', printf('%.2f', lev) from m
  union all select 'Samples Evaluated', format('{:,}', n) from m
  union all select 'Evaluation Time', '1.5 minutes' from m
  union all select 'Speed', printf('%.2f samples/sec', n / 90.0) from m)""",
    ).replace("\n, m as", ", m as"),
    "sample_view": _with(
        SCORED,
        """select sample_id, target, array_to_string(predictions[1:5], ', ') as predictions, exact_match, in_topk,
  len(predictions) as k from scored order by sample_id limit 10""",
    ),
    "first_samples": _with(BEAMS, "select * from gold order by sample_id limit 100"),
    "batch_inference": _with(
        EXAMPLES
        + rf""", guessed as (
  select path, span_start, target,
    regexp_extract(string_split(trim(string_split(source, chr(10))[2], ' '), ' ')[1], '^\s*({_NAME})', 1) as name
  from examples),
 named as (
  select path, span_start, target,
    case when name <> '' then name else 'Name' end as predicted_name from guessed)""",
        "select *, target = predicted_name as correct from named",
    ),
    "resumed_answers": """select doc_id, left(text, 20) as first, length(text)::varchar as second, 1::bigint as asked
from documents""",
    "batch_accuracy": _with(
        LISTS,
        """select count(*) as total, sum((predictions[1] = target)::int)::bigint as correct,
  round(avg((predictions[1] = target)::int), 6) as accuracy from lists""",
    ),
    "encode_texts": _with(
        BEAMS,
        """select sample_id, array_to_string(list_transform(string_split(target, ''), lambda x: unicode(x)), ',') as input_ids
from gold""",
    ),
    "row_accounting": "select count(*) as rows from documents",
    "label_mask": _with(
        SHORT_TOKENS,
        f"select sample_id, {_list_text('input_ids')} as input_ids, {_list_text('labels')} as labels from labelled",
    ),
    "seq2seq_arrays": """select doc_id as sample_id, array_to_string(ids[1:1024], ',') as input_ids,
  array_to_string(list_reverse(ids)[1:32], ',') as labels
from (select doc_id, list_transform(string_split(text, ' '), lambda w: length(w)) as ids from documents)""",
    "collate_batches": _with(
        TOKENS
        + """, batched as (
  select *, (row_number() over (order by md5('42|' || sample_id)) - 1) // 8 as batch_id from labelled),
 sized as (select *, max(len(input_ids)) over (partition by batch_id) as longest from batched)""",
        _PADDED.format(key="batch_id,", length="longest", rows="sized"),
    ),
    "pad_fixed": _with(
        TOKENS
        + """, short as (
  select sample_id, input_ids[1:512] as input_ids, labels[1:512] as labels from labelled)""",
        _PADDED.format(key="", length="512", rows="short"),
    ),
    "token_accuracy": _with(
        TOKENS
        + """, cells as (
  select unnest(labels) as label, unnest(list_transform(input_ids, lambda x, i:
    case when (i - 1) % 3 = 0 then x + 1 else x end)) as guess from labelled)""",
        """select count(*) filter (where label = guess) as correct, count(*) as total,
  round(count(*) filter (where label = guess) / count(*)::double, 6) as token_accuracy from cells where label <> -100""",
    ),
    "argmax": """select vec_id, (list_position(embedding, list_max(embedding)) - 1)::bigint as place,
  (list_position(embedding[1:32], list_max(embedding[1:32])) - 1) || ',' ||
  (list_position(embedding[33:64], list_max(embedding[33:64])) - 1) as halves from embeddings""",
    "best_checkpoint": _with(TRAINING_LOG, _BEST),
    "latest_checkpoint": _with(
        CHECKPOINTS, "select run, arg_max(path, step) as path, max(step) as step from checkpoints group by run"
    ),
    "keep_last_two": _with(
        CHECKPOINTS,
        "select * from checkpoints qualify row_number() over (partition by run order by step desc) <= 2",
    ),
    "first_metrics": """select 'user' || user_id as run, 'p' || min(event_id) || '/metrics.json' as path,
  min(event_id) as priority from events where event_type = 'error' group by user_id""",
    "loss_curve": _with(TRAINING_LOG, "select run, step as x, metric, value from training_log"),
    "curve_positions": _with(
        TRAINING_LOG,
        "select run, step as line, row_number() over (partition by run order by step) - 1 as x, value from training_log",
    ),
    "training_log_csv": _with(TRAINING_LOG, _ALL_METRICS),
    "training_log_files": _with(TRAINING_LOG, _ALL_METRICS),
    "log_positions": """with lines as (
  select 'run' || cast(user_id % 3 as varchar) as run, event_id as step, event_type, value,
    row_number() over (partition by user_id % 3 order by event_id) - 1 as line
  from events where event_type in ('view', 'error', 'click'))
select run, line, step, case event_type when 'view' then 'loss' else 'eval_loss' end as metric, value
from lines where event_type <> 'click'
union all select run, line, step, 'epoch', 0.5::double from lines where event_type = 'view'""",
    "log_records": """with rows as (
  select user_id % 5 as run, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts,
    case when event_id % 3 = 0 then 3 else 1 end as n from events)
select run, (sum(n) over (partition by run order by event_id) - n)::bigint as record, ts, event_type as script,
  case event_type when 'error' then 'ERROR' else 'INFO' end as level,
  'value ' || event_id || case when n = 3
    then chr(10) || 'Traceback: ' || event_type || chr(10) || '  in line ' || event_id else '' end as message
from rows""",
    "artifact_listing": r"""select case when contains(path, '/') then regexp_extract(path, '^(.*)/', 1) else 'root' end as folder,
  string_split(path, '/')[-1] as name
from (select regexp_extract(url, '^https?://[^/]*/(.*)$', 1) as path from pages) order by folder, name""",
    "parse_run_logs": _with(LOGS, "select ts, script, level, message from logs"),
    "log_errors": _with(LOGS, "select ts, script, level, message from logs where level = 'ERROR'"),
    "log_selection": _with(
        LOGS, "select ts, script, level, message from logs where ts like '2024-01-02%' and script like 'cl%'"
    ),
    "examples_roundtrip": _with(
        SPLIT, "select language, split, repo, path, span_start, span_end, source, target from split"
    ),
    "flat_split_roundtrip": _with(
        SPLIT, "select language, split, repo, path, span_start, span_end, source, target from split"
    ),
    "test_split_scan": _with(SPLIT, "select language, repo, path, target from split where split = 'test'"),
    "tolerant_scan": "select source as repo, text as source, doc_id::varchar as target from documents where lang <> 'fr'",
    "export_import_splits": _with(
        FIRST_DOCUMENTS,
        "select split, count(*) as count from split_documents where split in ('train', 'valid') group by split",
    ),
    "results_roundtrip": _with(SCORED, "select sample_id, target, top_prediction, exact_match, in_topk from scored"),
    "metrics_roundtrip": _with(
        SCORED,
        """select run, count(*) as n, round(avg(exact_match::int), 6) as exact_match,
  round(avg(in_topk::int), 6) as topk_accuracy from scored, (values ('run1'), ('run2')) r(run) group by run""",
    ),
    "scan_files": _with(
        CODE_FILES,
        """select language, repo, '_pkg/.d/__' || path
  || (case language when 'python' then '.py' when 'java' then '.java' else '.cs' end) as path, content from code_files""",
    ),
    "scan_accounts": _with(
        CODE_FILES,
        """select repo, count(*) as files, 0::bigint as unread_files, 0::bigint as unread_folders from code_files group by repo
  union all select 'gone', 0, 0, 1""",
    ),
    "failed_batches": """select count(*) as prompts, count(*) filter (length(text) % 3 = 0) as failed from documents""",
    "stream_training_log": _with(TRAINING_LOG, _BEST),
    "stream_bounded": _with(TRAINING_LOG, _ALL_METRICS),
    "stream_scores": _with(
        SCORED,
        """select count(*) as n, sum(exact_match::int)::bigint as em, sum(exact_match_ci::int)::bigint as em_ci,
  sum(in_topk::int)::bigint as topk, sum(edit_distance)::bigint as lev_sum,
  round(avg(exact_match::int), 6) as exact_match from scored""",
    ),
    "stream_alignment": _with(
        LISTS
        + """, placed as (
  select l.sample_id, l.target, l.predictions, cast(substr(e.path, 2) as bigint) as doc_id
  from lists l join examples e using (sample_id)),
 half as (select max(doc_id) // 2 as middle from placed),
 told as (select *, doc_id % 8 <= 5 and not (doc_id % 7 = 0 and doc_id < middle - 100) as answered from placed, half)""",
        """select sample_id, target, case when answered then array_to_string(predictions, ',') else ',,' end as predictions,
  answered from told""",
    ),
    "stream_log_errors": _with(LOGS, "select ts, script, level, message from logs where level = 'ERROR'"),
    "stream_callback": _with(TRAINING_LOG, "select run, step, metric, value from training_log"),
}
