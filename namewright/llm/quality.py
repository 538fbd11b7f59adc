"""Quality rules: a table of thresholds compiled into one projection."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK_CLASS, BLANKS, whole_text, without_blanks

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the be to of and that have with a in is it for was on are as at this but by not from or an "
    "le la les de des du et un une est que qui dans pour pas sur par au en avec ce il ne se "
    "der die das und den dem ein eine ist nicht von zu mit auf für im sich des auch es an als "
    "el los las y una por con no para como su al lo más del"
).split()


class Rule(NamedTuple):
    """A document is rejected if ``metric`` lies outside the limits; None is no limit."""

    metric: str
    least: float | None = None
    most: float | None = None


# All ratios are per word or per line, so long texts are judged like others and have no limit of their own.
RULES = (
    Rule("n_words", 50, None),
    Rule("mean_word_chars", 2, 14),
    Rule("symbols_per_word", None, 0.25),
    Rule("bars_per_word", None, 0.25),
    Rule("shouts_per_word", None, 0.5),
    Rule("stop_words_per_word", 0.02, None),
    Rule("dup_lines_per_line", None, 0.6),
    Rule("ellipsis_lines_per_line", None, 0.5),
    Rule("bullet_lines_per_line", None, 0.95),
)


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK_CLASS}+"))


def repeated_window_words(words: Column) -> Column:
    """How many words lie in a three-word window that the text has twice or more.

    Windows become numbers of 34 hash bits above 30 bits of their place, sorted as plain
    longs; neighbours with equal hash bits are candidates, which are then told apart by
    their words. No step compares all windows with each other.
    """

    def window(w, i):
        return [F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)]

    def packed(w):
        return F.sort_array(
            F.transform(
                F.sequence(F.lit(0), F.size(w) - 3),
                lambda i: F.shiftleft(F.xxhash64(*window(w, i)).bitwiseAND(F.lit((1 << 33) - 1)), 30) + i,
            )
        )

    def repeats(values, same):
        """The values that equal a sorted neighbour."""
        return F.flatten(
            F.transform(
                F.array(values),
                lambda s: F.filter(
                    s,
                    lambda v, k: F.coalesce(same(v, F.get(s, k - 1)), F.lit(False))
                    | F.coalesce(same(v, F.get(s, k + 1)), F.lit(False)),
                ),
            )
        )

    def exact(w, candidates):
        place = lambda v: v.bitwiseAND(F.lit((1 << 30) - 1)).cast("int")
        spelled = F.transform(
            candidates, lambda v: F.struct(F.array(*window(w, place(v))).alias("w"), place(v).alias("i"))
        )
        found = repeats(F.sort_array(spelled), lambda a, b: a["w"] == b["w"])
        spots = F.flatten(F.transform(found, lambda v: F.array(v["i"], v["i"] + 1, v["i"] + 2)))
        return F.size(F.array_distinct(spots))

    same_hash = lambda a, b: F.shiftright(a, 30) == F.shiftright(b, 30)
    counted = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(exact(w, repeats(packed(w), same_hash))),
    )
    return F.element_at(counted, 1)


def base_metrics(docs: DataFrame, text: str = "text", keep=()) -> DataFrame:
    """The counts that the rules divide: words, characters, symbols, lines, stop words.

    All columns come from one scan without a shuffle. Words are runs of characters other
    than the six ASCII blanks, lines are cut at \\n, and a line without a word is no line.
    """
    stops = [*STOP_WORDS, *(word.capitalize() for word in STOP_WORDS)]
    base = docs.select(*keep, whole_text(text).alias("_text"))
    base = base.withColumn("_words", _words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    )

    def lines(pattern: str) -> Column:
        return F.size(F.filter("_lines", lambda line: line.rlike(pattern))).cast("long")

    return base.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.length(without_blanks(F.col("_text"))).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_words", lambda w: w.isin(*stops))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_words", lambda w: w == "|")).cast("long").alias("n_bars"),
        F.size(F.filter("_words", lambda w: w.endswith("!!"))).cast("long").alias("n_shouts"),
        lines(r"(\.\.\.|…)[\x20\x09-\x0D]*\z").alias("n_ellipsis_lines"),
        lines(r"\A[\x20\x09-\x0D]*[-*•]").alias("n_bullet_lines"),
    )


def _ratios() -> dict[str, Column]:
    per_word = lambda name: F.col(name) / F.greatest(F.col("n_words"), F.lit(1))
    per_line = lambda name: F.col(name) / F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "n_words": F.col("n_words"),
        "mean_word_chars": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "bars_per_word": per_word("n_bars"),
        "shouts_per_word": per_word("n_shouts"),
        "stop_words_per_word": per_word("n_stop_words"),
        "dup_lines_per_line": per_line("n_dup_lines"),
        "ellipsis_lines_per_line": per_line("n_ellipsis_lines"),
        "bullet_lines_per_line": per_line("n_bullet_lines"),
    }


def compile_rules(rules=RULES) -> Column:
    """One boolean column: every rule's ratio lies within its limits."""
    ratios = _ratios()
    verdict = F.lit(True)
    for rule in rules:
        if rule.least is not None:
            verdict = verdict & (ratios[rule.metric] >= F.lit(rule.least))
        if rule.most is not None:
            verdict = verdict & (ratios[rule.metric] <= F.lit(rule.most))
    return verdict


def base_failed() -> Column:
    """Too short, or over half of the words lie in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules=RULES) -> DataFrame:
    """Counts and verdict of every row: (doc_id, counts, base_failed, kept).

    A missing or empty text has no words, so it fails. Repeated rows are judged alike and
    each returned. Columns other than key and text are not read.
    """
    counts = base_metrics(docs.select(F.col(key).alias("doc_id"), text), text, ["doc_id"])
    return counts.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & compile_rules(rules))


def keep_quality(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """Only the rows that pass, with all their columns, whatever these are called.

    The row number keeps the optimiser from moving the filter below the counts, which would
    count words and lines once for every rule that names them.
    """
    whole = docs.select(F.struct("*").alias("_doc"))
    counts = base_metrics(whole.withColumn("_whole", F.col("_doc")[text]), "_whole", ["_doc"])
    counts = counts.withColumn("_row", F.monotonically_increasing_id())
    return counts.filter(~base_failed() & compile_rules(rules) & (F.col("_row") >= 0)).select("_doc.*")
