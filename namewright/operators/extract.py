"""From source files to (masked source, target) examples."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import running_lengths
from ..functions.declarations import DECLARATION, by_language, mask_snippet, snippet_name
from ..functions.text import LANGUAGES, count_lines, normalize_source

# What orders the copies of an example: list order, file order, order in the file.
EXAMPLE_ORDER = ("repo_ord", "repo", "path", "span_start")


def split_at_declarations(content: Column, language: Column) -> Column:
    """The text before the first declaration, then one piece per declaration.

    Every piece runs to the next declaration or the end of the text, so the pieces
    joined together are the text again. The mark put in front of each declaration is
    one control character, or a digest of the text in the rare case that the text
    itself holds that character.
    """
    mark = F.when(F.contains(content, F.lit("\x01")), F.concat(F.lit("\x01"), F.sha2(content, 256), F.lit("\x01")))
    mark = mark.otherwise(F.lit("\x01"))
    marked = by_language(
        language,
        {
            name: F.regexp_replace(content, F.lit(pattern), F.concat(mark, F.lit("$0")))
            for name, pattern in DECLARATION.items()
        },
        content,
    )
    return F.split(marked, mark, -1)


def extract_declarations(files: DataFrame) -> DataFrame:
    """One row per declaration: ``span_start``, ``span_end``, ``snippet``, ``target``.

    Needs ``language`` and ``content``; all other columns but the content are kept.
    Offsets count code points, the end is exclusive. Other languages give no rows.
    """
    kept = [name for name in files.columns if name != "content"]
    pieces = files.filter(F.col("language").isin(*LANGUAGES)).select(
        *kept, split_at_declarations(F.col("content"), F.col("language")).alias("pieces")
    )
    ends = running_lengths(F.col("pieces")).alias("ends")
    exploded = pieces.select(*kept, F.posexplode(F.arrays_zip("pieces", ends)).alias("place", "piece"))
    snippet, end = F.col("piece.pieces"), F.col("piece.ends")
    return exploded.filter(F.col("place") > 0).select(
        *kept,
        (end - F.length(snippet)).alias("span_start"),
        end.alias("span_end"),
        snippet.alias("snippet"),
        snippet_name(snippet, F.col("language")).alias("target"),
    )


def sample_id(language: Column, repo: Column, path: Column, start: Column) -> Column:
    """A stable row id from the place of the example, free of separator mix-ups."""
    place = F.concat_ws("|", language, F.length(repo).cast("string"), repo, start.cast("string"), path)
    return F.sha2(place, 256)


def extract_examples(files: DataFrame, mask: bool = True, min_lines: int = 3) -> DataFrame:
    """Examples of at least ``min_lines`` lines, the declared name masked on demand.

    Adds ``sample_id`` and ``dedup_key``, a digest of the normalised source. Files
    without ``repo_ord`` are ordered by their repository's name.
    """
    if "repo_ord" not in files.columns:
        files = files.withColumn("repo_ord", F.col("repo"))
    found = extract_declarations(files).filter(count_lines(F.col("snippet")) >= min_lines)
    if mask:
        source = mask_snippet(F.col("snippet"), F.col("target"), F.col("language"))
    else:
        source = F.col("snippet")
    kept = [name for name in found.columns if name != "snippet"]
    place = [F.col(name) for name in ("language", "repo", "path", "span_start")]
    return found.select(*kept, source.alias("source"), sample_id(*place).alias("sample_id")).withColumn(
        "dedup_key", F.sha2(normalize_source(F.col("source")), 256)
    )


def to_example_rows(examples: DataFrame, *extra: str) -> DataFrame:
    """The published row shape, with the span as a struct."""
    span = F.struct(F.col("span_start").alias("start"), F.col("span_end").alias("end"))
    return examples.select("language", "repo", "path", span.alias("class_span"), "source", "target", *extra)
