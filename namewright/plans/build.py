"""From source files to a split dataset."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import first_of_copies, join_first, keep_first
from ..operators.extract import EXAMPLE_ORDER, extract_examples, to_example_rows
from ..operators.profile import language_accounts, repo_accounts
from ..operators.ranking import assign_split
from ..session import stage
from ..sources.examples import write_examples

def split_of_first(
    examples: DataFrame, train: float = 0.8, valid: float = 0.1, seed: int = 42, carry=()
) -> DataFrame:
    """The narrow row of each first copy with its split; no text is moved.

    The first copies are staged, so the examples are read only once for them.
    """
    first = first_of_copies(examples, "dedup_key", EXAMPLE_ORDER, carry=carry)
    return assign_split(stage(first, "first"), "dedup_key", train, valid, seed)


def unique_examples(examples: DataFrame) -> DataFrame:
    """The first copy of each example, as a whole row."""
    return keep_first(stage(examples, "examples"), "dedup_key", EXAMPLE_ORDER)


def split_examples(examples: DataFrame, train: float = 0.8, valid: float = 0.1, seed: int = 42) -> DataFrame:
    """De-duplicate and split in one join of the full rows, the only shuffle of text."""
    staged = stage(examples, "examples")
    chosen = split_of_first(staged, train, valid, seed)
    return join_first(staged, chosen, "dedup_key", EXAMPLE_ORDER, how="inner")


def build_dataset(
    files: DataFrame,
    path: str,
    mask: bool = True,
    min_lines: int = 3,
    train: float = 0.8,
    valid: float = 0.1,
    seed: int = 42,
    ingest: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Write the dataset and return its accounts as tables.

    The examples are staged, so the files are read and searched once and the
    de-duplication reads only narrow columns of the staged table. The written
    dataset is read back for the split sizes.
    """
    examples = stage(extract_examples(files, mask, min_lines), "examples")
    chosen = stage(split_of_first(examples, train, valid, seed), "chosen")
    rows = join_first(examples, chosen, "dedup_key", EXAMPLE_ORDER, how="inner")
    write_examples(to_example_rows(rows, "sample_id", "split"), path)
    return {
        "repos": repo_accounts(examples),
        "languages": language_accounts(examples, chosen, ingest),
        "splits": chosen.groupBy("language", "split").agg(F.count(F.lit(1)).alias("count")),
    }
