"""Readers and writers of example tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import rename_splits

EXAMPLE_SCHEMA = (
    "language string, repo string, path string, class_span struct<start:bigint,end:bigint>, "
    "source string, target string"
)
SPLIT_SCHEMA = EXAMPLE_SCHEMA + ", split string"


def read_examples(
    spark: SparkSession, path: str, split: str | None = None, tolerant: bool = False, schema: str = EXAMPLE_SCHEMA
) -> DataFrame:
    """JSON Lines under a schema.

    With ``split`` only that split is read: its folder of a partitioned table as written
    here, or its file of the flat layout ``<language>/<split>.jsonl``. It is an error
    if there is neither. A malformed line ends the job, or is skipped if ``tolerant``.
    """
    mode = "DROPMALFORMED" if tolerant else "FAILFAST"
    if split is not None and "split string" not in schema:
        schema = f"{schema}, split string"
    rows = spark.read.schema(schema).option("mode", mode).json(path)
    return rows if split is None else _of_splits(rows, [split], path)


def _of_splits(rows: DataFrame, splits, path: str) -> DataFrame:
    """Rows of some splits, named by partition folders or else by file names."""
    files = rows.inputFiles()
    if any("/split=" in file for file in files):
        return rows.filter(F.col("split").isin(*splits))
    if not {file.rsplit("/", 1)[-1].split(".", 1)[0] for file in files} & set(splits):
        raise ValueError(f"no folder and no file of the splits {list(splits)} below {path}")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"\A([^.]*)", 1)
    return rows.withColumn("split", name).filter(F.col("split").isin(*splits))


def read_splits(spark: SparkSession, path: str, splits=("train", "valid"), tolerant: bool = False) -> DataFrame:
    """The named splits of a partitioned table or of flat files; other folders are not opened."""
    mode = "DROPMALFORMED" if tolerant else "FAILFAST"
    rows = spark.read.schema(SPLIT_SCHEMA).option("mode", mode).json(path)
    return _of_splits(rows, splits, path)


def write_examples(
    examples: DataFrame, path: str, fmt: str = "json", max_rows: int = 1_000_000, rebalance: bool = False
) -> None:
    """One folder per language and split; files are closed after ``max_rows`` rows.

    ``rebalance`` spends a shuffle on files of even size: the rows of a folder come
    together, and Spark splits folders that are too large for one task.
    """
    if rebalance:
        examples = examples.hint("rebalance", "language", "split")
    (
        examples.write.partitionBy("language", "split")
        .option("maxRecordsPerFile", max_rows)
        .format(fmt)
        .save(path)
    )


def export_splits(examples: DataFrame, path: str, splits=None, fmt: str = "json") -> DataFrame:
    """Write under the published split names; gives the row count per split."""
    return _write_renamed(rename_splits(examples, True, splits), path, fmt)


def import_splits(examples: DataFrame, path: str, splits=None, fmt: str = "json") -> DataFrame:
    """Write a published table under the local split names; gives the row counts."""
    return _write_renamed(rename_splits(examples, False, splits), path, fmt)


def _write_renamed(renamed: DataFrame, path: str, fmt: str) -> DataFrame:
    write_examples(renamed, path, fmt)
    written = renamed.sparkSession.read.schema(renamed.schema).format(fmt).load(path)
    return written.groupBy("split").agg(F.count(F.lit(1)).alias("count"))
