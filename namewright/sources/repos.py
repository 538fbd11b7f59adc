"""Lists of repositories."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import repo_slug, trim_ws


def read_repo_list(spark: SparkSession, path: str) -> DataFrame:
    """One row per listed URL with its place in the list; duplicates stay.

    Several lists follow each other in the order of their paths. Blank lines and lines that
    start with ``#`` are skipped. A list is a small text file, read whole so that the lines
    keep their order.
    """
    texts = spark.read.text(path, wholetext=True)
    urls = F.filter(F.transform(F.split("value", "\r\n|\r|\n"), trim_ws), lambda url: (url != "") & ~url.startswith("#"))
    lists = texts.select(F.col("_metadata.file_path").alias("file"), urls.alias("urls"))
    # One small row per file; only these are numbered in one task.
    before = F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("file")) - F.col("n")
    starts = lists.select("file", F.size("urls").cast("bigint").alias("n")).select("file", before.alias("start"))
    lines = lists.select("file", F.posexplode("urls").alias("line", "url")).join(starts, "file")
    return lines.select((F.col("start") + F.col("line")).alias("repo_ord"), "url", repo_slug(F.col("url")).alias("repo"))
