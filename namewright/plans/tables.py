"""The given tables and the views that the registered queries read."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.prompts import END_OF_TEXT

LANGUAGE_BY_ID = "case doc_id % 3 when 0 then 'python' when 1 then 'java' else 'csharp' end"
HEADER_BY_ID = "case doc_id % 3 when 0 then 'class K' when 1 then 'public class K' else 'public sealed class K' end"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


def as_code_files(documents: DataFrame) -> DataFrame:
    """Every fourth line of a document stands below a class header of its language, named after the line's first word."""
    content = f"""array_join(transform(split(text, chr(10)), (x, i) ->
        case when i % 4 = 0
             then concat({HEADER_BY_ID}, regexp_extract(x, '[A-Za-z]+', 0),
                         case doc_id % 3 when 0 then '(Base):' else ' {{' end, chr(10), '    ', x)
             else concat('    ', x) end), chr(10))"""
    return documents.select(
        F.col("source").alias("repo"),
        F.expr("concat('f', cast(doc_id as string))").alias("path"),
        F.expr(LANGUAGE_BY_ID).alias("language"),
        F.expr(content).alias("content"),
    )


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_code_files(documents(spark, sf_dir, "text", "source"))


def gold(examples: DataFrame) -> DataFrame:
    """The name each extracted example asks for."""
    return examples.select("sample_id", "language", "target")


def _with_names(examples: DataFrame) -> DataFrame:
    """Three answers per example, made of the first words below its masked header.

    The length of the source says which word comes first, so the right name has rank 1, 2
    or 3; one answer in five is in lower case and one is empty.
    """
    body = examples.withColumn("body", F.expr("substr(source, instr(source, chr(10)) + 1)"))
    words = body.withColumns({"w": F.expr("regexp_extract_all(body, '[A-Za-z]+', 0)"), "n": F.length("source")})
    names = """transform(array(1, 2, 3), b -> case n % 5 when 3 then ''
        when 1 then lower('K' || coalesce(get(w, (b + n) % 3), ''))
        else 'K' || coalesce(get(w, (b + n) % 3), '') end)"""
    return words.withColumn("predictions", F.expr(names))


def beams(examples: DataFrame, *columns: str) -> DataFrame:
    """The answers as long rows."""
    return _with_names(examples).select("sample_id", *columns, F.posexplode("predictions").alias("place", "text")).select(
        "sample_id", *columns, (F.col("place") + 1).alias("beam"), "text"
    )


def prediction_lists(examples: DataFrame, *columns: str) -> DataFrame:
    """Target and the same answers as a list; row by row, so also for streams."""
    return _with_names(examples).selectExpr("sample_id", "language", "target", "predictions", *columns)


def completions(examples: DataFrame) -> DataFrame:
    """Raw texts of several shapes: prompt repeated, no marker, two markers, empty, another marker, end marker only."""
    raw = f"""case (n + beam) % 6
        when 0 then concat(source, chr(10), 'Class name: ', text, ' ;x:', chr(10), 'next{END_OF_TEXT}tail')
        when 1 then concat(text, chr(10), body)
        when 2 then concat('Class name: Other', chr(10), 'Class name: ', text, '.;,')
        when 3 then ''
        when 4 then concat('Name: ', text, ':,{END_OF_TEXT}', body)
        else concat('class ____:', chr(10), 'Class name: ', text, '{END_OF_TEXT}') end"""
    return beams(examples, "source", "body", "n").select("sample_id", "beam", F.expr(raw).alias("raw"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word lengths as ids; every seventh prompt is longer than its row."""
    return documents(spark, sf_dir, "text").select(
        F.col("doc_id").alias("sample_id"),
        F.expr("transform(split(text, ' '), w -> length(w))").alias("input_ids"),
        F.expr(
            "cast(case when doc_id % 7 = 0 then size(split(text, ' ')) + 1 else doc_id % 10 end as int)"
        ).alias("prompt_len"),
    )


def training_log(events: DataFrame) -> DataFrame:
    """Two metrics of three runs; works on a stream too."""
    return events.filter("event_type in ('view', 'error')").select(
        F.expr("'run' || cast(user_id % 3 as string)").alias("run"),
        F.col("event_id").alias("step"),
        F.expr("case event_type when 'view' then 'loss' else 'eval_loss' end").alias("metric"),
        "value",
    )


def log_lines(events: DataFrame, *columns: str) -> DataFrame:
    """A run-log line per event, next to further columns."""
    return events.selectExpr("*", *columns).select(
        *[column.rsplit(" ", 1)[-1] for column in columns],
        F.concat(
            F.left(F.col("ts").cast("string"), F.lit(19)),
            F.lit(" - "),
            F.col("event_type"),
            F.expr("case event_type when 'error' then ' - ERROR - ' else ' - INFO - ' end"),
            F.lit("value "),
            F.col("event_id").cast("string"),
        ).alias("value")
    )


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, one file or a folder of files, as a stream of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
