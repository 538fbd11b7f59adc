"""Training logs and run logs."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import trim_ws
from ..session import stage
from .lines import RANGE_BYTES, number_lines, read_lines, records

# The shape of a log line and of a log file's name.
LOG_LINE = r"(?s)\A(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - (.*?) - ([A-Z]+) - (.*)\z"
LOG_FILE = r"(?s)\A.*?([^/]+)_(\d{4})(\d\d)(\d\d)_(\d\d)(\d\d)(\d\d)\.log\z"


def training_log_rows(lines: DataFrame, layouts: list[list[str]]) -> DataFrame:
    """Long ``run, step, metric, value`` rows from ``run`` and CSV ``value`` lines.

    The header stands in the file once or more, and loss rows and evaluation rows
    have different columns under it. So headers are skipped, and a row takes the
    column names of the layout with as many fields; a row that fits none keeps its
    fields as ``column_1`` and so on, with the step last, where it is always written.
    Layouts of equal length could not be told apart and are an error.
    """
    lengths = [len(layout) for layout in layouts]
    if len(set(lengths)) < len(lengths):
        raise ValueError(f"layouts of {lengths} columns: rows cannot tell layouts of one length apart")
    kept = [name for name in lines.columns if name != "value"]
    fields = F.split("value", ",", -1)
    count = F.size("fields")
    names = F.transform(F.sequence(F.lit(1), count), lambda i: F.concat(F.lit("column_"), i.cast("string")))
    names = F.concat(F.slice(names, 1, count - 1), F.array(F.lit("step")))
    for layout in layouts:
        names = F.when(count == len(layout), F.array(*[F.lit(name) for name in layout])).otherwise(names)
    parsed = (
        lines.filter(trim_ws(F.col("value")) != "")
        .select(*kept, F.transform(fields, lambda field: trim_ws(field)).alias("fields"))
        .filter(~F.array_contains("fields", "step"))
        .select(*kept, F.arrays_zip(names.alias("metric"), F.col("fields").alias("value")).alias("cells"))
        .withColumn("step", F.get(F.filter("cells", lambda cell: cell["metric"] == "step"), F.lit(0))["value"])
    )
    return (
        parsed.select(*kept, F.expr("try_cast(step as bigint)").alias("step"), F.inline("cells"))
        .filter((F.col("metric") != "step") & (F.col("value") != ""))
        .withColumn("value", F.expr("try_cast(value as double)"))
    )


def run_of_file(path: Column) -> Column:
    """The run is the folder that holds the log."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+\z", 1)


def read_training_log(
    spark: SparkSession, path: str, layouts: list[list[str]], with_position: bool = False, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """The training logs below ``path`` as long rows, with the line's number in its file, from 0, on demand.

    Numbered logs are read by ranges of ``range_bytes``, so a log of any size is split.
    """
    if not with_position:
        lines = spark.read.text(path).select(run_of_file(F.col("_metadata.file_path")).alias("run"), "value")
    else:
        numbered = number_lines(read_lines(spark, path, range_bytes))
        lines = numbered.select(run_of_file(F.col("path")).alias("run"), "line", "value")
    return training_log_rows(lines, layouts)


def parse_run_log(lines: DataFrame, text: str = "value") -> DataFrame:
    """Add ``ts, script, level, message``; a continuation line has only the message.

    Log times have no zone, so none is put on them.
    """
    line = F.col(text)
    fits = line.rlike(LOG_LINE)
    part = {i: F.when(fits, F.regexp_extract(line, LOG_LINE, i)) for i in range(1, 5)}
    return lines.select(
        *[name for name in lines.columns if name != text],
        part[1].try_cast("timestamp_ntz").alias("ts"),
        part[2].alias("script"),
        part[3].alias("level"),
        F.coalesce(part[4], line).alias("message"),
    )


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """Run logs with the script and start time that the file name gives."""
    name = F.col("_metadata.file_path")
    started = F.regexp_replace(name, LOG_FILE, "$2-$3-$4 $5:$6:$7").try_cast("timestamp_ntz")
    lines = spark.read.text(path).select(
        F.nullif(F.regexp_extract(name, LOG_FILE, 1), F.lit("")).alias("log_script"), started.alias("started"), "value"
    )
    return parse_run_log(lines)


def read_log_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(path, record, ts, script, level, message) of the run logs below ``path``; lines of a traceback are part of the message.

    ``record`` is the number of the record's first line, from 0; lines before the first record are rows of their own,
    without time, script and level, numbered downwards from -1.
    """
    lines = stage(read_lines(spark, path, range_bytes), "lines")
    found = records(number_lines(lines), F.col("value").rlike(LOG_LINE))
    return parse_run_log(found)


def select_logs(logs: DataFrame, day=None, script: str | None = None, phrase: str | None = None) -> DataFrame:
    """Logs of a day, of scripts whose name starts so, or with a phrase in the message."""
    if day is not None:
        logs = logs.filter(F.to_date("ts") == F.lit(day).cast("date"))
    if script is not None:
        logs = logs.filter(F.col("script").startswith(script))
    if phrase is not None:
        logs = logs.filter(F.col("message").contains(phrase))
    return logs


def error_lines(logs: DataFrame) -> DataFrame:
    """Lines that have the word error anywhere, in any case."""
    return logs.filter(F.lower(F.concat_ws(" ", "script", "level", "message")).contains("error"))


def loss_curve(log: DataFrame, metrics=("train_loss", "eval_loss")) -> DataFrame:
    """The plotted series: the x-axis is the step."""
    return log.filter(F.col("metric").isin(*metrics)).select("run", F.col("step").alias("x"), "metric", "value")
