"""Gold rows and predictions that both arrive as streams."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_streams(
    gold: DataFrame,
    predictions: DataFrame,
    k: int,
    wait: str = "1 hour",
    delay: str = "10 minutes",
    key: str = "sample_id",
    time: str = "at",
) -> DataFrame:
    """Each gold row once, with its predictions, or with ``k`` empty ones when none came in time.

    Both streams have ``key`` and an event time ``time``; ``predictions`` has ``predictions``, all other
    columns come from ``gold``. A prediction counts if its time lies up to ``wait`` after its gold
    row's. Rows may arrive out of order by up to ``delay``; later ones Spark drops, as their sample has been
    decided. Repeats of a key are left out on both sides. Adds ``answered``; a gold row without an answer
    appears once the watermark has passed its ``wait``. Rows without key, or with
    no time after 1970 began (where watermarks start), are left out.

    Each side is shuffled once, by key, for both the repeats and the join. State holds the rows of the
    last ``wait`` and ``delay``, whatever the streams' length, and moves with the checkpoint.
    """

    def once(rows: DataFrame) -> DataFrame:
        known = rows.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        return known.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

    told = predictions.select(F.col(key).alias("_key"), F.col(time).alias("_time"), F.col("predictions").alias("_told"))
    told = told.withWatermark("_time", delay).filter("_key is not null and _time is not null")
    told = told.dropDuplicatesWithinWatermark(["_key"])
    in_time = (F.col("_time") >= F.col(time)) & (F.col("_time") <= F.col(time) + F.expr(f"interval {wait}"))
    joined = once(gold).join(told, (F.col(key) == F.col("_key")) & in_time, "left_outer")
    none = F.array_repeat(F.lit(""), k)
    return joined.withColumns(
        {"predictions": F.coalesce("_told", none), "answered": F.col("_key").isNotNull()}
    ).drop("_key", "_time", "_told")
