"""Row-level clean-up of example tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.declarations import mask_header
from ..functions.text import or_unknown

# The names the label has gone by, in the order they are tried.
LABEL_COLUMNS = ("class_name", "target", "label", "className")


def drop_empty(examples: DataFrame) -> DataFrame:
    """Keep the rows that have both a source and a target."""
    return examples.filter(
        (F.coalesce(F.length("source"), F.lit(0)) > 0) & (F.coalesce(F.length("target"), F.lit(0)) > 0)
    )


def with_defaults(examples: DataFrame) -> DataFrame:
    """A missing language or repository, column or value, becomes ``unknown``."""
    for name in ("language", "repo"):
        value = F.col(name) if name in examples.columns else F.lit(None).cast("string")
        examples = examples.withColumn(name, or_unknown(value))
    return examples


def resolve_label(examples: DataFrame) -> DataFrame:
    """Bring the label under its one name ``target``, whatever the file called it."""
    present = [name for name in LABEL_COLUMNS if name in examples.columns]
    if not present:
        raise ValueError(f"no label column among {', '.join(LABEL_COLUMNS)}")
    label = F.coalesce(*[F.col(name) for name in present])
    others = [name for name in present if name != "target"]
    return examples.withColumn("target", label).drop(*others)


def mask_sources(examples: DataFrame, mask: bool = True) -> DataFrame:
    """Mask the header of arbitrary source text before asking a model, if wanted."""
    if not mask:
        return examples
    return examples.withColumn("source", mask_header(F.col("source"), F.col("language")))


def first_samples(examples: DataFrame, n: int, order) -> DataFrame:
    """The first ``n`` rows in a stable order."""
    return examples.orderBy(*order).limit(n)


def without_large_fields(results: DataFrame) -> DataFrame:
    """Leave the token arrays out of a result before it is stored."""
    return results.drop("input_ids", "attention_mask", "labels")
