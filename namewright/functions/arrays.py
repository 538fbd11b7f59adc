"""Array expressions for token columns and prediction lists."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the label that the loss ignores.
IGNORED = -100


def running_lengths(pieces: Column, block: int = 256) -> Column:
    """Where each text ends when all of them stand one behind the other.

    Sums are listed block by block, so a very long array does not cost the square of
    its length.
    """

    def last_of(values):
        return F.try_element_at(values, F.lit(-1))

    def append_block(blocks, start):
        before = F.coalesce(last_of(last_of(blocks)), F.lit(0))
        sums = F.aggregate(
            F.slice(pieces, start, F.lit(block)),
            F.array().cast("array<bigint>"),
            lambda ends, piece: F.concat(ends, F.array(F.coalesce(last_of(ends), before) + F.length(piece))),
        )
        return F.concat(blocks, F.array(sums))

    starts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(block))
    return F.flatten(F.aggregate(starts, F.array().cast("array<array<bigint>>"), append_block))


def truncate(ids: Column, length: int) -> Column:
    """At most ``length`` leading elements."""
    return F.slice(ids, 1, length)


def mask_prompt(ids: Column, prompt_len: Column) -> Column:
    """Labels: the prompt's positions are ignored if anything follows the prompt.

    A prompt that fills the whole row is left as it is and trained on.
    """
    rest = F.slice(ids, prompt_len + 1, F.greatest(F.size(ids) - prompt_len, F.lit(0)))
    ignored = F.array_repeat(F.lit(IGNORED), prompt_len)
    return F.when(prompt_len < F.size(ids), F.concat(ignored, rest)).otherwise(ids)


def pad_right(values: Column, length: Column, filler: int) -> Column:
    """Fill up to ``length`` elements; a longer array stays as it is."""
    missing = F.greatest(length - F.size(values), F.lit(0)).cast("int")
    return F.concat(values, F.array_repeat(F.lit(filler), missing))


def attention_mask(ids: Column, length: Column) -> Column:
    """Ones for the tokens, zeros for the padding."""
    return pad_right(F.array_repeat(F.lit(1), F.size(ids)), length, 0)


def argmax(scores: Column) -> Column:
    """Zero-based place of the first greatest element."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def argmax_each(rows: Column) -> Column:
    """Argmax of every inner array."""
    return F.transform(rows, argmax)


def ordered_distinct(values: Column, k: int, drop_empty: bool = False) -> Column:
    """The first ``k`` different elements in their order."""
    if drop_empty:
        values = F.filter(values, lambda value: value != "")
    return F.slice(F.array_distinct(values), 1, k)
