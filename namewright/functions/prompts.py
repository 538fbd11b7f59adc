"""Prompt templates and the cleaning of generated text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NOT_WS, WS, first_token, trim_ws

# Markers and templates the models are trained and asked with.
END_OF_TEXT = "<|endoftext|>"
CAUSAL_MARK = "Class name:"
SEQ2SEQ_MARK = "Name:"
TEMPLATES = {
    "seq2seq": ("Predict class name:\n", "\nName:"),
    "causal": ("", "\nClass name:"),
}
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]*"


def render_prompt(source: Column, template: str = "causal") -> Column:
    """The text a model is asked with."""
    before, after = TEMPLATES[template]
    return F.concat(F.lit(before), source, F.lit(after))


def training_text(source: Column, target: Column) -> Column:
    """Causal prompt, answer and end marker in one text."""
    return F.concat(render_prompt(source, "causal"), F.lit(" "), target, F.lit(END_OF_TEXT))


def _answer_part(raw: Column, prompt: Column | None) -> Column:
    """Text after the last answer mark, or without the prompt, up to the end marker."""
    part = F.substring_index(raw, CAUSAL_MARK, -1)
    if prompt is not None:
        part = F.when(raw.contains(CAUSAL_MARK), part).otherwise(F.replace(raw, prompt, F.lit("")))
    return trim_ws(F.substring_index(part, END_OF_TEXT, 1))


def completion_token(raw: Column, prompt: Column | None = None) -> Column:
    """First word of the first answer line, closing punctuation removed."""
    line = trim_ws(F.substring_index(_answer_part(raw, prompt), "\n", 1))
    return first_token(F.rtrim(line, F.lit(".:;,")))


def completion_line(raw: Column, prompt: Column | None = None) -> Column:
    """First answer line with all its words; punctuation is cut before the line is.

    Without the answer mark the whole answer is kept, line breaks included.
    """
    cleaned = trim_ws(F.rtrim(_answer_part(raw, prompt), F.lit(".:;,\n\t")))
    line = trim_ws(F.substring_index(cleaned, "\n", 1))
    return F.when(raw.contains(CAUSAL_MARK), line).otherwise(cleaned)


def completion_identifier(raw: Column) -> Column:
    """Identifier after the first ``Name:``, else the leading identifier, else empty."""
    after = F.regexp_extract(raw, rf"(?s)\A(?>.*?{SEQ2SEQ_MARK}){WS}*({IDENTIFIER})", 1)
    leading = F.regexp_extract(raw, rf"\A{WS}*({IDENTIFIER})", 1)
    return F.when(after != "", after).otherwise(leading)


def completion_probe(raw: Column) -> Column:
    """First word after ``Name:`` or ``EMPTY``; NULL when the mark is missing."""
    word = F.regexp_extract(raw, rf"(?s)\A(?>.*?{SEQ2SEQ_MARK}){WS}*({NOT_WS}*)", 1)
    return F.when(raw.contains(SEQ2SEQ_MARK), F.when(word != "", word).otherwise(F.lit("EMPTY")))
