"""Patterns and expressions for type declarations in source text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS

# What counts as a declaration in each language.
NAME = "[A-Za-z_][A-Za-z0-9_]*+"
JAVA_KEYWORDS = "class|interface|enum"
CSHARP_KEYWORDS = "class|interface|struct|enum|record"
CSHARP_ACCESS = "public|private|internal|protected"
CSHARP_MODIFIER = "static|sealed|abstract|partial"
MASK = "____"

# Word boundaries spelled out: Python's \w is letters, numbers and the underscore,
# which no Java flag gives exactly.
WORD = r"[\p{L}\p{N}_]"
WORD_START = f"(?<!{WORD})"
WORD_END = f"(?!{WORD})"

_CSHARP_LEAD = f"(?:{CSHARP_ACCESS})?{WS}*+(?:{CSHARP_MODIFIER})?{WS}*+"
_ACCESS_PART = f"(?:(?:{CSHARP_ACCESS}){WS}*+)?"
_MODIFIER_PART = f"(?:(?:{CSHARP_MODIFIER}){WS}*+)?"

# Where a declaration starts, searched in a whole file. A look-ahead on the first three
# letters of the words a declaration can start with spares most positions the costlier
# tests. A C# declaration starts at any word boundary: at the first letter of a word,
# or already at the white space behind a word; that is tested before the run of white
# space is scanned, so that a long run is scanned once and not from each of its places.
_JAVA_START = "[cie][ln][atu]"
_CSHARP_START = "[aceiprs][abelnrtu][abciorstu]"
DECLARATION = {
    "python": rf"(?md)^class{WS}+{NAME}",
    "java": f"(?={_JAVA_START}){WORD_START}(?:{JAVA_KEYWORDS}){WS}+{NAME}{WORD_END}",
    "csharp": (
        f"(?:(?={_CSHARP_START}){WORD_START}{_ACCESS_PART}|(?<={WORD})(?={WS})(?={WS}*+{_CSHARP_START}){WS}++)"
        f"{_MODIFIER_PART}"
        f"(?:{CSHARP_KEYWORDS}){WS}+{NAME}{WORD_END}"
    ),
}

# The declaration at the very start of a snippet; group 1 is the declared name.
SNIPPET_NAME = {
    "python": rf"\Aclass{WS}+({NAME})",
    "java": rf"\A(?:{JAVA_KEYWORDS}){WS}+({NAME})",
    "csharp": rf"\A{_CSHARP_LEAD}(?:{CSHARP_KEYWORDS}){WS}+({NAME}){WORD_END}",
}

# Group 1 is everything of the declaration before the name.
SNIPPET_HEAD = {
    "python": rf"\A(class{WS}+){NAME}",
    "java": rf"\A((?:{JAVA_KEYWORDS}){WS}+){NAME}",
    "csharp": rf"\A({_CSHARP_LEAD}{WORD_START}(?:{CSHARP_KEYWORDS}){WS}+){NAME}{WORD_END}",
}

# Any text: replace the first mention of the name that the first declaration gives.
# Python looks the name up at column 0 but replaces its first mention anywhere,
# without a closing boundary; Java looks up and replaces at the same place.
TEXT_HEAD = {
    "python": rf"(?sd)\A(?=(?:|.*?\n)class{WS}+({NAME}))(.*?class{WS}+)\1",
    "java": rf"(?s)\A()(.*?{WORD_START}(?:{JAVA_KEYWORDS}){WS}+){NAME}{WORD_END}",
}


def by_language(language: Column, options: dict[str, Column], default: Column) -> Column:
    """Pick one expression per row by its language."""
    chosen = None
    for name, value in options.items():
        chosen = (F if chosen is None else chosen).when(language == name, value)
    return chosen.otherwise(default)


def snippet_name(snippet: Column, language: Column) -> Column:
    """The name declared at the start of a snippet."""
    options = {lang: F.regexp_extract(snippet, pattern, 1) for lang, pattern in SNIPPET_NAME.items()}
    return by_language(language, options, F.lit(None).cast("string"))


def mask_snippet(snippet: Column, name: Column, language: Column) -> Column:
    """Replace the name in the declaration that starts a snippet, and nothing else.

    A C# keyword glued to a modifier is no word of its own, so there the first
    proper mention further on is replaced, if any.
    """
    replacement = f"$1{MASK}"
    options = {lang: F.regexp_replace(snippet, pattern, replacement) for lang, pattern in SNIPPET_HEAD.items()}
    first_mention = F.concat(
        F.lit(rf"(?s)\A(.*?{WORD_START}(?:{CSHARP_KEYWORDS}){WS}+)"), name, F.lit(WORD_END)
    )
    options["csharp"] = F.when(snippet.rlike(SNIPPET_HEAD["csharp"]), options["csharp"]).otherwise(
        F.regexp_replace(snippet, first_mention, F.lit(replacement))
    )
    return by_language(language, options, snippet)


def mask_header(text: Column, language: Column) -> Column:
    """Mask the first declared name of any Python or Java text; other text is unchanged."""
    options = {lang: F.regexp_replace(text, pattern, f"$2{MASK}") for lang, pattern in TEXT_HEAD.items()}
    return by_language(language, options, text)
