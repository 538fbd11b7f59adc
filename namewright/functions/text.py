"""String expressions that follow Python's text rules on the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip(), str.split() and \s treat as
# white space, once as a character set and once as a regex class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"[\p{IsWhite_Space}\x1c-\x1f]"
NOT_WS = r"[^\p{IsWhite_Space}\x1c-\x1f]"

# File ending of each supported language.
EXTENSIONS = {"python": ".py", "java": ".java", "csharp": ".cs"}
LANGUAGES = tuple(EXTENSIONS)


def trim_ws(text: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def first_token(text: Column) -> Column:
    """The first white-space delimited word, or the empty string."""
    return F.coalesce(F.regexp_extract(text, rf"\A{WS}*({NOT_WS}*)", 1), F.lit(""))


def count_lines(text: Column) -> Column:
    """Newlines plus one."""
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def normalize_source(text: Column) -> Column:
    """Turn every run of white space into one space, and strip."""
    return F.trim(F.regexp_replace(text, f"{WS}+", " "))


def unify_newlines(text: Column) -> Column:
    """CRLF and lone CR become LF."""
    return F.regexp_replace(text, r"\r\n?", "\n")


def decode_source(raw: Column) -> Column:
    """UTF-8 bytes to text with LF line ends; bytes that are no UTF-8 vanish.

    For binary columns of a table. A genuine U+FFFD in the bytes is lost with the
    invalid ones; the file scan decodes on the executors and keeps it.
    """
    return unify_newlines(F.replace(F.make_valid_utf8(raw.cast("string")), F.lit("\ufffd"), F.lit("")))


def language_of(path: Column) -> Column:
    """Language by file ending; NULL for all others."""
    chosen = F.lit(None).cast("string")
    for language, ending in EXTENSIONS.items():
        chosen = F.when(path.endswith(ending), F.lit(language)).otherwise(chosen)
    return chosen


def repo_slug(url: Column) -> Column:
    """``https://host/owner/name.git/`` to ``owner__name``; one part stays itself."""
    parts = F.split(F.regexp_replace(F.rtrim(url, F.lit("/")), r"\.git\z", ""), "/", -1)
    last = F.element_at(parts, -1)
    return F.when(F.size(parts) >= 2, F.concat(F.try_element_at(parts, F.lit(-2)), F.lit("__"), last)).otherwise(last)


def preview(text: Column, length: int = 100) -> Column:
    """The first ``length`` characters, with dots when something was cut."""
    return F.when(F.length(text) > length, F.concat(F.left(text, F.lit(length)), F.lit("..."))).otherwise(text)


def or_unknown(value: Column) -> Column:
    """A missing language or repository counts as ``unknown``."""
    return F.coalesce(value, F.lit("unknown"))


def percent(share: Column) -> Column:
    """``0.1234`` to ``12.34%``, ties to even on the exact binary value."""
    return F.concat(F.replace(F.format_number(share * 100, 2), F.lit(","), F.lit("")), F.lit("%"))


def fixed(value: Column, places: int) -> Column:
    """A number with a fixed count of decimals and no thousands separators."""
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))
