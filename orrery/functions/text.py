"""String helpers that keep the reference's text semantics inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import IDENTIFIER_PATTERN

# Python's str.strip() removes every Unicode white-space character, Spark's
# trim() only ' '.  These are Python's; trimming looks at both ends of a
# text only, a regex would look at each of its characters.
_WS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
                        0x3000)))

# fullmatch semantics: \z instead of $ so a trailing newline never matches
_IDENTIFIER_FULL = IDENTIFIER_PATTERN[:-1] + r"\z"

# Python float(): optional sign, digits with single underscores between
# them, optional fraction and exponent, or nan / inf / infinity words.
_DIGITS = r"\d(?:_?\d)*"
_NUMBER = (
    rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:nan|inf|infinity))\z"
)


def py_strip(col: Column) -> Column:
    """str(value).strip() for a string column (NULL stays NULL)."""
    return F.btrim(col, F.lit(_WS))


def is_identifier(col: Column) -> Column:
    return col.rlike(_IDENTIFIER_FULL)


def parse_float(col: Column) -> Column:
    """float(text) of Python: NULL when the text is not a float literal."""
    text = py_strip(col)
    gated = F.when(text.rlike(_NUMBER), F.regexp_replace(text, "_", ""))
    return gated.try_cast("double")


def blank_to_null(col: Column) -> Column:
    """'' (after strip) becomes NULL."""
    stripped = py_strip(col)
    return F.when(stripped != "", stripped)
