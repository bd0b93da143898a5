"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every white-space character of Unicode lies below U+3001
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip_whitespace(value: Column) -> Column:
    """Strip all leading and trailing white space; SQL ``trim`` only strips spaces.

    A value that begins and ends with a visible ASCII character is told by two comparisons of bytes.
    """
    plain = value.between("!", "~") & value.substr(-1, 1).between("!", "~")
    return F.when(plain, value).otherwise(F.btrim(value, F.lit(WHITESPACE)))


def blank_to_null(value: Column) -> Column:
    """Trim spaces; an empty rest becomes NULL."""
    return F.nullif(F.trim(value), F.lit(""))
