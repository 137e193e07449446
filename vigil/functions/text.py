"""Text helpers: Unicode whitespace, splits, safe casts — all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.split()/re \s (UNICODE) whitespace as a Java regex class: \s plus the
# information separators, NEL and every Unicode space separator (Zs/Zl/Zp).
WHITESPACE_CLASS = "[\\s\\x1c-\\x1f\\x85\\p{Z}]"
# Its characters, for trims.
WHITESPACE = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
              + "\u2028\u2029\u202f\u205f\u3000")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c) -> Column:
    """Remove every whitespace run (also inside quoted text). A regex class beats ``translate``
    here: Spark's translate maps each character through a boxed lookup."""
    return F.regexp_replace(_c(c), WHITESPACE_CLASS + "+", "")


def split_on_space(c) -> Column:
    """``s.split(" ")``: single spaces, empty strings kept."""
    return F.split(_c(c), " ", -1)


def split_on_whitespace(c) -> Column:
    """``s.split()``: whitespace runs, no empty strings."""
    arr = F.split(_c(c), WHITESPACE_CLASS + "+", -1)
    return F.filter(arr, lambda w: w != F.lit(""))


def try_double(c) -> Column:
    """Text to double; NULL instead of a failed job on bad text."""
    return _c(c).try_cast("double")
