"""Field validity rules of the end events.

A text value counts only when it is non-blank after trimming; a number only
when it is numeric and non-zero (zero means "not sent"). NaN and infinities are
refused as well, a deliberate tightening: the stored value must be a number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() trims ASCII whitespace: space, tab, new line, return,
# vertical tab and form feed.
_SPACE_CHARS = " \t\n\r\x0b\x0c"


def strip_text(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACE_CHARS))


def valid_text(c: Column) -> Column:
    return c.isNotNull() & (strip_text(c) != "")


#: Decimal numbers and the names of what isn't finite; the text forms that only a JVM reads (12d, 0x1p3) are not among them.
DECIMAL_NUMBER = r"(?i)^\s*[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


def number_or_null(c: Column) -> Column:
    """Text or number to double; null when not a decimal number."""
    return F.when(c.cast("string").rlike(DECIMAL_NUMBER), c.try_cast("double"))


def finite(n: Column) -> Column:
    """``n`` is a double column holding a finite number."""
    return n.isNotNull() & ~F.isnan(n) & (F.abs(n) != F.lit(float("inf")))


def valid_number(n: Column) -> Column:
    """``n`` is a double column: present, non-zero and finite."""
    return finite(n) & (n != F.lit(0.0))
