"""Column expressions shared by the operators (all built-in, JVM-side)."""

from tripcraft.functions.datetime import (
    parse_date_text,
    parse_datetime_text,
    time_of_day,
    to_ntz,
)
from tripcraft.functions.validity import (
    finite,
    number_or_null,
    valid_number,
    valid_text,
)

__all__ = [
    "finite",
    "number_or_null",
    "parse_date_text",
    "parse_datetime_text",
    "time_of_day",
    "to_ntz",
    "valid_number",
    "valid_text",
]
