"""Column-level building blocks (JVM-side expressions only)."""

from skytally.functions.dates import format_date, parse_date, shift_days
from skytally.functions.text import (
    is_numeric_literal,
    is_on_time,
    field,
    split_fields,
    to_delay,
    trim_trailing_separators,
    with_fields,
)

__all__ = [
    "field",
    "format_date",
    "is_numeric_literal",
    "is_on_time",
    "parse_date",
    "shift_days",
    "split_fields",
    "to_delay",
    "trim_trailing_separators",
    "with_fields",
]
