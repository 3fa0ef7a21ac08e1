"""Column expressions; all of them stay inside whole-stage code generation."""

from .calendar import weekday_name
from .rates import rate, round_half_even, two_decimals
from .statistics import pearson
from .values import parse_boolean, parse_timestamp, to_double, to_long, to_text

__all__ = [
    "parse_boolean",
    "parse_timestamp",
    "pearson",
    "rate",
    "round_half_even",
    "to_double",
    "to_long",
    "to_text",
    "two_decimals",
    "weekday_name",
]
