"""Column expressions; all of them stay inside the JVM."""

from linecheck.functions.geometry import deviation, distance, out_of_tolerance
from linecheck.functions.texts import (
    code_text,
    fixed_decimals,
    joined,
    line_text,
    missing_lines_text,
    model_key,
    result_text,
    suffix,
    without_spaces,
)
from linecheck.functions.values import later, midnight, number_or_zero

__all__ = [
    "code_text",
    "deviation",
    "distance",
    "fixed_decimals",
    "joined",
    "later",
    "line_text",
    "midnight",
    "missing_lines_text",
    "model_key",
    "number_or_zero",
    "out_of_tolerance",
    "result_text",
    "suffix",
    "without_spaces",
]
