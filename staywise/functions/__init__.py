"""Column expressions: text normalisation, numbers, ratios, tail probabilities."""

from staywise.functions.numbers import (
    difference,
    parse_percent,
    row_mean,
    safe_ratio,
    to_number,
    zero_if_missing,
)
from staywise.functions.text import (
    blank_to_null,
    extract_code,
    extract_key,
    humanize,
    normalize_category,
    normalize_target,
    strip,
)

__all__ = [
    "blank_to_null",
    "difference",
    "extract_code",
    "extract_key",
    "humanize",
    "normalize_category",
    "normalize_target",
    "parse_percent",
    "row_mean",
    "safe_ratio",
    "strip",
    "to_number",
    "zero_if_missing",
]
