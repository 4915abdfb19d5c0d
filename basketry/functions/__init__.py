"""Column functions whose meaning differs between SQL engines, pinned down."""

from basketry.functions.casts import cast_to, to_int
from basketry.functions.dates import (
    day_number_sunday0,
    days_between,
    months_before,
    parse_timestamp,
)
from basketry.functions.keys import key_text, surrogate_key
from basketry.functions.numbers import greatest_strict, mean_of, ratio, rounded_ratio
from basketry.functions.text import address_part, is_blank

__all__ = [
    "address_part",
    "cast_to",
    "day_number_sunday0",
    "days_between",
    "greatest_strict",
    "is_blank",
    "mean_of",
    "months_before",
    "parse_timestamp",
    "ratio",
    "rounded_ratio",
    "key_text",
    "surrogate_key",
    "to_int",
]
