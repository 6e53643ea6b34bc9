"""Column expressions shared by the operators (all built-in Spark functions)."""

from strata.functions.numbers import go_float, numeric_compare
from strata.functions.strings import normalize_text, trim_unicode, as_text
from strata.functions.dates import months_between_dates

__all__ = ["go_float", "numeric_compare", "normalize_text", "trim_unicode", "as_text",
           "months_between_dates"]
