"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode White_Space property (tab, LF, VT, FF, CR, space, NEL, NBSP, U+1680,
# U+2000-U+200A, U+2028, U+2029, U+202F, U+205F, U+3000). F.trim strips only
# U+0020, so edges are stripped with a Java regex class instead.
_EDGE_SPACE = r"^\p{IsWhite_Space}+|\p{IsWhite_Space}+$"


def trim_unicode(col: Column) -> Column:
    return F.regexp_replace(col, _EDGE_SPACE, "")


def normalize_text(col: Column) -> Column:
    """Lower-case, then strip Unicode white space at both ends."""
    return trim_unicode(F.lower(col))


def as_text(col: Column) -> Column:
    """A value as record text: strings unchanged, NULL as the empty string."""
    return F.coalesce(col.cast("string"), F.lit(""))
