"""Route id normalization (N10) and blank handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..settings import UNKNOWN_ROUTE


def normalize_route_id(c, unknown: str = UNKNOWN_ROUTE) -> Column:
    """NULL or blank to ``UNKNOWN``; trim and upper-case; an all-digit id
    loses its leading zeros (``0070`` -> ``70``, ``000`` -> ``0``)."""
    col = F.col(c) if isinstance(c, str) else c
    # Strip all surrounding whitespace, as Python's str.strip() does.
    text = F.upper(F.regexp_replace(col.cast("string"), r"^\s+|\s+$", ""))
    # Python's str.isdigit() on the trimmed text: ASCII digits only here.
    digits = text.rlike("^[0-9]+$")
    stripped = F.regexp_replace(text, "^0+(?=[0-9])", "")
    return (
        F.when(col.isNull() | (text == ""), F.lit(unknown))
        .when(digits, stripped)
        .otherwise(text)
    )


def null_if_nan_token(c) -> Column:
    """the bare token ``NaN`` (and ``"NaN"`` with quotes) means NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin("NaN", '"NaN"'), F.lit(None).cast("string")).otherwise(col)
