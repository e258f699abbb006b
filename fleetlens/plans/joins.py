"""Joins of a fact table with a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """A plain join: adaptive execution broadcasts a side whose measured bytes
    are under the session's threshold, and otherwise splits skewed keys."""
    return fact.join(dim, on, how)
