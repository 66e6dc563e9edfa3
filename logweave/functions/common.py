"""Small shared helpers for column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_col(c) -> Column:
    """Accept a Column or a column name."""
    return c if isinstance(c, Column) else F.col(c)


def lit_or_col(c) -> Column:
    """Accept a Column or a Python literal."""
    return c if isinstance(c, Column) else F.lit(c)
