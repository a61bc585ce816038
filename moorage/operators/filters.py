"""Filters built from optional parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def where_given(rows: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Compare only the columns whose parameter was given; the scan sees just those predicates."""
    tests = [F.col(name) == value for name, value in wanted.items() if value is not None]
    return rows.where(reduce(lambda a, b: a & b, tests)) if tests else rows
