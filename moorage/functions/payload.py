"""Access to JSON whose shape differs from response to response.

A field that may hold one value or a list of them is read as a variant and
turned into an array here; every other field has a declared type.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_array(value: Column, element: str) -> Column:
    """``x`` and ``[x]`` both become ``[x]``; null, a missing field and ``[]`` become an empty array."""
    one = F.try_variant_get(value, "$", element)
    return F.coalesce(
        F.try_variant_get(value, "$", f"array<{element}>"),
        F.when(one.isNotNull(), F.array(one)),
        F.array().cast(f"array<{element}>"),
    )


def with_computed(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed exactly once per row.

    A plain column would be repeated inside every filter that is pushed below
    it. A one-element list and its explode keep the two apart.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it inside a loop over a list."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_of(items: Column) -> Column:
    """First element, NULL for an empty or missing array."""
    return F.get(items, F.lit(0))


def first_value(value: Column, element: str) -> Column:
    """First element of a one-or-many field."""
    return first_of(as_array(value, element))


def find_by_id(items: Column, id_field: str, wanted: Column) -> Column:
    """The list entry whose id equals ``wanted``; stays inside the row."""
    return once(wanted, lambda key: first_of(F.filter(items, lambda item: item[id_field] == key)))
