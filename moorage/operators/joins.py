"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(rows: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join many rows to a table that is unique on ``on``.

    The planner broadcasts a lookup that is under the session's own limit, and
    adaptive execution, which the library's session turns on, cuts the
    partition of a hot key into pieces from its real size, whatever that is.
    """
    return rows.join(lookup, on, how)


#: Bytes that a broadcast row takes beside its values.
ROW_BYTES = 64


def counted_join(rows: DataFrame, lookup: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """`lookup_join` to a lookup that is read from files, broadcast only if its rows are under the session's own limit.

    The planner goes by the size of the files. Compressed ones hold some fifty times as much, which a broadcast would
    put whole into the driver. A lookup it would broadcast is counted first; one that is too large is merged.
    """
    return rows.join(lookup.hint("merge") if _packed(lookup) else lookup, on, how)


def _packed(lookup: DataFrame) -> bool:
    """Whether the planner takes a lookup for smaller than the session's broadcast limit, and its rows are larger."""
    plan, limit = lookup._jdf.queryExecution(), lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > limit:
        return False
    return lookup.count() * (ROW_BYTES + lookup._jdf.schema().defaultSize()) > limit


def matched_join(rows: DataFrame, others: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join two tables of about the same number of rows, such as two steps of every run.

    Both are shuffled and merged: parsed documents are guessed far smaller than they are, and the planner would send
    one side whole through the driver.
    """
    return rows.join(others.hint("merge"), on, how)


def attach_children(parent: DataFrame, child: DataFrame, on: str) -> DataFrame:
    """``parent LEFT JOIN child`` for a parent unique on ``on``.

    Written as the matched children plus the childless parents, so that the
    large child side neither shuffles for a small parent nor piles up on a hot one.
    """
    matched = lookup_join(child, parent, on)
    childless = parent.join(child.select(on).distinct(), on, "left_anti")
    columns = parent.columns + [name for name in child.columns if name != on]
    return matched.select(*columns).unionByName(childless, allowMissingColumns=True)


def update_from(target: DataFrame, source: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Overwrite ``columns`` in the target rows that ``source`` (unique on ``on``) matches."""
    fresh = source.select(on, F.lit(True).alias("_hit"), *[F.col(name).alias(f"_new_{name}") for name in columns])
    joined = target.join(fresh, on, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name)
            if name in columns
            else F.col(name)
            for name in target.columns
        ]
    )


def unseen(rows: DataFrame, known: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows whose key is not in ``known`` (NOT EXISTS). Where a key repeats in ``known``, pass it distinct."""
    if isinstance(on, str):
        return lookup_join(rows, known.select(on), on, "left_anti")
    return rows.join(known.select(*on), list(on), "left_anti")


def within(known: DataFrame, key: str, bounds: tuple | None) -> DataFrame:
    """The rows of ``known`` that rows with keys in these bounds can meet.

    The bounds reach the Parquet reader; files that hold their keys in order, as those of allocated keys do, are
    skipped outside of them. Without bounds there is nothing to meet.
    """
    if bounds is None:
        return known.where(F.lit(False))
    return known.where(F.col(key).between(*bounds))
