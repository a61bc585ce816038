"""Proof that two tables hold the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType


def missing_from(rows: DataFrame, published: DataFrame) -> DataFrame:
    """Distinct rows that ``published`` lacks (EXCEPT: NULLs equal, one direction)."""
    return rows.subtract(published.select(*rows.columns))


#: Buckets that rows are dealt to by their content, a power of two; so many rows at most say which of them differ.
BUCKETS = 1024


def _in_buckets(rows: DataFrame) -> DataFrame:
    """Rows with ``_hash`` and ``_bucket``; a null counts by its place too."""
    columns = [F.col(f"`{name}`") for name in rows.columns]
    content = F.xxhash64(*columns, *[column.isNull() for column in columns])
    return _dealt(rows.withColumn("_hash", content))


def _dealt(rows: DataFrame) -> DataFrame:
    """Rows with the ``_bucket`` of their ``_hash``, by an expression that is never null: no filter on nulls hashes the rows once more."""
    return rows.withColumn("_bucket", F.col("_hash").bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets in which the two sides don't hold the same rows as often.

    A bucket's fingerprint is its number of rows and the sums of both halves of their hashes. Sums add up within each task, so
    one row a bucket and task is shuffled, whatever the tables' sizes. Buckets whose fingerprints agree by chance (once in some
    2 to the power 64) would be taken for equal.
    """
    half = F.lit((1 << 32) - 1)
    signed = lambda rows, sign: rows.select(
        "_bucket", F.lit(sign).alias("rows"), (F.col("_hash").bitwiseAND(half) * sign).alias("low"),
        (F.shiftrightunsigned("_hash", 32) * sign).alias("high"),
    )
    return (
        signed(left, 1).unionAll(signed(right, -1)).groupBy("_bucket")
        .agg(F.sum("rows").alias("rows"), F.sum("low").alias("low"), F.sum("high").alias("high"))
        .where("rows <> 0 OR low <> 0 OR high <> 0").select("_bucket")
    )


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, both directions at once.

    Only rows of buckets that differ are compared one by one, so equal tables are compared without a shuffle of rows.
    The comparison is one grouped sum of signs in place of two EXCEPT ALLs: each side is
    shuffled once and identical rows combine before the shuffle. ``surplus`` is
    positive for copies only ``left`` has.
    """
    columns = left.columns
    left, right = _in_buckets(left), _in_buckets(right.select(*columns))
    differing = F.broadcast(differing_buckets(left, right))  # at most BUCKETS numbers
    side = lambda rows, sign: rows.join(differing, "_bucket", "left_semi").select(*columns, F.lit(sign).alias("_sign"))
    signed = side(left, 1).unionByName(side(right, -1))
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("surplus")).where("surplus <> 0")


def digested(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with 96 bits of hashes, ``_content`` and ``_check``, in place of ``columns``; a null counts by its place too.

    For rows that must be shuffled before they are compared. Types must be the same on both sides, and single values.
    """
    values = [F.col(f"`{name}`") for name in columns]
    values += [value.isNull() for value in values]
    kept = [F.col(f"`{name}`") for name in rows.columns if name not in columns]
    return rows.select(*kept, F.xxhash64(*values).alias("_content"), F.hash(*values).alias("_check"))


def _single(kind) -> bool:
    """Whether hashes tell values of this type apart as grouping does: they skip nulls inside lists, and bytes aren't collations."""
    return isinstance(kind, AtomicType) and (not isinstance(kind, StringType) or kind.simpleString() == "string")


def _typed(column: Column, own, wanted) -> Column:
    return column if own == wanted else column.cast(wanted)


def difference_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: copies only on the left, copies only on the right, and whether both are none.

    As `differences`, but rows of buckets that differ are shuffled as digests of 12 bytes. Different rows whose 96 bits agree by
    chance would be taken for equal (some 1 in 10 to the power 12 for any two of 400 million). Rows with lists or other values
    that hashes can't tell apart are compared whole.
    """
    columns = [f"`{name}`" for name in left.columns]
    left, right = left.select(*columns), right.select(*columns)
    common = left.unionByName(right).schema
    left, right = [
        rows.select(*[_typed(F.col(name), own.dataType, field.dataType) for name, own, field in zip(columns, rows.schema, common)])
        for rows in (left, right)
    ]
    if all(_single(field.dataType) for field in common):
        left, right = [_dealt(digested(rows, rows.columns).withColumn("_hash", F.col("_content"))) for rows in (left, right)]
        differing = F.broadcast(differing_buckets(left, right))  # at most BUCKETS numbers
        left, right = [rows.join(differing, "_bucket", "left_semi") for rows in (left, right)]
        columns = ["_content", "_check"]
    side = lambda rows, sign: rows.select(*columns, F.lit(sign).alias("_sign"))
    found = side(left, 1).unionByName(side(right, -1)).groupBy(*columns).agg(F.sum("_sign").alias("surplus"))
    surplus = F.col("surplus")
    only = lambda rows: F.coalesce(F.sum(rows), F.lit(0)).cast("bigint")
    return found.agg(
        only(F.greatest(surplus, F.lit(0))).alias("only_left"),
        only(F.greatest(-surplus, F.lit(0))).alias("only_right"),
    ).withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))
