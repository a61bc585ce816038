"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorage.session import materialise


def allocate_keys(
    rows: DataFrame, natural_key: str | Sequence[str], key: str, after: int | DataFrame = 0
) -> DataFrame:
    """Give every row the next free number in natural-key order.

    ``after`` is the highest number in use, or the table that holds it.
    """
    return allocate(rows, natural_key, key, after)[0]


def allocate(
    rows: DataFrame, natural_key: str | Sequence[str], key: str, after: int | DataFrame = 0, parts: int | None = None
) -> tuple[DataFrame, int]:
    """Numbered rows, and the highest number in use with them; ``parts`` is the number of ranges, by default the session's.

    The rows are range-partitioned and sorted inside each range, so no task
    sorts everything. Each row's range and place in it are written down before
    use: a recomputed task can then not number the rows differently. Only the
    row count of each range comes to the driver.
    """
    order = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    placed = _placed(rows, order, parts)
    counts = placed.groupBy("_range").agg(F.count("*").alias("size"))
    if isinstance(after, DataFrame):
        counts = counts.unionByName(after.agg(F.lit(-1).alias("_range"), F.coalesce(F.max(key), F.lit(0)).alias("size")))
        after = 0
    sizes = dict(counts.collect())
    before, running = [], sizes.pop(-1, after)
    for number in range(max(sizes, default=0) + 1):
        before.append(running)
        running += sizes.get(number, 0)
    offset = F.get(F.lit(before).cast("array<bigint>"), F.col("_range"))
    numbered = placed.select((offset + F.col("_place") + 1).alias(key), *[F.col(name) for name in rows.columns])
    return numbered, running


def _placed(rows: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows sorted over ranges, with each row's ``_range`` and ``_place``, written down."""
    return materialise(
        rows.repartitionByRange(*([parts] if parts else []), *order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "keys",
    )


#: Rows of a group that one task still sorts and numbers by itself.
LARGE = 1_000_000


#: Rows that a task sorts or groups at once: so few that they stay in its memory.
ROWS_A_TASK = 100_000


def parts_of(rows: DataFrame) -> int:
    """How many tasks to deal these rows to: the session's number of partitions, or more for many rows."""
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_A_TASK))


#: Buckets that groups are dealt to by their hash, to see where a large one can be.
GROUP_BUCKETS = 4096


def large_groups(rows: DataFrame, group: str, most: int = LARGE) -> list:
    """The groups of more than ``most`` rows: at most one key per ``most`` rows of the table comes to the driver.

    Rows are counted by bucket first, which shuffles a row a bucket and task. Only groups of buckets with more than
    ``most`` rows, normally none, are counted one by one.
    """
    bucket = F.pmod(F.xxhash64(group), F.lit(GROUP_BUCKETS)).cast("int")
    filled = rows.groupBy(bucket.alias("_bucket")).agg(F.count("*").alias("_size")).where(F.col("_size") > most)
    full = [row[0] for row in filled.select("_bucket").collect()]
    if not full:
        return []
    sizes = rows.where(bucket.isin(full)).groupBy(group).agg(F.count("*").alias("_size"))
    return [row[0] for row in sizes.where(F.col("_size") > most).select(group).collect()]


def numbered_within(
    rows: DataFrame, group: str, order: Sequence[str], number: str, large: list | None = None
) -> DataFrame:
    """Number the rows of each group from one, in the given order.

    Rows are dealt by group, so that what follows by group needs no shuffle of
    its own. Only ``large`` groups, those of `large_groups` unless given, are
    cut into ranges, so that no task sorts a whole one.
    """
    large = large_groups(rows, group) if large is None else large
    whole = F.row_number().over(Window.partitionBy(group).orderBy(*order)).alias(number)
    if not large:
        return rows.select("*", whole)
    among = F.coalesce(F.col(group).isin([key for key in large if key is not None]), F.lit(None in large))
    return rows.where(~among).select("*", whole).unionByName(_numbered_in_ranges(rows.where(among), group, order, number))


def _numbered_in_ranges(rows: DataFrame, group: str, order: Sequence[str], number: str) -> DataFrame:
    """`numbered_within` for groups of any size.

    The ranges cut large groups too, so no task sorts a whole one. Rows are
    numbered inside their range; the only group of a range that can have begun
    in an earlier one is its first, and the rows that it has there are added.
    Only one row per range comes to the driver.
    """
    placed = _placed(rows, [group, *order])
    sizes = placed.groupBy("_range", F.struct(group).alias("_group")).agg(F.count("*").alias("size"))
    ends = sizes.groupBy("_range").agg(
        F.min("_group").alias("first"), F.max("_group").alias("last"), F.max_by("size", "_group").alias("size")
    ).collect()
    before = [0] * (max((end["_range"] for end in ends), default=0) + 1)
    last, running = None, 0
    for end in sorted(ends, key=lambda end: end["_range"]):
        if end["first"] != last:
            running = 0
        before[end["_range"]] = running
        if end["first"] != end["last"]:
            running = 0
        last, running = end["last"], running + end["size"]
    in_range = Window.partitionBy("_range", group).orderBy("_place")
    # The group of a range that holds its first row is the first one.
    begun = F.when(
        F.min("_place").over(Window.partitionBy("_range", group)) == 0,
        F.get(F.lit(before).cast("array<bigint>"), F.col("_range")),
    ).otherwise(0)
    return placed.select(*rows.columns, (F.row_number().over(in_range) + begun).alias(number))
