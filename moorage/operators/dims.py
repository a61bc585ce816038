"""Dimension loads.

Each takes the current dimension and the source and returns the new state of
the whole dimension. Source rows are one per natural key; the quality gates
check that before a load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators.joins import lookup_join, unseen, update_from
from moorage.operators.keys import allocate, allocate_keys


def load_type1(dim: DataFrame, source: DataFrame, natural_key: str, attributes: list[str], key: str) -> DataFrame:
    """Overwrite attributes of known ids, add new ids, keep ids the extract left out. Keys never change."""
    source = source.select(natural_key, *attributes)
    kept = update_from(dim, source, natural_key, attributes)
    added = allocate_keys(unseen(source, dim, natural_key), natural_key, key, dim)
    return kept.unionByName(added.select(*dim.columns))


def load_insert_only(dim: DataFrame, source: DataFrame, natural_key: str, attributes: list[str], key: str) -> DataFrame:
    """Add unseen ids; known ids keep the attributes they have."""
    return dim.unionByName(new_members(dim, source, natural_key, attributes, key)[0])


def new_members(
    dim: DataFrame, source: DataFrame, natural_key: str, attributes: list[str], key: str, top: int | None = None
) -> tuple[DataFrame, int]:
    """The rows that an insert-only load adds, and the highest key with them; ``top`` is the highest so far, if it is known."""
    new = unseen(source.select(natural_key, *attributes).distinct(), dim, natural_key)
    added, top = allocate(new, natural_key, key, dim if top is None else top)
    return added.select(*dim.columns), top


def rebuild(source: DataFrame, natural_key: str, attributes: list[str], key: str) -> DataFrame:
    """Number the distinct rows from one again."""
    return allocate_keys(source.select(natural_key, *attributes).distinct(), natural_key, key)


def stacked(rows: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """The distinct rows that each of several dimensions takes from one source, from one read and one shuffle of it.

    ``columns`` names each dimension's columns. A result row has the dimension's name in ``_dim``, its own columns,
    and nulls in those of the others.
    """
    kinds = {name: rows.schema[name].dataType for names in columns.values() for name in names}
    entry = lambda dim, own: F.struct(
        F.lit(dim).alias("_dim"), *[(F.col(name) if name in own else F.lit(None).cast(kind)).alias(name) for name, kind in kinds.items()]
    )
    return rows.select(F.inline(F.array(*[entry(dim, own) for dim, own in columns.items()]))).distinct()


def distinct_spellings(source: DataFrame, text: str, name: str, collation: str | None = None) -> DataFrame:
    """Distinct values of a text column.

    With a collation, spellings that it treats as equal become one row that
    carries the smallest spelling in byte order.
    """
    values = source.where(F.col(text).isNotNull()).select(F.col(text).alias(name))
    if collation is None:
        return values.distinct()
    return values.groupBy(F.collate(F.col(name), collation).alias("_folded")).agg(F.min(name).alias(name)).drop("_folded")


def load_outrigger(
    outrigger: DataFrame, source: DataFrame, text: str, name: str, key: str, collation: str | None = None
) -> DataFrame:
    """Add the text values that have no key yet."""
    return outrigger.unionByName(new_texts(outrigger, source, text, name, key, collation)[0])


def new_texts(
    outrigger: DataFrame, source: DataFrame, text: str, name: str, key: str, collation: str | None = None, top: int | None = None
) -> tuple[DataFrame, int]:
    """The rows that `load_outrigger` adds, and the highest key with them; ``top`` as of `new_members`."""
    values = distinct_spellings(source, text, name, collation)
    if collation is None:
        new = unseen(values, outrigger, name)
    else:
        folded = F.collate(F.col(name), collation)
        known = outrigger.select(folded.alias("_folded")).distinct()
        new = values.withColumn("_folded", folded).join(known, "_folded", "left_anti").drop("_folded")
    added, top = allocate(new, name, key, outrigger if top is None else top)
    return added.select(*outrigger.columns), top


def swap_text_for_key(
    rows: DataFrame, outrigger: DataFrame, text: str, name: str, key: str, collation: str | None = None
) -> DataFrame:
    """Replace a text attribute by the key of its outrigger row and drop the text."""
    if collation is None:
        lookup = outrigger.select(F.col(name).alias(text), key)
        return lookup_join(rows, lookup, text).drop(text)
    folded = rows.withColumn(text, F.collate(F.col(text), collation))
    lookup = outrigger.select(F.collate(F.col(name), collation).alias(text), key)
    return folded.join(lookup, text).drop(text)


def normalise(
    dim: DataFrame, text: str, name: str, outrigger_key: str
) -> tuple[DataFrame, DataFrame]:
    """Star to snowflake: the dimension with a key in place of the text, and the new outrigger."""
    outrigger = allocate_keys(distinct_spellings(dim, text, name), name, outrigger_key)
    return swap_text_for_key(dim, outrigger, text, name, outrigger_key), outrigger


def _add_dates(dim: DataFrame, days: DataFrame) -> DataFrame:
    return dim.unionByName(unseen(days, dim, "calendar_date").select(*dim.columns))


def calendar_columns(day: Column) -> list[Column]:
    return [
        S.date_key(day).alias("date_key"),
        day.alias("calendar_date"),
        F.year(day).cast("smallint").alias("calendar_year"),
        F.month(day).cast("smallint").alias("calendar_month"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
    ]


def distinct_days(source: DataFrame, column: str) -> DataFrame:
    return source.select(F.col(column).cast("date").alias("calendar_date")).where("calendar_date IS NOT NULL").distinct()


def load_dates(dim: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Add one row per date that occurs; dates that do not occur get none."""
    return dim.unionByName(new_dates(dim, source, column))


def new_dates(dim: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """The rows that `load_dates` adds."""
    days = distinct_days(source, column).select(*calendar_columns(F.col("calendar_date")))
    return unseen(days, dim, "calendar_date").select(*dim.columns)


def load_dates_named(dim: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """As :func:`load_dates` with the month's name in place of the day."""
    return dim.unionByName(new_dates_named(dim, source, column))


def new_dates_named(dim: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """The rows that `load_dates_named` adds."""
    day = F.col("calendar_date")
    days = distinct_days(source, column).select(*calendar_columns(day)[:4], S.month_name(day).alias("month_name"))
    return unseen(days, dim, "calendar_date").select(*dim.columns)


def load_dates_text(dim: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """As :func:`load_dates` for dates held as ISO text."""
    text = F.col("calendar_date")
    days = (
        source.select(F.col(column).alias("calendar_date"))
        .where("calendar_date IS NOT NULL")
        .distinct()
        .select(
            S.date_key_from_text(text).alias("date_key"),
            text,
            S.year_from_text(text).alias("calendar_year"),
            S.month_from_text(text).alias("calendar_month"),
        )
    )
    return _add_dates(dim, days)
