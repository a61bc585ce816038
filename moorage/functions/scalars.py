"""Scalar column functions shared by the loads and the log reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """Date or timestamp to a ``yyyymmdd`` integer."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def date_key_from_text(text: Column) -> Column:
    """ISO date text to a ``yyyymmdd`` integer."""
    return F.replace(text, F.lit("-"), F.lit("")).cast("int")


def year_from_text(text: Column) -> Column:
    return F.substring(text, 1, 4).cast("int")


def month_from_text(text: Column) -> Column:
    return F.substring(text, 6, 2).cast("int")


def month_name(day: Column) -> Column:
    """Full English month name."""
    return F.date_format(day, "MMMM")


def compact_date(text: Column) -> Column:
    """``19850412`` to a date."""
    return F.to_date(text, "yyyyMMdd")


def iso_seconds(moment: Column) -> Column:
    """Timestamp to 19 characters of ISO text."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


def minutes_since(earlier: Column, later: Column) -> Column:
    """Minute boundaries crossed, so 10:00:59 to 10:01:00 is one."""
    return F.timestamp_diff("MINUTE", F.date_trunc("minute", earlier), F.date_trunc("minute", later))


def add_days_iso(day: Column, days: int) -> Column:
    return F.date_format(F.date_add(day, days), "yyyy-MM-dd")


def text_of(*parts: Column) -> Column:
    """Concatenation in which a NULL reads as empty text."""
    return F.concat_ws("", *[part.cast("string") for part in parts])


def blank(value: Column) -> Column:
    """True for NULL and for empty text; never NULL itself."""
    return value.isNull() | (value == "")


def filled(value: Column) -> Column:
    return value.isNotNull() & (value != "")


def first_filled(*values: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(value, F.lit("")) for value in values])


def join_filled(separator: str, *values: Column) -> Column:
    """Values joined with a separator, blanks skipped."""
    return F.concat_ws(separator, *[F.nullif(value, F.lit("")) for value in values])


def money(value: Column, precision: int = 18, scale: int = 2) -> Column:
    return value.cast(f"decimal({precision},{scale})")


def total(value: Column) -> Column:
    """Sum of money widened to decimal(18,2); zero when there is nothing to add."""
    return money(F.coalesce(F.sum(money(value)), F.lit(0)))
