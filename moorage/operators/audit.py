"""Audit rows of successful loads, under the two retry policies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.functions import scalars as S


def replace_run(audit: DataFrame, row: DataFrame) -> DataFrame:
    """A retry of a run replaces its row."""
    return audit.join(row.select("run_id"), "run_id", "left_anti").select(*audit.columns).unionByName(
        row.select(*audit.columns)
    )


def insert_once(audit: DataFrame, row: DataFrame) -> DataFrame:
    """A retry of a run keeps its first row."""
    return audit.unionByName(row.join(audit.select("run_id"), "run_id", "left_anti").select(*audit.columns))


def latest(audit: DataFrame) -> DataFrame:
    """Newest row, the greater run id first among equals; empty when there is none."""
    return audit.orderBy(F.desc("loaded_at"), F.desc("run_id")).limit(1)


def latest_with_age(audit: DataFrame, as_of) -> DataFrame:
    """Newest row with the minutes since it was loaded."""
    return latest(audit).withColumn("minutes_since_load", S.minutes_since(F.col("loaded_at"), as_of))


def latest_text(audit: DataFrame, rows: str) -> DataFrame:
    """Newest row as one line of text, or a fixed line when no load succeeded yet."""
    line = S.text_of(
        F.lit("Run: "), F.col("run_id"),
        F.lit("; Loaded UTC: "), S.iso_seconds(F.col("loaded_at")),
        F.lit("; Appointments: "), F.col(rows),
    )
    newest = F.max_by(line, F.struct("loaded_at", "run_id"))
    return audit.agg(F.coalesce(newest, F.lit("No successful load yet")).alias("summary"))
