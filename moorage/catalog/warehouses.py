"""Loaded warehouses that the report and check queries read.

Loading is its own set of queries; a report reads what a load has published.
Each warehouse is loaded once per session and folder, on first use.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from moorage import bindings as B
from moorage.plans import appointment, encounter, sales
from moorage.session import materialise, scratch_path, together
from moorage.sources import tables
from moorage.sources.store import SnapshotStore

AS_OF = date(2002, 1, 1)
LOADED_AT = datetime(2002, 1, 1, 6, 30, 45)
_LOADED: dict[tuple[str, str, str], SnapshotStore] = {}


def new_store(spark: SparkSession, name: str) -> SnapshotStore:
    return SnapshotStore(spark, scratch_path(spark, name))


def staged_appointments(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    source = {"patient": B.patients, "doctor": B.doctors, "appointment": B.appointments}
    return together(
        {
            name: lambda name=name, read=read: materialise(read(spark, folder), f"stage-{name}")
            for name, read in source.items()
        }
    )


def staged_sales(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(sales.extract(**B.sales_tables(spark, folder)), "stage-sales")


def _load_encounters(spark, folder, store):
    extract, copied = tables.stage_counted(B.encounter_extract(spark, folder), scratch_path(spark, "stage-extract"))
    encounter.run(store, extract, "run-1", copied, AS_OF, LOADED_AT)


def _load_star(spark, folder, store):
    appointment.run_star(store, **staged_appointments(spark, folder))


def _load_snowflake(spark, folder, store):
    appointment.run_snowflake(store, **staged_appointments(spark, folder), run_id="run-1", loaded_at=LOADED_AT)


def _load_sales(spark, folder, store):
    sales.run_star(store, staged_sales(spark, folder))


_LOADERS = {
    "encounter": _load_encounters, "star": _load_star, "snowflake": _load_snowflake, "sales": _load_sales,
}


def loaded(spark: SparkSession, folder: str, kind: str) -> dict[str, DataFrame]:
    """Tables of a warehouse loaded from ``folder``."""
    key = (spark.sparkContext.applicationId, folder, kind)
    if key not in _LOADED:
        store = new_store(spark, kind)
        _LOADERS[kind](spark, folder, store)
        _LOADED[key] = store
    return _LOADED[key].read()
