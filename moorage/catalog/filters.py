"""Filters and predicates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage import bindings as B
from moorage.catalog.registry import query
from moorage.functions import scalars as S
from moorage.operators import errors
from moorage.plans import encounter, sales
from moorage.plans.appointment import STATUSES
from moorage.sources import tables


@query(f"WITH {B.SALES_SQL} SELECT order_id, line_number, quantity FROM extract WHERE order_status = 'Completed'")
def filter_status_equals(spark, folder):
    rows = sales.extract(**B.sales_tables(spark, folder))
    return rows.where(F.col("order_status") == sales.COMPLETED).select("order_id", "line_number", "quantity")


@query(f"WITH {B.CARE_SQL} SELECT patient_id, encounter_id, cost FROM extract WHERE encounter_id IS NOT NULL")
def filter_not_null(spark, folder):
    return encounter.visits(B.encounter_extract(spark, folder)).select("patient_id", "encounter_id", "cost")


@query(
    f"""WITH {B.APPT_SQL}, coded AS (SELECT appointment_id, CASE WHEN reason LIKE '%7' THEN NULL
      WHEN reason LIKE '%3' THEN 'Unknown' ELSE status END AS status FROM appointment)
    SELECT appointment_id, 'in' AS side FROM coded WHERE status IN ('Scheduled', 'Completed', 'Cancelled', 'NoShow')
    UNION ALL
    SELECT appointment_id, 'out' FROM coded WHERE status NOT IN ('Scheduled', 'Completed', 'Cancelled', 'NoShow')"""
)
def filter_domain(spark, folder):
    status = F.when(F.col("reason").endswith("7"), None).when(F.col("reason").endswith("3"), "Unknown")
    rows = B.appointments(spark, folder).select("appointment_id", status.otherwise(F.col("status")).alias("status"))
    # NULL is on neither side.
    side = F.when(F.col("status").isin(STATUSES), "in").when(~F.col("status").isin(STATUSES), "out")
    return rows.select("appointment_id", side.alias("side")).where("side IS NOT NULL")


@query(f"""WITH line AS ({B.LINE_SQL}), appointment AS ({B.appointment_sql(raw_end=True)})
    SELECT appointment_id, starts_at, ends_at FROM appointment WHERE ends_at <= starts_at""")
def filter_column_compare(spark, folder):
    rows = B.appointments(spark, folder, raw_end=True)
    return rows.where(F.col("ends_at") <= F.col("starts_at")).select("appointment_id", "starts_at", "ends_at")


@query(
    f"""WITH {B.CARE_SQL} SELECT patient_id, CAST(birth_date AS VARCHAR) AS birth_date FROM patient
    WHERE birth_date > DATE '1942-06-30'"""
)
def filter_future_date(spark, folder):
    as_of = date(1942, 6, 30)
    rows = B.patients(spark, folder).where(F.col("birth_date") > F.lit(as_of))
    return rows.select("patient_id", F.col("birth_date").cast("string").alias("birth_date"))


PLANTED_SQL = """planted AS (SELECT patient_id, birth_date, encounter_id,
  CASE WHEN department_id = 1 AND cost < 50000 THEN NULL ELSE encounter_date END AS encounter_date, department_id,
  CASE WHEN department_id = 2 AND cost < 50000 THEN NULL ELSE department_name END AS department_name,
  CASE WHEN department_id = 3 AND cost < 50000 THEN -cost ELSE cost END AS cost FROM extract)"""


def planted_extract(spark, folder):
    """The extract with a missing date, a missing name and a negative cost in some cheap visits."""
    cheap = lambda department: (F.col("department_id") == department) & (F.col("cost") < 50000)
    return B.encounter_extract(spark, folder).withColumns(
        {
            "encounter_date": F.when(~cheap(1) | F.col("cost").isNull(), F.col("encounter_date")),
            "department_name": F.when(~cheap(2) | F.col("cost").isNull(), F.col("department_name")),
            "cost": F.when(cheap(3), -F.col("cost")).otherwise(F.col("cost")).cast("decimal(12,2)"),
        }
    )


@query(
    f"""WITH {B.CARE_SQL}, {PLANTED_SQL} SELECT patient_id, encounter_id FROM planted
    WHERE birth_date > DATE '1985-01-01' OR (encounter_id IS NOT NULL AND (encounter_date IS NULL
      OR department_id IS NULL OR department_name IS NULL OR cost IS NULL OR cost < 0
      OR encounter_date < birth_date))"""
)
def filter_nested_or(spark, folder):
    rows = planted_extract(spark, folder)
    return rows.where(encounter.invalid_rows(date(1985, 1, 1)).broken).select("patient_id", "encounter_id")


@query(
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS quantity FROM lineitem
    WHERE l_quantity > 0 AND l_extendedprice >= 5000 AND l_discount >= 0.05"""
)
def filter_range(spark, folder):
    rows = tables.scan(spark, folder, "lineitem",
                       ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    inside = (F.col("l_quantity") > 0) & (F.col("l_extendedprice") >= 5000) & (F.col("l_discount") >= 0.05)
    return rows.where(inside).select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"))


@query(
    """SELECT 'both' AS parameters, count(*) AS row_count FROM orders WHERE o_orderstatus = 'F'
      AND o_orderpriority = '1-URGENT'
    UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'none', count(*) FROM orders"""
)
def filter_optional_param(spark, folder):
    from moorage.operators.filters import where_given

    rows = tables.scan(spark, folder, "orders", ["o_orderstatus", "o_orderpriority"])
    cases = {
        "both": {"o_orderstatus": "F", "o_orderpriority": "1-URGENT"},
        "status": {"o_orderstatus": "F", "o_orderpriority": None},
        "none": {"o_orderstatus": None, "o_orderpriority": None},
    }
    counts = tables.labelled_counts({name: where_given(rows, given) for name, given in cases.items()})
    return counts.withColumnRenamed("table_name", "parameters")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, CASE WHEN state <> 'P' THEN 'ticket-' ELSE 'original-' END || run_id AS ticket_number FROM run
    WHERE state <> 'P' OR segment <> 'BUILDING'"""
)
def filter_truthy(spark, folder):
    from moorage.operators import payloads

    found = payloads.ticket(given_logs.parsed_step(spark, folder, "ticket"))
    return found.where(S.filled(F.col("ticket_number"))).select("run_id", "ticket_number")


@query(f"""WITH {FLAT_SQL} SELECT DISTINCT run_id FROM item WHERE flag = 'A' OR (flag = 'R' AND quantity > 25)""")
def filter_regex(spark, folder):
    found = errors.exploded(given_logs.parsed_step(spark, folder, "confirm"))
    return found.where(errors.schedule_change(F.col("text"))).select("run_id").distinct()
