"""Aggregations, sorts, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage import bindings as B
from moorage.catalog import warehouses
from moorage.catalog.joins import COST_SQL, SHOP_OK_SQL
from moorage.catalog.registry import query
from moorage.functions import scalars as S
from moorage.functions.payload import with_computed
from moorage.operators import audit, payloads, quality, reconcile, runlogs
from moorage.plans import encounter, sales
from moorage.sources import tables


def _staged(spark, folder):
    return {
        "patient": B.patients(spark, folder), "doctor": B.doctors(spark, folder),
        "appointment": B.appointments(spark, folder),
    }


COUNTS_SQL = f"""WITH {B.APPT_SQL} SELECT 'patient' AS table_name, count(*) AS row_count FROM patient
  UNION ALL SELECT 'doctor', count(*) FROM doctor UNION ALL SELECT 'appointment', count(*) FROM appointment"""


@query(COUNTS_SQL)
def agg_table_counts(spark, folder):
    return tables.labelled_counts(_staged(spark, folder))


@query(
    f"""WITH {B.APPT_SQL} SELECT 'all' AS part, count(*) AS row_count,
    CAST(coalesce(sum(cost), 0) AS DECIMAL(18,2)) AS amount FROM appointment
    UNION ALL SELECT 'none', 0, CAST(0 AS DECIMAL(18,2))"""
)
def agg_count_sum_total(spark, folder):
    rows = B.appointments(spark, folder)
    counted = lambda part, found: found.agg(F.count("*").alias("row_count"), S.total(F.col("cost")).alias("amount")).select(
        F.lit(part).alias("part"), "row_count", "amount"
    )
    return counted("all", rows).unionByName(counted("none", rows.where("cost < 0")))


@query(COST_SQL)
def agg_cost_by_date_department(spark, folder):
    rows = B.encounters(spark, folder).groupBy("encounter_date", "department_name").agg(
        F.count("*").alias("encounters"), S.total(F.col("cost")).alias("total_cost")
    )
    return rows.select(F.col("encounter_date").cast("string").alias("calendar_date"), "department_name", "encounters",
                       "total_cost")


def _sales_report_sql(month: str, alias: str) -> str:
    return f"""WITH {B.SALES_SQL} SELECT CAST(year(order_date) AS INTEGER) AS calendar_year, {month} AS {alias},
    category_name, CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(CAST(quantity * unit_price AS DECIMAL(14,2))) AS DECIMAL(18,2)) AS revenue FROM extract
    WHERE order_status = 'Completed' GROUP BY ALL"""


@query(_sales_report_sql("monthname(order_date)", "month_name"))
def agg_sales_by_month_category(spark, folder):
    return sales.by_month_category(warehouses.loaded(spark, folder, "sales"), "month_name")


@query(_sales_report_sql("CAST(month(order_date) AS INTEGER)", "calendar_month"))
def agg_sales_by_month_number(spark, folder):
    return sales.by_month_category(warehouses.loaded(spark, folder, "sales"), "calendar_month")


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1"""
)
def agg_having_duplicates(spark, folder):
    rows = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.duplicates(rows, ["l_orderkey", "l_linenumber"])


@query(f"WITH {B.CARE_SQL} SELECT DISTINCT department_id, department_name, city FROM extract WHERE encounter_id IS NOT NULL")
def agg_distinct_rows(spark, folder):
    rows = encounter.visits(B.encounter_extract(spark, folder))
    return rows.select("department_id", "department_name", "city").distinct()


@query(
    f"""WITH {B.APPT_SQL} SELECT (SELECT count(*) FROM patient) AS patients, (SELECT count(*) FROM doctor) AS doctors,
    count(*) AS appointments FROM appointment"""
)
def agg_scalar_row(spark, folder):
    staged = _staged(spark, folder)
    return tables.one_row({f"{name}s": rows.agg(F.count("*")) for name, rows in staged.items()})


@query(f"WITH {B.APPT_SQL} SELECT min(appointment_id) AS smallest, max(appointment_id) AS greatest FROM appointment")
def agg_min_max(spark, folder):
    return B.appointments(spark, folder).agg(
        F.min("appointment_id").alias("smallest"), F.max("appointment_id").alias("greatest")
    )


TESTS_SQL = """SELECT k, page, n, part, supplier, quantity, flag, t.name, t.failed FROM item,
  LATERAL (VALUES ('ordered before', shipped < ordered), ('small part', size > 40)) t(name, failed) WHERE quantity > 5"""
REQUESTS_SQL = "SELECT *, flag = 'R' AS failed FROM item"


@query(
    f"""WITH {FLAT_SQL} SELECT CAST(k AS INTEGER) AS iteration, count(*) FILTER (NOT failed) AS passed,
    count(*) FILTER (failed) AS failed FROM ({TESTS_SQL}) GROUP BY k"""
)
def agg_conditional_counts(spark, folder):
    rows = runlogs.tests(given_logs.parsed_reports(spark, folder))
    return rows.groupBy("iteration").agg(
        F.count_if(F.col("status") == runlogs.PASS).alias("passed"),
        F.count_if(F.col("status") != runlogs.PASS).alias("failed"),
    )


@query(
    f"""WITH {FLAT_SQL} SELECT CAST(k AS INTEGER) AS iteration, bool_and(NOT failed) AS all_passed
    FROM (SELECT k, failed FROM ({TESTS_SQL}) UNION ALL SELECT k, failed FROM ({REQUESTS_SQL})
      UNION ALL SELECT k, true FROM run WHERE n_lines = 0) GROUP BY k"""
)
def agg_all_pass(spark, folder):
    counted = runlogs.iteration_counts(given_logs.parsed_reports(spark, folder))
    clean = (F.col("requests") > 0) & (F.col("failed_requests") == 0) & (F.col("failed_tests") == 0)
    return counted.groupBy("iteration").agg(F.bool_and(clean).alias("all_passed"))


@query(
    """SELECT o_orderkey AS order_key, count(DISTINCT l_linenumber) AS names, count(DISTINCT l_linenumber) = 4 AS expected
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey"""
)
def agg_count_distinct_names(spark, folder):
    lines = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    names = lines.groupBy(F.col("l_orderkey").alias("order_key")).agg(F.count_distinct("l_linenumber").alias("names"))
    return names.withColumn("expected", F.col("names") == 4)


@query(
    f"""WITH {B.APPT_SQL} SELECT doctor_id, CAST(sum(cost) AS DECIMAL(18,2)) AS amount FROM appointment
    GROUP BY doctor_id"""
)
def agg_sum_by_key_map(spark, folder):
    return B.appointments(spark, folder).groupBy("doctor_id").agg(S.total(F.col("cost")).alias("amount"))


# ------------------------------------------------------------- sorts and top-k


@query(
    f"""WITH {B.SALES_SQL} SELECT order_date::VARCHAR AS order_date, category_name, order_id, line_number
    FROM extract ORDER BY 1, 2, 3, 4"""
)
def sort_multi_key(spark, folder):
    rows = sales.extract(**B.sales_tables(spark, folder))
    rows = rows.select(F.col("order_date").cast("string").alias("order_date"), "category_name", "order_id", "line_number")
    return rows.orderBy("order_date", "category_name", "order_id", "line_number")


@query(f"WITH {B.AUDIT_SQL} SELECT * FROM audit ORDER BY loaded_at DESC, run_id DESC LIMIT 1")
def topk_latest_audit(spark, folder):
    return audit.latest(B.audit_rows(spark, folder))


@query(f"WITH {FLAT_SQL} SELECT run_id, CASE WHEN n IS NOT NULL THEN 'P' || customer END AS pax_ref_id FROM head")
def first_array_element(spark, folder):
    return payloads.retrieved_order(given_logs.parsed_step(spark, folder, "retrieve")).select("run_id", "pax_ref_id")


ORIGIN, DESTINATION = "HOU", "ECO"
OFFER_ID_SQL = "'F-' || k || '-' || n"
#: The first direct line of a run, else its first line.
PICK_SQL = f"""SELECT run_id, arg_min(n, CASE WHEN direct THEN n - {given_logs.PAGE} ELSE n END) AS n FROM item
  WHERE {SHOP_OK_SQL} GROUP BY run_id"""
PICKED_SQL = f"WITH {FLAT_SQL} SELECT run_id, {OFFER_ID_SQL} AS offer_id FROM ({PICK_SQL}) JOIN item USING (run_id, n)"


@query(PICKED_SQL)
def first_matching_else_first(spark, folder):
    parsed = given_logs.parsed_step(spark, folder, "shopping")
    rows = with_computed(parsed, "offer", payloads.first_direct_else_first(ORIGIN, DESTINATION))
    return rows.where("offer IS NOT NULL").select("run_id", F.col("offer.offerId").alias("offer_id"))


@query(PICKED_SQL)
def topk_per_document(spark, folder):
    return payloads.best_per_document(given_logs.parsed_step(spark, folder, "shopping"), ORIGIN, DESTINATION)


# -------------------------------------------------------------- set operations


@query(COUNTS_SQL)
def union_all_counts(spark, folder):
    return tables.labelled_counts(_staged(spark, folder))


@query(
    f"""WITH {B.CARE_SQL} SELECT patient_id, department_id, city FROM extract WHERE encounter_id IS NOT NULL
    EXCEPT SELECT patient_id, department_id, city FROM extract WHERE cost < 300000"""
)
def except_reconcile(spark, folder):
    rows = encounter.visits(B.encounter_extract(spark, folder))
    columns = ["patient_id", "department_id", "city"]
    return reconcile.missing_from(rows.select(*columns), rows.where("cost < 300000"))


@query(
    """WITH lft AS (SELECT l_suppkey, l_returnflag, l_linenumber FROM lineitem),
    rgt AS (SELECT l_suppkey, CASE WHEN l_quantity < 3 THEN 'X' ELSE l_returnflag END AS l_returnflag, l_linenumber
      FROM lineitem WHERE l_quantity < 49)
    SELECT count(*) FILTER (side = 'l') AS only_left, count(*) FILTER (side = 'r') AS only_right, false AS equal FROM (
      SELECT 'l' AS side FROM (SELECT * FROM lft EXCEPT ALL SELECT * FROM rgt)
      UNION ALL SELECT 'r' FROM (SELECT * FROM rgt EXCEPT ALL SELECT * FROM lft))"""
)
def compare_both_ways(spark, folder):
    columns = ["l_suppkey", "l_returnflag", "l_linenumber"]
    rows = tables.scan(spark, folder, "lineitem", [*columns, "l_quantity"])
    changed = rows.where("l_quantity < 49").withColumn(
        "l_returnflag", F.when(F.col("l_quantity") < 3, "X").otherwise(F.col("l_returnflag"))
    )
    return reconcile.difference_counts(rows.select(*columns), changed.select(*columns))


