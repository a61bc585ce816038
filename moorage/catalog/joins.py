"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage import bindings as B
from moorage.catalog import warehouses
from moorage.catalog.registry import query
from moorage.catalog.tables import DETAILS_SQL, EXTRACT, appointment_details
from moorage.operators import dims, payloads, quality
from moorage.operators.facts import Lookup, with_dimension_keys
from moorage.operators.joins import unseen, update_from
from moorage.plans import appointment, encounter, sales
from moorage.sources import logs, tables

PATIENT_KEYS_SQL = "patient_key AS (SELECT patient_id, row_number() OVER (ORDER BY patient_id) AS patient_key FROM patient)"
DEPARTMENT_KEYS_SQL = """department_key AS (SELECT department_id, row_number() OVER (ORDER BY department_id)
  AS department_key FROM (SELECT DISTINCT department_id FROM encounter))"""


@query(
    f"""WITH {B.CARE_SQL}, {PATIENT_KEYS_SQL}, {DEPARTMENT_KEYS_SQL}
    SELECT encounter_id, patient_key, department_key, cost FROM encounter JOIN patient_key USING (patient_id)
    JOIN department_key USING (department_id)"""
)
def join_inner_lookup(spark, folder):
    visits = B.encounters(spark, folder)
    patient = dims.rebuild(B.patients(spark, folder), "patient_id", encounter.PATIENT, "patient_key")
    department = dims.rebuild(visits, "department_id", ["department_name"], "department_key")
    keyed = with_dimension_keys(
        visits, [Lookup(patient, "patient_id", "patient_key"), Lookup(department, "department_id", "department_key")]
    )
    return keyed.select("encounter_id", "patient_key", "department_key", "cost")


@query(f"WITH {B.CARE_SQL} SELECT patient_id, given_name, city, encounter_id, department_name, cost FROM extract")
def join_left_extract(spark, folder):
    rows = B.encounter_extract(spark, folder)
    return rows.select("patient_id", "given_name", "city", "encounter_id", "department_name", "cost")


@query(f"WITH {B.SALES_SQL} SELECT {EXTRACT} FROM extract")
def join_extract_5way(spark, folder):
    return sales.extract(**B.sales_tables(spark, folder)).select(*EXTRACT.split(", "))


@query(f"WITH {B.APPT_SQL} {DETAILS_SQL}")
def join_appointment_details(spark, folder):
    return appointment_details(spark, folder)


COST_SQL = f"""WITH {B.CARE_SQL} SELECT CAST(encounter_date AS VARCHAR) AS calendar_date, department_name,
  count(*) AS encounters, CAST(sum(cost) AS DECIMAL(18,2)) AS total_cost FROM encounter
  GROUP BY encounter_date, department_name"""


@query(COST_SQL)
def join_star_report(spark, folder):
    rows = encounter.cost_by_date_department(warehouses.loaded(spark, folder, "encounter"))
    return rows.withColumn("calendar_date", F.col("calendar_date").cast("string"))


@query(
    f"""WITH {B.APPT_SQL}, details AS ({DETAILS_SQL})
    SELECT d.*, a.starts_at, a.ends_at, CAST(CAST(a.starts_at AS DATE) AS VARCHAR) AS calendar_date,
      1 AS appointment_count FROM details d JOIN appointment a USING (appointment_id)"""
)
def join_snowflake_view(spark, folder):
    rows = appointment.details(warehouses.loaded(spark, folder, "snowflake"))
    return rows.withColumn("calendar_date", F.col("calendar_date").cast("string"))


@query(
    f"""WITH {B.CARE_SQL} SELECT patient_id, city FROM patient p WHERE NOT EXISTS
    (SELECT 1 FROM encounter e WHERE e.patient_id = p.patient_id AND e.encounter_date < DATE '1995-06-01')"""
)
def join_anti_not_exists(spark, folder):
    early = B.encounters(spark, folder).where("encounter_date < DATE '1995-06-01'").select("patient_id").distinct()
    return unseen(B.patients(spark, folder).select("patient_id", "city"), early, "patient_id")


@query(
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS copies FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM lineitem r WHERE r.l_orderkey = l.l_orderkey AND r.l_linenumber = l.l_linenumber
      AND r.l_returnflag = 'R') GROUP BY ALL"""
)
def join_anti_composite(spark, folder):
    lines = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag"])
    # One row per key on both sides before they meet, so a hot order is one row.
    every = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("copies"))
    returned = lines.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber").distinct()
    kept = unseen(every, returned, ["l_orderkey", "l_linenumber"])
    return kept.toDF("order_id", "line_number", "copies")


@query(
    f"""WITH {B.APPT_SQL} SELECT DISTINCT CAST(CAST(starts_at AS DATE) AS VARCHAR) AS day FROM appointment a
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
      AND CAST(o_orderdate AS DATE) = CAST(a.starts_at AS DATE))"""
)
def join_anti_expression_key(spark, folder):
    urgent = tables.scan(spark, folder, "orders", ["o_orderdate", "o_orderstatus", "o_orderpriority"])
    known = dims.distinct_days(urgent.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"), "o_orderdate")
    days = dims.distinct_days(B.appointments(spark, folder), "starts_at")
    return unseen(days, known, "calendar_date").select(F.col("calendar_date").cast("string").alias("day"))


@query(
    f"""WITH {B.APPT_SQL} SELECT appointment_id, p.patient_id IS NULL AS patient_missing,
    d.doctor_id IS NULL AS doctor_missing FROM appointment a
    LEFT JOIN (SELECT * FROM patient WHERE city <> 'BUILDING') p ON p.patient_id = a.patient_id
    LEFT JOIN (SELECT * FROM doctor WHERE is_active) d ON d.doctor_id = a.doctor_id
    WHERE p.patient_id IS NULL OR d.doctor_id IS NULL"""
)
def join_left_null_orphans(spark, folder):
    patient = B.patients(spark, folder).where("city <> 'BUILDING'").select("patient_id")
    doctor = B.doctors(spark, folder).where("is_active").select("doctor_id")
    rows = B.appointments(spark, folder).select("appointment_id", "patient_id", "doctor_id")
    rows = quality.lookup_left(rows, patient, "patient_id", "has_patient")
    rows = quality.lookup_left(rows, doctor, "doctor_id", "has_doctor")
    return rows.select(
        "appointment_id", F.col("has_patient").isNull().alias("patient_missing"),
        F.col("has_doctor").isNull().alias("doctor_missing"),
    ).where("patient_missing OR doctor_missing")


@query(
    f"""WITH {B.CARE_SQL} SELECT patient_id, city FROM patient p WHERE EXISTS
    (SELECT 1 FROM encounter e WHERE e.patient_id = p.patient_id AND e.cost > 400000)"""
)
def join_semi_exists(spark, folder):
    costly = B.encounters(spark, folder).where("cost > 400000").select("patient_id").distinct()
    return B.patients(spark, folder).select("patient_id", "city").join(costly, "patient_id", "left_semi")


@query(
    f"""WITH {B.CARE_SQL}, newest AS (SELECT patient_id, max(department_name) AS department FROM encounter
      WHERE department_id >= 3 GROUP BY patient_id)
    SELECT p.patient_id, p.family_name, coalesce(n.department, p.city) AS city FROM patient p
    LEFT JOIN newest n USING (patient_id)"""
)
def join_update_from(spark, folder):
    newest = B.encounters(spark, folder).where("department_id >= 3").groupBy("patient_id").agg(
        F.max("department_name").alias("city")
    )
    target = B.patients(spark, folder).select("patient_id", "family_name", "city")
    return update_from(target, newest, "patient_id", ["city"])


SHOP_OK_SQL = f"NOT {given_logs.TRANSPORT} AND NOT {given_logs.BUSINESS}"
SEGMENTS_SQL = f"""SELECT run_id, 'J' || n AS journey_id, leg AS pos, 'S' || n || name AS segment_id,
  'D' || n || name AS dated_segment_id, CASE WHEN leg = 0 THEN substr(segment, 1, 3) ELSE brand END AS origin,
  CASE WHEN leg = 1 OR size <= 30 THEN substr(kind, 1, 3) ELSE brand END AS destination
  FROM item, (VALUES (0, 'a'), (1, 'b')) t(leg, name) WHERE {SHOP_OK_SQL} AND (leg = 0 OR size > 30)"""


@query(f"WITH {FLAT_SQL} {SEGMENTS_SQL}")
def join_array_by_id(spark, folder):
    return payloads.segments(given_logs.parsed_step(spark, folder, "shopping", logs.SHOPPING_LISTS))


