"""Data-quality checks and their summaries.

A check returns its report, one row per rule, so clean and planted data alike
have an answer to compare.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from moorage import bindings as B
from moorage.catalog import warehouses
from moorage.catalog.filters import PLANTED_SQL, planted_extract
from moorage.catalog.registry import query
from moorage.functions import scalars as S
from moorage.operators import audit, quality, reconcile
from moorage.plans import appointment, encounter, sales
from moorage.session import materialise, scratch_path
from moorage.sources import tables


def _line(rule: str, code: int, violations: str, sample: str = "NULL", source: str = "") -> str:
    return (
        f"SELECT '{rule}' AS rule, {code} AS code, CAST(coalesce({violations}, 0) AS BIGINT) AS violations, "
        f"CAST({sample} AS VARCHAR) AS sample_key {source}"
    )


@query(
    f"WITH {B.CARE_SQL} "
    + " UNION ALL ".join(
        [
            _line("exact", 51000, "0", "count(*)", "FROM extract"),
            _line("wrong", 51000, "1", "count(*)", "FROM extract"),
            _line("missing", 51000, "1", "count(*)", "FROM extract"),
        ]
    )
)
def dq_expected_row_count(spark, folder):
    extract, copied = tables.stage_counted(B.encounter_extract(spark, folder), scratch_path(spark, "extract"))
    cases = {"exact": copied, "wrong": copied + 1, "missing": None}
    return quality.all_of([quality.row_count_is(extract, n, name, 51000) for name, n in cases.items()])


@query(
    f"WITH {B.APPT_SQL} "
    + " UNION ALL ".join(
        [
            _line("patient_count", 51004, "0", "count(*)", "FROM patient"),
            _line("doctor_count", 51004, "1", "count(*)", "FROM doctor"),
        ]
    )
)
def dq_copy_counts_match(spark, folder):
    patient, copied = tables.stage_counted(B.patients(spark, folder), scratch_path(spark, "patient"))
    doctor = B.doctors(spark, folder)
    # The count for the doctors is one too high; none is known for the appointments.
    given = {"patient": (patient, copied), "doctor": (doctor, doctor.count() + 1),
             "appointment": (B.appointments(spark, folder), None)}
    return quality.counts_match(given, 51004)


@query(f"WITH {B.APPT_SQL} SELECT appointment_id, cost FROM appointment WHERE cost >= (SELECT avg(cost) FROM appointment)")
def dq_lookup_scalar(spark, folder):
    rows = materialise(B.appointments(spark, folder), "appointments")
    total, number = rows.agg(F.sum("cost"), F.count("*")).first()
    return rows.where(F.col("cost") * number >= F.lit(total)).select("appointment_id", "cost")


@query(
    " UNION ALL ".join([_line("patients_empty", 51001, "0"), _line("none_selected", 51001, "1")])
)
def dq_not_empty(spark, folder):
    patient = B.patients(spark, folder)
    return quality.all_of(
        [
            quality.not_empty(patient, "patients_empty", 51001),
            quality.not_empty(patient.where("city = 'nowhere'"), "none_selected", 51001),
        ]
    )


DUPLICATES_SQL = "SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1"
FIRST_DUPLICATE_SQL = f"(SELECT l_orderkey || '/' || l_linenumber FROM ({DUPLICATES_SQL}) ORDER BY l_orderkey, l_linenumber LIMIT 1)"


@query(_line("order_line", 51102, "count(*)", FIRST_DUPLICATE_SQL, f"FROM ({DUPLICATES_SQL})"))
def dq_duplicate_key(spark, folder):
    rows = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.duplicate_key(rows, ["l_orderkey", "l_linenumber"], "order_line", 51102)


@query(
    f"WITH {B.CARE_SQL}, {PLANTED_SQL} "
    + _line(
        "invalid_rows", 51002, "count(*)", "min(patient_id)",
        """FROM planted WHERE birth_date > DATE '1985-01-01' OR (encounter_id IS NOT NULL AND (encounter_date IS NULL
        OR department_id IS NULL OR department_name IS NULL OR cost IS NULL OR cost < 0
        OR encounter_date < birth_date))""",
    )
)
def dq_invalid_rows(spark, folder):
    return quality.row_rules(planted_extract(spark, folder), [encounter.invalid_rows(date(1985, 1, 1))], "patient_id")


@query(
    f"WITH line AS ({B.LINE_SQL}), appointment AS ({B.appointment_sql(raw_end=True)}) "
    + _line("invalid_appointment", 51003, "count(*)", "min(appointment_id)", "FROM appointment WHERE ends_at <= starts_at")
)
def dq_invalid_appointment(spark, folder):
    rows = B.appointments(spark, folder, raw_end=True)
    return quality.row_rules(rows, [appointment.invalid_appointment()], "appointment_id")


@query(
    f"WITH {B.CARE_SQL}, versions AS (SELECT DISTINCT patient_id, CASE WHEN cost > 499000 THEN 'Other' ELSE city END "
    "AS city FROM extract), conflicts AS (SELECT patient_id FROM versions GROUP BY ALL HAVING count(*) > 1) "
    + _line("patient_attributes", 51003, "count(*)", "min(patient_id)", "FROM conflicts")
)
def dq_conflicting_patient_attributes(spark, folder):
    city = F.when(F.col("cost") > 499000, "Other").otherwise(F.col("city"))
    rows = B.encounter_extract(spark, folder).withColumn("city", city)
    return quality.conflicting_attributes(rows, "patient_id", encounter.PATIENT, "patient_attributes", 51003)


@query(
    f"WITH {B.CARE_SQL}, versions AS (SELECT DISTINCT department_id, CASE WHEN cost > 499000 AND department_id > 2 "
    "THEN 'Other' ELSE department_name END AS n FROM encounter), "
    "conflicts AS (SELECT department_id FROM versions GROUP BY ALL HAVING count(*) > 1) "
    + _line("department_name", 51004, "count(*)", "min(department_id)", "FROM conflicts")
)
def dq_conflicting_department_attributes(spark, folder):
    odd = (F.col("cost") > 499000) & (F.col("department_id") > 2)
    rows = B.encounters(spark, folder).withColumn("department_name", F.when(odd, "Other").otherwise(F.col("department_name")))
    return quality.conflicting_attributes(rows, "department_id", ["department_name"], "department_name", 51004)


@query(
    f"WITH {B.SALES_SQL}, versions AS (SELECT DISTINCT product_id, CASE WHEN quantity > 49 THEN 'Other' "
    "ELSE category_name END AS c FROM extract), conflicts AS (SELECT product_id FROM versions GROUP BY ALL "
    "HAVING count(*) > 1) "
    + " UNION ALL ".join(
        [
            _line("customer_conflict", 1, "0"),
            _line("product_conflict", 1, "count(*)", "min(product_id)", "FROM conflicts"),
            _line("store_conflict", 1, "0"),
            _line("order_line", 2, "0", "''"),
        ]
    )
)
def dq_conflict_by_unique_dim(spark, folder):
    rows = warehouses.staged_sales(spark, folder)
    odd = rows.withColumn("category_name", F.when(F.col("quantity") > 49, "Other").otherwise(F.col("category_name")))
    return sales.extract_report(odd)


@query(
    f"WITH {B.APPT_SQL} "
    + " UNION ALL ".join(
        [
            _line("missing_patient", 51002, "count(*)", "min(patient_id)",
                  "FROM appointment WHERE patient_id NOT IN (SELECT patient_id FROM patient WHERE city <> 'BUILDING')"),
            _line("missing_doctor", 51002, "count(*)", "min(doctor_id)",
                  "FROM appointment WHERE doctor_id NOT IN (SELECT doctor_id FROM doctor WHERE is_active)"),
        ]
    )
)
def dq_orphans(spark, folder):
    rows = B.appointments(spark, folder)
    patient = B.patients(spark, folder).where("city <> 'BUILDING'")
    doctor = B.doctors(spark, folder).where("is_active")
    return quality.all_of(
        [
            quality.orphans(rows, "patient_id", patient, "patient_id", "missing_patient", 51002),
            quality.orphans(rows, "doctor_id", doctor, "doctor_id", "missing_doctor", 51002),
        ]
    )


@query(
    f"WITH {B.CARE_SQL} "
    + " UNION ALL ".join(
        [
            _line("all_dimensions", 51005, "0"),
            _line("department_left_out", 51005, "count(*)", source="FROM encounter WHERE department_id = 5"),
        ]
    )
)
def dq_lookup_lost_rows(spark, folder):
    now = warehouses.loaded(spark, folder, "encounter")
    extract = B.encounter_extract(spark, folder)
    visits = B.encounters(spark, folder)
    reports = []
    for name, department in (("all_dimensions", now["dim_department"]),
                             ("department_left_out", now["dim_department"].where("department_id <> 5"))):
        rows = encounter.fact_rows(extract, now["dim_patient"], department, now["dim_date"])
        reports.append(quality.same_count(rows, visits, name, 51005))
    return quality.all_of(reports)


@query(
    f"WITH {B.CARE_SQL} "
    + " UNION ALL ".join(
        [
            _line("published", 51006, "0"),
            _line("cheap_left_out", 51006, "count(*)", "min(encounter_id)", "FROM encounter WHERE cost < 50000"),
        ]
    )
)
def dq_fact_reconciliation(spark, folder):
    fact = warehouses.loaded(spark, folder, "encounter")["fact_encounter"]
    rows = fact.select(*encounter.FACT_COLUMNS)
    return quality.all_of(
        [
            quality.no_rows(reconcile.missing_from(rows, fact), "encounter_id", "published", 51006),
            quality.no_rows(
                reconcile.missing_from(rows, fact.where("cost >= 50000")), "encounter_id", "cheap_left_out", 51006
            ),
        ]
    )


@query(
    f"""WITH {B.APPT_SQL} SELECT 'Passed' AS quality_status, count(*) AS appointment_rows,
    CAST(sum(cost) AS DECIMAL(18,2)) AS amount FROM appointment"""
)
def dq_warehouse_quality(spark, folder):
    return appointment.check_quality(warehouses.loaded(spark, folder, "snowflake"))


@query(
    f"""WITH {B.APPT_SQL} SELECT count(*) AS validated_rows, CAST(sum(cost) AS DECIMAL(18,2)) AS validated_cost
    FROM appointment"""
)
def dq_post_load_validation(spark, folder):
    return appointment.validate(warehouses.loaded(spark, folder, "snowflake"))


@query(
    f"""WITH {B.CARE_SQL} SELECT (SELECT count(*) FROM patient) AS patients, (SELECT count(DISTINCT department_id) FROM encounter) AS departments,
    (SELECT count(DISTINCT encounter_date) FROM encounter) AS dates, count(*) AS facts,
    CAST(sum(cost) AS DECIMAL(18,2)) AS total, (SELECT count(*) FROM extract) AS audited_rows FROM encounter"""
)
def dq_fixture_expectations(spark, folder):
    now = warehouses.loaded(spark, folder, "encounter")
    count = lambda name: now[name].agg(F.count("*"))
    return tables.one_row(
        {
            "patients": count("dim_patient"), "departments": count("dim_department"), "dates": count("dim_date"),
            "facts": count("fact_encounter"), "total": now["fact_encounter"].agg(S.total(F.col("cost"))),
            "audited_rows": now["load_audit"].agg(F.max("extract_rows")),
        }
    )


@query(
    " UNION ALL ".join(
        [
            _line("order_line_unique", 1, "count(*)", FIRST_DUPLICATE_SQL, f"FROM ({DUPLICATES_SQL})"),
            _line("order_line_not_null", 1, "0"),
        ]
    )
)
def dq_primary_key(spark, folder):
    rows = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.primary_key(rows, ["l_orderkey", "l_linenumber"], "order_line", 1)


@query(
    " UNION ALL ".join(
        [
            _line("line_order", 1, "count(*)", "min(l_orderkey)",
                  "FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"),
            _line("line_product", 1, "count(*)", "min(l_partkey)",
                  "FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)"),
            _line("line_store", 1, "count(*)", "min(l_suppkey)",
                  "FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)"),
        ]
    )
)
def dq_foreign_key(spark, folder):
    line = tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_partkey", "l_suppkey"])
    orders = tables.scan(spark, folder, "orders", ["o_orderkey", "o_orderstatus"]).where("o_orderstatus <> 'P'")
    part = tables.scan(spark, folder, "part", ["p_partkey"])
    supplier = tables.scan(spark, folder, "supplier", ["s_suppkey"])
    return quality.all_of(
        [
            quality.orphans(line, "l_orderkey", orders, "o_orderkey", "line_order", 1),
            quality.orphans(line, "l_partkey", part, "p_partkey", "line_product", 1),
            quality.orphans(line, "l_suppkey", supplier, "s_suppkey", "line_store", 1),
        ]
    )


@query(
    f"WITH {B.CARE_SQL} "
    + " UNION ALL ".join(
        [
            _line("email_required", 1, "count(*) FILTER (email IS NULL)", "min(patient_id) FILTER (email IS NULL)", "FROM patient"),
            _line("city_required", 1, "0"),
            _line("birth_date_required", 1, "0"),
        ]
    )
)
def dq_not_null(spark, folder):
    return quality.row_rules(B.patients(spark, folder), quality.required(["email", "city", "birth_date"], 1), "patient_id")


@query(
    f"WITH {B.CARE_SQL} "
    + " UNION ALL ".join(
        [
            _line("family_name_length", 1, "0"),
            _line("city_length", 1, "count(*)", "min(patient_id)", "FROM patient WHERE length(city) > 8"),
        ]
    )
)
def dq_text_length(spark, folder):
    rules = quality.longest({"family_name": 50, "city": 8}, 1)
    return quality.row_rules(B.patients(spark, folder), rules, "patient_id")


@query(
    " UNION ALL ".join(
        [
            _line("quantity_positive", 1, "0"),
            _line("price_range", 1, "count(*)", "min(l_orderkey)", "FROM lineitem WHERE NOT (l_extendedprice >= 1000)"),
            _line("flag_domain", 1, "count(*)", "min(l_orderkey)", "FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"),
            _line("shipped_in_time", 1, "count(*)", "min(l_orderkey)",
                  "FROM lineitem WHERE NOT (l_shipdate < TIMESTAMP '2001-10-01 00:00:00')"),
        ]
    )
)
def dq_check_constraints(spark, folder):
    rows = tables.scan(spark, folder, "lineitem",
                       ["l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"])
    check = lambda name, holds: quality.Rule(name, 1, ~holds)
    return quality.row_rules(
        rows,
        [
            check("quantity_positive", F.col("l_quantity") > 0),
            check("price_range", F.col("l_extendedprice") >= 1000),
            check("flag_domain", F.col("l_returnflag").isin("A", "N")),
            check("shipped_in_time", F.col("l_shipdate") < F.lit("2001-10-01 00:00:00").cast("timestamp_ntz")),
        ],
        "l_orderkey",
    )


@query(
    f"""WITH {B.APPT_SQL} SELECT v.column_name, v.problem, (SELECT count(*) FROM appointment) AS row_count FROM
    (VALUES ('booked_at', 'missing'), ('cost', 'type decimal(10,2)'), ('reason', 'unexpected')) v(column_name, problem)"""
)
def dq_schema_contract(spark, folder):
    rows = B.appointments(spark, folder)
    contract = {
        "appointment_id": "bigint", "patient_id": "bigint", "doctor_id": "bigint", "starts_at": "timestamp_ntz",
        "ends_at": "timestamp_ntz", "status": "string", "cost": "decimal(12,2)", "booked_at": "timestamp_ntz",
    }
    found = tables.inline(spark, quality.schema_differences(rows, contract), "column_name string, problem string")
    return found.withColumn("row_count", F.lit(rows.count()))


@query(
    f"""WITH {B.APPT_SQL} SELECT 'patient' AS part, 0 AS only_left, 0 AS only_right, true AS equal
    UNION ALL SELECT 'doctor', 0, 0, true UNION ALL SELECT 'appointment', 0, 0, true
    UNION ALL SELECT 'changed', count(*), count(*), false FROM appointment WHERE status = 'NoShow'"""
)
def dq_source_vs_warehouse(spark, folder):
    now = warehouses.loaded(spark, folder, "snowflake")
    patient = now["dim_patient"].join(now["dim_city"], "city_key").withColumnRenamed("city_name", "city")
    doctor = now["dim_doctor"].join(now["dim_specialty"], "specialty_key").withColumnRenamed("specialty_name", "specialty")
    source = B.appointments(spark, folder)
    changed = source.withColumn("reason", F.when(F.col("status") == "NoShow", "none").otherwise(F.col("reason")))
    # What a fact holds itself meets its dimensions as a digest.
    own = [name for name in source.columns if name not in ("patient_id", "doctor_id")]
    fact = now["fact_appointment"].select("patient_key", "doctor_key", "date_key", *own)
    details = appointment.details(now | {"fact_appointment": reconcile.digested(fact, own)})
    source, changed = [reconcile.digested(rows, own) for rows in (source, changed)]
    pairs = {
        "patient": (B.patients(spark, folder), patient),
        "doctor": (B.doctors(spark, folder), doctor),
        "appointment": (source, details),
        "changed": (changed, details),
    }
    return quality.all_of(
        [
            reconcile.difference_counts(left, right.select(*left.columns)).select(F.lit(part).alias("part"), "*")
            for part, (left, right) in pairs.items()
        ]
    )


@query(f"""WITH {B.APPT_SQL} SELECT count(*) AS compared, 0 AS different, 0 AS unmatched FROM appointment""")
def dq_fact_amount_by_id(spark, folder):
    fact = warehouses.loaded(spark, folder, "snowflake")["fact_appointment"]
    rows = B.appointments(spark, folder).select("appointment_id", "cost")
    joined = rows.join(fact.select("appointment_id", F.col("cost").alias("fact_cost")), "appointment_id", "left")
    return joined.agg(
        F.count("*").alias("compared"),
        F.count_if(F.col("cost") != F.col("fact_cost")).alias("different"),
        F.count_if(F.col("fact_cost").isNull()).alias("unmatched"),
    )


@query(f"WITH {B.APPT_SQL} SELECT count(*) AS facts, count(*) AS joined FROM appointment")
def dq_all_dims_join(spark, folder):
    now = warehouses.loaded(spark, folder, "snowflake")
    return tables.one_row(
        {"facts": now["fact_appointment"].agg(F.count("*")), "joined": appointment.details(now).agg(F.count("*"))}
    )


@query(
    f"""WITH {B.APPT_SQL} SELECT 'Passed; Appointments: ' || count(*) || '; Amount GBP: ' ||
    CAST(sum(cost) AS DECIMAL(18,2)) AS summary FROM appointment"""
)
def report_quality_summary(spark, folder):
    found = appointment.check_quality(warehouses.loaded(spark, folder, "snowflake"))
    return found.select(
        S.text_of(F.col("quality_status"), F.lit("; Appointments: "), F.col("appointment_rows"),
                  F.lit("; Amount GBP: "), F.col("amount")).alias("summary")
    )


@query(
    f"""WITH {B.APPT_SQL} SELECT 'Patients: ' || (SELECT count(*) FROM patient) || '; Doctors: ' ||
    (SELECT count(*) FROM doctor) || '; Appointments: ' || count(*) AS summary FROM appointment"""
)
def report_source_summary(spark, folder):
    counts = tables.one_row(
        {
            "patients": B.patients(spark, folder).agg(F.count("*")),
            "doctors": B.doctors(spark, folder).agg(F.count("*")),
            "appointments": B.appointments(spark, folder).agg(F.count("*")),
        }
    )
    return counts.select(
        S.text_of(F.lit("Patients: "), F.col("patients"), F.lit("; Doctors: "), F.col("doctors"),
                  F.lit("; Appointments: "), F.col("appointments")).alias("summary")
    )


@query(
    f"""WITH {B.AUDIT_SQL} SELECT *, date_diff('minute', loaded_at, TIMESTAMP '2002-01-01 00:00:15')
    AS minutes_since_load FROM audit ORDER BY loaded_at DESC, run_id DESC LIMIT 1"""
)
def report_latest_load(spark, folder):
    as_of = F.lit(datetime(2002, 1, 1, 0, 0, 15)).cast("timestamp_ntz")
    return audit.latest_with_age(B.audit_rows(spark, folder), as_of)
