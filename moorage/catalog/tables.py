"""Sources, sinks and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage import bindings as B
from moorage.catalog.registry import query
from moorage.operators import runlogs
from moorage.plans import sales
from moorage.session import materialise, scratch_path
from moorage.sources import logs, tables
from moorage.sources.store import SnapshotStore


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem")
def scan_table_columns(spark, folder):
    return tables.scan(spark, folder, "lineitem", ["l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag"])


@query(f"WITH {B.CARE_SQL} SELECT patient_id, city, encounter_id, department_name, cost FROM extract")
def scan_view_extract(spark, folder):
    B.encounter_extract(spark, folder).createOrReplaceTempView("patient_extract")
    return spark.table("patient_extract").select("patient_id", "city", "encounter_id", "department_name", "cost")


# The readable names of the order statuses.
STATUS_NAMES = [("F", "Completed"), ("O", "Open"), ("P", "Pending")]


@query(
    """SELECT o_orderkey, v.name AS status_name FROM orders
    JOIN (VALUES ('F', 'Completed'), ('O', 'Open'), ('P', 'Pending')) v(code, name) ON v.code = o_orderstatus"""
)
def scan_inline_values(spark, folder):
    names = tables.inline(spark, STATUS_NAMES, "o_orderstatus string, status_name string")
    rows = tables.scan(spark, folder, "orders", ["o_orderkey", "o_orderstatus"])
    return rows.join(names, "o_orderstatus").select("o_orderkey", "status_name")


@query(
    f"""WITH {FLAT_SQL} SELECT CAST(k AS INTEGER) AS iteration, CAST(n_lines AS INTEGER) AS requests,
    CASE WHEN flag = 'R' THEN 'fail' WHEN n IS NOT NULL THEN 'pass' END AS first_status, false AS missing FROM head"""
)
def scan_run_report_json(spark, folder):
    path = scratch_path(spark, "run-reports")
    given_logs.reports(spark, folder).write.text(path, compression="gzip")
    found = logs.readable(logs.read_run_reports(spark, path))
    return found.select(
        F.col("iterationIndex").alias("iteration"),
        F.size("results").alias("requests"),
        F.get("results", F.lit(0))["status"].alias("first_status"),
        "missing",
    )


@query(
    """SELECT CAST(event_id AS VARCHAR) AS run_id, 'PL_' || event_type AS pipeline,
    CASE WHEN value < 20 THEN 'InProgress' WHEN value < 40 THEN 'Failed' WHEN value < 60 THEN 'Cancelled'
      ELSE 'Succeeded' END AS status,
    CAST(CASE WHEN value < 20 THEN 0 ELSE 3 END AS INTEGER) AS activities FROM events"""
)
def scan_pipeline_runs_json(spark, folder):
    path = scratch_path(spark, "pipeline-runs")
    given_logs.pipeline_runs(spark, folder).write.text(path)
    found = logs.readable(logs.read_pipeline_runs(spark, path))
    return found.select(
        F.col("runId").alias("run_id"), "pipeline", "status",
        F.coalesce(F.size("activities"), F.lit(0)).alias("activities"),
    )


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 1 AS seq, 'shopping' AS step,
    CASE WHEN NOT {given_logs.TRANSPORT} THEN 'T1-' || run_id END AS trx_id FROM run"""
)
def scan_api_payloads(spark, folder):
    path = scratch_path(spark, "api-log")
    log = tables.stage(given_logs.api_log(spark, folder, ["shopping"]), path)
    body = F.parse_json("body")
    trx = F.try_variant_get(body, "$.data.iataAirShopping[0].payloadAttributes.trxId", "string")
    return log.select("run_id", "seq", "step", trx.alias("trx_id"))


def _appointment_tables(spark, folder):
    return {
        "patient": B.patients(spark, folder),
        "doctor": B.doctors(spark, folder),
        "appointment": B.appointments(spark, folder),
    }


@query(
    f"""WITH {B.APPT_SQL} SELECT 1 AS version, a.appointment_id, p.city, d.specialty, a.cost FROM appointment a
    JOIN patient p ON p.patient_id = a.patient_id JOIN doctor d ON d.doctor_id = a.doctor_id"""
)
def snapshot_extract(spark, folder):
    store = SnapshotStore(spark, scratch_path(spark, "snapshot"))
    source = _appointment_tables(spark, folder)
    store.publish(source, 0)
    store.publish({"patient": source["patient"].withColumn("city", F.lit("moved"))}, 1)
    # All three tables come from version 1 although version 2 is out.
    frozen = store.read(1)
    return (
        frozen["appointment"]
        .join(frozen["patient"].select("patient_id", "city"), "patient_id")
        .join(frozen["doctor"].select("doctor_id", "specialty"), "doctor_id")
        .select(F.lit(1).alias("version"), "appointment_id", "city", "specialty", "cost")
    )


@query(f"WITH {B.APPT_SQL} SELECT appointment_id, doctor_id, status, cost FROM appointment")
def stage_overwrite(spark, folder):
    path = scratch_path(spark, "stage")
    rows = B.appointments(spark, folder).select("appointment_id", "doctor_id", "status", "cost")
    tables.stage(rows, path)
    return tables.stage(rows, path)


@query(
    f"""WITH {B.APPT_SQL} SELECT 'patient' AS table_name, count(*) AS copied, count(*) AS staged FROM patient
    UNION ALL SELECT 'doctor', count(*), count(*) FROM doctor
    UNION ALL SELECT 'appointment', count(*), count(*) FROM appointment"""
)
def stage_copy_with_count(spark, folder):
    staged, copied = {}, {}
    for name, rows in _appointment_tables(spark, folder).items():
        staged[name], copied[name] = tables.stage_counted(rows, scratch_path(spark, name))
    reported = spark.createDataFrame(list(copied.items()), "table_name string, copied bigint")
    return tables.labelled_counts(staged).withColumnRenamed("row_count", "staged").join(reported, "table_name")


EXTRACT = (
    "order_id, line_number, customer_name, customer_city, country_code, product_name, category_name, store_name, "
    "store_city, order_status, quantity, unit_price"
)


@query(f"WITH {B.SALES_SQL} SELECT {EXTRACT} FROM extract")
def create_table_as_select(spark, folder):
    return materialise(sales.extract(**B.sales_tables(spark, folder)), "sales-extract").select(*EXTRACT.split(", "))


@query(
    f"""WITH {B.CARE_SQL}, departments AS (SELECT DISTINCT department_id, department_name FROM extract
      WHERE encounter_id IS NOT NULL)
    SELECT d.department_id, d.department_name, (SELECT count(*) FROM departments) AS departments,
      count(*) AS encounters FROM departments d JOIN extract e ON e.department_id = d.department_id GROUP BY ALL"""
)
def select_into_temp(spark, folder):
    extract = B.encounter_extract(spark, folder).where("encounter_id IS NOT NULL")
    departments = materialise(extract.select("department_id", "department_name").distinct(), "departments")
    counts = extract.groupBy("department_id").agg(F.count("*").alias("encounters"))
    return departments.join(counts, "department_id").withColumn("departments", F.lit(departments.count()))


DETAILS_SQL = """SELECT a.appointment_id, p.patient_id, p.given_name AS patient_given_name,
  p.family_name AS patient_family_name, p.city AS city_name, d.doctor_id, d.given_name AS doctor_given_name,
  d.family_name AS doctor_family_name, d.specialty AS specialty_name, a.status, a.reason, a.cost
  FROM appointment a JOIN patient p ON p.patient_id = a.patient_id JOIN doctor d ON d.doctor_id = a.doctor_id"""


def appointment_details(spark, folder):
    patient = tables.prefixed(
        B.patients(spark, folder).select("patient_id", "given_name", "family_name", F.col("city").alias("city_name")),
        "patient_", keep=("patient_id", "city_name"),
    )
    doctor = tables.prefixed(
        B.doctors(spark, folder).select(
            "doctor_id", "given_name", "family_name", F.col("specialty").alias("specialty_name")
        ),
        "doctor_", keep=("doctor_id", "specialty_name"),
    )
    rows = B.lookup_join(B.appointments(spark, folder), patient, "patient_id")
    return B.lookup_join(rows, doctor, "doctor_id").drop("starts_at", "ends_at")


@query(f"WITH {B.APPT_SQL} {DETAILS_SQL}")
def define_view(spark, folder):
    appointment_details(spark, folder).createOrReplaceTempView("appointment_details")
    return spark.sql("SELECT * FROM appointment_details")


@query(
    f"""WITH {B.APPT_SQL} SELECT 1 AS version_before, 1 AS version_after, true AS failed,
    (SELECT count(*) FROM patient) AS patients, (SELECT count(*) FROM appointment) AS appointments"""
)
def publish_all_or_nothing(spark, folder):
    store = SnapshotStore(spark, scratch_path(spark, "publish"))
    source = _appointment_tables(spark, folder)
    before = store.publish({"patient": source["patient"], "appointment": source["appointment"]}, 0)

    def refuse(written):
        raise ValueError("gate refused")

    try:
        store.publish({"patient": source["patient"].withColumn("city", F.lit("wrong"))}, before, refuse)
        failed = False
    except ValueError:
        failed = True
    counts = tables.labelled_counts(store.read())
    size = lambda name: F.max(F.when(F.col("table_name") == name, F.col("row_count")))
    return counts.agg(size("patient").alias("patients"), size("appointment").alias("appointments")).select(
        F.lit(before).alias("version_before"), F.lit(store.version()).alias("version_after"),
        F.lit(failed).alias("failed"), "*",
    )


# --------------------------------------------------------------- projections

COLUMN_MAP = {
    "AppointmentId": ("appointment_id", "bigint"),
    "DoctorId": ("doctor_id", "int"),
    "StartsAtUtc": ("starts_at", "timestamp_ntz"),
    "Status": ("status", "string"),
    "CostGBP": ("cost", "decimal(12,2)"),
}


@query(
    f"""WITH {B.APPT_SQL} SELECT appointment_id AS "AppointmentId", CAST(doctor_id AS INTEGER) AS "DoctorId",
    starts_at AS "StartsAtUtc", status AS "Status", CAST(cost AS DECIMAL(12,2)) AS "CostGBP" FROM appointment"""
)
def map_columns_cast(spark, folder):
    return tables.mapped(B.appointments(spark, folder), COLUMN_MAP)


@query(f"WITH {B.APPT_SQL} {DETAILS_SQL}")
def rename_prefix_columns(spark, folder):
    return appointment_details(spark, folder)


@query(
    f"""WITH line AS ({B.LINE_SQL}) SELECT l_orderkey AS order_id, l_linenumber AS line_number,
    CAST(quantity * CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS sales_amount
    FROM line JOIN part ON p_partkey = line.part"""
)
def computed_amount(spark, folder):
    from moorage.operators.facts import with_amount

    return with_amount(B.sales_tables(spark, folder)["line"]).select("order_id", "line_number", "sales_amount")


@query(
    f"""WITH {B.APPT_SQL} SELECT patient_id, coalesce(email, 'none') AS email, true AS is_active, 1 AS patient_count
    FROM patient"""
)
def constant_measure(spark, folder):
    rows = tables.with_defaults(
        B.patients(spark, folder),
        {"email": F.lit("none"), "is_active": F.lit(True), "patient_count": F.lit(1)},
    )
    return rows.select("patient_id", "email", "is_active", "patient_count")


@query(
    f"""WITH {B.APPT_SQL}, city AS (SELECT city, row_number() OVER (ORDER BY city) AS city_key
      FROM (SELECT DISTINCT city FROM patient))
    SELECT patient_id, given_name, family_name, email, city_key FROM patient JOIN city USING (city)"""
)
def add_then_drop_column(spark, folder):
    from moorage.operators import dims

    patient, _ = dims.normalise(B.patients(spark, folder).drop("birth_date"), "city", "city_name", "city_key")
    return patient


@query(
    """SELECT CAST(event_id AS VARCHAR) AS run_id, t.name, t.status, t.error_message, t.copied FROM events,
    LATERAL (VALUES ('Copy', 'Succeeded', NULL, CAST(json_extract(props, '$.k') AS BIGINT)),
      ('Load', CASE WHEN value < 40 THEN 'Failed' ELSE 'Succeeded' END,
        CASE WHEN value < 40 THEN 'value ' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END, NULL),
      ('Validate', CASE WHEN value < 40 THEN 'Skipped' WHEN value < 60 THEN 'Cancelled' ELSE 'Succeeded' END,
        NULL, NULL)) t(name, status, error_message, copied) WHERE value >= 20"""
)
def activity_projection(spark, folder):
    return runlogs.activities(given_logs.parsed_pipeline_runs(spark, folder)).select(
        "run_id", "name", "status", "error_message", "copied"
    )


@query(f"WITH {B.CARE_SQL} SELECT * EXCLUDE (birth_date, email, c_nationkey) FROM patient ORDER BY patient_id")
def select_star_ordered(spark, folder):
    return B.patients(spark, folder).drop("birth_date", "email").select("*").orderBy("patient_id")


