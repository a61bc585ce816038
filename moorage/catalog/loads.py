"""Warehouse-load operators and whole loads.

Most load two batches: the first holds what happened before 1998, the second
everything with some attributes changed. The SQL states the final result.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from moorage import bindings as B
from moorage.catalog import warehouses
from moorage.catalog.joins import DEPARTMENT_KEYS_SQL, PATIENT_KEYS_SQL
from moorage.catalog.aggregates import _sales_report_sql
from moorage.catalog.registry import query
from moorage.functions import scalars as S
from moorage.operators import audit, dims, facts, keys, quality, reconcile
from moorage.operators.joins import unseen
from moorage.plans import appointment, encounter, sales
from moorage.session import materialise, together
from moorage.sources import tables

SPLIT = "1998-01-01"


def _numbered(old: str, order: str) -> str:
    """SQL for keys given in two batches; ``old`` says whether a row came with the first."""
    return (
        f"CASE WHEN {old} THEN 0 ELSE count(*) FILTER ({old}) OVER () END + "
        f"row_number() OVER (PARTITION BY {old} ORDER BY {order})"
    )


def _moved(column: str = "city"):
    return F.when(F.col("email").isNull(), F.lit("Moved")).otherwise(F.col(column))


@query(
    f"""WITH {B.CARE_SQL}, first AS (SELECT DISTINCT patient_id FROM encounter WHERE encounter_date < DATE '{SPLIT}'),
    rows AS (SELECT p.*, f.patient_id IS NOT NULL AS old FROM patient p LEFT JOIN first f USING (patient_id)
      WHERE f.patient_id IS NOT NULL OR city <> 'BUILDING')
    SELECT {_numbered("old", "patient_id")} AS patient_key, patient_id, family_name,
      CASE WHEN city <> 'BUILDING' AND email IS NULL THEN 'Moved' ELSE city END AS city FROM rows"""
)
def load_dim_type1(spark, folder):
    patient = B.patients(spark, folder)
    seen = B.encounters(spark, folder).where(f"encounter_date < DATE '{SPLIT}'").select("patient_id").distinct()
    columns = encounter.PATIENT
    dim = encounter.empty(spark)["dim_patient"]
    dim = dims.load_type1(dim, patient.join(seen, "patient_id", "left_semi"), "patient_id", columns, "patient_key")
    second = patient.where("city <> 'BUILDING'").withColumn("city", _moved())
    dim = dims.load_type1(materialise(dim, "dim"), second, "patient_id", columns, "patient_key")
    return dim.select("patient_key", "patient_id", "family_name", "city")


@query(
    f"""WITH {B.SALES_SQL}, rows AS (SELECT customer_id, any_value(customer_city) AS city,
      bool_or(order_date < DATE '{SPLIT}') AS old FROM extract GROUP BY customer_id)
    SELECT {_numbered("old", "customer_id")} AS customer_key, customer_id,
      CASE WHEN old THEN city ELSE 'Moved' END AS customer_city FROM rows"""
)
def load_dim_insert_only(spark, folder):
    rows = warehouses.staged_sales(spark, folder)
    dim = sales.empty(spark)["dim_customer"]
    for batch in (rows.where(f"order_date < DATE '{SPLIT}'"), rows.withColumn("customer_city", F.lit("Moved"))):
        dim = materialise(dims.load_insert_only(dim, batch, "customer_id", sales.CUSTOMER, "customer_key"), "dim")
    return dim.select("customer_key", "customer_id", "customer_city")


@query(
    f"""WITH {B.SALES_SQL} SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name,
    category_name FROM (SELECT DISTINCT product_id, product_name, category_name FROM extract)"""
)
def load_dim_rebuild(spark, folder):
    rows = sales.extract(**B.sales_tables(spark, folder))
    return dims.rebuild(rows, "product_id", sales.PRODUCT, "product_key")


@query(
    f"""WITH {B.APPT_SQL}, rows AS (SELECT specialty, bool_or(is_active AND specialty < 'NATION_2') AS old FROM doctor
      GROUP BY specialty)
    SELECT {_numbered("old", "specialty")} AS specialty_key, specialty AS specialty_name FROM rows"""
)
def load_dim_outrigger(spark, folder):
    doctor = B.doctors(spark, folder)
    dim = tables.inline(spark, [], "specialty_key bigint, specialty_name string")
    for batch in (doctor.where("is_active AND specialty < 'NATION_2'"), doctor):
        dim = dims.load_outrigger(dim, batch, "specialty", "specialty_name", "specialty_key")
    return dim


@query(
    f"""WITH {B.APPT_SQL}, names AS (SELECT specialty, row_number() OVER (ORDER BY specialty) AS k
      FROM (SELECT DISTINCT specialty FROM doctor)),
    named AS (SELECT specialty, k FROM names UNION ALL SELECT 'General', (SELECT max(k) + 1 FROM names))
    SELECT row_number() OVER (ORDER BY doctor_id) AS doctor_key, doctor_id, email, k AS specialty_key FROM doctor
    JOIN named ON named.specialty = CASE WHEN is_active THEN doctor.specialty ELSE 'General' END"""
)
def load_dim_with_outrigger_key(spark, folder):
    doctor = B.doctors(spark, folder)
    changed = doctor.withColumn("specialty", F.when(F.col("is_active"), F.col("specialty")).otherwise("General"))
    now = appointment.empty(spark, appointment.SNOWFLAKE)
    dim, names = now["dim_doctor"], now["dim_specialty"]
    for batch in (doctor, changed):
        names = materialise(dims.load_outrigger(names, batch, "specialty", "specialty_name", "specialty_key"), "names")
        dim = materialise(
            appointment.load_with_outrigger(
                dim, batch, names, "specialty", "specialty_name", "specialty_key", "doctor_id", "doctor_key"
            ),
            "dim",
        )
    return dim.select("doctor_key", "doctor_id", "email", "specialty_key")


_DATE_SQL = """CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS calendar_date,
  CAST(year(d) AS INTEGER) AS calendar_year, CAST(month(d) AS INTEGER) AS calendar_month"""


def _readable(dim):
    return dim.select(
        "date_key", F.col("calendar_date").cast("string").alias("calendar_date"),
        F.col("calendar_year").cast("int").alias("calendar_year"),
        F.col("calendar_month").cast("int").alias("calendar_month"), *dim.columns[4:],
    )


@query(
    f"""WITH {B.CARE_SQL} SELECT {_DATE_SQL}, CAST(day(d) AS INTEGER) AS day_of_month
    FROM (SELECT DISTINCT encounter_date AS d FROM encounter)"""
)
def load_dim_date(spark, folder):
    visits = B.encounters(spark, folder)
    dim = encounter.empty(spark)["dim_date"]
    for batch in (visits.where(f"encounter_date < DATE '{SPLIT}'"), visits):
        dim = dims.load_dates(dim, batch, "encounter_date")
    return _readable(dim).withColumn("day_of_month", F.col("day_of_month").cast("int"))


@query(
    f"""SELECT {_DATE_SQL}, monthname(d) AS month_name FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def load_dim_date_named(spark, folder):
    orders = B.sales_tables(spark, folder)["order"]
    dim = sales.empty(spark)["dim_date"]
    for batch in (orders.where(f"order_date < DATE '{SPLIT}'"), orders):
        dim = dims.load_dates_named(dim, batch, "order_date")
    return _readable(dim)


@query(f"SELECT {_DATE_SQL} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def load_dim_date_text(spark, folder):
    orders = B.sales_tables(spark, folder)["order"].withColumn("order_date", F.col("order_date").cast("string"))
    dim = tables.inline(spark, [], "date_key int, calendar_date string, calendar_year int, calendar_month int")
    return dims.load_dates_text(dim, orders, "order_date")


@query("SELECT 1000 + row_number() OVER (ORDER BY o_orderkey) AS encounter_key, o_orderkey FROM orders")
def allocate_keys(spark, folder):
    return keys.allocate_keys(tables.scan(spark, folder, "orders", ["o_orderkey"]), "o_orderkey", "encounter_key", 1000)


FACT_SQL = f"""SELECT encounter_id, patient_key, department_key,
  CAST(strftime(encounter_date, '%Y%m%d') AS INTEGER) AS date_key, cost FROM encounter JOIN patient_key USING (patient_id)
  JOIN department_key USING (department_id)"""


@query(f"WITH {B.CARE_SQL}, {PATIENT_KEYS_SQL}, {DEPARTMENT_KEYS_SQL} {FACT_SQL}")
def lookup_fact_keys(spark, folder):
    extract = materialise(B.encounter_extract(spark, folder), "extract")
    visits = encounter.visits(extract)
    return encounter.fact_rows(
        extract,
        dims.rebuild(extract, "patient_id", encounter.PATIENT, "patient_key"),
        dims.rebuild(visits, "department_id", ["department_name"], "department_key"),
        materialise(dims.load_dates(encounter.empty(spark)["dim_date"], visits, "encounter_date"), "dates"),
    )


_APPT_FACT = "appointment_key bigint, appointment_id bigint, date_key int, status string, cost decimal(10,2)"


def _two_batches(spark, folder):
    """Appointments before the split, then all with cancelled ones dearer and a day later."""
    rows = materialise(B.appointments(spark, folder), "appointments")
    cancelled = F.col("status") == "Cancelled"
    moved = rows.withColumns(
        {
            "cost": F.when(cancelled, F.col("cost") + 1).otherwise(F.col("cost")).cast("decimal(10,2)"),
            "starts_at": F.when(cancelled, F.col("starts_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("starts_at")),
        }
    )
    keyed = lambda part: part.select(
        "appointment_id", S.date_key(F.col("starts_at")).alias("date_key"), "status", "cost"
    )
    return keyed(rows.where(f"starts_at < TIMESTAMP_NTZ '{SPLIT} 00:00:00'")), keyed(moved)


def _merged(spark, batches):
    """The fact table after its batches were merged one by one, month by month."""
    store, like = warehouses.new_store(spark, "fact"), tables.inline(spark, [], _APPT_FACT)
    for batch in batches:
        draft = store.draft()
        facts.merge(draft, "fact", batch, like, "appointment_id", "appointment_key", facts.month_of())
        draft.publish()
    return store.read()["fact"]


@query(
    f"""WITH {B.APPT_SQL}, rows AS (SELECT *, starts_at < TIMESTAMP '{SPLIT} 00:00:00' AS old,
      status = 'Cancelled' AS moved FROM appointment)
    SELECT {_numbered("old", "appointment_id")} AS appointment_key, appointment_id,
      CAST(strftime(starts_at + to_days(CASE WHEN moved THEN 1 ELSE 0 END), '%Y%m%d') AS INTEGER) AS date_key, status,
      CAST(cost + CASE WHEN moved THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS cost FROM rows"""
)
def load_fact_upsert(spark, folder):
    return _merged(spark, _two_batches(spark, folder))


@query(
    f"""WITH {B.SALES_SQL}, rows AS (SELECT *, order_date < DATE '{SPLIT}' AS old FROM extract
      WHERE order_status = 'Completed')
    SELECT {_numbered("old", "order_id, line_number")} AS sales_key, order_id, line_number,
      CAST(quantity + CASE WHEN old THEN 0 ELSE 1 END AS INTEGER) AS quantity,
      CAST((quantity + CASE WHEN old THEN 0 ELSE 1 END) * unit_price AS DECIMAL(14,2)) AS sales_amount FROM rows"""
)
def load_fact_insert_only(spark, folder):
    rows = warehouses.staged_sales(spark, folder).where(F.col("order_status") == sales.COMPLETED)
    fact = tables.inline(
        spark, [], "sales_key bigint, order_id bigint, line_number int, quantity int, sales_amount decimal(14,2)"
    )
    later = rows.withColumn("quantity", F.col("quantity") + 1)
    for batch in (rows.where(f"order_date < DATE '{SPLIT}'"), later):
        fact = facts.insert_only(fact, facts.with_amount(batch), ["order_id", "line_number"], "sales_key")
        fact = materialise(fact, "fact")
    return fact


@query(
    f"""WITH {B.SALES_SQL} SELECT row_number() OVER (ORDER BY order_id, line_number) AS sales_key, order_id, line_number,
    quantity, CAST(quantity * unit_price AS DECIMAL(14,2)) AS sales_amount FROM extract
    WHERE order_status = 'Completed'"""
)
def load_fact_rebuild(spark, folder):
    rows = sales.extract(**B.sales_tables(spark, folder)).where(F.col("order_status") == sales.COMPLETED)
    completed = facts.with_amount(rows).select("order_id", "line_number", "quantity", "sales_amount")
    return facts.rebuild(completed, ["order_id", "line_number"], "sales_key")


@query(
    f"""WITH {B.APPT_SQL} SELECT status, count(*) AS appointments, CAST(sum(cost) AS DECIMAL(18,2)) AS amount
    FROM appointment GROUP BY status"""
)
def retain_missing_source_rows(spark, folder):
    rows = materialise(B.appointments(spark, folder), "appointments").select(
        "appointment_id", S.date_key(F.col("starts_at")).alias("date_key"), "status", "cost"
    )
    # The second extract no longer has the cancelled appointments; their facts stay.
    fact = _merged(spark, (rows, rows.where("status <> 'Cancelled'")))
    return fact.groupBy("status").agg(F.count("*").alias("appointments"), S.total(F.col("cost")).alias("amount"))


@query(
    f"""WITH {B.APPT_SQL}, {PATIENT_KEYS_SQL} SELECT patient_key, patient_id, city AS city_name, email,
    dense_rank() OVER (ORDER BY city) AS city_key FROM patient JOIN patient_key USING (patient_id)"""
)
def normalise_star_to_snowflake(spark, folder):
    star = dims.rebuild(B.patients(spark, folder), "patient_id", appointment.PATIENT, "patient_key")
    patient, city = dims.normalise(star, "city", "city_name", "city_key")
    back = patient.join(city, "city_key")
    same = reconcile.differences(star.select("patient_key", "patient_id", "city"),
                                 back.select("patient_key", "patient_id", F.col("city_name").alias("city")))
    quality.gate(quality.no_rows(same, "patient_id", "keys_changed", 1), "migration", {1: "Migration changed rows"})
    return back.select("patient_key", "patient_id", "city_name", "email", "city_key")


@query(
    f"""WITH {B.AUDIT_SQL} SELECT run_id, loaded_at, appointment_rows, CAST(amount + CASE WHEN run_id LIKE '%F'
    THEN 1 ELSE 0 END AS DECIMAL(18,2)) AS amount FROM audit"""
)
def audit_replace_run(spark, folder):
    rows = B.audit_rows(spark, folder)
    retry = rows.where("run_id LIKE '%F'").withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    return audit.replace_run(rows, retry)


@query(f"WITH {B.AUDIT_SQL} SELECT run_id, loaded_at, appointment_rows, amount FROM audit")
def audit_insert_once(spark, folder):
    rows = B.audit_rows(spark, folder)
    retry = rows.withColumn("amount", (F.col("amount") + 1).cast("decimal(18,2)"))
    return audit.insert_once(rows, retry)


@query(
    """SELECT c_custkey AS customer_id, CASE WHEN c_acctbal < 0 THEN 'seeded' ELSE c_mktsegment END AS city
    FROM customer"""
)
def seed_missing_rows(spark, folder):
    rows = tables.scan(spark, folder, "customer", ["c_custkey", "c_mktsegment", "c_acctbal"])
    present = rows.where("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("city"))
    seeds = rows.select(F.col("c_custkey").alias("customer_id"), F.lit("seeded").alias("city"))
    return present.unionByName(unseen(seeds, present, "customer_id"))


# ---------------------------------------------------------------- whole loads


@query(
    f"""WITH {B.CARE_SQL}, {PATIENT_KEYS_SQL}, {DEPARTMENT_KEYS_SQL}, fact AS ({FACT_SQL}),
    rows AS (SELECT *, date_key < 19980101 AS old FROM fact)
    SELECT {_numbered("old", "encounter_id")} AS encounter_key, encounter_id, patient_key, department_key, date_key,
      1 AS encounter_count, cost, CASE WHEN email IS NULL THEN 'Moved' ELSE city END AS city,
      count(*) OVER () AS audited_encounters FROM rows JOIN patient_key USING (patient_key) JOIN patient USING (patient_id)"""
)
def run_encounter_star(spark, folder):
    store = warehouses.new_store(spark, "encounter")
    moved = B.patients(spark, folder).withColumn("city", _moved()).drop("email")
    early = B.encounters(spark, folder).where(f"encounter_date < DATE '{SPLIT}'")
    first = B.attach_children(B.patients(spark, folder).drop("email"), early, "patient_id")
    second = B.attach_children(moved, B.encounters(spark, folder), "patient_id")
    for run_id, rows in (("run-1", first), ("run-2", second)):
        extract, copied = tables.stage_counted(rows, f"{store.root}/stage/{run_id}")
        encounter.run(store, extract, run_id, copied, warehouses.AS_OF, warehouses.LOADED_AT)
    now = store.read()
    audited = now["load_audit"].where("run_id = 'run-2'").first()["encounters"]
    return (
        now["fact_encounter"]
        .join(now["dim_patient"].select("patient_key", "city"), "patient_key")
        .withColumn("encounter_count", F.col("encounter_count").cast("int"))
        .withColumn("audited_encounters", F.lit(audited))
    )


DOCTOR_KEYS_SQL = "doctor_key AS (SELECT doctor_id, row_number() OVER (ORDER BY doctor_id) AS doctor_key FROM doctor)"
APPT_FACT_SQL = """SELECT row_number() OVER (ORDER BY appointment_id) AS appointment_key, appointment_id, patient_key,
  doctor_key, CAST(strftime(starts_at, '%Y%m%d') AS INTEGER) AS date_key, starts_at, ends_at, status, reason, cost
  FROM appointment JOIN patient_key USING (patient_id) JOIN doctor_key USING (doctor_id)"""


@query(f"WITH {B.APPT_SQL}, {PATIENT_KEYS_SQL}, {DOCTOR_KEYS_SQL} {APPT_FACT_SQL}")
def run_appointment_star(spark, folder):
    store = warehouses.new_store(spark, "star")
    appointment.run_star(store, **warehouses.staged_appointments(spark, folder))
    return store.read()["fact_appointment"].drop("appointment_count")


@query(
    f"""WITH {B.APPT_SQL}, {PATIENT_KEYS_SQL}, {DOCTOR_KEYS_SQL}, fact AS ({APPT_FACT_SQL})
    SELECT fact.*, dense_rank() OVER (ORDER BY city) AS city_key, dense_rank() OVER (ORDER BY specialty) AS specialty_key
    FROM fact JOIN patient_key USING (patient_key) JOIN patient USING (patient_id)
    JOIN doctor_key USING (doctor_key) JOIN doctor USING (doctor_id)"""
)
def run_appointment_snowflake(spark, folder):
    store = warehouses.new_store(spark, "snowflake")
    source = {"patient": B.patients, "doctor": B.doctors, "appointment": B.appointments}
    copies = together(
        {
            name: lambda name=name, read=read: tables.stage_counted(read(spark, folder), f"{store.root}/stage/{name}")
            for name, read in source.items()
        }
    )
    staged = {name: rows for name, (rows, _) in copies.items()}
    counts = {name: copied for name, (_, copied) in copies.items()}
    appointment.run_snowflake(store, **staged, run_id="run-1", counts=counts, loaded_at=warehouses.LOADED_AT)
    now = store.read()
    return (
        now["fact_appointment"].drop("appointment_count")
        .join(now["dim_patient"].select("patient_key", "city_key"), "patient_key")
        .join(now["dim_doctor"].select("doctor_key", "specialty_key"), "doctor_key")
    )


@query(_sales_report_sql("monthname(order_date)", "month_name"))
def run_sales_star(spark, folder):
    store = warehouses.new_store(spark, "sales")
    sales.run_star(store, warehouses.staged_sales(spark, folder))
    return sales.by_month_category(store.read(), "month_name")


@query(_sales_report_sql("CAST(month(order_date) AS INTEGER)", "calendar_month"))
def run_sales_rebuild(spark, folder):
    store = warehouses.new_store(spark, "sales-rebuild")
    rows = warehouses.staged_sales(spark, folder).withColumn("order_date", F.col("order_date").cast("string"))
    sales.run_rebuild(store, rows)
    return sales.by_month_category(store.read(), "calendar_month")


@query(
    f"""WITH {B.APPT_SQL} SELECT 2 AS version, 0 AS only_left, 0 AS only_right, true AS equal,
    count(*) AS appointments FROM appointment"""
)
def rerun_idempotence(spark, folder):
    store = warehouses.new_store(spark, "rerun")
    staged = warehouses.staged_appointments(spark, folder)
    for run in ("run-1", "run-2"):
        later = warehouses.LOADED_AT + timedelta(hours=int(run[-1]))
        appointment.run_snowflake(store, **staged, run_id=run, loaded_at=later)
    first, second = store.read(1), store.read(2)
    same = reconcile.difference_counts(first["fact_appointment"], second["fact_appointment"])
    return same.withColumn("version", F.lit(store.version())).withColumn(
        "appointments", F.lit(second["fact_appointment"].count())
    )


@query(
    f"""WITH {B.APPT_SQL} SELECT 'appointment 51002' AS refused, 1 AS version, count(*) AS appointments,
    CAST(sum(cost) AS DECIMAL(18,2)) AS amount FROM appointment"""
)
def reject_leaves_state(spark, folder):
    store = warehouses.new_store(spark, "reject")
    staged = warehouses.staged_appointments(spark, folder)
    appointment.run_snowflake(store, **staged, run_id="run-1", loaded_at=warehouses.LOADED_AT)
    planted = staged["appointment"].withColumn(
        "patient_id", F.when(F.col("status") == "NoShow", -1).otherwise(F.col("patient_id"))
    )
    try:
        appointment.run_snowflake(store, staged["patient"], staged["doctor"], planted, "run-2", None, warehouses.LOADED_AT)
        refused = "nothing"
    except quality.LoadError as error:
        refused = f"{error.load} {error.code}"
    return appointment.totals(store.read(), "appointments", "amount").select(
        F.lit(refused).alias("refused"), F.lit(store.version()).alias("version"), "*"
    )


