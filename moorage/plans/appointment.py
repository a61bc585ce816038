"""Appointment loads: the star with text attributes, and the snowflake with outriggers and audit."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators import audit, dims, facts, quality
from moorage.operators.joins import lookup_join
from moorage.operators.keys import parts_of
from moorage.operators.quality import LoadError
from moorage.session import materialise, together
from moorage.sources.store import Draft, SnapshotStore

LOAD = "appointment"
# The statuses an appointment can have.
STATUSES = ["Scheduled", "Completed", "Cancelled", "NoShow"]
PATIENT = ["given_name", "family_name", "birth_date", "city", "email"]
DOCTOR = ["given_name", "family_name", "specialty", "email", "is_active"]
# The codes; they are checked in this order.
MESSAGES = quality.CONTRACT_MESSAGES | {
    51004: "A copy reported another number of rows than its staged table has",
    51001: "No patients or no doctors were staged",
    51002: "Appointments name patients or doctors that were not staged",
    51003: "Appointments end before they start, cost less than nothing or have an unknown status",
    51005: "Rows found no dimension key",
}
# Longest texts of the staged tables.
PATIENT_LENGTHS = {"given_name": 50, "family_name": 50, "city": 80, "email": 254}
DOCTOR_LENGTHS = {"given_name": 50, "family_name": 50, "specialty": 100, "email": 254}
APPOINTMENT_LENGTHS = {"status": 20, "reason": 200}
QUALITY_MESSAGES = {
    51100: "The fact table is empty",
    51101: "Facts without a parent, or with values that can't be",
    51102: "An appointment id is there more than once",
    51010: "Facts without a direct parent, or with values that can't be",
}
_DATE = "date_key int, calendar_date date, calendar_year smallint, calendar_month smallint, day_of_month smallint"
_FACT = (
    "appointment_key bigint, appointment_id bigint, patient_key bigint, doctor_key bigint, date_key int, "
    "starts_at timestamp_ntz, ends_at timestamp_ntz, status string, reason string, appointment_count smallint, "
    "cost decimal(10,2)"
)
_NAMES = "given_name string, family_name string"
STAR = {
    "dim_patient": f"patient_key bigint, patient_id bigint, {_NAMES}, birth_date date, city string, email string",
    "dim_doctor": f"doctor_key bigint, doctor_id bigint, {_NAMES}, specialty string, email string, is_active boolean",
    "dim_date": _DATE,
    "fact_appointment": _FACT,
}
SNOWFLAKE = {
    "dim_city": "city_key bigint, city_name string",
    "dim_specialty": "specialty_key bigint, specialty_name string",
    "dim_patient": f"patient_key bigint, patient_id bigint, {_NAMES}, birth_date date, email string, city_key bigint",
    "dim_doctor": f"doctor_key bigint, doctor_id bigint, {_NAMES}, email string, is_active boolean, "
    "specialty_key bigint",
    "dim_date": _DATE,
    "fact_appointment": _FACT,
    "load_audit": "run_id string, loaded_at timestamp_ntz, patient_rows bigint, doctor_rows bigint, "
    "appointment_rows bigint, amount decimal(18,2)",
}


def empty(spark: SparkSession, tables: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in tables.items()}


def invalid_appointment() -> quality.Rule:
    broken = (
        (F.col("ends_at") <= F.col("starts_at")) | (F.col("cost") < 0) | ~F.col("status").isin(STATUSES)
    )
    return quality.Rule("invalid_appointment", 51003, broken)


def stage_report(
    patient: DataFrame, doctor: DataFrame, appointment: DataFrame, counts: dict[str, int | None] | None = None
) -> DataFrame:
    """All gates on the staged tables; ``counts`` holds the copy counts that are known."""
    staged = {"patient": patient, "doctor": doctor, "appointment": appointment}
    known = {name: (staged[name], n) for name, n in (counts or {}).items() if n is not None}
    return quality.all_of(
        ([quality.counts_match(known, 51004)] if known else [])
        + [
            quality.not_empty(patient, "patients_empty", 51001),
            quality.not_empty(doctor, "doctors_empty", 51001),
            quality.orphans(appointment, "patient_id", patient, "patient_id", "missing_patient", 51002),
            quality.orphans(appointment, "doctor_id", doctor, "doctor_id", "missing_doctor", 51002),
            quality.row_rules(appointment, [invalid_appointment()], "appointment_id"),
        ]
    )


def contract_report(patient: DataFrame, doctor: DataFrame, appointment: DataFrame) -> DataFrame:
    """Keys, required columns and text lengths of the staged tables."""
    reports = []
    for rows, key, needed, lengths in (
        (patient, "patient_id", [name for name in PATIENT if name != "email"], PATIENT_LENGTHS),
        (doctor, "doctor_id", DOCTOR, DOCTOR_LENGTHS),
        (appointment, "appointment_id",
         ["patient_id", "doctor_id", "starts_at", "ends_at", "status", "reason", "cost"], APPOINTMENT_LENGTHS),
    ):
        quality.same_columns(LOAD, rows, [key, *needed, *lengths])
        reports.append(quality.contract(rows, key, [key, *needed], lengths, unique=(key,)))
    return quality.all_of(reports)


def _kept_all(rows: DataFrame, source: DataFrame, name: str) -> DataFrame:
    """``rows``, after a check that the lookup that made them lost nothing of ``source``."""
    quality.gate(quality.same_count(rows, source, name, 51005), LOAD, MESSAGES)
    return rows


def fact_keys(appointment: DataFrame, dim_patient: DataFrame, dim_doctor: DataFrame) -> DataFrame:
    """Each appointment's keys; what it holds itself is left out of the lookups."""
    keyed = facts.with_dimension_keys(
        appointment.select("appointment_id", "patient_id", "doctor_id", S.date_key(F.col("starts_at")).alias("date_key")),
        [facts.Lookup(dim_patient, "patient_id", "patient_key"), facts.Lookup(dim_doctor, "doctor_id", "doctor_key")],
    )
    return keyed.select("appointment_id", "patient_key", "doctor_key", "date_key")


def fact_measures(appointment: DataFrame) -> DataFrame:
    return appointment.select(
        "appointment_id", S.date_key(F.col("starts_at")).alias("date_key"), "starts_at", "ends_at", "status", "reason",
        F.lit(1).cast("smallint").alias("appointment_count"), "cost",
    )


def _load_facts(draft: Draft, now: dict[str, DataFrame], new: dict[str, DataFrame], appointment: DataFrame) -> None:
    """Merge the appointments into the months they are in."""
    rows = materialise(fact_keys(appointment, new["dim_patient"], new["dim_doctor"]), "appointments")
    _kept_all(rows, appointment, "appointment_lookup")
    facts.merge(
        draft, "fact_appointment", rows, now["fact_appointment"], "appointment_id", "appointment_key", facts.month_of(),
        parts_of(rows), fact_measures(appointment),
    )


def run_star(store: SnapshotStore, patient: DataFrame, doctor: DataFrame, appointment: DataFrame) -> int:
    """Load staged tables into dimensions that hold city and specialty as text."""
    draft = store.draft()
    now = store.read(draft.base) or empty(store.spark, STAR)
    if "dim_city" in now:
        raise LoadError(LOAD, 50000, "The warehouse is a snowflake; use the snowflake load")
    report = quality.all_of([contract_report(patient, doctor, appointment), stage_report(patient, doctor, appointment)])
    quality.gate(report, LOAD, MESSAGES)
    new = draft.put_all(
        {
            "dim_patient": lambda: dims.load_type1(
                now["dim_patient"], patient, "patient_id", PATIENT, "patient_key"
            ),
            "dim_doctor": lambda: dims.load_type1(now["dim_doctor"], doctor, "doctor_id", DOCTOR, "doctor_key"),
        },
    )
    draft.append("dim_date", dims.new_dates(now["dim_date"], appointment, "starts_at"))
    _load_facts(draft, now, new, appointment)
    return draft.publish()


def load_with_outrigger(
    dim: DataFrame, source: DataFrame, outrigger: DataFrame, text: str, name: str, outrigger_key: str,
    natural_key: str, key: str, collation: str | None = None,
) -> DataFrame:
    """Type 1 load of a dimension that holds the outrigger's key in place of the text."""
    keyed = materialise(dims.swap_text_for_key(source, outrigger, text, name, outrigger_key, collation), f"keyed-{text}")
    _kept_all(keyed, source, f"{text}_lookup")
    attributes = [column for column in dim.columns if column not in (natural_key, key)]
    return dims.load_type1(dim, keyed, natural_key, attributes, key)


def audit_row(
    patient: DataFrame, doctor: DataFrame, appointment: DataFrame, run_id: str, loaded_at: datetime
) -> DataFrame:
    """Totals of the staged tables; the time keeps whole seconds."""
    zero, one = F.lit(0), F.lit(1)
    parts = (
        appointment.select(zero.alias("p"), zero.alias("d"), one.alias("a"), S.money(F.col("cost")).alias("c"))
        .unionAll(patient.select(one, zero, zero, S.money(zero)))
        .unionAll(doctor.select(zero, one, zero, S.money(zero)))
    )
    count = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    return parts.agg(
        count("p").alias("patient_rows"), count("d").alias("doctor_rows"), count("a").alias("appointment_rows"),
        S.total(F.col("c")).alias("amount"),
    ).select(
        F.lit(run_id).alias("run_id"),
        F.date_trunc("second", F.lit(loaded_at).cast("timestamp_ntz")).cast("timestamp_ntz").alias("loaded_at"),
        "patient_rows", "doctor_rows", "appointment_rows", "amount",
    )


def run_snowflake(
    store: SnapshotStore, patient: DataFrame, doctor: DataFrame, appointment: DataFrame,
    run_id: str | None = None, counts: dict[str, int | None] | None = None, loaded_at: datetime | None = None,
    collation: str | None = None,
) -> int:
    """Load staged tables through city and specialty outriggers; audits when a run id is given, by default as of now."""
    report = [contract_report(patient, doctor, appointment), stage_report(patient, doctor, appointment, counts)]
    quality.gate(quality.all_of(report), LOAD, MESSAGES)
    loaded_at = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    draft = store.draft()
    now = store.read(draft.base) or empty(store.spark, SNOWFLAKE)

    def load_audit() -> DataFrame:
        if run_id is None:
            return now["load_audit"]
        return audit.insert_once(now["load_audit"], audit_row(patient, doctor, appointment, run_id, loaded_at))

    def texts(table: str, source: DataFrame, text: str, name: str, key: str) -> tuple[DataFrame, int]:
        return dims.new_texts(now[table], source, text, name, key, collation, draft.top_key(table))

    loaded = together(
        {
            "grown": lambda: draft.append_all(
                {
                    "dim_city": lambda: texts("dim_city", patient, "city", "city_name", "city_key"),
                    "dim_specialty": lambda: texts("dim_specialty", doctor, "specialty", "specialty_name", "specialty_key"),
                    "dim_date": lambda: (dims.new_dates(now["dim_date"], appointment, "starts_at"), None),
                }
            ),
            "audit": lambda: draft.put("load_audit", load_audit()),
        }
    )
    new = loaded["grown"] | {"load_audit": loaded["audit"]}
    new |= draft.put_all(
        {
            "dim_patient": lambda: load_with_outrigger(
                now["dim_patient"], patient, new["dim_city"], "city", "city_name", "city_key",
                "patient_id", "patient_key", collation,
            ),
            "dim_doctor": lambda: load_with_outrigger(
                now["dim_doctor"], doctor, new["dim_specialty"], "specialty", "specialty_name", "specialty_key",
                "doctor_id", "doctor_key", collation,
            ),
        },
    )
    _load_facts(draft, now, new, appointment)
    return draft.publish()


def migrate(store: SnapshotStore) -> int:
    """Turn a published star into a snowflake; keys and facts stay. Does nothing to a snowflake."""
    base = store.version()
    now = store.read(base)
    if "dim_city" in now:
        return base
    patient, city = dims.normalise(now["dim_patient"], "city", "city_name", "city_key")
    doctor, specialty = dims.normalise(now["dim_doctor"], "specialty", "specialty_name", "specialty_key")
    return store.publish(
        {
            "dim_city": city, "dim_specialty": specialty, "dim_patient": patient, "dim_doctor": doctor,
            "load_audit": empty(store.spark, {"load_audit": SNOWFLAKE["load_audit"]})["load_audit"],
        },
        base,
    )


def details(tables: dict[str, DataFrame]) -> DataFrame:
    """The flattened snowflake: fact, dimensions and outriggers in one row."""
    patient = lookup_join(tables["dim_patient"], tables["dim_city"], "city_key").select(
        "patient_key", "patient_id", F.col("given_name").alias("patient_given_name"),
        F.col("family_name").alias("patient_family_name"), "city_name",
    )
    doctor = lookup_join(tables["dim_doctor"], tables["dim_specialty"], "specialty_key").select(
        "doctor_key", "doctor_id", F.col("given_name").alias("doctor_given_name"),
        F.col("family_name").alias("doctor_family_name"), "specialty_name",
    )
    day = tables["dim_date"].select("date_key", "calendar_date")
    rows = tables["fact_appointment"]
    for lookup, key in ((patient, "patient_key"), (doctor, "doctor_key"), (day, "date_key")):
        rows = lookup_join(rows, lookup, key)
    return rows.drop("appointment_key", "patient_key", "doctor_key", "date_key")


def _with_parents(tables: dict[str, DataFrame]) -> DataFrame:
    """Every fact with marks for the parents it has, through the outriggers."""
    patient = quality.lookup_left(
        tables["dim_patient"].select("patient_key", "city_key"), tables["dim_city"].select("city_key"), "city_key",
        "has_city",
    )
    doctor = quality.lookup_left(
        tables["dim_doctor"].select("doctor_key", "specialty_key"), tables["dim_specialty"].select("specialty_key"),
        "specialty_key", "has_specialty",
    )
    patient = patient.select("patient_key", "has_city", F.lit(True).alias("has_patient"))
    doctor = doctor.select("doctor_key", "has_specialty", F.lit(True).alias("has_doctor"))
    rows = quality.lookup_marks(tables["fact_appointment"], patient, "patient_key")
    rows = quality.lookup_marks(rows, doctor, "doctor_key")
    return quality.lookup_left(rows, tables["dim_date"].select("date_key", "calendar_date"), "date_key", "has_date")


def warehouse_rules() -> list[quality.Rule]:
    """Rules of the full quality check, each a part of one code."""
    rule = lambda name, broken: quality.Rule(name, 51101, broken)
    return [
        rule("patient_missing", F.col("has_patient").isNull()),
        rule("city_missing", F.col("has_city").isNull()),
        rule("doctor_missing", F.col("has_doctor").isNull()),
        rule("specialty_missing", F.col("has_specialty").isNull()),
        rule("date_missing", F.col("has_date").isNull()),
        rule("date_differs", F.col("calendar_date") != F.col("starts_at").cast("date")),
        rule("negative_cost", F.col("cost") < 0),
        rule("ends_before_start", F.col("ends_at") <= F.col("starts_at")),
        rule("unknown_status", ~F.col("status").isin(STATUSES)),
        rule("count_not_one", F.col("appointment_count") != 1),
    ]


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    fact = tables["fact_appointment"]
    return quality.all_of(
        [
            quality.not_empty(fact, "no_appointments", 51100),
            quality.row_rules(_with_parents(tables), warehouse_rules(), "appointment_id"),
            quality.duplicate_key(fact, ["appointment_id"], "duplicate_appointment", 51102),
        ]
    )


def totals(tables: dict[str, DataFrame], rows: str, amount: str) -> DataFrame:
    return tables["fact_appointment"].agg(F.count("*").alias(rows), S.total(F.col("cost")).alias(amount))


def check_quality(tables: dict[str, DataFrame]) -> DataFrame:
    """Raise on the first broken rule, else one row of status, rows and amount."""
    quality.gate(quality_report(tables), "warehouse", QUALITY_MESSAGES)
    return totals(tables, "appointment_rows", "amount").select(F.lit("Passed").alias("quality_status"), "*")


def validation_report(tables: dict[str, DataFrame]) -> DataFrame:
    """The lighter check after a load: direct parents, cost and duration."""
    rows = tables["fact_appointment"]
    for dim, key in (("dim_patient", "patient_key"), ("dim_doctor", "doctor_key"), ("dim_date", "date_key")):
        rows = quality.lookup_marks(rows, tables[dim].select(key, F.lit(True).alias(f"has_{key}")), key)
    broken = (
        F.col("has_patient_key").isNull() | F.col("has_doctor_key").isNull() | F.col("has_date_key").isNull()
        | F.coalesce((F.col("cost") < 0) | (F.col("ends_at") <= F.col("starts_at")), F.lit(False))
    )
    return quality.row_rules(rows, [quality.Rule("invalid_fact", 51010, broken)], "appointment_id")


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    quality.gate(validation_report(tables), "pipeline", QUALITY_MESSAGES)
    return totals(tables, "validated_rows", "validated_cost")
