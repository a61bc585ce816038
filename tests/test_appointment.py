from decimal import Decimal

import pytest
from conftest import rows
from fixtures import APPOINTMENTS, CITIES, DOCTORS, LOADED, PATIENTS, staged
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators import audit, quality, reconcile
from moorage.plans import appointment


def snowflake(spark, store, run_id="run-1", counts=None, **tables):
    return appointment.run_snowflake(store, **(staged(spark) | tables), run_id=run_id, counts=counts, loaded_at=LOADED)


def test_golden_numbers(spark, store):
    snowflake(spark, store, counts={"patient": 6, "doctor": 3, "appointment": 8})
    now = store.read()
    sizes = {name: now[name].count() for name in appointment.SNOWFLAKE}
    assert sizes == {
        "dim_city": 6, "dim_specialty": 3, "dim_patient": 6, "dim_doctor": 3, "dim_date": 8, "fact_appointment": 8,
        "load_audit": 1,
    }
    assert rows(appointment.check_quality(now)) == [("Passed", 8, Decimal("585.00"))]
    assert rows(appointment.validate(now)) == [(8, Decimal("585.00"))]
    assert rows(now["load_audit"]) == [("run-1", LOADED.replace(microsecond=0), 6, 3, 8, Decimal("585.00"))]
    assert appointment.details(now).count() == 8


def test_retry_keeps_the_first_audit_row_and_all_keys(spark, store):
    snowflake(spark, store)
    snowflake(spark, store)
    first, second = store.read(1), store.read(2)
    for name in appointment.SNOWFLAKE:
        assert rows(reconcile.difference_counts(first[name], second[name])) == [(0, 0, True)]


def test_changed_start_moves_the_date_key_and_keeps_the_old_date(spark, store):
    snowflake(spark, store)
    later = [(*r[:3], r[3].replace(day=20), r[4].replace(day=20), *r[5:]) if r[0] == 5001 else r for r in APPOINTMENTS]
    snowflake(spark, store, "run-2", appointment=staged(spark, appointments=later)["appointment"])
    now = store.read()
    assert rows(now["fact_appointment"].where("appointment_id = 5001"), "date_key") == [(20260920,)]
    assert now["dim_date"].count() == 9


def planted(**fields):
    names = ["appointment_id", "patient_id", "doctor_id", "starts_at", "ends_at", "status", "reason", "cost"]
    return [tuple((dict(zip(names, APPOINTMENTS[0])) | fields).values()), *APPOINTMENTS[1:]]


@pytest.mark.parametrize(
    "tables, counts, code",
    [
        ({"appointments": planted(patient_id=-1)}, None, 51002),
        ({"appointments": planted(doctor_id=-1)}, None, 51002),
        ({"appointments": planted(ends_at=APPOINTMENTS[0][3])}, None, 51003),
        ({"appointments": planted(cost=Decimal(-1))}, None, 51003),
        ({"appointments": planted(status="Other")}, None, 51003),
        ({"doctors": []}, None, 51001),
        ({"patients": [*PATIENTS, PATIENTS[0]]}, None, 2627),
        ({"appointments": [*APPOINTMENTS, APPOINTMENTS[0]]}, None, 2627),
        ({"patients": [(*PATIENTS[0][:4], None, None), *PATIENTS[1:]]}, None, 515),
        ({"patients": [(*PATIENTS[0][:4], "x" * 81, None), *PATIENTS[1:]]}, None, 2628),
        ({}, {"appointment": 9}, 51004),
    ],
)
def test_rejected_input_leaves_the_state(spark, store, tables, counts, code):
    snowflake(spark, store)
    with pytest.raises(quality.LoadError) as refused:
        appointment.run_snowflake(store, **staged(spark, **tables), run_id="run-2", counts=counts, loaded_at=LOADED)
    assert refused.value.code == code
    assert store.version() == 1 and store.read()["fact_appointment"].count() == 8


def test_star_load_refuses_a_snowflake(spark, store):
    snowflake(spark, store)
    with pytest.raises(quality.LoadError):
        appointment.run_star(store, **staged(spark))
    assert store.version() == 1


def test_missing_column_and_default_audit_time(spark, store):
    tables = staged(spark)
    with pytest.raises(quality.LoadError):
        appointment.run_snowflake(store, tables["patient"].drop("city"), tables["doctor"], tables["appointment"])
    appointment.run_snowflake(store, **tables, run_id="now")
    assert store.read()["load_audit"].where("loaded_at > '2024-01-01'").count() == 1


def test_migration_keeps_keys_and_facts(spark, store):
    appointment.run_star(store, **staged(spark))
    star = store.read()
    assert appointment.migrate(store) == 2
    assert appointment.migrate(store) == 2
    now = store.read()
    assert "city" not in now["dim_patient"].columns
    back = now["dim_patient"].join(now["dim_city"].withColumnRenamed("city_name", "city"), "city_key")
    assert rows(back, *star["dim_patient"].columns[:6]) == rows(star["dim_patient"], *star["dim_patient"].columns[:6])
    assert rows(now["fact_appointment"]) == rows(star["fact_appointment"])
    snowflake(spark, store)
    assert store.read()["dim_city"].count() == 6


def test_spellings_of_a_city(spark, store):
    spelled = [(*r[:4], city, r[5]) for r, city in zip(PATIENTS, ["London", "LONDON", "London ", *CITIES[3:]])]
    tables = staged(spark, patients=spelled)
    appointment.run_snowflake(store, **tables, collation="UTF8_LCASE_RTRIM")
    now = store.read()
    assert now["dim_city"].count() == 4
    assert now["dim_patient"].join(now["dim_city"], "city_key").count() == 6
    appointment.run_snowflake(store, **tables, collation="UTF8_LCASE_RTRIM")
    assert store.read()["dim_city"].count() == 4
    binary = type(store)(spark, store.root + "-binary")
    appointment.run_snowflake(binary, **tables)
    assert binary.read()["dim_city"].count() == 6


def test_quality_check_names_the_broken_rule(spark, store):
    snowflake(spark, store)
    now = store.read()
    for change, rule in [
        ({"dim_city": now["dim_city"].where("city_name <> 'York'")}, "city_missing"),
        ({"dim_date": now["dim_date"].withColumn("calendar_date", F.date_add("calendar_date", 1))}, "date_differs"),
        ({"fact_appointment": now["fact_appointment"].withColumn("status", F.lit("Other"))}, "unknown_status"),
        ({"fact_appointment": now["fact_appointment"].union(now["fact_appointment"])}, "duplicate_appointment"),
        ({"fact_appointment": now["fact_appointment"].limit(0)}, "no_appointments"),
    ]:
        report = appointment.quality_report(now | change).where("violations > 0").collect()
        assert [line["rule"] for line in report] == [rule]
        with pytest.raises(quality.LoadError):
            appointment.check_quality(now | change)


def test_latest_audit(spark):
    schema = "run_id string, loaded_at timestamp_ntz, appointment_rows bigint"
    at = LOADED.replace(minute=0, second=59, microsecond=0)
    table = spark.createDataFrame([("a", at, 1), ("b", at, 2), ("z", at.replace(hour=1), 3)], schema)
    as_of = F.lit(at.replace(minute=1, second=0)).cast("timestamp_ntz")
    assert rows(audit.latest_with_age(table, as_of)) == [("b", at, 2, 1)]
    assert audit.latest(table.limit(0)).count() == 0
    assert rows(audit.latest_text(table, "appointment_rows")) == [
        ("Run: b; Loaded UTC: 2026-10-01T06:00:59; Appointments: 2",)
    ]
    assert rows(audit.latest_text(table.limit(0), "appointment_rows")) == [("No successful load yet",)]


def test_text_helpers(spark):
    frame = spark.createDataFrame([(None, "", "x")], "a string, b string, c string")
    got = frame.select(
        S.text_of(F.col("a"), F.lit("-"), F.col("c")), S.first_filled(F.col("a"), F.col("b"), F.col("c")),
        S.join_filled(" ", F.col("a"), F.col("b"), F.col("c")), S.blank(F.col("b")), S.filled(F.col("a")),
        S.compact_date(F.lit("19850412")).cast("string"),
    ).first()
    assert tuple(got) == ("-x", "x", "x", True, False, "1985-04-12")


def test_everyone_counts(spark, store):
    assert len(DOCTORS) == 3
    snowflake(spark, store)
    now = store.read()
    source = staged(spark)["appointment"]
    assert rows(reconcile.difference_counts(source, appointment.details(now).select(*source.columns))) == [(0, 0, True)]


def test_appointments_are_looked_up_by_id_alone(spark, store):
    snowflake(spark, store)
    now = store.read()
    found = appointment.fact_keys(staged(spark)["appointment"], now["dim_patient"], now["dim_doctor"])
    assert found.columns == ["appointment_id", "patient_key", "doctor_key", "date_key"] and found.count() == 8
    wanted = appointment.fact_measures(staged(spark)["appointment"]).join(found.drop("date_key"), "appointment_id")
    fact = now["fact_appointment"].drop("appointment_key")
    assert rows(reconcile.difference_counts(fact, wanted.select(*fact.columns))) == [(0, 0, True)]
