"""Scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage import bindings as B
from moorage.catalog.registry import query
from moorage.functions import scalars as S
from moorage.operators import audit, errors, payloads
from moorage.sources import tables

DAY_SQL = "CAST(o_orderdate AS DATE)"


def _orders(spark, folder, *columns):
    return tables.scan(spark, folder, "orders", ["o_orderkey", *columns])


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key FROM orders")
def fn_date_key(spark, folder):
    return _orders(spark, folder, "o_orderdate").select("o_orderkey", S.date_key(F.col("o_orderdate")).alias("date_key"))


def _day_text(spark, folder):
    return _orders(spark, folder, "o_orderdate").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day")
    )


@query(f"SELECT o_orderkey, CAST(replace(CAST({DAY_SQL} AS VARCHAR), '-', '') AS INTEGER) AS date_key FROM orders")
def fn_date_key_from_text(spark, folder):
    return _day_text(spark, folder).select("o_orderkey", S.date_key_from_text(F.col("day")).alias("date_key"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders")
def fn_substr_year_month(spark, folder):
    day = F.col("day")
    return _day_text(spark, folder).select("o_orderkey", S.year_from_text(day).alias("y"), S.month_from_text(day).alias("m"))


@query(
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
    CAST(day(o_orderdate) AS INTEGER) AS d FROM orders"""
)
def fn_year_month_day(spark, folder):
    day = F.col("o_orderdate")
    return _orders(spark, folder, "o_orderdate").select(
        "o_orderkey", F.year(day).alias("y"), F.month(day).alias("m"), F.dayofmonth(day).alias("d")
    )


@query("SELECT o_orderkey, monthname(o_orderdate) AS month_name FROM orders")
def fn_month_name(spark, folder):
    return _orders(spark, folder, "o_orderdate").select("o_orderkey", S.month_name(F.col("o_orderdate")).alias("month_name"))


@query("SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def fn_timestamp_to_date(spark, folder):
    rows = tables.scan(spark, folder, "events", ["event_id", "ts"])
    return rows.select("event_id", F.col("ts").cast("date").cast("string").alias("day"))


@query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS parsed FROM orders")
def fn_parse_compact_date(spark, folder):
    compact = F.date_format("o_orderdate", "yyyyMMdd")
    return _orders(spark, folder, "o_orderdate").select(
        "o_orderkey", S.compact_date(compact).cast("timestamp_ntz").alias("parsed")
    )


@query("SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def fn_parse_iso_timestamp(spark, folder):
    rows = tables.scan(spark, folder, "events", ["event_id", "ts"])
    return rows.select("event_id", F.to_timestamp_ntz(S.iso_seconds(F.col("ts"))).alias("parsed"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def fn_format_iso_timestamp(spark, folder):
    rows = tables.scan(spark, folder, "events", ["event_id", "ts"])
    return rows.select("event_id", S.iso_seconds(F.col("ts")).alias("iso"))


@query("SELECT event_id, date_diff('minute', ts, TIMESTAMP '2024-02-01 00:00:30') AS minutes FROM events")
def fn_minutes_since(spark, folder):
    as_of = F.lit(datetime(2024, 2, 1, 0, 0, 30)).cast("timestamp_ntz")
    rows = tables.scan(spark, folder, "events", ["event_id", "ts"])
    return rows.select("event_id", S.minutes_since(F.col("ts"), as_of).alias("minutes"))


@query(
    f"""SELECT o_orderkey, CAST({DAY_SQL} + 14 AS VARCHAR) AS booking, CAST({DAY_SQL} + 28 AS VARCHAR) AS change
    FROM orders"""
)
def fn_add_days(spark, folder):
    day = F.col("o_orderdate").cast("date")
    return _orders(spark, folder, "o_orderdate").select(
        "o_orderkey", S.add_days_iso(day, 14).alias("booking"), S.add_days_iso(day, 28).alias("change")
    )


@query(f"""WITH {B.APPT_SQL} SELECT patient_id, concat('Mail: ', email, '; City: ', city) AS summary FROM patient""")
def fn_concat_null_as_empty(spark, folder):
    rows = B.patients(spark, folder)
    line = S.text_of(F.lit("Mail: "), F.col("email"), F.lit("; City: "), F.col("city"))
    return rows.select("patient_id", line.alias("summary"))


@query(
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Customer' WHEN c_acctbal > 9000 THEN split_part(c_name, '#', 2)
    ELSE replace(c_name, '#', ' ') END AS full_name FROM customer"""
)
def fn_join_nonempty(spark, folder):
    rows = tables.scan(spark, folder, "customer", ["c_custkey", "c_name", "c_acctbal"])
    first = F.when(F.col("c_acctbal") > 9000, "").otherwise(F.split_part("c_name", F.lit("#"), F.lit(1)))
    last = F.when(F.col("c_acctbal") >= 0, F.split_part("c_name", F.lit("#"), F.lit(2)))
    return rows.select("c_custkey", S.join_filled(" ", first, last).alias("full_name"))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'Subscription unavailable; Run ' || run_id AS detail FROM run
    WHERE {given_logs.TRANSPORT}"""
)
def fn_join_messages(spark, folder):
    parsed = given_logs.parsed_step(spark, folder, "shopping").where("errors IS NOT NULL")
    return parsed.select("run_id", errors.messages(F.col("errors")).alias("detail"))


@query(
    f"""WITH {B.CARE_SQL} SELECT patient_id, CAST(coalesce(sum(cost) FILTER (cost > 400000), 0) AS DECIMAL(18,2)) AS large
    FROM extract GROUP BY patient_id"""
)
def fn_coalesce_zero(spark, folder):
    large = F.when(F.col("cost") > 400000, F.col("cost"))
    return B.encounter_extract(spark, folder).groupBy("patient_id").agg(S.total(large).alias("large"))


@query(
    f"""WITH {B.AUDIT_SQL} SELECT 'found' AS part, (SELECT 'Run: ' || run_id || '; Loaded UTC: ' ||
      strftime(loaded_at, '%Y-%m-%dT%H:%M:%S') || '; Appointments: ' || appointment_rows FROM audit
      ORDER BY loaded_at DESC, run_id DESC LIMIT 1) AS summary
    UNION ALL SELECT 'none', 'No successful load yet'"""
)
def fn_coalesce_default_text(spark, folder):
    rows = B.audit_rows(spark, folder)
    line = lambda part, found: audit.latest_text(found, "appointment_rows").select(F.lit(part).alias("part"), "summary")
    return line("found", rows).unionByName(line("none", rows.where("appointment_rows < 0")))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, CASE WHEN state <> 'P' THEN 'ticket-' || run_id
    WHEN segment <> 'BUILDING' THEN 'original-' || run_id END AS ticket_number FROM run"""
)
def fn_first_truthy(spark, folder):
    return payloads.ticket(given_logs.parsed_step(spark, folder, "ticket")).select("run_id", "ticket_number")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'C-' || k || '-' || n || '-' || (CASE WHEN quantity > 25 THEN 1 ELSE part END) AS offer_item_id
    FROM item JOIN (SELECT run_id, min(n) AS n FROM item WHERE flag = 'A' GROUP BY run_id) USING (run_id, n)"""
)
def fn_append_suffix_fallback(spark, folder):
    return payloads.reshop_offer(given_logs.parsed_step(spark, folder, "reshop"), "T1").select("run_id", "offer_item_id")


@query("SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount FROM orders GROUP BY ALL")
def fn_cast_decimal_sum(spark, folder):
    rows = tables.scan(spark, folder, "orders", ["o_orderpriority", "o_totalprice"])
    return rows.groupBy("o_orderpriority").agg(S.total(F.col("o_totalprice")).alias("amount"))
