"""Test-run and pipeline-run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage.catalog.aggregates import REQUESTS_SQL, TESTS_SQL
from moorage.catalog.registry import query
from moorage.operators import runlogs

ITERATION = "CAST(k AS INTEGER) AS iteration"
NAME_SQL = """CASE WHEN flag <> 'N' THEN 'request ' || n WHEN quantity > 25 THEN 'file ' || supplier ELSE 'path/' || part END"""


@query(
    f"""WITH {FLAT_SQL} SELECT {ITERATION}, pos, {NAME_SQL} AS request, CASE WHEN priority = 3 THEN '-' ELSE '200' END AS http_status,
    CAST(quantity AS VARCHAR) AS duration, CASE WHEN failed THEN 'fail' ELSE 'pass' END AS status FROM ({REQUESTS_SQL})"""
)
def report_flatten_requests(spark, folder):
    return runlogs.requests(given_logs.parsed_reports(spark, folder))


@query(
    f"""WITH {FLAT_SQL} SELECT {ITERATION}, {NAME_SQL} AS request, name AS description,
    CASE WHEN failed THEN 'fail' ELSE 'pass' END AS status, CASE WHEN failed THEN 'not ' || name ELSE '' END AS error
    FROM ({TESTS_SQL})"""
)
def report_flatten_tests(spark, folder):
    return runlogs.tests(given_logs.parsed_reports(spark, folder))


@query(
    f"""WITH {FLAT_SQL} SELECT *, false AS missing, CAST(0 AS BIGINT) AS unreadable,
    failed_requests = 0 AND failed_tests = 0 AND EXISTS (FROM run) AS overall_pass
    FROM (SELECT count(*) FILTER (NOT failed) AS passed_requests, count(*) FILTER (failed) AS failed_requests FROM ({REQUESTS_SQL})),
      (SELECT count(*) FILTER (NOT failed) AS passed_tests, count(*) FILTER (failed) AS failed_tests FROM ({TESTS_SQL}))"""
)
def report_totals(spark, folder):
    return runlogs.totals(given_logs.parsed_reports(spark, folder))


@query(
    f"""WITH {FLAT_SQL}, rows AS (SELECT q.k, q.page, q.n, q.failed, coalesce(bool_or(t.failed), false) AS test_failed
      FROM ({REQUESTS_SQL}) q LEFT JOIN ({TESTS_SQL}) t ON t.k = q.k AND t.n = q.n GROUP BY q.k, q.page, q.n, q.failed),
    counts AS (SELECT k, count(*) FILTER (NOT failed) AS passed, count(*) FILTER (failed) AS failed,
      count(*) FILTER (NOT failed AND NOT test_failed) AS clean, count(*) FILTER (failed OR test_failed) AS unclean
      FROM rows GROUP BY k, page)
    SELECT {ITERATION}, 'passed_requests' AS measure, clean AS stored, passed AS recounted FROM counts WHERE clean <> passed
    UNION ALL SELECT {ITERATION}, 'failed_requests', unclean, failed FROM counts WHERE unclean <> failed"""
)
def report_recompute_summary(spark, folder):
    return runlogs.summary_differences(given_logs.parsed_reports(spark, folder))


ACTIVITIES_SQL = """SELECT 'PL_' || event_type AS pipeline, CAST(event_id AS VARCHAR) AS run_id, t.name, t.status,
  t.error_message, t.copied FROM events,
  LATERAL (VALUES ('Copy', 'Succeeded', NULL, CAST(json_extract(props, '$.k') AS BIGINT)),
    ('Load', CASE WHEN value < 40 THEN 'Failed' ELSE 'Succeeded' END,
      CASE WHEN value < 40 THEN 'value ' || CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) END, NULL),
    ('Validate', CASE WHEN value < 40 THEN 'Skipped' WHEN value < 60 THEN 'Cancelled' ELSE 'Succeeded' END,
      NULL, NULL)) t(name, status, error_message, copied) WHERE value >= 20"""


@query(ACTIVITIES_SQL)
def pipeline_activity_status(spark, folder):
    return runlogs.activities(given_logs.parsed_pipeline_runs(spark, folder))


@query(
    """SELECT 'PL_' || event_type AS pipeline, CAST(event_id AS VARCHAR) AS run_id, 'Validate' AS activity,
    v.row_number, v.column_name, v.value FROM events, LATERAL (VALUES
      (0, 'ValidatedFactRows', CAST(event_id AS VARCHAR)), (0, 'Kind', event_type),
      (1, 'ValidatedFactRows', CAST(event_id + 1 AS VARCHAR))) v(row_number, column_name, value) WHERE value_of >= 60"""
    .replace("FROM events,", "FROM (SELECT *, value AS value_of FROM events),")
)
def pipeline_result_rows(spark, folder):
    return runlogs.result_values(given_logs.parsed_pipeline_runs(spark, folder))


@query(
    """SELECT CAST(event_id AS VARCHAR) AS run_id, CASE WHEN value < 40 THEN 'Failed' WHEN value < 60 THEN 'Cancelled'
    ELSE 'Succeeded' END AS status FROM events WHERE value >= 20"""
)
def pipeline_terminal_filter(spark, folder):
    rows = runlogs.terminal(given_logs.parsed_pipeline_runs(spark, folder))
    return rows.select(F.col("runId").alias("run_id"), "status")


@query(
    f"""SELECT run_id, name, status, CASE WHEN name = 'Validate' AND failed THEN 'skipped' ELSE 'run' END AS expected
    FROM (SELECT *, bool_or(status = 'Failed') OVER (PARTITION BY run_id) AS failed FROM ({ACTIVITIES_SQL}))"""
)
def precedence_outcome(spark, folder):
    needs = {"Copy": [], "Load": ["Copy"], "Validate": ["Load"]}
    return runlogs.precedence(given_logs.parsed_pipeline_runs(spark, folder), needs)
