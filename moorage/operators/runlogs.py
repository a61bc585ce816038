"""Reports over test runs and pipeline runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.sources import logs

PASS = "pass"
# States in which a pipeline run is over.
TERMINAL = ["Succeeded", "Failed", "Cancelled"]


def _request_name(result: Column) -> Column:
    return S.first_filled(result["name"], result["test"]["filename"], result["path"])


def requests(reports: DataFrame) -> DataFrame:
    """One row per request of each iteration."""
    return reports.select("iterationIndex", F.posexplode("results").alias("pos", "result")).select(
        F.col("iterationIndex").alias("iteration"),
        "pos",
        _request_name(F.col("result")).alias("request"),
        F.coalesce(F.col("result.response.status").cast("string"), F.lit("-")).alias("http_status"),
        F.coalesce(F.col("result.response.duration").cast("string"), F.lit("-")).alias("duration"),
        F.coalesce(F.col("result.status"), F.lit("unknown")).alias("status"),
    )


def tests(reports: DataFrame) -> DataFrame:
    """One row per test of each request."""
    exploded = reports.select("iterationIndex", F.explode("results").alias("result")).select(
        "iterationIndex", _request_name(F.col("result")).alias("request"), F.explode("result.testResults").alias("test")
    )
    return exploded.select(
        F.col("iterationIndex").alias("iteration"), "request", F.col("test.description").alias("description"),
        F.col("test.status").alias("status"), F.coalesce("test.error", F.lit("")).alias("error"),
    )


def _tests_of(results: Column) -> Column:
    empty = F.array().cast("array<struct<description: string, status: string, error: string>>")
    return F.flatten(F.transform(results, lambda result: F.coalesce(result["testResults"], empty)))


def iteration_counts(reports: DataFrame) -> DataFrame:
    """Requests and tests, passed and failed, counted inside each iteration; whatever did not pass failed.

    An unreadable document is a row without counts.
    """
    size = lambda items: F.coalesce(F.size(items), F.lit(0))
    passed = lambda items: size(F.filter(items, lambda item: item["status"] == PASS))
    rows = reports.withColumn("tests", _tests_of(F.col("results")))
    return rows.select(
        F.col("iterationIndex").alias("iteration"), "missing", "unreadable", "summary",
        size(F.col("results")).alias("requests"), passed(F.col("results")).alias("passed_requests"),
        size(F.col("tests")).alias("tests"), passed(F.col("tests")).alias("passed_tests"),
    ).withColumns(
        {
            "failed_requests": F.col("requests") - F.col("passed_requests"),
            "failed_tests": F.col("tests") - F.col("passed_tests"),
        }
    )


def totals(reports: DataFrame) -> DataFrame:
    """One row over all iterations.

    The run passes only if a report exists, all of it is readable, it has an iteration, and nothing in it failed.
    """
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).cast("bigint")
    missing = F.coalesce(F.bool_or("missing"), F.lit(False))
    return iteration_counts(reports).agg(
        total("passed_requests").alias("passed_requests"), total("failed_requests").alias("failed_requests"),
        total("passed_tests").alias("passed_tests"), total("failed_tests").alias("failed_tests"),
        missing.alias("missing"), F.count("unreadable").alias("unreadable"), F.count("*").alias("_rows"),
    ).withColumn(
        "overall_pass",
        ~F.col("missing") & (F.col("unreadable") == 0) & (F.col("_rows") > 0) & (F.col("failed_requests") == 0)
        & (F.col("failed_tests") == 0),
    ).drop("_rows")


def summary_differences(reports: DataFrame) -> DataFrame:
    """Numbers of the stored summary that a recount does not confirm, one row per number."""
    counted = iteration_counts(reports.where("unreadable IS NULL"))
    numbers = {
        "totalRequests": "requests", "passedRequests": "passed_requests", "failedRequests": "failed_requests",
        "totalTests": "tests", "passedTests": "passed_tests", "failedTests": "failed_tests",
    }
    lines = F.array(
        *[
            F.struct(
                F.lit(mine).alias("measure"), F.col(f"summary.{theirs}").cast("bigint").alias("stored"),
                F.col(mine).cast("bigint").alias("recounted"),
            )
            for theirs, mine in numbers.items()
        ]
    )
    return counted.select("iteration", F.inline(lines)).where(~F.col("stored").eqNullSafe(F.col("recounted")))


def terminal(runs: DataFrame) -> DataFrame:
    """Finished runs only; an unreadable one, whose state nobody knows, ends the job."""
    return logs.readable(runs).where(F.col("status").isin(TERMINAL))


def activities(runs: DataFrame) -> DataFrame:
    """One row per activity of the finished runs."""
    exploded = terminal(runs).select("pipeline", "runId", F.explode("activities").alias("activity"))
    return exploded.select(
        "pipeline", F.col("runId").alias("run_id"), F.col("activity.name").alias("name"),
        F.col("activity.status").alias("status"), F.col("activity.error.message").alias("error_message"),
        F.col("activity.output.rowsCopied").alias("copied"),
    )


def result_values(runs: DataFrame) -> DataFrame:
    """Every value of every result row, as row number, column and text."""
    rows = logs.readable(runs).select("pipeline", "runId", F.explode("activities").alias("activity"))
    rows = rows.select("pipeline", "runId", F.col("activity.name").alias("activity"),
                       F.explode("activity.resultSets").alias("found"))
    rows = rows.select("pipeline", "runId", "activity", F.posexplode("found.rows").alias("row_number", "fields"))
    return rows.select(
        "pipeline", F.col("runId").alias("run_id"), "activity", "row_number",
        F.explode("fields").alias("column_name", "value"),
    )


def precedence(runs: DataFrame, needs: dict[str, list[str]]) -> DataFrame:
    """Whether each activity should have run: only if all that it needs succeeded.

    The activities of a run are few and arrive together, so the check stays in the row.
    """
    no_names = F.array().cast("array<string>")
    literal = F.create_map(*[part for name, before in needs.items()
                             for part in (F.lit(name), F.array(*map(F.lit, before)) if before else no_names)])
    rows = terminal(runs).withColumn(
        "status_of", F.map_from_entries(F.transform("activities", lambda a: F.struct(a["name"], a["status"])))
    )
    rows = rows.select(F.col("runId").alias("run_id"), "status_of", F.explode("activities").alias("activity"))
    needed = F.coalesce(F.try_element_at(literal, F.col("activity.name")), no_names)
    ready = F.forall(needed, lambda name: F.try_element_at(F.col("status_of"), name).eqNullSafe(F.lit("Succeeded")))
    return rows.select(
        "run_id", F.col("activity.name").alias("name"), F.col("activity.status").alias("status"),
        F.when(ready, "run").otherwise("skipped").alias("expected"),
    )
