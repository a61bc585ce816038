"""Documents that can't be read are never passed over, and a log of many steps is read once."""

import json
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from moorage.operators import errors, runlogs
from moorage.session import scratch_path
from moorage.sources import logs

ITERATION = {"iterationIndex": 0, "results": [{"path": "p", "status": "pass", "testResults": [{"description": "d", "status": "pass"}]}]}
FAILED = {"iterationIndex": 1, "results": [{"path": "q", "status": "fail"}]}
RUN = {"pipeline": "A", "runId": "1", "status": "Succeeded", "activities": [{"name": "Copy", "status": "Succeeded"}]}


def reports(spark, tmp_path, text, multi_line=True):
    path = tmp_path / "report.json"
    path.write_text(text)
    return logs.read_run_reports(spark, str(path), multi_line=multi_line)


def totals(frame):
    row = runlogs.totals(frame).first()
    return row["passed_requests"], row["failed_requests"], row["unreadable"], row["overall_pass"]


@pytest.mark.parametrize(
    "text, multi_line, wanted",
    [
        (json.dumps([ITERATION]), True, (1, 0, 0, True)),
        (json.dumps([ITERATION, ITERATION], indent=2), True, (2, 0, 0, True)),
        (json.dumps([ITERATION, FAILED]), True, (1, 1, 0, False)),
        (json.dumps([ITERATION, FAILED])[:-40], True, (0, 0, 1, False)),
        (json.dumps([ITERATION])[:-1], True, (0, 0, 1, False)),
        (json.dumps([ITERATION, None]), True, (1, 0, 1, False)),
        ("", True, (0, 0, 0, False)),
        (" \n", True, (0, 0, 1, False)),
        ("[]", True, (0, 0, 0, False)),
        ("null", True, (0, 0, 1, False)),
        ("oops", True, (0, 0, 1, False)),
        ("", False, (0, 0, 0, False)),
        (json.dumps(ITERATION) + "\n\n" + json.dumps(ITERATION) + "\n", False, (2, 0, 0, True)),
        (json.dumps(ITERATION) + "\n" + json.dumps(FAILED)[:-9] + "\n", False, (1, 0, 1, False)),
    ],
)
def test_totals_of_whole_and_broken_reports(spark, tmp_path, text, multi_line, wanted):
    assert totals(reports(spark, tmp_path, text, multi_line)) == wanted


def test_quarantine_of_a_report(spark, tmp_path):
    cut = json.dumps(FAILED)[:-9]
    frame = reports(spark, tmp_path, json.dumps(ITERATION) + "\n" + cut + "\n", multi_line=False)
    good, bad = logs.quarantine(frame)
    assert rows(good, "iterationIndex") == [(0,)] and rows(bad) == [(cut,)]
    assert rows(logs.quarantine_counts(frame)) == [(1, 1)]
    assert rows(runlogs.summary_differences(frame.where("unreadable IS NOT NULL"))) == []
    with pytest.raises(Exception, match="Unreadable document"):
        logs.readable(frame).collect()


def test_broken_line_of_a_pipeline_log_is_refused(spark):
    path = scratch_path(spark, "test-runs")
    spark.createDataFrame([(json.dumps(RUN),), (json.dumps(RUN)[:-20],)], "value string").coalesce(1).write.text(path)
    frame = logs.read_pipeline_runs(spark, path)
    for made in (runlogs.terminal(frame), runlogs.activities(frame), runlogs.result_values(frame), runlogs.precedence(frame, {})):
        with pytest.raises(Exception, match="Unreadable document"):
            made.collect()
    good, bad = logs.quarantine(frame)
    assert rows(runlogs.activities(good), "name") == [("Copy",)] and bad.count() == 1


def log_of(spark, bodies):
    """Every body for every step."""
    return spark.createDataFrame(
        [
            (f"{step}-{i}", kind.seq, step, 200, body if body is None or isinstance(body, str) else json.dumps(body), datetime(2026, 1, 1))
            for step, kind in logs.STEPS.items() for i, body in enumerate(bodies)
        ],
        logs.API_LOG,
    )


ERROR = {"code": errors.EXEMPT_CODE, "typeCode": "Warning", "type": "Warning", "descText": "x"}
OTHER = {"code": 17, "typeCode": "Error", "descText": "Departure Time changed for Q"}
CONTAINERS = sorted({kind.container for kind in logs.STEPS.values()})
BODIES = [
    {"data": {name: {"response": {}, "error": found} for name in CONTAINERS}}
    for found in ([], [ERROR], [ERROR, OTHER], [OTHER, {"typeCode": "Warning", "descText": "Arrival Time changed for Q"}], None)
] + [
    {"data": {name: [{"error": [OTHER]}] for name in CONTAINERS}},
    {"data": None, "errors": [{"message": "m"}, {"message": "n"}]}, {"data": {}}, {"data": "text"}, {}, [], "null", None, "{\"data\": {", "", "x",
]


def test_one_pass_agrees_with_step_by_step(spark):
    log = log_of(spark, BODIES)
    steps = list(logs.STEPS)
    found = logs.parse_outcomes(log, steps).select(
        "run_id", "step", F.size(F.coalesce("errors", F.array())).alias("transport"), "has_data", "has_result", "unreadable",
        errors.dispatched(F.col("business"), steps).alias("blocking"),
    )
    single = None
    for step in steps:
        part = logs.parse_step(log, step).select(
            "run_id", "step", F.size(F.coalesce("errors", F.array())).alias("transport"), "has_data",
            F.col("result").isNotNull().alias("has_result"), "unreadable",
            errors.blocking_count(F.col("result.error"), step).alias("blocking"),
        )
        single = part if single is None else single.unionByName(part)
    order = lambda frame: sorted(map(tuple, frame.collect()), key=lambda row: row[:2])
    assert order(found) == order(single)


def test_unreadable_body_blocks_its_step(spark):
    log = log_of(spark, ["{\"data\": {", None])
    steps = list(logs.STEPS)
    outcomes = logs.parse_outcomes(log, steps)
    blocked = {row["run_id"]: row["blocking"] for row in errors.blocked(outcomes, steps).collect()}
    assert {blocked[f"{step}-0"] for step in steps} == {1} and {blocked[f"{step}-1"] for step in steps} == {0}
    verdicts = errors.classified(outcomes, steps).collect()
    assert {row["outcome"] for row in verdicts} == {"fail"} and len(verdicts) == 2 * len(steps)
    assert {row["unreadable"] for row in logs.parse_step(log, "create").collect()} == {"{\"data\": {", None}


def test_five_steps_need_one_scan(spark):
    path = scratch_path(spark, "test-log")
    logs.write_log(log_of(spark, BODIES), path)
    steps = ["shopping", "pricing", "retrieve_change", "ticket", "reshop"]
    blocked = errors.blocked(logs.parse_outcomes(logs.read_log(spark, path), steps), steps)
    plan = blocked._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "PartitionFilters: [" in plan and "step" in plan.split("PartitionFilters: [")[1]
    assert blocked.count() == 5 * len(BODIES)
