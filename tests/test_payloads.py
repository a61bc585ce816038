"""Responses of odd shapes, error rules, workflow state and run reports."""

import json
import random
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from moorage.operators import errors, payloads, runlogs, workflow
from moorage.session import scratch_path
from moorage.sources import logs


def parsed(spark, step, *bodies, status=200):
    table = [(str(i), logs.STEPS[step].seq, step, status, body if isinstance(body, str) else json.dumps(body),
              datetime(2026, 1, 1)) for i, body in enumerate(bodies)]
    return logs.parse_step(spark.createDataFrame(table, logs.API_LOG), step)


def offer(name, journey=None, service_journey=None, pax=("P1",)):
    found = {"offerId": name, "ownerCode": "QA", "offerItem": [{"offerItemId": f"{name}-1", "service": [
        {"serviceId": "S", "paxRefId": pax}]}], "totalPrice": {"totalAmount": {"cdata": "10.50", "curCode": "GBP"}}}
    if journey:
        found["journeyOverview"] = {"journeyPriceClass": [{"paxJourneyRefId": journey}]}
    if service_journey:
        found["offerItem"][0]["service"][0]["offerServiceAssociation"] = {
            "paxJourneyRef": {"paxJourneyRefId": [service_journey]}}
    return found


LISTS = {
    "paxJourneyList": {"paxJourney": [{"paxJourneyId": "two", "paxSegmentRefId": ["s1", "s2"]},
                                      {"paxJourneyId": "one", "paxSegmentRefId": ["s1"]}]},
    "paxSegmentList": {"paxSegment": [{"paxSegmentId": "s1", "datedMarketingSegmentRefId": "d1"},
                                      {"paxSegmentId": "s2", "datedMarketingSegmentRefId": "missing"}]},
    "datedMarketingSegmentList": {"datedMarketingSegment": [
        {"datedMarketingSegmentId": "d1", "dep": {"iataLocationCode": "AAA"}, "arrival": {"iataLocationCode": "BBB"}}]},
}


def shopping(offers, many=True, **fields):
    result = {"payloadAttributes": {"trxId": "T"}, "augmentationPoint": {
        "common": {"nfSubscriptionId": "SUB"}, "provider": {"nfShoppingResponseId": "R"}},
        "response": {"offersGroup": {"carrierOffers": [{"offer": offers}]}, "dataLists": LISTS}} | fields
    return {"data": {"iataAirShopping": [result] if many else result}}


def test_direct_offer_wins_else_the_first(spark):
    frame = parsed(
        spark, "shopping",
        shopping([offer("a", "two"), offer("b", service_journey="one")]),
        shopping([offer("a", "two"), offer("b", "unknown")], many=False),
        shopping([]), shopping([offer("a", "one", pax="P7")]), shopping([offer("a", pax=[])]),
        shopping([offer("a")], error=[{"code": "X"}]), shopping([offer("a")], augmentationPoint={}),
        {"data": None, "errors": [{"message": "down"}, {"message": "again"}]}, {"data": {"iataAirShopping": [{"response": {}}]}},
        "not json",
    )
    picked = payloads.selected_offer(frame, "AAA", "BBB")
    assert rows(picked, "run_id", "offer_id", "pax_ref_id") == [("0", "b", "P1"), ("1", "a", "P1"), ("3", "a", "P7")]
    assert rows(payloads.direct_offers(frame, "AAA", "BBB")) == [("0", "b"), ("3", "a")]
    assert rows(payloads.best_per_document(frame, "AAA", "BBB"), "run_id", "offer_id")[:2] == [("0", "b"), ("1", "a")]
    assert rows(frame.where("run_id = '7'").select(errors.messages(F.col("errors")))) == [("down; again",)]
    legs = rows(payloads.segments(frame.where("run_id = '0'")), "journey_id", "segment_id", "origin")
    assert ("one", "s1", "AAA") in legs and ("two", "s2", None) in [tuple(leg) for leg in legs]


def test_order_may_be_bare_or_listed(spark):
    order = {"orderId": "O", "ownerCode": "QA", "totalPrice": {"totalAmount": {"cdata": "n/a", "curCode": "GBP"}},
             "orderItem": [{"orderItemId": "I", "service": [{"serviceId": "V", "paxRefId": "P1"}]}]}
    frame = parsed(spark, "retrieve", *[{"data": {"iataOrderRetrieve": {"payloadAttributes": {"trxId": "T"},
                   "response": {"order": shape}}}} for shape in (order, [order], order | {"orderItem": None}, [])])
    got = rows(payloads.retrieved_order(frame), "run_id", "order_id", "order_item_id", "pax_ref_id", "amount")
    assert got == [("0", "O", "I", "P1", None), ("1", "O", "I", "P1", None), ("2", "O", None, None, None),
                   ("3", None, None, None, None)]


def test_ticket_number_falls_back_to_the_original_issue(spark):
    def body(document):
        return {"data": {"iataOrderChange": {"payloadAttributes": {"trxId": "T"}, "response": {"ticketDocInfo": document}}}}

    frame = parsed(
        spark, "ticket", body({"ticket": {"ticketNumber": "7", "coupon": {"couponNumber": 1, "couponStatusCode": "I"}}}),
        body([{"ticket": [{"ticketNumber": ""}], "originalIssueInfo": {"ticketNumber": "8"}}]), body({}), body(None),
    )
    assert [tuple(r) for r in payloads.ticket(frame).select("ticket_number", "coupon_number").orderBy("run_id").collect()] == [
        ("7", 1), ("8", None), (None, None), (None, None)
    ]


def test_reshop_fallbacks(spark):
    def body(offers):
        return {"data": {"iataOrderReshop": {"response": {"reshopResults": {"reshopOffers": {"offer": offers}}}}}}

    price = {"totalPrice": {"totalAmount": {"cdata": "1", "curCode": "GBP"}}}
    frame = parsed(spark, "reshop", body({"offerId": "C", "offerItem": None} | price), body([{"offerId": "D", "offerItem": [
        {"offerItemId": "D-9", "nameChangeService": [{"paxRefId": ["P4", "P5"]}]}]} | price]), body([{"offerId": "E"}]), body([]))
    assert rows(payloads.reshop_offer(frame, "T1"), "offer_item_id", "pax_ref_id") == [("C-1", "T1"), ("D-9", "P4")]


MOVED = "None - Arrival Time changed for QA5 2026-10-07"


@pytest.mark.parametrize(
    "found, blocks",
    [
        ([{"descText": MOVED, "typeCode": "Warning"}, {"descText": MOVED[7:], "typeCode": "Warning"}], 0),
        ([{"code": errors.EXEMPT_CODE, "typeCode": "Warning"}], 0),
        (None, 0),
        ([{"descText": MOVED, "typeCode": "Error"}], 1),
        ([{"descText": MOVED, "typeCode": None}], 1),
        ([{"descText": "Departure Time changed forever", "typeCode": "Warning"}], 1),
        ([{"code": "OTHER", "descText": "Unexpected", "typeCode": "Warning"}], 1),
        ([{"code": errors.EXEMPT_CODE, "typeCode": "Error"}], 1),
    ],
)
def test_change_rules(spark, found, blocks):
    frame = parsed(spark, "confirm", {"data": {"iataOrderChange": {"error": found}}})
    assert rows(frame.select(errors.blocking_count(F.col("result.error"), "confirm"))) == [(blocks,)]


def test_exempt_code_passes_retrieval_whatever_its_severity(spark):
    frame = parsed(spark, "retrieve", {"data": {"iataOrderRetrieve": {"error": [
        {"code": errors.EXEMPT_CODE, "typeCode": "Error", "type": "Warning"}, {"typeCode": "Warning"}]}}})
    error = F.col("result.error")
    counts = [errors.blocking_count(error, step) for step in ("retrieve", "create", "ticket")]
    counts.append(errors.blocking_count(error, "create", errors.BROWSER_RULES))
    assert rows(frame.select(*[c.alias(str(i)) for i, c in enumerate(counts)])) == [(1, 1, 2, 1)]


def test_state_as_of_each_step_over_blocks(spark):
    made = random.Random(3)
    events, probes = [], []
    for seq in range(3000):
        run = "hot" if made.random() < 0.6 else f"r{made.randrange(5)}"
        name = made.choice(["a", "b"])
        if made.random() < 0.4:
            events.append((run, name, seq, None if made.random() < 0.3 else f"v{seq}"))
        if made.random() < 0.4:
            probes.append((run, name, seq))
    state, wanted = {}, []
    at = {}
    for run, name, seq, value in events:
        at.setdefault((run, name), []).append((seq, value))
    for run, name, seq in probes:
        before = [value for when, value in at.get((run, name), []) if when < seq]
        wanted.append((run, name, seq, before[-1] if before else None))
    event_frame = spark.createDataFrame(events, "run_id string, name string, seq bigint, value string")
    probe_frame = spark.createDataFrame(probes, "run_id string, name string, seq bigint")
    for block in (7, 100, 10_000):
        got = [tuple(r) for r in workflow.as_of(event_frame, probe_frame, block).collect()]
        assert sorted(got, key=str) == sorted(wanted, key=str)
    state = {(run, name): found[-1][1] for (run, name), found in at.items()}
    assert {(r.run_id, r.name): r.value for r in workflow.final_state(event_frame).collect()} == state
    usable = {(r.run_id, r.name): r.usable for r in workflow.usable(event_frame).collect()}
    assert usable == {key: value is not None for key, value in state.items()}


def test_missing_inputs_and_logins(spark):
    steps = spark.createDataFrame([("1", "pricing"), ("2", "pricing")], "run_id string, step string")
    inputs = spark.createDataFrame([("1", "x", "")], "run_id string, a string, b string")
    assert rows(workflow.required_missing(steps, inputs, ["a", "b"])) == [("1", "pricing", "b"), ("2", "pricing", "a, b")]
    logins = spark.createDataFrame(
        [(1, "a@example.test", "a@example.test", "t"), (2, "a@example.test", "b@example.test", "t"),
         (3, "a@example.test", None, "t"), (4, "a@example.test", "a@example.test", "")],
        "id int, requested_email string, user_email string, token string",
    )
    assert rows(workflow.accepted_logins(logins), "id") == [(1,)]


def report(status="pass", tests=("fail",) * 5):
    return [{"iterationIndex": 0, "results": [{"name": None, "path": "p", "status": status, "test": {"filename": "f"},
             "response": {"status": 401, "duration": 7},
             "testResults": None if tests is None else [{"description": "d", "status": t, "error": None} for t in tests]}],
             "summary": {"totalRequests": 1, "passedRequests": 0, "failedRequests": 1, "totalTests": len(tests or ()),
                         "passedTests": 0, "failedTests": len(tests or ())}}]


def test_run_reports(spark, tmp_path):
    path = tmp_path / "report.json"
    path.write_text(json.dumps(report()))
    frame = logs.read_run_reports(spark, str(path), multi_line=True)
    assert rows(runlogs.totals(frame)) == [(1, 0, 0, 5, False, 0, False)]
    assert rows(runlogs.summary_differences(frame), "measure", "stored", "recounted") == [
        ("failed_requests", 1, 0), ("passed_requests", 0, 1)
    ]
    assert rows(runlogs.requests(frame), "request", "http_status", "duration") == [("f", "401", "7")]
    assert rows(runlogs.tests(frame), "request", "error")[0] == ("f", "")
    path.write_text(json.dumps(report(tests=None)))
    assert rows(runlogs.totals(logs.read_run_reports(spark, str(path), multi_line=True))) == [(1, 0, 0, 0, False, 0, True)]
    assert rows(runlogs.totals(logs.read_run_reports(spark, str(tmp_path / "none.json")))) == [(0, 0, 0, 0, True, 0, False)]


def test_pipeline_runs(spark):
    path = scratch_path(spark, "test-runs")
    runs = [
        {"pipeline": "A", "runId": "1", "status": "Failed", "activities": [
            {"name": "Copy", "status": "Failed", "error": {"message": "m"}}, {"name": "Load", "status": "Skipped"}]},
        {"pipeline": "B", "runId": "2", "status": "InProgress"},
        {"pipeline": "C", "runId": "3", "status": "Succeeded", "activities": [{"name": "Load", "status": "Succeeded",
            "resultSets": [{"rowCount": 1, "rows": [{"Rows": 8, "Amount": 585.0}]}]}]},
    ]
    spark.createDataFrame([(json.dumps(run),) for run in runs], "value string").write.text(path)
    frame = logs.read_pipeline_runs(spark, path)
    assert runlogs.terminal(frame).count() == 2
    assert rows(runlogs.result_values(frame), "activity", "column_name", "value") == [
        ("Load", "Amount", "585.0"), ("Load", "Rows", "8")
    ]
    needs = {"Copy": [], "Load": ["Copy"]}
    assert rows(runlogs.precedence(frame, needs), "run_id", "name", "expected") == [
        ("1", "Copy", "run"), ("1", "Load", "skipped"), ("3", "Load", "skipped")
    ]
