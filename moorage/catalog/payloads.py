"""Nested-JSON and API-log queries; a workflow run is a few lines of an order."""

from __future__ import annotations

from pyspark.sql import functions as F

import given_logs
from given_logs import FLAT_SQL
from moorage.catalog.aggregates import DESTINATION, OFFER_ID_SQL, ORIGIN, PICK_SQL
from moorage.catalog.joins import SEGMENTS_SQL, SHOP_OK_SQL
from moorage.catalog.registry import query
from moorage.functions.payload import as_array
from moorage.operators import errors, payloads, workflow
from moorage.sources import logs, tables

PAX_SQL = "CASE WHEN quantity > 30 THEN 2 ELSE 1 END"
GUEST_SQL = "'P' || customer"
ITEM_ID_SQL = "'I-' || k || '-' || n"
#: Runs of which no line is rejected.
CREATED_SQL = f"run_id NOT IN (SELECT run_id FROM item WHERE {given_logs.REJECTED})"


def _shopping(spark, folder):
    return given_logs.parsed_step(spark, folder, "shopping")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, CAST(CASE WHEN n IS NULL THEN 0 ELSE {PAX_SQL} END AS INTEGER) AS passengers,
    CASE WHEN n IS NULL THEN '' WHEN {PAX_SQL} = 2 THEN {GUEST_SQL} || ',Q' || customer ELSE {GUEST_SQL} END AS pax_ref_ids
    FROM head"""
)
def json_array_or_scalar(spark, folder):
    from moorage.functions.payload import first_value

    parsed = given_logs.parsed_step(spark, folder, "retrieve")
    order = first_value(F.col("result.response.order"), logs.ORDER)
    service = first_value(first_value(order["orderItem"], logs.ITEM)["service"], logs.SERVICE)
    pax = as_array(service["paxRefId"], "string")
    return parsed.select("run_id", pax.alias("pax")).select(
        "run_id", F.size("pax").alias("passengers"), F.array_join("pax", ",").alias("pax_ref_ids")
    )


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, CASE WHEN NOT {given_logs.TRANSPORT} THEN 'T1-' || run_id END AS trx_id,
    CASE WHEN NOT {given_logs.TRANSPORT} AND balance >= 0 THEN 'SUB-' || customer END AS subscription_id FROM run"""
)
def json_safe_path(spark, folder):
    return _shopping(spark, folder).select(
        "run_id", F.col("result.payloadAttributes.trxId").alias("trx_id"),
        F.col("result.augmentationPoint.common.nfSubscriptionId").alias("subscription_id"),
    )


OFFERS = f"FROM item WHERE {SHOP_OK_SQL}"


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, pos, {OFFER_ID_SQL} AS offer_id, CASE WHEN flag = 'R' THEN 'ZZ' ELSE 'QA' END AS owner_code,
    CAST(price AS DECIMAL(18,2)) AS amount, currency {OFFERS}"""
)
def flatten_offers(spark, folder):
    return payloads.offers(_shopping(spark, folder)).drop("offer")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, {OFFER_ID_SQL} AS offer_id, {OFFER_ID_SQL} || '-' || part || '-' || t AS offer_item_id,
    'V' || supplier || '-' || t || '-' || s AS service_id, g || customer AS pax_ref_id
    FROM item, (VALUES (1), (2)) a(t), (VALUES (1), (2)) b(s), (VALUES ('P'), ('Q')) c(g)
    WHERE {SHOP_OK_SQL} AND (t = 1 OR quantity > 25) AND (s = 1 OR size > 25) AND (g = 'P' OR quantity > 30)"""
)
def flatten_offer_items_services(spark, folder):
    return payloads.offer_services(_shopping(spark, folder))


@query(f"WITH {FLAT_SQL} {SEGMENTS_SQL}")
def flatten_segments(spark, folder):
    return payloads.segments(given_logs.parsed_step(spark, folder, "shopping", logs.SHOPPING_LISTS))


@query(f"WITH {FLAT_SQL} SELECT run_id, {OFFER_ID_SQL} AS offer_id, 'J' || n AS journey_id {OFFERS}")
def resolve_journey_ref(spark, folder):
    rows = payloads.offers(_shopping(spark, folder))
    return rows.select("run_id", "offer_id", payloads.journey_ref(F.col("offer")).alias("journey_id"))


@query(f"WITH {FLAT_SQL} SELECT run_id, {OFFER_ID_SQL} AS offer_id {OFFERS} AND direct")
def filter_direct_offers(spark, folder):
    return payloads.direct_offers(_shopping(spark, folder), ORIGIN, DESTINATION)


SELECTED_SQL = f"""SELECT run_id, 'T1-' || run_id AS trx_id, 'SUB-' || customer AS subscription_id,
  'SR-' || run_id AS shopping_response_id, {OFFER_ID_SQL} AS offer_id, CASE WHEN flag = 'R' THEN 'ZZ' ELSE 'QA' END AS owner_code,
  {OFFER_ID_SQL} || '-' || part || '-1' AS offer_item_id, {GUEST_SQL} AS pax_ref_id
  FROM ({PICK_SQL}) JOIN item USING (run_id, n) WHERE balance >= 0"""


@query(f"WITH {FLAT_SQL} {SELECTED_SQL}")
def select_offer(spark, folder):
    return payloads.selected_offer(_shopping(spark, folder), ORIGIN, DESTINATION)


PRICED_SQL = f"""SELECT h.run_id, 'T2-' || h.run_id AS trx_id, 'SUB-' || customer AS subscription_id,
  CASE WHEN segment <> 'MACHINERY' THEN 'SR2-' || h.run_id ELSE s.shopping_response_id END AS shopping_response_id,
  {OFFER_ID_SQL} AS offer_id, CASE WHEN flag = 'R' THEN 'ZZ' ELSE 'QA' END AS owner_code,
  {OFFER_ID_SQL} || '-' || part || '-1' AS offer_item_id, {GUEST_SQL} AS pax_ref_id
  FROM head h LEFT JOIN ({SELECTED_SQL}) s ON s.run_id = h.run_id WHERE {given_logs.PRICED}"""


@query(f"WITH {FLAT_SQL} {PRICED_SQL}")
def extract_priced_offer(spark, folder):
    selected = payloads.selected_offer(_shopping(spark, folder), ORIGIN, DESTINATION)
    return payloads.priced_offer(given_logs.parsed_step(spark, folder, "pricing"), selected)


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'T3-' || run_id AS trx_id, 'N-' || run_id AS nf_order_id,
    'SUB-' || customer AS subscription_id, 'O-' || k AS order_id, 'QA' AS owner_code FROM run WHERE {CREATED_SQL}"""
)
def extract_created_order(spark, folder):
    return payloads.created_order(given_logs.parsed_step(spark, folder, "create"))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'T4-' || run_id AS trx_id, 'O-' || k AS order_id, 'QA' AS owner_code,
    {ITEM_ID_SQL} AS order_item_id, 'V' || supplier AS service_id, CASE WHEN n IS NOT NULL THEN {GUEST_SQL} END AS pax_ref_id,
    CAST(total AS VARCHAR) AS amount_text, total AS amount, currency FROM head"""
)
def extract_retrieved_order(spark, folder):
    return payloads.retrieved_order(given_logs.parsed_step(spark, folder, "retrieve"))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'T7-' || run_id AS trx_id, {ITEM_ID_SQL} AS order_item_id,
    'V' || supplier AS service_id FROM head"""
)
def extract_order_before_change(spark, folder):
    return payloads.order_before_change(given_logs.parsed_step(spark, folder, "retrieve_change"))


def _ticket_sql(step: int) -> str:
    return f"""SELECT run_id, 'T{step}-' || run_id AS trx_id, CASE WHEN state <> 'P' THEN 'ticket-' || run_id
    WHEN segment <> 'BUILDING' THEN 'original-' || run_id END AS ticket_number, 'T' AS ticket_type, n AS coupon_number,
    CASE flag WHEN 'A' THEN 'OK' WHEN 'N' THEN 'I' WHEN 'R' THEN 'I' END AS coupon_status FROM head"""


@query(f"WITH {FLAT_SQL} {_ticket_sql(5)} UNION ALL {_ticket_sql(10)}")
def extract_ticket(spark, folder):
    first = payloads.ticket(given_logs.parsed_step(spark, folder, "ticket"))
    return first.unionByName(payloads.ticket(given_logs.parsed_step(spark, folder, "ticket_change")))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'PAY-' || run_id AS payment_id, 'Paid' AS payment_status,
    CASE WHEN state <> 'O' THEN total END AS amount, currency FROM run"""
)
def extract_payment(spark, folder):
    return payloads.payment(given_logs.parsed_step(spark, folder, "ticket"))


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'T8-' || run_id AS trx_id, CASE WHEN balance >= 0 THEN 'SR8-' || run_id END AS shopping_response_id,
    'C-' || k || '-' || n AS offer_id, 'QA' AS owner_code, CAST(price AS DECIMAL(18,2)) AS amount, currency,
    'C-' || k || '-' || n || '-' || (CASE WHEN quantity > 25 THEN 1 ELSE part END) AS offer_item_id,
    CASE WHEN quantity > 25 OR size > 25 THEN 'T1' ELSE {GUEST_SQL} END AS pax_ref_id
    FROM item JOIN (SELECT run_id, min(n) AS n FROM item WHERE flag = 'A' GROUP BY run_id) USING (run_id, n)"""
)
def extract_reshop_offer(spark, folder):
    return payloads.reshop_offer(given_logs.parsed_step(spark, folder, "reshop"), "T1")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, v.name, v.value FROM head, LATERAL (VALUES ('trx_id', 'T9-' || run_id),
      ('nf_order_id', CASE WHEN segment <> 'FURNITURE' THEN 'N9-' || run_id END),
      ('subscription_id', 'SUB9-' || customer),
      ('order_id', CASE WHEN priority = 5 THEN 'O-other' ELSE 'O-' || k END),
      ('owner_code', CASE WHEN segment <> 'FURNITURE' THEN 'QA' END), ('order_item_id', {ITEM_ID_SQL}),
      ('pax_ref_id', CASE WHEN n IS NOT NULL THEN {GUEST_SQL} END), ('amount', CAST(total AS VARCHAR)),
      ('currency', currency)) v(name, value)
    WHERE v.value IS NOT NULL"""
)
def extract_changed_order(spark, folder):
    return payloads.changed_values(given_logs.parsed_step(spark, folder, "confirm"))


# --------------------------------------------------------------------- errors


def _blocked(spark, folder, steps, rules=errors.RULES):
    return errors.blocked(given_logs.parsed_outcomes(spark, folder, steps), steps, rules)


NOTHING_OPEN_SQL = "run_id NOT IN (SELECT run_id FROM item WHERE flag = 'A')"


def _blocked_sql(step: str, rule: str) -> str:
    """Blocking errors of a step: the lines of each run that the rule holds for."""
    return f"""SELECT run_id, '{step}' AS step, CAST(count(*) FILTER ({rule}) AS INTEGER) AS blocking
    FROM run LEFT JOIN (SELECT run_id, n, flag, quantity, size FROM item) USING (run_id) GROUP BY run_id"""


def _run_sql(step: str, rule: str) -> str:
    """Blocking errors of a step that fails as a whole."""
    return f"SELECT run_id, '{step}' AS step, CAST(CASE WHEN {rule} THEN 1 ELSE 0 END AS INTEGER) AS blocking FROM run"


@query(
    f"WITH {FLAT_SQL} "
    + " UNION ALL ".join(
        [
            _run_sql("shopping", given_logs.BUSINESS),
            _run_sql("pricing", "false"),
            _blocked_sql("retrieve_change", "quantity = 50"),
            _blocked_sql("ticket", "quantity = 49"),
            _run_sql("reshop", NOTHING_OPEN_SQL),
        ]
    )
)
def errors_strict(spark, folder):
    return _blocked(spark, folder, ["shopping", "pricing", "retrieve_change", "ticket", "reshop"])


@query(f"WITH {FLAT_SQL} {_blocked_sql('create', given_logs.REJECTED)}")
def errors_non_warning_block(spark, folder):
    return _blocked(spark, folder, ["create"])


@query(f"WITH {FLAT_SQL} {_blocked_sql('retrieve', given_logs.OTHER)}")
def errors_code_exempt(spark, folder):
    return _blocked(spark, folder, ["retrieve"])


@query(f"""WITH {FLAT_SQL} {_blocked_sql("confirm", f"flag = 'R' OR {given_logs.UNEXPECTED}")}""")
def errors_change_rules(spark, folder):
    return _blocked(spark, folder, ["confirm"])


@query(
    f"WITH {FLAT_SQL} "
    + " UNION ALL ".join(
        [
            _blocked_sql("create", f"(flag = 'N' AND size <= 25) OR {given_logs.REJECTED}"),
            _blocked_sql("retrieve", f"flag = 'N' OR {given_logs.OTHER}"),
            _blocked_sql("confirm", f"flag IN ('A', 'R') OR {given_logs.LATE} OR {given_logs.UNEXPECTED}"),
        ]
    )
)
def errors_ui_rules(spark, folder):
    return _blocked(spark, folder, ["create", "retrieve", "confirm"], errors.BROWSER_RULES)


HTTP_SQL = "balance >= -900"


def _classified_sql(http: str, transport: str, data: str, blocked: str) -> str:
    return f"""SELECT run_id, step, http_ok, transport_ok, has_data, blocking AS blocking_errors,
    CASE WHEN http_ok AND transport_ok AND has_data AND blocking = 0 THEN 'pass' ELSE 'fail' END AS outcome
    FROM (SELECT run_id, step, blocking, {http} AS http_ok, {transport} AS transport_ok, {data} AS has_data
      FROM ({blocked}) JOIN run USING (run_id))"""


@query(
    f"WITH {FLAT_SQL} "
    + " UNION ALL ".join(
        [
            _classified_sql("true", f"NOT {given_logs.TRANSPORT}", f"NOT {given_logs.TRANSPORT}", _run_sql("shopping", given_logs.BUSINESS)),
            _classified_sql(HTTP_SQL, given_logs.PRICED, "true", _run_sql("pricing", "false")),
            _classified_sql(HTTP_SQL, "true", "true", _blocked_sql("create", given_logs.REJECTED)),
            _classified_sql(HTTP_SQL, "true", "true", _run_sql("payment", "false")),
        ]
    )
)
def classify_response(spark, folder):
    steps = ["shopping", "pricing", "create", "payment"]
    return errors.classified(given_logs.parsed_outcomes(spark, folder, steps), steps)


# ------------------------------------------------------------------- workflow

NEEDED = ["trx_id", "subscription_id", "shopping_response_id", "offer_id", "owner_code", "offer_item_id"]


@query(
    f"""WITH {FLAT_SQL} SELECT r.run_id, 'pricing' AS step, CASE WHEN s.run_id IS NULL THEN '{", ".join(NEEDED)}' ELSE '' END AS missing
    FROM run r LEFT JOIN ({SELECTED_SQL}) s ON s.run_id = r.run_id"""
)
def required_values_missing(spark, folder):
    selected = payloads.selected_offer(_shopping(spark, folder), ORIGIN, DESTINATION)
    steps = given_logs.api_log(spark, folder, ["pricing"])
    return workflow.required_missing(steps, selected, NEEDED)


# An event stream read as workflow state: a view sets the offer, a click sets
# the price, a purchase sets the order; a sign-up clears offer and price, an
# error clears the order.
STATE_SQL = """state AS (SELECT user_id AS run_id, event_id AS seq, v.name, v.value FROM events, LATERAL (VALUES
  ('view', 'offer', 'o' || event_id), ('click', 'price', 'p' || event_id), ('purchase', 'order', 'b' || event_id),
  ('signup', 'offer', NULL), ('signup', 'price', NULL), ('error', 'order', NULL)) v(kind, name, value)
  WHERE v.kind = event_type)"""
PROBES_SQL = """probes AS (SELECT user_id AS run_id, event_id AS seq, v.name FROM events, LATERAL (VALUES
  ('click', 'offer'), ('purchase', 'offer'), ('purchase', 'price')) v(kind, name) WHERE v.kind = event_type)"""


def _state(spark, folder):
    rows = tables.scan(spark, folder, "events", ["event_id", "user_id", "event_type"])
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    setting = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    settings = (
        F.when(kind == "view", F.array(setting("offer", F.concat(F.lit("o"), number))))
        .when(kind == "click", F.array(setting("price", F.concat(F.lit("p"), number))))
        .when(kind == "purchase", F.array(setting("order", F.concat(F.lit("b"), number))))
        .when(kind == "signup", F.array(setting("offer", F.lit(None)), setting("price", F.lit(None))))
        .when(kind == "error", F.array(setting("order", F.lit(None))))
    )
    return rows.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.inline(settings))


def _probes(spark, folder):
    rows = tables.scan(spark, folder, "events", ["event_id", "user_id", "event_type"])
    names = F.when(F.col("event_type") == "click", F.array(F.lit("offer"))).when(
        F.col("event_type") == "purchase", F.array(F.lit("offer"), F.lit("price"))
    )
    return rows.select(F.col("user_id").alias("run_id"), F.col("event_id").alias("seq"), F.explode(names).alias("name"))


@query(
    f"""WITH {STATE_SQL}, {PROBES_SQL} SELECT p.run_id, p.name, p.seq, s.value FROM probes p ASOF LEFT JOIN state s
    ON s.run_id = p.run_id AND s.name = p.name AND s.seq < p.seq"""
)
def carry_state_last_value(spark, folder):
    return workflow.as_of(_state(spark, folder), _probes(spark, folder))


@query(
    f"""WITH {STATE_SQL} SELECT run_id, name, max(seq) FILTER (value IS NOT NULL) AS last_set,
    max(seq) FILTER (value IS NULL) AS last_clear,
    coalesce(max(seq) FILTER (value IS NOT NULL) > coalesce(max(seq) FILTER (value IS NULL), -1), false) AS usable,
    arg_max(coalesce(value, '-'), seq) AS final_value FROM state GROUP BY run_id, name"""
)
def stale_value_guard(spark, folder):
    state = _state(spark, folder)
    final = workflow.final_state(state).select("run_id", "name", F.coalesce("value", F.lit("-")).alias("final_value"))
    return workflow.usable(state).join(final, ["run_id", "name"])


@query(
    """SELECT c_custkey AS login_id, lower(c_name) AS user_email FROM customer
    WHERE c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY'"""
)
def identity_match_gate(spark, folder):
    rows = tables.scan(spark, folder, "customer", ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"])
    logins = rows.select(
        F.col("c_custkey").alias("login_id"),
        F.lower("c_name").alias("requested_email"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "someone@example.test").otherwise(F.lower("c_name")).alias("user_email"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit("token-"), F.col("c_custkey"))).otherwise("").alias("token"),
    )
    return workflow.accepted_logins(logins).select("login_id", "user_email")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, segment = 'MACHINERY' OR NOT {given_logs.TRANSPORT} AS order_agrees, true AS owner_agrees,
    priority = 3 OR (segment <> 'MACHINERY' AND NOT {given_logs.TRANSPORT}) AS reference_agrees,
    priority = 3 OR nation >= 5 AS reference_owner_agrees FROM run"""
)
def chain_order_match(spark, folder):
    ticketed = payloads.ticket_references(given_logs.parsed_step(spark, folder, "ticket"))
    retrieved = payloads.retrieved_order(given_logs.parsed_step(spark, folder, "retrieve"))
    return workflow.order_match(ticketed, retrieved)


@query(f"WITH {FLAT_SQL} SELECT run_id, bool_and(flag <> 'R') AS all_owned {OFFERS} GROUP BY run_id")
def owner_all_equal(spark, folder):
    return workflow.carrier_owns_all(payloads.offers(_shopping(spark, folder)), "QA")


@query(
    f"""WITH {FLAT_SQL} SELECT run_id, 'O-' || k AS booking_reference, total AS amount, currency, {ITEM_ID_SQL} AS order_item_id,
    'N-' || run_id AS external_id FROM head WHERE {CREATED_SQL}"""
)
def payment_batch_rows(spark, folder):
    created = payloads.created_order(given_logs.parsed_step(spark, folder, "create"))
    return payloads.payment_rows(created, payloads.retrieved_order(given_logs.parsed_step(spark, folder, "retrieve")))
