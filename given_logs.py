"""API responses, test-run reports and pipeline runs captured over the given tables.

A workflow run is up to ``PAGE`` lines of an order: its offers are those lines, their items the parts, their services
come from the suppliers, and the passengers from the customer. A large order has many runs, so no document and no
group grows with a hot order. Errors, coupons and change offers are those of the lines too; an order without lines
has one run with nothing in it. Lines of unknown parts and orders of unknown customers are in no run. The answers of
the queries follow from the flat tables (`FLAT_SQL`), without any document.

A test iteration has the same lines as its requests, a pipeline run is an event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage import bindings as B
from moorage.operators.joins import attach_children, lookup_join
from moorage.operators.keys import large_groups, parts_of
from moorage.session import materialise, scratch_path
from moorage.sources import logs
from moorage.sources.tables import scan, spread

#: Most lines of a run.
PAGE = 8

#: Row rules over a run or a line, alike in both dialects.
TRANSPORT = "(priority = 1 AND state = 'P')"
BUSINESS = "(priority = 2 AND state = 'P')"
PRICED = "(n_lines > 0 AND NOT (priority = 5 AND state = 'O'))"
REJECTED = "(flag = 'R' AND quantity > 40)"
OTHER = "(flag = 'A' AND quantity > 45)"
LATE = "(flag = 'N' AND quantity <= 10)"
UNEXPECTED = "(flag = 'N' AND quantity > 40)"

FLAT_SQL = f"""line AS (SELECT l_orderkey AS k, l_linenumber AS n, CAST((l_linenumber - 1) // {PAGE} AS INTEGER) AS page,
    part, supplier, quantity, price, flag, shipped, p_size AS size, p_type AS kind, p_brand AS brand
  FROM ({B.LINE_SQL}) JOIN part ON p_partkey = part),
run AS (SELECT o_orderkey AS k, coalesce(page, 0) AS page, o_orderkey || '-' || coalesce(page, 0) AS run_id,
    o_orderstatus AS state, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority, o_orderdate AS ordered,
    o_custkey AS customer, c_mktsegment AS segment, c_acctbal AS balance, c_nationkey AS nation,
    CASE o_orderstatus WHEN 'F' THEN 'GBP' WHEN 'O' THEN 'USD' ELSE 'EUR' END AS currency,
    CAST(coalesce(total, 0) AS DECIMAL(18,2)) AS total, coalesce(n_lines, 0) AS n_lines
  FROM orders JOIN customer ON c_custkey = o_custkey
  LEFT JOIN (SELECT k, page, sum(price) AS total, count(*) AS n_lines FROM line GROUP BY k, page) ON k = o_orderkey),
item AS (SELECT *, CAST(n - 1 - {PAGE} * page AS INTEGER) AS pos,
    segment = 'HOUSEHOLD' AND kind = 'ECONOMY' AND size <= 30 AS direct FROM line JOIN run USING (k, page)),
head AS (SELECT run.*, i.n, i.part, i.supplier, i.quantity, i.flag, i.size FROM run
  LEFT JOIN (SELECT * FROM item WHERE pos = 0) i USING (k, page))"""

_KEPT: dict[tuple[str, str], DataFrame] = {}


def _tasks(spark: SparkSession, folder: str) -> int:
    """Files of the captured runs: a few for each core, as many for one as for any other, so that they are read evenly as they lie.

    So many at least that a task's lines are sorted and grouped in memory, whatever the session's number of partitions.
    """
    cores = spark.sparkContext.defaultParallelism
    return cores * -(-max(4 * cores, parts_of(scan(spark, folder, "lineitem", ["l_orderkey"]))) // cores)


def _lines(spark: SparkSession, folder: str, large: list, tasks: int) -> DataFrame:
    parts = scan(spark, folder, "part", ["p_partkey", "p_size", "p_type", "p_brand"]).selectExpr(
        "p_partkey AS part", "struct(p_size AS size, p_type AS kind, p_brand AS brand) AS p"
    )
    # One row per part, so that it can be looked up before the lines are numbered: a part that repeats repeats its lines after.
    described = parts.groupBy("part").agg(F.collect_list("p").alias("described"))
    lines = B.order_lines(spark, folder, described, large, tasks).select("*", F.explode("described").alias("p"))
    return lines.selectExpr(
        "l_orderkey AS k", f"cast((l_linenumber - 1) div {PAGE} AS int) AS page",
        "struct(l_linenumber AS n, part, supplier, quantity, price, flag, shipped, p.size, p.kind, p.brand) AS line",
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_custkey"]
    customers = scan(spark, folder, "customer", ["c_custkey", "c_mktsegment", "c_acctbal", "c_nationkey"]).selectExpr(
        "c_custkey AS customer", "c_mktsegment AS segment", "c_acctbal AS balance", "c_nationkey AS nation"
    )
    orders = scan(spark, folder, "orders", columns).selectExpr(
        "o_orderkey AS k", "o_orderstatus AS state", "cast(substring(o_orderpriority, 1, 1) AS int) AS priority",
        "o_orderdate AS ordered", "o_custkey AS customer",
        "CASE o_orderstatus WHEN 'F' THEN 'GBP' WHEN 'O' THEN 'USD' ELSE 'EUR' END AS currency",
    )
    return lookup_join(orders, customers, "customer")


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per run with its lines, at most ``PAGE``, in order; built once per session and folder, like any captured log.

    Lines are dealt by order once, for their numbers, their pages, the join and the files. Only where an order is too large
    for one task are they dealt by page, and spread over more tasks on reading if their files are few.
    """
    key = (spark.sparkContext.applicationId, folder)
    if key not in _KEPT:
        large = large_groups(scan(spark, folder, "lineitem", ["l_orderkey"]), "l_orderkey")
        tasks = _tasks(spark, folder)
        pages = _lines(spark, folder, large, tasks).groupBy("k", "page").agg(
            F.sort_array(F.collect_list("line")).alias("lines"), F.sum("line.price").cast("decimal(18,2)").alias("total")
        )
        orders = _orders(spark, folder)
        rows = attach_children(orders, pages, "k") if large else orders.repartition(tasks, "k").join(pages, "k", "left")
        _KEPT[key] = materialise(
            rows.withColumns(
                {
                    "page": F.coalesce("page", F.lit(0)),
                    "lines": F.coalesce("lines", F.array().cast(rows.schema["lines"].dataType)),
                    "total": F.coalesce("total", F.lit(0).cast("decimal(18,2)")),
                }
            ).selectExpr("*", "concat(k, '-', page) AS run_id", "cast(size(lines) AS bigint) AS n_lines"),
            "captured",
        )
    cores = spark.sparkContext.defaultParallelism
    return _KEPT[key] if 2 * _KEPT[key].rdd.getNumPartitions() > cores else _KEPT[key].repartition(4 * cores, "k", "page")


# --------------------------------------------------------------- responses


def _of_line(rule: str) -> str:
    """A rule over a line's columns as one over the entry ``l`` of ``lines``."""
    for name in ("flag", "quantity"):
        rule = rule.replace(name, f"l.{name}")
    return rule


def _object(**fields: str) -> str:
    """JSON text of an object from that of its fields; a field that is null is left out.

    Responses are put together as text, each part once. What is there for every line is one flat ``concat``: structs and
    variants made in a loop over lines are copied on each level around it, and a variant's text costs a parser of its own.
    A line always has a number and a part, a run with lines a key and a customer; all other columns may be null.
    """
    pairs = ", ".join(f"concat('\"{name}\":', {value})" for name, value in fields.items())
    return f"concat('{{', concat_ws(',', {pairs}), '}}')"


def _list(values: str) -> str:
    """JSON text of a list from an array of texts."""
    return f"concat('[', concat_ws(',', {values}), ']')"


def _written(struct: str) -> str:
    return f"to_json({struct})"


def _text(value: str) -> str:
    """JSON text of a string made from keys and fixed words, in which nothing needs an escape."""
    return f"concat('\"', {value}, '\"')"


def _quoted(value: str) -> str:
    """JSON text of any string; few need an escape."""
    escaped = f"get(transform(array(to_json(named_struct('_', {value}))), held -> substring(held, 6, char_length(held) - 6)), 0)"
    return f"if({value} RLIKE '[\\\\x00-\\\\x1f\"\\\\\\\\]', {escaped}, concat('\"', {value}, '\"'))"


def _each(value: str) -> str:
    """JSON texts of the lines, with commas; a line whose text is null has none."""
    return f"concat_ws(',', transform(lines, l -> {value}))"


def _augmentation(subscription: str, provider: str = "null", order: str = "null") -> str:
    return (
        f"named_struct('common', named_struct('nfOrderId', {order}, 'nfSubscriptionId', {subscription}), "
        f"'provider', {provider})"
    )


def _result(container: str, errors: str = "null", **fields: str) -> str:
    return _object(data=_object(**{container: _object(**fields)}), errors=errors)


def _error(code: str, kind: str, text: str) -> str:
    """An error of the line ``l``; those of small parts have no ``type``."""
    start = "{" if code == "null" else f'{{"code":"{code[1:-1]}",'
    word = kind[1:-1]
    return f"""concat('{start}"typeCode":"{word}",', if(l.size > 25, '"type":"{word}",', ''), '"descText":"', {text}, '"}}')"""


def _line_errors(*cases: tuple[str, str]) -> str:
    """One error for every line that a rule holds for, by the first such rule."""
    chosen = " ".join(f"WHEN {_of_line(rule)} THEN {error}" for rule, error in cases)
    return f"concat('[', {_each(f'CASE {chosen} END')}, ']')"


def _price(amount: str) -> str:
    return _object(totalAmount=_object(cdata=_text(f"cast({amount} AS string)"), curCode=_text("currency")))


def _trx(step: int) -> str:
    return _object(trxId=_text(f"concat('T{step}-', run_id)"))


def _one_or_many(values: str) -> str:
    """A list of texts as such, its only entry alone, nothing for none."""
    return f"get(transform(array({values}), held -> CASE size(held) WHEN 0 THEN null WHEN 1 THEN get(held, 0) ELSE {_list('held')} END), 0)"


def _either(value: str, alone: str) -> str:
    """The same value bare in some responses and in a list in others."""
    return f"get(transform(array({value}), held -> if({alone}, held, concat('[', held, ']'))), 0)"


#: What the texts of every line of a run share: made once for the run.
_SHARED = (
    "cast(k AS string) AS key", "concat('P', customer) AS guest", "concat('\"P', customer, '\"') AS first_pax",
    "concat('[\"P', customer, '\",\"Q', customer, '\"]') AS both_pax",
)
_PAX = "CASE WHEN l.quantity <= 10 THEN first_pax WHEN l.quantity <= 30 THEN concat('[', first_pax, ']') ELSE both_pax END"


def _offer(two: str) -> str:
    """The offer of a line: two items for large quantities, of two services each where ``two`` says so."""

    def service(item: int, number: int) -> str:
        return f"""if(l.supplier IS NULL, '{{', concat('{{"serviceId":"V', l.supplier, '-{item}-{number}",')), '"paxRefId":', {_PAX},
          ',"offerServiceAssociation":{{"paxJourneyRef":{{"paxJourneyRefId":["J', l.n, '"]}}}}}}'"""

    def item(number: int) -> str:
        return f"""'{{"offerItemId":"F-', key, '-', l.n, '-', l.part, '-{number}","service":[', {service(number, 1)},
          if({two}, concat(',', {service(number, 2)}), ''), ']}}'"""

    return f"""concat('{{"offerId":"F-', key, '-', l.n, if(l.flag = 'R', '","ownerCode":"ZZ"', '","ownerCode":"QA"'),
      if(l.flag <> 'A', concat(',"journeyOverview":{{"journeyPriceClass":[{{"paxJourneyRefId":"J', l.n, '"}}]}}'), ''),
      ',"offerItem":[', {item(1)}, if(l.quantity > 25, concat(',', {item(2)}), ''),
      '],"totalPrice":{{"totalAmount":{{', if(l.price IS NULL, '', concat('"cdata":"', cast(l.price AS string), '",')), '"curCode":"', currency, '"}}}}}}')"""


def _place(value: str) -> str:
    return f"""coalesce(concat('{{"iataLocationCode":', {_quoted(value)}, '}}'), '{{}}')"""


# A line's journey goes from the customer's market to the part's kind, large parts over the brand.
_JOURNEY = """concat('{"paxJourneyId":"J', l.n, '","paxSegmentRefId":["S', l.n, if(l.size <= 30, 'a"]}', concat('a","S', l.n, 'b"]}')))"""
_SEGMENT = """concat('{"paxSegmentId":"S', l.n, 'a","datedMarketingSegmentRefId":"D', l.n, if(l.size <= 30, 'a"}',
  concat('a"},{"paxSegmentId":"S', l.n, 'b","datedMarketingSegmentRefId":"D', l.n, 'b"}')))"""
_END = _place("substring(l.kind, 1, 3)")
_DATED = f"""concat('{{"datedMarketingSegmentId":"D', l.n, 'a","dep":', origin, ',"arrival":', if(l.size <= 30, concat({_END}, '}}'),
  concat({_place("l.brand")}, '}},{{"datedMarketingSegmentId":"D', l.n, 'b","dep":', {_place("l.brand")}, ',"arrival":', {_END}, '}}')))"""
_LISTS = f"""concat('{{"paxJourneyList":{{"paxJourney":[', {_each(_JOURNEY)}, ']}},"paxSegmentList":{{"paxSegment":[', {_each(_SEGMENT)},
  ']}},"datedMarketingSegmentList":{{"datedMarketingSegment":[', {_each(_DATED)}, ']}}}}')"""
_FOUND = f"""concat('{{"offersGroup":{{"carrierOffers":[{{"offer":[', {_each(_offer("l.size > 25"))}, ']}}]}},"dataLists":', {_LISTS}, '}}')"""
_SHOPPED = _object(
    payloadAttributes=_trx(1),
    augmentationPoint=_written(
        _augmentation("if(balance < 0, null, concat('SUB-', customer))", "named_struct('nfShoppingResponseId', concat('SR-', run_id))")
    ),
    error=f"""if({BUSINESS}, '[{{"code":"SHOP-1","typeCode":"Error","type":"Error","descText":"No fares"}}]', null)""",
    response=f"if({BUSINESS}, null, {_FOUND})",
)
_UNAVAILABLE = _list(f"""array('{{"message":"Subscription unavailable"}}', {_object(message=_text("concat('Run ', run_id)"))})""")
_SHOPPING = _object(
    data=f"if({TRANSPORT}, null, {_object(iataAirShopping=_list(f'array({_SHOPPED})'))})", errors=f"if({TRANSPORT}, {_UNAVAILABLE}, null)"
)
_FIRST_OFFER = f"get(transform(slice(lines, 1, 1), l -> {_offer('false')}), 0)"
_PRICING = _result(
    "iataOfferPrice",
    f"if({PRICED}, null, to_json(array(named_struct('message', 'Offer expired'))))",
    payloadAttributes=_trx(2),
    augmentationPoint=_written(
        _augmentation(
            "concat('SUB-', customer)",
            "if(segment = 'MACHINERY', null, named_struct('nfShoppingResponseId', concat('SR2-', run_id)))",
        )
    ),
    response=f"if({PRICED}, {_object(pricedOffer=_FIRST_OFFER)}, null)",
)
_ITEM = f"""concat('{{"orderItemId":"I-', key, '-', l.n, '","service":[{{"paxRefId":', {_PAX},
  if(l.supplier IS NULL, '}}]}}', concat(',"serviceId":"V', l.supplier, '"}}]}}')))"""
_ITEMS = _one_or_many(f"transform(lines, l -> {_ITEM})")


def _order(owner: str = "'QA'", order_id: str = "concat('O-', k)") -> str:
    return _object(orderId=_text(order_id), orderItem=_ITEMS, ownerCode=_text(owner), totalPrice=_price("total"))


# The exempt error code and the wording of a schedule change.
_TTL = "'NFE-NDC-TTL-INCORRECT'"
_MOVED = "concat('None - Departure Time changed for QA', l.part)"
_CREATE = _result(
    "iataOrderCreate",
    payloadAttributes=_trx(3),
    augmentationPoint=_written(_augmentation("concat('SUB-', customer)", order="concat('N-', run_id)")),
    error=_line_errors(
        ("flag = 'N'", _error(_TTL, "'Warning'", "'Retry later'")), (REJECTED, _error("'ORD-1'", "'Error'", "'Rejected'"))
    ),
    response=f"""if(exists(lines, l -> {_of_line(REJECTED)}), null, {_object(order=_either(_order(), "state = 'F'"))})""",
)


def _retrieve(step: int, error: str) -> str:
    return _result(
        "iataOrderRetrieve", payloadAttributes=_trx(step), error=error,
        response=_object(order=_either(_order(), "priority < 3")),
    )


_RETRIEVE = _retrieve(
    4,
    _line_errors(("flag = 'N'", _error(_TTL, "'Error'", "'Time limit'")), (OTHER, _error("'RET-1'", "'Warning'", "'Other'"))),
)
_RETRIEVE_CHANGE = _retrieve(7, _line_errors(("quantity = 50", _error("'RET-2'", "'Warning'", "'Held'"))))


def _ticket(step: int) -> str:
    coupon = """concat('{"couponNumber":', l.n, if(l.flag = 'A', ',"couponStatusCode":"OK"}', ',"couponStatusCode":"I"}'))"""
    ticket = _object(
        coupon=f"concat('[', {_each(coupon)}, ']')", ticketDocTypeCode=_text("'T'"),
        ticketNumber=_text("if(state = 'P', '', concat('ticket-', run_id))"),
    )
    original = _object(ticketNumber=_text("concat('original-', run_id)"))
    referenced = _object(orderId=_text("concat('O-', k)"), ownerCode=_text("if(nation < 5, 'XX', 'QA')"))
    document = _object(
        originalIssueInfo=f"if(segment = 'BUILDING', null, {original})", paxRefId="first_pax",
        referencedOrder=f"if(priority = 3, null, {referenced})", ticket=_either(ticket, "priority = 1"),
    )
    amount = _object(cdata=_text("if(state = 'O', 'n/a', cast(total AS string))"), curCode=_text("currency"))
    payment = _object(
        paymentProcessingSummary=_object(
            amount=amount, paymentId=_text("concat('PAY-', run_id)"), paymentStatusCode=_text("'Paid'")
        )
    )
    order_id = f"CASE WHEN segment = 'MACHINERY' THEN null WHEN {TRANSPORT} THEN concat('O-', k, '-old') ELSE concat('O-', k) END"
    return _result(
        "iataOrderChange",
        payloadAttributes=_trx(step),
        error=_line_errors(("quantity = 49", _error("'TKT-1'", "'Warning'", "'Queue'"))),
        response=_object(
            order=_either(_order(order_id=order_id), "state = 'F'"), ticketDocInfo=_either(document, "state = 'O'")
        ),
        paymentFunctions=_either(payment, "priority > 3"),
    )


_OPEN = "filter(lines, l -> l.flag = 'A')"
_NAME = _object(paxRefId=_text("if(l.size > 25, '', guest)"))
_CHANGED_ITEM = _object(nameChangeService=_NAME, offerItemId=_text("concat('C-', k, '-', l.n, '-', l.part)"))
_CHANGED_OFFER = _object(
    offerId=_text("concat('C-', k, '-', l.n)"), offerItem=f"if(l.quantity > 25, null, {_CHANGED_ITEM})",
    ownerCode=_text("'QA'"), totalPrice=_price("l.price"),
)
_NO_OFFER = "array(named_struct('code', 'CHG-1', 'typeCode', 'Error', 'type', 'Error', 'descText', 'No change offer'))"
_RESHOP_OFFERS = _object(
    reshopResults=_object(reshopOffers=_object(offer=_one_or_many(f"transform({_OPEN}, l -> {_CHANGED_OFFER})")))
)
_RESHOP = _result(
    "iataOrderReshop",
    payloadAttributes=_trx(8),
    augmentationPoint=_written(
        _augmentation("null", "if(balance < 0, null, named_struct('nfShoppingResponseId', concat('SR8-', run_id)))")
    ),
    error=f"if(size({_OPEN}) = 0, to_json({_NO_OFFER}), null)",
    response=f"if(size({_OPEN}) = 0, null, {_RESHOP_OFFERS})",
)
_CONFIRM_ERRORS = _line_errors(
    ("flag = 'A'", _error("null", "'Warning'", _MOVED)), ("flag = 'R' AND quantity > 25", _error("null", "'Error'", _MOVED)),
    ("flag = 'R'", _error(_TTL, "'Error'", "'Time limit'")), (LATE, _error(_TTL, "'Warning'", "'Time limit'")),
    (UNEXPECTED, _error("'CNF-1'", "'Warning'", "'Unexpected'")),
)
_CONFIRMED = _order("if(segment = 'FURNITURE', '', 'QA')", "if(priority = 5, 'O-other', concat('O-', k))")
_CONFIRM = _result(
    "iataOrderChange",
    payloadAttributes=_trx(9),
    augmentationPoint=_written(
        _augmentation("concat('SUB9-', customer)", order="if(segment = 'FURNITURE', '', concat('N9-', run_id))")
    ),
    error=_CONFIRM_ERRORS,
    response=_object(order=_either(_CONFIRMED, "state = 'F'")),
)
_BODIES = {
    "shopping": _SHOPPING, "pricing": _PRICING, "create": _CREATE, "retrieve": _RETRIEVE, "ticket": _ticket(5),
    "payment": _result("customerPayment", success="cast(balance >= 0 AS string)"), "retrieve_change": _RETRIEVE_CHANGE,
    "reshop": _RESHOP, "confirm": _CONFIRM, "ticket_change": _ticket(10),
}


def api_log(spark: SparkSession, folder: str, steps: list[str] | None = None) -> DataFrame:
    """One row per (run, step) with the response as JSON text."""
    given = steps or list(_BODIES)
    shared = runs(spark, folder).selectExpr("*", *_SHARED, f"{_place('substring(segment, 1, 3)')} AS origin")
    if len(given) == 1:
        # A projection is compiled; the generator that several steps need is not.
        rows = shared.selectExpr("*", f"{logs.STEPS[given[0]].seq} AS seq", f"'{given[0]}' AS step", f"{_BODIES[given[0]]} AS body")
    else:
        entries = ", ".join(f"named_struct('seq', {logs.STEPS[step].seq}, 'step', '{step}', 'body', {_BODIES[step]})" for step in given)
        rows = shared.select("*", F.expr(f"inline(array({entries}))"))
    return rows.selectExpr(
        "run_id", "seq", "step", "if(balance < -900 AND step <> 'shopping', 500, 200) AS http_status", "body",
        "ordered + make_dt_interval(0, 0, seq) AS requested_at",
    )


def parsed_step(spark: SparkSession, folder: str, step: str, part: str | None = None) -> DataFrame:
    return logs.parse_step(api_log(spark, folder, [step]), step, part)


def parsed_outcomes(spark: SparkSession, folder: str, steps: list[str]) -> DataFrame:
    """The outcomes of some steps, from a log that is kept by step and read once."""
    path = scratch_path(spark, "api-log")
    for step in steps:
        logs.write_log(api_log(spark, folder, [step]), path, step)
    return logs.parse_outcomes(logs.read_log(spark, path), steps)


# ------------------------------------------------------------- run reports


def reports(spark: SparkSession, folder: str) -> DataFrame:
    """One iteration per run, numbered by its order: a request per line, with two tests where there are enough pieces.

    The stored summary counts a request with a failed test as failed although
    its own status says pass.
    """
    checks = {"ordered before": "l.shipped < ordered", "small part": "l.size > 40"}
    tests = ", ".join(
        f"named_struct('description', '{name}', 'status', if({failed}, 'fail', 'pass'), 'error', if({failed}, 'not {name}', null))"
        for name, failed in checks.items()
    )
    result = f"""named_struct('name', if(l.flag = 'N', null, concat('request ', l.n)), 'path', concat('path/', l.part),
      'status', if(l.flag = 'R', 'fail', 'pass'), 'test', if(l.quantity > 25, named_struct('filename', concat('file ', l.supplier)), null),
      'response', named_struct('status', if(priority = 3, null, 200), 'duration', l.quantity),
      'testResults', if(l.quantity > 5, array({tests}), null))"""
    results = runs(spark, folder).select("k", F.expr(f"transform(lines, l -> {result})").alias("results"))
    all_tests = "flatten(transform(results, x -> coalesce(x.testResults, array())))"
    clean = "x.status = 'pass' AND NOT exists(coalesce(x.testResults, array()), t -> t.status = 'fail')"
    return results.selectExpr(
        f"""to_json(named_struct('iterationIndex', k, 'results', results, 'summary', named_struct(
        'totalRequests', size(results), 'passedRequests', size(filter(results, x -> {clean})),
        'failedRequests', size(filter(results, x -> NOT ({clean}))),
        'totalTests', size({all_tests}), 'passedTests', size(filter({all_tests}, t -> t.status = 'pass')),
        'failedTests', size(filter({all_tests}, t -> t.status <> 'pass'))))) AS value"""
    )


def parsed_reports(spark: SparkSession, folder: str) -> DataFrame:
    return logs.parse_text(reports(spark, folder), logs.RUN_REPORT).withColumn("missing", F.lit(False))


# ----------------------------------------------------------- pipeline runs


def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One pipeline run per event: copy, load and validate; a run in progress lists no activity."""
    rows = spread(scan(spark, folder, "events", ["event_id", "event_type", "value", "props"]), spark.sparkContext.defaultParallelism)
    k = "cast(get_json_object(props, '$.k') AS bigint)"
    rows_found = """named_struct('rowCount', 2, 'rows', array(
      map('ValidatedFactRows', cast(event_id AS string), 'Kind', event_type),
      map('ValidatedFactRows', cast(event_id + 1 AS string))))"""
    return rows.selectExpr(
        f"""to_json(named_struct('pipeline', concat('PL_', event_type), 'runId', cast(event_id AS string),
        'status', CASE WHEN value < 20 THEN 'InProgress' WHEN value < 40 THEN 'Failed' WHEN value < 60 THEN 'Cancelled'
          ELSE 'Succeeded' END,
        'activities', if(value < 20, null, array(
          named_struct('name', 'Copy', 'status', 'Succeeded', 'error', cast(null AS struct<message: string>),
            'output', named_struct('rowsCopied', {k}), 'resultSets', null),
          named_struct('name', 'Load', 'status', if(value < 40, 'Failed', 'Succeeded'),
            'error', if(value < 40, named_struct('message', concat('value ', cast(value AS decimal(10,2)))), null),
            'output', cast(null AS struct<rowsCopied: bigint>), 'resultSets', null),
          named_struct('name', 'Validate',
            'status', CASE WHEN value < 40 THEN 'Skipped' WHEN value < 60 THEN 'Cancelled' ELSE 'Succeeded' END,
            'error', null, 'output', null, 'resultSets', if(value < 60, null, array({rows_found})))
        )))) AS value"""
    )


def parsed_pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    return logs.parse_text(pipeline_runs(spark, folder), logs.PIPELINE_RUN)
