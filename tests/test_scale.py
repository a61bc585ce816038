"""Steps that must not grow faster than their input."""

import json

import given_logs
from conftest import rows
from moorage.operators import keys, payloads, quality, workflow
from moorage.plans import sales
from moorage.sources import logs
from pyspark.sql import functions as F


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_steps_of_a_run_meet_without_a_broadcast(spark):
    ticketed = spark.createDataFrame(
        [("a", "1", "x", "1", "x"), ("b", "2", "x", None, None), (None, "3", "x", "3", "x")],
        "run_id string, order_id string, owner_code string, referenced_order_id string, referenced_owner_code string",
    )
    retrieved = spark.createDataFrame(
        [("a", "1", "x"), ("b", "9", "x"), (None, "3", "x")], "run_id string, order_id string, owner_code string"
    )
    found = workflow.order_match(ticketed, retrieved)
    assert rows(found) == [("a", True, True, True, True), ("b", False, True, True, True)]
    steps = spark.createDataFrame([("a", "pricing"), ("c", "pricing")], "run_id string, step string")
    missing = workflow.required_missing(steps, retrieved, ["order_id"])
    assert rows(missing) == [("a", "pricing", ""), ("c", "pricing", "order_id")]
    paid = payloads.payment_rows(
        spark.createDataFrame([("a", "n")], "run_id string, nf_order_id string"),
        retrieved.selectExpr("*", "1 AS amount", "'GBP' AS currency", "'i' AS order_item_id"),
    )
    assert rows(paid) == [("a", "1", 1, "GBP", "i", "n")]
    for frame in (found, missing, paid):
        assert "SortMergeJoin" in _plan(frame) and "Broadcast" not in _plan(frame)


def test_lines_are_numbered_by_one_shuffle_unless_a_group_is_large(spark):
    given = [(group, value) for group in (None, 1, 2, 3) for value in range(5 + (group or 0) * 10)]
    lines = spark.createDataFrame(given, "g int, v int").repartition(3)
    large = keys.large_groups(lines, "g", 20)
    assert sorted(large) == [2, 3] and keys.large_groups(lines, "g") == []
    wanted = sorted((str(group), value, value + 1) for group, value in given)
    for some in (None, large, [None, 1]):
        found = keys.numbered_within(lines, "g", ["v"], "n", some)
        assert sorted((str(g), v, n) for g, v, n in found.collect()) == wanted
    dealt = keys.numbered_within(lines, "g", ["v"], "n").groupBy("g").agg(F.max("n").alias("n"))
    plan = _plan(dealt).split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning(g") == 1 and "rangepartitioning" not in plan


def test_captured_runs_are_dealt_once_and_read_as_they_lie(spark, tmp_path):
    folder = str(tmp_path)
    lines = [(k, n, 1 + n % 2, 1, 5.0 * n, 10.0 + n, "A", None) for k in range(1, 60) for n in range(1, 1 + k % 11)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                     "l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "part": ([(1, 5, "t", "b"), (2, 30, "t", "b")], "p_partkey long, p_size int, p_type string, p_brand string"),
        "orders": ([(k, "O", None, "1-URGENT", 7) for k in range(1, 60)],
                   "o_orderkey long, o_orderstatus string, o_orderdate timestamp_ntz, o_orderpriority string, o_custkey long"),
        "customer": ([(7, "BUILDING", 1.0, 3)], "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey long"),
    }
    for name, (given, schema) in tables.items():
        spark.createDataFrame(given, schema).repartition(2).write.parquet(f"{folder}/{name}.parquet")
    found = given_logs.runs(spark, folder)
    assert 2 * found.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism and "Exchange" not in _plan(found)
    sizes = sorted((r["k"], r["page"], [line["n"] for line in r["lines"]]) for r in found.collect())
    numbers = {k: list(range(1, 1 + k % 11)) for k in range(1, 60)}
    wanted = [(k, page, n[8 * page : 8 * page + 8]) for k, n in numbers.items() for page in range(max(1, -(-len(n) // 8)))]
    assert sizes == sorted(wanted)
    assert "Exchange" not in _plan(given_logs.api_log(spark, folder, ["create"]))


def test_whether_a_result_is_there_is_asked_without_copying_it(spark):
    bodies = ['{"data":{"iataOrderCreate":%s}}' % x for x in ("{}", '{"_":"x"}', "[]", "null", '"x"', "[{}]")]
    bodies += ['{"data":{}}', '{"data":[]}', "{}", "no", None]
    log = spark.createDataFrame([(str(n), 3, "create", 200, body, None) for n, body in enumerate(bodies)], logs.API_LOG)
    found = logs.parse_outcomes(log, ["create"])
    assert "MapType" not in _plan(found)
    there = {r["run_id"]: (r["has_data"], r["has_result"]) for r in found.collect()}
    assert [there[str(n)] for n in range(len(bodies))] == (
        [(True, True)] * 2 + [(True, False)] * 4 + [(True, False)] + [(False, False)] * 4
    )


def test_a_body_holds_each_of_its_parts_once():
    for step in ("create", "retrieve", "ticket", "confirm"):
        body = given_logs._BODIES[step]
        assert body.count("orderItemId") == 1 and "parse_json" not in body
    assert given_logs._BODIES["reshop"].count("offerItemId") == 1


def test_a_log_of_one_step_is_written_without_a_sort(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "partitionBy", None)
    log = spark.createDataFrame(
        [("r", 1, "shopping", 200, "{}", None), ("r", 2, "pricing", 200, "[]", None)], logs.API_LOG
    )
    for step in ("shopping", "pricing"):
        logs.write_log(log, str(tmp_path / "log"), step)
    kept = logs.read_log(spark, str(tmp_path / "log"))
    assert rows(kept.select("run_id", "seq", "step", "body")) == [("r", 1, "shopping", "{}"), ("r", 2, "pricing", "[]")]


def test_a_list_of_shopping_results_is_read_with_declared_types(spark):
    lists = """{"paxJourneyList":{"paxJourney":[{"paxJourneyId":"J","paxSegmentRefId":["s","t"]}]},
      "paxSegmentList":{"paxSegment":[{"paxSegmentId":"s","datedMarketingSegmentRefId":"d"}]},
      "datedMarketingSegmentList":{"datedMarketingSegment":[{"datedMarketingSegmentId":"d","dep":{"iataLocationCode":"A"}}]}}"""
    result = '{"payloadAttributes":{"trxId":"T"},"response":{"dataLists":%s}}' % lists
    body = '{"data":{"iataAirShopping":%s}%s}'
    bodies = [body % (x, "") for x in (f"[{result}]", result, f"[{result},{{}}]", "[]", "null", "[null]", '"x"', "[1]")]
    bodies += [body % (f"[{result}]", ',"errors":[{"message":"m"}]'), body % (result, ',"errors":{"message":"m"}'), '{"data":{', "no", "[]", None]
    log = spark.createDataFrame([(str(n), 1, "shopping", 200, text, None) for n, text in enumerate(bodies)], logs.API_LOG)
    whole, part = logs.parse_step(log, "shopping"), logs.parse_step(log, "shopping", logs.SHOPPING_LISTS)
    seen = lambda found: sorted(
        (int(r["run_id"]), r["errors"] and r["errors"][0][0], r["has_data"], r["trx"], r["unreadable"])
        for r in found.select("*", F.col("result.payloadAttributes.trxId").alias("trx")).collect()
    )
    there = {0, 1, 2, 8, 9}
    assert seen(whole) == seen(part) and {row[0] for row in seen(whole) if row[3] == "T"} == there
    assert {row[0] for row in seen(whole) if row[4] is not None} == {10, 11} and seen(whole)[8][1] == "m"
    found = rows(payloads.segments(part), "run_id", "pos", "dated_segment_id", "origin")
    assert found == rows(payloads.segments(whole), "run_id", "pos", "dated_segment_id", "origin")
    assert found == sorted((str(n), pos, *leg) for n in there for pos, leg in enumerate([("d", "A"), (None, None)]))


def test_tasks_grow_with_the_rows_whatever_the_session_has(spark, monkeypatch):
    lines = spark.range(1000).select((F.col("id") % 40).alias("g"), "id")
    assert keys.parts_of(lines) == 4
    monkeypatch.setattr(keys, "ROWS_A_TASK", 30)
    assert keys.parts_of(lines) == 34
    assert keys._placed(lines, ["id"], 34).select("_range").distinct().count() > 20


def test_a_table_of_small_groups_is_counted_by_bucket_only(spark, monkeypatch):
    lines = spark.range(1000).select(F.when(F.col("id") < 990, F.col("id") % 100).alias("g"))
    monkeypatch.setattr(keys, "GROUP_BUCKETS", 4)
    found = lines.groupBy("g").count().where("count > 9").collect()
    assert sorted(keys.large_groups(lines, "g", 9), key=str) == sorted([row["g"] for row in found], key=str)
    assert keys.large_groups(lines, "g", 10) == [] and keys.large_groups(lines.where("g IS NULL"), "g", 9) == [None]


def test_facts_meet_only_the_keys_that_lack_a_mark(spark):
    many = spark.range(60_000).select(F.col("id").alias("key"), F.when(F.col("id") % 5 > 0, True).alias("has_city"))
    facts = spark.createDataFrame([(n, key) for n, key in enumerate([1, 5, 5, None, -1, 59_999])], "n int, key long")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        found = quality.lookup_marks(facts, many.select("*", F.lit(True).alias("has_key")), "key")
        marks = rows(found, "n", "has_city", "has_key")
        assert "SortMergeJoin" not in _plan(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert marks == [(0, True, True), (1, None, True), (2, None, True), (3, None, None), (4, None, None), (5, True, True)]


def test_lines_are_not_shuffled_for_customers(monkeypatch):
    met = []

    class Rows:
        def __init__(self, *names):
            self.names = {*names}

        def select(self, *_):
            return self

    def join(left, right, on):
        met.append((on, left.names))
        return Rows(*left.names, *right.names)

    monkeypatch.setattr(sales, "lookup_join", join)
    sales.extract(Rows("order"), Rows("line"), Rows("customer"), Rows("product"), Rows("store"))
    assert [names for on, names in met if on == "customer_id"] == [{"order"}]
    assert met[-1] == ("order_id", {"line", "product", "store"})


def test_a_lookup_of_many_rows_in_a_small_file_is_not_broadcast(spark, tmp_path):
    def kept(name, frame):
        frame.write.parquet(f"{tmp_path}/{name}", compression="zstd")
        return spark.read.parquet(f"{tmp_path}/{name}")

    tables = {
        "fact_sales": kept("fact", spark.sql("SELECT 20200101 AS date_key, id % 3 AS product_key, 2 AS quantity, 5.00BD AS sales_amount FROM range(9)")),
        "dim_date": kept("date", spark.sql("SELECT 20200101 AS date_key, 2020 AS calendar_year, 1 AS calendar_month")),
        "dim_product": kept("product", spark.sql("SELECT id AS product_key, if(id = 0, 'a', 'b') AS category_name FROM range(200000)")),
    }
    found = sales.by_month_category(tables, "calendar_month")
    assert [tuple(row) for row in found.collect()] == [(2020, 1, "a", 6, 15), (2020, 1, "b", 12, 30)]
    # The file of the products is far under the limit of 10 MB, their rows are over it; the single day is broadcast.
    assert _plan(found).count("SortMergeJoin") and _plan(found).count("BroadcastHashJoin")


def test_bodies_are_flat_texts_that_hold_any_value(spark):
    """No struct, variant or inner loop is made for a line; nulls leave their field out and texts are escaped."""
    for body in given_logs._BODIES.values():
        assert "variant" not in body and "sequence(" not in body and "(lines, l -> named_struct" not in body
    line = "struct<n:int,part:bigint,supplier:bigint,quantity:int,price:decimal(12,2),flag:string,size:int,kind:string,brand:string>"
    given = [(1, 7, 'a"b', [(1, 3, 5, 40, None, "N", 40, "x\ny", None), (2, 4, None, None, None, None, None, None, "c\\d")])]
    run = spark.createDataFrame(given, f"k bigint, customer bigint, segment string, lines array<{line}>").selectExpr(
        "*", "'1-0' AS run_id", "1D AS balance", "'F' AS state", "2 AS priority", "'GBP' AS currency", "1 AS nation", "2L AS n_lines"
    )
    shared = run.selectExpr("*", *given_logs._SHARED, f"{given_logs._place('substring(segment, 1, 3)')} AS origin")
    body = json.loads(shared.selectExpr(f"{given_logs._BODIES['shopping']} AS body").first()[0])
    response = body["data"]["iataAirShopping"][0]["response"]
    first, second = response["offersGroup"]["carrierOffers"][0]["offer"]
    reference = lambda n: {"paxJourneyRef": {"paxJourneyRefId": [f"J{n}"]}}
    assert [s for item in first["offerItem"] for s in item["service"]] == [
        {"serviceId": f"V5-{t}-{s}", "paxRefId": ["P7", "Q7"], "offerServiceAssociation": reference(1)} for t in (1, 2) for s in (1, 2)
    ]
    assert second == {
        "offerId": "F-1-2", "ownerCode": "QA", "totalPrice": {"totalAmount": {"curCode": "GBP"}},
        "offerItem": [{"offerItemId": "F-1-2-4-1", "service": [{"paxRefId": ["P7", "Q7"], "offerServiceAssociation": reference(2)}]}],
    }
    legs = response["dataLists"]["datedMarketingSegmentList"]["datedMarketingSegment"]
    assert [(leg["dep"].get("iataLocationCode"), leg["arrival"].get("iataLocationCode")) for leg in legs] == [
        ('a"b', None), (None, "x\ny"), ('a"b', "c\\d"), ("c\\d", None)
    ]
