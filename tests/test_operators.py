"""Keys, joins, reconciliation, checks and the store, against brute force."""

import os
import random
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from moorage import bindings
from moorage.operators import dims, joins, keys, quality, reconcile, workflow
from moorage.session import scratch_path
from moorage.sources import tables
from moorage.sources.store import PublishConflict


def test_keys_follow_the_natural_order_over_many_ranges(spark):
    words = [f"Customer#{n:09d}" for n in range(5000)]
    random.Random(1).shuffle(words)
    frame = spark.createDataFrame([(w,) for w in words], "name string").repartition(7)
    got = rows(keys.allocate_keys(frame, "name", "key", 10), "key", "name")
    assert got == [(11 + n, name) for n, name in enumerate(sorted(words))]


def test_keys_are_the_same_however_the_input_is_split(spark):
    frame = spark.range(0, 3000).withColumn("line", (F.col("id") % 7).cast("int"))
    one = keys.allocate_keys(frame.coalesce(1), ["line", "id"], "key")
    many = keys.allocate_keys(frame.repartition(13), ["line", "id"], "key")
    assert rows(one) == rows(many)


def test_no_new_rows_get_no_keys(spark):
    known = spark.createDataFrame([(4, "a")], "key bigint, name string")
    assert keys.allocate_keys(known.select("name").limit(0), "name", "key", known).count() == 0
    assert rows(keys.allocate_keys(spark.createDataFrame([("b",)], "name string"), "name", "key", known)) == [(5, "b")]


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_many_hot_keys_lose_nothing(spark, how):
    # 1,500 keys of equal weight besides an unmatched one and NULLs that hold most of the rows.
    facts = spark.range(0, 30_000).select(
        "id", F.when(F.col("id") % 3 == 0, 7777).when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 1500).alias("k")
    )
    lookup = spark.range(0, 1400).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    joined = joins.lookup_join(facts, lookup, "k", how).collect()
    known = set(range(1400))
    want = [(r["id"], r["k"]) for r in facts.collect() if how == "left" or (r["k"] in known) == (how != "left_anti")]
    assert sorted((r["id"], r["k"] if r["k"] is not None else -1) for r in joined) == sorted((i, -1 if k is None else k) for i, k in want)


def test_adaptive_execution_splits_a_hot_key(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {name: spark.conf.get(name, None) for name in small}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        facts = spark.range(0, 200_000, 1, 8).select(
            F.uuid().alias("id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("k")
        )
        lookup = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("k"), F.lit("v").alias("v"))
        joined = joins.lookup_join(facts, lookup, "k")
        assert joined.count() == 200_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_children_are_attached_like_a_left_join(spark):
    parent = spark.range(0, 20).select(F.col("id").alias("k"), (F.col("id") * 2).alias("p"))
    child = spark.range(0, 100).select((F.col("id") % 15).alias("k"), F.col("id").alias("c"))
    wanted = parent.join(child, "k", "left").select("k", "p", "c")
    assert rows(reconcile.difference_counts(joins.attach_children(parent, child, "k").select("k", "p", "c"), wanted)) == [
        (0, 0, True)
    ]


def test_update_overwrites_with_null_and_keeps_unmatched(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    source = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(joins.update_from(target, source, "k", ["v"])) == [(1, None, "x"), (2, "b", "y")]


def test_differences_count_copies_and_see_nulls(spark):
    left = [("a", 1), ("a", 1), (None, 2), ("c", None)]
    right = [("a", 1), (None, 2), (None, 2), ("d", 4)]
    schema = "x string, y int"
    got = reconcile.differences(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))
    wanted = Counter(left)
    wanted.subtract(Counter(right))
    assert {(r.x, r.y): r.surplus for r in got.collect()} == {k: n for k, n in wanted.items() if n}
    assert rows(reconcile.difference_counts(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema))) == [
        (2, 2, False)
    ]


def test_checks_pass_nulls_and_count_hot_orphans(spark):
    child = spark.createDataFrame([(None,), (1,), (9,), (9,), (9,)], "k int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphans(child, "k", parent, "id", "lost", 7)) == [("lost", 7, 3, "9")]
    assert rows(quality.row_rules(child, [quality.Rule("big", 1, F.col("k") > 5)], "k")) == [("big", 1, 3, "9")]
    assert rows(quality.primary_key(child, ["k"], "pk", 1)) == [("pk_not_null", 1, 1, ""), ("pk_unique", 1, 1, "9")]


def test_gate_reports_the_first_code(spark):
    report = spark.createDataFrame([("b", 2, 5, "x"), ("a", 1, 1, "y"), ("ok", 0, 0, None)],
                                   "rule string, code int, violations bigint, sample_key string")
    with pytest.raises(quality.LoadError, match="load 1: first"):
        quality.gate(report, "load", {0: "none", 1: "first", 2: "second"})


def test_gate_names_every_rule_of_the_code(spark):
    report = spark.createDataFrame([("patient", 1, 7, "x"), ("doctor", 1, 2, "y")], "rule string, code int, violations bigint, sample_key string")
    with pytest.raises(quality.LoadError) as refused:
        quality.gate(report, "load", {1: "first"})
    assert "7 x patient, e.g. x" in refused.value.message and "2 x doctor, e.g. y" in refused.value.message


def test_two_settings_at_one_step(spark):
    events = spark.createDataFrame([("r", "n", 2**60, "a"), ("r", "n", 2**60, "b"), ("r", "n", 1, None)], "run_id string, name string, seq bigint, value string")
    probes = spark.createDataFrame([("r", "n", 2**60 + 1), ("r", "n", 2**60), ("r", "n", 2**62)], "run_id string, name string, seq bigint")
    for frame in (events, events.orderBy("value"), events.orderBy(F.desc("value"))):
        assert rows(workflow.as_of(frame, probes), "seq", "value")[1:] == [(2**60 + 1, "b"), (2**62, "b")]
        assert rows(workflow.final_state(frame), "value") == [("b",)]


def test_every_line_is_kept(spark):
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    given = spark.read.parquet(f"{folder}/lineitem.parquet")
    lines = bindings.order_lines(spark, folder)
    cents = lambda name: F.sum((F.col(name) * 100).cast("decimal(20,0)"))
    assert lines.agg(F.count("*"), cents("price")).first() == given.agg(F.count("*"), cents("l_extendedprice")).first()
    assert lines.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").isEmpty()
    ids = bindings.appointments(spark, folder).select("appointment_id")
    assert ids.count() == ids.distinct().count() == given.count()


def test_contract(spark):
    frame = spark.createDataFrame([], "a int, b string")
    assert quality.schema_differences(frame, {"a": "bigint", "c": "string"}) == [
        ("a", "type int"), ("b", "unexpected"), ("c", "missing"),
    ]


def test_collated_spellings(spark):
    frame = spark.createDataFrame([("london",), ("London ",), ("LONDON",), ("Leeds",)], "t string")
    assert len(rows(dims.distinct_spellings(frame, "t", "n"))) == 4
    assert rows(dims.distinct_spellings(frame, "t", "n", "UTF8_LCASE_RTRIM")) == [("LONDON",), ("Leeds",)]


def test_store_publishes_all_or_nothing(spark, store):
    one, two = spark.range(1).toDF("a"), spark.range(2).toDF("a")
    assert store.publish({"x": one, "y": one}, 0) == 1
    with pytest.raises(PublishConflict):
        store.publish({"x": two}, 0)
    with pytest.raises(ZeroDivisionError):
        store.publish({"x": two}, 1, lambda written: 1 / 0)
    assert store.version() == 1 and store.read()["x"].count() == 1
    assert store.publish({"x": two}, 1) == 2
    assert store.read()["x"].count() == 2 and store.read()["y"].count() == 1 and store.read(1)["x"].count() == 1


def test_staging_again_does_not_double(spark):
    path = scratch_path(spark, "test-stage")
    tables.stage(spark.range(10).toDF("a"), path)
    staged, copied = tables.stage_counted(spark.range(10).toDF("a"), path)
    assert staged.count() == copied == 10


def test_totals_side_by_side(spark):
    frame = spark.range(5)
    got = tables.one_row({"n": frame.agg(F.count("*")), "top": frame.agg(F.max("id").cast("string"))})
    assert rows(got) == [(5, "4")]


def test_a_missing_column_in_a_map_fails(spark):
    with pytest.raises(Exception, match="nothing"):
        tables.mapped(spark.range(1), {"a": ("nothing", "int")}).collect()


def test_lines_of_a_very_large_order(spark, tmp_path):
    """An order of 25,000 lines between small ones: numbers without gaps, in order, over several ranges, and ids of their own."""
    n = 25_000
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    lines = spark.range(n).selectExpr("5L AS l_orderkey", "id").unionByName(
        spark.range(300).selectExpr("1 + id % 30 AS l_orderkey", "id")
    ).selectExpr(
        "l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id AS l_partkey", "id % 5 AS l_suppkey", "1D AS l_quantity",
        "CAST(id AS DOUBLE) AS l_extendedprice", "'A' AS l_returnflag", "TIMESTAMP_NTZ '2026-01-05 00:00:00' AS l_shipdate",
    )
    orders = spark.range(1, 31).selectExpr("id AS o_orderkey", "id AS o_custkey", "TIMESTAMP_NTZ '2026-01-01 00:00:00' AS o_orderdate")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    found = defaultdict(list)
    for order, line, part in bindings.order_lines(spark, str(tmp_path)).select("l_orderkey", "l_linenumber", "part").collect():
        found[order].append((line, part % 7, part))
    assert len(found[5]) == n + 10 and len(found) == 30
    for of_order in found.values():
        assert [line for line, _, _ in sorted(of_order)] == list(range(1, len(of_order) + 1))
        given = [row[1:] for row in sorted(of_order)]
        assert given == sorted(given)
    ids = bindings.appointments(spark, str(tmp_path)).select("appointment_id")
    assert ids.count() == ids.distinct().count() == n + 300
    numbered = keys.numbered_within(lines, "l_orderkey", ["l_partkey"], "n")
    spark.conf.set(coalesce, before)
    assert numbered.where("l_orderkey = 5").agg(F.max("n"), F.countDistinct("n")).first() == (n + 10, n + 10)


def test_differences_are_those_of_a_count(spark):
    import random
    from collections import Counter

    from moorage.operators import reconcile

    draw = random.Random(6)
    schema = "a int, b string, c double, d array<int>"
    row = lambda: (draw.choice([None, 1, 2]), draw.choice([None, "x", "y"]), draw.choice([None, 0.5]), draw.choice([None, [1], [None]]))
    left, right = [row() for _ in range(400)], [row() for _ in range(400)]
    frozen = lambda r: (*r[:3], None if r[3] is None else tuple(r[3]))
    wanted = Counter(map(frozen, left))
    wanted.subtract(map(frozen, right))
    frame = lambda made: spark.createDataFrame(made, schema)
    found = {frozen(r): r["surplus"] for r in reconcile.differences(frame(left), frame(right)).collect()}
    assert found == {key: n for key, n in wanted.items() if n}
    assert reconcile.differing_buckets(*[reconcile._in_buckets(frame(made)) for made in (left, left[::-1])]).count() == 0
    counts = reconcile.difference_counts(frame([*left, (9, "z", None, None)]), frame(left[::-1])).first()
    assert tuple(counts) == (1, 0, False)
    # Nulls in different columns are different rows.
    assert tuple(reconcile.difference_counts(frame([(None, "x", None, None)]), frame([(None, None, None, None)])).first()) == (1, 1, False)
    swapped = spark.createDataFrame([(None, 1)], "a int, b int"), spark.createDataFrame([(1, None)], "a int, b int")
    assert tuple(reconcile.difference_counts(*swapped).first()) == (1, 1, False)


def test_equal_tables_shuffle_no_rows(spark):
    from moorage.operators import reconcile
    from moorage.session import scratch_path

    path = scratch_path(spark, "equal")
    spark.range(50_000).selectExpr("id", "cast(id % 7 AS string) AS name").write.parquet(path)
    one, two = spark.read.parquet(path), spark.read.parquet(path).repartition(3)
    found = reconcile.differences(one, two)
    assert found.collect() == []
    # What the row comparison's exchange got, from the plan that ran.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_counts_shuffle_digests_and_hash_rows_once(spark):
    path = scratch_path(spark, "wide")
    spark.range(20_000).selectExpr("id", "repeat(cast(id AS string), 9) AS name").write.parquet(path)
    one = spark.read.parquet(path)
    two = one.withColumn("name", F.when(F.col("id") % 2 == 0, "x").otherwise(F.col("name")))
    found = reconcile.difference_counts(one, two)
    assert rows(found) == [(10_000, 10_000, False)]
    # The rows' own exchange carries hashes, no text, and no filter on nulls hashes the rows again.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = [line for line in plan.splitlines() if "Aggregate [" in line and "_check" in line]
    assert grouped and not any("name" in line for line in grouped)
    assert not any("Filter" in line and "hash" in line for line in plan.splitlines())


def test_counts_know_types_nested_nulls_and_zeros(spark):
    frame = spark.createDataFrame
    counts = lambda left, right: rows(reconcile.difference_counts(left, right))
    assert counts(frame([(1,), (2,)], "a int"), frame([(1,), (3,)], "a bigint")) == [(1, 1, False)]
    assert counts(frame([([None],), ([],)], "a array<int>"), frame([([],), ([],)], "a array<int>")) == [(1, 1, False)]
    assert counts(frame([(0.0, None), (float("nan"), 1)], "a double, b int"), frame([(-0.0, None), (float("nan"), 1)], "a double, b int")) == [
        (0, 0, True)
    ]
    folded = lambda text: frame([(text,)], "a string").select(F.collate("a", "UTF8_LCASE").alias("a"))
    assert counts(folded("A"), folded("a")) == [(0, 0, True)]
    # Copies count.
    assert counts(frame([(1, "x")] * 3, "a int, b string"), frame([(1, "x")], "a int, b string")) == [(2, 0, False)]
