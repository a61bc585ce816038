"""The captured logs over small tables: bounded documents, empty orders, unknown parts."""

import duckdb
import pytest
from compare import rows_of
from pyspark.sql import functions as F

import given_logs
from moorage.catalog import ORACLES, QUERIES
from moorage.session import scratch_path

LINES = 3 * given_logs.PAGE + 2


@pytest.fixture(scope="module")
def folder(spark):
    """Order 1 has many lines, order 2 one, order 3 none, order 4 only a line of an unknown part."""
    path = scratch_path(spark, "small")
    lines = [(1, part % 5, 7, 1, float(1 + part % 50), 10.5 + part, "ANR"[part % 3]) for part in range(LINES)]
    lines += [(2, 3, 7, 1, 50.0, 99.0, "R"), (4, 77, 7, 1, 5.0, 1.0, "A")]
    tables = {
        "customer": spark.createDataFrame(
            [(1, "One", 2, 10.0, "HOUSEHOLD"), (2, "Two", 9, -950.0, "MACHINERY")],
            "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string",
        ),
        "part": spark.createDataFrame(
            [(n, f"part {n}", f"Brand#{n}", ["ECONOMY", "PROMO"][n % 2], 10 * n, 900.0) for n in range(5)],
            "p_partkey bigint, p_name string, p_brand string, p_type string, p_size bigint, p_retailprice double",
        ),
        "orders": spark.createDataFrame(
            [(1, 1, "F", "3-MEDIUM"), (2, 2, "O", "2-HIGH"), (3, 1, "P", "5-LOW"), (4, 1, "O", "1-URGENT")],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
        ).selectExpr("*", "100.0D AS o_totalprice", "TIMESTAMP_NTZ '1996-01-01 00:00:00' AS o_orderdate"),
        "lineitem": spark.createDataFrame(
            lines,
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double,"
            "l_returnflag string",
        ).selectExpr("*", "TIMESTAMP_NTZ '1996-02-01 00:00:00' AS l_shipdate"),
    }
    for name, frame in tables.items():
        frame.coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def oracle(folder):
    connection = duckdb.connect()
    for name in ("customer", "part", "orders", "lineitem"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return connection


def test_large_orders_have_many_bounded_runs(spark, folder):
    found = {row["run_id"]: row["n_lines"] for row in given_logs.runs(spark, folder).collect()}
    assert found == {"1-0": 8, "1-1": 8, "1-2": 8, "1-3": 2, "2-0": 1, "3-0": 0, "4-0": 0}


def test_every_line_is_one_offer(spark, folder):
    offers = QUERIES["flatten_offers"](spark, folder)
    assert offers.where("run_id LIKE '1-%'").count() == LINES
    assert offers.where("run_id = '1-3'").agg(F.sum("amount")).first()[0] == sum(10.5 + n for n in range(LINES)) - sum(
        row[0] for row in offers.where("run_id IN ('1-0', '1-1', '1-2')").select(F.col("amount").cast("double")).collect()
    )


NAMES = sorted(name for name, sql in ORACLES.items() if sql.startswith(f"WITH {given_logs.FLAT_SQL}"))


def test_the_answers_name_no_document():
    assert len(NAMES) > 40
    assert not [name for name in NAMES if "%" in ORACLES[name]]


@pytest.mark.parametrize("name", NAMES)
def test_answer(spark, folder, oracle, name):
    frame = QUERIES[name](spark, folder)
    found = oracle.execute(ORACLES[name])
    names = [entry[0] for entry in found.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, found.fetchall())


def test_a_log_of_one_step_is_projected_and_holds_the_rows_of_the_whole_log(spark, folder):
    whole = given_logs.api_log(spark, folder)
    for step in ("shopping", "payment"):
        one = given_logs.api_log(spark, folder, [step])
        assert "Generate" not in one._jdf.queryExecution().executedPlan().toString() and one.columns == whole.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, whole.where(F.col("step") == step).collect()))
