"""The loads' source tables, read from the given benchmark tables.

Each Spark reader has its SQL twin for the oracle beside it. All of them read
whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators.joins import attach_children, counted_join, lookup_join
from moorage.operators.keys import large_groups, numbered_within, parts_of
from moorage.sources.tables import scan

# ---------------------------------------------------------------- encounters


def patients(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])
    return rows.select(
        F.col("c_custkey").alias("patient_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("given_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("family_name"),
        F.date_add(F.lit("1940-01-01").cast("date"), (F.col("c_custkey") % 18000).cast("int")).alias("birth_date"),
        F.col("c_mktsegment").alias("city"),
        F.when(F.col("c_acctbal") >= 0, F.lower("c_name")).alias("email"),
    )


PATIENT_SQL = """SELECT c_custkey AS patient_id, split_part(c_name, '#', 1) AS given_name,
  split_part(c_name, '#', 2) AS family_name, DATE '1940-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
  c_mktsegment AS city, CASE WHEN c_acctbal >= 0 THEN lower(c_name) END AS email, c_nationkey FROM customer"""


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice"])
    return rows.select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("o_orderdate").cast("date").alias("encounter_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("department_id"),
        F.expr("substring(o_orderpriority, 3)").alias("department_name"),
        S.money(F.col("o_totalprice"), 12).alias("cost"),
    )


ENCOUNTER_SQL = """SELECT o_orderkey AS encounter_id, o_custkey AS patient_id,
  CAST(o_orderdate AS DATE) AS encounter_date, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS department_id,
  substr(o_orderpriority, 3) AS department_name, CAST(o_totalprice AS DECIMAL(12,2)) AS cost FROM orders"""


def encounter_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Every patient with their encounters; a patient without one has NULLs."""
    return attach_children(patients(spark, folder).drop("email"), encounters(spark, folder), "patient_id")


CARE_SQL = f"""patient AS ({PATIENT_SQL}), encounter AS ({ENCOUNTER_SQL}),
extract AS (SELECT p.patient_id, given_name, family_name, birth_date, city, encounter_id, encounter_date,
  department_id, department_name, cost FROM patient p LEFT JOIN encounter e ON e.patient_id = p.patient_id)"""

# -------------------------------------------------------------- appointments


#: Ids of an order's lines up to this number are the order's key times this, plus the line.
LINE_ROOM = 10_000


def order_lines(
    spark: SparkSession, folder: str, described: DataFrame | None = None, large: list | None = None, parts: int | None = None
) -> DataFrame:
    """Every given line, numbered from one within its order; the given numbers repeat and only set the order.

    Columns of ``described``, unique on ``part``, are added before the numbering deals the lines by order, so that
    they can be grouped by order without another shuffle. ``large`` as of `numbered_within`; without large orders the
    lines are dealt to ``parts`` tasks, by default to the session's number or as many as they need.
    """
    columns = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"]
    rows = scan(spark, folder, "lineitem", ["l_orderkey", *columns])
    large = large_groups(rows, "l_orderkey") if large is None else large
    added = []
    if described is not None:
        added = [name for name in described.columns if name != "part"]
        rows = lookup_join(rows, described.withColumnRenamed("part", "l_partkey"), "l_partkey", "left")
    if parts is None and (enough := parts_of(scan(spark, folder, "lineitem", ["l_orderkey"]))) > int(spark.conf.get("spark.sql.shuffle.partitions")):
        parts = enough
    if parts and not large:
        rows = rows.repartition(parts, "l_orderkey")
    return numbered_within(rows, "l_orderkey", columns, "_number", large).select(
        "l_orderkey", F.col("_number").cast("int").alias("l_linenumber"), F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"), F.col("l_quantity").cast("int").alias("quantity"),
        S.money(F.col("l_extendedprice"), 12).alias("price"), F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").alias("shipped"), *added,
    )


def appointment_id(order: Column, line: Column) -> Column:
    """One bigint per order and line, the same in every extract and never shared.

    Lines from ``LINE_ROOM`` on get negative ids: key and line side by side, the
    line in six, eight or ten digits, and a last digit that says which. Ids
    past 64 bits raise an error.
    """
    order, line = order.cast("bigint"), line.cast("bigint")
    wide = lambda digits, mark: F.negative((order * F.lit(10**digits) + line) * 10 + mark)
    return (
        F.when(line < LINE_ROOM, order * LINE_ROOM + line)
        .when(line < 10**6, wide(6, 1)).when(line < 10**8, wide(8, 2)).otherwise(wide(10, 3))
    )


LINE_SQL = """SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
    l_quantity, l_extendedprice, l_returnflag, l_shipdate) AS INTEGER) AS l_linenumber, l_partkey AS part, l_suppkey AS supplier,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, l_returnflag AS flag,
  l_shipdate AS shipped FROM lineitem"""


def _status() -> Column:
    return (
        F.when(F.col("flag") == "A", "Completed")
        .when(F.col("flag") == "N", "Scheduled")
        .when(F.col("shipped") <= F.col("o_orderdate"), "NoShow")
        .otherwise("Cancelled")
    )


def appointments(spark: SparkSession, folder: str, raw_end: bool = False) -> DataFrame:
    """One appointment per order line; ``raw_end`` takes the ship date as the end, often before the start."""
    orders = scan(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    rows = order_lines(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey")
    starts = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    ends = F.col("shipped") if raw_end else starts + F.make_dt_interval(F.lit(0), F.lit(0), F.col("quantity"))
    return lookup_join(rows, orders, "o_orderkey").select(
        appointment_id(F.col("o_orderkey"), F.col("l_linenumber")).alias("appointment_id"),
        F.col("o_custkey").alias("patient_id"),
        F.col("supplier").alias("doctor_id"),
        starts.alias("starts_at"),
        ends.alias("ends_at"),
        _status().alias("status"),
        F.concat(F.lit("Part "), F.col("part")).alias("reason"),
        F.col("price").cast("decimal(10,2)").alias("cost"),
    )


def appointment_sql(raw_end: bool = False) -> str:
    starts = "o_orderdate + to_hours(l_linenumber)"
    ends = "shipped" if raw_end else f"{starts} + to_minutes(quantity)"
    return f"""SELECT o_orderkey * {LINE_ROOM} + l_linenumber AS appointment_id, o_custkey AS patient_id, supplier AS doctor_id,
  {starts} AS starts_at, {ends} AS ends_at, CASE WHEN flag = 'A' THEN 'Completed' WHEN flag = 'N' THEN 'Scheduled'
  WHEN shipped <= o_orderdate THEN 'NoShow' ELSE 'Cancelled' END AS status, 'Part ' || part AS reason,
  CAST(price AS DECIMAL(10,2)) AS cost FROM line JOIN orders ON o_orderkey = l_orderkey"""


def doctors(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    nation = scan(spark, folder, "nation", ["n_nationkey", "n_name"]).withColumnRenamed("n_nationkey", "s_nationkey")
    return lookup_join(rows, nation, "s_nationkey").select(
        F.col("s_suppkey").alias("doctor_id"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("given_name"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("family_name"),
        F.col("n_name").alias("specialty"),
        F.lower("s_name").alias("email"),
        (F.col("s_acctbal") >= 0).alias("is_active"),
    )


DOCTOR_SQL = """SELECT s_suppkey AS doctor_id, split_part(s_name, '#', 1) AS given_name,
  split_part(s_name, '#', 2) AS family_name, n_name AS specialty, lower(s_name) AS email,
  s_acctbal >= 0 AS is_active, s_nationkey FROM supplier JOIN nation ON n_nationkey = s_nationkey"""
APPT_SQL = f"""patient AS ({PATIENT_SQL}), doctor AS ({DOCTOR_SQL}), line AS ({LINE_SQL}),
appointment AS ({appointment_sql()})"""

# --------------------------------------------------------------------- sales


def sales_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    nation = scan(spark, folder, "nation", ["n_nationkey", "n_name"])
    supplier = scan(spark, folder, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    prices = scan(spark, folder, "part", ["p_partkey", "p_retailprice"]).withColumnRenamed("p_partkey", "part")
    status = F.col("o_orderstatus")
    return {
        "customer": scan(spark, folder, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_city"),
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("country_code"),
        ),
        "product": scan(spark, folder, "part", ["p_partkey", "p_name", "p_type"]).toDF(
            "product_id", "product_name", "category_name"
        ),
        "store": counted_join(supplier, nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").select(
            F.col("s_suppkey").alias("store_id"), F.col("s_name").alias("store_name"), F.col("n_name").alias("store_city")
        ),
        "order": scan(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"]).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.when(status == "F", "Completed").when(status == "O", "Open").otherwise("Pending").alias("order_status"),
        ),
        "line": counted_join(order_lines(spark, folder), prices, "part").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number"),
            F.col("part").alias("product_id"), F.col("supplier").alias("store_id"), "quantity",
            S.money(F.col("p_retailprice"), 12).alias("unit_price"),
        ),
    }


SALES_SQL = f"""line AS ({LINE_SQL}),
extract AS (SELECT o_orderkey AS order_id, l_linenumber AS line_number, c_custkey AS customer_id,
  c_name AS customer_name, c_mktsegment AS customer_city, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS country_code,
  p_partkey AS product_id, p_name AS product_name, p_type AS category_name, s_suppkey AS store_id,
  s_name AS store_name, n_name AS store_city, CAST(o_orderdate AS DATE) AS order_date,
  CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Open' ELSE 'Pending' END AS order_status,
  quantity, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, c_nationkey
  FROM line JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
  JOIN part ON p_partkey = line.part JOIN supplier ON s_suppkey = line.supplier
  JOIN nation ON n_nationkey = s_nationkey)"""

# --------------------------------------------------------------------- audit


def audit_rows(spark: SparkSession, folder: str) -> DataFrame:
    """One audit row per order day and status, three of a day loaded at the same time."""
    rows = scan(spark, folder, "orders", ["o_orderdate", "o_orderstatus", "o_totalprice"])
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return rows.groupBy(
        F.concat(F.lit("run-"), day, F.lit("-"), F.col("o_orderstatus")).alias("run_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(6), F.lit(30), F.lit(45))).alias("loaded_at"),
    ).agg(F.count("*").alias("appointment_rows"), S.total(F.col("o_totalprice")).alias("amount"))


AUDIT_SQL = """audit AS (SELECT 'run-' || strftime(o_orderdate, '%Y%m%d') || '-' || o_orderstatus AS run_id,
  o_orderdate + INTERVAL '6 hours 30 minutes 45 seconds' AS loaded_at, count(*) AS appointment_rows,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount FROM orders GROUP BY ALL)"""
