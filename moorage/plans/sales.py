"""Sales loads: the insert-only star and the full rebuild from text dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorage.functions import scalars as S
from moorage.operators import dims, facts, quality
from moorage.operators.joins import counted_join as lookup_join
from moorage.operators.joins import unseen, within
from moorage.operators.keys import allocate
from moorage.session import materialise
from moorage.sources.store import SnapshotStore

LOAD = "sales"
COMPLETED = "Completed"
CUSTOMER = ["customer_name", "customer_city", "country_code"]
PRODUCT = ["product_name", "category_name"]
STORE = ["store_name", "store_city"]
MESSAGES = quality.CONTRACT_MESSAGES | {1: "Conflicting attributes for a dimension key", 2: "Repeated order line"}
NEEDED = [
    "order_id", "line_number", "customer_id", *CUSTOMER, "product_id", *PRODUCT, "store_id", *STORE, "order_date",
    "order_status", "quantity", "unit_price",
]
# Longest texts of the staged table.
LENGTHS = {
    "customer_name": 100, "customer_city": 80, "country_code": 2, "product_name": 100, "category_name": 80,
    "store_name": 100, "store_city": 80, "order_status": 20,
}
_DIMS = {
    "dim_customer": "customer_key bigint, customer_id bigint, customer_name string, customer_city string, "
    "country_code string",
    "dim_product": "product_key bigint, product_id bigint, product_name string, category_name string",
    "dim_store": "store_key bigint, store_id bigint, store_name string, store_city string",
}
_FACT = (
    "sales_key bigint, order_id bigint, line_number int, date_key int, customer_key bigint, product_key bigint, "
    "store_key bigint, quantity int, unit_price decimal(12,2), sales_amount decimal(14,2)"
)
TABLES = _DIMS | {
    "dim_date": "date_key int, calendar_date date, calendar_year smallint, calendar_month smallint, month_name string",
    "fact_sales": _FACT,
}


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in TABLES.items()}


def extract(order: DataFrame, line: DataFrame, customer: DataFrame, product: DataFrame, store: DataFrame) -> DataFrame:
    """Order lines with their order, customer, product and store.

    The line side is large and may lean on few orders, products or stores, so
    each join is a lookup. Customers join their orders, so that lines aren't
    shuffled for them, and the widest columns join last.
    """
    ordered = lookup_join(order, customer, "customer_id")
    rows = line
    for lookup, key in ((product, "product_id"), (store, "store_id"), (ordered, "order_id")):
        rows = lookup_join(rows, lookup, key)
    return rows.select(
        "order_id", "line_number", "customer_id", *CUSTOMER, "product_id", *PRODUCT, "store_id", *STORE,
        "order_date", "order_status", "quantity", "unit_price",
    )


#: What each dimension takes from the extract: its natural key and its attributes.
DIMENSIONS = {
    "dim_customer": ("customer_id", CUSTOMER, "customer_key", "customer_conflict"),
    "dim_product": ("product_id", PRODUCT, "product_key", "product_conflict"),
    "dim_store": ("store_id", STORE, "store_key", "store_conflict"),
}


def _conflicts(sources: dict[str, DataFrame], now: dict[str, DataFrame] | None) -> DataFrame:
    """Ids that come with several attributes; an id that a dimension knows is not inserted and can't conflict."""
    incoming = lambda table, key: sources[table] if now is None else unseen(sources[table], now[table], key)
    return quality.all_of(
        [
            quality.conflicting_attributes(incoming(table, key), key, attributes, rule, 1)
            for table, (key, attributes, _, rule) in DIMENSIONS.items()
        ]
    )


def extract_report(rows: DataFrame, now: dict[str, DataFrame] | None = None) -> DataFrame:
    """The unique constraints of the target tables as checks on the rows that would be inserted.

    With the current tables given, rows that they already know are not
    inserted and so cannot conflict.
    """
    lines = rows.where(F.col("order_status") == COMPLETED)
    if now is not None:
        lines = unseen(lines, now["fact_sales"], ["order_id", "line_number"])
    return quality.all_of([_conflicts(dict.fromkeys(DIMENSIONS, rows), now), _repeated_lines(lines)])


def _repeated_lines(lines: DataFrame) -> DataFrame:
    return quality.duplicate_key(lines, ["order_id", "line_number"], "order_line", 2)


def row_rules() -> list[quality.Rule]:
    """Required columns and text lengths of the extract, and the ranges of what becomes a fact."""
    sold = F.col("order_status") == COMPLETED
    checks = (
        quality.Rule("quantity_positive", quality.CHECK, sold & ~(F.col("quantity") > 0)),
        quality.Rule("price_not_negative", quality.CHECK, sold & ~(F.col("unit_price") >= 0)),
    )
    return quality.contract_rules(NEEDED, LENGTHS, checks)


def dimension_sources(rows: DataFrame, now: dict[str, DataFrame] | None) -> tuple[dict[str, DataFrame], tuple | None]:
    """The distinct rows of every dimension, and the days, from one read of the extract that checks its rows too.

    Also the bounds of its order ids. Refuses rows that break the contract, and ids with conflicting attributes.
    """
    quality.same_columns(LOAD, rows, NEEDED)
    columns = {table: [key, *attributes] for table, (key, attributes, _, _) in DIMENSIONS.items()} | {"dim_date": ["order_date"]}
    watch = quality.Watch(rows, row_rules(), "order_id")
    stacked = materialise(dims.stacked(watch.rows, columns), "sales-dimensions")
    watch.gate(LOAD, MESSAGES)
    sources = {table: stacked.where(F.col("_dim") == table).select(*own) for table, own in columns.items()}
    quality.gate(_conflicts(sources, now), LOAD, MESSAGES)
    return sources, watch.bounds


def fact_rows(rows: DataFrame, tables: dict[str, DataFrame], day: str = "order_date") -> DataFrame:
    """Completed lines with their dimension keys and amount."""
    keyed = facts.with_dimension_keys(
        rows.where(F.col("order_status") == COMPLETED).withColumnRenamed(day, "calendar_date"),
        [
            facts.Lookup(tables["dim_date"], "calendar_date", "date_key"),
            facts.Lookup(tables["dim_customer"], "customer_id", "customer_key"),
            facts.Lookup(tables["dim_product"], "product_id", "product_key"),
            facts.Lookup(tables["dim_store"], "store_id", "store_key"),
        ],
        lookup_join,
    )
    return facts.with_amount(keyed).select(
        "order_id", "line_number", "date_key", "customer_key", "product_key", "store_key",
        "quantity", "unit_price", "sales_amount",
    )


def run_star(store: SnapshotStore, rows: DataFrame) -> int:
    """Insert-only load: known dimension rows and facts stay as they are. ``rows`` is read twice."""
    draft = store.draft()
    now = store.read(draft.base) or empty(store.spark)
    sources, orders = dimension_sources(rows, now)
    loads = {"dim_date": lambda: (dims.new_dates_named(now["dim_date"], sources["dim_date"], "order_date"), None)}
    for table, (natural_key, attributes, key, _) in DIMENSIONS.items():
        loads[table] = lambda table=table, natural_key=natural_key, attributes=attributes, key=key: dims.new_members(
            now[table], sources[table], natural_key, attributes, key, draft.top_key(table)
        )
    new = draft.append_all(loads)
    # Written down once: numbering reads its rows twice, and the lookups behind them needn't run again.
    known = within(now["fact_sales"], "order_id", orders)
    sold = materialise(unseen(fact_rows(rows, new), known, ["order_id", "line_number"]), "sales-facts")
    quality.gate(_repeated_lines(sold), LOAD, MESSAGES)
    # The store notes the highest key in use, so the facts needn't be read for it.
    top = draft.top_key("fact_sales")
    numbered, top = allocate(sold, ["order_id", "line_number"], "sales_key", now["fact_sales"] if top is None else top)
    draft.append("fact_sales", numbered.select(*now["fact_sales"].columns), top)
    return draft.publish()


def run_rebuild(store: SnapshotStore, rows: DataFrame) -> int:
    """Full rebuild; ``order_date`` is ISO text and keys start at one again. ``rows`` is read twice."""
    sources, _ = dimension_sources(rows, None)
    no_dates = store.spark.createDataFrame(
        [], "date_key int, calendar_date string, calendar_year int, calendar_month int"
    )
    draft = store.draft()
    loads = {"dim_date": lambda: dims.load_dates_text(no_dates, sources["dim_date"], "order_date")}
    for table, (natural_key, attributes, key, _) in DIMENSIONS.items():
        loads[table] = lambda table=table, natural_key=natural_key, attributes=attributes, key=key: dims.rebuild(
            sources[table], natural_key, attributes, key
        )
    new = draft.put_all(loads)
    sold = materialise(fact_rows(rows, new), "sales-facts")
    quality.gate(_repeated_lines(sold), LOAD, MESSAGES)
    draft.put("fact_sales", facts.rebuild(sold, ["order_id", "line_number"], "sales_key"))
    return draft.publish()


def by_month_category(tables: dict[str, DataFrame], month: str) -> DataFrame:
    """Units and revenue per year, month and category, ordered by them.

    Facts combine per date and product before they meet the dimensions.
    """
    grouped = tables["fact_sales"].groupBy("date_key", "product_key").agg(
        F.sum("quantity").alias("units"), F.sum(S.money(F.col("sales_amount"))).alias("amount")
    )
    dated = lookup_join(grouped, tables["dim_date"].select("date_key", "calendar_year", month), "date_key")
    joined = lookup_join(dated, tables["dim_product"].select("product_key", "category_name"), "product_key")
    return (
        joined.groupBy("calendar_year", month, "category_name")
        .agg(F.sum("units").cast("bigint").alias("units_sold"), S.money(F.sum("amount")).alias("revenue"))
        .orderBy("calendar_year", month, "category_name")
    )
