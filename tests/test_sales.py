from datetime import date
from decimal import Decimal

import pytest
from conftest import rows
from fixtures import SALES, SALES_SCHEMA
from pyspark.sql import functions as F

from moorage.operators.quality import LoadError
from moorage.plans import sales


def frame(spark, lines=SALES):
    return spark.createDataFrame(lines, SALES_SCHEMA)


def changed(index, **fields):
    names = [part.split()[0] for part in SALES_SCHEMA.split(", ")]
    return [*SALES[:index], tuple((dict(zip(names, SALES[index])) | fields).values()), *SALES[index + 1:]]


def test_golden_numbers(spark, store):
    sales.run_star(store, frame(spark))
    now = store.read()
    assert {name: now[name].count() for name in sales.TABLES} == {
        "dim_customer": 3, "dim_product": 4, "dim_store": 2, "dim_date": 3, "fact_sales": 3,
    }
    assert rows(sales.by_month_category(now, "month_name")) == [
        (2026, "September", "Accessories", 5, Decimal("127.50")),
        (2026, "September", "Hardware", 1, Decimal("950.00")),
    ]


def test_insert_only(spark, store):
    sales.run_star(store, frame(spark))
    before = store.read()
    sales.run_star(store, frame(spark, changed(0, quantity=99, customer_city="Hull")[:1]))
    sales.run_star(store, frame(spark, changed(2, order_status="Cancelled")))
    after = store.read()
    for name in sales.TABLES:
        assert rows(before[name]) == rows(after[name])
    new = changed(0, order_id=4009, customer_id=90, order_date=date(2026, 8, 1))[:1]
    sales.run_star(store, frame(spark, new))
    assert rows(store.read()["fact_sales"].where("order_id = 4009"), "sales_key", "customer_key") == [(4, 4)]
    # Files of what is known are carried over; only a load with new rows adds a folder.
    for name in sales.TABLES:
        assert store.paths(name, 3) == store.paths(name, 1)
    assert store.paths("dim_customer", 4)[:-1] == store.paths("dim_customer", 1)
    assert store.paths("dim_store", 4) == store.paths("dim_store", 1)
    assert store.paths("fact_sales", 3) == store.paths("fact_sales", 1)
    assert store.paths("fact_sales", 4)[:-1] == store.paths("fact_sales", 1)


@pytest.mark.parametrize("fields, code", [({"quantity": -3}, 547), ({"unit_price": Decimal("-1.00")}, 547), ({"store_name": None}, 515)])
def test_rows_outside_the_contract_are_refused(spark, store, fields, code):
    sales.run_star(store, frame(spark))
    sold = next(i for i, row in enumerate(SALES) if "Completed" in row)
    fresh = [(r[0] + 100, *r[1:]) for r in changed(sold, **fields)]
    for load in (lambda rows: sales.run_star(store, rows), lambda rows: sales.run_rebuild(store, rows.withColumn("order_date", F.col("order_date").cast("string")))):
        with pytest.raises(LoadError) as refused:
            load(frame(spark, fresh))
        assert refused.value.code == code
    assert store.version() == 1


def test_known_ids_cannot_conflict_but_new_ones_can(spark, store):
    sales.run_star(store, frame(spark))
    sales.run_star(store, frame(spark, changed(0, customer_city="Hull")))
    fresh = [(r[0] + 100, r[1], r[2] + 100, *r[3:]) for r in changed(0, customer_city="Hull")]
    with pytest.raises(LoadError):
        sales.run_star(store, frame(spark, fresh))
    assert store.version() == 2


def test_rebuild_matches_a_first_load(spark, store):
    as_text = frame(spark).withColumn("order_date", F.col("order_date").cast("string"))
    sales.run_rebuild(store, as_text)
    sales.run_rebuild(store, as_text.where("order_id <> 4001"))
    now = store.read(1)
    assert rows(sales.by_month_category(now, "calendar_month"))[0] == (2026, 9, "Accessories", 5, Decimal("127.50"))
    assert rows(now["dim_date"], "date_key", "calendar_year", "calendar_month")[0] == (20260901, 2026, 9)
    assert store.read(2)["fact_sales"].count() == 1


def test_repeated_order_line_is_refused(spark, store):
    with pytest.raises(LoadError):
        sales.run_star(store, frame(spark, [*SALES, SALES[0]]))


@pytest.mark.parametrize("load", ["star", "rebuild"])
def test_extract_is_read_twice(spark, store, load):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = frame(spark)
    if load == "rebuild":
        given = given.withColumn("order_date", F.col("order_date").cast("string"))
    extract = given.mapInArrow(counted, given.schema)
    (sales.run_star if load == "star" else sales.run_rebuild)(store, extract)
    assert seen.value == 2 * len(SALES) and store.version() == 1


def test_refusal_names_every_broken_rule(spark, store):
    lines = changed(0, store_name=None, customer_name=None)
    with pytest.raises(LoadError, match="1 x customer_name_required, e.g. 4001; 1 x store_name_required, e.g. 4001"):
        sales.run_star(store, frame(spark, lines))
