"""Clean-up of a store, and what an insert-only load reads of known facts."""

import pytest
from conftest import rows
from fixtures import SALES, SALES_SCHEMA

from moorage.operators import quality
from moorage.operators.joins import unseen, within
from moorage.plans import sales
from moorage.sources.store import SnapshotStore


def table(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value int")


def test_sweep_keeps_what_is_needed(spark, store):
    store.publish({"a": table(spark, 1), "b": table(spark, 1)}, 0)
    store.publish({"a": table(spark, 2)}, 1)
    store.publish({"a": table(spark, 3)}, 2)
    abandoned, kept = store.draft(), store.draft()
    abandoned.put("a", table(spark, 9))
    kept.put("a", table(spark, 4))
    reader = store.read(2)
    # Within the grace time nothing goes: version 2 is being read, both drafts may be in the making.
    assert store.sweep(keep=1) == [] and rows(reader["a"]) == [(2,)]
    assert kept.publish() == 4
    gone = store.sweep(keep=2, grace=-5)
    assert [place for place in gone if place.startswith("manifests")] == ["manifests/000000001.json", "manifests/000000002.json"]
    assert len(gone) == 4  # and the folders of version 2 and of the abandoned draft
    # Table b is still that of version 1, whose folder stays for it.
    assert {version: (rows(store.read(version)["a"]), rows(store.read(version)["b"])) for version in (3, 4)} == {
        3: ([(3,)], [(1,)]), 4: ([(4,)], [(1,)])
    }
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST|No such file"):
        reader["a"].collect()
    assert store.sweep(keep=2, grace=-5) == []
    assert SnapshotStore(spark, store.root).version() == 4


def test_sweep_of_staging_folders_and_broken_publishes(spark, store):
    table(spark, 1).write.parquet(f"{store.root}/stage/run-1")
    store._files.create(store._path(f"{store.root}/manifests/x.draft"), False).close()
    store.publish({"a": table(spark, 1)}, 0)
    assert store.sweep() == []
    assert store.sweep(grace=-5) == ["manifests/x.draft", "stage/run-1"]
    assert rows(store.read()["a"]) == [(1,)]


def test_parts_are_swept_folder_by_folder(spark, store):
    from test_facts import merge

    merge(spark, store, [(1, 20260105, 10), (2, 20260220, 20)])
    merge(spark, store, [(2, 20260221, 21)])
    store.sweep(keep=1, grace=-5)
    assert rows(store.read()["fact"]) == [(1, 1, 20260105, 10), (2, 2, 20260221, 21)]
    merge(spark, store, [(1, 20260106, 11), (3, 20260301, 30)])
    assert rows(store.read()["fact"]) == [(1, 1, 20260106, 11), (2, 2, 20260221, 21), (3, 3, 20260301, 30)]


def test_known_facts_are_read_between_the_batch_s_bounds(spark, store):
    sales.run_star(store, spark.createDataFrame(SALES, SALES_SCHEMA))
    known = store.read()["fact_sales"]
    batch = spark.createDataFrame([(4002, 1), (4003, 1)], "order_id bigint, line_number int")
    watch = quality.Watch(batch, [], "order_id")
    watch.rows.collect()
    assert watch.bounds == (4002, 4003)
    left = unseen(batch, within(known, "order_id", watch.bounds), ["order_id", "line_number"])
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_id,4002)" in plan and "LessThanOrEqual(order_id,4003)" in plan
    assert rows(left) == rows(unseen(batch, known, ["order_id", "line_number"]))
    assert within(known, "order_id", None).count() == 0


def test_highest_key_comes_from_the_manifest(spark, store):
    sales.run_star(store, spark.createDataFrame(SALES, SALES_SCHEMA))
    assert store.draft().top_key("fact_sales") == 3
    later = [(4900 + i, *row[1:]) for i, row in enumerate(SALES)]
    sales.run_star(store, spark.createDataFrame(later, SALES_SCHEMA))
    assert store.draft().top_key("fact_sales") == store.read()["fact_sales"].count() == 6
    assert sorted(row[0] for row in store.read()["fact_sales"].select("sales_key").collect()) == list(range(1, 7))
