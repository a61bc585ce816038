"""Facts kept in months: what a merge touches, and what it leaves alone."""

import glob
import random

import pytest
from conftest import rows

from moorage.operators import facts

SCHEMA = "visit_key bigint, visit_id bigint, date_key int, cost int"


def merge(spark, store, batch):
    draft = store.draft()
    frame = spark.createDataFrame(batch, "visit_id bigint, date_key int, cost int")
    months = facts.merge(draft, "fact", frame, spark.createDataFrame([], SCHEMA), "visit_id", "visit_key", facts.month_of())
    draft.publish()
    return months


def spoil(paths):
    """Make the files of some folders unreadable."""
    for path in paths:
        for name in glob.glob(f"{path}/*.parquet"):
            with open(name, "wb") as file:
                file.write(b"no table")


def test_batch_of_one_month_leaves_the_others_unread(spark, store):
    merge(spark, store, [(1, 20260105, 10), (2, 20260220, 20), (3, 20260228, 30), (4, 20260301, 40)])
    before = store.parts("fact")
    assert sorted(before) == ["202601", "202602", "202603"]
    spoil(before["202601"] + before["202603"])
    assert merge(spark, store, [(2, 20260221, 21), (9, 20260222, 90)]) == ["202602"]
    after = store.parts("fact")
    assert after["202601"] == before["202601"] and after["202603"] == before["202603"]
    assert not set(after["202602"]) & set(before["202602"])
    left = spark.read.schema(SCHEMA).parquet(*after["202602"])
    assert rows(left) == [(2, 2, 20260221, 21), (3, 3, 20260228, 30), (5, 9, 20260222, 90)]


def test_only_new_ids_rewrite_nothing(spark, store):
    merge(spark, store, [(1, 20260105, 10), (2, 20260120, 20)])
    before = store.parts("fact")["202601"]
    spoil(before)
    merge(spark, store, [(3, 20260131, 30)])
    assert store.parts("fact")["202601"][:-1] == before


def test_moved_date_leaves_its_old_month(spark, store):
    merge(spark, store, [(1, 20260105, 10), (2, 20260220, 20)])
    merge(spark, store, [(1, 20260305, 11)])
    assert sorted(store.parts("fact")) == ["202602", "202603"]
    merge(spark, store, [(1, 20260206, 12)])
    assert rows(store.read()["fact"]) == [(1, 1, 20260206, 12), (2, 2, 20260220, 20)]
    assert rows(store.read(2)["fact"]) == [(1, 1, 20260305, 11), (2, 2, 20260220, 20)]


def test_empty_batches(spark, store):
    merge(spark, store, [])
    assert store.read()["fact"].count() == 0
    merge(spark, store, [(1, 20260105, 10)])
    paths = store.paths("fact")
    assert merge(spark, store, []) == [] and store.paths("fact") == paths


def test_table_published_whole_goes_into_parts_once(spark, store):
    store.publish({"fact": spark.createDataFrame([(7, 1, 20260105, 10), (9, 2, 20260220, 20)], SCHEMA)}, 0)
    merge(spark, store, [(2, 20260221, 21), (3, 20260222, 30)])
    assert rows(store.read()["fact"]) == [(7, 1, 20260105, 10), (9, 2, 20260221, 21), (10, 3, 20260222, 30)]


def test_hidden_table_is_not_read_back(spark, store):
    merge(spark, store, [(1, 20260105, 10)])
    assert set(store.read()) == {"fact"}


@pytest.mark.parametrize("seed", [1, 2])
def test_many_merges_equal_a_dictionary(spark, store, seed):
    draw, known, top = random.Random(seed), {}, 0
    for _ in range(5):
        batch = {i: (i, 20260000 + 100 * draw.randint(1, 4) + draw.randint(1, 28), draw.randint(0, 9)) for i in draw.sample(range(30), 12)}
        merge(spark, store, list(batch.values()))
        for i in sorted(batch):
            if i not in known:
                top += 1
            known[i] = (known[i][0] if i in known else top, *batch[i])
    assert rows(store.read()["fact"]) == sorted(known.values())


def test_measures_meet_their_keys_at_the_write(spark, store, monkeypatch):
    monkeypatch.setattr(facts, "ROWS_A_CELL", 20)
    like = spark.createDataFrame([], "visit_key bigint, visit_id bigint, patient_key bigint, date_key int, note string, cost int")
    draw = random.Random(4)
    known: dict[int, tuple] = {}
    for ids in (range(0, 400, 2), range(100, 300)):
        batch = [(n, draw.randrange(9), draw.choice([20260105, 20260220, 20260301]), draw.choice([None, "a", "b"]), draw.randrange(50)) for n in ids]
        whole = spark.createDataFrame(batch, "visit_id bigint, patient_key bigint, date_key int, note string, cost int")
        draft = store.draft()
        facts.merge(
            draft, "fact", whole.select("visit_id", "patient_key", "date_key"), like, "visit_id", "visit_key", facts.month_of(),
            measures=whole.drop("patient_key"),
        )
        draft.publish()
        new = sorted(set(ids) - set(known))
        keys = {n: known[n][0] for n in known} | {n: len(known) + i + 1 for i, n in enumerate(new)}
        known |= {row[0]: (keys[row[0]], *row) for row in batch}
        frozen = {tuple(row) for row in store.read()["fact"].collect()}
        assert frozen == set(known.values()) and store.read()["fact"].count() == len(known)


def test_rows_without_a_key_are_left_out_of_the_write(spark, store):
    like = spark.createDataFrame([], SCHEMA)
    draft = store.draft()
    keyed = spark.createDataFrame([(1, 20260105)], "visit_id bigint, date_key int")
    measures = spark.createDataFrame([(1, 20260105, None), (2, 20260106, 7)], "visit_id bigint, date_key int, cost int")
    facts.merge(draft, "fact", keyed, like, "visit_id", "visit_key", facts.month_of(), measures=measures)
    draft.publish()
    assert rows(store.read()["fact"]) == [(1, 1, 20260105, None)]
