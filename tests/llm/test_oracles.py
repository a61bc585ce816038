"""Queries with SQL: on the small tables and on odd rows."""

import hashlib
from collections import Counter

import duckdb
import pytest
from compare import compare, duck
from pyspark.sql import functions as F

from moorage.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def same(found):
    return not found[1].replace(" type of target: double/DOUBLE", "")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_small_tables(spark, name, documents):
    found = compare(QUERIES[name](spark, SMALL), ORACLES[name], duck(SMALL))
    assert same(found), found[1]
    assert found[0] == documents.count() or name == "op13_ranked_search"


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, name, odd, nothing, folder, empty):
    items = spark.createDataFrame(
        [(1, "the quick brown fox"), (2, None), (3, ""), (None, "MIT license"), (1, "È word"), (7, " ".join(f"word{i}" for i in range(13)))],
        "item_id long, text string",
    )
    # The SQL copies a list of words per window, so the longest text is cut down for it.
    given = nothing if empty else odd.withColumn("text", F.substring("text", 1, 9000))
    path = folder(spark, given, benchmark=items)
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet/*.parquet'")
    found = compare(QUERIES[name](spark, path), ORACLES[name], connection)
    assert same(found), found[1]
    assert found[0] == (0 if empty else odd.count()) or name == "op13_ranked_search"


def test_very_long_texts_against_plain_python(spark, odd, folder):
    """The text of 40,000 words that the SQL gets cut."""
    words = odd.where("doc_id = 5").first()["text"].split()
    window = words[20_000:20_013]
    items = spark.createDataFrame([(4, " ".join(window)), (9, "never there")], "item_id long, text string")
    path = folder(spark, odd, benchmark=items)
    rows = {name: [row for row in QUERIES[name](spark, path).collect() if row["doc_id"] in (5, 6)] for name in ("op1_mix_sources", "op4_quality_ledger", "op6_decontaminate")}
    assert {row["size"] for row in rows["op1_mix_sources"]} == {len(words)} and len(rows["op1_mix_sources"]) == 2
    triples = Counter(zip(words, words[1:], words[2:]))
    repeated = {place + k for place, triple in enumerate(zip(words, words[1:], words[2:])) if triples[triple] > 1 for k in range(3)}
    for row in rows["op4_quality_ledger"]:
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (
            len(words), sum(map(len, words)), 0, 0, len(repeated)
        )
    folded = [word.lower() for word in words]
    hit = {
        place + k for place in range(len(words) - 12) if folded[place : place + 13] == [w.lower() for w in window] for k in range(13)
    }
    digest = hashlib.sha256(b"4").hexdigest()
    for row in rows["op6_decontaminate"]:
        assert (row["n_words"], row["n_hit"], row["n_items"], row["items_sha256"]) == (len(words), len(hit), 1, digest)
