"""Each stage of the pipeline against brute force on its own input."""

from collections import Counter

import pytest
from llm.test_near_copies import plain_components, plain_fingerprint
from llm.test_text_operators import plain_words
from pyspark.sql import functions as F

import corpus_pipeline
from moorage.llm import mixing, toxicity

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, documents):
    """Input and output of each stage, as rows."""
    docs, found = documents, {}
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SMALL)
        if place < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == documents.columns
            made = made.cache()
        found[name] = (docs.collect(), made.collect())
        docs = made
    return found


def test_toxic_documents_go(spark, stages, documents):
    before, after = stages["toxicity"]
    scored = toxicity.score(documents, toxicity.train(documents, spark.read.parquet(f"{SMALL}/labels.parquet")))
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in scored.where("predicted = 0").collect()}
    assert len(after) > 0.7 * len(before)


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash"]
    before = sorted(before)
    roots = plain_components([plain_fingerprint(r["text"]) for r in before])
    assert sorted(after) == [before[i] for i in sorted(set(roots))]


def test_contaminated_documents_go(spark, stages):
    before, after = stages["decontamination"]
    grams = set()
    for item in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect():
        words = plain_words(item["text"])
        grams |= {tuple(words[i : i + 13]) for i in range(max(1, len(words) - 12))} if words else set()
    kept = []
    for row in before:
        words = plain_words(row["text"])
        hit = {p for i in range(len(words)) if tuple(words[i : i + 13]) in grams for p in range(i, i + 13)}
        if not hit or 20 * len(hit) < len(words):
            kept.append(row)
    assert sorted(after) == sorted(kept)


def test_mix_repeats_documents(spark, stages):
    before, after = stages["mixing"]
    docs = spark.createDataFrame(before)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).where("copies > 0").collect()}
    assert Counter(r["doc_id"] for r in after) == Counter(copies)


def test_every_document_has_a_place(stages):
    before, after = stages["sharding"]
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before)
    places = Counter((r["shard"], r["slot"]) for r in after)
    assert set(places.values()) == {1}
    for shard, n in Counter(r["shard"] for r in after).items():
        assert all((shard, slot) in places for slot in range(n))


def test_run_on_odd_tables(spark, odd, nothing, folder):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    path = folder(
        spark, docs, labels=spark.createDataFrame([(1, 1, 0), (None, 1, 1), (8, 0, None)], "doc_id long, quality int, toxic int"),
        benchmark=spark.createDataFrame([(1, None), (2, "quick brown")], "item_id long, text string"),
    )
    found = corpus_pipeline.run(spark, path)
    assert found.where(F.col("shard").between(0, 39)).count() == found.count() > 0
