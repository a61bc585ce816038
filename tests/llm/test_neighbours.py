"""The quality classifier: votes against plain cosines, held-out accuracy, odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from moorage.llm import neighbours
from moorage.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_votes_are_those_of_the_nearest():
    random = np.random.default_rng(3)
    vectors, found = (neighbours.unit(random.standard_normal((n, 6)).astype(np.float32)) for n in (40, 15))
    labels, weights = random.integers(0, 2, 40).astype(float), random.random(40) + 0.5
    model = neighbours.Model(0.7, np.eye(6, dtype=np.float32), vectors, labels, weights, voters=5, power=2.0)
    for row, score in zip(found, model.vote(found)):
        near = sorted(((max(0.0, float(np.dot(row, v))), place) for place, v in enumerate(vectors)), reverse=True)[:5]
        votes = [(cosine**2 * weights[place], labels[place]) for cosine, place in near]
        assert score == pytest.approx(sum(v * y for v, y in votes) / sum(v for v, _ in votes), abs=1e-5)


def test_terms_don_t_depend_on_the_slices():
    text = "One two two.\nOne two two.\n" * 50 + "é ### | !!"
    whole, cut = neighbours.term_counts(text), neighbours.term_counts(text, 500)
    assert whole[: neighbours.BYTES].sum() == len(text.encode()) - 2
    assert abs(whole - cut).sum() < 0.1 * whole.sum() and not neighbours.term_counts(None).any()


def test_held_out_accuracy(spark):
    found = QUERIES["op12_quality_neighbours"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    rows = found.where("held_out AND quality IS NOT NULL").select("doc_id", "quality", "predicted", "score").collect()
    assert all(zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 for row in rows) and len(rows) > 500
    right = {label: [row["predicted"] == label for row in rows if row["quality"] == label] for label in (0, 1)}
    assert np.mean(right[0]) >= 0.95 and np.mean(right[1]) >= 0.97


def test_labels_of_held_out_rows_are_never_read(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = F.expr("crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0")
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda known: neighbours.score(documents, neighbours.train(documents, known)).orderBy("doc_id").collect()
    assert score(labels) == score(other)


def test_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (3, 1), (3, 0), (5, 1), (9, 0), (10, 1), (None, 1), (8, None), (77, 0)], "doc_id long, quality int"
    )
    model = neighbours.train(odd, labels)
    rows = neighbours.score(odd, model).collect()
    assert len(rows) == odd.count()
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) and row["held_out"] is not None for row in rows)
    assert {row["score"] for row in rows if row["doc_id"] in (2, 3)} == {model.share}
    assert len({row["score"] for row in rows if row["doc_id"] == 1}) == 1
    assert neighbours.score(nothing, model).count() == 0
    for known in (labels.limit(0), labels.where("quality = 1")):
        assert {row["score"] for row in neighbours.score(odd, neighbours.train(odd, known)).collect()} <= {0.5, 1.0}
    assert neighbours.score(nothing, neighbours.train(nothing, labels.limit(0))).count() == 0
