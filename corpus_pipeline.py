"""A training corpus from ``documents``: each stage works on all that its predecessor kept.

Defined results: a null text counts as an empty one in every stage, scores as one, has no words and shares its fingerprint
with other empty ones; null ids, languages and sources are carried along, a null source being one of its own. Rows with equal
texts, repeated rows included, are one group of copies, of which the row with the smallest id stays. Very long texts are read
whole. Columns of other names, also those that a stage uses itself, pass through all stages but the last. An empty
``documents`` gives an empty result; without toxic labels no document is rejected, without benchmark items none is contaminated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moorage.llm import decontam, kd_shards, mixing, simhash, toxicity
from moorage.llm.common import table
from moorage.llm.queries import shard_digest
from moorage.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labels of these documents, doesn't reject."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: three-word shingles, three bits."""
    return simhash.keep_one(docs, width=3, bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in benchmark passages."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    return mixing.blend(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in 40 shards of near equal bytes."""
    return shard_digest(kd_shards.shard(docs, 40))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Toxicity scores and fingerprints can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
