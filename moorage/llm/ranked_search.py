"""Ranked lexical search: term at a time, rarest first, with a limited set of accumulators.

The documents are an index cut by document: a task turns a block of documents into postings of the items' terms, and scores
every item over the block. An item's terms are taken rarest first. Each posting adds to its document's accumulator, and
new accumulators are made only as long as the block's greatest possible gains of the terms left add up to the ``top``-th best
score so far, found in this block or an earlier one of the task. From there on the documents that have an accumulator go on
being updated exactly, and no other can come into the result. A tie with that score can still win by its id, so only a
smaller sum stops the making. A task hands on at most ``top`` rows an item; they are merged in two levels.

The weights need counts over all documents, so the texts are read twice. Items go out in chunks of bounded size, each
against all documents.

Defined results: a null or empty text has no terms and is no document of ``N``; an item without terms, or whose terms no
document holds, has no rows. Rows are documents and items of their own, also where ids or texts repeat or are null; equal
scores rank by ascending id, null last. Whole texts count, however long; their words are taken a megabyte at a time. Other
columns are never read. Empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moorage.llm.common import PLAIN_TABLE, pieces

#: Rows of the statistics that are no terms: documents with a term, and all terms with repeats.
DOCUMENTS, TERMS = -1, -2


class Item(NamedTuple):
    name: int | None
    terms: list[int]  # rarest first


def word_lists(text: str | None, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text as `plain_words` gives them, about ``size`` bytes at a time."""
    folded = (text or "").encode().translate(PLAIN_TABLE)
    start = 0
    while start < len(folded):
        stop = folded.find(b" ", start + size)
        stop = len(folded) if stop < 0 else stop
        yield folded[start:stop].split()
        start = stop


def term_counts(text: str | None, vocabulary: dict[bytes, int]) -> tuple[int, Counter]:
    """All terms of a text, and the occurrences of those in the vocabulary."""
    number, found = 0, Counter()
    for words in word_lists(text):
        number += len(words)
        found.update([term for term in map(vocabulary.get, words) if term is not None])
    return number, found


def search(
    docs: DataFrame, items: DataFrame, *, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", top: int = 50, block: int = 4096, room: int = 4_000_000,
) -> DataFrame:
    """The ``top`` best documents of every item: item key, ``rank``, document key, ``score``.

    Keys are integers. ``block`` documents are scored at a time; ``room`` bounds the bytes of item texts that a
    chunk of items brings to the driver and the tasks, a single longer item being a chunk of its own.
    """
    found = None
    for names, texts in _chunks(items.select(F.col(item_key).cast("long"), item_text), room):
        part = _search(docs.select(F.col(key).cast("long"), text), names, texts, top, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item long, rank int, doc long, score long")
    return found.select(F.col("item").alias(item_key), "rank", F.col("doc").alias(key), "score")


def _chunks(items: DataFrame, room: int) -> Iterator[tuple[list[int | None], list[str | None]]]:
    names, texts, used = [], [], 0
    for name, text in items.toLocalIterator():
        size = len(text or "") + 100
        if names and used + size > room:
            yield names, texts
            names, texts, used = [], [], 0
        names.append(name)
        texts.append(text)
        used += size
    if names:
        yield names, texts


def _search(docs: DataFrame, names: list[int | None], texts: list[str | None], top: int, block: int) -> DataFrame:
    vocabulary: dict[bytes, int] = {}
    wanted = []
    for text in texts:
        words = dict.fromkeys(word for words in word_lists(text) for word in words)
        wanted.append([vocabulary.setdefault(word, len(vocabulary)) for word in words])
    counts = dict(statistics(docs, vocabulary).collect())
    documents, terms = counts.pop(DOCUMENTS, 0), counts.pop(TERMS, 0)
    weights = np.zeros(len(vocabulary), np.int64)
    for term, held in counts.items():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * held + 1)))
    chosen = [
        Item(name, sorted((term for term in terms_ if term in counts), key=lambda term: (counts[term], term)))
        for name, terms_ in zip(names, wanted)
    ]
    ranker = Ranker(vocabulary, weights, chosen, documents, terms, top, block)
    partial = docs.mapInArrow(ranker, "place int, item long, doc long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc")]
    best = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    merged = (
        partial.withColumn("branch", F.floor(F.spark_partition_id() / 64))
        .withColumn("rank", best("place", "branch")).where(F.col("rank") <= top)
    )
    return merged.withColumn("rank", best("place")).where(F.col("rank") <= top).select("item", "rank", "doc", "score")


def statistics(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """How many documents hold each term, how many have a term at all, and all terms: one row a term and task, summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(vocabulary), np.int64)
        documents = terms = 0
        for batch in (piece for whole in batches for piece in pieces(whole)):
            for text in batch.column(1).to_pylist():
                number, found = term_counts(text, vocabulary)
                documents += number > 0
                terms += number
                held[list(found)] += 1
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, [DOCUMENTS, TERMS]), pa.int32()), pa.array(np.append(held[used], [documents, terms]), pa.int64())],
            names=["term", "number"],
        )

    return docs.mapInArrow(run, "term int, number long").groupBy("term").agg(F.sum("number").alias("number"))


class Best(NamedTuple):
    """The best rows of an item so far, best first."""

    scores: np.ndarray
    unnamed: np.ndarray
    keys: np.ndarray


class Ranker:
    """The best rows of every item among a task's documents."""

    def __init__(
        self, vocabulary: dict[bytes, int], weights: np.ndarray, items: list[Item], documents: int, terms: int, top: int, block: int
    ):
        self.vocabulary, self.weights, self.items = vocabulary, weights, items
        self.documents, self.terms, self.top, self.block = documents, max(terms, 1), top, block

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = np.zeros(0, np.int64)
        best = [Best(nothing, nothing.astype(bool), nothing) for _ in self.items]
        keys, sizes, places, terms, tallies = [], [], [], [], []
        for batch in (piece for whole in batches for piece in pieces(whole)):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number, found = term_counts(text, self.vocabulary)
                if found:
                    places.append(np.full(len(found), len(keys), np.int64))
                    terms.append(np.fromiter(found.keys(), np.int64, len(found)))
                    tallies.append(np.fromiter(found.values(), np.int64, len(found)))
                    keys.append(name)
                    sizes.append(number)
                if len(keys) == self.block:
                    self.rank(keys, sizes, places, terms, tallies, best)
                    keys, sizes, places, terms, tallies = [], [], [], [], []
        if keys:
            self.rank(keys, sizes, places, terms, tallies, best)
        for start in range(0, len(best), 1000):
            part = best[start : start + 1000]
            lengths = [len(found.scores) for found in part]
            unnamed = np.concatenate([found.unnamed for found in part])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(start, start + len(part)), lengths), pa.int32()),
                    pa.array([item.name for item, n in zip(self.items[start : start + 1000], lengths) for _ in range(n)], pa.int64()),
                    pa.array(np.concatenate([found.keys for found in part]), pa.int64(), mask=unnamed),
                    pa.array(np.concatenate([found.scores for found in part]), pa.int64()),
                ],
                names=["place", "item", "doc", "score"],
            )

    def rank(
        self, keys: list[int | None], sizes: list[int], places: list[np.ndarray], terms: list[np.ndarray],
        tallies: list[np.ndarray], best: list[Best],
    ) -> None:
        """Score every item over a block and bring its rows into ``best``."""
        places, terms, tallies = np.concatenate(places), np.concatenate(terms), np.concatenate(tallies)
        unnamed = np.array([name is None for name in keys])
        names = np.array([0 if name is None else name for name in keys], np.int64)
        length = 100 - 50 + (50 * np.array(sizes, np.int64) * self.documents) // self.terms
        gains = self.weights[terms] * ((1_000_000_000 * tallies) // (1000 * tallies + 20 * length[places]))
        order = np.argsort(terms, kind="stable")
        places, gains = places[order], gains[order]
        here, starts = np.unique(terms[order], return_index=True)
        most = dict(zip(here.tolist(), np.maximum.reduceat(gains, starts).tolist()))
        spans = dict(zip(here.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(places)])))
        for number, item in enumerate(self.items):
            present = [term for term in item.terms if term in most]
            if present:
                postings = [(places[slice(*spans[term])], gains[slice(*spans[term])], most[term]) for term in present]
                old = best[number]
                floor = int(old.scores[self.top - 1]) if len(old.scores) >= self.top else 0
                scores = accumulate(postings, len(keys), self.top, floor)
                best[number] = self.merged(old, scores, unnamed, names)

    def merged(self, old: Best, scores: np.ndarray, unnamed: np.ndarray, names: np.ndarray) -> Best:
        least = max(1, int(old.scores[self.top - 1]) if len(old.scores) >= self.top else 1)
        new = np.flatnonzero(scores >= least)
        if len(new) > self.top:
            cut = np.partition(scores[new], -self.top)[-self.top]
            new = new[scores[new] >= cut]
        if not len(new):
            return old
        both = Best(*(np.concatenate(pair) for pair in zip(old, (scores[new], unnamed[new], names[new]))))
        order = np.lexsort((both.keys, both.unnamed, -both.scores))[: self.top]
        return Best(*(column[order] for column in both))


def accumulate(postings: list[tuple[np.ndarray, np.ndarray, int]], size: int, top: int, floor: int = 0) -> np.ndarray:
    """Scores of a block's documents; exact for all that can be among the ``top``, 0 or too small for others.

    ``postings`` has the documents, gains and greatest gain of each term, rarest first. ``floor`` is a score that
    a document of the result has at least.
    """
    scores, held = np.zeros(size, np.int64), np.zeros(size, bool)
    left, creating = sum(most for _, _, most in postings), True
    for documents, gains, most in postings:
        if creating and left < floor:
            creating = False
        if creating:
            scores[documents] += gains
            held[documents] = True
            if size > top:
                floor = max(floor, int(np.partition(scores, -top)[-top]))
        else:
            known = held[documents]
            scores[documents[known]] += gains[known]
        left -= most
    return scores
