"""Ranked search against plain scoring of every document for every item."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.test_text_operators import plain_words

from moorage.llm import ranked_search


def plain_ranking(docs, items, top=50):
    """Rows (item, rank, doc, score) for documents and items as (id, text)."""
    bags = [Counter(plain_words(text)) for _, text in docs]
    sizes = [sum(bag.values()) for bag in bags]
    number, total = sum(size > 0 for size in sizes), sum(sizes)
    held = Counter(term for bag in bags for term in bag)
    found = []
    for name, text in items:
        scored = []
        for (doc, _), bag, size in zip(docs, bags, sizes):
            score = 0
            for term in set(plain_words(text)) & set(bag):
                weight = math.floor(1000 * math.log((2 * number + 2) / (2 * held[term] + 1)))
                m = 100 - 50 + (50 * size * number) // total
                score += weight * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda row: row[:3])
        found += [(name, rank, row[3], -row[0]) for rank, row in enumerate(scored[:top], 1)]
    return Counter(found)


def rows(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("room, block, top", [(4_000_000, 4096, 50), (300, 7, 3), (1, 50, 10)])
def test_small_tables(spark, documents, room, block, top):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = ranked_search.search(documents.repartition(6), items, room=room, block=block, top=top)
    assert rows(found) == plain_ranking(documents.select("doc_id", "text").collect(), items.collect(), top)


def test_odd_rows(spark, odd, nothing):
    items = [(1, "the quick brown fox"), (2, None), (3, ""), (None, "MIT license"), (1, "È WORD é"), (7, "word1 thing3 word1"), (1, "the quick brown fox")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    wanted = plain_ranking([tuple(row) for row in odd.select("doc_id", "text").collect()], items)
    found = ranked_search.search(odd, frame)
    assert found.columns == ["item_id", "rank", "doc_id", "score"] and rows(found) == wanted
    assert rows(ranked_search.search(odd, frame.withColumn("doc", frame["item_id"]), block=2)) == wanted
    assert ranked_search.search(nothing, frame).collect() == []
    assert ranked_search.search(odd, frame.limit(0)).collect() == []


def test_words_of_long_texts_are_cut_between_words():
    text = "alpha Beta  gamma" * 9
    for size in range(1, 30):
        assert [w for words in ranked_search.word_lists(text, size) for w in words] == [w.encode() for w in plain_words(text)]


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.dictionaries(st.integers(0, 29), st.integers(1, 9), min_size=1, max_size=30), min_size=1, max_size=8),
    st.integers(1, 5),
)
def test_limited_accumulators_keep_the_best_exact(terms, top):
    postings = [
        (np.array(list(term), np.int64), np.array(list(term.values()), np.int64), max(term.values()))
        for term in sorted(terms, key=len)
    ]
    exact = np.zeros(30, np.int64)
    for documents, gains, _ in postings:
        exact[documents] += gains
    found = ranked_search.accumulate(postings, 30, top)
    kth = np.sort(exact)[-top]
    assert (found <= exact).all() and (found[exact >= kth] == exact[exact >= kth]).all()


def test_makes_no_accumulators_that_cannot_matter():
    rare = (np.arange(3), np.full(3, 100), 100)
    common = (np.arange(1000), np.full(1000, 5), 5)
    found = ranked_search.accumulate([rare, common], 1000, 3)
    assert found[:3].tolist() == [105] * 3 and not found[3:].any()
