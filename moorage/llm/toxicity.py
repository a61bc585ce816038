"""Toxicity scores from averaged subword embeddings and a linear softmax.

A word's vector is the mean of the vectors of its hashed character n-grams,
the word itself included; a text's vector is the weighted mean of its word
vectors; a linear softmax turns it into class probabilities. Embeddings and
softmax are trained together by gradient descent in numpy. Spellings that
were never seen share most n-grams with seen ones and so inherit their vectors.

The training set is bounded: at most ``max_rows`` labelled rows per class,
taken by the smallest hash of the id, with whole texts up to ``max_chars``
characters per class in total, none longer than a twentieth of that (250,000
characters); a text that doesn't fit the room left is skipped. Scoring covers
every row and whole texts.

Because averaging and softmax are linear up to the last step, a word's
contribution to the class margin is one number; a worker computes it once per
distinct word. A word that occurs n times counts as the square root of n, so
that one repeated word doesn't make up a text, and the mean is taken over at
least ``pad`` words' weight, so that one chance word doesn't decide over a
short one. Plain gradient descent with
momentum keeps rarely seen n-grams near zero.

Defined results: a null text counts as an empty one; a text without words
gets the score of the bias alone; null ids are carried along
and are not held out; repeated rows get equal scores; an empty table gives an
empty result; without labelled rows of both classes every score is 0; labels,
language, source and id never enter a score.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import keep_rows, pieces

FOLDS = 5


def held_out(key: Column) -> Column:
    """True for ids whose crc32, as text, is divisible by the number of folds."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


SIGNS = ".,;:!?\"'()[]{}#*$%&|<>-_"


def words_of(text: str | None) -> list[str]:
    """Blank-separated words in lower case, with the signs around them."""
    return (text or "").lower().split()


@dataclass
class Model:
    """Vectors by bucket, softmax weights, word weights, and how words are cut into n-grams."""

    vectors: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    frequent: dict[str, float]
    smallest: int
    largest: int
    pad: float

    def scorer(self):
        """A function from texts to scores between 0 and 1; it remembers up to ``WORDS_KEPT`` words."""
        by_bucket = (self.vectors @ (self.softmax[:, 1] - self.softmax[:, 0])).tolist()
        known = _Contributions(by_bucket, self.frequent, self.smallest, self.largest)
        bias, pad = float(self.bias[1] - self.bias[0]), self.pad

        def scores(texts: list[str | None]) -> list[float]:
            if len(known) > WORDS_KEPT:
                known.clear()
            found = []
            for text in texts:
                total = sum([known[word] * n**0.5 for word, n in Counter(words_of(text)).items()], 0j)
                margin = total.real / max(total.imag, pad) + bias
                found.append(1.0 / (1.0 + math.exp(-min(max(margin, -30.0), 30.0))))
            return found

        return scores


#: Words whose contribution a worker remembers from one piece of a batch to the next.
WORDS_KEPT = 150_000


class _Contributions(dict):
    """By word: its weighted contribution to the margin (real) and its weight (imaginary)."""

    def __init__(self, by_bucket: list[float], frequent: dict[str, float], smallest: int, largest: int):
        super().__init__()
        self.by_bucket, self.frequent, self.smallest, self.largest = by_bucket, frequent, smallest, largest

    def __missing__(self, raw: str) -> complex:
        word = raw.strip(SIGNS)
        value = 0j
        if word:
            weight = self.frequent.get(word, 1.0)
            row = grams_of(word, len(self.by_bucket), self.smallest, self.largest)
            value = complex(weight * sum(map(self.by_bucket.__getitem__, row)) / len(row), weight)
        self[raw] = value
        return value


def grams_of(word: str, buckets: int, smallest: int, largest: int) -> list[int]:
    """Buckets of the word itself and of the n-grams of the word between its marks."""
    marked = f"<{word}>"
    size, crc = len(marked), zlib.crc32
    raw = marked.encode("utf-8", "replace")
    found = [crc(raw) % buckets]
    if len(raw) == size:
        for n in range(smallest, min(largest + 1, size)):
            found += [crc(raw[i : i + n]) % buckets for i in range(size - n + 1)]
    else:
        for n in range(smallest, min(largest + 1, size)):
            found += [crc(marked[i : i + n].encode("utf-8", "replace")) % buckets for i in range(size - n + 1)]
    return found


def _sums(table: np.ndarray, rows: np.ndarray, to: np.ndarray, size: int, weight: np.ndarray | None = None) -> np.ndarray:
    """Rows of a table, each times its weight, added up by target; column by column, to stay small."""
    found = np.empty((size, table.shape[1]), np.float32)
    for k in range(table.shape[1]):
        values = np.ascontiguousarray(table[:, k])[rows]
        found[:, k] = np.bincount(to, values if weight is None else values * weight, size)
    return found


def fit(
    texts: list[str], classes: list[int], *, buckets: int = 1 << 17, width: int = 4, steps: int = 100, rate: float = 0.1,
    gain: float = 50_000.0, smallest: int = 3, largest: int = 5, pad: float = 100.0, rare: float = 1e-3, least: int = 4,
    seed: int = 7,
) -> Model:
    """Train embeddings and softmax together by gradient descent with momentum, all examples at once.

    Both classes weigh the same. Buckets seen in fewer than ``least`` training
    texts keep a zero vector, so that chance spellings say nothing. The floor
    doesn't grow with the texts, so rare spellings of a rare class count.
    """
    rng = np.random.default_rng(seed)
    number: dict[str, int] = {}
    word_ids, times, sizes = array("i"), array("i"), array("i")
    for text in texts:
        plain: Counter[str] = Counter()
        for raw, n in Counter(words_of(text)).items():
            if word := raw.strip(SIGNS):
                plain[word] += n
        word_ids.extend([number.setdefault(word, len(number)) for word in plain])
        times.extend(plain.values())
        sizes.append(len(plain))
    word_ids, times, sizes = (np.frombuffer(a, np.int32) if a else np.zeros(0, np.int32) for a in (word_ids, times, sizes))
    doc_of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    part = np.bincount(word_ids, times, len(number)) / max(1, int(times.sum()))
    frequent = {word: rare / (rare + part[i]) for word, i in number.items() if part[i] > rare / 50}
    gram_ids, gram_counts = array("i"), array("i")
    for word in number:
        row = grams_of(word, buckets, smallest, largest)
        gram_ids.extend(row)
        gram_counts.append(len(row))
    gram_ids, gram_counts = np.frombuffer(gram_ids, np.int32), np.frombuffer(gram_counts, np.int32)
    by_word = np.array([frequent.get(word, 1.0) for word in number], np.float32)
    del number
    word_weight = np.sqrt(times, dtype=np.float32) * by_word[word_ids]
    norm = np.maximum(np.bincount(doc_of, word_weight, len(sizes)), pad)
    share = (word_weight / norm[doc_of]).astype(np.float32)
    truth = np.array(classes)
    weight = np.where(truth == 1, 0.5 / max(1, (truth == 1).sum()), 0.5 / max(1, (truth == 0).sum()))

    seen = np.zeros(buckets, np.int32)
    ends, place = np.cumsum(gram_counts), 0
    for size in sizes.tolist():
        if size:
            rows = [gram_ids[ends[word] - gram_counts[word] : ends[word]] for word in word_ids[place : place + size]]
            seen[np.unique(np.concatenate(rows))] += 1
        place += size
    used = seen >= least
    kept = used[gram_ids]
    gram_word = np.repeat(np.arange(len(gram_counts), dtype=np.int32), gram_counts)[kept]
    gram_ids = gram_ids[kept]
    vectors = (rng.normal(0, 1e-2, (buckets, width)) * used[:, None]).astype(np.float32)
    softmax, bias = rng.normal(0, 1.0, (width, 2)), np.zeros(2)
    speed = {"v": np.zeros_like(vectors), "s": np.zeros_like(softmax), "b": np.zeros_like(bias)}

    def descend(name: str, value: np.ndarray, gradient: np.ndarray, step: float) -> None:
        speed[name] *= 0.9
        speed[name] += gradient
        value -= step * speed[name]

    for step in range(1, steps + 1):
        word_vectors = _sums(vectors, gram_ids, gram_word, len(gram_counts)) / gram_counts[:, None]
        text_vectors = _sums(word_vectors, word_ids, doc_of, len(truth), share)
        logits = text_vectors @ softmax + bias
        chance = np.exp(logits - logits.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        error = chance
        error[np.arange(len(truth)), truth] -= 1
        error *= weight[:, None]
        to_text = error @ softmax.T
        to_word = _sums(to_text, doc_of, word_ids, len(gram_counts), share) / gram_counts[:, None]
        to_vectors = _sums(to_word, gram_word, gram_ids, buckets) * used[:, None]
        descend("s", softmax, text_vectors.T @ error, rate)
        descend("b", bias, error.sum(axis=0), rate)
        descend("v", vectors, to_vectors.astype(np.float32), rate * gain)
    return Model(vectors, softmax, bias, frequent, smallest, largest, pad)


def training_rows(
    docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, max_rows: int, max_chars: int
) -> tuple[list[str], list[int]]:
    """A bounded sample of labelled, not held-out texts per class; ids with contradicting labels are left out."""
    classes = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .where("_low = _high").select("_key", F.col("_low").cast("int").alias("_class"))
    )
    chosen = None
    for value in (0, 1):
        part = classes.where(F.col("_class") == value).orderBy(F.xxhash64("_key"), "_key").limit(max_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), "_key")  # at most twice max_rows ids
        .groupBy("_key", "_class").agg(F.min("_text").alias("_text"))
        .withColumn("_size", F.length("_text")).withColumn("_order", F.xxhash64("_key"))
    )
    texts, found = [], []
    for value in (0, 1):
        room = max_chars
        for row in rows.where((F.col("_class") == value) & (F.col("_size") <= max_chars // 20)).orderBy(
            "_order", "_key"
        ).select("_text", "_size").limit(max_rows).toLocalIterator():
            if row["_size"] > room:
                continue
            room -= row["_size"]
            texts.append(row["_text"])
            found.append(value)
    return texts, found


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = 3000, max_chars: int = 5_000_000, **options,
) -> Model | None:
    """A model of the labelled rows, or None if a class has no rows."""
    texts, classes = training_rows(docs, labels, key=key, text=text, label=label, max_rows=max_rows, max_chars=max_chars)
    return fit(texts, classes, **options) if len(set(classes)) == 2 else None


def score(docs: DataFrame, model: Model | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, ``held_out``, ``score``, ``predicted`` for every row."""
    kind = docs.schema[key].dataType.simpleString()
    if model is None:
        scored = docs.select(F.col(key), F.lit(0.0).alias("score"))
    else:
        scored = _scored(docs, key, text, kind, model)
    return scored.select(
        key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def _scored(docs: DataFrame, key: str, text: str, kind: str, model: Model) -> DataFrame:
    import pyarrow as pa
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    target = T.StructType.fromDDL(f"`{key}` {kind}, score double")
    arrow = to_arrow_schema(target)

    def run(batches):
        scores = model.scorer()
        for batch in (piece for whole in batches for piece in pieces(whole)):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow[0].type), pa.array(scores(batch.column(1).to_pylist()), pa.float64())], schema=arrow
            )

    return docs.select(key, text).mapInArrow(run, target)


def reject(docs: DataFrame, model: Model | None, *, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, all columns as they are."""
    if model is None:
        return docs
    return keep_rows(docs, text, _Below(model, threshold))


class _Below:
    """Verdict of a batch; builds the scorer once per task."""

    def __init__(self, model: Model, threshold: float):
        self.model, self.threshold, self.scores = model, threshold, None

    def __call__(self, texts: list[str | None]) -> list[bool]:
        self.scores = self.scores or self.model.scorer()
        return [score < self.threshold for score in self.scores(texts)]
