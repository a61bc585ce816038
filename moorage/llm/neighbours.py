"""Quality by nearest neighbours: labelled documents vote on every document, by their likeness in a latent space.

A document is a bag of terms: hashed triples of bytes, triples of character classes with runs taken as one (so signs, capitals,
digits, blanks and line ends show in any language), and a few terms for how often it repeats words and lines. Terms weigh
the logarithm of their share in the document times their rarity among the labelled documents. A randomised singular value
decomposition of the labelled documents' matrix gives the latent axes. The labelled documents' vectors go out to all tasks; each
document's cosines with all of them are computed exactly, as blocked matrix products, and its ``voters`` most similar labelled
documents vote with their label, weighted by a power of the cosine and by how common their class is in the sample against all labels.

Learned from at most ``max_rows`` labelled rows a class, those with the smallest hashes of their ids; ids with contradicting labels and
held-out ids (crc32 of the id as text divisible by five) are left out. Their term counts come to the driver, at most
``2 * max_rows`` rows of `TERMS` counts, however long the texts. Scoring reads every whole text, a megabyte at a time.

Defined results: a null text is an empty one; a document without terms, or unlike all labelled ones, scores the share of label 1 among
the labels. Repeated rows score alike, each for itself; several texts of one labelled id count as its smallest. A null id
isn't held out and never learned from. If a class has no labelled rows, all scores are the share of label 1, or 0.5 without labels. Columns besides id and text are never
read. Empty tables give an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from moorage.llm.common import pieces
from moorage.llm.toxicity import held_out

#: Hashed byte triples, triples of classes, repetition terms.
BYTES, CLASSES, REPEATS = 4096, 4096, 4
TERMS = BYTES + CLASSES + REPEATS

#: Class of each byte: line end, blank, small letter, capital, digit, part of a longer character, then signs by kind.
CLASS = np.zeros(256, np.uint16)
for _place, _signs in enumerate(
    (b"\n\r\x0b\x0c", b" \t", bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58)), bytes(range(128, 256)),
     b".", b",;:", b"!?", b"'\"`", b"()[]{}", b"#*$%&", b"|<>", b"-_=+~^", b"/\\@")
):
    CLASS[list(_signs)] = _place + 1


def _slices(folded: bytes, size: int) -> Iterator[bytes]:
    start = 0
    while start < len(folded):
        yield folded[start : start + size]
        start += size


def term_counts(text: str | None, size: int = 1 << 20) -> np.ndarray:
    """Counts of all terms of a whole text; the triples of two slices of ``size`` bytes don't reach across."""
    counts = np.zeros(TERMS, np.float64)
    folded = (text or "").encode()
    for part in _slices(folded, size):
        codes = np.frombuffer(part, np.uint8).astype(np.uint32)
        if len(codes) >= 3:
            keys = (codes[:-2] << 16 | codes[1:-1] << 8 | codes[2:]) * np.uint32(2654435761)
            counts[:BYTES] += np.bincount(keys >> np.uint32(20), minlength=BYTES)
        kinds = CLASS[codes]
        kinds = kinds[np.append(True, kinds[1:] != kinds[:-1])]
        if len(kinds) >= 3:
            counts[BYTES : BYTES + CLASSES] += np.bincount(kinds[:-2] << 8 | kinds[1:-1] << 4 | kinds[2:], minlength=CLASSES)
        words = part.split()
        lines = part.split(b"\n")
        counts[BYTES + CLASSES :] += (
            len(words) - len(set(words)), sum(a == b for a, b in zip(words, words[1:])), len(lines) - len(set(lines)), len(words),
        )
    return counts


def term_weights(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the terms' shares, each kind within itself."""
    shares = np.zeros(TERMS, np.float32)
    for start, stop in ((0, BYTES), (BYTES, BYTES + CLASSES)):
        shares[start:stop] = counts[start:stop] / max(1.0, counts[start:stop].sum())
    shares[BYTES + CLASSES : -1] = counts[BYTES + CLASSES : -1] / max(1.0, counts[-1])
    return np.log1p(1000 * shares)


class Model(NamedTuple):
    share: float
    """Label 1 among all labels; the score where nobody votes."""
    axes: np.ndarray | None = None
    """Terms to latent axes, the terms' rarity included."""
    vectors: np.ndarray | None = None
    """Of the labelled documents, of length 1."""
    labels: np.ndarray | None = None
    weights: np.ndarray | None = None
    """Of each labelled document's vote."""
    voters: int = 25
    power: float = 8.0

    def scores(self, texts: list[str | None], block: int = 250) -> Iterator[float]:
        """A score a text; texts and labelled vectors meet in matrix products of ``block`` texts."""
        for start in range(0, len(texts), block):
            part = texts[start : start + block]
            if self.vectors is None:
                yield from [self.share] * len(part)
                continue
            found = np.zeros((len(part), self.axes.shape[1]), np.float32)
            for place, text in enumerate(part):
                weights = term_weights(term_counts(text))
                used = np.flatnonzero(weights)
                found[place] = weights[used] @ self.axes[used]
            yield from self.vote(unit(found)).tolist()

    def vote(self, found: np.ndarray) -> np.ndarray:
        cosines = np.clip(found @ self.vectors.T, 0, None)
        voters = min(self.voters, cosines.shape[1])
        near = np.argpartition(cosines, -voters, axis=1)[:, -voters:]
        votes = np.take_along_axis(cosines, near, axis=1).astype(np.float64) ** self.power * self.weights[near]
        least = 1e-9  # of a vote for the share, so that it decides where nobody else does
        return np.clip(((votes * self.labels[near]).sum(axis=1) + least * self.share) / (votes.sum(axis=1) + least), 0, 1)


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


def fit(
    counts: np.ndarray, labels: np.ndarray, share: float, *, rank: int = 64, classes: float = 1.0, repeats: float = 8.0, **options
) -> Model:
    """A model of labelled documents' term counts, which are overwritten.

    ``classes`` and ``repeats`` weigh those terms against byte triples.
    """
    matrix = counts
    for place, row in enumerate(counts):
        matrix[place] = term_weights(row)
    rarity = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))).astype(np.float32) + 1
    rarity[BYTES : BYTES + CLASSES] *= classes
    rarity[BYTES + CLASSES :] = repeats
    matrix *= rarity
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix /= np.where(lengths > 0, lengths, 1)
    random = np.random.default_rng(7)
    rank = min(rank, *matrix.shape)
    basis = random.standard_normal((matrix.shape[1], min(rank + 16, matrix.shape[1]))).astype(np.float32)
    for _ in range(4):
        left, _ = np.linalg.qr(matrix @ basis)
        basis, _ = np.linalg.qr(matrix.T @ left)
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    axes = (basis @ turn[:rank].T).astype(np.float32)
    vectors = unit(matrix @ axes)
    ones = labels.mean()
    weights = np.where(labels == 1, share / ones, (1 - share) / (1 - ones))
    return Model(share, axes * rarity[:, None], vectors, labels.astype(np.float64), weights, **options)


def labelled_rows(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, max_rows: int) -> DataFrame:
    """``_class`` and ``_text`` of the rows to learn from: the smallest hashes of each class."""
    classes = (
        labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("_key")).agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
        .where("_low = _high").select("_key", F.col("_low").cast("int").alias("_class"))
    )
    part = lambda value: classes.where(F.col("_class") == value).orderBy(F.xxhash64("_key"), "_key").limit(max_rows)
    return (
        docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
        .join(F.broadcast(part(0).unionByName(part(1))), "_key")  # at most twice max_rows ids
        .groupBy("_key", "_class").agg(F.min("_text").alias("_text"))
    )


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = 1500, **options,
) -> Model:
    """A model of the labelled rows that aren't held out."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col(key)))
    share = known.agg(F.avg(F.col(label).cast("double"))).first()[0]
    share = 0.5 if share is None else share

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part.slice(at, 50) for whole in batches for part in pieces(whole) for at in range(0, part.num_rows, 50)):
            found = [term_counts(text) for text in batch.column(2).to_pylist()]
            used = [np.flatnonzero(counts) for counts in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.string()), batch.column(1),
                    pa.array([terms.astype(np.uint16).tobytes() for terms in used], pa.binary()),
                    pa.array([counts[terms].astype(np.float32).tobytes() for counts, terms in zip(found, used)], pa.binary()),
                ],
                names=["name", "label", "terms", "counts"],
            )

    rows = labelled_rows(docs, labels, key=key, text=text, label=label, max_rows=max_rows)
    found = sorted(
        rows.select("_key", "_class", "_text").mapInArrow(count, "name string, label int, terms binary, counts binary").toLocalIterator(),
        key=lambda row: hashlib.md5(row["name"].encode()).digest(),
    )
    truth = np.array([row["label"] for row in found])
    if len(set(truth.tolist())) < 2:
        return Model(share)
    counts = np.zeros((len(found), TERMS), np.float32)
    for place, row in enumerate(found):
        counts[place, np.frombuffer(row["terms"], np.uint16)] = np.frombuffer(row["counts"], np.float32)
    del found
    return fit(counts, truth, share, **options)


def score(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Key, ``held_out``, ``score``, ``predicted`` for every row."""
    kind = docs.schema[key].dataType.simpleString()
    target = T.StructType.fromDDL(f"`{key}` {kind}, score double")
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            scores = list(model.scores(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow[0].type), pa.array(scores, pa.float64())], schema=arrow)

    return docs.select(key, text).mapInArrow(run, target).select(
        key, held_out(F.col(key)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
