"""Cross-tokenizer alignment: where two tokenizers' tokens end together, and how often each pair of ids is linked so.

Every text is encoded once by both tokenizers; the ids go to the shared folder, together with each task's own counts of the
pairs that its documents link. The distinct pairs are dealt by hash to segments of about ``segment`` keys, and each
segment gets its part of a minimal perfect hash: levels of bits, a key being placed in the first level where no other key falls
on its bit. Laid end to end the parts are one function, the slot of a key being the number of ones before its bit, and the
keys in slot order verify every look-up. Each task turns its counts into a dense vector indexed by slot, and the vectors' pieces are
summed over a tree of two levels. A second pass aligns the documents again, from the stored ids, and looks up the counts of their links.

A pair of ids is a number below the product of the vocabularies' sizes, so there are at most that many. The function, keys and counts go
out to the tasks for at most ``most_pairs`` pairs at a time (about 17 bytes a pair); if there are more, the segments are taken in groups, one
after the other, and the documents' sums of the groups are added up. The rows are the same.

Defined results: texts that are null, empty, or whose tokens' bytes of either side differ from a blank and the text have no tokens, so zeros and an
empty digest. Rows with equal ids or texts are documents of their own and count once each; a null id stays null. Whole texts are
encoded, however long. Other columns are never read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import pieces
from moorage.session import materialise

#: How a byte-level vocabulary splits text before its merges. Fixed.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The fast encoder's splitting fails on blanks of very many characters; such texts go to the plain one, with the same result.
LONG_BLANK = re.compile(r"\s{2000}")


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next free one from 256."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in set(seen)]
    return {chr(byte): byte for byte in seen} | {chr(256 + place): byte for place, byte in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, from their files' contents: a byte-level one (A) and one of pieces (B)."""

    def __init__(self, byte_level: bytes, pieces_model: bytes):
        import sentencepiece
        import tiktoken

        vocabulary = json.loads(byte_level)["model"]["vocab"]
        special = {entry["content"] for entry in json.loads(byte_level).get("added_tokens", [])}
        signs = byte_signs()
        spelt = {name: name.encode() if name in special else bytes(map(signs.__getitem__, name)) for name in vocabulary}
        self.first = tiktoken.Encoding(
            "byte-level", pat_str=SPLIT, special_tokens={},
            mergeable_ranks={spelt[name]: number for name, number in vocabulary.items() if name not in special},
        )
        self.second = sentencepiece.SentencePieceProcessor(model_proto=pieces_model)
        self.byte_level, self.plain = byte_level, None
        self.first_bytes = [b""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            self.first_bytes[number] = spelt[name]
        self.second_bytes = [piece_bytes(self.second.id_to_piece(number)) for number in range(self.second.vocab_size())]

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides, none if the text has no tokens by the rules above."""
        if not text:
            return [], []
        first = self.first_ids(" " + text)
        second = self.second.encode(text)
        whole = b" " + text.encode()
        if b"".join(map(self.first_bytes.__getitem__, first)) != whole or b"".join(map(self.second_bytes.__getitem__, second)) != whole:
            return [], []
        return first, second

    def first_ids(self, text: str) -> list[int]:
        if not LONG_BLANK.search(text):
            return self.first.encode_ordinary(text)
        if self.plain is None:
            from tokenizers import Tokenizer

            self.plain = Tokenizer.from_str(self.byte_level.decode())
            self.plain.encode_special_tokens = True
        return self.plain.encode(text, add_special_tokens=False).ids


def piece_bytes(piece: str) -> bytes:
    byte = re.fullmatch("<0x([0-9A-F]{2})>", piece)
    return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()


class Vocabularies(NamedTuple):
    """What aligning stored ids needs to know of both sides."""

    first_sizes: np.ndarray
    second_sizes: np.ndarray

    @classmethod
    def of(cls, both: Tokenizers) -> Vocabularies:
        return cls(np.array(list(map(len, both.first_bytes))), np.array(list(map(len, both.second_bytes))))

    def ends(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of either side that end where a token of the other side does; no token is empty."""
        _, places, others = np.intersect1d(
            np.cumsum(self.first_sizes[first]), np.cumsum(self.second_sizes[second]), assume_unique=True, return_indices=True
        )
        return places, others

    def keys(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The linked pairs of a document as numbers, in order."""
        places, others = self.ends(first, second)
        return first[places].astype(np.int64) * len(self.second_sizes) + second[others]


class Spelling:
    """Groups of ids as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, sizes: Vocabularies):
        listed = lambda number, sign: np.array([f"{place}{sign}" for place in range(number)], object)
        self.first = [listed(len(sizes.first_sizes), sign) for sign in ",|"]
        self.second = [listed(len(sizes.second_sizes), sign) for sign in ",;"]

    def text(self, first: np.ndarray, second: np.ndarray, places: np.ndarray, others: np.ndarray) -> str:
        parts = np.empty(len(first) + len(second), object)
        # The tokens of a group: A's come after all B's of earlier groups, B's after all A's up to their own group.
        before = np.append(0, others + 1)[np.searchsorted(places, np.arange(len(first)))]
        upto = (places + 1)[np.searchsorted(others, np.arange(len(second)))]
        spelt = self.first[0][first]
        spelt[places] = self.first[1][first[places]]
        parts[np.arange(len(first)) + before] = spelt
        spelt = self.second[0][second]
        spelt[others] = self.second[1][second[others]]
        parts[np.arange(len(second)) + upto] = spelt
        return "".join(parts)[:-1]


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each key, another for each seed."""
    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build(keys: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """The levels' numbers of bits, all their bits, and the keys in slot order, for distinct keys of one segment."""
    sizes, bits, ordered, left, level = [], [], [], keys, 0
    while len(left):
        size = 2 * len(left) + 1
        places = mixed(left, level) % np.uint64(size)
        alone = np.bincount(places.astype(np.int64), minlength=size) == 1
        placed = alone[places]
        sizes.append(size)
        bits.append(alone)
        ordered.append(left[placed][np.argsort(places[placed])])
        left, level = left[~placed], level + 1
    nothing = np.zeros(0, np.int64)
    return sizes, np.concatenate(bits or [nothing.astype(bool)]), np.concatenate(ordered or [nothing])


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (mixed(keys, 1_000_003) % np.uint64(segments)).astype(np.int64)


class PerfectHash:
    """Slots of the keys of some segments, with the keys to verify them."""

    def __init__(self, segments: int, parts: dict[int, tuple[list[int], np.ndarray, np.ndarray]]):
        depth = max((len(sizes) for sizes, _, _ in parts.values()), default=0)
        self.segments, self.numbers = segments, np.array(sorted(parts), np.int64)
        self.sizes = np.zeros((len(parts), depth), np.int64)
        self.starts = np.zeros((len(parts), depth), np.int64)
        bits, keys, start = [], [], 0
        for row, number in enumerate(self.numbers.tolist()):
            sizes, own, ordered = parts[number]
            for level, size in enumerate(sizes):
                self.sizes[row, level], self.starts[row, level] = size, start
                start += size
            bits.append(own)
            keys.append(ordered)
        self.bits = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        #: Ones before each block of 64 bytes of bits.
        padded = np.append(self.bits, np.zeros(-len(self.bits) % 64, np.uint8)).reshape(-1, 64)
        self.padded = padded
        self.ranks = np.append(0, np.cumsum(np.bitwise_count(padded).sum(axis=1, dtype=np.int64)))[:-1]

    def _ones_before(self, places: np.ndarray) -> np.ndarray:
        block, byte, bit = places >> 9, (places >> 3) & 63, places & 7
        counts = np.bitwise_count(self.padded[block]).astype(np.int64)
        inside = np.where(np.arange(64) < byte[:, None], counts, 0).sum(axis=1)
        last = np.bitwise_count(self.padded[block, byte] >> (8 - bit).astype(np.uint8)).astype(np.int64)
        return self.ranks[block] + inside + np.where(bit > 0, last, 0)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for a key that the function was not built with."""
        found = np.full(len(keys), -1, np.int64)
        if not len(self.numbers):
            return found
        wanted = segment_of(keys, self.segments)
        rows = np.minimum(np.searchsorted(self.numbers, wanted), len(self.numbers) - 1)
        open_ = np.flatnonzero(self.numbers[rows] == wanted)
        for level in range(self.sizes.shape[1]):
            sizes = self.sizes[rows[open_], level]
            open_, sizes = open_[sizes > 0], sizes[sizes > 0]
            if not len(open_):
                break
            places = (mixed(keys[open_], level) % sizes.astype(np.uint64)).astype(np.int64) + self.starts[rows[open_], level]
            here = (self.bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1
            for start in range(0, int(here.sum()), 100_000):
                part = slice(start, start + 100_000)
                found[open_[here][part]] = self._ones_before(places[here][part])
            open_ = open_[~here]
        known = found >= 0
        found[known] = np.where(self.keys[found[known]] == keys[known], found[known], -1)
        return found


class Tally:
    """Counts of keys within a task, handed on whenever ``room`` distinct ones are held."""

    def __init__(self, room: int = 1_000_000):
        self.room, self.waiting, self.held = room, [], 0
        self.keys = self.counts = np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.waiting.append(keys)
        self.held += len(keys)
        if self.held > self.room:
            self.fold()
            if len(self.keys) > self.room:
                yield from self.empty()

    def fold(self) -> None:
        keys, counts = np.unique(np.concatenate([self.keys[:0], *self.waiting]), return_counts=True)
        both, place = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        sums = np.zeros(len(both), np.int64)
        np.add.at(sums, place, np.concatenate([self.counts, counts]))
        self.keys, self.counts, self.waiting, self.held = both, sums, [], 0

    def empty(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.fold()
        for start in range(0, len(self.keys), 65_536):
            yield self.keys[start : start + 65_536], self.counts[start : start + 65_536]
        self.keys = self.counts = self.keys[:0]


def width(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


#: A document with its ids, or some counts of a task.
STORED = "row long, doc long, first binary, second binary, pairs binary, counts binary"


def encode(docs: DataFrame, byte_level: bytes, pieces_model: bytes) -> DataFrame:
    """Rows of `STORED` for ``docs`` (row, doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(byte_level, pieces_model)
        sizes, tally = Vocabularies.of(both), Tally()
        kinds = width(len(sizes.first_sizes)), width(len(sizes.second_sizes))

        def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for keys, counts in parts:
                yield stored([None], [None], [None], [None], [keys.tobytes()], [counts.tobytes()])

        for batch in (piece for whole in batches for piece in pieces(whole)):
            columns, parts = ([], [], [], []), []
            for row, doc, text in zip(*(column.to_pylist() for column in batch.columns)):
                first, second = both.encode(text)
                first, second = np.array(first, kinds[0]), np.array(second, kinds[1])
                if len(first):
                    parts += tally.add(sizes.keys(first, second))
                for column, value in zip(columns, (row, doc, first.tobytes(), second.tobytes())):
                    column.append(value)
            nothing = [None] * batch.num_rows
            yield stored(*columns, nothing, nothing)
            yield from counted(parts)
        yield from counted(list(tally.empty()))

    def stored(*columns: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)],
            names=["row", "doc", "first", "second", "pairs", "counts"],
        )

    return docs.mapInArrow(run, STORED)


def _segments(tallies: DataFrame, segments: int) -> DataFrame:
    """A row a segment: its number, how many keys, its part of the function."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs in batch.column(0).to_pylist():
                found = np.frombuffer(pairs, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(segment_of(found, segments)), pa.array(found)], names=["segment", "key"])

    def built(group: pa.Table) -> pa.Table:
        sizes, bits, ordered = build(group.column("key").to_numpy())
        return pa.table({
            "segment": pa.array([group.column("segment")[0].as_py()], pa.int64()), "number": pa.array([len(ordered)], pa.int64()),
            "sizes": pa.array([sizes], pa.list_(pa.int64())), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            "keys": pa.array([ordered.tobytes()], pa.binary()),
        })

    distinct = tallies.select("pairs").mapInArrow(keys, "segment long, key long").distinct()
    return distinct.groupBy("segment").applyInArrow(built, "segment long, number long, sizes array<long>, bits binary, keys binary")


def _load(parts: DataFrame, numbers: list[int] | None, segments: int) -> PerfectHash:
    chosen = parts if numbers is None else parts.where(F.col("segment").between(numbers[0], numbers[-1]))
    return PerfectHash(segments, {
        row["segment"]: (
            row["sizes"], np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool),
            np.frombuffer(row["keys"], np.int64),
        )
        for row in chosen.toLocalIterator()
    })


#: Slots of a piece of a dense vector.
PIECE = 8192


def _dense_counts(tallies: DataFrame, function: PerfectHash) -> np.ndarray:
    """How often each key is linked, by slot: the tasks' dense vectors, summed over a tree."""
    number = len(function.keys)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(number, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                slots = function.slots(np.frombuffer(pairs, np.int64))
                known = slots >= 0
                vector[slots[known]] += np.frombuffer(counts, np.int64)[known]
        for start in range(0, number, PIECE):
            part = vector[start : start + PIECE]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([start]), pa.array([part.tobytes()], pa.binary())], names=["start", "sums"])

    def added(group: pa.Table) -> pa.Table:
        total = 0
        for piece in group.column("sums").to_pylist():
            total = total + np.frombuffer(piece, np.int64)
        return pa.table({"start": pa.array([group.column("start")[0].as_py()]), "sums": pa.array([total.tobytes()], pa.binary())})

    vectors = tallies.select("pairs", "counts").mapInArrow(dense, "start long, sums binary")
    branches = vectors.withColumn("branch", F.floor(F.spark_partition_id() / 32)).groupBy("start", "branch")
    summed = branches.applyInArrow(lambda _, group: added(group), "start long, sums binary")
    total = np.zeros(number, np.int64)
    for row in summed.groupBy("start").applyInArrow(lambda _, group: added(group), "start long, sums binary").toLocalIterator():
        total[row["start"] : row["start"] + PIECE] = np.frombuffer(row["sums"], np.int64)
    return total


RESULT = (
    "row long, doc long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
)


def _looked_up(docs: DataFrame, sizes: Vocabularies, function: PerfectHash, counts: np.ndarray, best: np.ndarray, digest: bool) -> DataFrame:
    """Every document aligned again, with the sums over those links whose keys the function holds."""
    kinds = width(len(sizes.first_sizes)), width(len(sizes.second_sizes))
    second_ids = len(sizes.second_sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(sizes)
        for batch in (piece for whole in batches for piece in pieces(whole)):
            firsts = [np.frombuffer(ids, kinds[0]) for ids in batch.column(2).to_pylist()]
            seconds = [np.frombuffer(ids, kinds[1]) for ids in batch.column(3).to_pylist()]
            ends = [sizes.ends(*pair) for pair in zip(firsts, seconds)]
            links = np.concatenate([[0], *(
                first[places].astype(np.int64) * second_ids + second[others]
                for first, second, (places, others) in zip(firsts, seconds, ends)
            )])[1:].astype(np.int64)
            keys, place = np.unique(links, return_inverse=True)
            slots = function.slots(keys)
            held = slots >= 0
            found = np.zeros(len(keys), np.int64)
            found[held] = counts[slots[held]]
            top = held & (found == best[keys % second_ids])
            stops = np.cumsum([0, *(len(places) for places, _ in ends)])
            sums = [np.append(0, np.cumsum(values[place], dtype=np.int64)) for values in (top, found)]
            texts = ["" for _ in ends]
            if digest:
                texts = [
                    hashlib.sha256(spelling.text(first, second, *both).encode()).hexdigest() if len(first) else ""
                    for first, second, both in zip(firsts, seconds, ends)
                ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), *(pa.array(list(map(len, ids)), pa.int64()) for ids in (firsts, seconds)),
                    *[pa.array(np.diff(stops), pa.int64())] * 2, *(pa.array(total[stops[1:]] - total[stops[:-1]]) for total in sums),
                    pa.array(texts, pa.string()),
                ],
                names=["row", "doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"],
            )

    return docs.select("row", "doc", "first", "second").mapInArrow(run, RESULT)


def align(
    docs: DataFrame, byte_level: str, pieces_model: str, *, key: str = "doc_id", text: str = "text",
    most_pairs: int = 4_000_000, segment: int = 16_384,
) -> DataFrame:
    """Per document: key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    ``byte_level`` and ``pieces_model`` are the vocabulary files of A and B, read here and sent to the tasks.
    """
    with open(byte_level, "rb") as file:
        first = file.read()
    with open(pieces_model, "rb") as file:
        second = file.read()
    sizes = Vocabularies.of(Tokenizers(first, second))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    stored = materialise(encode(rows, first, second), "aligned")
    tallies, encoded = stored.where("pairs IS NOT NULL"), stored.where("pairs IS NULL")
    # Tasks' keys with repeats bound the number of segments from above within the number of tasks; a sample isn't needed.
    held = tallies.agg(F.sum(F.length("pairs") / 8)).first()[0] or 0
    segments = max(1, int(held) // segment)
    parts = materialise(_segments(tallies, segments), "segments")
    groups = _groups(parts, most_pairs)
    best = np.zeros(len(sizes.second_sizes), np.int64)
    whole = len(groups) <= 1
    for group in groups:
        function = _load(parts, None if whole else group, segments)
        counts = _dense_counts(tallies, function)
        np.maximum.at(best, function.keys % len(sizes.second_sizes), counts)
    if whole:
        if not groups:
            function, counts = _load(parts, None, segments), np.zeros(0, np.int64)
        found = _looked_up(encoded, sizes, function, counts, best, True)
    else:
        found = None
        for place, group in enumerate(groups):
            function = _load(parts, group, segments)
            part = materialise(_looked_up(encoded, sizes, function, _dense_counts(tallies, function), best, place == 0), "links")
            found = part if found is None else found.unionByName(part)
        first_of = lambda *names: [F.max(name).alias(name) for name in names]
        found = found.groupBy("row").agg(
            *first_of("doc", "n_a", "n_b", "n_groups", "n_links", "groups"),
            *[F.sum(name).alias(name) for name in ("n_best", "count_sum")],
        )
    return found.select(
        F.col("doc").alias(key), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )


def _groups(parts: DataFrame, most: int) -> list[list[int]]:
    """First and last segment of runs of segments with at most ``most`` keys together; a larger segment is one alone."""
    groups, held = [], 0
    for row in parts.select("segment", "number").orderBy("segment").toLocalIterator():
        if groups and held + row["number"] <= most:
            groups[-1][1], held = row["segment"], held + row["number"]
        else:
            groups.append([row["segment"], row["segment"]])
            held = row["number"]
    return groups
