"""SimHash near-duplicates with pivot distance tables.

A text's fingerprint sums up the hashes of its word shingles. Fingerprints
link at ``bits`` or fewer differing bits; documents linked over any number of
steps form a component.

How pairs are found: copies collapse to one row per fingerprint. Two
fingerprints that differ in at most three bits agree on one of any four parts
of their bits, and again on one of four parts of the rest, so every pair meets
under one of 16 masks; that only deals the fingerprints out. Inside a dealt
group a table holds the Hamming distances of each fingerprint to fixed pivot
fingerprints. Pairs whose distances to some pivot differ by more than ``bits``
can't link (triangle inequality) and are discarded; survivors are verified bit
by bit. A group sends one edge per linked fingerprint to its smallest one,
never all pairs. Groups over ``MOST`` rows are dealt again under masks with
more bits, until they fit; the last masks leave at most 13 bits free, which bounds them for good.

Defined results: a null text counts as an empty one; texts without words have
fingerprint zero and link like any other; rows with equal or null ids are
rows of their own; null ids never name a component, so a component of null ids
alone has a null name; an empty table gives an empty result; columns other
than the id and the text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorage.llm.common import identity, map_rows
from moorage.session import materialise

SEED = 42
#: Rows of a dealt group that one task compares.
MOST = 4096
#: Pivots: fingerprints of the numbers from 0.
PIVOTS = 24
#: Bits of the four parts that a mask's free bits are cut into, level by level.
PARTS = ((16, 16, 16, 16), (12, 12, 12, 12), (9, 9, 9, 9), (7, 7, 7, 6), (5, 5, 5, 5), (4, 4, 4, 3))


def fingerprint(text: str | None, width: int = 3) -> int:
    """The signed 64-bit fingerprint of the word shingles of a text, A-Z lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(width, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = (starts + sizes)[width - 1 :]
    count = len(ends)
    digest = xxhash.xxh64_intdigest
    sums = np.zeros(64, np.int64)
    for low in range(0, count, 1 << 15):
        part = slice(low, low + (1 << 15))
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[part].tolist(), ends[part].tolist())], "<u8"
        )
        sums += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * sums > count, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """Per row: key and ``fingerprint`` as a long."""
    kind = docs.schema[key].dataType.simpleString()
    return map_rows(docs, [key, text], lambda k, t: (k, fingerprint(t, width)), f"`{key}` {kind}, fingerprint long")


def masks(level: int) -> list[int]:
    """The masks after dealing ``level`` times: entry ``4 * i + j`` extends entry ``i`` of the level before."""
    found = [0]
    for parts in PARTS[:level]:
        longer = []
        for mask in found:
            free = [bit for bit in range(64) if not mask >> bit & 1]
            place = 0
            for size in parts:
                longer.append(mask | sum(1 << bit for bit in free[place : place + size]))
                place += size
        found = longer
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _dealt(rows: DataFrame, level: int) -> DataFrame:
    """(path, part, fp): each fingerprint under every mask that extends its path."""
    mask = F.lit([_signed(m) for m in masks(level)])
    paths = F.transform(F.lit([0, 1, 2, 3]), lambda j: F.col("path") * 4 + j)
    return rows.select("fp", F.explode(paths).alias("path")).select(
        "path", F.col("fp").bitwiseAND(F.element_at(mask, F.col("path") + 1)).alias("part"), "fp"
    )


def link_group(fps: np.ndarray, pivots: np.ndarray, bits: int) -> np.ndarray:
    """For each fingerprint of a group, the place of the first fingerprint of its component within the group."""
    n = len(fps)
    table = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    table, sorted_fps = table[order], fps[order]
    upto = np.searchsorted(table[:, 0], table[:, 0] + bits, side="right")
    parent = list(range(n))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for low in range(0, n, 64):
        high = min(n, low + 64)
        reach = int(upto[high - 1])
        left, right = np.nonzero(np.arange(low, reach)[None, :] > np.arange(low, high)[:, None])
        left, right = left + low, right + low
        for pivot in range(table.shape[1]):
            if not len(left):
                break
            near = np.abs(table[left, pivot] - table[right, pivot]) <= bits
            left, right = left[near], right[near]
        linked = np.bitwise_count(sorted_fps[left] ^ sorted_fps[right]) <= bits
        left, right = order[left[linked]], order[right[linked]]
        if len(left) > n:  # a dense block: only pairs of different components so far
            tops = np.array([root(i) for i in range(n)])
            left, right = np.unique(np.sort(np.stack([tops[left], tops[right]]), axis=0), axis=1)
        for i, j in zip(left.tolist(), right.tolist()):
            i, j = root(i), root(j)
            if i != j:
                parent[max(i, j)] = min(i, j)
    return np.array([root(i) for i in range(n)])


def _linker(bits: int):
    """Maps sorted (path, part, fp) rows to edges (a, b), a > b, group by group."""
    pivots = np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(PIVOTS)], np.uint64)

    def edges(path: np.ndarray, part: np.ndarray, fps: np.ndarray) -> tuple[list, list]:
        cuts = np.flatnonzero((path[1:] != path[:-1]) | (part[1:] != part[:-1])) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(fps)]))
        above, below = [], []
        for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            group = np.unique(fps[start:end])
            first = link_group(group.view(np.uint64), pivots, bits)
            others = np.flatnonzero(first != np.arange(len(group)))
            above += group[others].tolist()
            below += group[first[others]].tolist()
        return above, below

    def run(batches):
        held: list[np.ndarray] = []
        for batch in batches:
            columns = [np.asarray(column) for column in batch.columns]
            if held:
                columns = [np.concatenate(pair) for pair in zip(held, columns)]
            path, part, fps = columns
            if not len(fps):
                continue
            # The last group may go on in the next batch.
            last = int(np.flatnonzero((path != path[-1]) | (part != part[-1]))[-1]) + 1 if (
                path[0] != path[-1] or part[0] != part[-1]
            ) else 0
            above, below = edges(path[:last], part[:last], fps[:last]) if last else ([], [])
            held = [path[last:], part[last:], fps[last:]]
            yield pa.RecordBatch.from_arrays([pa.array(above, pa.int64()), pa.array(below, pa.int64())], ["a", "b"])
        if held:
            above, below = edges(*held)
            yield pa.RecordBatch.from_arrays([pa.array(above, pa.int64()), pa.array(below, pa.int64())], ["a", "b"])

    return run


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) that connect exactly the linked ones."""
    if bits > 3:
        raise ValueError("four parts per level find pairs of at most three differing bits")
    rows, found, level = fps.select("fp", F.lit(0).alias("path")), None, 1
    rows = _dealt(rows, level).select("fp", "path")
    while True:
        level += 1
        rows = _dealt(rows, level)
        if level < len(PARTS):
            sizes = rows.groupBy("path", "part").agg(F.count("*").alias("size")).where(F.col("size") > MOST)
            big = materialise(sizes.select("path", "part"), "simhash-hot")
            hot = not big.isEmpty()
        else:
            hot = False
        fit = rows.join(F.broadcast(big), ["path", "part"], "left_anti") if hot and _few(big) else (
            rows.join(big, ["path", "part"], "left_anti") if hot else rows
        )
        made = fit.repartition("path", "part").sortWithinPartitions("path", "part", "fp").mapInArrow(
            _linker(bits), "a long, b long"
        )
        found = made if found is None else found.unionByName(made)
        if not hot:
            return found.distinct()
        rows = rows.join(big, ["path", "part"], "left_semi").select("fp", "path")


#: Dealt groups that are sent to every task; more are joined by key.
FEW_GROUPS = 10_000


def _few(big: DataFrame) -> bool:
    return big.count() <= FEW_GROUPS


def components(edges: DataFrame) -> DataFrame:
    """(a, b): every node of a component but its smallest, and that smallest node.

    Large-star and small-star steps until nothing changes. Each step's edges
    are written to the shared folder, so lost executors cost no more than the
    step that runs.
    """

    def state(frame: DataFrame):
        return frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = materialise(edges.where("a <> b"), "components")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("x")
        ).select("x.*").where("a <> b").distinct()
        edges = materialise(small, "components")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges


def near_copies(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3, also: dict | None = None
) -> DataFrame:
    """Per row: key, ``fingerprint`` (long), ``component`` (smallest reachable key); ``also`` adds columns of ``docs``."""
    also = also or {}
    if also:
        kinds = docs.select(key, *(column.alias(name) for name, column in also.items()))
        schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in kinds.schema)
        ready = docs.select(F.col(key), F.col(text), *(column.alias(name) for name, column in also.items()))
        rows = map_rows(
            ready, [key, text, *also], lambda k, t, *rest: (k, *rest, fingerprint(t, width)), f"{schema}, fingerprint long"
        )
    else:
        rows = fingerprints(docs, key=key, text=text, width=width)
    rows = materialise(rows, "fingerprints")
    single = materialise(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(key).alias("low")), "fingerprints-single")
    roots = components(links(single.select("fp"), bits))
    rooted = single.join(roots, single["fp"] == roots["a"], "left").select(
        "fp", "low", F.coalesce("b", "fp").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("low").alias("component"))
    named = rooted.join(names, "root").select(F.col("fp").alias("fingerprint"), "component")
    return rows.join(named, "fingerprint").select(key, *also, "fingerprint", "component")


def keep_one(docs: DataFrame, *, key: str = "doc_id", text: str = "text", width: int = 3, bits: int = 3) -> DataFrame:
    """One row of each component, all columns as they are: the smallest key; of rows with equal keys, the smallest text hash."""
    same = identity(F.col(key), F.col(text))
    found = near_copies(docs, key=key, text=text, width=width, bits=bits, also={"same": same})
    # A component of null keys alone has no name; its rows are told apart by fingerprint.
    chosen = (
        found.groupBy("component", F.when(F.col("component").isNull(), F.col("fingerprint")).alias("nameless"))
        .agg(F.min(F.struct(F.col(key).isNull().alias("absent"), F.col(key).alias("key"), "same")).alias("x"))
        .select("x.same.*")
    )
    packed = docs.select(F.struct("*").alias("doc"), same.alias("same")).select("doc", "same.*")
    return packed.join(chosen, ["mark", "check"], "left_semi").dropDuplicates(["mark", "check"]).select("doc.*")


def hexadecimal(column: str = "fingerprint"):
    """A long as 16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(F.col(column))), 16, "0")
