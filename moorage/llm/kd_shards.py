"""Shards of near equal bytes by k-d tree partitioning.

A node that holds several shards is split at the weighted median of the
dimension in which its documents spread widest (at the share of its shards
that go to the left, if their number is odd), until every leaf is one shard.
Dimensions are metadata: source, language, size and position of the id.

A median is found without sorting: the weights of a node's documents are
summed up in a fixed number of ranges of the dimension's key, and the range
in which the median lies is cut again, until it holds one key. All nodes of a
level are searched in the same passes, and a pass moves partial sums alone.
Documents with equal texts are a group: they share the smallest metadata of
any of them, so all their keys are equal but for the lowest bits, a hash of
the id. A cut that falls into a group goes to its nearer end, and only where
the group holds more than ``GROUP_SHARE`` of a shard it goes through it, so that
shards stay near equal.

Only DataFrame and SQL functions are used.

Defined results: a null text has no bytes and is no copy of an empty one; null
metadata comes first; rows equal in id and text share a key and stay together; an empty table gives an
empty result, and with fewer documents than shards some shards stay empty;
columns other than those named are only carried along.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moorage.session import materialise

#: Ranges that a node's keys are summed up in, per pass. Keys have 52 bits, so range numbers fit in 64.
RANGES = 1024
#: Bits of a key: the value, below it a hash of the text, lowest a hash of the id.
VALUE_BITS, TEXT_BITS, ID_BITS = 20, 20, 12
TIE_BITS = TEXT_BITS + ID_BITS
#: Share of a shard up to which a group of equal texts is never cut.
GROUP_SHARE = 0.05
OVERHEAD = 16


class Node(NamedTuple):
    """A node of the tree: its number (children 2n and 2n + 1), its shards, the first of them."""

    number: int
    shards: int
    first: int


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus a fixed overhead per document."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def _name_value(column: Column) -> Column:
    """A place for a name: the upper bits of its crc32; null comes first."""
    place = F.shiftrightunsigned(F.crc32(column.cast("string").cast("binary")), 32 - VALUE_BITS)
    return F.coalesce(place, F.lit(0))


def dimensions(docs: DataFrame, *, key: str, text: str, names: list[str]) -> list[Column]:
    """Per dimension a whole number of ``VALUE_BITS`` bits: each name column, the log of the size, the id's position."""
    top = (1 << VALUE_BITS) - 1
    found = [_name_value(F.col(name)) for name in names]
    found.append(F.least(F.lit(top), F.floor(F.log2(byte_size(F.col(text)).cast("double")) * (1 << 15))))
    if isinstance(docs.schema[key].dataType, T.NumericType):
        low, high = docs.agg(F.min(key).cast("double"), F.max(key).cast("double")).first()
        if low is not None and high > low:
            part = (F.col(key).cast("double") - F.lit(low)) / F.lit(high - low)
            found.append(F.coalesce(F.floor(part * top), F.lit(0)))
    return [column.cast("long") for column in found]


def _keyed(docs: DataFrame, *, key: str, text: str, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows as ``doc``, size, text_crc32, tie, ``mark`` (of the text) and own ``values``; and the values of groups of equal texts.

    Only texts that repeat have a row in the second table: the mark and the smallest value of each dimension.
    """
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    tie = F.crc32(F.concat_ws(":", F.col(key).cast("string"), crc.cast("string")).cast("binary"))
    rows = docs.select(
        F.struct("*").alias("doc"), byte_size(F.col(text)).alias("size"), crc.alias("text_crc32"), tie.alias("tie"),
        F.xxhash64(F.col(text).isNull(), F.col(text)).alias("mark"),
        F.array(*dimensions(docs, key=key, text=text, names=names)).alias("values"),
    )
    places = range(len(names) + 2)
    least = F.array_compact(F.array(*[F.min(F.get("values", F.lit(d))) for d in places])).alias("shared")
    groups = rows.select("mark", "values").groupBy("mark").agg(F.count("*").alias("n"), least)
    return rows, groups.where("n > 1").select("mark", "shared")


def _with_keys(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds ``keys``: per dimension the group's value, above a hash of the text and one of the id."""
    joined = rows.join(groups, "mark", "left")
    low = F.pmod("mark", F.lit(1 << TEXT_BITS)) * (1 << ID_BITS) + F.pmod("tie", F.lit(1 << ID_BITS))
    keys = F.transform(F.coalesce("shared", "values"), lambda value: value * (1 << TIE_BITS) + low)
    return joined.withColumn("keys", keys).drop("shared", "values", "mark")


def _widest(rows: DataFrame, nodes: list[Node], spread: list[int], dims: int) -> dict[int, dict]:
    """Per node its widest dimension, the range of its keys there, and the bytes wanted to the left of the cut."""
    sums = [F.sum("size").alias("total")]
    for d in range(dims):
        at = F.element_at("keys", d + 1)
        sums += [F.min(at).alias(f"low{d}"), F.max(at).alias(f"high{d}")]
    shards = {node.number: node.shards for node in nodes}
    found = {}
    for row in rows.groupBy("node").agg(*sums).collect():  # one row per node
        if (n := shards.get(row["node"], 1)) < 2:
            continue
        wide = [((row[f"high{d}"] >> TIE_BITS) - (row[f"low{d}"] >> TIE_BITS)) / max(1, spread[d]) for d in range(dims)]
        d = max(range(dims), key=lambda i: (wide[i], -i))
        found[row["node"]] = {
            "dim": d, "low": row[f"low{d}"], "high": row[f"high{d}"], "before": 0, "want": row["total"] * (n // 2) / n,
            "whole": GROUP_SHARE * row["total"] / n,
        }
    return found


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small table as SQL values; None is null."""
    names = [column.split()[0] for column in columns.split(", ")]
    if not rows:
        return spark.sql("select " + ", ".join(f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in columns.split(", ")) + " where false")
    listed = ", ".join("(" + ", ".join("null" if v is None else repr(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"cast({c.split()[0]} as {c.split()[1]}) as {c.split()[0]}" for c in columns.split(", "))
    return spark.sql(f"select {casts} from values {listed} as t({', '.join(names)})")


SEARCH = "node bigint, dim int, low bigint, high bigint, before bigint, want double"
GROUP = "node bigint, dim int, place bigint, want double"


def _narrow(rows: DataFrame, search: dict[int, dict]) -> None:
    """One pass: cut each node's range of keys down to the part in which its median lies."""
    spark = rows.sparkSession
    state = _values(spark, [(n, s["dim"], s["low"], s["high"], s["before"], s["want"]) for n, s in search.items()], SEARCH)
    at = F.element_at("keys", F.col("dim") + 1)
    # One row of state per node; nodes are fewer than shards.
    inside = rows.join(F.broadcast(state), "node").withColumn("at", at).where("at between low and high")
    part = F.expr(f"(at - low) * {RANGES} div (high - low + 1)")
    sums = inside.groupBy("node", part.alias("part")).agg(
        F.sum("size").alias("bytes"), F.min("at").alias("from"), F.max("at").alias("to"), F.first("before").alias("before"),
        F.first("want").alias("want"),
    )
    upto = Window.partitionBy("node").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)  # at most RANGES rows a node
    placed = sums.withColumn("upto", F.sum("bytes").over(upto) + F.col("before"))
    hit = placed.where("upto >= want").groupBy("node").agg(F.min(F.struct("part", "from", "to", "upto", "bytes")).alias("x"))
    for row in hit.select("node", "x.*").collect():  # one row per node
        search[row["node"]].update(low=row["from"], high=row["to"], before=row["upto"] - row["bytes"], bytes=row["bytes"])


def _group(s: dict) -> int | None:
    """The group that the range of keys left lies in, if it is one."""
    return s["low"] >> ID_BITS if s["low"] >> ID_BITS == s["high"] >> ID_BITS else None


def _at_group_ends(rows: DataFrame, search: dict[int, dict]) -> None:
    """Where the median lies in a group of at most ``whole`` bytes, the search ends with the whole group."""
    state = _values(rows.sparkSession, [(n, s["dim"], s["low"] >> ID_BITS, s["want"]) for n, s in search.items()], GROUP)
    at = F.shiftright(F.element_at("keys", F.col("dim") + 1), ID_BITS)
    # One row of state per node; nodes are fewer than shards.
    met = rows.join(F.broadcast(state), "node").withColumn("at", at).where("at <= place")
    sums = met.groupBy("node").agg(
        F.sum(F.when(F.col("at") < F.col("place"), F.col("size"))).alias("before"),
        F.sum(F.when(F.col("at") == F.col("place"), F.col("size"))).alias("bytes"),
    )
    for row in sums.collect():  # one row per node
        s = search[row["node"]]
        if row["bytes"] <= s["whole"]:
            first = (s["low"] >> ID_BITS) << ID_BITS
            s.update(low=first, high=first + (1 << ID_BITS) - 1, before=row["before"] or 0, bytes=row["bytes"], ended=True)


def _cuts(rows: DataFrame, nodes: list[Node], spread: list[int], dims: int) -> list[tuple[int, int, int]]:
    """(node, dimension, last key of the left side) for each node of several shards."""
    search = _widest(rows, nodes, spread, dims)
    open_nodes = dict(search)
    while open_nodes:
        _narrow(rows, open_nodes)
        reached = {n: s for n, s in open_nodes.items() if "asked" not in s and _group(s) is not None}
        if reached:
            _at_group_ends(rows, reached)
            for s in reached.values():
                s["asked"] = True
        open_nodes = {n: s for n, s in open_nodes.items() if s["low"] < s["high"] and "ended" not in s}
    found = []
    for n, s in search.items():
        nearer = s["before"] + s.get("bytes", 0) / 2 <= s["want"]
        found.append((n, s["dim"], s["high"] if nearer else s["low"] - 1))
    return found


def _step(rows: DataFrame, cuts: list[tuple[int, int, int]]) -> DataFrame:
    """Move each row to the child of its node."""
    table = _values(rows.sparkSession, cuts, "node bigint, dim int, cut bigint")
    left = F.element_at("keys", F.col("dim") + 1) <= F.col("cut")
    child = F.when(F.col("dim").isNull(), F.col("node")).otherwise(F.col("node") * 2 + (~left).cast("long"))
    # One cut per node; nodes are fewer than shards.
    moved = rows.join(F.broadcast(table), "node", "left").withColumn("child", child)
    return moved.drop("node", "dim", "cut").withColumnRenamed("child", "node")


def grow(narrow: DataFrame, shards: int) -> tuple[list[list[tuple[int, int, int]]], list[Node]]:
    """The cuts level by level, and the leaves, from rows of (size, keys)."""
    nodes, levels = [Node(1, shards, 0)], []
    first = narrow.select(F.size("keys").alias("n")).first()
    if first is None or shards < 2:
        return levels, nodes
    dims = first["n"]
    ends = narrow.agg(*[f(F.element_at("keys", d + 1)) for d in range(dims) for f in (F.min, F.max)]).first()
    spread = [(ends[2 * d + 1] >> TIE_BITS) - (ends[2 * d] >> TIE_BITS) for d in range(dims)]
    rows = narrow.withColumn("node", F.lit(1).cast("long"))
    for _ in range(math.ceil(math.log2(shards))):
        cuts = _cuts(rows, nodes, spread, dims)
        levels.append(cuts)
        split = {cut[0] for cut in cuts}
        nodes = [
            child
            for node in nodes
            for child in (
                [Node(2 * node.number, node.shards // 2, node.first),
                 Node(2 * node.number + 1, node.shards - node.shards // 2, node.first + node.shards // 2)]
                if node.number in split else [node]
            )
        ]
        rows = materialise(_step(rows, cuts), "kd")
    return levels, nodes


def shard(
    docs: DataFrame, shards: int = 40, *, key: str = "doc_id", text: str = "text", names: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """``doc`` (the row as a struct), size, text_crc32, ``shard``, and ``slot``: gapless places from 0 within the shard."""
    rows, groups = _keyed(docs, key=key, text=text, names=[name for name in names if name in docs.columns])
    groups = materialise(groups, "kd-groups")
    keyed = _with_keys(rows, groups)
    narrow = materialise(_with_keys(rows.select("size", "tie", "mark", "values"), groups), "kd")
    levels, leaves = grow(narrow, shards)

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("node", F.lit(1).cast("long"))
        for cuts in levels:
            rows = _step(rows, cuts)
        table = _values(rows.sparkSession, [(leaf.number, leaf.first) for leaf in leaves], "node bigint, shard int")
        # A shard's documents are numbered group by group, so that no task numbers a whole shard.
        groups = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return rows.join(F.broadcast(table), "node").withColumn("part", F.pmod("tie", F.lit(groups)).cast("int")).drop("node")

    sizes = placed(narrow).groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "text_crc32", "size")) - 1
    return (
        placed(keyed).join(starts, ["shard", "part"])
        .select("doc", "size", "text_crc32", "shard", (F.col("start") + number).cast("long").alias("slot"))
    )


def shards_for(docs: DataFrame, target_bytes: int, *, text: str = "text") -> int:
    """The number of shards at which they reach about ``target_bytes``."""
    total = docs.agg(F.sum(byte_size(F.col(text)))).first()[0] or 0
    return max(1, round(total / target_bytes))
