"""Fact loads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorage.operators.joins import lookup_join, unseen, update_from
from moorage.operators.keys import allocate, allocate_keys, parts_of
from moorage.session import materialise, together
from moorage.sources.store import Draft


@dataclass(frozen=True)
class Lookup:
    """A dimension, the natural key it is found by, and the key it supplies."""

    dim: DataFrame
    natural_key: str
    key: str


def with_dimension_keys(
    rows: DataFrame, lookups: list[Lookup], join: Callable[[DataFrame, DataFrame, str], DataFrame] = lookup_join
) -> DataFrame:
    """Attach the key of every dimension; rows that one of them lacks are lost, as in an inner ``join``."""
    for lookup in lookups:
        rows = join(rows, lookup.dim.select(lookup.natural_key, lookup.key), lookup.natural_key)
    return rows


def upsert(fact: DataFrame, rows: DataFrame, natural_key: str, key: str) -> DataFrame:
    """Update facts by natural id, add unseen ids, keep the rest. ``rows`` is unique on the id."""
    measures = [name for name in fact.columns if name not in (natural_key, key)]
    rows = rows.select(natural_key, *measures)
    kept = update_from(fact, rows, natural_key, measures)
    added = allocate_keys(unseen(rows, fact, natural_key), natural_key, key, fact)
    return kept.unionByName(added.select(*fact.columns))


PART = "_part"


def month_of(date_key: str = "date_key") -> Column:
    """The part of a fact: year and month of its date key."""
    return F.floor(F.col(date_key) / 100).cast("int")


def merge(
    draft: Draft, name: str, rows: DataFrame, like: DataFrame, natural_key: str, key: str, part: Column, ranges: int | None = None,
    measures: DataFrame | None = None,
) -> list[str]:
    """Update facts by natural id and add unseen ids in a table kept in parts; returns the parts that hold the batch.

    ``rows`` is unique on the id and has all columns of ``like`` but the key. Those that ``measures`` has are left out of it: there is one
    row of them for each id, with all that ``part`` needs, and they meet the keys at the write, so they are shuffled once. A narrow table beside the facts holds each id's key and
    part, the latest entry of an id being its present one; it only grows. New ids are numbered over ``ranges`` tasks, if given. So the parts that hold facts of the batch
    are known without reading any: those are rewritten without them, the batch is written to its parts, and all
    other parts stay as they are. An id whose part changes leaves the old one.
    """
    places = f"{name}__places"
    if draft.read(name) is not None and not draft.in_parts(name):
        _into_parts(draft, name, natural_key, key, part)
    own = [column for column in like.columns if column != key and (measures is None or column in rows.columns)]
    rows = rows.select(*own, part.alias(PART))
    known = draft.read(places)
    top = draft.top_key(name) or 0
    if known is None:
        seen, new = None, rows
    else:
        latest = (
            known.join(rows.select(natural_key), natural_key, "left_semi")
            .groupBy(natural_key).agg(F.max_by(F.struct(F.col(key).alias("key"), F.col("part")), "version").alias("_place"))
        )
        placed = materialise(rows.join(latest, natural_key, "left"), "batch")
        seen, new = placed.where("_place IS NOT NULL"), placed.where("_place IS NULL").drop("_place")
    columns = [*[column for column in like.columns if column == key or column in own], PART]
    added, top = allocate(new, natural_key, key, top, ranges)
    batch = added.select(*columns, F.lit(None).cast("int").alias("_from"))
    left: list[str] = []
    if seen is not None:
        batch = batch.unionByName(seen.withColumn(key, F.col("_place.key")).select(*columns, F.col("_place.part").alias("_from")))
        left = [str(row[0]) for row in seen.select("_place.part").distinct().collect()]
    moved = _places(batch.where("_from IS NULL OR _from <> " + PART), natural_key, key, draft.base + 1)
    whole = batch.select(*columns)
    if measures is not None:
        beside = [column for column in like.columns if column not in columns]
        measures = measures.select(natural_key, *beside, part.alias(PART))
        whole = _with_measures(whole, measures, natural_key, key).select(*like.columns, PART)
    # Independent of each other, and all from rows that are written down.
    writes = {
        "batch": lambda: draft.write_parts(whole, PART, name, measures is not None),
        "places": lambda: draft.append(places, moved),
    }
    if left:
        rest = draft.read(name, left).join(seen.select(natural_key), natural_key, "left_anti").withColumn(PART, part)
        writes["rest"] = lambda: draft.write_parts(rest, PART, name)
    done = together(writes)
    replaced: dict[str, str | None] = dict.fromkeys(left) | done.get("rest", {})
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in like.schema)
    draft.put_parts(name, schema, replaced, done["batch"], top)
    return sorted(done["batch"])


#: Rows of a part that go to one task when it is written.
ROWS_A_CELL = 200_000


def _with_measures(keyed: DataFrame, measures: DataFrame, natural_key: str, key: str) -> DataFrame:
    """The keyed rows, each with its measures, dealt by part; parts with many rows go to several tasks.

    Both are dealt by part and hash of the id and meet as one group an id, since a join would deal them by the id alone
    and they would have to be dealt again to be written. One row a part comes to the driver.
    """
    sizes = keyed.groupBy(PART).agg(F.count("*").alias("size")).collect()
    cells = {row[PART]: -(-row["size"] // ROWS_A_CELL) for row in sizes}
    split = {part: number for part, number in cells.items() if number > 1 and part is not None}
    number = F.lit(1)
    if split:
        number = F.coalesce(F.create_map(*[F.lit(value) for pair in split.items() for value in pair])[F.col(PART)], number)
    cell = F.pmod(F.xxhash64(natural_key), number).alias("_cell")
    both = keyed.unionByName(measures, allowMissingColumns=True).select("*", cell)
    values = [name for name in both.columns if name not in (natural_key, PART, "_cell")]
    return (
        both.repartition(max(1, min(sum(cells.values()), parts_of(keyed))), PART, "_cell").groupBy(PART, "_cell", natural_key)
        .agg(*[F.first(name, ignorenulls=True).alias(name) for name in values]).where(F.col(key).isNotNull())
    )


def _places(rows: DataFrame, natural_key: str, key: str, version: int) -> DataFrame:
    return rows.select(natural_key, key, F.col(PART).alias("part"), F.lit(version).cast("bigint").alias("version"))


def _into_parts(draft: Draft, name: str, natural_key: str, key: str, part: Column) -> None:
    """Put a table that was published whole into parts, once."""
    whole = draft.read(name)
    rows = whole.withColumn(PART, part)
    top = whole.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in whole.schema)
    draft.put_parts(name, schema, {}, draft.write_parts(rows, PART, name), top)
    draft.put(f"{name}__places", _places(rows, natural_key, key, draft.base))


def new_facts(fact: DataFrame, rows: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    """The rows with an unseen natural key, with keys above those in use."""
    rows = rows.select(*[name for name in fact.columns if name != key])
    return allocate_keys(unseen(rows, fact, natural_key), natural_key, key, fact).select(*fact.columns)


def insert_only(fact: DataFrame, rows: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    """Add facts with an unseen natural key; later changes to known ones are ignored."""
    return fact.unionByName(new_facts(fact, rows, natural_key, key))


def rebuild(rows: DataFrame, natural_key: list[str], key: str) -> DataFrame:
    return allocate_keys(rows, natural_key, key)


def with_amount(rows: DataFrame) -> DataFrame:
    """The stored ``quantity * unit_price`` column."""
    return rows.withColumn("sales_amount", (F.col("quantity") * F.col("unit_price")).cast("decimal(14,2)"))
