"""Data-quality checks and the gates that stop a load.

A check is a one-row report ``(rule, code, violations, sample_key)``; reports
union into one table that a gate reads. Only that table, a row per rule,
reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from moorage.operators.joins import lookup_join
from moorage.session import materialise


class LoadError(Exception):
    """A gate's refusal. Codes repeat between loads, so each carries its load's name."""

    def __init__(self, load: str, code: int, message: str):
        super().__init__(f"{load} {code}: {message}")
        self.load, self.code, self.message = load, code, message


@dataclass(frozen=True)
class Rule:
    """A row-level rule; ``broken`` is true for a row that violates it, NULL passes."""

    name: str
    code: int
    broken: Column


def _report(violations: Column, sample: Column, name: str, code: int) -> list[Column]:
    return [
        F.lit(name).alias("rule"),
        F.lit(code).alias("code"),
        F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations"),
        sample.cast("string").alias("sample_key"),
    ]


def _row_metrics(rules: list[Rule], sample_key: str) -> list[Column]:
    """Per rule, how many rows break it and the smallest key of one that does."""
    return [
        *[F.count_if(rule.broken).alias(f"n{i}") for i, rule in enumerate(rules)],
        *[F.min(F.when(rule.broken, F.col(sample_key))).alias(f"k{i}") for i, rule in enumerate(rules)],
    ]


class Watch:
    """Row rules checked by the very write that reads the rows, with no pass of their own.

    Run ``rows`` through an action first; after it, ``gate`` refuses as the gate of `row_rules` does. A rule that no row breaks
    counts none however often a task is repeated.
    """

    def __init__(self, rows: DataFrame, rules: list[Rule], sample_key: str):
        self._rules, self._seen = rules, Observation()
        self.rows = rows.observe(
            self._seen, *_row_metrics(rules, sample_key), F.min(sample_key).alias("low"), F.max(sample_key).alias("high")
        )

    @property
    def bounds(self) -> tuple | None:
        """The smallest and the largest sample key that came by."""
        found = self._seen.get
        return None if found.get("low") is None else (found["low"], found["high"])

    def gate(self, load: str, messages: dict[int, str]) -> None:
        found = self._seen.get
        counts = [(rule, found.get(f"n{i}"), found.get(f"k{i}")) for i, rule in enumerate(self._rules)]
        refuse([(rule.name, rule.code, number, key) for rule, number, key in counts if number], load, messages)


def row_rules(rows: DataFrame, rules: list[Rule], sample_key: str) -> DataFrame:
    """All row-level rules of a table in one pass."""
    counted = rows.agg(*_row_metrics(rules, sample_key))
    lines = F.array(
        *[F.struct(*_report(F.col(f"n{i}"), F.col(f"k{i}"), rule.name, rule.code)) for i, rule in enumerate(rules)]
    )
    return counted.select(F.inline(lines))


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, NULL keys left out, with their number of rows."""
    present = reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])
    return rows.where(present).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def _key_text(keys: list[str]) -> Column:
    return F.concat_ws("/", *[F.col(key).cast("string") for key in keys])


def duplicate_key(rows: DataFrame, keys: list[str], name: str, code: int) -> DataFrame:
    found = duplicates(rows, keys)
    sample = F.min(F.struct(*keys))
    return found.agg(F.count("*").alias("n"), sample.alias("s")).select(
        *_report(F.col("n"), F.concat_ws("/", *[F.col(f"s.{key}").cast("string") for key in keys]), name, code)
    )


def conflicts(rows: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Ids that come with more than one tuple of attributes."""
    tuples = rows.where(F.col(key).isNotNull()).select(key, *attributes).distinct()
    return tuples.groupBy(key).agg(F.count("*").alias("versions")).where("versions > 1")


def conflicting_attributes(rows: DataFrame, key: str, attributes: list[str], name: str, code: int) -> DataFrame:
    return conflicts(rows, key, attributes).agg(F.count("*").alias("n"), F.min(key).alias("s")).select(
        *_report(F.col("n"), F.col("s"), name, code)
    )


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str) -> DataFrame:
    """Foreign keys without a parent and their number of rows.

    The child shrinks to one row per key before it meets the parent.
    """
    used = child.where(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count("*").alias("child_rows"))
    known = parent.select(F.col(primary_key).alias(foreign_key))
    return used.join(known, foreign_key, "left_anti")


def orphans(
    child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str, name: str, code: int
) -> DataFrame:
    lost = orphan_keys(child, foreign_key, parent, primary_key)
    return lost.agg(F.sum("child_rows").alias("n"), F.min(foreign_key).alias("s")).select(
        *_report(F.col("n"), F.col("s"), name, code)
    )


def not_empty(rows: DataFrame, name: str, code: int) -> DataFrame:
    """One violation when there is no row; reads no more than one."""
    found = rows.select(F.lit(1).alias("one")).limit(1)
    return found.agg(F.count("*").alias("n")).select(*_report(1 - F.col("n"), F.lit(None), name, code))


def row_count_is(rows: DataFrame, expected: int | None, name: str, code: int) -> DataFrame:
    """One violation when the count differs, or when the expected count is missing or not positive."""
    broken = F.lit(expected is None or expected <= 0) | (F.col("n") != F.lit(expected if expected is not None else -1))
    return rows.agg(F.count("*").alias("n")).select(
        *_report(F.when(broken, 1).otherwise(0), F.col("n"), name, code)
    )


def counts_match(tables: dict[str, tuple[DataFrame, int | None]], code: int) -> DataFrame:
    """Staged tables against the counts their copies reported; a count that was not given is not compared."""
    given = {name: pair for name, pair in tables.items() if pair[1] is not None}
    reports = [
        rows.agg(F.count("*").alias("n")).select(
            *_report(F.when(F.col("n") != expected, 1).otherwise(0), F.col("n"), f"{name}_count", code)
        )
        for name, (rows, expected) in given.items()
    ]
    return all_of(reports)


def no_rows(rows: DataFrame, sample_key: str, name: str, code: int) -> DataFrame:
    """Every row is a violation."""
    return rows.agg(F.count("*").alias("n"), F.min(sample_key).alias("s")).select(
        *_report(F.col("n"), F.col("s"), name, code)
    )


def same_count(rows: DataFrame, others: DataFrame, name: str, code: int) -> DataFrame:
    """Rows by which two tables differ in size."""
    sizes = rows.agg(F.count("*").alias("n")).unionAll(others.agg((-F.count("*")).alias("n")))
    return sizes.agg(F.abs(F.sum("n")).alias("n")).select(*_report(F.col("n"), F.lit(None), name, code))


def primary_key(rows: DataFrame, keys: list[str], name: str, code: int) -> DataFrame:
    """Repeated keys plus rows with a NULL in the key."""
    missing = reduce(lambda a, b: a | b, [F.col(key).isNull() for key in keys])
    return all_of(
        [
            duplicate_key(rows, keys, f"{name}_unique", code),
            row_rules(rows.withColumn("_key", _key_text(keys)), [Rule(f"{name}_not_null", code, missing)], "_key"),
        ]
    )


def required(columns: list[str], code: int) -> list[Rule]:
    return [Rule(f"{column}_required", code, F.col(column).isNull()) for column in columns]


def longest(lengths: dict[str, int], code: int) -> list[Rule]:
    return [Rule(f"{column}_length", code, F.char_length(column) > size) for column, size in lengths.items()]


# Codes of the database's own refusals.
NOT_NULL, CHECK, UNIQUE, TOO_LONG = 515, 547, 2627, 2628
CONTRACT_MESSAGES = {
    NOT_NULL: "A required column is NULL", UNIQUE: "A key is repeated", TOO_LONG: "A text is too long",
    CHECK: "A value is outside its range",
}


def contract_rules(needed: list[str], lengths: dict[str, int], checks: tuple[Rule, ...] = ()) -> list[Rule]:
    return [*required(needed, NOT_NULL), *longest(lengths, TOO_LONG), *checks]


def contract(
    rows: DataFrame, key: str, needed: list[str], lengths: dict[str, int], checks: tuple[Rule, ...] = (),
    unique: tuple[str, ...] = (),
) -> DataFrame:
    """Required columns, text lengths and checks of a staged table in one pass, and its key if it has one."""
    rules = contract_rules(needed, lengths, checks)
    keyed = [duplicate_key(rows, list(unique), f"{key}_unique", UNIQUE)] if unique else []
    return all_of([row_rules(rows, rules, key), *keyed])


def same_columns(load: str, rows: DataFrame, columns: list[str]) -> None:
    """Refuse a staged table that lacks a column of its contract."""
    if missing := [name for name in columns if name not in rows.columns]:
        raise LoadError(load, 207, f"Columns missing from the staged table: {', '.join(missing)}")


def schema_differences(actual: DataFrame, contract: dict[str, str]) -> list[tuple[str, str]]:
    """Columns missing from, added to or typed differently than the contract."""
    found = {field.name: field.dataType.simpleString() for field in actual.schema}
    problems = [(name, "missing") for name in contract if name not in found]
    problems += [(name, "unexpected") for name in found if name not in contract]
    problems += [(name, f"type {found[name]}") for name in contract if name in found and found[name] != contract[name]]
    return sorted(problems)


def all_of(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def gate(report: DataFrame, load: str, messages: dict[int, str]) -> None:
    """Raise for the first broken code in the order of ``messages``, naming every rule broken under it."""
    found = report.where("violations > 0").select("rule", "code", "violations", "sample_key")
    refuse([tuple(row) for row in found.collect()], load, messages)  # one row per rule


def refuse(found: list[tuple], load: str, messages: dict[int, str]) -> None:
    """The gate's refusal of broken rules (name, code, violations, sample key)."""
    broken: dict[int, list[str]] = {}
    for name, code, violations, sample in sorted(found, key=lambda row: (row[1], row[0])):
        broken.setdefault(code, []).append(f"{violations} x {name}, e.g. {sample}")
    for code, message in messages.items():
        if code in broken:
            raise LoadError(load, code, f"{message} ({'; '.join(broken[code])})")


def lookup_left(rows: DataFrame, lookup: DataFrame, on: str, marker: str) -> DataFrame:
    """Left lookup that marks the rows it found."""
    return lookup_join(rows, lookup.withColumn(marker, F.lit(True)), on, "left")


def lookup_marks(rows: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left lookup of marks, the columns of ``lookup`` beside ``on``, each true or null.

    The rows shrink to their keys, and only keys that lack a mark, normally none, are written down and meet the rows.
    """
    marks = [name for name in lookup.columns if name != on]
    used = rows.where(F.col(on).isNotNull()).select(on).distinct()
    lacks = reduce(lambda a, b: a | b, [F.col(mark).isNull() for mark in marks])
    lacking = materialise(lookup_join(used, lookup, on, "left").where(lacks), f"lacking-{on}")
    joined = lookup_join(rows, lacking.select(on, F.lit(True).alias("_lacks"), *[F.col(m).alias(f"_own_{m}") for m in marks]), on, "left")
    found = lambda mark: F.when(F.col("_lacks"), F.col(f"_own_{mark}")).when(F.col(on).isNotNull(), True)
    return joined.select(*rows.columns, *[found(mark).alias(mark) for mark in marks])
