"""Run a query on Spark and its SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        return ("number", float(value))
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)):
        return ("number", "nan" if isinstance(value, float) and math.isnan(value) else round(float(value), 6))
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return repr(value)


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(frame, sql: str, connection: duckdb.DuckDBPyConnection) -> tuple[int, str]:
    """Number of rows and, if the two sides differ, a description of how."""
    found = connection.execute(sql)
    names = [entry[0] for entry in found.description]
    types = {entry[0]: str(entry[1]) for entry in found.description}
    wanted = rows_of(names, found.fetchall())
    if sorted(frame.columns) != sorted(names):
        return 0, f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = rows_of(frame.columns, frame.collect())
    note = ""
    if actual != wanted:
        note = (
            f"only spark {list((actual - wanted).items())[:3]} only sql {list((wanted - actual).items())[:3]} "
            f"rows {sum(actual.values())}/{sum(wanted.values())}"
        )
    for name, kind in frame.dtypes:
        if kind == "date" or types[name] == "DATE" or kind.startswith(("array", "struct", "map", "double")):
            note += f" type of {name}: {kind}/{types[name]}"
        if kind.startswith("decimal") and kind.upper() != types[name].replace(" ", "").upper():
            note += f" type of {name}: {kind}/{types[name]}"
        if kind in ("int", "bigint", "smallint") and types[name] in ("DOUBLE", "HUGEINT"):
            note += f" type of {name}: {kind}/{types[name]}"
    return sum(actual.values()), note
