"""Every query the library offers over the given tables, with its SQL twin."""

from moorage.catalog import aggregates, columns, filters, joins, loads, payloads, quality, runlogs, tables  # noqa: F401
from moorage.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
