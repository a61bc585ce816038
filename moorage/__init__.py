"""Warehouse loads, data-quality gates and API-log analytics as PySpark jobs."""
