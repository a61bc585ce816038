"""Table sources and staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, folder: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """Named columns of one table; the select reaches the Parquet reader."""
    rows = spark.read.parquet(f"{folder}/{table}.parquet")
    return rows.select(*columns) if columns else rows


def spread(rows: DataFrame, parts: int) -> DataFrame:
    """Deal rows out to ``parts`` tasks, by their content, before costly work per row such as parsing documents."""
    return rows.repartition(parts, *rows.columns)


def scan_jdbc(spark: SparkSession, url: str, query: str, split: tuple[str, int, int, int] | None = None, **options):
    """Rows of a database query; ``split`` is (column, lowest, highest, parts) for a parallel read."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if split is None:
        return reader.option("query", query).load()
    column, lowest, highest, parts = split
    return (
        reader.option("dbtable", f"({query}) source")
        .option("partitionColumn", column)
        .option("lowerBound", lowest)
        .option("upperBound", highest)
        .option("numPartitions", parts)
        .load()
    )


def inline(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A literal row source with declared types."""
    return spark.createDataFrame(rows, schema)


def mapped(rows: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Apply a map of sink column to (source column, type); a missing source column fails."""
    return rows.select(*[F.col(source).cast(kind).alias(sink) for sink, (source, kind) in columns.items()])


def prefixed(rows: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Put a prefix on every column but the kept ones."""
    return rows.select(*[F.col(name) if name in keep else F.col(name).alias(prefix + name) for name in rows.columns])


def with_defaults(rows: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill columns that are missing, or NULL, with their default."""
    return rows.withColumns(
        {
            name: F.coalesce(F.col(name), default) if name in rows.columns else default
            for name, default in defaults.items()
        }
    )


def stage(rows: DataFrame, path: str) -> DataFrame:
    """Replace a staging table, so that a retry never doubles it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def stage_counted(rows: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Replace a staging table and return the number of rows copied, counted during the write."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), seen.get["rows"]


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, rows in tables.items()]
    stacked = counts[0]
    for one in counts[1:]:
        stacked = stacked.unionByName(one)
    return stacked


def one_row(totals: dict[str, DataFrame]) -> DataFrame:
    """Put several one-row, one-column totals side by side without a join."""
    stacked = None
    for name, total in totals.items():
        row = total.select(F.col(total.columns[0]).alias(name))
        stacked = row if stacked is None else stacked.unionByName(row, allowMissingColumns=True)
    return stacked.agg(*[F.max(name).alias(name) for name in totals])
