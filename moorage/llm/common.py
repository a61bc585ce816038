"""What the operators share: reading tables, row-wise Arrow maps, digests."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
PLAIN_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def schema_of(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


#: Rows of an Arrow batch that are Python objects at a time.
PIECE = 500


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, PIECE):
        yield batch.slice(start, PIECE)


def map_rows(frame: DataFrame, columns: list[str], function: Callable[..., tuple], schema: str) -> DataFrame:
    """One output row per input row: ``function(*values)`` gives the values of ``schema``.

    Works piece by piece, so a task holds one Arrow batch and few Python rows at a time. Only
    ``columns`` are read; other columns of the frame never reach Python.
    """
    target = schema_of(schema)
    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            rows = [function(*values) for values in zip(*(column.to_pylist() for column in batch.columns))]
            made = zip(*rows) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(values), kind.type) for values, kind in zip(made, arrow)], schema=arrow
            )

    return frame.select(*columns).mapInArrow(run, target)


def keep_rows(frame: DataFrame, column: str, verdict: Callable[[list], list[bool]]) -> DataFrame:
    """The rows for which ``verdict`` of the column's values is true, all columns as they are."""
    place = frame.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole)):
            yield batch.filter(pa.array(verdict(batch.column(place).to_pylist()), pa.bool_()))

    return frame.mapInArrow(run, frame.schema)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


#: Bytes: A-Z to a-z, every other ASCII byte outside 0-9 and a-z to a blank.
PLAIN_TABLE = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32
    for code in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return (text or "").encode().translate(PLAIN_TABLE).split()


def blank_words(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of the text, as UTF-8."""
    return (text or "").encode().split()


def split_words(text: Column, breaks: str) -> Column:
    """The same words as a column of strings; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), breaks), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def identity(*columns: Column) -> Column:
    """A struct (mark, check) of two hashes, never null, that equal rows share; 96 bits keep others apart."""
    return F.struct(F.xxhash64(*columns).alias("mark"), F.hash(*columns).alias("check"))
