"""A filter of bounded size before a join: rows whose key can't be on the other side never reach its shuffle.

The other side's 64-bit keys set two bits each in a bitmap, which goes out to the tasks whole. It has at least 16 bits a key, but 2 to the
power ``MOST`` (16 MB) at most. Every row whose key is on the other side passes, and so do some others, more as the bitmap fills up, which
the join itself then drops; beyond one key for two bits it would hold nothing back, and all rows pass without being read. So the
rows of the join are the same at any size. A null key never counts as on the other side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST, MOST, PIECE = 16, 27, 16
"""Powers of two: bits of the smallest and the largest bitmap, bits of a piece of it that one task puts together."""


class Members:
    """The bitmap of a table's keys."""

    def __init__(self, keys: DataFrame, column: str):
        number = keys.count()
        self.bits, self.power = None, min(MOST, max(LEAST, (16 * number - 1).bit_length() if number else 0))
        if 2 * number > 1 << MOST:
            return
        key, mask = F.col(column), (1 << self.power) - 1
        place = F.explode(F.array(key.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(key, MOST).bitwiseAND(F.lit(mask)))).alias("place")
        places = keys.where(key.isNotNull()).select(place).distinct().select(
            F.shiftright("place", PIECE).cast("int").alias("piece"), F.col("place").bitwiseAND((1 << PIECE) - 1).cast("int").alias("bit")
        )

        def packed(group: pa.Table) -> pa.Table:
            bits = np.zeros(1 << PIECE, np.uint8)
            bits[group.column("bit").to_numpy()] = 1
            return pa.table({
                "piece": pa.array([group.column("piece")[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()),
            })

        self.bits = np.zeros(1 << (self.power - 3), np.uint8)
        size = 1 << (PIECE - 3)
        for row in places.groupBy("piece").applyInArrow(packed, "piece int, bits binary").toLocalIterator():
            self.bits[row["piece"] * size : (row["piece"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)

    def possible(self, keys: np.ndarray) -> np.ndarray:
        """Whether each key may be in the table; false is certain."""
        if self.bits is None:
            return np.ones(len(keys), bool)
        keys, mask = keys.astype(np.int64).view(np.uint64), np.uint64((1 << self.power) - 1)
        found = np.ones(len(keys), bool)
        for places in (keys & mask, (keys >> np.uint64(MOST)) & mask):
            places = places.astype(np.int64)
            found &= (self.bits[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1 == 1
        return found

    def among(self, batch: pa.RecordBatch, place: int, inside: bool = True) -> pa.RecordBatch:
        """The rows of a batch whose key, in the column at ``place``, may be in the table, or the others."""
        keys = batch.column(place)
        found = self.possible(keys.fill_null(0).to_numpy(zero_copy_only=False)) & ~keys.is_null().to_numpy(zero_copy_only=False)
        return batch.filter(pa.array(found == inside))

    def keep(self, frame: DataFrame, column: str) -> DataFrame:
        """The rows whose key may be in the table; all columns as they are."""
        if self.bits is None:
            return frame
        place = frame.columns.index(column)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield self.among(batch, place)

        return frame.mapInArrow(run, frame.schema)
