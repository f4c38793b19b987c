"""Tables of fixed size that tell which hashes may occur more often than a limit.

A table has one bit per place, and a hash has one place. A hash above the limit always finds
its bit set; one below may find it set by another. So a table may only be used to leave out work
for hashes that are surely rare, or to put hashes in some order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places in a table: 8 MB each, whatever the input. The fuller it is, the less work it saves.
TABLE_BITS = 26
U64 = np.uint64


def frequency_tables(counted: DataFrame, limits: Sequence[int]) -> list[np.ndarray]:
    """One table per limit, ascending, of the hashes whose ``df`` adds up to more.

    ``counted`` has columns hash and df (long). At most 2**20 rows reach the driver.
    """
    df = counted.groupBy("hash").agg(F.sum("df").alias("df")).where(F.col("df") > limits[0])
    place = F.col("hash").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    bit = F.expr("shiftleft(1L, CAST(hash & 63 AS INT))")
    bits = [F.bit_or(F.when(F.col("df") > x, bit).otherwise(F.lit(0))).alias(f"l{x}") for x in limits]
    rows = df.groupBy(F.shiftright(place, 6).alias("word")).agg(*bits).toArrow()
    tables = np.zeros((len(limits), 1 << (TABLE_BITS - 6)), np.int64)
    for table, x in zip(tables, limits, strict=True):
        table[rows["word"].to_numpy()] = rows[f"l{x}"].to_numpy()
    return [t.view(U64) for t in tables]


def levels_passed(value: np.ndarray, tables: Sequence[np.ndarray]) -> np.ndarray:
    """In how many of the tables each hash finds its bit set."""
    place = value & U64((1 << TABLE_BITS) - 1)
    word, bit = (place >> U64(6)).astype(np.int64), place & U64(63)
    return sum((t[word] >> bit) & U64(1) for t in tables).astype(np.int64)


def may_hold(tables: Sequence[np.ndarray], column: str, df: DataFrame) -> Column:
    """Whether a column's hashes (long, not null) find their bit in any of the tables; no other column
    leaves the JVM."""
    shared = df.sparkSession.sparkContext.broadcast(tables)

    @F.arrow_udf("boolean")
    def found(hashes: pa.Array) -> pa.Array:
        return pa.array(levels_passed(hashes.to_numpy(zero_copy_only=False).view(U64), shared.value) > 0)

    return found(F.col(column))
