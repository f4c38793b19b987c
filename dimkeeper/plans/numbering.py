"""Gapless numbers in sort order without a global window.

``row_number() over (order by ...)`` brings every row into one task. Here the rows are
range-partitioned and sorted once and written to the shared folder together with their
position. The partitions' sizes are then added up, one row per partition, and a
row's number is its partition's offset plus its place in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimkeeper.functions.columns import column, columns, fresh
from dimkeeper.session import stage

# monotonically_increasing_id() keeps the partition above bit 33 and the row's place below.
PLACE_BITS = 33


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    number: str,
    start: DataFrame | int = 0,
) -> DataFrame:
    """Add ``number`` (bigint), counting up from ``start`` in the given order.

    ``start`` may be a frame of one row and one column, such as the next free id of a
    table; it is read inside the plan. ``number`` may replace a column used for sorting.
    """
    spark = df.sparkSession
    at, part, offset, n = (fresh(c, df) for c in ("_placed", "_part", "_offset", "_n"))
    # Range bounds come from a sample that differs between runs, so the placed rows are
    # written before they are counted: both uses below must see the same partitions.
    placed = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(at, F.monotonically_increasing_id()),
        "numbered",
    )
    partition = F.shiftright(at, PLACE_BITS)
    place = F.col(at).bitwiseAND(F.lit(2**PLACE_BITS - 1))
    if isinstance(start, DataFrame):
        base = start.select(F.lit(-1).cast("long").alias(part), column(start.columns[0]).alias(n))
    else:
        base = spark.range(1).select(
            F.lit(-1).cast("long").alias(part), F.lit(start).cast("long").alias(n)
        )
    sizes = (
        placed.groupBy(partition.alias(part)).agg(F.count(F.lit(1)).alias(n)).unionByName(base)
    )
    # One row per written partition plus the start: bounded by the number of shuffle
    # partitions, whatever the number of rows.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(part, F.sum(n).over(before).alias(offset))
    numbered = placed.withColumn(part, partition).join(F.broadcast(offsets), part)
    value = (F.col(offset) + place).cast("long").alias(number)
    kept = [c for c in df.columns if c != number]
    return numbered.select(value, *columns(kept))
