"""Places within groups, and joins with a table of unique keys, both without a hot task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimkeeper.plans.numbering import PLACE_BITS
from dimkeeper.session import stage

#: A key counts as hot if it has more than one part in so many of all rows. So there are fewer
#: hot keys than this, whatever the input, and their rows may be broadcast.
HOT_KEYS = 1000


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``rank`` (from 0, within the group, nulls first) and ``n`` (rows of the group).

    A group may be of any size: rows are dealt out by range, so a large group takes several tasks,
    and a row's rank is its place in its task plus the group's rows in earlier tasks. The table of
    those runs has one row per task and group. Group columns hold no nulls. ``df`` is read
    twice, so it should be a written table. Equal rows have some order among them.
    """
    sort = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    # Written, because range bounds come from a sample and both uses must see the same places.
    placed = stage(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("_task", F.shiftright("_place", PLACE_BITS))
    runs = placed.groupBy("_task", *group).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_task",
        *group,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(Window.partitionBy(*group)).alias("n"),
    )
    return placed.join(runs, ["_task", *group]).select(
        *df.columns, (F.col("_place") + F.col("_shift")).alias("rank"), "n"
    )


def join_unique(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` with the one row that ``table`` has for each key.

    ``weight`` is a column of the table: how many rows have its key. Keys with a large part of all
    rows are joined where the rows are, by a broadcast of fewer than ``HOT_KEYS`` rows; the others by
    a shuffle, in which no key has more than that part. Both frames should be written tables.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * HOT_KEYS > total
    hot, cold = table.where(is_hot), table.where(~is_hot)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(cold, key))
