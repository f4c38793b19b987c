"""Connected components of a graph given as a table of edges, by alternating stars.

Each round links every node's larger neighbours to its smallest one, then every node's smaller
neighbours. Rounds are written to the shared folder; edges never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.session import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it is connected with, for every node of an edge.

    ``edges`` has columns ``u`` and ``v`` (long). Repeated edges and loops do no harm; nulls are
    left out. No edges: no rows.
    """
    pairs = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    now = stage(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = stage(large.where("u > v").distinct(), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u > v")
        now = stage(small.distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())
