"""Keys that hold a large part of a table.

Spark splits a hot key of an inner or one-sided join, but not of a full outer join. Such keys are
few by definition. A sketch finds them in one job, whatever the table's size and number of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions.columns import with_key
from dimkeeper.plans.filter import equal_by_hash, key_hash

#: A key is heavy if it has more than one in so many of a table's rows, and so many rows at least.
HEAVY, HEAVY_ROWS = 200, 10_000
SKETCH_ITEMS = 10_000


def heavy_keys(table: DataFrame, on: Sequence[str]) -> list[int]:
    """Hashes of the keys that hold more than one in ``HEAVY`` of the table's rows, so fewer than that.

    One job over the key columns counts with a sketch of bounded size. Nothing is found where
    hashes do not tell keys apart, or where no key has ``HEAVY_ROWS``.
    """
    if not equal_by_hash(table, on):
        return []
    top = F.call_function("approx_top_k", F.col("hash"), F.lit(HEAVY), F.lit(SKETCH_ITEMS))
    hashes = with_key(table, on).select(key_hash(on).alias("hash"))
    found = hashes.agg(F.count(F.lit(1)).alias("rows"), top.alias("top")).first()
    most = max(HEAVY_ROWS, found["rows"] // HEAVY)
    return [x["item"] for x in found["top"] or [] if x["count"] > most]
