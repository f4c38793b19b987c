"""The keys of an update batch, as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions.columns import with_key


def batch_keys(updates: DataFrame, key: str) -> DataFrame:
    """Every key of the batch with the number of rows that carry it; nulls are dropped.

    This holds what a list collected from the column would hold, but spread over the
    cluster, so it can be joined however many keys there are.
    """
    return with_key(updates, [key]).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
