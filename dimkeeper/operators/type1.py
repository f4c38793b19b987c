"""Type 1: overwrite the row of a known key, insert the row of a new one. No history is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dimkeeper.operators.merge import merge


def upsert(
    target: DataFrame, updates: DataFrame, key: str | Sequence[str], limit: int | None = None
) -> DataFrame:
    """The table after the batch: every row the batch names is replaced, the rest is kept.

    The plan is ``table anti-join batch keys`` plus the batch. With a batch below the
    broadcast limit the table is read once and not shuffled.
    """
    return merge(target, updates, key, limit=limit)
