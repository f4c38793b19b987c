"""Key lookups between a large table and an update batch.

Both forms keep the large table in place when the batch is small: the batch's keys are
broadcast to it, and only the few keys found there travel back. Beyond the limit they
become shuffle joins, where the table's keys are made distinct on the map side first, so
a key that fills a third of the table reaches the join as one row. Keys that the batch surely does
not have are left out before (:mod:`dimkeeper.plans.filter`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from dimkeeper.functions.columns import columns, with_key, without_key
from dimkeeper.plans.batch import BatchProfile
from dimkeeper.plans.filter import may_match
from dimkeeper.session import stage


def matched_keys(
    table: DataFrame, updates: DataFrame, on: Sequence[str], profile: BatchProfile
) -> DataFrame:
    """The keys of the table that the batch may hit, each once.

    With a small batch these are exactly the keys found in both. Otherwise further keys of the
    table are returned and the join that follows does the selection.
    """
    keys = with_key(table, on).select(*columns(on))
    if profile.keys_fit:
        keys = keys.join(profile.keys(updates, on), list(on), "left_semi")
    else:
        possible = may_match(table, updates, on, profile)
        keys = keys if possible is None else keys.where(possible)
    return keys.distinct()


def without_match(
    updates: DataFrame, table: DataFrame, on: Sequence[str], profile: BatchProfile
) -> DataFrame:
    """Rows of the batch that have no partner in the table; a null key never has one."""
    found = matched_keys(table, updates, on, profile)
    if profile.repeated_keys and not profile.keys_fit:
        # A hot key of the batch: Spark splits it if both sides of the join come straight
        # from an exchange, so the keys found are reduced to the batch's and written first.
        found = stage(found.join(profile.keys(updates, on), list(on), "left_semi"), "found")
    if not profile.null_keys:
        return updates.join(found, list(on), "left_anti").select(*columns(updates.columns))
    # Rows without a key would all meet in one task; they need no lookup.
    fresh = with_key(updates, on).join(found, list(on), "left_anti")
    return fresh.select(*columns(updates.columns)).unionByName(without_key(updates, on))
