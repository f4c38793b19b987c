"""Type 3: keep the value before the last change in a column of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions.columns import (
    align_names,
    cast_like,
    column as named,
    columns,
    fresh,
    resolve_names,
    typed_null,
    with_key,
    without_key,
)
from dimkeeper.operators.merge import equal_keys, merge
from dimkeeper.plans.batch import BatchProfile, profile_batch
from dimkeeper.plans.lookup import without_match
from dimkeeper.session import stage


def previous_name(column: str) -> str:
    return f"previous_{column}"


def new_rows(
    target: DataFrame, updates: DataFrame, key: str | Sequence[str], limit: int | None = None
) -> DataFrame:
    """Updates whose key the table does not have."""
    key = resolve_names(target, [key] if isinstance(key, str) else key)
    updates = cast_like(align_names(updates, target), target)
    return without_match(updates, target, key, profile_batch(updates, key, limit))


def change_rows(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str],
    column: str,
    null_safe: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """Updates that change ``column`` or bring a new key, with the value before the change.

    Rows that leave ``column`` as it is are dropped even where other columns differ: that
    defines type 3 here. A null on either side is no change unless ``null_safe`` is set.
    Equal rows of the batch count once. An update without a key is new. An update whose key the
    table has several times is returned for each of those rows that it changes.
    """
    key, column, updates = _fit(target, updates, key, column)
    previous = previous_name(column)
    # Distinct before the join: behind it, it would keep Spark from splitting a hot key.
    updates = updates.distinct()
    # Rows without a key have no partner, and in a shuffle would all meet in one task.
    keyless = without_key(updates, key)
    updates = with_key(updates, key)
    profile = profile_batch(updates, key, limit, repeats=False)
    # Changed and new rows exclude each other, so one outer join finds both.
    hit = fresh("_known", target)
    partners = _partners(target, updates, key, column, profile, hit)
    joined = updates.alias("u").join(partners.alias("t"), equal_keys(key), "left")
    known = named(hit, "t")
    found = joined.where(known.isNull() | _differs(column, null_safe)).select(
        "u.*", named(column, "t").alias(previous)
    )
    if keyless is None:
        return found
    return found.unionByName(keyless.withColumn(previous, typed_null(target.schema[column].dataType)))


def apply(
    target: DataFrame,
    updates: DataFrame,
    key: str | Sequence[str],
    column: str,
    null_safe: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The table after the batch, with ``previous_<column>`` added if it is not there yet.

    A changed row takes the values of the batch and keeps the one earlier value. All other
    rows stay, with a null or whatever earlier value they had. Whether rows of the batch are in
    each other's way is decided among those that change something: two of them on one key of the
    table raise an error, and so does one on a key that the table has several times.
    """
    key = resolve_names(target, [key] if isinstance(key, str) else key)
    # Written, because the merge measures its batch before it joins it.
    rows = stage(change_rows(target, updates, key, column, null_safe, limit), "changes")
    known = {c.lower(): c for c in target.columns}
    previous = previous_name(resolve_names(target, [column])[0])
    rows = rows.withColumnRenamed(previous, known.get(previous.lower(), previous))
    return merge(target, rows, key, evolve=True, limit=limit)


def _fit(
    target: DataFrame, updates: DataFrame, key: str | Sequence[str], column: str
) -> tuple[list[str], str, DataFrame]:
    key = resolve_names(target, [key] if isinstance(key, str) else key)
    (column,) = resolve_names(target, [column])
    updates = cast_like(align_names(updates, target), target)
    # The earlier value comes from the table, never from the batch.
    previous = previous_name(column).lower()
    return key, column, updates.select(*columns([c for c in updates.columns if c.lower() != previous]))


def _differs(column: str, null_safe: bool) -> Column:
    old, new = named(column, "t"), named(column, "u")
    return ~old.eqNullSafe(new) if null_safe else old != new


def _partners(
    target: DataFrame, updates: DataFrame, key: list[str], column: str, profile: BatchProfile, hit: str
) -> DataFrame:
    """Key and tracked value of the table; only rows the batch can hit if the batch is small."""
    partners = with_key(target, key).select(*columns([*key, column]), F.lit(True).alias(hit))
    if profile.keys_fit:
        partners = partners.join(profile.keys(updates, key), key, "left_semi")
    return partners
