"""Merge a batch of updates into a table.

Plain parquet has no MERGE. The new state of the table is computed from joins chosen by
the measured size of the batch and is returned; writing it is the caller's decision
(:mod:`dimkeeper.sources.publish`). Measuring runs one job, looking up repeated keys three more.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.functions.columns import (
    align_names,
    cast_like,
    column,
    columns,
    fresh,
    has_key,
    resolve_names,
    typed_null,
    with_key,
    without_key,
)
from dimkeeper.plans.batch import BatchProfile, profile_batch
from dimkeeper.plans.filter import equal_by_hash, key_hash, may_match
from dimkeeper.plans.heavy import heavy_keys
from dimkeeper.plans.lookup import matched_keys, without_match
from dimkeeper.session import stage

ALL = "all"


class AmbiguousMatchError(ValueError):
    """Several update rows hit the same row of the table."""


class SchemaMismatchError(ValueError):
    """The columns of the batch do not fit the table."""


def merge(
    target: DataFrame,
    updates: DataFrame,
    on: str | Sequence[str],
    matched: str | Mapping[str, Column | str] | None = ALL,
    not_matched: str | None = ALL,
    evolve: bool = False,
    matched_when: Column | None = None,
    full_outer: bool = False,
    limit: int | None = None,
    profile: BatchProfile | None = None,
) -> DataFrame:
    """Return ``target`` after merging ``updates`` on equal keys.

    ``matched``      ``"all"`` overwrites every column the batch has, a mapping sets single
                     columns to expressions over ``t`` (table) and ``u`` (updates), None
                     leaves matched rows alone.
    ``not_matched``  ``"all"`` inserts update rows without a partner, None drops them.
    ``evolve``       adds columns only the batch has. Columns only the table has then keep
                     their value on update and are null on insert.
    ``matched_when`` an extra condition over ``t`` and ``u``; where it is not true, the
                     matched row stays as it is.
    ``full_outer``   one full outer join instead of two one-sided ones. It shuffles the
                     table once, but Spark cannot split a hot key in it. So keys that hold a
                     large part of the table are found first and merged by one-sided joins.
    ``limit``        broadcast limit in bytes, by default the session's.
    ``profile``      the batch's measurements, if the caller took them already.

    The batch is read more than once. If it is the outcome of costly work, write it first
    (:func:`dimkeeper.session.stage`).

    A null in the key matches nothing. Raises :class:`AmbiguousMatchError` when two update
    rows hit one row of the table; repeated keys that hit nothing are all inserted.
    """
    on = [on] if isinstance(on, str) else list(on)
    on = resolve_names(target, on)
    target, updates = fit(target, updates, on, evolve, partial=matched != ALL and not_matched != ALL)
    whole = matched == ALL and matched_when is None and set(target.columns) <= set(updates.columns)
    replaces = whole and not_matched == ALL and not full_outer
    if profile is None:
        joins_rows = matched is not None and not replaces and not full_outer
        profile = profile_batch(updates, on, limit, rows=joins_rows)
    if matched is not None and profile.repeated_keys:
        _refuse_ambiguous(target, updates, on, profile.limit)

    if matched is None:
        kept = target
    elif full_outer:
        heavy = heavy_keys(target, on) if equal_by_hash(updates, on) else []
        if not heavy:
            return _full_outer(target, updates, on, matched, not_matched, matched_when)
        # The batch has at most one row for each of them, so it goes to where the table's rows are.
        hot = has_key(on) & key_hash(on).isin(heavy)
        rest = _full_outer(target.where(~hot), updates.where(~hot), on, matched, not_matched, matched_when)
        return rest.unionByName(_heavy(target.where(hot), updates.where(hot), on, matched, not_matched, matched_when, limit))
    elif replaces:
        # Update all, insert all: whatever the batch names is replaced by the batch.
        kept = _unmatched_rows(target, updates, on, profile)
        return kept.select(*columns(target.columns)).unionByName(updates)
    else:
        kept = _updated(target, updates, on, matched, matched_when, profile)

    if not_matched != ALL:
        return kept
    new = without_match(updates, target, on, profile)
    return kept.unionByName(_as_inserts(new, target))


def ambiguous_keys(
    target: DataFrame, updates: DataFrame, on: str | Sequence[str], limit: int | None = None
) -> DataFrame:
    """Keys that several update rows share and that exist in ``target``, with their count."""
    on = [on] if isinstance(on, str) else list(on)
    on = resolve_names(target, on)
    updates = cast_like(align_names(updates, target), target)
    return _ambiguous(target, updates, on, limit)


def fit(
    target: DataFrame,
    updates: DataFrame,
    on: Sequence[str],
    evolve: bool,
    partial: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Bring names and types of the batch in line with the table, adding columns if allowed.

    ``partial`` accepts a batch that lacks columns of the table, for merges that neither
    insert nor overwrite whole rows.
    """
    updates = align_names(updates, target)
    resolve_names(updates, on)
    extra = [f for f in updates.schema if f.name not in target.columns]
    missing = [c for c in target.columns if c not in updates.columns]
    if not evolve and not partial and (extra or missing):
        raise SchemaMismatchError(
            f"the batch adds {[f.name for f in extra]} and lacks {missing}; "
            "pass evolve=True to allow it"
        )
    if evolve and extra:
        target = target.select("*", *[typed_null(f.dataType).alias(f.name) for f in extra])
    return target, cast_like(updates, target)


def _ambiguous(
    target: DataFrame, updates: DataFrame, on: list[str], limit: int | None
) -> DataFrame:
    """Only repeated keys are looked up, so their number decides how the table is searched."""
    keys = with_key(updates, on).groupBy(*columns(on))
    repeated = keys.agg(F.count(F.lit(1)).alias("matches")).where(F.col("matches") > 1)
    repeated = stage(repeated, "repeated")
    profile = profile_batch(repeated, on, limit, repeats=False)
    return repeated.join(matched_keys(target, repeated, on, profile), on, "left_semi")


def _refuse_ambiguous(target: DataFrame, updates: DataFrame, on: list[str], limit: int) -> None:
    found = (
        _ambiguous(target, updates, on, limit)
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*columns(on))).alias("example"))
        .first()
    )
    if found["n"]:
        raise AmbiguousMatchError(
            f"{found['n']} keys of the table are hit by several update rows, such as "
            f"{found['example'].asDict()}"
        )


def _unmatched_rows(
    target: DataFrame, updates: DataFrame, on: list[str], profile: BatchProfile
) -> DataFrame:
    keys = profile.keys(updates, on)
    if profile.keys_fit:
        return target.join(keys, on, "left_anti")
    possible = may_match(target, updates, on, profile)
    if possible is not None:
        kept = target.where(possible).join(keys, on, "left_anti")
        return kept.select(*columns(target.columns)).unionByName(target.where(~possible))
    # Shuffle join: rows without a key match nothing, and all of them would land in one
    # task, so they bypass it. Parquet statistics make the second scan cheap.
    kept = with_key(target, on).join(keys, on, "left_anti")
    keyless = without_key(target, on)
    return kept if keyless is None else kept.unionByName(keyless)


def _updated(
    target: DataFrame,
    updates: DataFrame,
    on: list[str],
    matched: str | Mapping[str, Column | str],
    matched_when: Column | None,
    profile: BatchProfile,
) -> DataFrame:
    """All rows of the table, matched ones changed. The table is the streamed, splittable side."""
    partners = with_key(updates, on)
    if profile.repeated_keys:
        # The ambiguity check has passed, so repeated keys hit nothing and any row stands for them.
        partners = partners.dropDuplicates(on)
        if not profile.rows_fit:
            # Straight from a file, so that Spark can split a hot key of the table.
            partners = stage(partners, "partners")
    hit = fresh("_hit", target, updates)
    partners = partners.withColumn(hit, F.lit(True))
    if profile.rows_fit:
        joined = target.alias("t").join(F.broadcast(partners).alias("u"), equal_keys(on), "left")
        return joined.select(*_changed(target, updates, on, matched, matched_when, hit))
    possible = may_match(target, updates, on, profile)
    able = with_key(target, on) if possible is None else target.where(possible)
    joined = able.alias("t").join(partners.alias("u"), equal_keys(on), "left")
    changed = joined.select(*_changed(target, updates, on, matched, matched_when, hit))
    if possible is not None:
        return changed.unionByName(target.where(~possible))
    keyless = without_key(target, on)
    return changed if keyless is None else changed.unionByName(keyless)


def _heavy(
    target: DataFrame,
    updates: DataFrame,
    on: list[str],
    matched: str | Mapping[str, Column | str],
    not_matched: str | None,
    matched_when: Column | None,
    limit: int | None,
) -> DataFrame:
    """Every row of the table changed where it lies, then the rows of the batch without a partner."""
    profile = profile_batch(updates, on, limit, rows=True)
    changed = _updated(target, updates, on, matched, matched_when, profile)
    if not_matched != ALL:
        return changed
    return changed.unionByName(_as_inserts(without_match(updates, target, on, profile), target))


def _full_outer(
    target: DataFrame,
    updates: DataFrame,
    on: list[str],
    matched: str | Mapping[str, Column | str],
    not_matched: str | None,
    matched_when: Column | None,
) -> DataFrame:
    here, hit = fresh("_here", target, updates), fresh("_hit", target, updates)
    left = with_key(target, on).withColumn(here, F.lit(True)).alias("t")
    right = with_key(updates, on).withColumn(hit, F.lit(True)).alias("u")
    joined = left.join(right, equal_keys(on), "full" if not_matched == ALL else "left")
    known = column(here, "t")
    changed = _changed(target, updates, on, matched, matched_when, hit)
    result = joined.select(
        *[
            F.when(known, new).otherwise(
                column(c, "u") if c in updates.columns else typed_null(target.schema[c].dataType)
            ).alias(c)
            for c, new in zip(target.columns, changed)
        ]
    )
    keyless = without_key(target, on)
    if keyless is not None:
        result = result.unionByName(keyless)
    keyless = without_key(updates, on)
    if not_matched == ALL and keyless is not None:
        result = result.unionByName(_as_inserts(keyless, target))
    return result


def _changed(
    target: DataFrame,
    updates: DataFrame,
    on: list[str],
    matched: str | Mapping[str, Column | str],
    matched_when: Column | None,
    hit: str,
) -> list[Column]:
    """The columns of the table after a left or full join of ``t`` and ``u``."""
    if matched == ALL:
        new = {c: column(c, "u") for c in target.columns if c in updates.columns and c not in on}
    else:
        names = resolve_names(target, list(matched))
        values = [F.expr(v) if isinstance(v, str) else v for v in matched.values()]
        new = dict(zip(names, values))
    change = column(hit, "u")
    change = change if matched_when is None else change & matched_when
    return [
        F.when(change, new[f.name].cast(f.dataType)).otherwise(column(f.name, "t")).alias(f.name)
        if f.name in new
        else column(f.name, "t")
        for f in target.schema
    ]


def _as_inserts(rows: DataFrame, target: DataFrame) -> DataFrame:
    return rows.select(
        *[
            column(f.name) if f.name in rows.columns else typed_null(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def equal_keys(on: list[str]) -> Column:
    """Equality of all keys between the aliases ``t`` and ``u``."""
    condition = column(on[0], "t") == column(on[0], "u")
    for c in on[1:]:
        condition &= column(c, "t") == column(c, "u")
    return condition
