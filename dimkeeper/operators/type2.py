"""Type 2: close the current row of a changed key with an end date and add a new row.

A history table has a surrogate id, one or more business key columns, attributes, a start
date and an end date. The end date is null while a row is current.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

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
from dimkeeper.operators.merge import AmbiguousMatchError, equal_keys
from dimkeeper.plans.batch import BatchProfile, profile_batch
from dimkeeper.plans.filter import may_match
from dimkeeper.plans.numbering import number_rows
from dimkeeper.session import stage

ACTIVE = "active"
ALL = "all"


class History:
    """The column roles of a type 2 table, and the operators over it."""

    def __init__(
        self,
        key: str | Sequence[str],
        surrogate: str = "id",
        start: str = "start_date",
        end: str = "end_date",
    ):
        self.key = [key] if isinstance(key, str) else list(key)
        self.surrogate = surrogate
        self.start = start
        self.end = end

    def spelled_as(self, history: DataFrame) -> History:
        """The same roles with the names as the table spells them."""
        key = resolve_names(history, self.key)
        return History(key, *resolve_names(history, [self.surrogate, self.start, self.end]))

    def attributes(self, history: DataFrame) -> list[str]:
        """Every column that is neither id nor one of the two dates; the key is included."""
        return [c for c in history.columns if c not in (self.surrogate, self.start, self.end)]

    # Reading -----------------------------------------------------------------------------

    def is_active(self) -> Column:
        return column(self.end).isNull()

    def active(self, history: DataFrame) -> DataFrame:
        """Current rows."""
        return history.where(self.is_active())

    def inactive(self, history: DataFrame) -> DataFrame:
        """Closed rows, which are those with an end date.

        Comparing with null (``end_date <> null``) is never true and would return nothing.
        """
        return history.where(column(self.end).isNotNull())

    def with_active_flag(self, history: DataFrame, flag: str = "is_active") -> DataFrame:
        return history.withColumn(flag, self.is_active())

    # Writing -----------------------------------------------------------------------------

    def change_rows(
        self,
        history: DataFrame,
        updates: DataFrame,
        effective_date: datetime.date | None = None,
        limit: int | None = None,
    ) -> DataFrame:
        """The updates as new open rows without id, and all rows the table has for their keys."""
        roles = self.spelled_as(history)
        updates = roles._fit(history, updates)
        profile = profile_batch(updates, roles.key, limit, repeats=False)
        known = history.join(profile.keys(updates, roles.key), roles.key, "left_semi")
        opened = roles._opened(history, updates, effective_date or today(history))
        return opened.unionByName(known).select(*columns(history.columns))

    def apply(
        self,
        history: DataFrame,
        updates: DataFrame,
        effective_date: datetime.date | None = None,
        expire: str = ACTIVE,
        skip_unchanged: bool = False,
        limit: int | None = None,
    ) -> DataFrame:
        """The history after the batch: hit rows closed, one new open row per update.

        New rows get ids at once, counting up from the largest id in key order, so no row
        without id is ever visible and a second run finds the rows of the first.

        ``expire="all"`` also overwrites the end date of rows closed earlier. The default
        leaves them alone. ``skip_unchanged`` drops updates equal to the key's open row. A
        batch with two rows for one key is refused: it would open two rows.
        """
        if expire not in (ACTIVE, ALL):
            raise ValueError(f"expire is 'active' or 'all', not {expire!r}")
        roles = self.spelled_as(history)
        updates = roles._fit(history, updates)
        profile = profile_batch(updates, roles.key, limit, rows=skip_unchanged)
        if profile.repeated_keys:
            raise AmbiguousMatchError(f"{profile.repeated_keys} keys occur in several update rows")
        if skip_unchanged:
            # Written once: the comparison would otherwise run for each use below.
            updates = stage(roles._changed_only(history, updates, profile), "changed")
        effective_date = effective_date or today(history)

        opened = roles.assign_ids(history, roles._opened(history, updates, effective_date))
        closed = roles._closed(history, updates, effective_date, expire, profile)
        return closed.select(*columns(history.columns)).unionByName(opened)

    def assign_ids(self, history: DataFrame, rows: DataFrame) -> DataFrame:
        """Give ``rows`` the ids after the largest one of ``history``, in key order."""
        largest = F.coalesce(F.max(column(self.surrogate)), F.lit(-1)).cast("long")
        free = history.agg((largest + 1).alias("free"))
        order = [column(c).asc_nulls_last() for c in self._order(rows)]
        numbered = number_rows(rows, order, self.surrogate, free)
        return cast_like(numbered, history).select(*columns(rows.columns))

    def renumber(self, history: DataFrame) -> DataFrame:
        """Ids from 0 without gaps: by the old id, rows without one last and in key order.

        If the old ids have no gaps already, they stay, and only rows without one are numbered.
        """
        roles = self.spelled_as(history)
        dense = roles.dense_ids(history)
        if dense is not None:
            known = column(roles.surrogate).isNotNull()
            new = history.where(~known)
            order = [column(c).asc_nulls_last() for c in roles._order(history)]
            numbered = cast_like(number_rows(new, order, roles.surrogate, dense), history)
            return history.where(known).unionByName(numbered).select(*columns(history.columns))
        order = [column(c).asc_nulls_last() for c in [roles.surrogate, *roles._order(history)]]
        return number_rows(history, order, roles.surrogate).select(*columns(history.columns))

    def dense_ids(self, history: DataFrame) -> int | None:
        """How many ids there are if they are 0, 1, 2 and so on, each once; else None.

        One aggregation decides it: ids are grouped by 64, each group keeps a count and one bit per
        id. Ids that lie together, as those of a written history do, are combined on the map side.
        """
        if not isinstance(history.schema[self.surrogate].dataType, T.IntegralType):
            return None
        id = column(self.surrogate).cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), id.bitwiseAND(F.lit(63)).cast("int"))
        ids = history.where(id.isNotNull()).groupBy(F.shiftright(id, 6).alias("part"))
        parts = ids.agg(
            F.count(F.lit(1)).alias("n"), F.bit_or(bit).alias("bits"), F.min(id).alias("least"), F.max(id).alias("most")
        )
        found = parts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
            F.coalesce(F.min("least"), F.lit(0)).alias("least"),
            F.coalesce(F.max("most"), F.lit(-1)).alias("most"),
            F.count_if(F.bit_count("bits") != F.col("n")).alias("repeated"),
        ).first()
        dense = found["least"] == 0 and found["most"] == found["n"] - 1 and not found["repeated"]
        return found["n"] if dense else None

    # Parts -------------------------------------------------------------------------------

    def _order(self, rows: DataFrame) -> list[str]:
        """The business key, then every other column that can be sorted by."""
        rest = [f.name for f in rows.schema if "map<" not in f.dataType.simpleString()]
        return self.key + [c for c in rest if c not in (*self.key, self.surrogate)]

    def _fit(self, history: DataFrame, updates: DataFrame) -> DataFrame:
        """Attributes of the batch under the table's names and types; an id in it is ignored."""
        updates = align_names(updates, history)
        return cast_like(
            updates.select(*columns(resolve_names(updates, self.attributes(history)))), history
        )

    def _opened(
        self, history: DataFrame, updates: DataFrame, effective_date: datetime.date
    ) -> DataFrame:
        types = {f.name: f.dataType for f in history.schema}
        return updates.select(
            typed_null(types[self.surrogate]).alias(self.surrogate),
            *columns(updates.columns),
            F.lit(effective_date).cast(types[self.start]).alias(self.start),
            typed_null(types[self.end]).alias(self.end),
        )

    def _changed_only(
        self, history: DataFrame, updates: DataFrame, profile: BatchProfile
    ) -> DataFrame:
        """Drop updates that equal the open row of their key, nulls counting as equal."""
        maps = [f.name for f in updates.schema if "map<" in f.dataType.simpleString()]
        if maps:
            raise ValueError(f"maps cannot be compared, skip_unchanged does not work with {maps}")
        attributes = [c for c in updates.columns if c not in self.key]
        current = with_key(self.active(history), self.key).select(*columns(updates.columns)).alias("t")
        same = equal_keys(self.key)
        for c in attributes:
            same &= column(c, "t").eqNullSafe(column(c, "u"))
        keyed = with_key(updates, self.key)
        if profile.rows_fit:
            # The table stays in place; the few keys found there travel back.
            equal = current.join(F.broadcast(keyed.alias("u")), same, "left_semi").select(*columns(self.key))
            changed = keyed.join(equal, self.key, "left_anti")
        else:
            changed = keyed.alias("u").join(current, same, "left_anti")
        changed = changed.select(*columns(updates.columns))
        # Rows without a key would all meet in one task; they equal nothing.
        keyless = without_key(updates, self.key)
        return changed if keyless is None else changed.unionByName(keyless)

    def _closed(
        self,
        history: DataFrame,
        updates: DataFrame,
        effective_date: datetime.date,
        expire: str,
        profile: BatchProfile,
    ) -> DataFrame:
        """All old rows, those hit by the batch with their end date set."""
        key, end_type = self.key, history.schema[self.end].dataType
        found = fresh("_hit", history, updates)
        hits = profile.keys(updates, key).withColumn(found, F.lit(True))
        hit = F.col(found) if expire == ALL else F.col(found) & self.is_active()
        end = F.when(hit, F.lit(effective_date).cast(end_type)).otherwise(column(self.end))
        if profile.keys_fit:
            return history.join(hits, key, "left").withColumn(self.end, end)
        # Shuffle join: only rows that can be closed take part. Without closed rows a key has
        # at most one open row, however long its history is; rows without key match nothing.
        # With expire="all" a long history joins as a whole, on the side Spark can split.
        # Rows that the batch surely does not hit take no part either.
        possible = may_match(history, updates, key, profile)
        able = has_key(key) if possible is None else possible
        able = able if expire == ALL else able & self.is_active()
        joined = history.where(able).join(hits, key, "left").withColumn(self.end, end)
        return joined.select(*columns(history.columns)).unionByName(history.where(~able))


def today(df: DataFrame) -> datetime.date:
    """The current date in the session's time zone, fixed once for a whole merge."""
    return df.sparkSession.range(1).select(F.current_date()).first()[0]
