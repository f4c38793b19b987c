"""Type 4: a current table and its queryable history, kept in one change log.

The log holds ``version`` (bigint), ``op`` (``I`` insert, ``U`` update, ``D`` delete) and
the columns of the table. Version 0 is the whole first state, every later version holds
only the rows it touched. A state is read as the base version minus the keys touched
since, plus the latest row of each touched key. So the large base is never sorted,
aggregated or shuffled while the changes are few.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions.columns import align_names, cast_like, column, columns, fresh, resolve_names
from dimkeeper.operators.merge import AmbiguousMatchError, fit
from dimkeeper.plans.batch import BatchProfile, profile_batch, stage_measured
from dimkeeper.session import stage

VERSION = "version"
OP = "op"
INSERT, UPDATE, DELETE = "I", "U", "D"
CREATE, MERGE, RESTORE = "create", "merge", "restore"
#: What is known of a version as a whole.
COMMIT = (
    "version BIGINT, operation STRING, to_version BIGINT, committed_at TIMESTAMP, "
    "n_inserted BIGINT, n_updated BIGINT, n_deleted BIGINT"
)


class ChangeLog:
    """Operators over a change log. ``key`` names the columns that identify a row.

    ``base`` is the version that holds a whole state. It is 0 unless :meth:`compact` was
    used: then ``base_state`` is the compacted state of version ``base``, and versions
    before it are read from a log with base 0.
    """

    def __init__(
        self,
        log: DataFrame,
        key: str | Sequence[str],
        base: int = 0,
        base_state: DataFrame | None = None,
        limit: int | None = None,
        commits: DataFrame | None = None,
        newest: int | None = None,
    ):
        self.log = log
        self.commits = commits
        self.key = resolve_names(log, [key] if isinstance(key, str) else key)
        self.columns = [c for c in log.columns if c not in (VERSION, OP)]
        self.base = base
        self.base_state = base_state
        self.limit = limit
        self._newest = newest
        self._at_least = base

    @classmethod
    def start(cls, state: DataFrame, key: str | Sequence[str], limit: int | None = None) -> ChangeLog:
        """A log whose version 0 is ``state``. Every row needs a key, and no key may repeat."""
        key = resolve_names(state, [key] if isinstance(key, str) else key)
        profile = profile_batch(state, key, limit)
        if profile.null_keys:
            raise ValueError(f"a row without {key} cannot be followed through versions")
        if profile.repeated_keys:
            raise AmbiguousMatchError(f"{profile.repeated_keys} keys occur in several rows")
        rows = _tagged(state, 0, INSERT)
        return cls(rows, key, limit=limit, commits=commit_rows(rows, [0]), newest=0)

    def with_changes(
        self,
        changes: DataFrame,
        version: int | None = None,
        operation: str | None = None,
        to_version: int | None = None,
    ) -> ChangeLog:
        """The log with further rows, such as the result of :meth:`merge` or :meth:`restore`.

        The rows are written to the shared folder first. So a chain of merges reads finished
        tables, whatever their size, and no merge is computed again by the next one. ``version``
        names the version of changes that may have no row, so that it counts as existing.
        ``operation`` and ``to_version`` are kept for :meth:`operations`.
        """
        written = stage(changes.select(*columns(self.log.columns)), "changes")
        noted = commit_rows(written, None if version is None else [version], operation, to_version)
        commits = noted if self.commits is None else self.commits.unionByName(noted)
        log = ChangeLog(
            self.log.unionByName(written), self.key, self.base, self.base_state, self.limit, commits
        )
        log._at_least = max(self._newest or 0, self._at_least, version or 0)
        return log

    # Reading -----------------------------------------------------------------------------

    def latest_version(self) -> int:
        if self._newest is None:
            newest = self.log.agg(F.max(VERSION)).first()[0]
            self._newest = max(self._at_least, self._at_least if newest is None else newest)
        return self._newest

    def as_of(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """The state at ``version``, by default the latest one.

        A version that does not exist is refused. ``where`` is a condition on the state's rows.
        If it needs key columns only, it is applied to the log's rows too, before the latest one
        per key is chosen, and so reaches the scans.
        """
        if version is not None:
            self._check(version)
        if where is not None and not self._needs_keys_only(where):
            return self.as_of(version).where(where)
        rows = self._rows() if where is None else self._rows().where(where)
        base = rows.where(F.col(VERSION) == self.base).select(*columns(self.columns))
        if version == self.base:
            return base
        log = rows.where(F.col(VERSION) > self.base)
        if version is not None:
            log = log.where(F.col(VERSION) <= version)
        touched = self._latest(log)
        if where is None:
            # Written once, as its keys and its rows are both needed and its keys are counted. Under
            # a condition on keys it is computed in place, from what the filtered scans return.
            touched, profile = stage_measured(touched, self.key, self.limit, label="touched")
        else:
            profile = profile_batch(touched, self.key, self.limit, repeats=False)
        untouched = base.join(profile.keys(touched, self.key), self.key, "left_anti")
        living = touched.where(F.col(OP) != DELETE)
        return untouched.select(*columns(self.columns)).unionByName(living.select(*columns(self.columns)))

    def current(self) -> DataFrame:
        return self.as_of()

    def union_versions(self, versions: Sequence[int], where: Column | None = None) -> DataFrame:
        """Several states side by side, each row tagged with its version.

        The base and the log are read once, however many versions are asked for. ``where`` is a
        condition on the states' rows, as in :meth:`as_of`.
        """
        versions = list(versions)
        if not versions:
            raise ValueError("no version is given")
        for v in versions:
            self._check(v)
        pushed = where is not None and self._needs_keys_only(where)
        rows = self._rows().where(where) if pushed else self._rows()
        log = rows.where((F.col(VERSION) > self.base) & (F.col(VERSION) <= max(versions)))
        # Per key the latest row at each version, null where the key is not touched by then.
        own = [fresh(c, self.log) for c in ("_rows", "_at", "_kept")]
        past, at, kept_at = own
        row = F.struct(OP, *columns([c for c in self.columns if c not in self.key]))
        seen = [F.col(VERSION) <= v for v in versions]
        latest = [F.max_by(F.when(s, row), F.when(s, F.col(VERSION))) for s in seen]
        touched = stage(log.groupBy(*columns(self.key)).agg(F.array(*latest).alias(past)), "touched")
        tags = F.array(*[F.lit(v).cast("long") for v in versions])

        zipped = F.arrays_zip(tags.alias(VERSION), F.col(past).alias(past))
        living = touched.select(*columns(self.key), F.explode(zipped).alias(at))
        living = living.where(F.col(f"{at}.{past}.{OP}") != DELETE)
        living = living.select(F.col(f"{at}.{VERSION}").alias(VERSION), *columns(self.key), f"{at}.{past}.*")
        # Per key the versions that still have the base's row.
        kept = F.transform(past, lambda r: r.isNull()).alias(kept_at)
        kept = touched.select(*columns(self.key), kept)
        profile = profile_batch(kept, self.key, self.limit, rows=True, repeats=False)
        kept = F.broadcast(kept) if profile.rows_fit else kept
        base = rows.where(F.col(VERSION) == self.base).select(*columns(self.columns))
        places = F.transform(
            tags, lambda v, i: F.when(F.col(kept_at).isNull() | F.get(kept_at, i), v)
        )
        untouched = base.join(kept, self.key, "left").select(
            F.explode(F.array_compact(places)).alias(VERSION), *columns(self.columns)
        )
        states = untouched.unionByName(living.select(VERSION, *columns(self.columns)))
        return states if where is None or pushed else states.where(where)

    def history(self) -> DataFrame:
        """How many rows each version inserted, updated and deleted."""
        return self.log.groupBy(VERSION, OP).agg(F.count(F.lit(1)).alias("n_rows"))

    def operations(self) -> DataFrame:
        """What made each version: operation, version restored to, time, and rows it changed.

        Versions without any changed row have a row here too. A log that was made without commit rows
        is counted anew, and its operations and times are unknown.
        """
        if self.commits is not None:
            return self.commits
        unknown = commit_rows(self.log, None)
        return unknown.withColumns({"operation": F.lit(None).cast("string"), "committed_at": F.lit(None).cast("timestamp")})

    # Writing: both return the rows to append --------------------------------------------

    def merge(self, updates: DataFrame, version: int | None = None) -> DataFrame:
        """The rows of ``version``: an upsert of ``updates`` on the latest state.

        ``version`` is by default the next one and must be later than all there are.
        Only touched rows are recorded, marked as insert or update. Append them to the
        stored log, or see the outcome with :meth:`with_changes`.
        """
        version = self._next(version)
        _, updates = fit(self.log.select(*columns(self.columns)), updates, self.key, evolve=False)
        profile = profile_batch(updates, self.key, self.limit)
        if profile.null_keys:
            raise ValueError(f"{profile.null_keys} update rows have no {self.key}")
        if profile.repeated_keys:
            raise AmbiguousMatchError(f"{profile.repeated_keys} keys occur in several update rows")
        rows = self._of_keys(self._rows(), updates, profile)
        known = self._latest(rows).where(F.col(OP) != DELETE)
        hit = fresh("_known", self.log)
        known = known.select(*columns(self.key), F.lit(True).alias(hit))
        op = F.when(F.col(hit), F.lit(UPDATE)).otherwise(F.lit(INSERT))
        return updates.join(known, self.key, "left").select(
            F.lit(version).cast("long").alias(VERSION), op.alias(OP), *columns(self.columns)
        )

    def restore(self, to_version: int, version: int | None = None) -> DataFrame:
        """The rows of ``version`` that bring the state back to ``to_version``; nothing is lost.

        ``version`` is by default the next one and must be later than all there are.
        Only keys touched after ``to_version`` can differ, so only they are compared.
        """
        self._check(to_version)
        version = self._next(version)
        since = self._rows().where(F.col(VERSION) > to_version)
        now, profile = stage_measured(self._latest(since), self.key, self.limit, label="touched")
        rows = self._rows().where(F.col(VERSION) <= to_version)
        before = self._latest(self._of_keys(rows, now, profile))

        live, new, old = (fresh(c, self.log) for c in ("_live", "_now", "_before"))
        content = F.struct(*columns(self.columns))
        both = now.select(
            *columns(self.key), content.alias(new), (F.col(OP) != DELETE).alias(live)
        ).join(
            before.where(F.col(OP) != DELETE).select(*columns(self.key), content.alias(old)),
            self.key,
            "left",
        )
        op = (
            F.when(F.col(old).isNull(), F.when(F.col(live), F.lit(DELETE)))
            .when(~F.col(live), F.lit(INSERT))
            .when(F.col(new) != F.col(old), F.lit(UPDATE))
        )
        row = F.coalesce(F.col(old), F.col(new))
        return (
            both.select(op.alias(OP), row.alias("row"))
            .where(F.col(OP).isNotNull())
            .select(F.lit(version).cast("long").alias(VERSION), OP, "row.*")
        )

    def compact(self, version: int, state: DataFrame) -> ChangeLog:
        """Read on from ``state``, a stored copy of :meth:`as_of` at ``version``.

        Older versions stay in the log and are read through the log this one came from.
        """
        state = cast_like(align_names(state, self.log), self.log)
        return ChangeLog(self.log, self.key, version, state, self.limit, self.commits, self._newest)

    # Parts -------------------------------------------------------------------------------

    def _check(self, version: int) -> None:
        if version < self.base:
            raise ValueError(f"version {version} lies before the base {self.base} of this log")
        if version > self.latest_version():
            raise ValueError(f"version {version} does not exist, the latest is {self.latest_version()}")

    def _next(self, version: int | None) -> int:
        if version is None:
            return self.latest_version() + 1
        if version <= self.latest_version():
            raise ValueError(f"version {version} is not later than {self.latest_version()}")
        return version

    def _needs_keys_only(self, where: Column) -> bool:
        """Whether the condition can be resolved on a frame that has the key columns alone."""
        keys = T.StructType([self.log.schema[c] for c in self.key])
        try:
            self.log.sparkSession.createDataFrame([], keys).where(where).schema  # noqa: B018
        except AnalysisException:
            return False
        return True

    def _rows(self) -> DataFrame:
        """The base as rows of its version, and all changes since."""
        if self.base_state is None:
            return self.log.where(F.col(VERSION) >= self.base)
        state = _tagged(self.base_state.select(*columns(self.columns)), self.base, INSERT)
        return state.unionByName(self.log.where(F.col(VERSION) > self.base))

    def _of_keys(self, rows: DataFrame, keys: DataFrame, profile: BatchProfile) -> DataFrame:
        """The log's rows for the keys of another frame."""
        return rows.join(profile.keys(keys, self.key), self.key, "left_semi")

    def _latest(self, log: DataFrame) -> DataFrame:
        """The last row of each key, combined on the map side before the shuffle."""
        row = F.struct(OP, *columns([c for c in self.columns if c not in self.key]))
        last = fresh("_row", self.log)
        latest = log.groupBy(*columns(self.key)).agg(F.max_by(row, F.col(VERSION)).alias(last))
        return latest.select(*columns(self.key), f"{last}.*").select(OP, *columns(self.columns))


def commit_rows(
    rows: DataFrame,
    versions: Sequence[int] | None,
    operation: str | None = None,
    to_version: int | None = None,
    at: datetime.datetime | None = None,
) -> DataFrame:
    """One row per version with what is known of it, see :data:`COMMIT`.

    ``versions`` are listed even if they have no row; None stands for those that the rows have.
    """
    counted = rows.groupBy(VERSION).agg(
        *[
            F.count_if(F.col(OP) == op).alias(name)
            for op, name in ((INSERT, "n_inserted"), (UPDATE, "n_updated"), (DELETE, "n_deleted"))
        ]
    )
    if versions is not None:
        listed = rows.sparkSession.createDataFrame([(v,) for v in versions], f"{VERSION} BIGINT")
        counted = listed.join(counted, VERSION, "left").fillna(0, ["n_inserted", "n_updated", "n_deleted"])
    usual = F.when(F.col(VERSION) == 0, F.lit(CREATE)).otherwise(F.lit(MERGE))
    return counted.select(
        F.col(VERSION).cast("long").alias(VERSION),
        (usual if operation is None else F.lit(operation)).alias("operation"),
        F.lit(to_version).cast("long").alias("to_version"),
        (F.current_timestamp() if at is None else F.lit(at).cast("timestamp")).alias("committed_at"),
        *("n_inserted", "n_updated", "n_deleted"),
    )


def _tagged(state: DataFrame, version: int, op: str) -> DataFrame:
    return state.select(
        F.lit(version).cast("long").alias(VERSION), F.lit(op).alias(OP), "*"
    )
