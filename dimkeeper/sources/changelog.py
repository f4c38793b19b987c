"""Store the change log of a type 4 table as parquet, one folder per version.

Three folders belong to a log at ``path``: ``path`` has the rows, ``path.commits`` one small row per
version, ``path.bases`` whole states that :func:`compact_log` wrote. A version exists once its
commit row does. It is written last, so what a failed write left behind is never read.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.functions.columns import columns
from dimkeeper.operators.type4 import COMMIT, OP, VERSION, ChangeLog, commit_rows


def append_version(
    changes: DataFrame,
    path: str,
    replace: bool = False,
    version: int | None = None,
    operation: str | None = None,
    to_version: int | None = None,
    at: datetime.datetime | None = None,
) -> None:
    """Add the rows of one version to the log, then the row that commits it.

    ``version`` is the one that all rows have; give it where there may be no rows, since a
    version without changes counts too. Without it the versions are looked up in the rows.
    ``operation`` (by default create for version 0, else merge), ``to_version`` and the time ``at``
    (by default now) are kept for the history.

    A version that is there already is refused, since later states build on it; ``replace``
    writes it again. Other versions stay untouched either way.
    """
    spark = changes.sparkSession
    if version is None:
        versions = [r[0] for r in changes.select(VERSION).distinct().collect()]
    else:
        versions = [version]
    if not replace:
        there = read_commits(spark, path)
        again = None if there is None else there.where(F.col(VERSION).isin(versions)).agg(F.min(VERSION)).first()[0]
        if again is not None:
            raise ValueError(f"version {again} is already in the log")
    if version is None:
        _overwrite(changes, path)
    else:
        other = F.raise_error(F.lit(f"rows of another version than {version}"))
        op = F.when(F.col(VERSION) == version, F.col(OP)).otherwise(other).alias(OP)
        rest = [c for c in changes.columns if c not in (VERSION, OP)]
        rows = changes.select(op, *columns(rest))
        # The folder of a version is replaced as a whole, also by no rows.
        rows.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")
    written = spark.read.schema(f"{OP} STRING, {VERSION} BIGINT").parquet(path).where(F.col(VERSION).isin(versions))
    _overwrite(commit_rows(written, versions, operation, to_version, at).coalesce(1), f"{path}.commits")


def read_log(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The stored log with the columns of ``like``. Conditions on the version skip whole folders."""
    return spark.read.schema(like.schema).parquet(path).select(*columns(like.columns))


def read_commits(spark: SparkSession, path: str) -> DataFrame | None:
    """One row per version: version, operation, to_version, committed_at and counts. None without any."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}.commits")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def open_log(
    spark: SparkSession,
    path: str,
    like: DataFrame,
    key: str | Sequence[str],
    base: int | None = None,
    limit: int | None = None,
) -> ChangeLog:
    """The log as it was last committed, with the columns of ``like``.

    ``base`` names a version that :func:`compact_log` stored; states are then read from there on.
    The latest version comes from the commit rows, so none of the log's rows is read for it.
    """
    commits = read_commits(spark, path)
    if commits is None:
        return ChangeLog(read_log(spark, path, like), key, limit=limit)
    newest = commits.agg(F.max(VERSION)).first()[0]
    rows = read_log(spark, path, like).where(F.col(VERSION) <= newest)
    log = ChangeLog(rows, key, limit=limit, commits=commits, newest=newest)
    if base is None:
        return log
    names = [f for f in like.schema if f.name not in (VERSION, OP)]
    state = spark.read.schema(type(like.schema)(names)).parquet(_base(path, base))
    return log.compact(base, state)


def compact_log(log: ChangeLog, path: str, version: int) -> None:
    """Store the whole state of ``version`` beside the log, so that later states can start from it."""
    log.as_of(version).write.mode("overwrite").parquet(_base(path, version))


def _base(path: str, version: int) -> str:
    return f"{path}.bases/{VERSION}={version}"


def _overwrite(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(VERSION).parquet(path)
