"""Commit rows: versions without rows, kinds and times, unfinished writes, stored bases."""

from __future__ import annotations

import datetime

import pytest
from pyspark.errors import PySparkException

from dimkeeper.operators import ChangeLog
from dimkeeper.sources import append_version, compact_log, open_log, read_commits, rows

SCHEMA = "k BIGINT, name STRING"
AT = datetime.datetime(2024, 5, 6, 7, 8, 9)


def state(df):
    return {r[0]: r[1] for r in df.collect()}


def kinds(log):
    listed = log.operations().orderBy("version").collect()
    return [(r.version, r.operation, r.to_version, r.n_inserted, r.n_updated, r.n_deleted) for r in listed]


@pytest.fixture
def stored(spark, tmp_path):
    path = str(tmp_path / "log")
    start = ChangeLog.start(rows(spark, [(1, "a"), (2, "b")], SCHEMA), "k").log
    append_version(start, path, version=0, at=AT)
    return path, start


def test_history_of_a_stored_log(spark, stored):
    path, start = stored
    reopened = lambda: open_log(spark, path, start, "k")
    append_version(reopened().merge(rows(spark, [(1, "x"), (9, "n")], SCHEMA)), path, version=1)
    append_version(reopened().restore(0), path, version=2, operation="restore", to_version=0)
    append_version(reopened().restore(0), path, version=3, operation="restore", to_version=0)
    log = reopened()
    assert log.latest_version() == 3
    assert kinds(log) == [
        (0, "create", None, 2, 0, 0),
        (1, "merge", None, 1, 1, 0),
        (2, "restore", 0, 0, 1, 1),
        (3, "restore", 0, 0, 0, 0),
    ]
    assert read_commits(spark, path).where("version = 0").first().committed_at == AT
    assert state(log.current()) == state(log.as_of(3)) == {1: "a", 2: "b"}
    assert state(log.as_of(1)) == {1: "x", 2: "b", 9: "n"}
    with pytest.raises(ValueError, match="already"):
        append_version(log.restore(0, version=4), path, version=3)
    append_version(log.restore(1), path, version=4, operation="restore", to_version=1)
    assert state(reopened().current()) == state(log.as_of(1))


def test_rows_without_a_commit_are_not_read(spark, stored):
    path, start = stored
    half = open_log(spark, path, start, "k").merge(rows(spark, [(1, "lost"), (7, "lost")], SCHEMA))
    half.drop("version").write.parquet(f"{path}/version=1")
    log = open_log(spark, path, start, "k")
    assert log.latest_version() == 0
    assert state(log.current()) == {1: "a", 2: "b"}
    append_version(log.restore(0), path, version=1, operation="restore", to_version=0)
    assert state(open_log(spark, path, start, "k").current()) == {1: "a", 2: "b"}


def test_rows_of_another_version_are_refused(spark, stored):
    path, start = stored
    changes = open_log(spark, path, start, "k").merge(rows(spark, [(1, "x")], SCHEMA))
    with pytest.raises(PySparkException, match="another version"):
        append_version(changes, path, version=2)
    assert open_log(spark, path, start, "k").latest_version() == 0


def test_an_empty_folder_and_several_versions_at_once(spark, stored, tmp_path):
    path, start = stored
    log = open_log(spark, path, start, "k")
    log = log.with_changes(log.merge(rows(spark, [(5, "e")], SCHEMA)))
    log = log.with_changes(log.restore(1, version=2), version=2, operation="restore", to_version=1)
    assert kinds(log) == [(0, "create", None, 2, 0, 0), (1, "merge", None, 1, 0, 0), (2, "restore", 1, 0, 0, 0)]
    other = tmp_path / "other"
    other.mkdir()
    append_version(log.log, str(other))
    copied = open_log(spark, str(other), start, "k")
    assert copied.latest_version() == 1 and state(copied.current()) == state(log.current())


def test_a_log_without_commit_rows(spark, tmp_path):
    log = ChangeLog(ChangeLog.start(rows(spark, [(1, "a")], SCHEMA), "k").log, "k")
    assert kinds(log) == [(0, None, None, 1, 0, 0)]
    path = str(tmp_path / "plain")
    log.log.write.partitionBy("version").parquet(path)
    assert open_log(spark, path, log.log, "k").latest_version() == 0


@pytest.mark.parametrize("limit", [None, -1])
def test_stored_base(spark, stored, limit):
    path, start = stored
    append_version(open_log(spark, path, start, "k").merge(rows(spark, [(1, "x"), (9, "n")], SCHEMA)), path, version=1)
    compact_log(open_log(spark, path, start, "k"), path, 1)
    append_version(open_log(spark, path, start, "k").merge(rows(spark, [(2, "y")], SCHEMA)), path, version=2)
    log = open_log(spark, path, start, "k", base=1, limit=limit)
    assert state(log.as_of(1)) == {1: "x", 2: "b", 9: "n"}
    assert state(log.current()) == {1: "x", 2: "y", 9: "n"}
    with pytest.raises(ValueError, match="before the base"):
        log.as_of(0)
