from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators import AmbiguousMatchError, ChangeLog
from dimkeeper.session import stage
from dimkeeper.sources import append_version, read_log, rows, top_keys

SCHEMA = "k BIGINT, name STRING, email STRING"
PEOPLE = [(k, f"n{k}", f"m{k}@x") for k in range(1, 9)]


def start(spark, limit=None):
    return ChangeLog.start(top_keys(rows(spark, PEOPLE, SCHEMA), "k", ["name", "email"]), "k", limit)


def stored(log, changes):
    """The log with the changes appended as a finished table, as a stored log would hold them."""
    return log.with_changes(changes)


def state(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


@pytest.mark.parametrize("limit", [None, -1])
def test_scenario(spark, limit):
    """Five rows, two changed: four tagged rows for two versions, then a rollback."""
    log = start(spark, limit)
    batch = rows(spark, [(1, "n1", "new@x"), (2, "longer", "m2@x")], SCHEMA)
    log = log.with_changes(log.merge(batch, 1))
    assert state(log.current())[1] == ("n1", "new@x")
    assert log.current().count() == 5
    both = log.union_versions([0, 1], where=(F.col("k") == 1) | (F.col("k") == 2))
    assert sorted(map(tuple, both.collect())) == [
        (0, 1, "n1", "m1@x"),
        (0, 2, "n2", "m2@x"),
        (1, 1, "n1", "new@x"),
        (1, 2, "longer", "m2@x"),
    ]
    log = log.with_changes(log.restore(to_version=0, version=2))
    assert state(log.current()) == state(log.as_of(0))
    assert state(log.as_of(1))[2] == ("longer", "m2@x")
    assert log.latest_version() == 2
    history = {(r.version, r.op): r.n_rows for r in log.history().collect()}
    assert history == {(0, "I"): 5, (1, "U"): 2, (2, "U"): 2}


@pytest.mark.parametrize("limit", [None, -1])
def test_restore_deletes_and_brings_back(spark, limit):
    log = start(spark, limit)
    log = stored(log, log.merge(rows(spark, [(50, "new", "e"), (1, "x", "y")], SCHEMA), 1))
    back = log.restore(to_version=0, version=2)
    assert {(r.op, r.k) for r in back.collect()} == {("D", 50), ("U", 1)}
    log = stored(log, back)
    assert state(log.current()) == state(log.as_of(0))
    again = log.restore(to_version=1, version=3)
    assert {(r.op, r.k) for r in again.collect()} == {("I", 50), ("U", 1)}
    log = stored(log, again)
    assert state(log.current()) == state(log.as_of(1))
    # A key that was deleted counts as new, an update equal to the old state changes nothing.
    log = stored(log, log.restore(to_version=0, version=4))
    after = log.merge(rows(spark, [(50, "third", "e")], SCHEMA), 5)
    assert [(r.op, r.k) for r in after.collect()] == [("I", 50)]
    assert log.restore(to_version=2, version=5).count() == 0


@pytest.mark.parametrize("limit", [None, -1])
def test_random_versions(spark, limit):
    """Every version reads back as it was, also after later ones and from a stored base."""
    r = random.Random(8)
    log = ChangeLog.start(rows(spark, PEOPLE, SCHEMA), "k", limit)
    states = [{p[0]: p[1:] for p in PEOPLE}]
    for version in range(1, 5):
        if version == 3:
            log = stored(log, log.restore(1, version))
            states.append(states[1])
        else:
            keys = r.sample(range(1, 14), 5)
            batch = [(k, f"v{version}", None if k > 7 else "e") for k in keys]
            log = stored(log, log.merge(rows(spark, batch, SCHEMA), version))
            states.append({**states[-1], **{b[0]: b[1:] for b in batch}})
    for version, want in enumerate(states):
        assert state(log.as_of(version)) == want
    assert state(log.current()) == states[-1]

    based = log.compact(2, stage(log.as_of(2)))
    for version in (2, 3, 4):
        assert state(based.as_of(version)) == states[version]
    for reading in (lambda: based.as_of(1), lambda: based.restore(1, 5)):
        with pytest.raises(ValueError, match="before the base"):
            reading()
    rollback = based.restore(2, 5)
    assert sorted(map(tuple, rollback.collect())) == sorted(map(tuple, log.restore(2, 5).collect()))
    batch = rows(spark, [(1, "x", "y"), (70, "n", "e")], SCHEMA)
    want = {(row.op, row.k) for row in log.merge(batch, 5).collect()}
    assert {(row.op, row.k) for row in based.merge(batch, 5).collect()} == want


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_chain_of_merges_at_any_broadcast_limit(spark, threshold):
    """Three merges appended one after the other, then a rollback, without writing in between."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        base = spark.range(3000).selectExpr("id AS k", "'old' AS name", "'e' AS email")
        log = ChangeLog.start(base, "k")
        for n in (1, 2, 3):
            batch = spark.range(n * 500, n * 500 + 1500).selectExpr("id AS k", f"'v{n}' AS name", "'e' AS email")
            log = log.with_changes(log.merge(batch))
        assert log.latest_version() == 3
        names = {r["name"]: r["count"] for r in log.current().groupBy("name").count().collect()}
        assert names == {"old": 500, "v1": 500, "v2": 500, "v3": 1500}
        assert state(log.as_of(2))[1200] == ("v2", "e")
        log = log.with_changes(log.restore(to_version=1))
        assert state(log.current()) == state(log.as_of(1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_versions_that_cannot_be_are_refused(spark):
    log = start(spark)
    log = log.with_changes(log.merge(rows(spark, [(1, "x", "y")], SCHEMA)))
    for call in (lambda: log.as_of(2), lambda: log.restore(9)):
        with pytest.raises(ValueError, match="does not exist"):
            call()
    for version in (0, 1):
        with pytest.raises(ValueError, match="not later"):
            log.merge(rows(spark, [(1, "a", "b")], SCHEMA), version)
        with pytest.raises(ValueError, match="not later"):
            log.restore(0, version)


def test_condition_on_any_column(spark):
    log = start(spark)
    log = log.with_changes(log.merge(rows(spark, [(1, "changed", "y")], SCHEMA)))
    assert log.as_of(1, where=F.col("name") == "n1").count() == 0
    assert log.as_of(0, where=F.col("name") == "n1").count() == 1
    both = log.union_versions([0, 1], where=(F.col("name") == "changed") | (F.col("k") == 2))
    assert sorted((r["version"], r["k"]) for r in both.collect()) == [(0, 2), (1, 1), (1, 2)]


def test_bad_keys_are_refused(spark):
    with pytest.raises(AmbiguousMatchError):
        ChangeLog.start(rows(spark, [(1, "a", "b"), (1, "c", "d")], SCHEMA), "k")
    with pytest.raises(ValueError, match="without"):
        ChangeLog.start(rows(spark, [(None, "a", "b")], SCHEMA), "k")
    log = start(spark)
    with pytest.raises(ValueError, match="have no"):
        log.merge(rows(spark, [(None, "a", "b")], SCHEMA), 1)
    with pytest.raises(AmbiguousMatchError):
        log.merge(rows(spark, [(1, "a", "b"), (1, "c", "d")], SCHEMA), 1)


def test_stored_log_reads_only_the_versions_needed(spark, tmp_path):
    log = start(spark)
    path = str(tmp_path / "log")
    append_version(log.log, path)
    changes = log.merge(rows(spark, [(1, "x", "y"), (70, "n", "e")], SCHEMA), 1)
    append_version(changes, path)
    with pytest.raises(ValueError, match="already in the log"):
        append_version(changes, path)
    append_version(changes, path, replace=True)
    read = ChangeLog(read_log(spark, path, log.log), "k")
    assert state(read.current()) == state(log.with_changes(changes).current())
    assert state(read.as_of(0)) == state(log.current())
    plan = read.as_of(0)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan
    assert {(r.version, r.op): r.n_rows for r in read.history().collect()} == {
        (0, "I"): 5,
        (1, "U"): 1,
        (1, "I"): 1,
    }


def test_key_filter_reaches_the_scans(spark, tmp_path):
    path = str(tmp_path / "log")
    log = start(spark)
    append_version(log.log, path)
    append_version(log.merge(rows(spark, [(1, "x", "y")], SCHEMA), 1), path)
    read = ChangeLog(read_log(spark, path, log.log), "k")
    plan = read.as_of(1, where=F.col("k") == 1)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("EqualTo(k,1)" in line for line in scans)


@pytest.mark.parametrize("limit", [None, -1])
def test_several_versions_read_the_base_once(spark, tmp_path, limit):
    path = str(tmp_path / "log")
    log = start(spark)
    append_version(log.log, path)
    append_version(log.merge(rows(spark, [(1, "x", "y"), (90, "n", "e")], SCHEMA), 1), path)
    read = ChangeLog(read_log(spark, path, log.log), "k", limit=limit)
    append_version(read.restore(0, version=2), path)
    read = ChangeLog(read_log(spark, path, log.log), "k", limit=limit)
    states = read.union_versions([0, 1, 2])
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(version") == 1
    for version in (0, 1, 2):
        assert state(states.where(F.col("version") == version).drop("version")) == state(read.as_of(version))
    with pytest.raises(ValueError, match="does not exist"):
        read.union_versions([0, 3])
