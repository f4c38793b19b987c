"""Plans at scale: what is broadcast, what is shuffled, how hot keys are spread."""

from __future__ import annotations

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators import History, ambiguous_keys, type1, type3
from dimkeeper.plans import broadcast_limit, number_rows, profile_batch
from dimkeeper.session import shared_folder, stage

EFF = dt.date(2024, 1, 1)


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def dimension(spark):
    return stage(spark.range(0, 20000).selectExpr("id AS k", "concat('n', id) AS name", "'Oslo' AS city"))


@pytest.fixture(scope="module")
def batch(spark):
    return stage(spark.range(19990, 20010).selectExpr("id AS k", "concat('n', id) AS name", "'Rome' AS city"))


@pytest.fixture(scope="module")
def hot_history(spark):
    """A third of all rows belong to one key."""
    rows = spark.range(0, 60000).selectExpr(
        "id",
        "IF(id < 20000, 0, id) AS k",
        "concat('n', xxhash64(id)) AS name",
        "DATE '2020-01-01' AS start_date",
        "IF(id < 19999, DATE '2021-01-01', NULL) AS end_date",
    )
    return stage(rows)


def test_profile(spark):
    rows = spark.createDataFrame(
        [(1, "a"), (1, "b"), (2, "ccc"), (None, "d"), (None, None)], "k BIGINT, v STRING"
    )
    p = profile_batch(rows, ["k"], limit=500, rows=True)
    assert (p.rows, p.null_keys, p.repeated_keys) == (5, 2, 1)
    assert p.key_bytes == 5 * (48 + 24)
    assert p.row_bytes == 5 * (48 + 24 + 24) + 6
    assert p.keys_fit and p.rows_fit
    assert not profile_batch(rows, ["k"], limit=10).keys_fit
    assert sorted(r.k for r in p.keys(rows, ["k"]).collect()) == [1, 2]
    nested = rows.select("k", F.array("v").alias("a"))
    assert profile_batch(nested, ["k"], rows=True).row_bytes > p.row_bytes
    unread = profile_batch(rows, ["k"], repeats=False)
    assert unread.row_bytes is None and not unread.rows_fit
    assert (unread.rows, unread.null_keys, unread.repeated_keys) == (5, 2, 0)
    empty = profile_batch(rows.where("false"), ["k"])
    assert (empty.rows, empty.key_bytes, empty.repeated_keys) == (0, 0, 0)


def test_limit_follows_the_session(spark):
    assert broadcast_limit(spark) == 10 * 2**20
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="3MB"):
        assert broadcast_limit(spark) == 3 * 2**20
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        assert broadcast_limit(spark) == -1
        rows = spark.range(3)
        assert not profile_batch(rows, ["id"]).keys_fit
        assert not profile_batch(rows.where("false"), ["id"]).keys_fit


def test_small_batch_leaves_the_table_in_place(dimension, batch):
    text = plan(type1.upsert(dimension, batch, "k"))
    assert "BroadcastHashJoin" in text and "LeftAnti, BuildRight" in text
    assert "Exchange hashpartitioning" not in text


def test_large_batch_is_not_broadcast(spark, dimension, batch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = type1.upsert(dimension, batch, "k")
        assert "SortMergeJoin" in plan(merged) and "BroadcastExchange" not in plan(merged)
        assert merged.count() == 20010
        found = type3.apply(dimension, batch, "k", "city")
        assert "BroadcastExchange" not in plan(found)
        assert found.where("previous_city = 'Oslo'").count() == 10


def test_rows_without_key_bypass_the_shuffle(spark, dimension, batch):
    """Nulls would all hash to one partition; the shuffled side filters them out."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(type1.upsert(dimension, batch, "k"))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert sum("PushedFilters: [IsNotNull(k)]" in line for line in scans) == 2
    assert sum("PushedFilters: [IsNull(k)]" in line for line in scans) == 1


def test_closed_rows_stay_out_of_the_shuffle(spark, hot_history, batch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        merged = History("k").apply(hot_history, batch.select("k", "name"), EFF)
        scans = [line for line in plan(merged).splitlines() if "FileScan" in line]
    assert any("IsNotNull(k), IsNull(end_date)" in line for line in scans)
    assert merged.count() == 60020


def test_hot_key_is_split(spark, hot_history):
    """With expire="all" every row of the hot key joins; Spark cuts its partition up."""
    hit = stage(spark.range(0, 20100).selectExpr("id AS k", "'x' AS name"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
    ):
        merged = History("k").apply(hot_history, hit, EFF, expire="all")
        rows = merged.collect()
        text = plan(merged)
    assert "skew=true" in text
    closed = [r for r in rows if r.end_date == EFF]
    assert len(closed) == 20000 + 100
    assert len(rows) == 60000 + 20100
    assert sorted(r.id for r in rows) == list(range(80100))


def test_numbers_follow_the_order_over_many_partitions(spark):
    rows = spark.range(0, 5000).selectExpr("id * 7919 % 5003 AS k", "id % 3 AS v").repartition(7)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        got = number_rows(rows, [F.col("k").asc_nulls_last()], "n", 100)
        placed = got.select("k", "n").orderBy("k").collect()
    assert [r.n for r in placed] == list(range(100, 5100))


def test_numbering_has_no_window_over_the_rows(spark, hot_history):
    text = plan(History("k").renumber(hot_history))
    window = next(line for line in text.splitlines() if "Window" in line)
    assert "_part" in window and "sum(_n" in window
    below = text[text.index("Window") :]
    assert "partial_count" in below and "name" not in below.split("SinglePartition")[1].split("ReadSchema")[1]


def test_numbers_start_after_the_largest_id(spark):
    start = spark.createDataFrame([(41,)], "next BIGINT")
    rows = spark.createDataFrame([("b",), ("a",), (None,)], "k STRING")
    got = number_rows(rows, [F.col("k").asc_nulls_last()], "n", start)
    assert {r.k: r.n for r in got.collect()} == {"a": 41, "b": 42, None: 43}
    assert number_rows(rows.where("false"), [F.col("k").asc()], "n").count() == 0


def test_checks_scan_only_the_key_columns(spark, hot_history):
    key_only = profile_batch(hot_history.select("k"), ["k"])
    assert key_only.rows == 60000 and key_only.repeated_keys == 1


def test_stage_uses_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    (file, *_) = stage(spark.range(3)).inputFiles()
    assert shared_folder(spark) in file


def test_one_repeated_key_of_a_large_batch_leaves_the_table_in_place(spark, dimension):
    """Beyond the limit as a whole, but only the repeated key is looked up."""
    keys = spark.range(0, 30000).selectExpr("IF(id = 29999, 7, id) AS k")
    large = stage(keys)
    found = ambiguous_keys(dimension, large, "k", limit=10_000)
    lookup = plan(found)
    assert "SortMergeJoin" not in lookup
    assert "BroadcastHashJoin [k" in lookup
    assert [tuple(r) for r in found.collect()] == [(7, 2)]
