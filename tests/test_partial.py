"""States published in part, and files clustered by key."""

from __future__ import annotations

import os
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from dimkeeper import sources
from dimkeeper.operators import type1
from tests.test_plans import plan


def _table(spark, n=1000, parts=100):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % parts).cast("int").alias("p"), F.lit("old").alias("v"))


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


def _folders(place, snapshot):
    return sorted(x for x in os.listdir(f"{place}/snap={snapshot}") if "=" in x)


@pytest.mark.parametrize("temporary", [True, False])
def test_an_upsert_writes_the_partition_it_hits(spark, tmp_path, temporary):
    name, place = f"partial_{temporary}".lower(), str(tmp_path / "t")
    sources.publish(_table(spark), name, place, snapshot="a", temporary=temporary, partition_by=["p"])
    before = spark.table(name)
    batch = sources.rows(spark, [(107, 7, "new"), (207, 7, "new")], "k BIGINT, p INT, v STRING")
    full = _rows(type1.upsert(before, batch, "k"))
    out = sources.upsert_touched(name, batch, "k", place, ["p"], type1.upsert, snapshot="b", temporary=temporary)
    assert _folders(place, "b") == ["p=7"]
    assert _rows(out) == full and out.dtypes == before.dtypes
    assert before.where("v = 'new'").count() == 0, "whoever reads the first state still finds it"
    # A row that moves changes the partition it leaves and the one it enters; a new one may be made.
    batch = sources.rows(spark, [(3, 4, "moved"), (5000, 500, "born")], "k BIGINT, p INT, v STRING")
    full = _rows(type1.upsert(out, batch, "k"))
    out = sources.upsert_touched(name, batch, "k", place, ["p"], type1.upsert, snapshot="c", temporary=temporary)
    assert _folders(place, "c") == ["p=3", "p=4", "p=500"]
    assert _rows(out) == full
    assert len({f.split("/snap=")[1].split("/")[0] for f in out.inputFiles()}) == 3


@pytest.mark.parametrize("temporary", [True, False])
def test_an_emptied_partition_disappears(spark, tmp_path, temporary):
    name, place = f"emptied_{temporary}".lower(), str(tmp_path / "t")
    data = sources.rows(spark, [(1, "a"), (2, "b"), (3, "b")], "k INT, p STRING")
    sources.publish(data, name, place, temporary=temporary, partition_by=["p"])
    batch = sources.rows(spark, [(1, "b")], "k INT, p STRING")
    out = sources.upsert_touched(name, batch, "k", place, ["p"], type1.upsert, temporary=temporary)
    assert _rows(out) == Counter([(1, "b"), (2, "b"), (3, "b")])
    gone = sources.publish_touched(out.where("false"), out.select("p").distinct(), name, place, temporary=temporary)
    assert gone.count() == 0 and gone.columns == ["k", "p"]


@pytest.mark.parametrize("temporary", [True, False])
def test_values_that_folders_escape(spark, tmp_path, temporary):
    name, place = f"escaped_{temporary}".lower(), str(tmp_path / "it's 100%")
    odd = ["a/b", "it's", "50%", "x=y", " ", "ü", "01", "1", "c:\\d", "%2F", None]
    data = sources.rows(spark, [(i, p, i % 2 == 0) for i, p in enumerate(odd)], "k INT, `p.q` STRING, r BOOLEAN")
    sources.publish(data, name, place, temporary=temporary, partition_by=["p.q", "r"])
    batch = sources.rows(spark, [(0, "it's", True), (10, "01", True), (77, None, None)], "k INT, `p.q` STRING, r BOOLEAN")
    want = _rows(type1.upsert(data, batch, "k"))
    out = sources.upsert_touched(name, batch, "k", place, ["P.Q", "r"], type1.upsert, snapshot="s", temporary=temporary)
    assert _rows(out) == want
    assert out.columns == data.columns


def test_untouched_partitions_are_not_read(spark, tmp_path):
    place = str(tmp_path / "t")
    table = sources.publish(_table(spark), "pruned", place, temporary=True, partition_by=["p"])
    batch = sources.rows(spark, [(107, 7, "new")], "k BIGINT, p INT, v STRING")
    from dimkeeper.sources.publish import _among

    text = plan(type1.upsert(table, batch, "k").where(_among(["p"], [("7",)])))
    scan = next(line for line in text.splitlines() if "FileScan" in line or "PartitionFilters" in line)
    assert "PartitionFilters: []" not in scan


def test_nothing_touched_writes_nothing(spark, tmp_path):
    place = str(tmp_path / "t")
    table = sources.publish(_table(spark), "untouched", place, temporary=True, partition_by=["p"])
    out = sources.publish_touched(table, table.select("p").where("false"), "untouched", place)
    assert out.count() == 1000 and len(os.listdir(place)) == 1


def test_another_partitioning_is_refused(spark, tmp_path):
    table = sources.publish(_table(spark), "others", str(tmp_path / "t"), temporary=True, partition_by=["p"])
    with pytest.raises(ValueError, match="no partition by"):
        sources.publish_touched(table, table.select("v").distinct(), "others", str(tmp_path / "t"))


def test_a_relative_folder(spark, tmp_path, monkeypatch):
    relative = os.path.relpath(tmp_path / "it's here")
    for by in ([], ["p"]):
        out = sources.publish(_table(spark, 10, 2), f"relative{len(by)}", relative, partition_by=by)
        assert out.count() == 10


def test_clustered_files_hold_ranges(spark, tmp_path):
    data = _table(spark, 20_000, 3).orderBy(F.xxhash64("k"))
    with_ranges = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = sources.publish(data, "ranges", str(tmp_path / "t"), cluster_by=["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_ranges)
    ranges, sorted_rows = [], []
    for file in out.inputFiles():
        keys = pq.read_table(file.removeprefix("file://")).column("k").to_pylist()
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1]))
        sorted_rows += keys
    ranges.sort()
    assert len(ranges) == 4 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))
    assert sorted(sorted_rows) == list(range(20_000))
    # A key lies within the statistics of one file of four.
    assert sum(low <= 1234 <= high for low, high in ranges) == 1
