"""JSON arrays read in blocks give the rows that reading them whole gives."""

from __future__ import annotations

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimkeeper import sources
from dimkeeper.sources.arrays import array_records

SCHEMA = "id BIGINT, note STRING, more STRUCT<a: ARRAY<INT>, b: STRUCT<c: STRING>>"


def records(n, seed=1):
    r = random.Random(seed)
    odd = ['}', '{', '[', ']', '"', '\\', '\\"', '},{', 'é', '😀', ',', ' ', '\n', 'x' * 40]
    text = lambda: "".join(r.choice(odd) for _ in range(r.randint(0, 12)))
    return [{"id": i, "note": text(), "more": {"a": [1, i], "b": {"c": text()}}} for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0"}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def rows(frame):
    return Counter((r["id"], r["note"], str(r["more"])) for r in frame.collect())


@pytest.mark.parametrize("indent", [None, 2])
def test_blocks_give_equal_rows(spark, tmp_path, small_blocks, indent):
    for k, n in enumerate((150, 40)):
        (tmp_path / f"{k}.json").write_text(json.dumps(records(n, k), ensure_ascii=bool(k), indent=indent))
    found = sources.load_json(spark, str(tmp_path), SCHEMA, array=True)
    whole = spark.read.schema(SCHEMA).json(str(tmp_path), multiLine=True, mode="FAILFAST")
    assert rows(found) == rows(whole) and found.count() == 190
    # One file is read by many tasks.
    one = spark.read.option("lineSep", "}").text(str(tmp_path / "0.json"))
    assert one.rdd.getNumPartitions() > 10


def test_a_record_longer_than_blocks(spark, tmp_path, small_blocks):
    long = [{"id": 1, "note": "}{" * 3000, "more": None}, {"id": 2, "note": "[", "more": None}, {"id": 3, "note": 'x"' * 2000, "more": None}]
    (tmp_path / "long.json").write_text(json.dumps(long))
    found = sources.load_json(spark, str(tmp_path), SCHEMA, array=True)
    assert {(r["id"], r["note"]) for r in found.collect()} == {(x["id"], x["note"]) for x in long}


@pytest.mark.parametrize("text, n", [("", 0), ("[]", 0), (" [ ] \n", 0), ('[{}]', 1), ('{"id": 4}', 1), (' [\n{"id": 4} , {"id": 5}]\n', 2)])
def test_small_files(spark, tmp_path, text, n):
    (tmp_path / "one.json").write_text(text)
    assert sources.load_json(spark, str(tmp_path), SCHEMA, array=True).count() == n


@pytest.mark.parametrize("text", ['[{"id": 1}', '[{"id": 1}]]', '[{"note": "a}]', '[{"id": 1}, 7]', '[[{"id": 1}]]', '["a"]', '[{"id": "x"}]', '[{"id" 1}]'])
def test_broken_arrays_are_errors(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="MALFORMED"):
        sources.load_json(spark, str(tmp_path), SCHEMA, array=True).collect()


def test_pieces_are_few(spark, tmp_path, small_blocks):
    """Only records that cross blocks are shuffled."""
    (tmp_path / "some.json").write_text(json.dumps(records(100)))
    frame = array_records(spark, str(tmp_path))
    plan = frame._jdf.queryExecution().toString()
    assert "Window" in plan and frame.where(F.col("value").startswith("{")).count() == 100
