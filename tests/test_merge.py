from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators import AmbiguousMatchError, SchemaMismatchError, ambiguous_keys, merge
from tests import model

SCHEMA = "k BIGINT, j STRING, a STRING, n INT"
BROADCAST, SHUFFLE = None, -1


def frame(spark, rows, schema=SCHEMA):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema)


def random_rows(seed, size, keys, unique=True):
    """Rows with a composite key, nulls in keys and values, and keys that only some frames have."""
    r = random.Random(seed)
    pick = r.sample(range(keys), size) if unique else [r.randrange(keys) for _ in range(size)]
    return [
        {
            "k": k if r.random() < 0.9 else None,
            "j": r.choice(["x", "x", "x", None]) if r.random() < 0.2 else "x",
            "a": r.choice(["red", "green", None]),
            "n": r.choice([1, 2, 3, None]),
        }
        for k in pick
    ]


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
@pytest.mark.parametrize("full_outer", [False, True])
@pytest.mark.parametrize("not_matched", ["all", None])
def test_update_all(spark, limit, full_outer, not_matched):
    target, updates = random_rows(1, 60, 100), random_rows(2, 40, 120)
    got = merge(
        frame(spark, target),
        frame(spark, updates),
        ["k", "j"],
        not_matched=not_matched,
        full_outer=full_outer,
        limit=limit,
    )
    assert got.columns == ["k", "j", "a", "n"]
    assert model.bag_of(got) == model.bag(
        model.merge(target, updates, ["k", "j"], not_matched=not_matched)
    )


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
@pytest.mark.parametrize("full_outer", [False, True])
@pytest.mark.parametrize("not_matched", ["all", None])
def test_update_set(spark, limit, full_outer, not_matched):
    target, updates = random_rows(3, 60, 100), random_rows(4, 40, 120)
    got = merge(
        frame(spark, target),
        frame(spark, updates),
        ["k", "j"],
        matched={"N": "t.n + u.n", "a": F.lit("set")},
        not_matched=not_matched,
        full_outer=full_outer,
        limit=limit,
    )

    def change(t, u):
        both = t["n"] is not None and u["n"] is not None
        return {**t, "n": t["n"] + u["n"] if both else None, "a": "set"}

    assert model.bag_of(got) == model.bag(
        model.merge(target, updates, ["k", "j"], matched=change, not_matched=not_matched)
    )


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
def test_insert_only_takes_repeated_rows(spark, limit):
    """Matched rows stay, repeated new keys and rows without key are all inserted."""
    target, updates = random_rows(5, 60, 100), random_rows(6, 90, 120, unique=False)
    got = merge(frame(spark, target), frame(spark, updates), ["k"], matched=None, limit=limit)
    assert model.bag_of(got) == model.bag(model.merge(target, updates, ["k"], matched=None))


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
@pytest.mark.parametrize("matched", ["all", {"a": "u.a"}])
def test_repeated_keys(spark, limit, matched):
    target = [{"k": 1, "j": "x", "a": "old", "n": 1}]
    new = [{"k": 2, "j": "x", "a": "red", "n": i} for i in (1, 1, 2)]
    got = merge(frame(spark, target), frame(spark, new), "k", matched=matched, limit=limit)
    assert model.bag_of(got) == model.bag(target + new)
    hit = [{"k": 1, "j": "x", "a": "red", "n": i} for i in (1, 2)]
    with pytest.raises(AmbiguousMatchError, match="1 keys.*'k': 1"):
        merge(frame(spark, target), frame(spark, new + hit), "k", matched=matched, limit=limit)
    # Without an update clause there is nothing ambiguous.
    kept = merge(frame(spark, target), frame(spark, new + hit), "k", matched=None, limit=limit)
    assert model.bag_of(kept) == model.bag(target + new)


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
def test_ambiguous_keys(spark, limit):
    target = [{"k": k, "j": "x", "a": "t", "n": 1} for k in (1, 2, 3, None)]
    updates = [{"k": k, "j": "x", "a": "u", "n": 1} for k in (1, 1, 2, 9, 9, None, None)]
    got = ambiguous_keys(frame(spark, target), frame(spark, updates), "K", limit)
    assert [tuple(r) for r in got.collect()] == [(1, 2)]


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
@pytest.mark.parametrize("full_outer", [False, True])
def test_evolve(spark, limit, full_outer):
    """A column of the batch is added; a column of the table only is kept or null."""
    target = random_rows(7, 60, 100)
    updates = [
        {"k": r["k"], "j": r["j"], "n": r["n"], "extra": i}
        for i, r in enumerate(random_rows(8, 40, 120))
    ]
    got = merge(
        frame(spark, target),
        frame(spark, updates, "k INT, j STRING, n INT, extra INT"),
        ["k", "j"],
        evolve=True,
        full_outer=full_outer,
        limit=limit,
    )
    assert dict(got.dtypes) == {
        "k": "bigint",
        "j": "string",
        "a": "string",
        "n": "int",
        "extra": "int",
    }
    want = model.merge(target, updates, ["k", "j"], columns=["a", "extra"])
    assert model.bag_of(got) == model.bag(want)


def test_schema_mismatch(spark):
    target = frame(spark, random_rows(9, 5, 10))
    with pytest.raises(SchemaMismatchError, match="extra"):
        merge(target, target.withColumn("extra", F.lit(1)), "k")
    with pytest.raises(SchemaMismatchError, match="lacks"):
        merge(target, target.drop("a"), "k")
    with pytest.raises(ValueError, match="nokey"):
        merge(target, target, "nokey")


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
@pytest.mark.parametrize("full_outer", [False, True])
def test_matched_when(spark, limit, full_outer):
    target, updates = random_rows(10, 60, 100), random_rows(11, 40, 120)
    got = merge(
        frame(spark, target),
        frame(spark, updates),
        ["k", "j"],
        matched_when=F.col("t.n") < F.col("u.n"),
        full_outer=full_outer,
        limit=limit,
    )

    def change(t, u):
        known = t["n"] is not None and u["n"] is not None
        return u if known and t["n"] < u["n"] else t

    want = model.merge(target, updates, ["k", "j"], matched=change)
    assert model.bag_of(got) == model.bag(want)


@pytest.mark.parametrize("limit", [BROADCAST, SHUFFLE])
def test_empty_sides(spark, limit):
    rows = random_rows(12, 10, 20)
    some, none = frame(spark, rows), frame(spark, [])
    assert model.bag_of(merge(some, none, "k", limit=limit)) == model.bag(rows)
    assert model.bag_of(merge(none, some, "k", limit=limit)) == model.bag(rows)
    assert merge(none, none, "k", limit=limit).count() == 0


def test_names_and_types_follow_the_table(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "Key BIGINT, Val STRING")
    updates = spark.createDataFrame([("new", 2), ("c", 3)], "VAL STRING, key INT")
    got = merge(target, updates, "KEY")
    assert got.schema == target.schema
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "new"), (3, "c")]


def test_upsert_twice_changes_nothing(spark):
    target, updates = random_rows(13, 40, 60), random_rows(14, 30, 80)
    updates = [u for u in updates if u["k"] is not None]
    once = merge(frame(spark, target), frame(spark, updates), "k")
    twice = merge(once, frame(spark, updates), "k")
    assert model.bag_of(once) == model.bag_of(twice)
