from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dimkeeper.operators import AmbiguousMatchError, History
from dimkeeper.sources import rows

SCHEMA = "id BIGINT, k BIGINT, name STRING, city STRING, start_date DATE, end_date DATE"
BATCH = "k INT, name STRING, city STRING"
BEGIN, EFF, LATER = dt.date(2010, 1, 1), dt.date(2024, 1, 1), dt.date(2024, 6, 1)
PEOPLE = History("k")


def start(spark, n=30):
    return rows(spark, [(k - 1, k, f"p{k}", "Oslo", BEGIN, None) for k in range(1, n + 1)], SCHEMA)


def by_key(df, *keys):
    found = df.where(df.k.isin(*keys)).orderBy("k", "start_date", "id").collect()
    return [(r.k, r.name, r.city, r.start_date, r.end_date) for r in found]


@pytest.mark.parametrize("limit", [None, -1])
def test_scenario(spark, limit):
    """Two changed people: one closed and one open row each, ids without gaps."""
    batch = rows(spark, [(6, "p6", "Bergen"), (21, "q21", "Oslo")], BATCH)
    got = PEOPLE.apply(start(spark), batch, EFF, limit=limit)
    assert got.columns == start(spark).columns
    assert by_key(got, 6, 21) == [
        (6, "p6", "Oslo", BEGIN, EFF),
        (6, "p6", "Bergen", EFF, None),
        (21, "p21", "Oslo", BEGIN, EFF),
        (21, "q21", "Oslo", EFF, None),
    ]
    assert sorted(r.id for r in got.collect()) == list(range(32))
    assert {r.k: r.id for r in got.where("start_date > '2020-01-01'").collect()} == {6: 30, 21: 31}
    assert PEOPLE.inactive(got).count() == 2
    assert PEOPLE.active(got).count() == 30
    flags = PEOPLE.with_active_flag(got).groupBy("is_active").count().collect()
    assert {r[0]: r[1] for r in flags} == {True: 30, False: 2}


@pytest.mark.parametrize("limit", [None, -1])
def test_second_batch_finds_the_rows_of_the_first(spark, limit):
    first = PEOPLE.apply(start(spark), rows(spark, [(6, "p6", "Bergen")], BATCH), EFF, limit=limit)
    batch = rows(spark, [(6, "p6", "Molde"), (99, "new", "Voss")], BATCH)
    second = PEOPLE.apply(first, batch, LATER, limit=limit)
    assert by_key(second, 6, 99) == [
        (6, "p6", "Oslo", BEGIN, EFF),
        (6, "p6", "Bergen", EFF, LATER),
        (6, "p6", "Molde", LATER, None),
        (99, "new", "Voss", LATER, None),
    ]
    assert sorted(r.id for r in second.collect()) == list(range(33))


@pytest.mark.parametrize("limit", [None, -1])
def test_expire_all_stamps_closed_rows_again(spark, limit):
    first = PEOPLE.apply(start(spark), rows(spark, [(6, "p6", "Bergen")], BATCH), EFF)
    batch = rows(spark, [(6, "p6", "Molde")], BATCH)
    second = PEOPLE.apply(first, batch, LATER, expire="all", limit=limit)
    assert by_key(second, 6) == [
        (6, "p6", "Oslo", BEGIN, LATER),
        (6, "p6", "Bergen", EFF, LATER),
        (6, "p6", "Molde", LATER, None),
    ]
    with pytest.raises(ValueError, match="expire"):
        PEOPLE.apply(first, batch, LATER, expire="some")


@pytest.mark.parametrize("limit", [None, -1])
def test_skip_unchanged(spark, limit):
    """Only updates that differ from the open row count; null equals null."""
    table = rows(
        spark,
        [
            (0, 1, "a", None, BEGIN, None),
            (1, 2, "b", "Oslo", BEGIN, None),
            (2, 3, "c", "Oslo", BEGIN, EFF),
            (3, 3, "c", "Rome", EFF, None),
            (4, 4, None, None, BEGIN, None),
        ],
        SCHEMA,
    )
    batch = rows(
        spark,
        [(1, "a", None), (2, "b", None), (3, "c", "Oslo"), (4, None, None), (5, "e", "Kyiv")],
        BATCH,
    )
    got = PEOPLE.apply(table, batch, LATER, skip_unchanged=True, limit=limit)
    opened = got.where("start_date = '2024-06-01'").collect()
    assert {(r.k, r.name, r.city, r.id) for r in opened} == {
        (2, "b", None, 5),
        (3, "c", "Oslo", 6),
        (5, "e", "Kyiv", 7),
    }
    assert {r.k for r in got.where("end_date = '2024-06-01'").collect()} == {2, 3}


def test_change_rows(spark):
    table = PEOPLE.apply(start(spark), rows(spark, [(6, "p6", "Bergen")], BATCH), EFF)
    batch = rows(spark, [(6, "p6", "Molde"), (50, "x", "Rome")], BATCH)
    for limit in (None, -1):
        got = PEOPLE.change_rows(table, batch, LATER, limit).collect()
        assert Counter((r.id, r.k, r.city, r.start_date, r.end_date) for r in got) == Counter(
            [
                (None, 6, "Molde", LATER, None),
                (None, 50, "Rome", LATER, None),
                (5, 6, "Oslo", BEGIN, EFF),
                (30, 6, "Bergen", EFF, None),
            ]
        )


def test_two_updates_for_one_key_are_refused(spark):
    batch = rows(spark, [(6, "p6", "Bergen"), (6, "p6", "Molde")], BATCH)
    with pytest.raises(AmbiguousMatchError):
        PEOPLE.apply(start(spark), batch, EFF)


@pytest.mark.parametrize("limit", [None, -1])
def test_rows_without_key_match_nothing(spark, limit):
    table = rows(
        spark, [(0, None, "ghost", "Oslo", BEGIN, None), (1, 1, "a", "Oslo", BEGIN, None)], SCHEMA
    )
    batch = rows(spark, [(None, "ghost", "Rome"), (None, "ghost", "Bari"), (1, "a", "Rome")], BATCH)
    for expire in ("active", "all"):
        got = PEOPLE.apply(table, batch, EFF, expire=expire, limit=limit)
        assert sorted(((r.name, r.city, r.end_date) for r in got.collect()), key=str) == [
            ("a", "Oslo", EFF),
            ("a", "Rome", None),
            ("ghost", "Bari", None),
            ("ghost", "Oslo", None),
            ("ghost", "Rome", None),
        ]
        assert sorted(r.id for r in got.collect()) == [0, 1, 2, 3, 4]


def test_empty_sides(spark):
    empty = rows(spark, [], SCHEMA)
    fresh = PEOPLE.apply(empty, rows(spark, [(2, "b", "x"), (1, "a", "y")], BATCH), EFF)
    assert {(r.k, r.id) for r in fresh.collect()} == {(1, 0), (2, 1)}
    same = PEOPLE.apply(start(spark), rows(spark, [], BATCH), EFF)
    assert sorted(map(tuple, same.collect())) == sorted(map(tuple, start(spark).collect()))


def test_ids_in_the_batch_are_ignored(spark):
    batch = rows(spark, [(777, 6, "p6", "Bergen")], "id INT, k INT, name STRING, city STRING")
    got = PEOPLE.apply(start(spark), batch, EFF)
    assert [r.id for r in got.where("city = 'Bergen'").collect()] == [30]


def test_default_date_is_today(spark):
    got = PEOPLE.apply(start(spark), rows(spark, [(6, "p6", "Bergen")], BATCH))
    (opened,) = got.where("city = 'Bergen'").collect()
    assert abs((opened.start_date - dt.date.today()).days) <= 1


def test_other_column_names_and_composite_key(spark):
    roles = History(["org", "k"], surrogate="sk", start="valid_from", end="valid_to")
    table = rows(
        spark,
        [(0, "a", 1, "x", BEGIN, None), (1, "b", 1, "y", BEGIN, None)],
        "SK INT, org STRING, K BIGINT, v STRING, valid_from DATE, valid_to DATE",
    )
    batch = rows(spark, [("a", 1, "z"), ("c", 1, "w")], "org STRING, k INT, V STRING")
    got = roles.apply(table, batch, EFF)
    assert got.dtypes == table.dtypes
    assert sorted(map(tuple, got.collect())) == [
        (0, "a", 1, "x", BEGIN, EFF),
        (1, "b", 1, "y", BEGIN, None),
        (2, "a", 1, "z", EFF, None),
        (3, "c", 1, "w", EFF, None),
    ]


def test_renumber_closes_gaps_and_fills_nulls(spark):
    r = random.Random(5)
    data = [(r.choice([None, 10 * i + r.randrange(10)]), i % 7, f"n{i}", "c", BEGIN, None) for i in range(200)]
    table = rows(spark, data, SCHEMA).repartition(5)
    got = PEOPLE.renumber(table).collect()
    assert sorted(r.id for r in got) == list(range(200))
    want = sorted(data, key=lambda d: (d[0] is None, d[0] or 0, d[1], d[2]))
    assert {r.name: r.id for r in got} == {d[2]: i for i, d in enumerate(want)}


@pytest.mark.parametrize("limit", [None, -1])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_batches_keep_the_invariants(spark, seed, limit):
    """At most one open row per key, gapless unique ids, closed rows never touched again."""
    r = random.Random(seed)
    table, day = start(spark, 15), EFF
    for _ in range(3):
        keys = r.sample(range(1, 25), 8)
        batch = rows(spark, [(k, f"p{k}", r.choice(["Oslo", "Rome", None])) for k in keys], BATCH)
        before = {x.id: x for x in table.collect()}
        table = PEOPLE.apply(table, batch, day, limit=limit)
        after = {x.id: x for x in table.collect()}
        assert sorted(after) == list(range(len(before) + len(keys)))
        assert max(Counter(x.k for x in after.values() if x.end_date is None).values()) == 1
        for i, old in before.items():
            hit = old.end_date is None and old.k in keys
            assert after[i].end_date == (day if hit else old.end_date)
            assert after[i][:5] == old[:5]
        day += dt.timedelta(days=1)
        table = spark.createDataFrame(list(after.values()), SCHEMA)


@pytest.mark.parametrize("limit", [None, -1])
def test_skip_unchanged_keeps_rows_without_key_and_refuses_maps(spark, limit):
    table = rows(spark, [(0, None, "a", None, BEGIN, None), (1, 2, "b", "Oslo", BEGIN, None)], SCHEMA)
    batch = rows(spark, [(None, "a", None), (None, "a", None), (2, "b", "Oslo")], BATCH)
    got = PEOPLE.apply(table, batch, LATER, skip_unchanged=True, limit=limit)
    opened = got.where("start_date = '2024-06-01'").collect()
    assert [(r.k, r.name) for r in opened] == [(None, "a")] * 2
    with_map = [df.withColumn("m", F.create_map(F.lit("x"), F.col("name"))) for df in (table, batch)]
    with pytest.raises(ValueError, match="maps cannot be compared"):
        PEOPLE.apply(*with_map, LATER, skip_unchanged=True, limit=limit)
