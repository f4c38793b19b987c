"""A persistent view over literal rows as a batch, and results in the order of a key."""

from __future__ import annotations

import random

from dimkeeper import sources
from dimkeeper.operators import History, type1


def test_merge_from_a_persistent_view(spark):
    sources.create_database(spark, "view_test", use=True)
    try:
        spark.sql("CREATE VIEW changes AS SELECT * FROM VALUES (2L, 'new'), (31L, 'more') AS v(k, name)")
        table = sources.rows(spark, [(1, "one"), (2, "two")], "k BIGINT, name STRING")
        batch = sources.read_table(spark, "view_test.changes")
        assert {tuple(r) for r in type1.upsert(table, batch, "k").collect()} == {(1, "one"), (2, "new"), (31, "more")}
        import datetime as dt

        people = History("k")
        first = people.apply(sources.rows(spark, [], "id BIGINT, k BIGINT, name STRING, start_date DATE, end_date DATE"), table, dt.date(2020, 1, 1))
        second = people.apply(first, sources.read_table(spark, "view_test.changes"), dt.date(2021, 1, 1))
        assert {(r.k, r.name) for r in people.active(second).collect()} == {(1, "one"), (2, "new"), (31, "more")}
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE view_test CASCADE")


def test_rows_come_in_the_order_of_the_key(spark):
    keys = list(range(500))
    random.Random(4).shuffle(keys)
    table = sources.rows(spark, [(k, f"n{k}") for k in keys] + [(None, "none")], "k BIGINT, name STRING").repartition(7)
    found = [r.k for r in table.orderBy("k").collect()]
    assert found == [None, *range(500)]
