"""Properties that hold for any batch."""

from __future__ import annotations

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dimkeeper.operators import ChangeLog, History, merge
from dimkeeper.session import stage
from tests import model

FEW = settings(
    max_examples=6,
    deadline=None,
    derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
values = st.one_of(st.none(), st.sampled_from(["a", "b"]))
keys = st.integers(0, 9)
tables = st.dictionaries(keys, values, max_size=8)
limits = st.sampled_from([None, -1])
SCHEMA = "k BIGINT, v STRING"


def frame(spark, table):
    return spark.createDataFrame(list(table.items()), SCHEMA)


@FEW
@given(tables, tables, limits)
def test_upsert_equals_dict_update_and_is_idempotent(spark, old, new, limit):
    once = merge(frame(spark, old), frame(spark, new), "k", limit=limit)
    assert dict(map(tuple, once.collect())) == {**old, **new}
    again = merge(stage(once), frame(spark, new), "k", limit=limit)
    assert model.bag_of(again) == model.bag_of(once)


@FEW
@given(st.lists(tables, min_size=1, max_size=2), limits, st.sampled_from(["active", "all"]))
def test_history_has_one_open_row_per_key_and_gapless_ids(spark, batches, limit, expire):
    schema = "id BIGINT, k BIGINT, v STRING, start_date DATE, end_date DATE"
    history, day = spark.createDataFrame([], schema), dt.date(2024, 1, 1)
    for n, batch in enumerate(batches):
        day = dt.date(2024, 1, n + 1)
        history = stage(History("k").apply(history, frame(spark, batch), day, expire, limit=limit))
    rows = history.collect()
    assert sorted(r.id for r in rows) == list(range(sum(map(len, batches))))
    latest = {k: v for batch in batches for k, v in batch.items()}
    assert {r.k: r.v for r in rows if r.end_date is None} == latest
    assert set(Counter(r.k for r in rows if r.end_date is None).values()) <= {1}


@FEW
@given(tables, tables.filter(bool), tables.filter(bool), limits)
def test_versions_do_not_change_and_can_be_restored(spark, first, second, third, limit):
    log = ChangeLog.start(frame(spark, first), "k", limit)
    states = [first]
    for version, batch in enumerate((second, third), start=1):
        log = log.with_changes(log.merge(frame(spark, batch), version))
        states.append({**states[-1], **batch})
    log = log.with_changes(log.restore(1, 3), version=3)
    states.append(states[1])
    for version, want in enumerate(states):
        assert dict(map(tuple, log.as_of(version).collect())) == want
