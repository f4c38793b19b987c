"""Type 1 scenario: one attribute of one known key is overwritten."""

from __future__ import annotations

import pytest

from dimkeeper.operators import AmbiguousMatchError, type1
from dimkeeper.sources import rows

PEOPLE = "employee_id BIGINT, first_name STRING, last_name STRING, job_title STRING"
STAFF = [
    (1, "Ada", "Ruiz", "Engineer"),
    (2, "Ben", "Okafor", "Clerk"),
    (3, "Cleo", "Lind", "Analyst"),
]


@pytest.mark.parametrize("limit", [None, -1])
def test_job_title_is_replaced(spark, limit):
    staff = rows(spark, STAFF, PEOPLE)
    # The key of the batch is a 32-bit integer, that of the table a 64-bit one.
    batch = rows(spark, [(2, "Ben", "Okafor", "Lawyer")], PEOPLE.replace("BIGINT", "INT"))
    merged = type1.upsert(staff, batch, "employee_id", limit)
    assert merged.schema == staff.schema
    assert merged.count() == len(STAFF)
    found = merged.where("first_name = 'Ben' AND last_name = 'Okafor'").collect()
    assert [r.job_title for r in found] == ["Lawyer"]


def test_new_key_is_inserted(spark):
    staff = rows(spark, STAFF, PEOPLE)
    merged = type1.upsert(staff, rows(spark, [(9, "Dee", "Hall", "Cook")], PEOPLE), "employee_id")
    assert sorted(r.employee_id for r in merged.collect()) == [1, 2, 3, 9]


def test_two_rows_for_one_person_are_refused(spark):
    staff = rows(spark, STAFF, PEOPLE)
    batch = rows(spark, [(2, "Ben", "Okafor", t) for t in ("Lawyer", "Judge")], PEOPLE)
    with pytest.raises(AmbiguousMatchError):
        type1.upsert(staff, batch, "employee_id")
