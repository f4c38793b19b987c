from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from dimkeeper import sources
from dimkeeper.operators import History, type1

# The columns of an employee record, as the loader expects them.
RECORD = (
    "id BIGINT, first_name STRING, last_name STRING, gender STRING, address_street STRING, "
    "address_city STRING, address_country STRING, email STRING, job_title STRING, "
    "start_date STRING, end_date STRING"
)
ATTRIBUTES = RECORD.replace(" STRING", "").replace("id BIGINT, ", "").split(", ")[:8]


def record(n, **changes):
    values = {c: f"{c}-{n}" for c in ATTRIBUTES}
    return {"id": n, **values, "start_date": f"2019-02-{n:02d}", "end_date": None, **changes}


def load(spark, path, **options):
    return sources.load_json(
        spark,
        str(path),
        RECORD,
        dates=["start_date", "end_date"],
        rename={"id": "employee_id"},
        add={"previous_country": "string"},
        **options,
    )


@pytest.mark.parametrize("array", [False, True])
def test_json(spark, tmp_path, array):
    short = record(2, end_date="not a date")
    del short["email"]
    records = [record(1), short, record(3, end_date="2020-03-04")]
    path = tmp_path / "people.json"
    path.write_text(json.dumps(records) if array else "\n".join(map(json.dumps, records)))
    frame = load(spark, path, array=array)
    assert frame.columns[0] == "employee_id" and frame.columns[-1] == "previous_country"
    assert dict(frame.dtypes)["end_date"] == "date"
    assert all(field.nullable for field in frame.schema)
    one, two, three = frame.orderBy("employee_id").collect()
    assert one.start_date == dt.date(2019, 2, 1) and one.end_date is None
    assert two.email is None and two.end_date is None
    assert three.end_date == dt.date(2020, 3, 4)
    assert {r.previous_country for r in (one, two, three)} == {None}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load(spark, path, array=array, strict_dates=True).collect()


def test_broken_json_is_an_error(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('{"id": 1}\n{"id": ')
    with pytest.raises(Exception, match="MALFORMED"):
        load(spark, path).collect()


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("json") / "people.json"
    path.write_text("\n".join(json.dumps(record(n)) for n in range(1, 13)))
    return load(spark, path)


def test_setup_shapes(base):
    key = "employee_id"
    assert sources.type1_table(base, key, ATTRIBUTES).columns == [key, *ATTRIBUTES]
    two = sources.type2_table(base, key, ATTRIBUTES)
    assert two.columns == ["id", key, *ATTRIBUTES, "start_date", "end_date"]
    assert {r.employee_id - r.id for r in two.collect()} == {1}
    three = sources.type3_table(base, key, ["first_name", "address_country"])
    assert three.columns == [key, "first_name", "address_country"]
    four = sources.top_keys(base, key, ATTRIBUTES)
    assert [r.employee_id for r in four.collect()] == [1, 2, 3, 4, 5]


def test_inline(spark):
    by_code = sources.rows(spark, [(1, "a"), (2, None)], "k INT, v STRING")
    by_sql = sources.values(spark, "(1, 'a'), (2, null)", ["k", "v"])
    assert by_code.collect() == by_sql.collect()
    assert by_sql.dtypes == [("k", "int"), ("v", "string")]
    with pytest.raises(ValueError, match="3 names for 2 columns"):
        sources.values(spark, "(1, 'a')", ["k", "v", "w"])


def test_database_and_tables(spark, base):
    sources.create_database(spark, "scd_test", use=True)
    try:
        made = sources.create_table(sources.type1_table(base, "employee_id", ATTRIBUTES), "Staff")
        assert made.count() == 12
        assert sources.read_table(spark, "scd_test.STAFF").count() == 12
        # Creating it again replaces it.
        assert sources.create_table(base.limit(3), "staff").count() == 3
        parts = sources.create_table(base, "by_city", partition_by=["address_country"])
        assert parts.count() == 12
        for name in ("staff", "by_city"):
            sources.drop_table(spark, name)
        assert not spark.catalog.tableExists("scd_test.staff")
    finally:
        spark.catalog.setCurrentDatabase("default")
        spark.sql("DROP DATABASE scd_test CASCADE")


def test_views(spark, base):
    base.createOrReplaceTempView("people_now")
    assert sources.read_table(spark, "PEOPLE_NOW").count() == 12
    sources.drop_view(spark, "people_now")
    assert not spark.catalog.tableExists("people_now")


@pytest.mark.parametrize("temporary", [True, False])
def test_publish_replaces_the_state_it_reads(spark, base, tmp_path, temporary):
    name, place = f"published_{temporary}".lower(), str(tmp_path)
    first = sources.publish(
        sources.type1_table(base, "employee_id", ATTRIBUTES), name, place, temporary=temporary
    )
    reader = spark.read.parquet(*first.inputFiles())
    change = first.where("employee_id = 2").withColumn("job_title", F.lit("Lawyer"))
    merged = type1.upsert(spark.table(name), change, "employee_id")
    now = sources.publish(merged, name, place, snapshot="second", temporary=temporary)
    assert now.where("job_title = 'Lawyer'").count() == 1
    assert spark.table(name).count() == 12
    # Whoever reads the first state still finds it.
    assert reader.where("job_title = 'Lawyer'").count() == 0 and reader.count() == 12
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sources.publish(merged, name, place, snapshot="second", temporary=temporary)


def test_publish_by_partition(spark, tmp_path):
    """History split into open and closed rows, so a merge may read open ones only."""
    people = History("k")
    table = sources.rows(
        spark,
        [(0, 1, dt.date(2020, 1, 1), None), (1, 2, dt.date(2020, 1, 1), dt.date(2021, 1, 1))],
        "id BIGINT, k BIGINT, start_date DATE, end_date DATE",
    )
    made = sources.publish(
        people.with_active_flag(table), "split", str(tmp_path), temporary=True, partition_by=["is_active"]
    )
    assert [r.k for r in made.where("is_active").collect()] == [1]
    assert made.where("is_active").drop("is_active").columns == table.columns


@pytest.mark.parametrize("temporary", [True, False])
def test_published_partitions_keep_types_and_order(spark, tmp_path, temporary):
    data = sources.rows(spark, [("01", 1, None), ("1", 2, "a"), (None, 3, "b")], "p STRING, k INT, v STRING")
    name = f"parted_{temporary}".lower()
    out = sources.publish(data, name, str(tmp_path / "t"), temporary=temporary, partition_by=["p"])
    assert out.columns == data.columns
    assert out.dtypes == data.dtypes
    assert {tuple(r) for r in out.collect()} == {("01", 1, None), ("1", 2, "a"), (None, 3, "b")}
