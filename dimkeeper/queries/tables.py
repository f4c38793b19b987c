"""Sources, sinks and setup."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.operators import type1, type3
from dimkeeper.queries import inputs
from dimkeeper.queries.registry import query
from dimkeeper.session import fresh_path
from dimkeeper.sources import (
    load_json,
    publish,
    read_table,
    rows,
    top_keys,
    type1_table,
    type2_table,
    type3_table,
    upsert_touched,
    values,
)

_ATTRIBUTES = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

# Two literal update rows, one for a known customer and one for a new one.
_INLINE_ROWS = [
    (7, "Customer#000000007", 3, 100.25, "INLINE"),
    (-500000, "Newcomer", 11, 5.5, "INLINE"),
]
_INLINE_SQL = (
    "(7, 'Customer#000000007', 3, 100.25D, 'INLINE'), (-500000, 'Newcomer', 11, 5.5D, 'INLINE')"
)
_INLINE_CTE = """
upd(c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment) AS (
  SELECT CAST(a AS BIGINT), b, CAST(c AS INTEGER), CAST(d AS DOUBLE), e
  FROM (VALUES (7, 'Customer#000000007', 3, 100.25, 'INLINE'),
               (-500000, 'Newcomer', 11, 5.5, 'INLINE')) v(a, b, c, d, e))"""


@query(inputs.with_sql(_INLINE_CTE, inputs.UPSERT_SQL) + "SELECT * FROM state1")
def src_inline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Literal rows with a schema, merged into the whole table; the key is a narrower integer."""
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.IntegerType(), True),
            T.StructField("c_name", T.StringType(), True),
            T.StructField("c_nationkey", T.IntegerType(), True),
            T.StructField("c_acctbal", T.DoubleType(), True),
            T.StructField("c_mktsegment", T.StringType(), True),
        ]
    )
    batch = rows(spark, _INLINE_ROWS, schema)
    return type1.upsert(inputs.table(spark, folder, "customer"), batch, "c_custkey")


@query(
    inputs.with_sql(_INLINE_CTE)
    + """
SELECT coalesce(u.c_custkey, c.c_custkey) AS c_custkey,
       CASE WHEN u.c_custkey IS NULL THEN c.c_name ELSE u.c_name END AS c_name,
       CASE WHEN u.c_custkey IS NULL THEN c.c_nationkey ELSE u.c_nationkey END AS c_nationkey,
       CASE WHEN u.c_custkey IS NULL THEN c.c_acctbal ELSE u.c_acctbal END AS c_acctbal,
       CASE WHEN u.c_custkey IS NULL THEN c.c_mktsegment ELSE u.c_mktsegment END AS c_mktsegment,
       CASE WHEN u.c_custkey IS NOT NULL THEN c.c_mktsegment END AS previous_c_mktsegment
FROM customer c FULL JOIN upd u ON c.c_custkey = u.c_custkey"""
)
def src_inline_values(spark: SparkSession, folder: str) -> DataFrame:
    """An inline table with named positions, merged into the whole table as type 3."""
    batch = values(spark, _INLINE_SQL, inputs.COLUMNS)
    customer = inputs.table(spark, folder, "customer")
    return type3.apply(customer, batch, "c_custkey", "c_mktsegment")


@query(
    """
SELECT o_orderkey AS order_id, o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) AS start_date,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS end_date,
       CAST(NULL AS VARCHAR) AS previous_priority
FROM orders"""
)
def src_json_load(spark: SparkSession, folder: str) -> DataFrame:
    """All orders written as JSON and loaded again.

    Finished orders have an end date, open ones the text "open", which is no date, and the
    others lack the field.
    """
    path = fresh_path(spark, "json")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    inputs.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        "o_custkey",
        "o_orderpriority",
        day.alias("start_date"),
        F.when(status == "F", day).when(status == "O", F.lit("open")).alias("end_date"),
    ).write.json(path)
    return load_json(
        spark,
        path,
        "id BIGINT, o_custkey BIGINT, o_orderpriority STRING, start_date STRING, end_date STRING",
        dates=["start_date", "end_date"],
        rename={"id": "order_id"},
        add={"previous_priority": "string"},
    )


@query(
    """
SELECT o_orderkey AS order_id, o_custkey, o_orderpriority || '},{' AS priority,
       CAST(o_orderdate AS DATE) AS start_date
FROM orders"""
)
def src_json_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """All orders written as files of one JSON array each, with brackets in strings, and loaded again."""
    path = fresh_path(spark, "json-arrays")
    record = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            "o_custkey",
            F.concat("o_orderpriority", F.lit("},{")).alias("priority"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("start_date"),
        )
    )

    def enclose(batches):
        mark = "["
        for batch in batches:
            texts = batch.column("value").to_pylist()
            if texts:
                lines = [mark + texts[0], *("," + t for t in texts[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])
                mark = ","
        yield pa.RecordBatch.from_arrays([pa.array(["[]" if mark == "[" else "]"])], ["value"])

    lines = inputs.table(spark, folder, "orders").select(record.alias("value"))
    lines.mapInArrow(enclose, "value STRING").write.text(path)
    return load_json(
        spark,
        path,
        "id BIGINT, o_custkey BIGINT, priority STRING, start_date STRING",
        dates=["start_date"],
        rename={"id": "order_id"},
        array=True,
    )


@query("SELECT * FROM customer")
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    inputs.table(spark, folder, "customer").createOrReplaceTempView("dimkeeper_customer")
    return read_table(spark, "DIMKEEPER_Customer")


@query("SELECT * FROM customer ORDER BY c_custkey")
def sort_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "customer").orderBy("c_custkey")


@query(
    """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier"""
)
def union_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    supplier = inputs.table(spark, folder, "supplier").toDF(*inputs.COLUMNS[:4])
    return inputs.table(spark, folder, "customer").unionByName(supplier, allowMissingColumns=True)


@query("SELECT c_custkey + 1 AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def dim_setup_type1(spark: SparkSession, folder: str) -> DataFrame:
    return type1_table(inputs.base(spark, folder), "customer_id", _ATTRIBUTES)


@query(
    """
SELECT c_custkey + 1 - 1 AS id, c_custkey + 1 AS customer_id, c_name, c_nationkey, c_acctbal,
       c_mktsegment, DATE '1995-01-01' AS start_date, CAST(NULL AS DATE) AS end_date
FROM customer"""
)
def dim_setup_type2(spark: SparkSession, folder: str) -> DataFrame:
    return type2_table(inputs.base(spark, folder), "customer_id", _ATTRIBUTES)


@query("SELECT c_custkey + 1 AS customer_id, c_name, c_mktsegment FROM customer")
def dim_setup_type3(spark: SparkSession, folder: str) -> DataFrame:
    return type3_table(inputs.base(spark, folder), "customer_id", ["c_name", "c_mktsegment"])


@query(
    """
SELECT c_custkey + 1 AS customer_id, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer ORDER BY customer_id LIMIT 5"""
)
def dim_setup_type4(spark: SparkSession, folder: str) -> DataFrame:
    return top_keys(inputs.base(spark, folder), "customer_id", _ATTRIBUTES)


@query(
    inputs.with_sql(inputs.UPDATES_SQL, inputs.UPSERT_SQL, inputs.SECOND_UPDATES_SQL)
    + """
SELECT * FROM upd2
UNION ALL
SELECT * FROM state1 s WHERE NOT EXISTS (SELECT 1 FROM upd2 u WHERE u.c_custkey = s.c_custkey)"""
)
def publish_state(spark: SparkSession, folder: str) -> DataFrame:
    """Two merges, each written as a new state behind one view that both read and replace."""
    place = fresh_path(spark, "published")
    name = "dimkeeper_published"
    inputs.table(spark, folder, "customer").createOrReplaceTempView(name)
    for batch in inputs.both_updates(spark, folder):
        state = type1.upsert(read_table(spark, name), batch, "c_custkey")
        publish(state, name, place, temporary=True)
    return read_table(spark, name)


@query(
    inputs.with_sql(inputs.UPDATES_SQL, inputs.UPSERT_SQL)
    + """
SELECT -1 - s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
       'PARTNER' AS c_mktsegment
FROM supplier
UNION ALL
SELECT * FROM state1 c WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE -1 - s.s_suppkey = c.c_custkey)"""
)
def publish_touched_state(spark: SparkSession, folder: str) -> DataFrame:
    """A state by segment; then the suppliers change theirs, and only their partitions are written."""
    place = fresh_path(spark, "published")
    name = "dimkeeper_segments"
    state = type1.upsert(inputs.table(spark, folder, "customer"), inputs.updates(spark, folder), "c_custkey")
    publish(state, name, place, temporary=True, partition_by=["c_mktsegment"], cluster_by=["c_custkey"])
    moved = inputs.suppliers(spark, folder, "PARTNER")
    return upsert_touched(
        name, moved, "c_custkey", place, ["c_mktsegment"], type1.upsert, temporary=True, cluster_by=["c_custkey"]
    )
