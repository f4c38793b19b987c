"""Type 1 and the general merge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.operators import ambiguous_keys, batch_keys, merge, type1
from dimkeeper.queries import inputs
from dimkeeper.queries.registry import query

_UPSERT = inputs.with_sql(inputs.UPDATES_SQL, inputs.UPSERT_SQL) + "SELECT * FROM state1"


@query(_UPSERT)
def scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    customer = inputs.table(spark, folder, "customer")
    return type1.upsert(customer, inputs.updates(spark, folder), "c_custkey")


@query(_UPSERT + " WHERE c_mktsegment = 'PRIORITY' AND c_nationkey = 7")
def scd1_check_row(spark: SparkSession, folder: str) -> DataFrame:
    merged = scd1_upsert(spark, folder)
    return merged.where((F.col("c_mktsegment") == "PRIORITY") & (F.col("c_nationkey") == 7))


@query(_UPSERT)
def merge_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    customer = inputs.table(spark, folder, "customer")
    return merge(customer, inputs.updates(spark, folder), "c_custkey", full_outer=True)


@query(
    inputs.with_sql(inputs.UPDATES_SQL)
    + """
SELECT c.c_custkey, c.c_name, c.c_nationkey,
       CASE WHEN u.c_custkey IS NULL THEN c.c_acctbal ELSE c.c_acctbal + u.c_acctbal END AS c_acctbal,
       CASE WHEN u.c_custkey IS NULL THEN c.c_mktsegment ELSE u.c_mktsegment END AS c_mktsegment
FROM customer c LEFT JOIN upd u ON c.c_custkey = u.c_custkey"""
)
def merge_update_set(spark: SparkSession, folder: str) -> DataFrame:
    return merge(
        inputs.table(spark, folder, "customer"),
        inputs.updates(spark, folder),
        "c_custkey",
        matched={"c_acctbal": "t.c_acctbal + u.c_acctbal", "c_mktsegment": F.col("u.c_mktsegment")},
        not_matched=None,
    )


@query(
    inputs.with_sql(inputs.UPDATES_SQL)
    + """
SELECT * FROM customer
UNION ALL
SELECT * FROM upd u WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = u.c_custkey)"""
)
def merge_insert_only(spark: SparkSession, folder: str) -> DataFrame:
    customer = inputs.table(spark, folder, "customer")
    return merge(customer, inputs.updates(spark, folder), "c_custkey", matched=None)


@query(
    inputs.with_sql(inputs.UPDATES_SQL)
    + """
SELECT coalesce(c.c_custkey, u.c_custkey) AS c_custkey, c.c_name,
       CASE WHEN u.c_custkey IS NULL THEN c.c_nationkey ELSE u.c_nationkey END AS c_nationkey,
       CASE WHEN u.c_custkey IS NULL THEN c.c_acctbal ELSE u.c_acctbal END AS c_acctbal,
       CASE WHEN u.c_custkey IS NULL THEN c.c_mktsegment ELSE u.c_mktsegment END AS c_mktsegment,
       u.c_lastorder
FROM customer c FULL JOIN upd_dated u ON c.c_custkey = u.c_custkey"""
)
def merge_evolve(spark: SparkSession, folder: str) -> DataFrame:
    """The batch has a column the table lacks (added) and lacks one the table has (kept)."""
    batch = inputs.updates(spark, folder, with_date=True).drop("c_name")
    return merge(inputs.table(spark, folder, "customer"), batch, "c_custkey", evolve=True)


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS matches
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def merge_ambiguous_keys(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = inputs.table(spark, folder, "lineitem")
    return ambiguous_keys(lineitem, lineitem, ["l_orderkey", "l_linenumber"])


@query(
    """
SELECT l_orderkey, count(*) AS matches FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
GROUP BY l_orderkey HAVING count(*) > 1"""
)
def merge_ambiguous_finished(spark: SparkSession, folder: str) -> DataFrame:
    """The table has only some of the keys that repeat in the batch."""
    orders = inputs.table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    finished = orders.withColumnRenamed("o_orderkey", "l_orderkey")
    return ambiguous_keys(finished, inputs.table(spark, folder, "lineitem"), "l_orderkey")


@query("SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey")
def agg_collect_keys(spark: SparkSession, folder: str) -> DataFrame:
    return batch_keys(inputs.table(spark, folder, "orders"), "o_custkey")
