"""Type 3: the value before the last change."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.operators import type3
from dimkeeper.queries import inputs
from dimkeeper.queries.registry import query


def _changes(column: str, upd: str = "upd", customer: str = "customer", differs: str = "<>") -> str:
    return f"""
SELECT u.*, c.{column} AS previous_{column}
FROM {upd} u JOIN {customer} c ON u.c_custkey = c.c_custkey AND c.{column} {differs} u.{column}
UNION
SELECT u.*, NULL
FROM {upd} u LEFT JOIN {customer} c ON u.c_custkey = c.c_custkey
WHERE c.c_custkey IS NULL"""


_UPDATES = inputs.with_sql(inputs.UPDATES_SQL)

_MERGED = f"""{_UPDATES},
changes AS ({_changes("c_mktsegment")})
SELECT * FROM (
  SELECT * FROM changes
  UNION ALL
  SELECT c.*, NULL FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM changes x WHERE x.c_custkey = c.c_custkey)) m"""


def _inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return inputs.table(spark, folder, "customer"), inputs.updates(spark, folder)


@query(
    _UPDATES
    + "SELECT * FROM upd u WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = u.c_custkey)"
)
def scd3_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    return type3.new_rows(*_inputs(spark, folder), "c_custkey")


@query(_UPDATES + _changes("c_mktsegment"))
def scd3_change_rows(spark: SparkSession, folder: str) -> DataFrame:
    return type3.change_rows(*_inputs(spark, folder), "c_custkey", "c_mktsegment")


@query(_UPDATES + _changes("c_acctbal"))
def scd3_change_rows_balance(spark: SparkSession, folder: str) -> DataFrame:
    """The same call with another column to track."""
    return type3.change_rows(*_inputs(spark, folder), "c_custkey", "c_acctbal")


@query(
    f"""{_UPDATES},
upd_null AS (SELECT * REPLACE (NULLIF(c_mktsegment, 'PRIORITY') AS c_mktsegment) FROM upd),
customer_null AS (SELECT * REPLACE (NULLIF(c_mktsegment, 'BUILDING') AS c_mktsegment) FROM customer)
{_changes("c_mktsegment", "upd_null", "customer_null", "IS DISTINCT FROM")}"""
)
def scd3_change_rows_nullsafe(spark: SparkSession, folder: str) -> DataFrame:
    customer, updates = _inputs(spark, folder)
    segment = F.col("c_mktsegment")
    return type3.change_rows(
        customer.withColumn("c_mktsegment", F.nullif(segment, F.lit("BUILDING"))),
        updates.withColumn("c_mktsegment", F.nullif(segment, F.lit("PRIORITY"))),
        "c_custkey",
        "c_mktsegment",
        null_safe=True,
    )


@query(_MERGED)
def scd3_merge(spark: SparkSession, folder: str) -> DataFrame:
    return type3.apply(*_inputs(spark, folder), "c_custkey", "c_mktsegment")


@query(_MERGED + " WHERE c_mktsegment IN ('PRIORITY', 'SUPPLIER', 'MACHINERY')")
def scd3_check_rows(spark: SparkSession, folder: str) -> DataFrame:
    merged = scd3_merge(spark, folder)
    return merged.where(F.col("c_mktsegment").isin("PRIORITY", "SUPPLIER", "MACHINERY"))
