"""The tables the queries run on, each as a DataFrame and as SQL.

``customer`` is the dimension. The update batch follows from all orders: customers whose
last order is open get a new balance, those with an urgent one also a new segment, and
the suppliers join as new customers under negative keys.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.operators import ChangeLog, History
from dimkeeper.session import stage

EFFECTIVE = datetime.date(2024, 1, 1)
CUSTOMER_HISTORY = History("c_custkey")
COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


# The columns of the given tables. Naming them saves a look into the files.
SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _last_orders(spark: SparkSession, folder: str) -> DataFrame:
    # The last order is combined on the map side, so a customer with most of the orders
    # does not gather in one task.
    order = F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max(order).alias("o"))
        .select("c_custkey", "o.o_orderdate", "o.o_orderstatus", "o.o_orderpriority", "o.o_totalprice")
    )


def suppliers(spark: SparkSession, folder: str, segment: str) -> DataFrame:
    return table(spark, folder, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit(segment).alias("c_mktsegment"),
    )


def _customers_with_last_order(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").join(_last_orders(spark, folder), "c_custkey")


def _first_batch(customers: DataFrame, suppliers: DataFrame) -> DataFrame:
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    known = customers.where("o_orderstatus = 'O'").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("o_totalprice").alias("c_acctbal"),
        F.when(urgent, "PRIORITY").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        F.to_date("o_orderdate").alias("c_lastorder"),
    )
    return known.unionByName(suppliers, allowMissingColumns=True)


def _second_batch(customers: DataFrame, suppliers: DataFrame) -> DataFrame:
    known = customers.where("o_orderstatus = 'F'").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("o_totalprice").alias("c_acctbal"),
        F.lit("FINISHED").alias("c_mktsegment"),
    )
    return known.unionByName(suppliers)


def updates(spark: SparkSession, folder: str, with_date: bool = False) -> DataFrame:
    """The first batch, written once because every merge reads its batch several times."""
    customers = _customers_with_last_order(spark, folder)
    batch = _first_batch(customers, suppliers(spark, folder, "SUPPLIER"))
    return stage(batch if with_date else batch.drop("c_lastorder"), "updates")


def both_updates(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The first batch and a later one: customers whose last order is finished, suppliers again."""
    customers = stage(_customers_with_last_order(spark, folder), "updates")
    return [
        _first_batch(customers, suppliers(spark, folder, "SUPPLIER")).drop("c_lastorder"),
        _second_batch(customers, suppliers(spark, folder, "PARTNER")),
    ]


def history(spark: SparkSession, folder: str) -> DataFrame:
    """A type 2 table: per customer one row closed in 1995 and one open row; ids have no gaps."""
    customer = table(spark, folder, "customer")

    def side(number, segment, start, end):
        return customer.select(
            number.alias("id"),
            "c_custkey",
            "c_name",
            segment.alias("c_mktsegment"),
            F.lit(start).cast("date").alias("start_date"),
            F.lit(end).cast("date").alias("end_date"),
        )

    key = F.col("c_custkey")
    closed = side(2 * key, F.lit("PROSPECT"), "1990-01-01", "1995-01-01")
    return closed.unionByName(side(2 * key + 1, F.col("c_mktsegment"), "1995-01-01", None))


def change_log(spark: SparkSession, folder: str, versions: int = 2) -> ChangeLog:
    """A type 4 log: all customers as version 0, then up to two batches."""
    log = ChangeLog.start(table(spark, folder, "customer"), "c_custkey")
    for version, batch in enumerate(both_updates(spark, folder)[:versions], start=1):
        log = log.with_changes(log.merge(batch, version))
    return log


def order_log(spark: SparkSession, folder: str) -> ChangeLog:
    """A type 4 log with a version per year of orders, up to version 7.

    A customer's last order of a year changes balance and segment; one that is finished and
    of low priority removes the customer until a later order.
    """
    customer = table(spark, folder, "customer")
    order = F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    yearly = (
        table(spark, folder, "orders")
        .groupBy(
            F.col("o_custkey").alias("c_custkey"),
            (F.year("o_orderdate") - 1994).cast("long").alias("version"),
        )
        .agg(F.max(order).alias("o"))
    )
    leaves = (F.col("o.o_orderstatus") == "F") & (F.col("o.o_orderpriority") == "5-LOW")
    changes = yearly.join(customer, "c_custkey").select(
        "version",
        F.when(leaves, "D").otherwise("U").alias("op"),
        "c_custkey",
        "c_name",
        "c_nationkey",
        F.col("o.o_totalprice").alias("c_acctbal"),
        F.col("o.o_orderpriority").alias("c_mktsegment"),
    )
    return ChangeLog.start(customer, "c_custkey").with_changes(changes)


def base(spark: SparkSession, folder: str) -> DataFrame:
    """Customers under keys that count from 1, with dates, as the setup queries expect them."""
    return table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1).alias("customer_id"),
        "c_name",
        "c_nationkey",
        "c_acctbal",
        "c_mktsegment",
        F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
    )


# The same tables in SQL, as common table expressions to put after WITH.

LAST_ORDERS_SQL = """
last_order AS (
  SELECT * FROM (
    SELECT o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders) ranked
  WHERE rn = 1)"""

UPDATES_SQL = (
    LAST_ORDERS_SQL
    + """,
upd_dated AS (
  SELECT c_custkey, c_name, c_nationkey, o_totalprice AS c_acctbal,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'PRIORITY' ELSE c_mktsegment END
           AS c_mktsegment,
         CAST(o_orderdate AS DATE) AS c_lastorder
  FROM customer JOIN last_order ON c_custkey = o_custkey
  WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER', NULL FROM supplier),
upd AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM upd_dated)"""
)

SECOND_UPDATES_SQL = """
upd2 AS (
  SELECT c_custkey, c_name, c_nationkey, o_totalprice AS c_acctbal, 'FINISHED' AS c_mktsegment
  FROM customer JOIN last_order ON c_custkey = o_custkey
  WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'PARTNER' FROM supplier)"""

HISTORY_SQL = """
hist AS (
  SELECT 2 * c_custkey AS id, c_custkey, c_name, 'PROSPECT' AS c_mktsegment,
         DATE '1990-01-01' AS start_date, DATE '1995-01-01' AS end_date
  FROM customer
  UNION ALL
  SELECT 2 * c_custkey + 1, c_custkey, c_name, c_mktsegment, DATE '1995-01-01', NULL
  FROM customer)"""

UPSERT_SQL = """
state1 AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM upd
  UNION ALL
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer c
  WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.c_custkey = c.c_custkey))"""

SECOND_UPSERT_SQL = """
state2 AS (
  SELECT * FROM upd2
  UNION ALL
  SELECT * FROM state1 s WHERE NOT EXISTS (SELECT 1 FROM upd2 u WHERE u.c_custkey = s.c_custkey))"""

LOG_SQL = """
log AS (
  SELECT CAST(0 AS BIGINT) AS version, 'I' AS op, c_custkey, c_name, c_nationkey, c_acctbal,
         c_mktsegment
  FROM customer
  UNION ALL
  SELECT CAST(1 AS BIGINT),
         CASE WHEN EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = u.c_custkey)
              THEN 'U' ELSE 'I' END, u.*
  FROM upd u
  UNION ALL
  SELECT CAST(2 AS BIGINT),
         CASE WHEN EXISTS (SELECT 1 FROM state1 s WHERE s.c_custkey = u.c_custkey)
              THEN 'U' ELSE 'I' END, u.*
  FROM upd2 u)"""


ORDER_LOG_SQL = """
order_log AS (
  SELECT CAST(0 AS BIGINT) AS version, 'I' AS op, c_custkey, c_name, c_nationkey, c_acctbal,
         c_mktsegment
  FROM customer
  UNION ALL
  SELECT version,
         CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'D' ELSE 'U' END,
         c_custkey, c_name, c_nationkey, o_totalprice, o_orderpriority
  FROM (SELECT dated.*, row_number() OVER (PARTITION BY o_custkey, version
                                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM (SELECT orders.*, CAST(year(o_orderdate) - 1994 AS BIGINT) AS version FROM orders)
          dated) ranked
  JOIN customer ON c_custkey = o_custkey
  WHERE rn = 1)"""


def state_sql(name: str, version: int) -> str:
    """The state of ``order_log`` at a version, as a common table expression."""
    return f"""
{name} AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
  FROM (SELECT order_log.*, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS rn
        FROM order_log WHERE version <= {version}) ranked
  WHERE rn = 1 AND op <> 'D')"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"
