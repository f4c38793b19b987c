"""Type 4: states and changes by version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.operators import ChangeLog
from dimkeeper.queries import inputs
from dimkeeper.queries.inputs import ORDER_LOG_SQL, state_sql
from dimkeeper.queries.registry import query
from dimkeeper.session import fresh_path, stage
from dimkeeper.sources import append_version, compact_log, open_log, read_log

_STATE1 = inputs.with_sql(inputs.UPDATES_SQL, inputs.UPSERT_SQL)
_MERGED_LOG = inputs.with_sql(
    inputs.UPDATES_SQL, inputs.UPSERT_SQL, inputs.SECOND_UPDATES_SQL, inputs.LOG_SQL
)


@query(_STATE1 + "SELECT * FROM state1")
def scd4_merge(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.change_log(spark, folder, versions=1).current()


@query(_MERGED_LOG + "SELECT * FROM log")
def v_change_log(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.change_log(spark, folder).log


@query(_STATE1 + "SELECT * FROM state1")
def v_log_table(spark: SparkSession, folder: str) -> DataFrame:
    """An older state read from a stored log, one folder per version."""
    made = inputs.change_log(spark, folder)
    path = fresh_path(spark, "log")
    append_version(made.log, path)
    return ChangeLog(read_log(spark, path, made.log), "c_custkey").as_of(1)


@query(inputs.with_sql(ORDER_LOG_SQL, state_sql("state", 4)) + "SELECT * FROM state")
def v_as_of(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_log(spark, folder).as_of(4)


@query(
    inputs.with_sql(ORDER_LOG_SQL, state_sql("state", 4))
    + "SELECT * FROM state WHERE c_mktsegment = '1-URGENT'"
)
def v_as_of_where(spark: SparkSession, folder: str) -> DataFrame:
    """A condition on a column that changes between versions."""
    return inputs.order_log(spark, folder).as_of(4, F.col("c_mktsegment") == "1-URGENT")


@query(
    inputs.with_sql(ORDER_LOG_SQL, *[state_sql(f"s{v}", v) for v in (0, 3, 6)])
    + " UNION ALL ".join(
        f"SELECT CAST({v} AS BIGINT) AS version, s{v}.* FROM s{v} WHERE c_acctbal > 5000" for v in (0, 3, 6)
    )
)
def v_union_versions_where(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_log(spark, folder).union_versions([0, 3, 6], F.col("c_acctbal") > 5000)


@query(
    inputs.with_sql(
        inputs.UPDATES_SQL, inputs.UPSERT_SQL, inputs.SECOND_UPDATES_SQL, inputs.SECOND_UPSERT_SQL
    )
    + """
SELECT * FROM upd
UNION ALL
SELECT * FROM state2 s WHERE NOT EXISTS (SELECT 1 FROM upd u WHERE u.c_custkey = s.c_custkey)"""
)
def v_merge_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Three merges in a row beyond the broadcast limit; the third repeats the first batch."""
    first, second = inputs.both_updates(spark, folder)
    log = ChangeLog.start(inputs.table(spark, folder, "customer"), "c_custkey", limit=1000)
    for batch in (first, second, first):
        log = log.with_changes(log.merge(batch))
    return log.current()


@query(inputs.with_sql(ORDER_LOG_SQL, state_sql("state", 7)) + "SELECT * FROM state")
def v_current(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_log(spark, folder).current()


@query(
    inputs.with_sql(ORDER_LOG_SQL, state_sql("early", 1), state_sql("late", 5))
    + """
SELECT CAST(1 AS BIGINT) AS version, early.* FROM early
UNION ALL
SELECT CAST(5 AS BIGINT) AS version, late.* FROM late"""
)
def v_union_versions(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_log(spark, folder).union_versions([1, 5])


@query(inputs.with_sql(ORDER_LOG_SQL, state_sql("state", 2)) + "SELECT * FROM state")
def v_restore(spark: SparkSession, folder: str) -> DataFrame:
    """The current state after a rollback to version 2 has been appended as version 8."""
    log = inputs.order_log(spark, folder)
    return log.with_changes(log.restore(to_version=2, version=8)).current()


@query(
    inputs.with_sql(
        ORDER_LOG_SQL,
        state_sql("before", 2),
        """
latest AS (
  SELECT * FROM (
    SELECT order_log.*, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC) AS rn
    FROM order_log WHERE version > 2) ranked
  WHERE rn = 1)""",
    )
    + """
SELECT CAST(8 AS BIGINT) AS version, 'D' AS op, l.c_custkey, l.c_name, l.c_nationkey, l.c_acctbal,
       l.c_mktsegment
FROM latest l LEFT JOIN before b ON b.c_custkey = l.c_custkey
WHERE l.op <> 'D' AND b.c_custkey IS NULL
UNION ALL
SELECT CAST(8 AS BIGINT), CASE WHEN l.op = 'D' THEN 'I' ELSE 'U' END, b.c_custkey, b.c_name,
       b.c_nationkey, b.c_acctbal, b.c_mktsegment
FROM latest l JOIN before b ON b.c_custkey = l.c_custkey
WHERE l.op = 'D' OR l.c_name IS DISTINCT FROM b.c_name
   OR l.c_nationkey IS DISTINCT FROM b.c_nationkey OR l.c_acctbal IS DISTINCT FROM b.c_acctbal
   OR l.c_mktsegment IS DISTINCT FROM b.c_mktsegment"""
)
def v_restore_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The rows a rollback appends."""
    return inputs.order_log(spark, folder).restore(to_version=2, version=8)


@query(
    inputs.with_sql(ORDER_LOG_SQL)
    + "SELECT version, op, count(*) AS n_rows FROM order_log GROUP BY version, op"
)
def v_history(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_log(spark, folder).history()


@query(inputs.with_sql(ORDER_LOG_SQL, state_sql("state", 7)) + "SELECT * FROM state")
def v_compact(spark: SparkSession, folder: str) -> DataFrame:
    """The latest state read from a stored copy of version 3 and what came after."""
    log = inputs.order_log(spark, folder)
    return log.compact(3, stage(log.as_of(3), "compact")).current()


def _stored_log(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """A log written version by version: the customers, two batches, a rollback to version 1, and once more."""
    customer, path = inputs.table(spark, folder, "customer"), fresh_path(spark, "log")
    start = ChangeLog.start(customer, "c_custkey").log
    append_version(start, path, version=0)
    for version, batch in enumerate(inputs.both_updates(spark, folder), start=1):
        rows = open_log(spark, path, start, "c_custkey").merge(batch)
        append_version(rows, path, version=version)
    for version in (3, 4):
        rows = open_log(spark, path, start, "c_custkey").restore(1)
        append_version(rows, path, version=version, operation="restore", to_version=1)
    return path, start


@query(
    inputs.with_sql(
        inputs.UPDATES_SQL,
        inputs.UPSERT_SQL,
        inputs.SECOND_UPDATES_SQL,
        inputs.LOG_SQL,
        """
undone AS (
  SELECT count(*) FILTER (s.c_custkey IS NULL) AS n_deleted,
         count(*) FILTER (s.c_custkey IS NOT NULL AND (
           s.c_name IS DISTINCT FROM u.c_name OR s.c_nationkey IS DISTINCT FROM u.c_nationkey
           OR s.c_acctbal IS DISTINCT FROM u.c_acctbal OR s.c_mktsegment IS DISTINCT FROM u.c_mktsegment)) AS n_updated
  FROM upd2 u LEFT JOIN state1 s ON s.c_custkey = u.c_custkey)""",
    )
    + """
SELECT version, CASE WHEN version = 0 THEN 'create' ELSE 'merge' END AS operation, CAST(NULL AS BIGINT) AS to_version,
       count(*) FILTER (op = 'I') AS n_inserted, count(*) FILTER (op = 'U') AS n_updated,
       count(*) FILTER (op = 'D') AS n_deleted
FROM log GROUP BY version
UNION ALL
SELECT CAST(3 AS BIGINT), 'restore', CAST(1 AS BIGINT), CAST(0 AS BIGINT), n_updated, n_deleted FROM undone
UNION ALL
SELECT CAST(4 AS BIGINT), 'restore', CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""
)
def v_history_ops(spark: SparkSession, folder: str) -> DataFrame:
    """What made each version of a stored log; the last one changed nothing and is listed all the same."""
    path, start = _stored_log(spark, folder)
    return open_log(spark, path, start, "c_custkey").operations().drop("committed_at")


@query(_STATE1 + "SELECT * FROM state1")
def v_log_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The state after the rollbacks, read from a stored copy of version 2 and what came after."""
    path, start = _stored_log(spark, folder)
    compact_log(open_log(spark, path, start, "c_custkey"), path, 2)
    return open_log(spark, path, start, "c_custkey", base=2).current()
