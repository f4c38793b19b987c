"""Type 2: history rows with ids and dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.queries import inputs
from dimkeeper.queries.inputs import CUSTOMER_HISTORY, EFFECTIVE
from dimkeeper.queries.registry import query

_BOTH = inputs.with_sql(inputs.UPDATES_SQL, inputs.HISTORY_SQL)
_COLUMNS = "c_custkey, c_name, c_mktsegment, start_date, end_date"
_OPENED = f"""
  SELECT CAST(NULL AS BIGINT) AS id, c_custkey, c_name, c_mktsegment,
         DATE '{EFFECTIVE}' AS start_date, CAST(NULL AS DATE) AS end_date
  FROM upd"""


def _merged(closes: str, changed: str = "TRUE") -> str:
    """The merge with all ids numbered anew at the end, as one statement."""
    return f"""{_BOTH},
live AS (SELECT * FROM hist WHERE end_date IS NULL),
hits AS (
  SELECT upd.* FROM upd LEFT JOIN live ON upd.c_custkey = live.c_custkey WHERE {changed}),
merged AS (
  SELECT h.id, h.c_custkey, h.c_name, h.c_mktsegment, h.start_date,
         CASE WHEN u.c_custkey IS NOT NULL AND {closes} THEN DATE '{EFFECTIVE}' ELSE h.end_date END
           AS end_date
  FROM hist h LEFT JOIN hits u ON h.c_custkey = u.c_custkey
  UNION ALL {_OPENED.replace("FROM upd", "FROM hits")})
SELECT CAST(row_number() OVER (ORDER BY id NULLS LAST, c_custkey) - 1 AS BIGINT) AS id, {_COLUMNS}
FROM merged"""


def _history_updates(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.updates(spark, folder).select("c_custkey", "c_name", "c_mktsegment")


def _apply(spark: SparkSession, folder: str, **options) -> DataFrame:
    return CUSTOMER_HISTORY.apply(
        inputs.history(spark, folder), _history_updates(spark, folder), EFFECTIVE, **options
    )


@query(
    f"""{_BOTH}
{_OPENED}
UNION ALL
SELECT id, {_COLUMNS} FROM hist WHERE c_custkey IN (SELECT c_custkey FROM upd)"""
)
def scd2_change_rows(spark: SparkSession, folder: str) -> DataFrame:
    return CUSTOMER_HISTORY.change_rows(
        inputs.history(spark, folder), _history_updates(spark, folder), EFFECTIVE
    )


@query(_merged("h.end_date IS NULL"))
def scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    return _apply(spark, folder)


@query(_merged("TRUE"))
def scd2_merge_expire_all(spark: SparkSession, folder: str) -> DataFrame:
    return _apply(spark, folder, expire="all")


@query(
    _merged(
        "h.end_date IS NULL",
        "live.c_custkey IS NULL OR upd.c_name IS DISTINCT FROM live.c_name "
        "OR upd.c_mktsegment IS DISTINCT FROM live.c_mktsegment",
    )
)
def scd2_merge_changed_only(spark: SparkSession, folder: str) -> DataFrame:
    return _apply(spark, folder, skip_unchanged=True)


_WITHOUT_IDS = f"""
  SELECT id, {_COLUMNS} FROM hist
  UNION ALL {_OPENED}"""


def _with_open_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The history with the new rows appended but not numbered yet."""
    history = inputs.history(spark, folder)
    opened = _history_updates(spark, folder).withColumn("start_date", F.lit(EFFECTIVE))
    return history.unionByName(opened, allowMissingColumns=True)


@query(
    f"""{_BOTH}
SELECT CAST(row_number() OVER (ORDER BY id NULLS LAST, c_custkey) - 1 AS BIGINT) AS id, {_COLUMNS}
FROM ({_WITHOUT_IDS}) u"""
)
def scd2_renumber(spark: SparkSession, folder: str) -> DataFrame:
    return CUSTOMER_HISTORY.renumber(_with_open_rows(spark, folder))


@query(
    inputs.with_sql(inputs.HISTORY_SQL)
    + f"""
SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS id, {_COLUMNS}
FROM hist WHERE end_date IS NULL"""
)
def scd2_renumber_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Only open rows are left, so every second id is missing."""
    return CUSTOMER_HISTORY.renumber(CUSTOMER_HISTORY.active(inputs.history(spark, folder)))


@query(
    f"""{_BOTH}
SELECT CAST((SELECT max(id) FROM hist) + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id,
       {_COLUMNS}
FROM ({_OPENED}) u"""
)
def scd2_new_ids(spark: SparkSession, folder: str) -> DataFrame:
    history = inputs.history(spark, folder)
    opened = _with_open_rows(spark, folder).where("id IS NULL")
    return CUSTOMER_HISTORY.assign_ids(history, opened)


@query(inputs.with_sql(inputs.HISTORY_SQL) + "SELECT * FROM hist WHERE end_date IS NOT NULL")
def scd2_inactive(spark: SparkSession, folder: str) -> DataFrame:
    return CUSTOMER_HISTORY.inactive(inputs.history(spark, folder))


@query(inputs.with_sql(inputs.HISTORY_SQL) + "SELECT * FROM hist WHERE end_date IS NULL")
def scd2_active(spark: SparkSession, folder: str) -> DataFrame:
    return CUSTOMER_HISTORY.active(inputs.history(spark, folder))


@query(inputs.with_sql(inputs.HISTORY_SQL) + "SELECT *, end_date IS NULL AS is_active FROM hist")
def scd2_active_flag(spark: SparkSession, folder: str) -> DataFrame:
    return CUSTOMER_HISTORY.with_active_flag(inputs.history(spark, folder))


@query(
    f"SELECT * FROM ({_merged('h.end_date IS NULL')}) m "
    "WHERE c_mktsegment = 'PRIORITY' OR c_mktsegment = 'SUPPLIER'"
)
def scd2_check_rows(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return scd2_merge(spark, folder).where((segment == "PRIORITY") | (segment == "SUPPLIER"))
