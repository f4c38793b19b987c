"""Named tables and views of the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by its name, ignoring case."""
    return spark.table(name)


def create_database(spark: SparkSession, name: str, use: bool = False) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.catalog.setCurrentDatabase(name)


def create_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Create a parquet table from a query, in place of one of that name, and return it.

    ``df`` must not read the table it replaces; use :func:`dimkeeper.sources.publish.publish`
    for a new state of the same table.
    """
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def drop_view(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP VIEW IF EXISTS {name}")
