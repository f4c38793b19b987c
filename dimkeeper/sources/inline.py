"""Small update batches written down in code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rows(spark: SparkSession, data: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """Literal rows with an explicit schema."""
    return spark.createDataFrame(list(data), schema)


def values(spark: SparkSession, table: str, names: Sequence[str]) -> DataFrame:
    """An inline table, ``VALUES (..), (..)``, with its positional columns named."""
    frame = spark.sql(f"SELECT * FROM VALUES {table}")
    if len(frame.columns) != len(names):
        raise ValueError(f"{len(names)} names for {len(frame.columns)} columns")
    return frame.select(*[F.col(c).alias(n) for c, n in zip(frame.columns, names)])
