"""Shape a base table into the table each kind of dimension starts from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def type1_table(base: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Key and attributes, without dates."""
    return base.select(key, *attributes)


def type2_table(
    base: DataFrame,
    key: str,
    attributes: Sequence[str],
    start: str = "start_date",
    end: str = "end_date",
    surrogate: str = "id",
) -> DataFrame:
    """With a surrogate id counting from 0, for business keys that count from 1 without gaps.

    For any other key, leave the id null and call ``History.renumber``.
    """
    return base.select((F.col(key) - 1).cast("long").alias(surrogate), key, *attributes, start, end)


def type3_table(base: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Key and attributes; the column for the previous value is added by the first merge."""
    return base.select(key, *attributes)


def top_keys(base: DataFrame, key: str, attributes: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` rows with the lowest keys, the start of the type 4 table."""
    return base.select(key, *attributes).orderBy(key).limit(n)
