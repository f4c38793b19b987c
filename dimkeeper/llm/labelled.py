"""Bounded samples of labelled rows for fitting a classifier, and the folds of the queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; a null id counts as 'null'."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary")) % modulus


def sample(labels: DataFrame, label: str, per_label: dict[int, int], training: Column) -> DataFrame:
    """At most so many ids of each of the labels 0 and 1: those of the least hash.

    An id with both labels counts as 0. Rows without id or label are left out.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & training)
    rows = rows.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [rows.where(F.col("label") == x).orderBy(*order).limit(per_label[x]) for x in (0, 1)]
    return parts[0].unionByName(parts[1])
