"""Measure an update batch before it meets a large table.

A merge has to know two things about its batch: whether a key repeats (an ambiguous match)
and whether the batch is small enough to be broadcast. One aggregation answers both. It
counts per key on the map side first, so a key that holds most of the batch does not
gather in one task.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions.columns import columns, quoted, with_key
from dimkeeper.session import stage

# Room in bytes for the header and hash table entry of one broadcast row, and for one value
# of it apart from a text's own length. Both are more than Spark uses.
ROW_OVERHEAD = 48
VALUE_SIZE = 24

_UNITS = {"": 1, "b": 1, "k": 2**10, "kb": 2**10, "m": 2**20, "mb": 2**20, "g": 2**30, "gb": 2**30}
_UNITS |= {"t": 2**40, "tb": 2**40, "p": 2**50, "pb": 2**50}


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit for broadcasts in bytes; negative means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", text).groups()
    return int(number) * _UNITS[unit.lower()]


def _fixed_and_varying(fields: Sequence[T.StructField]) -> tuple[int, str]:
    """Bytes every row takes, and an SQL expression for what a row takes on top."""
    fixed, varying = ROW_OVERHEAD, []
    for field in fields:
        name = quoted(field.name)
        fixed += VALUE_SIZE
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            varying.append(f"coalesce(octet_length({name}), 0)")
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            # The text form of a nested value, times what its shortest part may take in a row.
            varying.append(f"{VALUE_SIZE} * coalesce(octet_length(to_json(struct({name}))), 0)")
    return fixed, " + ".join(varying)


@dataclass(frozen=True)
class BatchProfile:
    """What was measured: rows, rows whose key has a null, repeated keys, bytes if broadcast."""

    rows: int
    null_keys: int
    repeated_keys: int
    key_bytes: int
    row_bytes: int | None
    limit: int

    @property
    def keys_fit(self) -> bool:
        return self.key_bytes <= self.limit

    @property
    def rows_fit(self) -> bool:
        return self.row_bytes is not None and self.row_bytes <= self.limit

    def keys(self, df: DataFrame, on: Sequence[str]) -> DataFrame:
        """The distinct non-null keys of the measured frame, marked for broadcast if they fit."""
        keys = with_key(df, on).select(*columns(on))
        if self.repeated_keys:
            keys = keys.distinct()
        if self.keys_fit:
            return F.broadcast(keys)
        # An aggregate between exchange and join would keep Spark from splitting a hot key
        # of the other side, so distinct keys too large for a broadcast are written first.
        return stage(keys, "keys") if self.repeated_keys else keys


def profile_batch(
    updates: DataFrame,
    on: Sequence[str],
    limit: int | None = None,
    rows: bool = False,
    repeats: bool = True,
) -> BatchProfile:
    """Measure ``updates`` in one job that reads the key columns only.

    ``rows`` measures whole rows too, for joins that would broadcast them; otherwise
    ``row_bytes`` is None. Without ``repeats`` keys are not compared and count as unique,
    which spares the shuffle by key. ``limit`` defaults to the session's broadcast limit.
    """
    key_size, key_text = _fixed_and_varying([updates.schema[c] for c in on])
    row_size, row_text = _fixed_and_varying(updates.schema.fields if rows else [])
    keys = [f"k{i}" for i in range(len(on))]
    no_key = "(" + " OR ".join(f"{k} IS NULL" for k in keys) + ")"

    measured = updates.selectExpr(
        *[f"{quoted(c)} AS {k}" for c, k in zip(on, keys, strict=True)],
        "1L AS _n",
        f"CAST({key_text or 0} AS BIGINT) AS _key_text",
        f"CAST({row_text or 0} AS BIGINT) AS _row_text",
    )
    if repeats:
        measured = measured.groupBy(*keys).agg(
            *[F.expr(f"sum({c}) AS {c}") for c in ("_n", "_key_text", "_row_text")]
        )
    found = measured.selectExpr(
        "coalesce(sum(_n), 0) AS rows",
        f"coalesce(sum(_n) FILTER (WHERE {no_key}), 0) AS null_keys",
        f"count_if(_n > 1 AND NOT {no_key}) AS repeated_keys",
        "coalesce(sum(_key_text), 0) AS key_text",
        "coalesce(sum(_row_text), 0) AS row_text",
    ).first()
    return BatchProfile(
        rows=found["rows"],
        null_keys=found["null_keys"],
        repeated_keys=found["repeated_keys"],
        key_bytes=found["rows"] * key_size + found["key_text"],
        row_bytes=found["rows"] * row_size + found["row_text"] if rows else None,
        limit=broadcast_limit(updates.sparkSession) if limit is None else limit,
    )


def stage_measured(
    df: DataFrame, on: Sequence[str], limit: int | None = None, rows: bool = False, label: str = "stage"
) -> tuple[DataFrame, BatchProfile]:
    """Write a frame whose keys are unique, and measure it in the same job."""
    key_size, key_text = _fixed_and_varying([df.schema[c] for c in on])
    row_size, row_text = _fixed_and_varying(df.schema.fields if rows else [])
    no_key = " OR ".join(f"{quoted(c)} IS NULL" for c in on)
    seen = Observation()
    written = stage(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.expr(f"count_if({no_key})").alias("null_keys"),
            F.expr(f"coalesce(sum(CAST({key_text or 0} AS BIGINT)), 0)").alias("key_text"),
            F.expr(f"coalesce(sum(CAST({row_text or 0} AS BIGINT)), 0)").alias("row_text"),
        ),
        label,
    )
    found = seen.get
    profile = BatchProfile(
        rows=found["rows"],
        null_keys=found["null_keys"],
        repeated_keys=0,
        key_bytes=found["rows"] * key_size + found["key_text"],
        row_bytes=found["rows"] * row_size + found["row_text"] if rows else None,
        limit=broadcast_limit(df.sparkSession) if limit is None else limit,
    )
    return written, profile
