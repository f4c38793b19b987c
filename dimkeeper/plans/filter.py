"""Bits of a batch's keys that let most rows of a large table bypass a shuffle join.

A batch beyond the broadcast limit has too many keys to send to the table, but some ten bits per
key may still fit. A row of the table whose bits are not all set has surely no partner in the
batch and stays where it is; the others, a few rows in a hundred too many, take part in the join.
The bits are computed by one aggregation of the batch's keys and read in the plan as a scalar
subquery. Their size never exceeds the broadcast limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.functions.columns import columns, has_key, with_key
from dimkeeper.plans.batch import BatchProfile

#: Wanted bits per key, and those below which too few rows would be kept out.
BITS, LEAST_BITS = 10, 4
#: Bits set per key, all in one word of 64.
PROBES = 3
_EXACT = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BooleanType, T.BinaryType)


def equal_by_hash(df: DataFrame, on: Sequence[str]) -> bool:
    """Whether equal keys surely have equal hashes; 0.0 and -0.0 or letters under a collation do not."""
    types = [df.schema[c].dataType for c in on]
    return all(isinstance(t, _EXACT) or t.simpleString() == "string" for t in types)


def key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*columns(on))


def may_match(table: DataFrame, updates: DataFrame, on: Sequence[str], profile: BatchProfile) -> Column | None:
    """A condition on rows of ``table``: false where the batch surely has no such key, never null.

    None if the keys may be broadcast anyway, if bits for them do not fit below the limit, or if the
    session forbids broadcasts.
    """
    keys = profile.rows - profile.null_keys
    words = 1
    while words * 64 < keys * BITS and words * 16 <= profile.limit:
        words *= 2
    if profile.keys_fit or words * 8 > profile.limit or words * 64 < keys * LEAST_BITS:
        return None
    if not equal_by_hash(table, on) or not equal_by_hash(updates, on):
        return None
    place, bits = _place(on, words), _bits(on)
    rows = with_key(updates, on).select(place.alias("place"), bits.alias("bits"))
    # A row for every word, so that the sorted list is addressed by place.
    blank = updates.sparkSession.range(words).select(F.col("id").alias("place"), F.lit(0).cast("long").alias("bits"))
    merged = rows.groupBy("place").agg(F.bit_or("bits").alias("bits")).unionByName(blank)
    merged = merged.groupBy("place").agg(F.bit_or("bits").alias("bits"))
    listed = merged.agg(F.sort_array(F.collect_list(F.struct("place", "bits"))).alias("words"))
    known = listed.select(F.transform("words", lambda w: w["bits"]).alias("words")).scalar()
    found = F.get(known, place.cast("int")).bitwiseAND(bits) == bits
    return has_key(on) & F.coalesce(found, F.lit(False))


def _place(on: Sequence[str], words: int) -> Column:
    return key_hash(on).bitwiseAND(F.lit(words - 1).cast("long"))


def _bits(on: Sequence[str]) -> Column:
    """Some bits of one word, chosen by the upper part of the hash."""
    at = [F.shiftrightunsigned(key_hash(on), 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), a) for a in at])
