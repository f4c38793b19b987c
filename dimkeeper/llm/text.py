"""Texts of Arrow batches as bytes, and hashes of their words.

A task sees its rows in slices of about one megabyte of text, so what a step needs in memory
is bounded by the slice or by the longest single text, not by the partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

SLICE_BYTES = 1 << 20
U64 = np.uint64

#: Byte classes. White space of the shingle rule: blank and the bytes 9 to 13.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True
#: What separates words of the window rule: ASCII that is neither digit nor letter.
NON_WORDS = np.zeros(256, bool)
NON_WORDS[: 0x30] = NON_WORDS[0x3A:0x61] = NON_WORDS[0x7B:0x80] = True
#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Spans up to so many bytes are hashed side by side, eight bytes at a time.
SHORT = 64
#: The prime of sums over sequences, and a fixed base below it.
PRIME = U64(2**61 - 1)
BASE = 0x1B873593CC9E2D51 % (2**61 - 1)
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(8)] + [2**64 - 1], U64)


def struct(fields: str) -> T.StructType:
    """A schema from pairs of name and type, such as "doc_id long, ids binary"; needs no session."""
    kinds = {"int": T.IntegerType, "long": T.LongType, "binary": T.BinaryType, "string": T.StringType}
    kinds |= {"double": T.DoubleType, "boolean": T.BooleanType}
    pairs = (f.split() for f in fields.split(","))
    return T.StructType([T.StructField(name, kinds[kind]()) for name, kind in pairs])


#: What a Python worker keeps from task to task, by kind. Spark hands workers on from stage to stage.
kept: dict[str, dict] = {}


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in order, in slices of about SLICE_BYTES of text.

    Unless the task is to ``keep`` it, what tasks of other stages have left in this worker goes first.
    """
    if not keep:
        for left in kept.values():
            left.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(group)) + 1
        for start, stop in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each row's begin (one more entry than rows)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    column = pa.concat_arrays([column])  # a slice becomes an array of its own
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it."""
    low, high = U64(2**31 - 1), U64(31)
    a1, a0, b1, b0 = a >> high, a & low, b >> high, b & low
    middle = a1 * b0 + a0 * b1
    x = (a1 * b1 << U64(1)) + (middle >> U64(30)) + ((middle & U64(2**30 - 1)) << high) + a0 * b0
    return _reduced(x)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> U64(61))
    return np.where(x >= PRIME, x - PRIME, x)


_powers = {b: np.ones(1, U64) for b in (BASE, pow(BASE, -1, 2**61 - 1))}


def power(base: int, n: int) -> np.ndarray:
    """The first n powers of one of the two bases."""
    known = _powers[base]
    while len(known) < n:
        step = np.full(len(known), U64(pow(base, len(known), 2**61 - 1)))
        known = _powers[base] = np.concatenate([known, times(known, step)])
    return known[:n]


def sequence_hashes(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of 64-bit values, from one running polynomial modulo a prime.

    Modulo a power of two, sequences that alternate in a certain way would have one hash.
    """
    n = len(values)
    terms = times(_reduced(values), power(BASE, n))
    # Halves are added up on their own, so that no sum overflows.
    half = U64(2**31 - 1)
    low, high = np.zeros(n + 1, U64), np.zeros(n + 1, U64)
    np.cumsum(terms & half, out=low[1:])
    np.cumsum(terms >> U64(31), out=high[1:])
    total = _reduced(_reduced(low) + times(_reduced(high), np.full(n + 1, U64(2**31))))
    inverse = power(pow(BASE, -1, 2**61 - 1), n + 1)
    h = times(_reduced(total[ends] + PRIME - total[begins]), inverse[begins])
    return mix(h ^ mix((ends - begins).astype(U64)))


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start and end of every word, and the row it belongs to. Words never cross rows."""
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[:-1] = inside
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    row_start = np.zeros(len(data) + 1, bool)
    row_start[offsets] = True
    starts = np.flatnonzero(edge & (~before | row_start))
    ends = np.flatnonzero(before & (~edge | row_start))
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number; the last eight places have none."""
    return np.ndarray(len(data) - 7, "<u8", data, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    sizes = ends - starts
    h = mix(sizes.astype(U64) + U64(0x9E3779B97F4A7C15))
    eight = eights(padded(data))
    live = np.flatnonzero(sizes <= SHORT)
    for at in range(0, SHORT, 8):
        live = live[sizes[live] > at]
        if not len(live):
            break
        word = eight[starts[live] + at] & _FIRST_BYTES[np.minimum(sizes[live] - at, 8)]
        h[live] = mix(mix(h[live] ^ word) + U64(at))
    for i in np.flatnonzero(sizes > SHORT):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def equal_spans(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, other: np.ndarray, begins: np.ndarray
) -> np.ndarray:
    """Whether each span has the same bytes as the one of its size in other data; both are padded."""
    same = np.ones(len(starts), bool)
    one, two = eights(data), eights(other)
    live = np.flatnonzero(sizes <= SHORT)
    for at in range(0, SHORT, 8):
        live = live[sizes[live] > at]
        if not len(live):
            break
        differ = one[starts[live] + at] ^ two[begins[live] + at]
        same[live] &= differ & _FIRST_BYTES[np.minimum(sizes[live] - at, 8)] == 0
    for i in np.flatnonzero(sizes > SHORT):
        same[i] = np.array_equal(data[starts[i] : starts[i] + sizes[i]], other[begins[i] : begins[i] + sizes[i]])
    return same
