"""Exact top-k inner products by vector-approximation files.

Vectors are packed in blocks. A block holds each component's cell (one of CELLS per dimension),
the least and greatest value in each cell, and the exact vectors. A query first scans the
cells: they bound its score with every vector from above and below. It then reads exact
vectors in the order of their bounds, and stops as soon as its k-th best score is out of reach
of every bound left. The scan of a block starts from the k best of the blocks before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimkeeper.llm import text as tx

CELLS = 16
VECTOR_BLOCK = 4096
QUERY_BLOCK = 1024
#: Every block of queries meets the blocks of vectors in so many groups.
SALTS = 8
STEP = 48


def scaled(batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, floor(scale * vectors)) for each length of vectors; incomplete rows are left out."""
    batch = batch.filter(pc.and_(batch.column("id").is_valid(), batch.column("vec").is_valid()))
    if not batch.num_rows:
        return
    vectors = batch.column("vec")
    values = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        matrix = values[(ends[rows] - size)[:, None] + np.arange(size)]
        whole = np.isfinite(matrix).all(axis=1)
        yield ids[rows][whole], np.floor(scale * matrix[whole])


def approximate(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of every component, and per cell and dimension the least and greatest value in it."""
    low, high = matrix.min(axis=0), matrix.max(axis=0)
    width = np.where(high > low, (high - low) / CELLS, 1)
    cells = np.minimum(((matrix - low) / width).astype(np.int64), CELLS - 1).astype(np.uint8)
    least = np.zeros((CELLS, matrix.shape[1]))
    greatest = np.zeros((CELLS, matrix.shape[1]))
    for c in range(CELLS):
        inside = cells == c
        some = inside.any(axis=0)
        least[c] = np.where(some, np.where(inside, matrix, np.inf).min(axis=0), 0)
        greatest[c] = np.where(some, np.where(inside, matrix, -np.inf).max(axis=0), 0)
    return cells, least, greatest


def exact_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products, exact at any size; beyond 64 bits they saturate."""
    reach = np.abs(rows).max(initial=0) * np.abs(query).max(initial=0) * max(1, rows.shape[1])
    if reach < 2**53:
        return (rows @ query).astype(np.int64)
    whole = [[int(x) for x in r] for r in rows]
    q = [int(x) for x in query]
    scores = [sum(a * b for a, b in zip(r, q, strict=True)) for r in whole]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], np.int64)


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.scores = [np.zeros(0, np.int64)] * len(ids)
        self.names = [np.zeros(0, np.int64)] * len(ids)
        self.row_of = {n: q for q, n in enumerate(ids.tolist())}
        self.largest = float(np.abs(queries).max(initial=0))

    def add(self, q: int, scores: np.ndarray, names: np.ndarray) -> None:
        scores = np.concatenate([self.scores[q], scores])
        names = np.concatenate([self.names[q], names])
        # -s - 1 reverses the order of all 64-bit values
        keep = np.lexsort((names, -scores - 1))[: self.k]
        self.scores[q], self.names[q] = scores[keep], names[keep]

    def scan(self, names: np.ndarray, cells: np.ndarray, least, greatest, exact: np.ndarray) -> None:
        columns = np.arange(cells.shape[1])
        # Twice the middle and twice the half-width of every cell: integers, like the vectors.
        middle, width = (greatest + least)[cells, columns], (greatest - least)[cells, columns]
        reach = 2 * self.largest * max(1.0, float(np.abs(exact).max(initial=0))) * max(1, cells.shape[1])
        kind = np.float32 if reach < 2**23 else np.float64  # exact below 2**24 and 2**53
        queries = self.queries.astype(kind)
        products = queries @ middle.T.astype(kind)
        spread = np.abs(queries) @ width.T.astype(kind)
        if reach >= 2**52:
            spread += kind(reach * 1e-12)
        # Scores saturate at 64 bits, so their bounds do too.
        upper = np.clip(products + spread, -(2.0**64), 2.0**64)
        own = np.flatnonzero(np.isin(names, self.ids))
        hidden = [(self.row_of[n], c) for n, c in zip(names[own].tolist(), own.tolist(), strict=True)]
        for q, c in hidden:
            upper[q, c] = -np.inf
        floor = np.array([2.0 * s[-1] if len(s) == self.k else -np.inf for s in self.scores])
        if np.isinf(floor).any() and len(names) >= self.k + len(hidden):
            lower = np.clip(products - spread, -(2.0**64), 2.0**64)
            for q, c in hidden:
                lower[q, c] = -np.inf
            at = len(names) - self.k
            floor = np.maximum(floor, np.partition(lower, at, axis=1)[:, at])
        for q in range(len(self.ids)):
            bound = upper[q]
            left = np.flatnonzero((bound >= floor[q]) & (bound > -np.inf))
            left = left[np.argsort(-bound[left], kind="stable")]
            for start in range(0, len(left), STEP):
                if len(self.scores[q]) == self.k and bound[left[start]] < 2.0 * self.scores[q][-1]:
                    break
                part = left[start : start + STEP]
                self.add(q, exact_products(exact[part], self.queries[q]), names[part])

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        columns = [np.repeat(self.ids, sizes), np.concatenate(self.names), np.concatenate(self.scores)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def _packed(vectors: DataFrame, scale: float, block: int, cells: bool) -> DataFrame:
    schema = tx.struct("dim int, block long, n int, ids binary, exact binary, cells binary, edges binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, matrix in scaled(batch, scale):
                for at in range(0, len(ids), block):
                    names, rows = ids[at : at + block], matrix[at : at + block]
                    if not len(names):
                        continue
                    coded = least = greatest = np.zeros(0)
                    if cells:
                        coded, least, greatest = approximate(rows)
                    # A block's number only has to spread: any row may stand for it.
                    row = [rows.shape[1], int(names[0]), len(names), names.tobytes(), rows.tobytes()]
                    row += [coded.tobytes(), least.tobytes() + greatest.tobytes()]
                    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], schema.names
                    )

    return vectors.mapInArrow(run, schema)


def top_k(vectors: DataFrame, queries: DataFrame, k: int, scale: float = 64.0) -> DataFrame:
    """The k highest inner products of each query with all vectors but its own.

    Both frames have ``id`` (long) and ``vec`` (array of numbers); vectors are compared as
    floor(scale * component). Returns query_id, rank (from 1), vec_id, score; ties go to the
    smaller vec_id. Rows whose id or vector is null, or whose vector holds a null or a value
    that is not finite, take no part. A query meets only vectors of its length. Vectors with a
    query's id are its own. Of query rows with one id the least vector counts; repeated
    vectors are each a candidate. No query or no vector: no rows.
    """
    once = queries.groupBy("id").agg(F.min("vec").alias("vec"))
    asked = _packed(once, scale, QUERY_BLOCK, False).select(
        "dim",
        F.monotonically_increasing_id().alias("asked"),
        F.col("n").alias("q_n"),
        F.col("ids").alias("q_ids"),
        F.col("exact").alias("q_exact"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    stored = _packed(vectors, scale, VECTOR_BLOCK, True).withColumn(
        "salt", F.pmod(F.xxhash64("block", "n"), F.lit(SALTS)).cast("int")
    )
    pairs = asked.join(stored, ["dim", "salt"]).select(
        "dim", "asked", "q_n", "q_ids", "q_exact", "n", "ids", "exact", "cells", "edges"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, current = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                d = row["dim"]
                if (d, row["asked"]) != current:
                    if best:
                        yield best.rows()
                    current = d, row["asked"]
                    matrix = np.frombuffer(row["q_exact"]).reshape(row["q_n"], d)
                    best = Best(np.frombuffer(row["q_ids"], np.int64), matrix, k)
                least, greatest = np.frombuffer(row["edges"]).reshape(2, CELLS, d)
                best.scan(
                    np.frombuffer(row["ids"], np.int64),
                    np.frombuffer(row["cells"], np.uint8).reshape(row["n"], d),
                    least,
                    greatest,
                    np.frombuffer(row["exact"]).reshape(row["n"], d),
                )
        if best:
            yield best.rows()

    found = pairs.mapInArrow(run, tx.struct("query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
