"""Token ids in files: canonical Huffman codes of limited length.

The code lengths follow from the counts of all ids, found by package-merge, so no code is
longer than MAX_BITS and one table lookup decodes an id. The lengths alone define the codes.

A file table is a folder of Parquet files. ``codes`` holds one row with the length of every
id's code. ``segments`` holds the ids in ascending document order: each row has some whole
documents (about SEGMENT_IDS ids, or one longer document), one bit stream for all their ids,
a checkpoint of the stream every BLOCK ids, the documents' ids and counts, and the number of
ids in the whole table before the segment. Blocks decode independently of each other, from
their checkpoint; numpy decodes all blocks of a segment side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dimkeeper.llm import bpe
from dimkeeper.llm import text as tx
from dimkeeper.session import fresh_path

MAX_BITS = 16
BLOCK = 256
SEGMENT_IDS = 1 << 18

SEGMENT = tx.struct(
    "part int, segment int, before long, n_ids long, doc_ids binary, doc_nulls binary, counts binary"
)


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with no code over ``limit`` bits (package-merge).

    An id that never occurs has length 0, a single id that occurs has length 1.
    """
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids need codes of more than {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaf = counts[order].astype(np.float64)
    # Per level, how many of the cheapest items are leaves, for each length of the list.
    packages, taken = np.zeros(0), []
    for _ in range(limit):
        weight = np.concatenate([leaf, packages])
        rank = np.argsort(weight, kind="stable")
        taken.append(np.concatenate([[0], np.cumsum(rank < len(leaf))]))
        weight = weight[rank]
        packages = weight[0 : len(weight) // 2 * 2 : 2] + weight[1 : len(weight) // 2 * 2 : 2]
    # The solution takes the 2n - 2 cheapest items of the last list; its packages point below.
    items = 2 * len(leaf) - 2
    of_leaf = np.zeros(len(leaf) + 1, np.int64)
    for n_leaves in reversed(taken):
        n = int(n_leaves[items])
        of_leaf[:n] += 1
        items = 2 * (items - n)
    lengths[order] = of_leaf[:-1]
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of every id, as a number of ``lengths`` bits: by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for bits in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == bits)
        code <<= bits - last
        last = bits
        codes[ids] = code + np.arange(len(ids))
        code += len(ids)
    return codes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The bit stream of some ids, and the bit at which each block of them begins (uint32)."""
    bits = lengths[ids].astype(np.int64)
    ends = np.cumsum(bits)
    starts = ends - bits
    total = int(ends[-1]) if len(ids) else 0
    stream = np.zeros((total + 31) // 32 + 1, np.uint64)
    if len(ids):
        # No code is longer than a word, so every 32-bit word has the start of one.
        value = codes[ids] << (64 - (starts & 31) - bits).astype(np.uint64)
        word = starts >> 5
        first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        summed = np.add.reduceat(value, first)
        at = word[first]
        stream[at] |= summed >> np.uint64(32)
        stream[at + 1] |= summed & np.uint64(0xFFFFFFFF)
    return stream.astype(">u4").tobytes(), starts[::BLOCK].astype("<u4").tobytes()


def decoding_table(lengths: np.ndarray) -> np.ndarray:
    """For every MAX_BITS bits that may come next: the id, times 32, plus its code's length."""
    codes = canonical(lengths).astype(np.int64)
    used = np.flatnonzero(lengths)
    used = used[np.argsort(codes[used] << (MAX_BITS - lengths[used].astype(np.int64)))]
    spans = 1 << (MAX_BITS - lengths[used].astype(np.int64))
    table = np.repeat(used.astype(np.int64) * 32 + lengths[used], spans)
    return np.concatenate([table, np.zeros((1 << MAX_BITS) - len(table), np.int64)])


def unpack(stream: bytes, checkpoints: bytes, n: int, table: np.ndarray) -> np.ndarray:
    """The ``n`` ids of a stream. All blocks advance together, one id a step."""
    if not n:
        return np.zeros(0, np.uint32)
    at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
    # 32 bits from every byte of the stream
    data = np.frombuffer(stream + b"\0" * 4, np.uint8)
    out = np.zeros((BLOCK, len(at)), np.uint32)
    last = n - BLOCK * (len(at) - 1)
    for step in range(min(BLOCK, n)):
        if step == last:  # the last block is shorter
            at = at[:-1]
        byte = at >> 3
        bits = (
            data[byte].astype(np.int64) << 16 | data[byte + 1].astype(np.int64) << 8 | data[byte + 2]
        ) >> (8 - (at & 7))
        entry = table[bits & 0xFFFF]
        out[step, : len(at)] = entry >> 5
        at = at + (entry & 31)
    return out.T.ravel()[:n]


def _raw_type(n_ids: int) -> str:
    """The bytes of an id that is not coded yet: two where they suffice."""
    return "<u2" if n_ids <= 1 << 16 else "<u4"


def _ordered_ids(docs: DataFrame, path: str, end: int) -> DataFrame:
    """Segments of raw ids: documents in order, each with the end id.

    After the segments of a partition comes a row with nothing but the partition and ``totals``, the count of
    every id in it, so that the ids need not be read again to be counted.
    """
    # One shuffle of the texts, before anything is computed: range bounds come from a sample
    # of its input. The hash keeps repeated ids from making one large range.
    order = [F.col("doc_id"), F.xxhash64("text")]
    placed = (
        docs.select("doc_id", "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
    )
    schema = T.StructType([*SEGMENT, *tx.struct("ids binary, totals binary")])
    raw_type = _raw_type(max(len(bpe.tokens(path).tokens), end + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = bpe.coder(path)
        stop = np.array([end], raw_type).tobytes()
        width = len(stop)
        names, nulls, counts, ids, size = [], [], [], [], 0
        segment = before = 0
        part = None
        totals = np.zeros(0, np.int64)

        def row(*values) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]
            arrays = [pa.array([v], k) for v, k in zip(values, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        def flush() -> pa.RecordBatch:
            nonlocal totals
            raw = b"".join(ids)
            totals = _added(totals, np.bincount(np.frombuffer(raw, raw_type)))
            documents = np.array(names, "<i8").tobytes(), bytes(nulls), np.array(counts, "<i8").tobytes()
            return row(part, segment, before, size, *documents, raw, None)

        for rows in tx.slices(batches, keep=True):
            part = rows.column("part")[0].as_py()
            coded, n = code.encode(*tx.utf8(rows.column("text")))
            coded, ends = coded.astype(raw_type).tobytes(), np.cumsum(n).tolist()
            for name, b, e in zip(rows.column("doc_id").to_pylist(), [0, *ends], ends):  # noqa: B905
                ids += [coded[width * b : width * e], stop]
                names.append(name or 0)
                nulls.append(name is None)
                counts.append(e - b + 1)
                size += counts[-1]
                if size >= SEGMENT_IDS:
                    yield flush()
                    segment, before = segment + 1, before + size
                    names, nulls, counts, ids, size = [], [], [], [], 0
        if names:
            yield flush()
        if part is not None:
            yield row(part, *[None] * 7, totals.astype("<i8").tobytes())

    return placed.mapInArrow(run, schema)


def _added(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The sum of two arrays of counts; what a shorter one lacks is 0."""
    out = np.zeros(max(len(one), len(two)), np.int64)
    out[: len(one)] += one
    out[: len(two)] += two
    return out


def _count_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for raw in batch.column("totals").to_pylist():
            total = _added(total, np.frombuffer(raw, "<i8"))
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["id", "n"])


def write(docs: DataFrame, tokenizer: str, path: str, end: int = 0) -> None:
    """Encode every text, append ``end``, and write all ids below ``path``.

    Documents come in ascending order of ``doc_id`` (nulls first), repeated ids in the order of
    a hash of their text; repeated rows are all written. A null text has no ids but the end.
    Other columns are not read. The folder must not exist yet.
    """
    spark = docs.sparkSession
    raw_path = fresh_path(spark, "token-ids")
    _ordered_ids(docs, tokenizer, end).write.option("compression", "zstd").parquet(raw_path)
    raw = spark.read.parquet(raw_path)

    # At most one row per id of the vocabulary reaches the driver.
    totals = raw.where("totals IS NOT NULL").select("totals")
    counted = totals.mapInArrow(_count_ids, "id BIGINT, n BIGINT").groupBy("id").agg(F.sum("n"))
    counts = np.zeros(max(len(bpe.tokens(tokenizer).tokens), end + 1), np.int64)
    raw_type = _raw_type(len(counts))
    for number, n in counted.collect():
        counts[number] = n
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths BINARY").coalesce(1).write.parquet(
        f"{path}/codes"
    )

    # One row per partition of the sorted documents.
    raw = raw.where("totals IS NULL").drop("totals")
    sizes = raw.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = raw.join(F.broadcast(offsets), "part")
    codes = canonical(lengths)
    schema = tx.struct(
        "part int, segment int, start long, n_ids long, doc_ids binary, doc_nulls binary, "
        "counts binary, stream binary, checkpoints binary"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                ids = np.frombuffer(row.column("ids")[0].as_py(), raw_type)
                stream, checkpoints = pack(ids, codes, lengths)
                start = pc.add(row.column("offset"), row.column("before"))
                kept = [row.column(c) for c in ("n_ids", "doc_ids", "doc_nulls", "counts")]
                yield pa.RecordBatch.from_arrays(
                    [row.column("part"), row.column("segment"), start, *kept]
                    + [pa.array([stream], pa.binary()), pa.array([checkpoints], pa.binary())],
                    schema.names,
                )

    # The streams are as dense as they get.
    placed.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/segments")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents as written: ``doc_id``, ``start`` (ids before it), ``ids`` (as in ``bpe.encode``)."""
    lengths = np.frombuffer(spark.read.parquet(f"{path}/codes").first()["lengths"], np.uint8)
    table = decoding_table(lengths)
    schema = tx.struct("doc_id long, start long, ids binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                ids = unpack(row["stream"], row["checkpoints"], row["n_ids"], table).astype("<u4")
                names = np.frombuffer(row["doc_ids"], "<i8")
                nulls = np.frombuffer(row["doc_nulls"], bool)
                ends = np.cumsum(np.frombuffer(row["counts"], "<i8"))
                starts = np.concatenate([[0], ends[:-1]])
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64(), mask=nulls),
                        pa.array(starts + row["start"], pa.int64()),
                        pa.array([raw[4 * i : 4 * j] for i, j in zip(starts, ends, strict=True)], pa.binary()),
                    ],
                    schema.names,
                )

    return spark.read.parquet(f"{path}/segments").mapInArrow(run, schema)


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write all ids, read them back; per document its place, length and checksum."""
    path = fresh_path(docs.sparkSession, "huffman")
    write(docs, tokenizer, path)
    return read(docs.sparkSession, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
