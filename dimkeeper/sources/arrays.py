"""Records of large files that hold one JSON array each, read in blocks by many tasks.

Spark's text reader splits a file at any separator, here a closing brace, so blocks of one file go to
different tasks and no piece is cut. What a block cannot know is whether it begins within a
string, and how deeply nested. So a first pass sums up each block for both cases; the sums of the
blocks before give each block its state. A second pass cuts the blocks into records. Only the
ends of records that cross blocks are put together afterwards, at most two pieces a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, ESCAPE, BRACE = ord('"'), ord("\\"), ord("}")
_STEP = np.zeros(256, np.int64)
_STEP[[ord(c) for c in "[{"]] = 1
_STEP[[ord(c) for c in "]}"]] = -1
#: What may stand between records.
_BETWEEN = np.zeros(256, bool)
_BETWEEN[[ord(c) for c in " \t\r\n,[]}"]] = True


def _blocks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files' text up to each closing brace, and the block it is in."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value"
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
    """The batch's bytes per block, with the braces that the reader took away."""
    files, starts = batch.column("file"), batch.column("block").to_numpy()
    names = files.dictionary_encode()
    number = names.indices.to_numpy()
    cuts = np.flatnonzero((np.diff(starts) != 0) | (np.diff(number) != 0)) + 1
    for i, j in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if i < j:
            pieces = batch.column("value").slice(i, j - i).cast(pa.large_string())
            joined = "}".join(pieces.to_pylist()) + "}"
            yield (files[int(i)].as_py(), int(starts[i])), np.frombuffer(joined.encode(), np.uint8)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Quotes that open or close a string: those after an even number of backslashes."""
    at = np.arange(len(data))
    plain = np.maximum.accumulate(np.where(data != ESCAPE, at, -1))
    before = np.concatenate([[-1], plain[:-1]])
    return (data == QUOTE) & ((at - 1 - before) % 2 == 0)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: whether it holds an odd number of quotes, and its change of depth for both cases."""
    names = ["file", "block", "odd", "outside", "inside"]

    def row(key: tuple[str, int], odd: int, depth: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*key, odd, *depth)), strict=True)))

    key, odd, depth = None, 0, [0, 0]
    for batch in batches:
        for now, data in _runs(batch):
            if now != key:
                if key is not None:
                    yield row(key, odd, depth)
                key, odd, depth = now, 0, [0, 0]
            quotes = np.cumsum(_quotes(data))
            within = (quotes + odd) % 2 == 1
            depth[0] += int(_STEP[data[~within]].sum())
            depth[1] += int(_STEP[data[within]].sum())
            odd = (odd + int(quotes[-1])) % 2
    if key is not None:
        yield row(key, odd, depth)


def _states(summaries: DataFrame) -> dict[tuple[str, int], tuple[int, int, int]]:
    """Per block whether it begins in a string, its depth, and the depth between the file's records.

    One row per block of some 128 MB reaches the driver.
    """
    states, files = {}, {}
    for r in sorted(summaries.collect(), key=lambda r: (r["file"], r["block"])):
        odd, depth, blocks = files.setdefault(r["file"], (0, 0, []))
        blocks.append((r["block"], odd, depth))
        files[r["file"]] = (odd ^ r["odd"], depth + (r["inside"] if odd else r["outside"]), blocks)
    for file, (odd, depth, blocks) in files.items():
        # The reader's last piece has no brace of its own: an array ends one brace too deep.
        if odd or depth not in (-1, 0):
            raise ValueError(f"MALFORMED JSON: brackets or quotes do not match in {file}")
        states |= {(file, block): (o, d, -depth) for block, o, d in blocks}
    return states


def _cutter(shared: Broadcast):
    """Cuts blocks into records; part 0 is whole, 1 ends or goes on with an earlier block's, 2 begins one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rest, odd, depth, base, part = None, b"", 0, 0, 0, 0

        def rows(texts: list[str], parts: list[int]) -> pa.RecordBatch:
            columns = [pa.array([key[0]] * len(texts)), pa.array([key[1]] * len(texts), pa.int64())]
            columns += [pa.array(parts, pa.int64()), pa.array(texts, pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["file", "block", "part", "value"])

        for batch in batches:
            for now, data in _runs(batch):
                if now != key:
                    if rest:
                        yield rows([rest.decode()], [part or 2])
                    key, rest = now, b""
                    odd, depth, base = shared.value[now]
                    part = int(odd or depth > base)
                quotes = _quotes(data)
                seen = np.cumsum(quotes)
                within = (seen - quotes + odd) % 2 == 1
                after = depth + np.cumsum(np.where(within, 0, _STEP[data]))
                before = np.concatenate([[depth], after[:-1]])
                outside = (before <= base) & (after <= base) & ~within
                begins = ~within & (before == base) & (after == base + 1) & (base + 1 > 0)
                # The array's own bracket is no record.
                begins &= data == ord("{")
                ends = ~within & (before == base + 1) & (after == base) & (data == BRACE)
                wrong = outside & (~_BETWEEN[data] | quotes)
                wrong |= ~within & (before == base) & (after == base + 1) & ~begins
                if wrong.any():
                    raise ValueError(f"MALFORMED JSON: an element that is no record in {now[0]}")
                first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
                if odd or depth > base:
                    first = np.concatenate([[0], first])
                raw = data.tobytes()
                texts = [raw[i:j] for i, j in zip(first, last, strict=False)]
                if texts:
                    texts[0] = rest + texts[0]
                    yield rows([t.decode() for t in texts], [part] + [0] * (len(texts) - 1))
                    rest, part = b"", 0
                if len(first) > len(last):
                    rest += raw[first[len(last)] :]
                odd = (odd + int(seen[-1])) % 2
                depth = int(after[-1])
        if rest:
            yield rows([rest.decode()], [part or 2])

    return run


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of files that hold one array of objects (or one object) each, as text column ``value``.

    Files are split at ``spark.sql.files.maxPartitionBytes``. Unmatched brackets or quotes and
    elements that are no objects are errors. Files without text have no records.
    """
    blocks = _blocks(spark, path)
    states = _states(blocks.mapInArrow(_summaries, "file STRING, block BIGINT, odd BIGINT, outside BIGINT, inside BIGINT"))
    pieces = blocks.mapInArrow(_cutter(spark.sparkContext.broadcast(states)), "file STRING, block BIGINT, part BIGINT, value STRING")
    whole = pieces.where("part = 0").select("value")
    # At most two pieces per block: what ends an earlier block's record, and what begins one.
    order = Window.partitionBy("file").orderBy("block", "part")
    crossing = pieces.where("part > 0").withColumn("record", F.sum(F.when(F.col("part") == 2, 1).otherwise(0)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "part", "value")))
    joined = crossing.groupBy("file", "record").agg(F.concat_ws("", F.transform(parts, lambda p: p["value"])).alias("value"))
    return whole.unionByName(joined.select("value"))
