"""Language-model scores by stupid backoff, computed with joins.

Words are hashed; an n-gram is a hash of its words. A document is scored by what the rest of the
corpus holds: its own occurrences are subtracted from every count of two and three words and from
their contexts, else no text of the corpus would ever back off. An n-gram that is left with a count
scores log(count / count of its context), one that is not goes on to the next shorter order
with log(BACKOFF) added. Single words keep all their counts, so every word has a score.

Texts are dealt out to blocks. A block explodes its texts into n-grams and sends its different ones,
sorted and packed, to the ranges of hashes that they belong to. The count table of a range adds up what
all blocks send, is joined to each block's n-grams, and the counts go back in the order of the n-grams.
Rows of one n-gram each would take twice the room, and as much again for every look-up.

An n-gram of three words that occurs in another document has both its parts of two words there. So the
longer orders are exploded after the shorter ones are counted, and only where both parts are left
with a count; no result depends on that.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.llm import text as tx

ORDER, BACKOFF = 3, 0.4
#: Bytes of text in a block, words per range of hashes (what a task holds of either), and how many of both
#: there are at least.
BLOCK_BYTES, RANGE_WORDS, LEAST = 8 << 20, 4 << 20, 16
U64 = tx.U64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], U64)
#: What a block sends to a range and what it gets back.
_SENT = tx.struct("n long, range long, block long, size long, grams binary, counts binary")
_COUNTED = tx.struct("n long, range long, block long, size long, counts binary")
_SCORED = tx.struct("doc_id long, n_words long, log_score double, perplexity double")


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Per order the hash of the n-gram that ends at each word (its order is cut at the text's
    beginning), and each word's row."""
    low = tx.LOWER[data]
    starts, ends, row = tx.words(low, offsets, tx.SPACES)
    h = tx.span_hashes(low, starts, ends)
    out = [h]
    for n in range(2, order + 1):
        longer = out[-1].copy()
        if len(h) >= n:
            inside = np.zeros(len(h), bool)
            inside[n - 1 :] = row[n - 1 :] == row[: len(h) - n + 1]
            joined = sum(h[n - 1 - k : len(h) - k] * _FACTORS[k] for k in range(n))
            longer[n - 1 :] = np.where(inside[n - 1 :], tx.mix(joined + U64(n)), longer[n - 1 :])
        out.append(longer)
    return out, row


def _places(row: np.ndarray) -> np.ndarray:
    """Each word's place in its text."""
    return np.arange(len(row)) - np.searchsorted(row, row)


def pack(values: np.ndarray, plain: int) -> bytes:
    """One or more whole numbers from 0 on as planes of bytes, lowest first: ``plain`` planes as they are,
    the rest compressed."""
    width = max(plain + 1, (int(values.max()).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    rest = zlib.compressobj(1, wbits=-15, strategy=zlib.Z_RLE)
    return planes[:plain].tobytes() + rest.compress(planes[plain:].tobytes()) + rest.flush()


def unpack(data: bytes, size: int, plain: int) -> np.ndarray:
    """The ``size`` numbers that ``pack`` made these bytes of."""
    rest = zlib.decompress(memoryview(data)[plain * size :], wbits=-15)
    planes = np.frombuffer(data[: plain * size] + rest, np.uint8).reshape(-1, size)
    out = np.zeros((size, 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.view("<u8").ravel()


def _arrow(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _own(row: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often the n-gram at each word (a number) occurs in the word's text."""
    of_text = row * (int(gram.max(initial=0)) + 1) + gram
    _, at, n = np.unique(of_text, return_inverse=True, return_counts=True)
    return n[at]


class _Block:
    """A block's n-grams, with what is left of their counts as far as these are known.

    ``known`` holds the counts of some orders, from one word on, as the ranges sent them.
    """

    def __init__(self, texts: pa.Table, known: pa.Table | None, order: int):
        self.found, self.row = grams(*tx.utf8(texts.column("text").cast(pa.large_binary()).combine_chunks()), order)
        self.place = _places(self.row)
        self.times = texts.column("times").to_numpy()
        #: Per order, at each word: all occurrences, and those in other documents.
        self.all, self.left = {}, {}
        counted: dict[int, dict[int, np.ndarray]] = {}
        for r in known.sort_by("range").to_pylist() if known is not None else []:
            counted.setdefault(r["n"], {})[r["range"]] = unpack(r["counts"], r["size"], 0)
        for n in range(1, max(counted, default=0) + 1):
            at, value, which = self.exploded(n)
            count = np.concatenate([np.zeros(0, U64), *counted.get(n, {}).values()]).astype(np.int64)
            if len(count) != len(value):
                raise RuntimeError(f"a block has {len(value)} n-grams of {n} words and got {len(count)} counts")
            self.all[n], self.left[n] = np.zeros((2, len(self.row)), np.int64)
            self.all[n][at] = count[which]
            more = np.flatnonzero(count[which] > 1)  # one occurrence is the text's own
            self.left[n][at[more]] = count[which[more]] - _own(self.row[at[more]], which[more])

    def exploded(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The words at which an n-gram ends that other documents may have, the different
        n-grams in ascending order, and which of them each word has."""
        may = self.place >= n - 1
        if n > 2:
            some = self.left.get(n - 1, np.zeros(len(may))) > 0
            may[1:] &= some[1:] & some[:-1]
        at = np.flatnonzero(may)
        return at, *np.unique(self.found[n - 1][at], return_inverse=True)

    def sent(self, n: int, bits: int) -> Iterator[dict]:
        """The n-grams of one order per range, with how often they occur in the block."""
        at, value, which = self.exploded(n)
        count = np.bincount(which, self.times[self.row[at]], len(value)).astype(np.int64)
        begins = np.arange(1 << bits, dtype=U64) << U64(64 - bits)
        cuts = np.append(np.searchsorted(value, begins), len(value))
        for k in np.flatnonzero(np.diff(cuts)):
            some = slice(cuts[k], cuts[k + 1])
            steps = np.diff(value[some], prepend=begins[k])
            yield {"n": n, "range": int(k), "size": len(steps), "grams": pack(steps, 5), "counts": pack(count[some], 0)}

    def scores(self, order: int, backoff: float, total: int) -> tuple[np.ndarray, np.ndarray]:
        """Each row's number of words and the sum of their scores."""
        size = np.minimum(self.place + 1, order)
        value = np.log(self.all[1] / total) if len(size) else np.zeros(0)
        reached = np.ones(len(size), np.int64)
        for n in range(2, order + 1):
            hit = np.flatnonzero(self.left.get(n, np.zeros(len(size))) > 0)
            # The context of an n-gram is the (n-1)-gram that ends one word earlier.
            value[hit] = np.log(self.left[n][hit] / self.left[n - 1][hit - 1]) if len(hit) else 0
            reached[hit] = n
        # Orders that the text's beginning did not allow are no backing off.
        value += (size - reached) * np.log(backoff)
        rows = len(self.times)
        return np.bincount(self.row, minlength=rows), np.bincount(self.row, value, rows)


def _measured(docs: DataFrame) -> tuple[int, int]:
    """Bytes and words of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            data, offsets = tx.utf8(part.column("text"))
            starts, _, _ = tx.words(data, offsets, tx.SPACES)
            yield pa.RecordBatch.from_pydict({"bytes": [len(data)], "words": [len(starts)]})

    rows = docs.select("text").mapInArrow(run, tx.struct("bytes long, words long"))
    return tuple(x or 0 for x in rows.agg(F.sum("bytes"), F.sum("words")).first())


def _sent(texts: DataFrame, known: DataFrame | None, orders: range, bits: int) -> DataFrame:
    """The n-grams of some orders, one row per block, order and range."""

    def run(part: pa.Table, counted: pa.Table | None) -> pa.Table:
        block, number = _Block(part, counted, orders[-1]), part.column("block")[0].as_py()
        rows = [r | {"block": number} for n in orders for r in block.sent(n, bits)]
        return pa.Table.from_pylist(rows, _arrow(_SENT))

    if known is None:
        return texts.groupBy("block").applyInArrow(lambda part: run(part, None), _SENT)
    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, _SENT)


def _counted(sent: DataFrame) -> DataFrame:
    """Each block's n-grams joined to the count table of their range: the counts, in the block's order."""

    def run(part: pa.Table) -> pa.Table:
        rows = part.to_pylist()
        # All begin at the range's first hash, which may stay out of the sums.
        grams = [np.cumsum(unpack(r["grams"], r["size"], 5), dtype=U64) for r in rows]
        counts = [unpack(r["counts"], r["size"], 0) for r in rows]
        table, which = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.bincount(which, np.concatenate(counts), len(table)).astype(np.int64)
        ends = np.cumsum([r["size"] for r in rows])
        out = []
        for r, end in zip(rows, ends, strict=True):
            of_block = total[which[end - r["size"] : end]]
            out.append({k: r[k] for k in ("n", "range", "block", "size")} | {"counts": pack(of_block, 0)})
        return pa.Table.from_pylist(out, _arrow(_COUNTED))

    return sent.groupBy("n", "range").applyInArrow(run, _COUNTED)


def scores(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """Per document: doc_id, n_words, log_score (sum over its words), perplexity.

    The tables are counted over all texts of ``docs``. Every row is a document of its own, so
    a repeated row finds all its n-grams in the other. Null texts and texts without words have
    no words, a sum of 0 and no perplexity. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    size, total = _measured(docs)
    blocks = max(LEAST, size // BLOCK_BYTES + 1)
    bits = (max(LEAST, total // RANGE_WORDS) - 1).bit_length()
    # The texts move once: all steps read the same exchange. Equal rows become one.
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    texts = docs.withColumn("block", block).repartition("block")
    texts = texts.groupBy("block", "doc_id", "text").agg(F.count(F.lit(1)).alias("times"))

    known = None
    for orders in [range(1, min(order, 2) + 1), *(range(n, n + 1) for n in range(3, order + 1))]:
        found = _counted(_sent(texts, known, orders, bits))
        known = found if known is None else known.unionByName(found)

    def run(part: pa.Table, counted: pa.Table) -> pa.Table:
        n, value = _Block(part, counted, order).scores(order, backoff, total)
        with np.errstate(over="ignore"):  # infinite, as Spark's exp would be
            perplexity = np.exp(-value / np.maximum(n, 1))
        columns = [part.column("doc_id").combine_chunks(), pa.array(n), pa.array(value), pa.array(perplexity, mask=n == 0)]
        copies = pa.array(np.repeat(np.arange(len(n)), part.column("times").to_numpy()))
        return pa.Table.from_arrays(columns, schema=_arrow(_SCORED)).take(copies)

    return texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, _SCORED)
