"""Benchmark decontamination by Wu-Manber multi-pattern search.

Documents and benchmark items become words joined by single blanks, with a blank at either
end, so a window of words occurs in a document exactly where its bytes do. Windows are
grouped by length. In each group a shift table over hashed blocks of bytes tells how far the
search may jump, a block that ends the common prefix of some window selects a bucket of
windows by its hash, and comparing bytes confirms or refutes them. The search runs over many
stretches of text at once in numpy; each has its own position.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.llm import text as tx
from dimkeeper.llm.names import any_names
from dimkeeper.session import stage

WINDOW = 13
#: Benchmark text per search, in bytes. A larger benchmark is searched for in several passes.
PASS_BYTES = 2 << 20
TABLE_BITS = 18
LANE = 2048

_BLANKED = bytes(32 if s else int(low) for s, low in zip(tx.NON_WORDS, tx.LOWER, strict=True))
# A-Z are no separators: they are lower-cased first.
_BLANKED = bytes(b + 32 if 65 <= b <= 90 else _BLANKED[b] for b in range(256))


def normal(data: bytes) -> bytes:
    """Lower-case words joined by blanks, with a blank at either end; empty without words."""
    found = data.translate(_BLANKED).split(b" ")
    found = [w for w in found if w]
    return b" " + b" ".join(found) + b" " if found else b""


def windows(data: bytes, size: int = WINDOW) -> list[bytes]:
    """Every run of ``size`` words of a normal text, or all its words if it has fewer."""
    found = data.split()
    last = max(len(found) - size, 0)
    return [b" " + b" ".join(found[i : i + size]) + b" " for i in range(last + 1)] if found else []


class Group:
    """Patterns of similar length, searched for together."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.least = m = min(map(len, patterns))
        self.most = max(map(len, patterns))
        self.block = k = 8 if m >= 24 else 4 if m >= 8 else min(2, m)
        self.patterns, self.numbers = patterns, numbers
        heads = np.array([np.frombuffer(p[:m], np.uint8) for p in patterns])
        self.shift = np.full(1 << TABLE_BITS, m - k + 1, np.int32)
        for end in range(k, m + 1):  # later blocks allow smaller jumps
            self.shift[np.unique(self.hashes(heads[:, end - k : end]))] = m - end
        # Patterns by the hash of the block that ends their first m bytes.
        keys = self.hashes(heads[:, m - k :])
        order = np.argsort(keys, kind="stable")
        self.bucket = np.searchsorted(keys[order], np.arange((1 << TABLE_BITS) + 1))
        self.order = order

    def hashes(self, blocks: np.ndarray) -> np.ndarray:
        """Table slots of blocks given as rows of bytes."""
        wide = np.zeros((len(blocks), 8), np.uint8)
        wide[:, : blocks.shape[1]] = blocks
        return self._slot(wide.view("<u8").ravel())

    @staticmethod
    def _slot(value: np.ndarray) -> np.ndarray:
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(position, index of the pattern) of every occurrence."""
        n, m, k = len(data), self.least, self.block
        if n < m:
            return
        padded = np.frombuffer(data + b"\0" * 8, np.uint8)
        # 8 bytes from every position, at any alignment
        view = np.lib.stride_tricks.as_strided(padded, (n, 8), (1, 1))
        mask = np.uint64((1 << (8 * k)) - 1) if k < 8 else np.uint64(2**64 - 1)
        # A lane looks for patterns that start in its stretch.
        at = np.arange(0, n - m + 1, LANE)
        stop = np.minimum(at + LANE, n - m + 1)
        while len(at):
            ends = at + (m - k)
            blocks = view[ends].view("<u8").ravel() & mask
            slot = self._slot(blocks)
            jump = self.shift[slot]
            for lane in np.flatnonzero(jump == 0).tolist():
                yield from self._confirm(data, int(at[lane]), int(slot[lane]))
            at = at + np.maximum(jump, 1)
            going = at < stop
            if not going.all():
                at, stop = at[going], stop[going]

    def _confirm(self, data: bytes, at: int, slot: int) -> Iterator[tuple[int, int]]:
        for i in self.order[self.bucket[slot] : self.bucket[slot + 1]].tolist():
            if data.startswith(self.patterns[i], at):
                yield at, self.numbers[i]


class Matcher:
    """All windows of some benchmark items, with the items that each belongs to."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int = WINDOW):
        owners: dict[bytes, set] = defaultdict(set)
        for item, data in items:
            for w in windows(normal(data), size):
                owners[w].add(item)
        self.patterns = list(owners)
        self.owners = [sorted(x for x in owners[p] if x is not None) for p in self.patterns]
        self.n_words = [p.count(b" ") - 1 for p in self.patterns]
        classes: dict[int, list[int]] = defaultdict(list)
        for i, p in enumerate(self.patterns):
            classes[len(p).bit_length()].append(i)
        self.groups = [Group([self.patterns[i] for i in c], c) for c in classes.values()]

    def find(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set]]:
        """Per text: its words, the spans of words hit (first, beyond the last), the items."""
        clean = [normal(t) for t in texts]
        # A byte that no pattern holds keeps occurrences from crossing texts.
        data = b"\0".join(clean)
        begins = np.cumsum([0, *(len(c) + 1 for c in clean)])
        blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        first = np.searchsorted(blanks, begins)
        for group in self.groups:
            for at, number in group.search(data):
                row = int(np.searchsorted(begins, at, "right")) - 1
                word = int(np.searchsorted(blanks, at)) - int(first[row])
                spans[row].append((word, word + self.n_words[number]))
                items[row].update(self.owners[number])
        return [max(c.count(b" ") - 1, 0) for c in clean], spans, items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same words in disjoint ascending spans."""
    out: list[tuple[int, int]] = []
    for first, beyond in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], beyond))
        else:
            out.append((first, beyond))
    return out


HITS = "_words BIGINT, _spans ARRAY<STRUCT<first: BIGINT, beyond: BIGINT>>, _items ARRAY<STRING>"
FOUND = ["_words", "_spans", "_items"]


def _search(docs: DataFrame, items: list[tuple[str | None, bytes]], size: int) -> DataFrame:
    """Add what one pass finds to what earlier passes found."""
    kept = [c for c in docs.columns if c not in FOUND]
    hits = T.StructType.fromDDL(HITS)
    schema = T.StructType([*(docs.schema[c] for c in kept), *hits])
    types = pa.list_(pa.struct([("first", pa.int64()), ("beyond", pa.int64())])), pa.list_(pa.string())
    shared = docs.sparkSession.sparkContext.broadcast(items)
    earlier = "_spans" in docs.columns
    made: dict[str, Matcher] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = made.setdefault("it", None) or Matcher(shared.value, size)
        made["it"] = match
        for part in tx.slices(batches):
            data = part.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            n, spans, found = match.find(data)
            if earlier:
                before = [[(s["first"], s["beyond"]) for s in x] for x in part.column("_spans").to_pylist()]
                spans = [a + b for a, b in zip(before, spans, strict=True)]
                found = [a | set(b) for a, b in zip(found, part.column("_items").to_pylist(), strict=True)]
            out = [[{"first": a, "beyond": b} for a, b in merged(x)] for x in spans]
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in kept),
                    pa.array(n, pa.int64()),
                    pa.array(out, types[0]),
                    pa.array([sorted(x) for x in found], types[1]),
                ],
                schema.names,
            )

    return docs.mapInArrow(run, schema)


def _found(docs: DataFrame, benchmark: DataFrame, size: int) -> DataFrame:
    bench = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where("text IS NOT NULL")
    total = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    passes = max(1, -(-2 * total // PASS_BYTES))
    out = docs.drop(*FOUND)
    for k in range(passes):
        of_pass = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(passes)) == k)
        items = [(r["item"], r["text"].encode()) for r in of_pass.distinct().toLocalIterator()]
        out = _search(out, items, size)
        if k + 1 < passes:
            out = stage(out, "decontamination")
    return out.withColumn(
        "_hit", F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["beyond"] - s["first"])
    )


@any_names("n_words", "spans", "n_hit", "items")
def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Add ``n_words``, ``spans`` (words hit, disjoint), ``n_hit`` and ``items`` (ids as strings).

    Columns of these names are replaced. An item of fewer than ``size`` words, but not none,
    is one window. Null and empty texts have no words, null items no windows. Repeated rows
    stay, and each gets the same result. An item without an id counts for the words hit but is
    not listed. The benchmark is measured first: each pass searches for about PASS_BYTES of it
    at most, and passes are joined through tables in the shared folder, so no benchmark is too
    large for memory.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "n_hit", "items")]
    return _found(docs, benchmark, size).select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("_words").alias("n_words"),
        F.col("_spans").alias("spans"),
        F.col("_hit").alias("n_hit"),
        F.col("_items").alias("items"),
    )


def contaminated(share: int) -> Column:
    """Whether at least one word in ``share`` is hit."""
    return (F.col("_hit") > 0) & (share * F.col("_hit") >= F.col("_words"))


def report(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = 20) -> DataFrame:
    """One row per document: words, words hit, items, and whether it counts as contaminated."""
    return _found(docs.select("doc_id", "text"), benchmark, size).select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(share).alias("contaminated"),
    )


@any_names()
def clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, share: int = 20) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    found = _found(docs, benchmark, size).where(~contaminated(share))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
