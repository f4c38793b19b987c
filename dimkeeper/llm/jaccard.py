"""Near-duplicate groups: an exact Jaccard join on word shingles with count-vector R-trees.

A document's shingles are hashed to 64 bits; texts with equal sets form a class and go on as
one. Four steps find all links between classes:

1. Deal out. Two sets that overlap enough share one of the first ``n - ceil(0.75 n) + 1``
   shingles of each, in any order common to all documents. Shingles with small hashes are
   counted over all documents. Those that occur once come first: they need not be dealt out,
   since no other document has them. The most frequent ones come last. Classes that
   share a dealt shingle, and whose sizes allow a link, are candidates: pair by pair where few
   share it, else as a crowd, all of them connected.
2. Sift. Every class has a sketch, the parities of its counts per group of hashes, up to two bits a shingle and 256 at least.
   Where the parities differ the sets do, so most pairs are told apart without their texts. What is left, and
   crowds, are joined to blocks by connected components, so a block holds all partners of its classes. Sets of
   large blocks are compared by their sketches, in cells of close sizes, and joined to blocks again.
3. Search. Within a block every set becomes a point: shingles are hashed to groups and the
   groups counted. An R-tree over the points skips pairs of nodes, then of points, whose summed
   coordinate minima cannot reach the overlap needed.
4. Verify. Every pair that remains is compared shingle by shingle, a leaf with a leaf at a time: the
   shingles of one leaf carry a bit for each of its sets, and those of the other look them up.

Links are added up to counts per class where they are found, and only as many pairs as connect
the classes are returned, so a group of n near copies gives some n rows, not n * n.
Large blocks and crowds are cut into cells, and every pair of cells becomes a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.llm import text as tx
from dimkeeper.llm.components import components
from dimkeeper.llm.frequency import frequency_tables, levels_passed, may_hold
from dimkeeper.llm.names import any_names
from dimkeeper.session import stage

SHINGLE = 5
#: The threshold as a fraction of integers: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Hashes below this share of all are counted over all documents.
COUNTED = 0.35
#: Bits of a hash that are sent to be counted, at least TABLE_BITS. Where two hashes share them, both seem
#: more frequent, which costs work, no link.
COUNTED_BITS = 40
#: Counted shingles are told apart by whether they occur more often than this.
LEVELS = (1, 6, 40)
#: Classes and shingles in one cell of a block.
CELL_SETS = 1024
CELL_SHINGLES = 1_500_000
#: Classes that share a dealt shingle are compared pair by pair up to this number, beyond it they are a crowd.
FEW = 32
#: Groups of a sketch at least, a power of two and 64 or more.
LEAST_GROUPS = 256
#: Classes, and bytes of their sketches, in one cell of a crowd.
SIFT_SETS = 4096
SIFT_BYTES = 4_000_000
#: A band of sizes; linked sets are in one band or in neighbouring ones. A little more than their sizes may differ.
BAND = 100 / PERCENT + 0.01
#: Sets compared by their sketches with all others at a time.
SIFT_ROWS = 64
#: Sets in a leaf of the tree, one for each bit of a mask.
LEAF = 32
#: Shingles looked up at a time.
CHUNK = 1 << 18

U64 = tx.U64
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all rows, ascending within each row, and each row's first."""
    low = tx.LOWER[data]
    starts, ends, row = tx.words(low, offsets, tx.SPACES)
    h = tx.span_hashes(low, starts, ends)
    n = len(h)
    n_rows = len(offsets) - 1
    count = np.bincount(row, minlength=n_rows)
    value = np.zeros(0, U64)
    owner = np.zeros(0, np.int64)
    if n >= SHINGLE:
        value = sum(h[k : n - SHINGLE + 1 + k] * _FACTORS[k] for k in range(SHINGLE))
        whole = row[: n - SHINGLE + 1] == row[SHINGLE - 1 :]
        value, owner = tx.mix(value[whole]), row[: n - SHINGLE + 1][whole]
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])
        sums = []
        for r in short.tolist():
            own = h[first[r] : first[r + 1]]
            sums.append((own * _FACTORS[: len(own)]).sum(dtype=U64) + U64(len(own)))
        value = np.concatenate([value, tx.mix(np.array(sums, U64) ^ U64(0x5851F42D4C957F2D))])
        owner = np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        first = np.ones(len(value), bool)
        first[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[first], owner[first]
    return value, np.searchsorted(owner, np.arange(n_rows + 1))


def class_ids(value: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One number per row that only equal sets share (64 bits; 0 for empty sets)."""
    total = np.concatenate([[U64(0)], np.cumsum(tx.mix(value ^ U64(0x2545F4914F6CDD1D)), dtype=U64)])
    sizes = np.diff(begins).astype(U64)
    ids = tx.mix(tx.mix(total[begins[1:]] - total[begins[:-1]]) + sizes * _FACTORS[0])
    return np.where(sizes > 0, ids, U64(0)).view(np.int64)


def sketches(value: np.ndarray, begins: np.ndarray, rows: np.ndarray) -> list[bytes]:
    """For some rows, a bit per group of hashes: whether the set has an odd number of hashes in it.

    The number of groups is a power of two, not less than the set's size. Halves of a longer sketch combine by
    exclusive or to the one of half the groups.
    """
    out = []
    for r in rows.tolist():
        own = value[begins[r] : begins[r + 1]]
        groups = max(LEAST_GROUPS, 1 << (len(own) - 1).bit_length())
        odd = np.bincount((own & U64(groups - 1)).astype(np.int64), minlength=groups) & 1
        out.append(np.packbits(odd.astype(np.uint8), bitorder="little").tobytes())
    return out


def _folded(words: np.ndarray, width: int) -> np.ndarray:
    """Sketches (a row each, of 64-bit words), as if made with fewer groups."""
    while words.shape[1] > width:
        half = words.shape[1] // 2
        words = words[:, :half] ^ words[:, half:]
    return words


def _words(some: list[bytes]) -> np.ndarray:
    """Sketches of one length, a row each."""
    return np.frombuffer(b"".join(some), "<u8").reshape(len(some), -1)


def may_link(differ: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Whether sets with so many hashes in ``both`` together can be linked, if at least ``differ`` are in one only."""
    return (100 + PERCENT) * differ.astype(np.int64) <= (100 - PERCENT) * both


def near_pairs(n: np.ndarray, sketch: list[bytes], sides: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs that connect all sets connected by pairs whose sizes and sketches allow a link.

    With ``sides`` (0 or 1 per set) only pairs between the sides are looked at.
    """
    n = np.asarray(n)
    order = np.argsort(n, kind="stable")
    width = np.array([len(sketch[i]) // 8 for i in order], np.int64)
    size, side = n[order], sides[order] if sides is not None else None
    group, found = np.arange(len(n)), []
    # Sizes ascend, and widths with them; sets of more than twice the width are out of reach.
    for w in np.unique(width).tolist():
        first, middle, last = np.searchsorted(width, [w, w + 1, 2 * w + 1])
        own = [_words([sketch[i] for i in order[a:b]]) for a, b in ((first, middle), (middle, last)) if b > a]
        words = np.ascontiguousarray(np.concatenate([_folded(x, w) for x in own]).T)
        for a in range(first, middle, SIFT_ROWS):
            b = min(a + SIFT_ROWS, middle)
            c = min(last, np.searchsorted(size, 100 * size[b - 1] // PERCENT, "right"))
            differ = np.zeros((b - a, c - a), np.uint32)
            for word in words:
                differ += np.bitwise_count(word[a - first : b - first, None] ^ word[None, a - first : c - first])
            near = may_link(differ, size[a:b, None] + size[None, a:c])
            near &= np.arange(a, b)[:, None] < np.arange(a, c)[None]
            near &= 100 * size[a:b, None] >= PERCENT * size[None, a:c]
            if side is not None:
                near &= side[a:b, None] != side[None, a:c]
            for x in np.flatnonzero(near.any(axis=1)).tolist():
                others = a + np.flatnonzero(near[x])
                groups, at = np.unique(group[others], return_index=True)
                for other, y in zip(groups.tolist(), others[at].tolist(), strict=True):
                    if other != group[a + x]:
                        group[group == other] = group[a + x]
                        found.append((int(order[a + x]), int(order[y])))
    return found


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n - (PERCENT * n + 99) // 100 + 1


def _first_met(classes: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which rows are the first of their class, over all calls with ``seen``."""
    once = np.zeros(len(classes), bool)
    for own, at in zip(*(x.tolist() for x in np.unique(classes, return_index=True)), strict=True):
        once[at] = own not in seen
        seen.add(own)
    return once


def _profiles(docs: DataFrame) -> DataFrame:
    """Per document its id, a hash of its text, its set's size and class; in each task a class's sketch once."""
    schema = tx.struct("doc_id long, text_hash long, n long, class long, sketch binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0}
        for part in tx.slices(batches):
            value, begins = shingle_sets(*tx.utf8(part.column("text")))
            classes = class_ids(value, begins)
            new = np.flatnonzero(_first_met(classes, seen))
            sketch = dict(zip(new.tolist(), sketches(value, begins, new), strict=True))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(np.diff(begins), pa.int64())]
                + [pa.array(classes), pa.array([sketch.get(r) for r in range(len(classes))], pa.binary())],
                schema.names,
            )

    return _keyed(docs).mapInArrow(run, schema)


def _counted(docs: DataFrame) -> DataFrame:
    """The counted hashes, ``df`` of each slice of texts; they go straight to where they are added up."""
    limit = U64(int(COUNTED * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            value, _ = shingle_sets(*tx.utf8(part.column("text")))
            hashes, df = np.unique(value[value < limit] & U64((1 << COUNTED_BITS) - 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(df, pa.int64())], ["hash", "df"])

    return docs.select("text").mapInArrow(run, tx.struct("hash long, df long"))


def turns(value: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """The order in which shingles are dealt out: unique ones first, frequent ones last."""
    above = levels_passed(value, tables)
    # Those not counted come before the most frequent.
    return np.where(value < U64(int(COUNTED * 2**64)), np.array([0, 1, 2, 4])[above], 3)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _candidates(docs: DataFrame, tables: list[np.ndarray]) -> DataFrame:
    """Pairs of classes that share a prefix shingle, and crowds: stars of classes of one shingle."""
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    schema = tx.struct("hash long, n long, class long")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a task deals out a class once, however many copies it meets
        for part in tx.slices(batches):
            value, begins = shingle_sets(*tx.utf8(part.column("text")))
            n, classes = np.diff(begins), class_ids(value, begins)
            once = _first_met(classes, seen)
            row = np.repeat(np.arange(len(n)), n)
            turn = turns(value, shared.value)
            order = np.lexsort((value, turn, row))
            value, turn = value[order], turn[order]
            place = np.arange(len(value)) - begins[:-1][row]
            taken = (place < prefix_length(n)[row]) & (turn > 0) & once[row]
            value, row = value[taken], row[taken]
            own = classes[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(n[row], pa.int64()), pa.array(own)], schema.names
            )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, head = np.zeros((3, 0), np.int64), None
        for batch in batches:
            new = np.array([batch.column(c).to_numpy(zero_copy_only=False) for c in schema.names])
            if new.shape[1]:
                out, last, head = _pairs(np.concatenate([last, new], axis=1), head, False)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["u", "v", "crowd"])
        if last.shape[1]:
            out, _, _ = _pairs(last, head, True)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["u", "v", "crowd"])

    rows = docs.mapInArrow(emit, schema)
    # Sorted by size within a shingle: where the next size is out of reach, so are all beyond.
    dealt = rows.repartition("hash").sortWithinPartitions("hash", "n", "class")
    return dealt.mapInArrow(pairs, tx.struct("u long, v long, crowd boolean")).distinct()


def _pairs(rows: np.ndarray, head: int | None, ended: bool) -> tuple[list[np.ndarray], np.ndarray, int | None]:
    """Candidates (u, v, crowd) among sorted rows of hash, size and class, and what to go on with: the rows
    of the last hash, to be put before the next rows, and if they are a crowd only the last of them and its head.

    A crowd's classes form stars: each is linked to its head, the first of the classes whose sizes are in reach
    one after the other. ``head`` is that of the first row if it is of a crowd.
    """
    first = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
    count = np.diff(np.concatenate([first, [rows.shape[1]]]))
    many = count > FEW
    many[0] |= head is not None
    follows = np.concatenate([[False], (rows[0, 1:] == rows[0, :-1]) & (100 * rows[1, :-1] >= PERCENT * rows[1, 1:])])
    heads = rows[2][np.maximum.accumulate(np.where(follows, 0, np.arange(len(follows))))]
    if head is not None:
        heads[: np.argmin(np.append(follows[1:], False)) + 1] = head
    rest, begins = rows[:, first[-1] :], int(first[-1])
    if many[-1]:
        rest, begins = rest[:, -1:], rows.shape[1]
    elif ended:
        begins = rows.shape[1]
    own = np.repeat(many, count)
    edges = [np.array([heads[own], rows[2][own], np.ones(own.sum(), np.int64)])]
    few = rows[:, :begins][:, ~own[:begins]]
    for k in range(1, FEW):
        a, b = few[:, :-k], few[:, k:]
        linked = (a[0] == b[0]) & (100 * a[1] >= PERCENT * b[1])
        if not linked.any():
            break
        edges.append(np.array([a[2][linked], b[2][linked], np.zeros(linked.sum(), np.int64)]))
    out = np.concatenate(edges, axis=1)
    out = np.concatenate([np.sort(out[:2], axis=0), out[2:]])[:, out[0] != out[1]]
    out = np.unique(out, axis=1)
    return [out[0], out[1], out[2].astype(bool)], rest, int(heads[-1]) if many[-1] else None


class Forest:
    """Which classes are already connected."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def roots(self, rows: np.ndarray) -> np.ndarray:
        return np.array([self.root(i) for i in rows.tolist()])


class CountTree:
    """An R-tree, bulk loaded: points sorted by size and counts, leaves of LEAF points.

    Every node keeps the greatest count per group and the least and greatest set size in it.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        largest = int(self.sizes.max())
        groups = 1 << min(10, max(5, int(largest).bit_length() - 2))
        shift = U64(64 - (groups.bit_length() - 1))
        # Sets are sorted by hash, so groups come from mixed bits, not from the leading ones.
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        group = (tx.mix(np.concatenate(sets)) >> shift).astype(np.int64)
        counts = np.zeros((len(sets), groups), np.int32)
        np.add.at(counts, (owner, group), 1)
        coarse = counts.reshape(len(sets), 16, -1).sum(axis=2)
        self.order = np.lexsort((*coarse.T[::-1], self.sizes))
        self.points = counts[self.order]
        self.sizes = self.sizes[self.order]
        self.leaves = [np.arange(i, min(i + LEAF, len(sets))) for i in range(0, len(sets), LEAF)]
        self.greatest = np.array([self.points[x].max(axis=0) for x in self.leaves])
        self.low = np.array([self.sizes[x[0]] for x in self.leaves])
        self.high = np.array([self.sizes[x[-1]] for x in self.leaves])

    def leaf_pairs(self, leaf: int) -> np.ndarray:
        """Leaves up to this one that may hold a partner for one of its points."""
        bound = np.minimum(self.greatest[: leaf + 1], self.greatest[leaf]).sum(axis=1)
        needed = -(-PERCENT * (self.low[: leaf + 1] + self.low[leaf]) // (100 + PERCENT))
        # Sizes ascend from leaf to leaf.
        reachable = 100 * self.high[: leaf + 1] >= PERCENT * self.low[leaf]
        return np.flatnonzero(reachable & (bound >= needed))

    def point_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs of points of two leaves whose bounds allow a link."""
        bound = np.minimum(self.points[a][:, None], self.points[b][None]).sum(axis=2)
        needed = -(-PERCENT * (self.sizes[a][:, None] + self.sizes[b][None]) // (100 + PERCENT))
        return bound >= needed


def leaf_masks(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of up to LEAF sets, ascending, and bits that tell whose they are."""
    value = np.concatenate(sets)
    bit = np.repeat(np.uint32(1) << np.arange(len(sets), dtype=np.uint32), [len(s) for s in sets])
    order = np.argsort(value, kind="stable")
    value, bit = value[order], bit[order]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    return value[first], np.bitwise_or.reduceat(bit, first)


def overlaps(value: np.ndarray, mask: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set shares with each set of a leaf: a row per set, LEAF columns."""
    out = np.zeros((len(sets), LEAF), np.int64)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    for at in range(0, len(flat), CHUNK):
        some, own = flat[at : at + CHUNK], owner[at : at + CHUNK]
        place = np.minimum(np.searchsorted(value, some), len(value) - 1)
        same = value[place] == some
        if not same.any():
            continue
        found, own = mask[place[same]], own[same]
        bits = np.unpackbits(found.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        out[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return out


def links(
    sets: list[np.ndarray], copies: np.ndarray, sides: np.ndarray | None = None
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between sets: pairs that connect all that are connected, and each set's number of links.

    A link counts as often as its other set has ``copies``. With ``sides`` (0 or 1 per set) only
    links between the sides are looked for.
    """
    total = np.zeros(len(sets), np.int64)
    if len(sets) < 2:
        return [], total
    tree, forest, found = CountTree(sets), Forest(len(sets)), []
    order = tree.order
    side = sides[order] if sides is not None else None
    ordered = [sets[i] for i in order]
    weight = np.asarray(copies)[order]
    count = np.zeros(len(sets), np.int64)
    for k, own in enumerate(tree.leaves):
        masks = None
        for j in tree.leaf_pairs(k).tolist():
            other = tree.leaves[j]
            open_ = np.ones((len(own), len(other)), bool)
            if j == k:
                open_ = own[:, None] > other[None]
            if side is not None:
                open_ &= side[own][:, None] != side[other][None]
            if not open_.any():
                continue
            open_ &= tree.point_pairs(own, other)
            some = np.flatnonzero(open_.any(axis=0))
            if not len(some):
                continue
            masks = masks or leaf_masks([ordered[i] for i in own])
            both = overlaps(*masks, [ordered[i] for i in other[some]]).T[: len(own)]
            union = tree.sizes[own][:, None] + tree.sizes[other[some]][None] - both
            linked = open_[:, some] & (100 * both >= PERCENT * union)
            count[own] += linked @ weight[other[some]]
            count[other[some]] += weight[own] @ linked
            for x, y in zip(*np.nonzero(linked), strict=True):
                a, b = int(own[x]), int(other[some[y]])
                ra, rb = forest.root(a), forest.root(b)
                if ra != rb:
                    forest.parent[max(ra, rb)] = min(ra, rb)
                    found.append((int(order[a]), int(order[b])))
    total[order] = count
    return found, total


def _tile_links(tiles: DataFrame) -> DataFrame:
    """Links found in each tile: pairs of classes (u, v), and each class's number of links (u, n).

    The texts are what is dealt out, since they compress to little more than half of their shingles' hashes.
    """

    def solve(rows: list[dict]) -> pa.RecordBatch:
        known = {r["class"]: r for r in rows}  # a class counts once
        rows = [known[c] for c in sorted(known)]
        sets = [r["shingles"] for r in rows]
        sides = None
        if rows[0]["i"] != rows[0]["j"]:
            sides = np.array([int(r["cell"] == r["j"]) for r in rows])
        pairs, n = links(sets, np.array([r["copies"] for r in rows]), sides)
        classes, linked = np.array([r["class"] for r in rows]), np.flatnonzero(n)
        u = [rows[a]["class"] for a, _ in pairs] + classes[linked].tolist()
        v = [rows[b]["class"] for _, b in pairs] + [None] * len(linked)
        n = [None] * len(pairs) + n[linked].tolist()
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v, n)], ["u", "v", "n"])

    def with_sets(part: pa.RecordBatch) -> list[dict]:
        value, begins = shingle_sets(*tx.utf8(part.column("text")))
        rows = part.drop_columns(["text"]).to_pylist()
        for at, row in enumerate(rows):
            row["shingles"] = value[begins[at] : begins[at + 1]].copy()
        return rows

    return _by_tile(tiles, ["block", "i", "j"], solve, tx.struct("u long, v long, n long"), "text", with_sets)


def _by_tile(
    tiles: DataFrame,
    key: list[str],
    solve: Callable[[list[dict]], pa.RecordBatch],
    schema: T.StructType,
    column: str,
    read: Callable[[pa.RecordBatch], list[dict]] = pa.RecordBatch.to_pylist,
) -> DataFrame:
    """``solve`` applied to the rows of each tile, ``read`` in slices by the size of a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, current = [], None
        for part in tx.slices(batches, column):
            for row in read(part):
                tile = [row[k] for k in key]
                if tile != current and rows:
                    yield solve(rows)
                    rows = []
                current = tile
                rows.append(row)
        if rows:
            yield solve(rows)

    dealt = tiles.repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, schema)


def _sifted(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (u, v) whose sketches allow a link; ``known`` has one of each class."""
    schema = tx.struct("u long, v long")
    one, two = (known.select(F.col("class").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "uv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v, nu, nv = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v", "nu", "nv"))
            su, sv = batch.column("su").to_pylist(), batch.column("sv").to_pylist()
            sizes = np.array([[len(x) // 8 for x in su], [len(x) // 8 for x in sv]]).reshape(2, -1)
            near = np.zeros(len(u), bool)
            for a, b in np.unique(sizes, axis=1).T.tolist():
                at = np.flatnonzero((sizes[0] == a) & (sizes[1] == b))
                left, right = (_folded(_words([s[i] for i in at]), min(a, b)) for s in (su, sv))
                near[at] = may_link(np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64), nu[at] + nv[at])
            yield pa.RecordBatch.from_arrays([pa.array(u[near]), pa.array(v[near])], schema.names)

    return pairs.select("u", "v").join(one, "u").join(two, "v").mapInArrow(run, schema)


def _crowd_pairs(members: DataFrame) -> DataFrame:
    """Pairs (u, v) that connect the classes of each block whose sizes and sketches allow links."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        sides = None
        if rows[0]["i"] != rows[0]["j"]:
            sides = np.array([int(r["cell"] == r["j"]) for r in rows])
        pairs = near_pairs(np.array([r["n"] for r in rows]), [r["sketch"] for r in rows], sides)
        u, v = ([rows[p[k]]["class"] for p in pairs] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (u, v)], ["u", "v"])

    # Sets that may be linked meet in the band of the smaller one.
    cells = F.greatest(F.ceil(F.col("sets") / SIFT_SETS), F.ceil(F.col("bytes") / SIFT_BYTES)).cast("int")
    band = F.floor(F.log("n") / math.log(BAND)).cast("int")
    members = members.withColumn("band", F.explode(F.array(band, band - 1)))
    large = members.groupBy("block", "band").agg(F.count(F.lit(1)).alias("sets"), F.sum(F.octet_length("sketch")).alias("bytes"))
    large = large.where(cells > 1).select("block", "band", cells.alias("cells"))
    members = members.join(F.broadcast(large), ["block", "band"], "left").withColumn("cells", F.coalesce("cells", F.lit(1)))
    members = members.withColumn("cell", F.pmod(F.xxhash64("class"), F.col("cells")).cast("int"))
    tiles = _tiles(members, ["block", "band"], "n", "sketch")
    return _by_tile(tiles, ["block", "band", "i", "j"], solve, tx.struct("u long, v long"), "sketch")


def _cells() -> Column:
    """How many cells a block of ``sets`` classes with ``shingles`` has."""
    return F.greatest(F.ceil(F.col("sets") / CELL_SETS), F.ceil(F.col("shingles") / CELL_SHINGLES)).cast("int")


def _weight(members: DataFrame) -> DataFrame:
    return members.groupBy("block").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))


def _split(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """Blocks (node, root) of several cells split into those that sketches leave connected.

    A large block is mostly a crowd, few of whose sets are close to any other. Its texts would move once for
    every cell, so their number would grow with the square of the block; sketches are far shorter.
    """
    members = known.join(blocks.select(F.col("node").alias("class"), F.col("root").alias("block")), "class")
    # At most one row for every CELL_SETS classes or CELL_SHINGLES shingles.
    large = stage(_weight(members).where(_cells() > 1).select("block"), "large")
    if large.isEmpty():
        return blocks
    pairs = _crowd_pairs(members.join(F.broadcast(large), "block"))
    rest = blocks.join(F.broadcast(large), F.col("root") == F.col("block"), "left_anti")
    return stage(rest.unionByName(components(pairs)), "split")


def _tiles(sets: DataFrame, block: list[str], *columns: str) -> DataFrame:
    """Each set of a block once for every cell of it, with the pair of cells (i, j) that are compared."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("cells") - 1),
        lambda c: F.struct(F.least(c, "cell").alias("i"), F.greatest(c, "cell").alias("j")),
    )
    return sets.withColumn("pair", F.explode(pairs)).select(*block, "pair.i", "pair.j", "cell", "class", *columns)


def grouped(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, text_hash, n_shingles, class, root (of linked classes), component_id, n_links.

    ``n_links`` counts all rows that a row is linked with, those with an equal set included.
    Words are runs of characters other than white space (blank and codes 9 to 13), A-Z in lower
    case. Texts with fewer than five words have their word sequence as only shingle. Null and
    empty texts and texts of white space have no shingle and are linked with nothing: class and
    root are 0 and component_id is their own id. Repeated rows are linked and all returned. A null doc_id
    takes part but is never the smallest id; only a group without any other id has none. Other
    columns are not read.
    """
    profiles = stage(_profiles(docs), "profiles")
    sketched, profiles = profiles.where("sketch IS NOT NULL").select("class", "n", "sketch"), profiles.drop("sketch")
    tables = frequency_tables(_counted(docs), LEVELS)

    texts = _keyed(docs)
    edges = stage(_candidates(texts, tables), "candidates")
    ends = edges.select(F.explode(F.array("u", "v")).alias("class")).distinct()
    known = sketched.join(ends, "class").groupBy("class").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    known = stage(known, "sketches")
    near = _sifted(edges.where("NOT crowd"), known).unionByName(edges.where("crowd").select("u", "v"))
    blocks = _split(stage(components(near), "blocks"), known)

    # One text per class that has candidates.
    rows = profiles.join(blocks.withColumnRenamed("node", "class"), "class")
    chosen = rows.groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "n")).alias("r"), F.min("root").alias("block"), F.count(F.lit(1)).alias("copies")
    )
    chosen = stage(chosen.select("class", "block", "copies", "r.doc_id", "r.text_hash", "r.n"), "chosen")
    chosen = chosen.join(_weight(chosen).select("block", _cells().alias("cells")), "block")
    chosen = chosen.withColumn("cell", F.pmod(F.xxhash64("class"), F.col("cells")).cast("int"))
    # A table of fixed size leaves out most other texts before anything is shuffled.
    wanted = chosen.select(F.col("text_hash").alias("hash"), F.lit(1).cast("long").alias("df"))
    some = texts.where(may_hold(frequency_tables(wanted, [0]), "text_hash", docs))
    same = (some.doc_id.eqNullSafe(chosen.doc_id)) & (some.text_hash == chosen.text_hash)
    sets = some.join(chosen, same).select("class", "block", "copies", "cells", "cell", "text")
    tiles = _tiles(sets, ["block"], "copies", "text")
    found = stage(_tile_links(tiles), "links")
    counts = found.where("v IS NULL").groupBy(F.col("u").alias("class")).agg(F.sum("n").alias("links"))
    # Whatever has a link is a node of the graph.
    linked = stage(components(found).withColumnRenamed("node", "class").join(counts, "class"), "linked")
    with_root = profiles.join(linked, "class", "left").withColumn("root", F.coalesce("root", "class"))
    with_root = stage(with_root, "roots")
    # Smallest ids and numbers of copies: per class, then per linked group, combined before they are
    # shuffled. Written, so that the join below can split a class with very many documents.
    full = with_root.where("n > 0")
    classes = full.groupBy("class").agg(
        F.min("root").alias("root"), F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")
    )
    classes = stage(classes, "classes")
    least = classes.groupBy("root").agg(F.min("first").alias("least"))
    classes = stage(classes.join(least, "root").select("class", "copies", "least"), "least")
    out = full.join(classes, "class").unionByName(
        with_root.where("n = 0").withColumns({"copies": F.lit(1).cast("long"), "least": F.col("doc_id")})
    )
    return out.select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"), "class", "root", F.col("least").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def groups(docs: DataFrame) -> DataFrame:
    """One row per document: its id, the size of its set, the smallest id reachable, its links."""
    return grouped(docs).select("doc_id", "n_shingles", "component_id", "n_links")


@any_names()
def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each linked group: the one with the smallest id.

    Documents without shingles all stay. Among rows with that id one with the least hash of its
    text is kept, and of fully equal id and text one row. Columns are those of ``docs``.
    """
    found = stage(grouped(docs), "groups")
    full = found.where("n_shingles > 0")
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")
    kept = full.groupBy("root").agg(F.min(first).alias("r")).select("r.doc_id", "r.text_hash")
    counted = full.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    same = lambda a, b: a.doc_id.eqNullSafe(b.doc_id) & (a.text_hash == b.text_hash)
    # What goes is usually less than what stays, so it is what the texts are joined with.
    dropped = counted.join(kept, same(counted, kept), "left_anti").select("doc_id", "text_hash")
    repeated = counted.where("rows > 1").join(kept, same(counted, kept), "left_semi").select("doc_id", "text_hash")
    marks = stage(
        dropped.withColumn("mark", F.lit(1)).unionByName(repeated.withColumn("mark", F.lit(2))), "marks"
    ).select(F.col("doc_id").alias("_mark_id"), F.col("text_hash").alias("_mark_hash"), F.col("mark").alias("_mark"))
    keyed = docs.withColumn("_text_hash", F.xxhash64("text"))
    # Texts whose hash is surely not marked stay where they are.
    wanted = marks.select(F.col("_mark_hash").alias("hash"), F.lit(1).cast("long").alias("df"))
    may = may_hold(frequency_tables(wanted, [0]), "_text_hash", docs)
    at = F.col("doc_id").cast("long").eqNullSafe(F.col("_mark_id")) & (F.col("_text_hash") == F.col("_mark_hash"))
    marked = keyed.where(may).join(marks, at, "left")
    once = marked.where("_mark = 2").dropDuplicates(["doc_id", "_text_hash"])
    out = keyed.where(~may).unionByName(marked.where("_mark IS NULL").select(*keyed.columns))
    out = out.unionByName(once.select(*keyed.columns))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
