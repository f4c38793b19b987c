"""A trie of conversation prefixes with a minimal perfect hash table per shard.

Every prefix of a conversation has a digest, and equal prefixes share a node. Conversations are
dealt out to shards in segments of bounded length. A shard enumerates the distinct digests of its
rows, gives each a slot by a minimal perfect hash that also keeps the digest (so a digest it does not know
is noticed), and scatters counts into flat numpy arrays over the slots. Subtree sums are
accumulated through the array of parent slots, deepest nodes first.

A node may lie in many shards. Every sum is therefore split so that shards add up: a node's own
value is entered only in the segment of its owner, the smallest conversation that has it, whose
path leads through all of its ancestors; what the owner's later segments hold enters at
the end of an earlier one. So neither a common first turn nor a conversation of any length
gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimkeeper.llm.ranking import join_unique, ranked
from dimkeeper.llm.text import mix, struct
from dimkeeper.session import stage

U64 = np.uint64
#: Turns of a segment, rows of a shard, and ids of one piece of a node's list.
SEGMENT = 1024
SHARD_ROWS = 100_000
ID_BITS = 12
#: Bits per key in each level of the hash table.
GAMMA = 2
#: A level places most of its keys, so distinct keys never need so many.
LEVELS = 200
WORD = r"[^\x20\x09-\x0D]+"
MASK = 0xFFFFFFFF


class NodeTable:
    """A minimal perfect hash of 128-bit keys: every key has its own slot in 0..n-1.

    Keys that meet no other key in a level of bits get their place there, the rest go to the next
    level with another seed; a slot is the number of set bits before the place.
    """

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        before, rest = 0, np.arange(len(high))
        while len(rest):
            if len(self.levels) == LEVELS:
                raise ValueError("the keys of a node table must be distinct")
            size = GAMMA * len(rest) + 1
            place = self._place(high[rest], low[rest], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((size, alone, before + np.cumsum(alone) - alone))
            before += int(alone.sum())
            rest = rest[~alone[place]]
        self.high, self.low = np.zeros(before, U64), np.zeros(before, U64)
        slot = self._slots(high, low)
        self.high[slot], self.low[slot] = high, low
        if (self.high[slot] != high).any() or (self.low[slot] != low).any():
            raise AssertionError("two keys have one slot")

    @staticmethod
    def _place(high: np.ndarray, low: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(high ^ mix(low + U64(level))) % U64(size)).astype(np.int64)

    def _slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        slot, rest = np.zeros(len(high), np.int64), np.arange(len(high))
        for level, (size, alone, first) in enumerate(self.levels):
            place = self._place(high[rest], low[rest], level, size)
            slot[rest[alone[place]]] = first[place[alone[place]]]
            rest = rest[~alone[place]]
        slot[rest] = -1
        return slot

    def slots(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that the table does not hold."""
        if not len(self.high):
            return np.full(len(high), -1)
        slot = self._slots(high, low)
        right = (slot >= 0) & (self.high[slot] == high) & (self.low[slot] == low)
        return np.where(right, slot, -1)


# Conversations -------------------------------------------------------------------------------


def turns(conversations: DataFrame) -> DataFrame:
    """Every turn with its place in its conversation: conv_id, place (from 1), said, words, n.

    ``said`` is a digest of role and text, nulls as empty texts. Turns are ordered by turn (null
    first), equal ones by digest. Rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        said.alias("said"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    placed = ranked(stage(rows, "turns"), ["conv_id"], ["turn", "said"])
    return placed.select("conv_id", (F.col("rank") + 1).alias("place"), "said", "words", "n")


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations with a shared beginning: conv_id, depth, said, words, length.

    Conversation c starts with the first h turns of c - c % 20, h = crc32(c) % 4, and goes on
    with its own turns after the first h. Depth 0 is a row without turn that each has.
    """
    head = F.crc32(F.col("conv_id").cast("string")) % 4
    base = F.col("conv_id") - F.col("conv_id") % 20
    turns = stage(turns, "places")
    # At most three turns per list, and at most 39 conversations per base.
    heads = (
        turns.where((F.col("place") <= 3) & (F.col("conv_id") == base))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "said", "words"))).alias("first"))
    )
    whole = turns.where("place = 1").select("conv_id", "n", head.alias("h"), base.alias("base"))
    none = F.array().cast(heads.schema["first"].dataType)
    whole = whole.join(heads, "base", "left").select(
        "conv_id",
        F.coalesce(F.slice("first", F.lit(1), F.col("h").cast("int")), none).alias("first"),
        F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own"),
        "h",
    )
    whole = stage(whole.withColumn("taken", F.size("first").cast("long")), "heads")
    length = F.col("taken") + F.col("own")
    begin = whole.select("conv_id", F.explode("first").alias("t"), length.alias("length"))
    begin = begin.select("conv_id", F.col("t.place").alias("depth"), "t.said", "t.words", "length")
    root = whole.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("said"),
        F.lit(0).cast("long").alias("words"),
        length.alias("length"),
    )
    own = turns.where(F.col("place") > head).join(whole.select("conv_id", "h", "taken", "own"), "conv_id")
    depth = (F.col("place") - F.col("h") + F.col("taken")).alias("depth")
    own = own.select("conv_id", depth, "said", "words", length.alias("length"))
    return root.unionByName(begin).unionByName(own)


def paths(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Every row with its node and the node above: conv_id, segment, depth, high, low, up_high, up_low, ..

    A digest is a sum over the turns so far of hashes of turn and depth, in four lanes modulo 2**32.
    Sums over a segment of a conversation start from those of the segments before.
    """
    rows = rows.withColumn("segment", F.expr(f"depth div {segment}"))

    def lanes(seed: int) -> list[Column]:
        h = F.when(F.col("said").isNotNull(), F.xxhash64(F.lit(seed), "depth", "said")).otherwise(F.lit(0))
        return [h.bitwiseAND(F.lit(MASK)), F.shiftrightunsigned(h, 32)]

    named = ["a", "b", "c", "d"]
    rows = rows.select("*", *[x.alias(c) for x, c in zip([*lanes(1), *lanes(2)], named, strict=True)])
    whole = rows.groupBy("conv_id", "segment").agg(*[F.sum(c).alias(c) for c in named])
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        "conv_id", "segment", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in named]
    )
    within = Window.partitionBy("conv_id", "segment").orderBy("depth")
    upto = within.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(whole, ["conv_id", "segment"]).withColumns(
        {f"{c}1": (F.sum(c).over(upto) + F.col(f"{c}0")) for c in named}
    )

    def packed(first: Column, second: Column) -> Column:
        return F.shiftleft(first.bitwiseAND(F.lit(MASK)), 32).bitwiseOR(second.bitwiseAND(F.lit(MASK)))

    now = [F.col(f"{c}1") for c in named]
    up = [F.col(f"{c}1") - F.col(c) for c in named]
    return rows.select(
        *("conv_id", "segment", "depth", "said", "words", "length"),
        packed(now[0], now[1]).alias("high"),
        packed(now[2], now[3]).alias("low"),
        packed(up[0], up[1]).alias("up_high"),
        packed(up[2], up[3]).alias("up_low"),
    )


# Shards --------------------------------------------------------------------------------------


def _columns(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
    """The numbers of a shard as flat arrays."""
    found: dict[str, list[np.ndarray]] = {}
    for batch in batches:
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            found.setdefault(name, []).append(column.to_numpy(zero_copy_only=False))
    return {name: np.concatenate(parts) for name, parts in found.items()}


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique(np.stack([high, low], 1), axis=0)
    return np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1])


def _keys(rows: dict[str, np.ndarray], prefix: str = "") -> tuple[np.ndarray, np.ndarray]:
    return rows[f"{prefix}high"].astype(np.int64).view(U64), rows[f"{prefix}low"].astype(np.int64).view(U64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard with their members in it and the smallest of these."""
    rows = _columns(batches)
    if not rows:
        return
    high, low = _keys(rows)
    table = NodeTable(*_distinct(high, low))
    slot = table.slots(high, low)
    size = len(table.high)
    convs = np.bincount(slot, minlength=size)
    first = np.full(size, np.iinfo(np.int64).max)
    np.minimum.at(first, slot, rows["conv_id"])
    out = {"high": table.high.view(np.int64), "low": table.low.view(np.int64), "n_convs": convs, "conv_id": first}
    for name in ("depth", "words", "up_high", "up_low"):
        flat = np.zeros(size, np.int64)
        flat[slot] = rows[name]
        if (flat[slot] != rows[name]).any():
            raise ValueError("two prefixes have one digest")
        out[name] = flat
    said = np.empty(size, object)
    said[slot] = rows["said"]
    if (said[slot] != rows["said"]).any():
        raise ValueError("two prefixes have one digest")
    out["said"] = said
    yield pa.RecordBatch.from_pydict({f.name: out[f.name] for f in COUNTED}, ARROW_COUNTED)


def _accumulate(batches: Iterator[pa.RecordBatch], segment: int) -> Iterator[pa.RecordBatch]:
    """Subtree sums of a shard's nodes over the values that belong to its segments.

    Rows with ``kind`` 0 are nodes of paths, rows with 1 hold values (leaves, saved) to add to a node.
    Nothing is passed on from one segment to another, even if the shard has both.
    """
    rows = _columns(batches)
    if not rows:
        return
    high, low = _keys(rows)
    node = rows["kind"] == 0
    table = NodeTable(*_distinct(high[node], low[node]))
    slot, size = table.slots(high, low), len(table.high)
    if (slot < 0).any():
        raise ValueError("a value belongs to a node that its shard does not have")
    depth = np.zeros(size, np.int64)
    depth[slot[node]] = rows["depth"][node]
    up = np.full(size, -1)
    up_high, up_low = _keys(rows, "up_")
    up[slot[node]] = table.slots(up_high[node], up_low[node])
    up[depth % segment == 0] = -1
    sums = []
    for name in ("leaves", "saved"):
        flat = np.zeros(size, np.int64)
        np.add.at(flat, slot[~node], rows[name][~node])
        sums.append(flat)
    order = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):  # all nodes of one depth, deepest first
        level = level[up[level] >= 0]
        for flat in sums:
            np.add.at(flat, up[level], flat[level])
    out = [table.high.view(np.int64), table.low.view(np.int64), *sums]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["high", "low", "leaves", "saved"])


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's list, whose pieces follow one another. One digest is open at a time."""
    at, digest = None, None
    for batch in batches:
        done: list[tuple[int, int, str]] = []
        for high, low, ids in zip(*(batch.column(c).to_pylist() for c in ("high", "low", "ids")), strict=True):
            if at != (high, low):
                if at is not None:
                    done.append((*at, digest.hexdigest()))
                at, digest = (high, low), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        yield _digests(done)
    if at is not None:
        yield _digests([(*at, digest.hexdigest())])


def _digests(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[], [], []]
    types = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["high", "low", "ends"])


COUNTED = struct("high long, low long, n_convs long, conv_id long, depth long, words long, up_high long, up_low long, said binary")
ARROW_COUNTED = pa.schema([(f.name, pa.binary() if f.name == "said" else pa.int64()) for f in COUNTED])
NODE = ["high", "low"]


# The trie ------------------------------------------------------------------------------------


def nodes(rows: DataFrame, segment: int = SEGMENT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie over ``rows`` (conv_id, depth, said, words, length), see :func:`report`.

    Each conversation has a row for every depth from 0 to its length. Without rows there is no node.
    """
    walked = stage(paths(rows, segment), "paths")
    shards = 1 + walked.count() // shard_rows
    dealt = walked.repartition(shards, "conv_id", "segment").select(
        "conv_id", "depth", "said", "words", "high", "low", "up_high", "up_low"
    )
    counted = dealt.mapInArrow(_count, COUNTED).groupBy(*NODE).agg(
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("depth").alias("depth"),
        F.min("words").alias("words"),
        F.min("up_high").alias("up_high"),
        F.min("up_low").alias("up_low"),
        # Equal sums of equal turns: a digest stands for one prefix if it has one last turn, one
        # depth and one node above, which holds for that node as well.
        (
            (F.min("depth") != F.max("depth"))
            | ~F.min("said").eqNullSafe(F.max("said"))
            | (F.min(F.struct("up_high", "up_low")) != F.max(F.struct("up_high", "up_low")))
        ).alias("clash"),
    )
    counted = stage(counted, "nodes")
    children = counted.where("depth > 0").groupBy(F.col("up_high").alias("high"), F.col("up_low").alias("low"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    known = stage(counted.join(children, NODE, "left").fillna(0, ["n_children"]), "nodes")
    if not known.where("clash").isEmpty():
        raise ValueError("two prefixes have one digest")

    # What each node adds to itself and all above, entered in its owner's segment.
    own = known.select(
        "conv_id",
        F.expr(f"depth div {segment}").alias("segment"),
        *NODE,
        (F.col("n_children") == 0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    whole = own.groupBy("conv_id", "segment").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, 0)
    later = whole.select(
        "conv_id", "segment", F.sum("leaves").over(after).alias("leaves"), F.sum("saved").over(after).alias("saved")
    )
    # The sum of a segment and all later ones enters at the last node of every segment before. A
    # conversation owns all of its nodes from some depth on, so segments without own nodes come first.
    ends = walked.where((F.col("depth") % segment == segment - 1) & (F.col("depth") < F.col("length")))
    ends = ends.select("conv_id", (F.col("segment") + 1).alias("next"), "segment", *NODE)
    first = later.groupBy("conv_id").agg(F.min("segment").alias("first"), F.max("leaves").alias("l"), F.max("saved").alias("s"))
    later = later.withColumnsRenamed({"segment": "next"})
    tails = ends.join(later, ["conv_id", "next"], "left").join(first, "conv_id").select(
        "conv_id",
        "segment",
        *NODE,
        F.coalesce("leaves", F.when(F.col("next") < F.col("first"), F.col("l"))).alias("leaves"),
        F.coalesce("saved", F.when(F.col("next") < F.col("first"), F.col("s"))).alias("saved"),
    )
    zero = F.lit(0).cast("long")
    path = walked.select("conv_id", "segment", *NODE, "up_high", "up_low", "depth", F.lit(0).alias("kind"), zero.alias("leaves"), zero.alias("saved"))
    value = own.unionByName(tails).select(
        "conv_id", "segment", *NODE, zero.alias("up_high"), zero.alias("up_low"), zero.alias("depth"), F.lit(1).alias("kind"), "leaves", "saved"
    )
    both = path.unionByName(value).repartition(shards, "conv_id", "segment").drop("conv_id", "segment")
    sums = both.mapInArrow(partial(_accumulate, segment=segment), struct("high long, low long, leaves long, saved long"))
    sums = sums.groupBy(*NODE).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    last = walked.where(F.col("depth") == F.col("length")).select(*NODE, "conv_id")
    pieces = last.groupBy(*NODE, F.shiftright("conv_id", ID_BITS).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")
    )
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece").select(*NODE, "ids")
    ended = pieces.mapInArrow(_digest_lists, struct("high long, low long, ends string"))

    found = stage(known.join(sums, NODE).join(ended, NODE, "left"), "trie")
    key = F.struct(*NODE).alias("node")
    above = found.where("n_children > 0").select(key, F.col("conv_id").alias("parent_conv_id"), "n_children")
    up = F.struct(F.col("up_high").alias("high"), F.col("up_low").alias("low")).alias("node")
    below = found.where("depth > 0").withColumnRenamed("n_children", "children").select("*", up)
    below = join_unique(below, above, "node", "n_children").drop("n_children", "node")
    below = below.withColumnRenamed("children", "n_children")
    top = found.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    ends = F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return below.unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node.

    conv_id is the node's smallest member and names it together with depth; parent_conv_id does the
    same for the node above (null for the root). n_convs counts members, n_children nodes
    below, n_leaves childless nodes of the subtree, saved_tokens sums (members - 1) times words of the
    last turn over the subtree, ends_sha256 digests the members that end here. Rows without
    conv_id are left out, null roles and texts are empty, turns of equal number are ordered by a digest,
    repeated rows are turns of their own. An empty table has no node. Other columns are not read.
    """
    return nodes(stage(rebuilt(turns(conversations)), "rebuilt"))
