"""A Merkle manifest of a dataset by nested-struct rollup.

Every row is a leaf. The leaves of a partition (a value of one column, such as the language) are
ranked, and the rank's digits in base 8 become columns: group by all but the last digit and eight
leaves become one struct that holds them and their hash; group that digit away as well and eight
such structs become one. After four digits a block of 4,096 leaves is one row. Blocks are the
leaves of the next tier, until one is left per partition, and the partitions' roots are rolled up
alike. On the way down, transform and explode unfold each block into its leaves together with
their proofs. Within a block that takes no join; a block learns the proof of its own root from the
tier above, one row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm.ranking import ranked
from dimkeeper.session import stage

FANOUT = 8
DIGITS = 4
BLOCK = FANOUT**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def field(value: Column) -> Column:
    """A value's unambiguous form: its length in bytes and itself, or a dash for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    )


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def manifest(leaves: DataFrame) -> DataFrame:
    """Proofs of all leaves and what they fold to.

    ``leaves`` has columns part (compared as text, may be null), id, leaf (hex digest) and
    claim (the digest somebody claims for that leaf; equal to leaf where nothing was changed).
    Returned are id, leaf, claim, subroot, root, path and folded. Parts are ordered with null first,
    leaves by id (null first), then by digest. ``path`` has one struct (before, after) per level with
    a run, from the leaf up: the digests left and right of the own one. ``folded`` is the root
    computed from claim and path. A run of one is hashed as well, a lone leaf is its part's root as it
    is. Repeated rows are leaves of their own. Without leaves there are no rows.
    """
    # A null part gets a value, so that parts can be compared by plain equality.
    known, part = F.col("part").isNotNull(), F.coalesce(F.col("part").cast("string"), F.lit(""))
    leaves = leaves.select(known.alias("known"), part.alias("part"), "id", "leaf", "claim")
    nodes = ranked(stage(leaves, "leaves"), ["known", "part"], ["id", "leaf", "claim"])
    body = F.struct(F.col("leaf").alias("h"), "id", "claim")
    tiers = _tiers(nodes.select("known", "part", "n", "rank", body.alias("node")), ["known", "part"])

    subroots = tiers[-1].select(F.lit(0).alias("tree"), "known", "part", F.col("node.h").alias("subroot"))
    subroots = ranked(stage(subroots, "subroots"), ["tree"], ["known", "part"])
    body = F.struct(F.col("subroot").alias("h"), "known", "part")
    trunk = _tiers(subroots.select("tree", "n", "rank", body.alias("node")), ["tree"])

    top = trunk[-1].select("tree", "block", F.col("node.h").alias("root"), _no_path())
    parts = _unfold(trunk, ["tree"], top, ["root"])
    above = parts.select(
        "node.known", "node.part", F.lit(0).cast("long").alias("block"), "root", "path", F.col("node.h").alias("subroot")
    )
    rows = _unfold(tiers, ["known", "part"], above, ["root", "subroot"])
    step = lambda own, level: F.sha2(F.concat(level["before"], own, level["after"]), 256)
    return rows.select(
        "node.id",
        F.col("node.h").alias("leaf"),
        "node.claim",
        "subroot",
        "root",
        "path",
        F.aggregate("path", F.col("node.claim"), step).alias("folded"),
    )


def report(docs: DataFrame) -> DataFrame:
    """Per document its proof, and whether it still folds to the root after tampering.

    Where 3 divides the crc32 of the id, the text that is checked has A-Z in lower case.
    """
    lowered = F.translate(F.col("text"), UPPER, UPPER.lower())
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    values = [F.col(c) for c in FIELDS]
    changed = [lowered if c == "text" else F.col(c) for c in FIELDS]
    true_leaf = leaf(values)
    leaves = docs.select(
        F.col("lang").alias("part"),
        F.col("doc_id").alias("id"),
        true_leaf.alias("leaf"),
        F.when(tampered, leaf(changed)).otherwise(true_leaf).alias("claim"),
    )
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["before"], p["after"])), "")
    return manifest(leaves).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(proof, 256).alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


# Rolling up ----------------------------------------------------------------------------------


def _tiers(nodes: DataFrame, group: list[str]) -> list[DataFrame]:
    """Blocks of ``nodes`` (group, n, rank, node), blocks of those, and so on to one per group.

    There is one tier for every four digits of the largest group's size.
    """
    tiers = [stage(_rolled(nodes, group, 0), "blocks")]
    largest = tiers[0].agg(F.max("n")).first()[0] or 0
    while largest > BLOCK ** len(tiers):
        roots = tiers[-1].select(*group, "n", F.col("block").alias("rank"), F.struct("node.h").alias("node"))
        tiers.append(stage(_rolled(roots, group, DIGITS * len(tiers)), "blocks"))
    return tiers


def _rolled(nodes: DataFrame, group: list[str], level: int) -> DataFrame:
    """One row per block: its digits grouped away one after the other, the last one first."""
    digits = [f"d{i}" for i in reversed(range(DIGITS))]  # d3, d2, d1, d0
    digit = lambda i: F.shiftright("rank", 3 * i).bitwiseAND(F.lit(FANOUT - 1)).cast("byte").alias(f"d{i}")
    block = F.shiftright("rank", 3 * DIGITS).alias("block")
    rows = nodes.select(*group, "n", block, *[digit(i) for i in reversed(range(DIGITS))], "node")
    # All group-bys below have these columns among their keys, so this is their only shuffle.
    rows = rows.repartition(*group, "block")
    for i in range(DIGITS):
        kids = F.sort_array(F.collect_list(F.struct(F.col(f"d{i}").alias("d"), "node")))
        rows = rows.groupBy(*group, "n", "block", *digits[: DIGITS - 1 - i]).agg(kids.alias("kids"))
        run = F.sha2(F.array_join(F.transform("kids", lambda k: k["node"]["h"]), ""), 256)
        one = F.col("kids")[0]["node"]["h"]
        h = F.when(F.col("n") > FANOUT ** (level + i), run).otherwise(one)
        rows = rows.withColumn("node", F.struct(h.alias("h"), "kids")).drop("kids")
    return rows


def _no_path() -> Column:
    return F.lit([]).cast("array<struct<before:string,after:string>>").alias("path")


def _unfold(tiers: list[DataFrame], group: list[str], above: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of the lowest tier with their paths: group, n, rank, node, path, carried."""
    for t in reversed(range(len(tiers))):
        rows = tiers[t].join(above, [*group, "block"]).withColumnRenamed("block", "rank")
        for i in reversed(range(DIGITS)):
            rows = _opened(rows, group, carried, DIGITS * t + i)
        above = rows.select(*group, F.col("rank").alias("block"), "path", *carried)
    return rows


def _opened(rows: DataFrame, group: list[str], carried: list[str], level: int) -> DataFrame:
    """One row per child of each node, its siblings added at the front of the path."""
    digests = F.transform("node.kids", lambda k: k["node"]["h"])

    def child(kid: Column, at: Column) -> Column:
        before = F.array_join(F.slice(F.col("digests"), F.lit(1), at), "")
        after = F.array_join(F.slice(F.col("digests"), at + 2, F.lit(FANOUT)), "")
        return F.struct(kid["d"].alias("d"), kid["node"].alias("node"), before.alias("before"), after.alias("after"))

    kids = F.explode(F.transform("node.kids", child)).alias("kid")
    rows = rows.withColumn("digests", digests).select(*group, "n", "rank", "path", *carried, kids)
    siblings = F.array(F.struct("kid.before", "kid.after"))
    path = F.when(F.col("n") > FANOUT**level, F.concat(siblings, "path")).otherwise(F.col("path"))
    rank = (F.col("rank") * FANOUT + F.col("kid.d")).alias("rank")
    return rows.select(*group, "n", rank, path.alias("path"), *carried, F.col("kid.node").alias("node"))
