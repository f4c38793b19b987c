"""Exact dedup by skew-safe combining.

Equal texts are combined three times, and each time the whole texts are compared: within a task
before any row leaves it, then among a share of the tasks (digest groups salted by task), then
among the winners of those shares. So a text that a third of all documents have leaves each task
as one row, and no task ever sees more rows of it than there are tasks in a share, or shares.
Only a digest of each document travels to learn which row stays in its place.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm.ranking import join_unique
from dimkeeper.session import stage

#: Shares of the tasks whose winners are combined first.
SALTS = 256


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def winners(texts: DataFrame, salts: int = SALTS) -> DataFrame:
    """Each different text once: digest, text, keep_id (the largest id), size (its rows).

    ``texts`` has columns id, text, digest, without nulls in the last two.
    """
    salted = texts.withColumn("salt", F.spark_partition_id() % salts)
    # Grouping by the text itself compares it in full; the map side of the first group-by combines
    # what a task has, its other side what the tasks of a share have.
    shares = salted.groupBy("digest", "salt", "text").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("size")
    )
    return shares.groupBy("digest", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("size").alias("size"))


def grouped(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = SALTS,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Every row with what became of it: row (struct), keep_id, group_size, kept, text_sha256.

    ``row`` holds the columns of ``docs`` named in ``carry`` (default: the id alone), under their own
    names, so columns of any name are allowed. A null text counts as empty. ``keep_id`` is the largest id
    of equal texts; a null id is smaller than all others, so ``keep_id`` is null only if all are.
    ``group_size`` counts rows. ``kept`` is true where the id is ``keep_id``: rows that repeat
    both text and largest id are one document and share that mark. An empty table gives no rows.

    Two different texts of one digest are told apart by their texts, at the price of moving the texts
    of such digests once more; with SHA-256 there are none.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (carry or (id,))]).alias("row")
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(F.col(f"`{id}`").alias("id"), row, content.alias("text"))
    texts = texts.withColumn("digest", digest(F.col("text"))).withColumn("sha256", sha256(F.col("text")))

    found = stage(winners(texts.select("id", "text", "digest"), salts).select("digest", "keep_id", "size"), "winners")
    shared = found.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    members = texts.drop("text")
    if shared.isEmpty():
        result = join_unique(stage(members, "members"), found, "digest", "size")
    else:
        shared = stage(shared, "shared")
        alone = stage(members.join(shared, "digest", "left_anti"), "members")
        result = join_unique(alone, found.join(shared, "digest", "left_anti"), "digest", "size")
        several = texts.join(shared, "digest", "left_semi")
        both = several.join(winners(several.select("id", "text", "digest"), salts), ["digest", "text"])
        result = result.unionByName(both.drop("text"))
    return result.select(
        "row",
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; see :func:`grouped` for what stays."""
    return grouped(docs, id, text, carry=tuple(docs.columns)).where("kept").select("row.*")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    return grouped(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
