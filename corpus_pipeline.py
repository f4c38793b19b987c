"""A corpus, step by step: toxic texts go, one of each group of near copies stays, repeated
passages go, contaminated texts go, and what is left is encoded.

Every stage takes the documents that the stage before kept. ``run`` writes each stage's result to
the shared folder and reads it again, so a lost executor costs no more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimkeeper.llm import bpe, jaccard, spans, toxicity, wumanber
from dimkeeper.llm.queries import BYTE_BPE, read, vocabulary
from dimkeeper.session import stage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents predicted toxic by a network trained on the labels of those given."""
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group linked by shingles."""
    return jaccard.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove sentences that a repeated span covers; n_chars follows the text."""
    cut = spans.remove(docs)
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which at least a twentieth stands in windows of the benchmark."""
    return wumanber.clean(docs, read(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of them and of the text they decode to."""
    path = vocabulary(BYTE_BPE)
    both = bpe.decode(bpe.encode(docs.select("doc_id", "text"), path), path)
    return both.select(
        "doc_id",
        "ids",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", toxic),
    ("shingle join", near_copies),
    ("sentence spans", repeated_passages),
    ("decontamination", contaminated),
    ("encoding", encoded),
]

#: SQL cannot train the network; tests compare each stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
