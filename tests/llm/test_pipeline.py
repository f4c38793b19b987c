"""The pipeline's stages on the smallest tables, each compared with what its operator decides."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from dimkeeper.llm import jaccard, toxicity, wumanber
from dimkeeper.llm.queries import ORACLES, QUERIES, read
from tests.compare import spark_rows
from tests.llm.fixtures import PASSAGE, documents

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = connection.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    got_names, got = spark_rows(QUERIES[name](spark, FOLDER))
    assert got_names == sorted(names)
    from collections import Counter

    assert got == Counter(tuple(r[i] for i in order) for r in want.fetchall())


def test_stages(spark):
    docs = read(spark, FOLDER, "documents")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    clean = corpus_pipeline.toxic(spark, docs, FOLDER)
    judged = toxicity.report(docs, read(spark, FOLDER, "labels"))
    assert ids(clean) == ids(judged.where("predicted = 0"))
    single = corpus_pipeline.near_copies(spark, clean, FOLDER)
    assert ids(single) == ids(jaccard.groups(clean).where("doc_id = component_id"))
    cut = corpus_pipeline.repeated_passages(spark, single, FOLDER)
    assert ids(cut) == ids(single)
    assert cut.where("n_chars <> char_length(text)").count() == single.where("n_chars <> char_length(text)").count()
    left = corpus_pipeline.contaminated(spark, cut, FOLDER)
    judged = wumanber.report(cut, read(spark, FOLDER, "benchmark"))
    assert ids(left) == ids(judged.where("NOT contaminated"))
    for step in (clean, single, cut, left):
        assert step.columns == docs.columns
        assert step.dtypes == docs.dtypes
    assert ids(corpus_pipeline.encoded(spark, left, FOLDER)) == ids(left)


def test_stages_bear_every_row(spark):
    docs = documents(spark)
    for _, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, FOLDER)
        assert out.columns == docs.columns
        assert 0 < out.count() <= docs.count()
    assert corpus_pipeline.encoded(spark, docs, FOLDER).count() == docs.count()


def test_the_shingle_join_deals_out_no_texts_that_only_share_a_passage(spark, monkeypatch):
    moved, real = [], jaccard._tile_links

    def counted(tiles):
        moved.append(tiles.count())
        return real(tiles)

    monkeypatch.setattr(jaccard, "_tile_links", counted)
    monkeypatch.setattr(jaccard, "CELL_SETS", 4)
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(40))
    texts = {i: f"{PASSAGE} {own(i)}" for i in range(60)} | {100: f"{PASSAGE} {own(7)} again"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    kept = corpus_pipeline.near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(60))
    assert moved[0] < 10  # 7 and 100, not 61 texts once for each of 16 cells
