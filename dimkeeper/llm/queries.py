"""One query per operator, on its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dimkeeper.llm import (
    backoff,
    bpe,
    exact,
    gam,
    huffman,
    jaccard,
    language,
    merkle,
    spans,
    toxicity,
    trie,
    vafile,
    wumanber,
)

QUERIES = {}
ORACLES = {}

#: The vocabulary all byte-level queries use.
BYTE_BPE = "byte_bpe_50k.json"


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function):
    QUERIES[function.__name__] = function
    return function


ORACLES["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op10_decontamination"] = r"""
WITH w AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
l AS (
  SELECT side, id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM w),
b AS (
  SELECT id, least(13, len(words)) AS size, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS pos
  FROM l WHERE side = 'b' AND len(words) > 0),
bw AS (SELECT DISTINCT id AS item, size, array_to_string(words[pos:pos + size - 1], ' ') AS gram FROM b),
d AS (SELECT id, words, unnest(range(1, len(words) + 1)) AS pos FROM l WHERE side = 'd'),
dw AS (
  SELECT id, pos, size, array_to_string(words[pos:pos + size - 1], ' ') AS gram
  FROM d, (SELECT DISTINCT size FROM bw) WHERE pos + size - 1 <= len(words)),
hit AS (SELECT dw.id, dw.pos, bw.item, bw.size FROM dw JOIN bw ON dw.gram = bw.gram AND dw.size = bw.size),
n AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(pos, pos + size)) AS p FROM hit) GROUP BY id),
i AS (
  SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT id, item::VARCHAR AS item FROM hit WHERE item IS NOT NULL) GROUP BY id)
SELECT l.id AS doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM l LEFT JOIN n USING (id) LEFT JOIN i USING (id) WHERE side = 'd'
"""

def crc_sql(column: str) -> str:
    """crc32 of a number's decimal digits: each byte is entered, then shifted out bit by bit (-1)."""
    digits = f"string_split({column}::VARCHAR, '')"
    steps = f"flatten(list_transform({digits}, lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN e >= 0 THEN xor(x, e) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    return f"xor(list_reduce(list_prepend(4294967295, {steps}), lambda x, e: {step}), 4294967295)"


# Conversations as lists of turns; every prefix of a list is a node of the trie.
ORACLES["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, said) AS place, said, words
  FROM (SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS words,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said
        FROM conversations WHERE conv_id IS NOT NULL)),
h AS (
  SELECT c, {crc_c} % 4 AS h
  FROM (SELECT DISTINCT c FROM t)),
r AS (
  SELECT h.c, 0 AS part, place, said, words FROM h JOIN t ON t.c = h.c - h.c % 20 AND place <= h.h
  UNION ALL
  SELECT h.c, 1, place, said, words FROM h JOIN t ON t.c = h.c AND place > h.h),
seq AS (
  SELECT h.c, list(said ORDER BY part, place) FILTER (said IS NOT NULL) AS said, list(words ORDER BY part, place) FILTER (said IS NOT NULL) AS words
  FROM h LEFT JOIN r ON r.c = h.c GROUP BY h.c),
p AS (
  SELECT c, d, coalesce(len(said), 0) = d AS stops, array_to_string(said[:d], '') AS node,
         array_to_string(said[:d - 1], '') AS up, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words
  FROM (SELECT *, unnest(range(coalesce(len(said), 0) + 1)) AS d FROM seq)),
n AS (
  SELECT node, d, any_value(up) AS up, min(c) AS c, count(*) AS members, any_value(words) AS words,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (stops), '')) AS ends
  FROM p GROUP BY node, d),
k AS (SELECT up AS node, d - 1 AS d, count(*) AS children FROM n WHERE d > 0 GROUP BY ALL),
m AS (SELECT n.*, coalesce(children, 0) AS children FROM n LEFT JOIN k ON k.node = n.node AND k.d = n.d),
s AS (
  SELECT a.node, a.d, count(*) FILTER (b.children = 0) AS leaves, sum((b.members - 1) * b.words) AS saved
  FROM m a JOIN m b ON b.d >= a.d AND starts_with(b.node, a.node) GROUP BY a.node, a.d)
SELECT m.c AS conv_id, m.d AS depth, u.c AS parent_conv_id, m.members AS n_convs, m.children AS n_children,
  leaves AS n_leaves, saved::BIGINT AS saved_tokens, m.ends AS ends_sha256
FROM m JOIN s ON s.node = m.node AND s.d = m.d LEFT JOIN m u ON u.node = m.up AND u.d = m.d - 1
""".replace("{crc_c}", crc_sql("c"))


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen({value}::VARCHAR) || ':' || {value} END"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Every level of every tree as a list of nodes, then each document's way up.
ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
    CASE WHEN {crc_sql("doc_id")} % 3 = 0
         THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
         ELSE {_leaf_sql("text")} END AS claim
  FROM documents),
l AS (
  SELECT *, 'p' || coalesce(':' || lang, '') AS tree, row_number() OVER () AS x, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r
  FROM d),
up AS (
  SELECT tree, lang, 0 AS k, r AS i, n, leaf AS h FROM l
  UNION ALL
  SELECT tree, lang, k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM up
  WHERE n > 1 GROUP BY tree, lang, k, i // 8, n),
subs AS (
  SELECT tree, k, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM up WHERE n = 1),
trunk AS (
  SELECT 0 AS k, r AS i, n, h FROM subs
  UNION ALL
  SELECT k + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM trunk WHERE n > 1 GROUP BY k, i // 8, n),
node AS (SELECT tree, k, i, h FROM up UNION ALL SELECT 'trunk', k, i, h FROM trunk),
step AS (
  SELECT x, s.k0 AS step, l.tree, s.k0 AS k, l.r // pow(8, s.k0)::BIGINT AS i
  FROM l JOIN subs USING (tree), (SELECT unnest(range(20)) AS k0) s WHERE s.k0 < subs.k
  UNION ALL
  SELECT x, subs.k + s.k0, 'trunk', s.k0, subs.r // pow(8, s.k0)::BIGINT
  FROM l JOIN subs USING (tree), (SELECT unnest(range(20)) AS k0) s WHERE s.k0 < (SELECT max(k) FROM trunk)),
way AS (
  SELECT x, step, node.i, node.i = step.i AS own, h FROM step JOIN node
  ON node.tree = step.tree AND node.k = step.k AND node.i // 8 = step.i // 8),
fold AS (
  SELECT x, 0 AS step, claim AS h FROM l
  UNION ALL
  SELECT x, fold.step + 1, sha256(string_agg(CASE WHEN own THEN fold.h ELSE way.h END, '' ORDER BY i))
  FROM fold JOIN way USING (x, step) GROUP BY x, fold.step),
proof AS (SELECT x, string_agg(h, '' ORDER BY step, i) AS h FROM way WHERE NOT own GROUP BY x)
SELECT doc_id, leaf, subs.h AS subroot, root.h AS root, sha256(coalesce(proof.h, '')) AS proof_sha256,
  f.h AS folded_root, f.h = root.h AS verified
FROM l JOIN subs USING (tree) JOIN (SELECT h FROM trunk WHERE n = 1) root ON true
JOIN (SELECT x, arg_max(h, step) AS h FROM fold GROUP BY x) f USING (x) LEFT JOIN proof USING (x)
"""

ORACLES["op13_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.report(read(spark, sf_dir, "conversations"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read(spark, sf_dir, "documents"))


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.report(read(spark, sf_dir, "documents"))


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.digests(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


@query
def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary(BYTE_BPE))


@query
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wumanber.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").selectExpr("vec_id AS id", "embedding AS vec")
    return vafile.top_k(vectors, vectors.where("id % 20 = 0"), 20)


@query
def op4_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read(spark, sf_dir, "documents"))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gam.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.report(read(spark, sf_dir, "documents"))


@query
def op7_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.scores(read(spark, sf_dir, "documents"))
