"""The conversation trie, the Merkle manifest and exact dedup, compared with plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimkeeper.llm import exact, merkle, ranking, trie
from dimkeeper.session import stage
from tests.llm.fixtures import documents, empty

U64 = np.uint64


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# Places and joins ----------------------------------------------------------------------------


def test_ranks_within_groups_that_span_tasks(spark):
    r = random.Random(4)
    data = [(r.choice("aaab"), r.choice([None, 1, 2, 3, r.randint(0, 999)]), i) for i in range(3000)]
    df = stage(spark.createDataFrame(data, "g string, o int, i int").repartition(5))
    by_group: dict[str, list] = {}
    for g, o, i in data:
        by_group.setdefault(g, []).append((o is not None, o or 0, i))
    want = {(g, x[2]): (k, len(xs)) for g, xs in by_group.items() for k, x in enumerate(sorted(xs))}
    found = ranking.ranked(df, ["g"], ["o", "i"]).collect()
    assert {(x["g"], x["i"]): (x["rank"], x["n"]) for x in found} == want
    assert ranking.ranked(stage(df.where("false")), ["g"], ["o", "i"]).count() == 0


@pytest.mark.parametrize("hot", [2, 1000])
def test_join_with_unique_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(ranking, "HOT_KEYS", hot)
    rows = stage(spark.range(900).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id"))
    table = stage(rows.groupBy("k").agg(F.count("*").alias("n")))
    found = ranking.join_unique(rows, table, "k", "n")
    assert sorted((x["id"], x["k"], x["n"]) for x in found.collect()) == [
        (i, -1 if i % 3 == 0 else i, 300 if i % 3 == 0 else 1) for i in range(900)
    ]


# Exact dedup ---------------------------------------------------------------------------------


def plain_groups(rows):
    groups: dict[str, list] = {}
    for doc, text in rows:
        groups.setdefault(text or "", []).append(doc)
    out = []
    for doc, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc, keep, len(ids), doc == keep, sha(text or "")))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact.sha256, lambda t: F.substring(exact.sha256(t), 1, 0), lambda t: F.length(t) % 3])
def test_exact_groups(spark, digest):
    """With any digest: a constant one and a bad one leave it to the texts to tell groups apart."""
    docs = documents(spark)
    docs = docs.unionByName(docs.select(*[(F.col(c) + 100).alias(c) if c == "doc_id" else c for c in docs.columns]))
    docs = docs.repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = exact.grouped(docs, digest=digest, salts=2)
    found = found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, found.collect()), key=repr) == plain_groups(rows)


def test_exact_report_and_rows_that_stay(spark):
    docs = documents(spark).selectExpr("*", "'y' AS `row`", "'z' AS digest", "1 AS `keep_id`", "2 AS size", "3 AS `a.b`")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = plain_groups(rows)
    assert sorted(map(tuple, exact.report(docs).collect()), key=repr) == want
    stay = exact.deduplicate(docs)
    assert stay.columns == docs.columns
    assert sorted(r["doc_id"] for r in stay.collect()) == sorted(x[0] for x in want if x[3])
    assert exact.report(empty(spark)).count() == 0
    assert exact.deduplicate(empty(spark)).columns == empty(spark).columns


def test_a_hot_text_leaves_each_task_once(spark):
    """The rows that the first shuffle moves: one per task and text, however many copies there are."""
    texts = spark.range(0, 20000, 1, 8).selectExpr("id", "'copy' AS text").withColumn("digest", exact.sha256(F.col("text")))
    plan = exact.winners(texts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "partial_max" in plan and "partial_count" in plan
    assert [(r["keep_id"], r["size"]) for r in exact.winners(texts).collect()] == [(19999, 20000)]


# Merkle manifest -----------------------------------------------------------------------------


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row):
    return sha("".join(plain_field(row[c]) for c in merkle.FIELDS))


def plain_levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return levels


def plain_way(levels, at):
    """Per level the digests left and right of the own one."""
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        yield run[: at % 8], run[at % 8 + 1 :]
        at //= 8


def plain_manifest(rows):
    parts: dict = {}
    for row in rows:
        parts.setdefault(row["lang"], []).append(row)
    langs = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        parts[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[lang] = plain_levels([plain_leaf(r) for r in parts[lang]])
    trunk = plain_levels([trees[x][-1][0] for x in langs])
    out = []
    for p, lang in enumerate(langs):
        for i, row in enumerate(parts[lang]):
            way = [*plain_way(trees[lang], i), *plain_way(trunk, p)]
            changed = row
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                changed = {**row, "text": re.sub("[A-Z]", lambda m: m[0].lower(), row["text"])}
            own = plain_leaf(changed)
            for before, after in way:
                own = sha("".join([*before, own, *after]))
            proof = sha("".join("".join([*b, *a]) for b, a in way))
            root = trunk[-1][0]
            out.append((row["doc_id"], plain_leaf(row), trees[lang][-1][0], root, proof, own, own == root))
    return sorted(out, key=repr)


def check_manifest(docs):
    rows = [r.asDict() for r in docs.select(*merkle.FIELDS).collect()]
    assert sorted(map(tuple, merkle.report(docs).collect()), key=repr) == plain_manifest(rows)


def test_manifest_of_odd_rows(spark):
    """A null part, a null id, repeated rows, long and empty texts, and columns named like inner ones."""
    docs = documents(spark).selectExpr("*", "1 AS part", "2 AS node", "3 AS path", "4 AS rank", "5 AS n", "6 AS known")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "ÿ").when(F.col("doc_id") % 3 == 1, "").otherwise(F.col("lang")))
    check_manifest(docs)
    check_manifest(docs.where("doc_id = 12"))  # a lone leaf: no run anywhere
    check_manifest(docs.where("doc_id < 9").withColumn("lang", F.col("doc_id").cast("string")))
    assert merkle.report(empty(spark)).count() == 0


@pytest.mark.parametrize("digits", [1, 2])
def test_manifest_over_several_tiers(spark, monkeypatch, digits):
    """Small blocks, so that 700 leaves take up to four tiers and 80 parts take up to three."""
    monkeypatch.setattr(merkle, "DIGITS", digits)
    monkeypatch.setattr(merkle, "BLOCK", merkle.FANOUT**digits)
    docs = spark.range(1000).selectExpr(
        "id AS doc_id", "concat('Text ', id) AS text", "'s' AS source", "id % 7 AS n_chars",
        "CASE WHEN id < 700 THEN 'big' ELSE concat('l', id % 79) END AS lang",
    )
    check_manifest(docs)


def test_rolling_up_takes_one_shuffle_and_no_join(spark):
    nodes = stage(spark.range(100).selectExpr("0 AS tree", "100L AS n", "id AS rank", "struct(string(id) AS h) AS node"))
    plan = merkle._rolled(nodes, ["tree"], 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


# Conversation trie ---------------------------------------------------------------------------


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(0, 3)), unique=True, max_size=500))
def test_node_table_is_minimal_perfect_and_verifies(keys):
    high = np.array([k[0] for k in keys], U64)
    low = np.array([k[1] for k in keys], U64)
    table = trie.NodeTable(high, low)
    assert sorted(table.slots(high, low)) == list(range(len(keys)))
    assert (table.slots(high, low + U64(4)) == -1).all()


def test_node_table_refuses_repeated_keys():
    with pytest.raises(ValueError, match="distinct"):
        trie.NodeTable(np.array([1, 1], U64), np.array([2, 2], U64))


def plain_trie(rows):
    """The contract's trie over (conv_id, turn, role, text), each node known by its whole prefix."""
    convs: dict[int, list] = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    said = lambda role, text: hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
    for turns in convs.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, said(*t[1:])))
    members: dict[tuple, list[int]] = {}
    ends: dict[tuple, list[int]] = {}
    for c in sorted(convs):
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        whole = tuple(t[1:] for t in [*convs.get(base, [])[:h], *convs[c][h:]])
        for d in range(len(whole) + 1):
            members.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    children: dict[tuple, int] = {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, ms in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(ms) - 1) * words
    return sorted(
        (
            (
                ms[0], len(p), members[p[:-1]][0] if p else None, len(ms), children.get(p, 0), leaves[p], saved[p],
                sha(",".join(map(str, ends.get(p, [])))),
            )
            for p, ms in members.items()
        ),
        key=repr,
    )


SCHEMA = "conv_id long, turn int, role string, text string"


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 AS depth", "2 AS place", "3 AS said", "4 AS words", "'x' AS high", "5 AS `rank`", "6 AS n")


def random_rows(seed, convs, longest):
    r = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(r.randint(1, longest)):
            rows.append((c, t, r.choice(["user", "assistant"]), " ".join(r.choices(["yes", "no thing"], k=r.randint(1, 2)))))
    return rows


def test_trie_of_random_conversations(spark):
    rows = random_rows(7, range(-25, 120), 6)
    assert sorted(map(tuple, trie.report(table(spark, rows)).collect()), key=repr) == plain_trie(rows)


def test_trie_of_odd_rows(spark):
    """Nulls everywhere, equal turns, repeated rows, a missing base, one that runs out, a turnless one."""
    rows = [(c, t, "u", f"t{t}") for c in (0, 1, 20, 45, 61) for t in (0, 1)]
    rows += [(0, None, "u", None), (0, 0, "u", "t0"), (1, 0, "a", "other"), (None, 0, "u", "lost"), (20, 7, None, "x y")]
    rows += [(45, 0, "", " \t\n"), (61, 0, "u", "word " * 30_000), (2**62, 0, "u", "far"), (2**62 + 1, 0, "u", "far")]
    rows += [(c, 0, "u", "only") for c in range(100, 120)]
    assert sorted(map(tuple, trie.report(table(spark, rows)).collect()), key=repr) == plain_trie(rows)
    assert trie.report(table(spark, rows).where("false")).count() == 0
    assert trie.report(table(spark, rows).where("conv_id IS NULL")).count() == 0


@pytest.mark.parametrize(("segment", "shard", "bits"), [(1, 40, 1), (3, 7, 2), (4, 10**6, 12)])
def test_trie_does_not_depend_on_segments_and_shards(spark, monkeypatch, segment, shard, bits):
    monkeypatch.setattr(trie, "ID_BITS", bits)
    rows = random_rows(8, range(40), 12) + [(3, t, "u", "yes") for t in range(20, 60)] + [(4, t, "u", "yes") for t in range(20, 60)]
    turns = trie.turns(table(spark, rows))
    found = trie.nodes(stage(trie.rebuilt(turns)), segment, shard)
    assert sorted(map(tuple, found.collect()), key=repr) == plain_trie(rows)


def test_a_common_conversation(spark):
    """A third of all conversations say the same; their ids stand in one node's list."""
    rows = [(3 * i, t, "u", f"t{t}") for i in range(700) for t in range(3)]
    rows += [(3 * i + 1, t, "u", f"t{i}-{t}") for i in range(300) for t in range(2)]
    assert sorted(map(tuple, trie.report(table(spark, rows)).collect()), key=repr) == plain_trie(rows)
