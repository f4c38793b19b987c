"""The shingle join, sentence spans, windows of a benchmark: compared with brute force."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from pyspark.sql import functions as F

from dimkeeper.llm import jaccard, spans, wumanber
from dimkeeper.llm import text as tx
from dimkeeper.llm.components import components
from tests.llm.fixtures import PASSAGE, TEXTS, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    """Per row (size of its set, least id reachable, rows it is linked with), by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))
    near = lambda a, b: bool(a and b) and 100 * len(a & b) >= 75 * len(a | b)
    linked = [sum(near(a, b) for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    least = {}
    for k, (name, _) in enumerate(rows):
        if name is not None:
            least[root[k]] = min(name, least.get(root[k], name))
    return Counter(
        (name, len(sets[k]), least.get(root[k]) if sets[k] else name, linked[k]) for k, (name, _) in enumerate(rows)
    )


def variants(n, seed):
    """Families of texts around the threshold, with shared passages."""
    r = random.Random(seed)
    out = {}
    for i in range(n):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(3, 120))]
        for _ in range(r.randint(1, 4)):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 18))):
                words[r.randrange(len(words))] = f"x{r.randint(0, 10**6)}"
            if r.random() < 0.4:
                words[len(words) // 2 : len(words) // 2] = PASSAGE.split()
            out[len(out) * 3 % 1000 + i * 1000] = " ".join(words)
    return out


@pytest.mark.parametrize("cell", [1024, 4])
def test_groups_match_all_pairs(spark, monkeypatch, cell):
    monkeypatch.setattr(jaccard, "CELL_SETS", cell)
    docs = documents(spark, TEXTS | variants(40, 5))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = Counter(tuple(r) for r in jaccard.groups(docs).collect())
    assert found == brute_groups(rows)


def test_links_find_every_pair(monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 500)  # sets are compared in pieces
    r = np.random.default_rng(2)
    pool = r.integers(0, 2**63, 4000).astype(np.uint64)
    sets = []
    for _ in range(60):
        base = r.choice(pool, r.integers(1, 200), replace=False)
        for _ in range(3):
            keep = base[r.random(len(base)) < r.choice([0.8, 0.9, 0.97])]
            sets.append(np.unique(np.concatenate([keep, r.choice(pool, len(base) // 20)])) if len(keep) else base)
    sets += [r.choice(pool, n, replace=False) for n in (900, 1400)]
    sets = [np.unique(s) for s in sets]
    copies = r.integers(1, 5, len(sets))

    def near(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)

    for sides in (None, r.integers(0, 2, len(sets))):
        root, want = list(range(len(sets))), np.zeros(len(sets), np.int64)

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i in range(len(sets)):
            for j in range(i):
                if (sides is None or sides[i] != sides[j]) and near(i, j):
                    want[i] += copies[j]
                    want[j] += copies[i]
                    root[max(find(i), find(j))] = min(find(i), find(j))
        roots = {i: find(i) for i in range(len(sets))}
        pairs, found = jaccard.links(sets, copies, sides)
        assert found.tolist() == want.tolist()
        root = list(range(len(sets)))
        for i, j in pairs:
            assert near(i, j)
            root[max(find(i), find(j))] = min(find(i), find(j))
        assert {i: find(i) for i in range(len(sets))} == roots
        assert len(pairs) < len(sets)


def test_a_group_of_different_near_copies_counts_all_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_SETS", 40)
    words = [f"w{i}" for i in range(60)]
    texts = {i: " ".join([*words[:30], f"x{i}", *words[30:]]) for i in range(150)} | {150 + i: " ".join(words[::-1]) for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in jaccard.groups(docs).collect()}
    assert found == {i: (0, 149) if i < 150 else (150, 19) for i in texts}


def test_texts_are_dealt_out_and_shared_bits_lose_no_link(spark, monkeypatch):
    """What moves is a text, not eight bytes for each of its shingles; counts by fewer bits only cost work."""
    columns, real = [], jaccard._tile_links
    monkeypatch.setattr(jaccard, "_tile_links", lambda tiles: columns.extend(tiles.columns) or real(tiles))
    monkeypatch.setattr(jaccard, "COUNTED_BITS", 26)
    docs = documents(spark, variants(30, 8))
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in jaccard.groups(docs).collect()) == brute_groups(rows)
    assert "text" in columns and "shingles" not in columns


def test_texts_that_only_share_a_passage_are_not_dealt_out(spark, monkeypatch):
    """A block of sets that are not close moves as sketches; its texts would move once for every cell."""
    moved, real = [], jaccard._tile_links

    def counted(tiles):
        moved.append(tiles.count())
        return real(tiles)

    monkeypatch.setattr(jaccard, "_tile_links", counted)
    monkeypatch.setattr(jaccard, "CELL_SETS", 4)
    monkeypatch.setattr(jaccard, "SIFT_SETS", 8, raising=False)
    r = random.Random(1)
    texts = {i: " ".join([*PASSAGE.split(), *(f"w{r.randint(0, 10**6)}" for _ in range(15 + i // 4))]) for i in range(80)}
    texts |= {100 + i: texts[i] + " and more" for i in (3, 50, 51)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    assert Counter(tuple(x) for x in jaccard.groups(docs).collect()) == brute_groups(list(texts.items()))
    assert moved[0] < 30  # 6 texts in blocks of their own; 20 times all 83 as one block


@pytest.mark.parametrize("few", [2, 5])
def test_candidates_do_not_depend_on_batches(monkeypatch, few):
    monkeypatch.setattr(jaccard, "FEW", few)
    r = np.random.default_rng(few)
    rows = np.array(sorted(zip(r.integers(0, 60, 400).tolist(), r.integers(5, 40, 400).tolist(), r.integers(0, 90, 400).tolist(), strict=True))).T

    def found(step):
        last, head, pairs = np.zeros((3, 0), np.int64), None, set()
        for at in range(0, rows.shape[1], step):
            out, last, head = jaccard._pairs(np.concatenate([last, rows[:, at : at + step]], axis=1), head, False)
            pairs |= set(zip(*(x.tolist() for x in out), strict=True))
        out, _, _ = jaccard._pairs(last, head, True)
        return pairs | set(zip(*(x.tolist() for x in out), strict=True))

    assert found(1) == found(7) == found(400)
    want, pairs = defaultdict(set), defaultdict(set)
    for h, n, own in rows.T.tolist():
        want[h].add((n, own))
    for u, v, crowd in found(400):
        pairs[u].add(v), pairs[v].add(u)
    for sets in want.values():
        for n, own in sets:
            reached, ahead = {own}, {own}
            while ahead:
                ahead = set().union(*(pairs[x] for x in ahead)) - reached
                reached |= ahead
            assert {y for m, y in sets if min(n, m) * 100 >= 75 * max(n, m)} <= reached


def test_sketches_lose_no_link():
    r = np.random.default_rng(6)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    sets = []
    for size in r.choice([1, 2, 3, 5, 20, 60, 128, 220, 256, 257, 300, 400, 700], 90):
        base = r.choice(pool, size, replace=False)
        for _ in range(3):
            keep = base[r.random(size) < r.choice([0.85, 0.95, 1])]
            sets.append(np.unique(np.concatenate([keep if len(keep) else base, r.choice(pool, size // 12)])))
    n = np.array([len(s) for s in sets])
    begins = np.concatenate([[0], np.cumsum(n)])
    made = jaccard.sketches(np.concatenate(sets), begins, np.arange(len(sets)))
    for sides in (None, r.integers(0, 2, len(sets))):
        pairs = jaccard.near_pairs(n, made, sides)
        root = list(range(len(sets)))
        for i, j in pairs:
            a, b = root[i], root[j]
            assert a != b
            root = [a if x == b else x for x in root]
        split = len({root[i] for i in range(len(sets))})
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (n[i] + n[j] - both) and (sides is None or sides[i] != sides[j]):
                    assert root[i] == root[j]
        assert split > 60


def test_texts_without_a_mark_are_not_shuffled(spark, monkeypatch):
    asked, real = [], jaccard.may_hold
    monkeypatch.setattr(jaccard, "may_hold", lambda tables, column, df: asked.append(column) or real(tables, column, df))
    docs = spark.createDataFrame([(i, f"a text of its own {i}") for i in range(50)] + [(7, TEXTS[1])] * 3, "doc_id BIGINT, text STRING")
    names = Counter(r["doc_id"] for r in jaccard.keep_one(docs).collect())
    assert names == Counter([*range(50), 7])
    assert asked == ["text_hash", "_text_hash"]


def test_one_document_of_each_group_stays(spark):
    docs = documents(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    names = Counter(r["doc_id"] for r in kept.collect())
    # 2, 3, the null id and one of the rows of 1 go; 8 is 7 in capitals, 11 mostly the passage in 10.
    assert names == Counter([1, 4, 5, 6, 7, 9, 10, 12, 13])
    assert jaccard.groups(empty(spark)).count() == jaccard.keep_one(empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (None, 3)]
    edges += [(1000, 999), (999, 1000), (998, 1000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u BIGINT, v BIGINT")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {i: 998 for i in (998, 999, 1000)}
    assert found == want


def test_repeated_spans_go_and_first_ones_stay(spark):
    docs = documents(spark)
    out = spans.remove(docs)
    assert [c for c in out.columns if c not in ("n_sentences", "n_removed")] == [c for c in docs.columns if c != "n_removed"]
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[10] == TEXTS[10]
    assert texts[11].split() == "Elsewhere it is told otherwise Alpha beta gamma delta epsilon. with another end.".split() or (
        "Upsilon" not in texts[11] and "Zeta eta" not in texts[11] and "with another end." in texts[11]
    )
    for same in (1, 4, 5, 6, 7, 8, 12, 13):
        assert texts[same] == TEXTS[same]
    # 977 words over and over, without punctuation: they stay once, with the ends of the text.
    assert TEXTS[9].startswith(" ".join(texts[9].split()[:977]))
    assert 977 <= len(texts[9].split()) < 1100
    assert out.count() == docs.count()
    assert spans.report(empty(spark)).count() == 0


def word_hash(word):
    data = np.frombuffer(word.translate(LOWER).encode(), np.uint8)
    return tx.span_hashes(data, np.array([0]), np.array([len(data)]))


def brute_sentences(text):
    """Sentences with the white space behind them, by the rule as it is stated."""
    pieces = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", text)
    words = [p.rstrip(" \t\n\x0b\x0c\r") for p in pieces]
    begins = [k == 0 or words[k - 1][-1] in ".!?,;:。！？" or "\n" in pieces[k - 1] or words[k][0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZÉ" for k in range(len(words))]
    cuts = list(begins)
    for k in range(2, len(words)):
        if k + spans.LONG < len(words) and not any(begins[max(0, k - spans.LONG) : k + spans.LONG + 1]):
            cuts[k] = bool(spans.cut_here(word_hash(words[k - 2]), word_hash(words[k - 1]))[0])
    starts = [k for k, c in enumerate(cuts) if c] + [len(words)]
    return ["".join(pieces[i:j]) for i, j in zip(starts, starts[1:])]  # noqa: B905


def brute_removed(texts):
    """Texts, in order of their ids, without sentences covered by a later occurrence of a span."""
    seen, out = set(), {}
    for name, text in texts.items():
        sentences = brute_sentences(text)
        size = lambda i, j: len(" ".join(sentences[i:j]).split())  # noqa: B023,E731
        runs = set()
        for k in range(len(sentences)):
            ahead = [j for j in range(k + 2, len(sentences) + 1) if size(k, j) >= spans.MIN_WORDS]
            back = [i for i in range(k - 1, -1, -1) if size(i, k + 1) >= spans.MIN_WORDS]
            runs |= {(k, j) for j in ahead[:1]} | {(i, k + 1) for i in back[:1]}
        gone = set()
        for i, j in sorted(runs):
            words = tuple(" ".join(sentences[i:j]).translate(LOWER).split())
            if words in seen:
                gone |= set(range(i, j))
            seen.add(words)
        out[name] = "".join(s for k, s in enumerate(sentences) if k not in gone)
    return out


def test_spans_match_brute_force(spark):
    r = random.Random(9)
    ends = [".", "!", ",", "", "", "。", "\n"]
    parts = [" ".join(f"{r.choice('kkkkkkKÉ')}{r.randint(0, 400)}" for _ in range(r.randint(1, 30))) + r.choice(ends) for _ in range(40)]
    texts = {i: " ".join(r.choice(parts) for _ in range(r.randint(0, 30))) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: r["text"] for r in spans.remove(docs).collect()}
    assert found == brute_removed(texts)


def test_sentences_of_a_text_do_not_depend_on_others():
    r = random.Random(3)
    texts = [" ".join(f"w{r.randint(0, 99)}{r.choice(['', '', '', '', '', '', '', '', '.'])}" for _ in range(r.choice([0, 5, 9, 17, 40, 90]))) for _ in range(60)]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t) for t in texts])
    _, begins, row, starts = spans.sentences(np.frombuffer(data, np.uint8), offsets)
    for i, text in enumerate(texts):
        alone = spans.sentences(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[3]
        assert (starts[row == i] - offsets[i]).tolist() == alone.tolist()
        assert len(alone) == len(brute_sentences(text))


def test_repeated_passages_without_punctuation_go(spark):
    """Of 60 words, within other words without punctuation or between sentences, most go."""
    r = random.Random(2)
    some = lambda n: " ".join(f"{r.choice('abcdefgh')}{r.randint(0, 10**6)}" for _ in range(n))
    passages = [some(60) for _ in range(30)]
    texts = {}
    for i, p in enumerate(passages):
        texts[2 * i] = f"{some(30)} {p} {some(30)}"
        texts[2 * i + 1] = f"{some(40)} {p} {some(20)}" if i % 2 else f"A sentence. {p}. Another sentence."
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: r["text"] for r in spans.remove(docs).collect()}
    left = []
    for i, p in enumerate(passages):
        assert found[2 * i] == texts[2 * i]
        kept = set(found[2 * i + 1].replace(".", " ").split())
        assert set(texts[2 * i + 1].replace(".", " ").split()) - kept <= set(p.split())
        left.append(len(kept & set(p.split())))
    assert max(left) < 50 and sum(left) / len(left) < 25


def test_the_end_of_a_repeated_passage_goes_too(spark):
    a, b, c = "A1 b c d e f g h.", "I1 j k l m n o p.", "Q1 r s."
    # Each within words of its own: only the passage is repeated, and its last sentence has 3 words.
    texts = {i: f"X{i} x{i} y{i}. {a} {b} {c} Z{i} z{i}. " for i in range(3)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: r["text"] for r in spans.remove(docs).collect()}
    assert found == {0: texts[0]} | {i: f"X{i} x{i} y{i}. Z{i} z{i}. " for i in (1, 2)}


def brute_windows(texts, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    grams = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            grams[tuple(w[i : i + 13])].add(item)
    for text in texts:
        w, hit, found = words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(w) - size + 1):
                g = tuple(w[i : i + size])
                if g in grams:
                    hit |= set(range(i, i + size))
                    found |= grams[g]
        yield len(w), len(hit), sorted(str(x) for x in found if x is not None)


@pytest.mark.parametrize("size", [1 << 21, 60])
def test_windows_match_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(wumanber, "PASS_BYTES", size)
    r = random.Random(4)
    items = [(i, " ".join(r.choice("the of and an ab ba aa x1 é ñandú zz".split()) for _ in range(r.choice([1, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(99, None), (98, "--"), (3, items[3][1]), (None, PASSAGE), (97, PASSAGE), (96, "a")]
    texts = dict(TEXTS)
    for i in range(100, 160):
        body = [r.choice("the of and an ab ba aa x1 é ñandú zz".split()) for _ in range(r.randint(0, 40))]
        if r.random() < 0.6:
            body[3:3] = (r.choice(items)[1] or "").upper().split()
        texts[i] = r.choice([" ", "-", ", "]).join(body)
    docs = documents(spark, texts)
    bench = spark.createDataFrame(items, "item_id BIGINT, text STRING")
    out = wumanber.occurrences(docs, bench)
    rows = out.select("text", "n_words", "n_hit", "items").collect()
    assert len(rows) == docs.count()
    for row, want in zip(rows, brute_windows([x["text"] for x in rows], items), strict=True):
        assert (row["n_words"], row["n_hit"], row["items"]) == want
    kept = wumanber.clean(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not (h and 20 * h >= n) for n, h, _ in ((r["n_words"], r["n_hit"], 0) for r in rows))
    assert wumanber.report(docs, bench.where("false")).where("n_hit > 0").count() == 0
    assert wumanber.report(empty(spark), bench).count() == 0


def test_words_never_cross_rows():
    data = np.frombuffer(b"abcd ef", np.uint8)
    starts, ends, row = tx.words(data, np.array([0, 2, 2, 6, 7]), tx.SPACES)
    assert list(zip(starts, ends, row, strict=True)) == [(0, 2, 0), (2, 4, 2), (5, 6, 2), (6, 7, 3)]


def test_columns_named_like_inner_ones(spark):
    """What the operators call their own columns may be names of the table's."""
    names = ["_spans", "_mark", "_mark_id", "_mark_hash", "_text_hash", "_words", "_hit", "_items", "_row", "a.b", "x`y"]
    docs = documents(spark, extra=False)
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.concat(F.lit(f"{i}-"), F.col("doc_id").cast("string")))
    bench = spark.createDataFrame([(1, PASSAGE)], "item_id BIGINT, text STRING")
    plain = docs.select("doc_id", "text")
    for operator in (spans.remove, jaccard.keep_one, lambda d: wumanber.clean(d, bench), lambda d: wumanber.occurrences(d, bench)):
        out, want = operator(docs), operator(plain)
        assert out.columns[: len(docs.columns)] == docs.columns
        rows = out.collect()
        assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in want.collect())
        for r in rows:
            for i, name in enumerate(names):
                assert r[name] == (None if r["doc_id"] is None else f"{i}-{r['doc_id']}")
