"""Classifiers by held-out accuracy, top-k search and language-model scores by brute force."""

from __future__ import annotations

import math
import random
import re
import tracemalloc
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from dimkeeper.llm import backoff, gam, language, toxicity, vafile
from dimkeeper.llm import text as tx
from dimkeeper.llm.queries import vocabulary
from tests.llm.fixtures import documents, empty

FOLDER = "/root/testdata/sf0.01"
PIECES = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels")]


def held_out(report, truth, column):
    rows = report.where("held_out").join(truth, "doc_id").collect()
    return [(r[column], r) for r in rows]


def test_quality(spark, tables):
    docs, labels = tables
    rows = gam.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows)
    assert right >= 0.9 * len(rows)
    model = gam.train(docs, labels)
    out = gam.score(documents(spark), model)
    assert out.count() == documents(spark).count()
    assert out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert gam.report(empty(spark), labels).count() == 0
    assert {r["score"] for r in gam.report(documents(spark), labels.where("false")).collect()} == {0.5}


def test_toxicity(spark, tables):
    docs, labels = tables
    rows = toxicity.report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    assert right >= 0.8 * len(rows)
    kept = toxicity.clean(documents(spark), labels)
    assert kept.columns == documents(spark).columns
    assert toxicity.report(empty(spark), labels).count() == 0
    out = toxicity.report(documents(spark), labels.where("false")).collect()
    assert all(r["score"] < 0.01 for r in out)


def test_gradients_of_the_network():
    """Steps follow the slope: differences of the loss match the gradients the step used."""
    r = np.random.default_rng(0)
    data = np.frombuffer(b"some words that make up windows of a text", np.uint8)
    starts, ends, _ = tx.words(data, np.array([0, len(data)]), tx.SPACES)
    hashes, triples, sizes = toxicity.word_inputs(data, starts, ends)
    words = r.integers(0, len(starts), (6, toxicity.WINDOW))
    mask = np.arange(toxicity.WINDOW) < r.integers(1, toxicity.WINDOW, 6)[:, None]
    y = np.array([0, 1, 0, 1, 1, 0], np.float32)

    def network():
        net = toxicity.Network.fresh(np.sort(hashes[:4]))
        net.p = {k: v.astype(np.float64) * 3 for k, v in net.p.items()}
        net.g = {k: np.zeros_like(v) for k, v in net.p.items()}
        return net

    def loss(net):
        x = net.inputs(net.numbers(hashes), triples, sizes)
        p = toxicity.logistic(net.run(net.projections(x)[words], mask))
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    stepped = network()
    stepped.g = {k: np.full_like(v, 1e-30) for k, v in stepped.p.items()}
    stepped.learn((stepped.numbers(hashes), triples, sizes), words, mask, y)
    for name in ("Wf", "Ub", "cb", "attend", "out", "word", "char"):
        for at in [np.unravel_index(i, stepped.g[name].shape) for i in r.integers(0, stepped.g[name].size, 400)]:
            size = math.sqrt(max(stepped.g[name][at] - 1e-30, 0))
            if size < 1e-4:
                continue
            up, down = network(), network()
            up.p[name][at] += 1e-4
            down.p[name][at] -= 1e-4
            slope = (loss(up) - loss(down)) / 2e-4
            assert abs(abs(slope) - size) < 1e-3 * max(1, size) + 0.02 * size
            break


def test_every_window_is_scored():
    """Windows start every STRIDE words until one reaches the text's end."""
    counts = [0, 1, 32, 33, 48, 49, 56, 57, 1000]
    row, place = toxicity.window_places(np.array(counts))
    want = []
    for i, n in enumerate(counts):
        start = 0
        while n:
            want.append((i, start))
            if start + toxicity.WINDOW >= n:
                break
            start += toxicity.STRIDE
    assert list(zip(row.tolist(), place.tolist(), strict=True)) == want
    # Any phrase of half a window stands whole in one.
    assert toxicity.STRIDE <= toxicity.WINDOW // 2


def test_toxicity_holds_the_words_of_one_slice_at_a_time(monkeypatch):
    import tracemalloc

    r = np.random.default_rng(3)
    names = [f"word{i}" for i in range(5000)]
    texts = [" ".join(names[i] for i in r.integers(0, len(names), 3000)).encode() for _ in range(400)]
    texts[5:7] = [b"", b" \n"]
    labels = (np.arange(len(texts)) % 3 == 0).astype(float)
    monkeypatch.setattr(toxicity, "EPOCHS", 0)
    tracemalloc.start()
    toxicity.fit(texts, labels)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * sum(map(len, texts))
    # However the texts are cut, the network is the same.
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    nets = []
    for size in (1 << 12, 1 << 30):
        monkeypatch.setattr(toxicity.tx, "SLICE_BYTES", size)
        nets.append(toxicity.fit([t[:400] for t in texts[:60]], labels[:60]))
    one, two = nets
    assert (one.known == two.known).all() and len(one.known)
    assert all((one.p[k] == two.p[k]).all() for k in one.p) and (one.calibration == two.calibration).all()


def test_toxicity_copies_no_gates_for_all_places_of_windows():
    net = toxicity.Network.fresh(np.zeros(0, np.uint64))
    r = random.Random(3)
    texts = [" ".join(f"w{r.randrange(900)}" for _ in range(n)) for n in (0, 7, 31, 33, 5000, 180_000)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    tracemalloc.start()
    scorer = toxicity.Scorer(net)
    tracemalloc.reset_peak()
    base = tracemalloc.get_traced_memory()[0]
    got = scorer.summaries(data, offsets)
    most = tracemalloc.get_traced_memory()[1] - base
    tracemalloc.stop()
    low = tx.LOWER[data]
    starts, ends, owner = tx.words(low, offsets, tx.SPACES)
    gates = toxicity.Scorer(net).gates(low, starts, ends)
    assert most < 2 * gates.nbytes
    # The same bits as from gates copied for every place.
    counts = np.bincount(owner, minlength=len(texts))
    row, place = toxicity.window_places(counts)
    at = ((np.cumsum(counts) - counts)[row] + place)[:, None] + np.arange(toxicity.WINDOW)
    mask = place[:, None] + np.arange(toxicity.WINDOW) < counts[row, None]
    at = np.minimum(at, len(gates) - 1)
    want = np.concatenate([net.run(gates[at[i : i + 4096]], mask[i : i + 4096]) for i in range(0, len(row), 4096)])
    best = np.array([want[row == k].max(initial=0) if counts[k] else 0 for k in range(len(texts))])
    assert counts[0] == 0 and np.array_equal(got[:, 0], best)


def test_toxicity_sends_texts_to_python_once(spark, tables, monkeypatch):
    labels = tables[1]
    seen, score = [], toxicity.score
    monkeypatch.setattr(toxicity, "score", lambda docs, network: seen.append(docs.schema.json()) or score(docs, network))
    docs = documents(spark)
    kept = toxicity.clean(docs, labels)
    assert kept.dtypes == docs.dtypes
    assert [s.count('"text"') for s in seen] == [1]


def test_language(spark, tables):
    docs, _ = tables
    rows = language.report(docs, PIECES).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows)
    assert right >= 0.95 * len(rows)
    model = language.train(docs, PIECES)
    found = {r["doc_id"]: r["lang_pred"] for r in language.predict(documents(spark), model).collect()}
    assert found[1] == "en"
    assert found[4] == found[5] == found[6] == "und"
    assert language.report(empty(spark), PIECES).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(9, 1)).where("false").unionByName(docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "n_chars"))
    assert {r["lang_pred"] for r in language.report(unlabelled, PIECES).collect()} == {"und"}


def test_forward_sums_over_all_segmentations():
    number = language.numbered(["▁", "a", "b", "ab", "▁a", "ba"])
    p = np.random.default_rng(1).random((2, 7))
    words = ["▁abab", "▁", "▁bxa", "▁aab"]

    def brute(text, q):
        if not text:
            return 1.0
        total = 0.0
        for j in range(1, len(text) + 1):
            piece = number.get(text[:j], 6 if j == 1 else -1)
            if piece >= 0:
                total += q[piece] * brute(text[j:], q)
        return total

    lattice = language.Lattice(words, number, 6)
    assert np.allclose(lattice.whole(p), [[brute(w, q) for w in words] for q in p])
    # Expected counts are the slope of the logarithm, times the probability.
    use = lattice.expected(p[0], np.array([2.0, 1, 1, 3]))
    for k in range(7):
        up = p[0].copy()
        up[k] += 1e-6
        change = np.log(lattice.whole(up[None])[0]) - np.log(lattice.whole(p[:1])[0])
        assert abs((change * [2, 1, 1, 3]).sum() / 1e-6 * p[0][k] - use[k]) < 1e-3


def all_segmentations(model, word, k):
    """The logarithm of a word's sum in one language, in exact fractions."""
    text, unknown = language.marked(word), model.p.shape[1] - 1
    q = [Fraction(x) for x in model.p[k].tolist()]
    sums = [Fraction(1)]
    for end in range(1, len(text) + 1):
        total = Fraction(0)
        for start in range(end):
            piece = model.number.get(text[start:end], -1)
            if piece < 0 and start == end - 1:
                piece = unknown
            if piece >= 0:
                total += sums[start] * q[piece]
        sums.append(total)
    return math.log(sums[-1].numerator) - math.log(sums[-1].denominator)


def test_predictions_match_brute_force(spark):
    """Pieces of up to 16 characters, words beyond 40 characters, and priors from all rows."""
    pieces = ["▁", "a", "b", "c", "ab", "bc", "▁ab", "abc", "▁c", "é", "abcabcabcabcabca"]
    counts = [("x", "abcabcabcabcabcab", 5), ("x", "ab", 9), ("y", "cb", 7), ("y", "bcé", 2), ("z", "a" * 90, 1)]
    model = language.fit(counts, {"x": 50, "y": 3, "z": 900}, pieces)
    texts = {1: "ab CB abc", 2: "abcabcabcabcabcab", 3: "bcé bcé", 4: "abc" * 25 + " cb", 5: "a" * 150, 6: "q", 7: "ébc" * 31, 8: "12", 9: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    for i, text in texts.items():
        if i >= 8:
            assert found[i] == ("und", 0.0)
            continue
        logs = [math.log((n + 1) / (953 + 3)) for n in (50, 3, 900)]
        for k in range(3):
            logs[k] += sum(all_segmentations(model, w, k) for w in text.lower().split())
        share = np.exp(np.array(logs) - max(logs))
        share /= share.sum()
        assert found[i][0] == "xyz"[int(share.argmax())]
        assert abs(found[i][1] - share.max()) < 1e-4


def test_sample_takes_from_every_language(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 20)
    rows = spark.range(30_000).selectExpr("CASE WHEN id < 12 THEN 'few' ELSE 'many' END AS lang", "id AS doc_id")
    rows = rows.unionByName(rows.where("doc_id < 3")).unionByName(spark.range(300).selectExpr("concat('l', id) AS lang", "id AS doc_id"))
    documents = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    found = Counter(r["lang"] for r in language.sample(rows, documents).collect())
    assert found["few"] == 12 and found["many"] == 20 and len(found) == 302


def test_top_k_matches_brute_force(spark):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(r.standard_normal(8) / 2, 1)]) for i in range(400)]
    rows += [(400, None), (None, [0.1] * 8), (420, [float("nan")] * 8), (440, [1.0, 2.0]), (441, [3.0, 1.0])]
    rows += [(460, [None] * 8), (480, [1e30] * 8), (481, [-1e30] * 8), (500, []), (520, rows[20][1]), (521, rows[20][1])]
    rows += [(20, rows[20][1])]
    vectors = spark.createDataFrame(rows, "id BIGINT, vec ARRAY<DOUBLE>")
    found = vafile.top_k(vectors, vectors.where("id % 20 = 0"), 5)
    got = {(x["query_id"], x["rank"], x["vec_id"], x["score"]) for x in found.collect()}
    clean = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, a in {i: v for i, v in clean if i % 20 == 0}.items():
        scored = [(sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in clean if i != q and len(a) == len(b)]
        scored = [(min(max(s, -(2**63)), 2**63 - 1), i) for s, i in scored]
        want |= {(q, k + 1, i, s) for k, (s, i) in enumerate(sorted(scored, key=lambda x: (-x[0], x[1]))[:5])}
    assert got == want
    assert vafile.top_k(vectors.where("false"), vectors, 5).count() == 0


def brute_scores(texts, order=3):
    """Scores of lists of words; every text is compared with the others' n-grams."""
    grams = [Counter(tuple(w[k : k + n]) for n in range(1, order + 1) for k in range(len(w) - n + 1)) for w in texts]
    counts = sum(grams, Counter())
    total = sum(map(len, texts))
    for words, own in zip(texts, grams, strict=True):
        value = 0.0
        for k in range(len(words)):
            size = min(k + 1, order)
            for n in range(size, 0, -1):
                gram = tuple(words[k - n + 1 : k + 1])
                if n == 1:
                    value += math.log(counts[gram] / total) + (size - 1) * math.log(0.4)
                elif counts[gram] > own[gram]:
                    context = gram[:-1]
                    value += math.log((counts[gram] - own[gram]) / (counts[context] - own[context]))
                    value += (size - n) * math.log(0.4)
                    break
        yield value


def backoff_agrees(spark, docs):
    lower = lambda t: "".join(c.lower() if c.isascii() else c for c in t)
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", lower(r["text"] or ""))) for r in docs.collect()]
    scored = brute_scores([w for _, w in rows])
    want = Counter((i, len(w), round(s, 5)) for (i, w), s in zip(rows, scored, strict=True))
    got = Counter((r["doc_id"], r["n_words"], round(r["log_score"], 5)) for r in backoff.scores(docs).collect())
    assert got == want


def test_backoff_matches_brute_force(spark):
    # With the text of 30,000 words, a null, empty texts and repeated rows.
    backoff_agrees(spark, documents(spark))
    assert backoff.scores(empty(spark)).count() == 0
    alone = backoff.scores(documents(spark, {1: "a b c"}, extra=False).where("doc_id = 1 AND text = 'a b c'"))
    assert round(alone.first()["log_score"], 6) == round(3 * math.log(1 / 3) + 3 * math.log(0.4), 6)


def test_backoff_of_other_orders(spark):
    # One word needs no second step, four words need a third.
    r = random.Random(8)
    texts = [[f"w{r.randrange(6)}" for _ in range(r.randint(0, 40))] for _ in range(30)]
    docs = documents(spark, {i: " ".join(w) for i, w in enumerate(texts)}, extra=False).where("doc_id < 30 AND source = 's'")
    docs = docs.where("NOT (doc_id = 1 AND n_chars = 78)")
    for order in (1, 4):
        got = {x["doc_id"]: round(x["log_score"], 5) for x in backoff.scores(docs, order).collect()}
        assert got == {i: round(s, 5) for i, s in enumerate(brute_scores(texts, order))}


def test_backoff_sends_packed_lists(spark):
    # A row for each n-gram took 11 bytes of shuffle to be counted and 53 to be looked up.
    r = random.Random(9)
    texts = [[f"word{r.randrange(300)}" for _ in range(400)] for _ in range(80)]
    docs = documents(spark, {i: " ".join(w) for i, w in enumerate(texts)}, extra=False).where("source = 's' AND n_chars > 500")
    texts_of = docs.selectExpr("doc_id % 2 AS block", "doc_id", "text", "1L AS times")
    sent = backoff._sent(texts_of, None, range(1, 3), 4)
    more = backoff._sent(texts_of, backoff._counted(sent), range(3, 4), 4)
    found = {n: [set(), set()] for n in (1, 2, 3)}
    pairs = Counter(p for w in texts for p in set(zip(w, w[1:], strict=False)))
    for i, w in enumerate(texts):
        for n in (1, 2, 3):
            some = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
            # Three words only where both parts of two occur in other documents.
            found[n][i % 2] |= {g for g in some if n < 3 or min(pairs[g[:2]], pairs[g[1:]]) > 1}
    for rows, orders in ((sent, (1, 2)), (more, (3,))):
        rows = rows.collect()
        assert len(rows) <= len(orders) * 2 * 16
        for n in orders:
            of_n = [x for x in rows if x["n"] == n]
            assert sum(x["size"] for x in of_n) == sum(map(len, found[n]))
            if n > 1:
                assert sum(len(x["grams"]) + len(x["counts"]) for x in of_n) < 8 * sum(x["size"] for x in of_n)


def test_packed_numbers():
    r = np.random.default_rng(10)
    for values in ([0], [1, 2**64 - 1, 0], r.integers(0, 2**45, 1000), np.ones(1000)):
        values = np.array(values, np.uint64)
        for plain in (0, 5):
            assert (backoff.unpack(backoff.pack(values, plain), len(values), plain) == values).all()


def test_backoff_with_hot_words(spark):
    r = random.Random(6)
    words = ["the"] * 60 + [f"w{i}" for i in range(80)]
    texts = {i: " ".join(r.choice(words) for _ in range(r.randint(0, 60))) for i in range(80)}
    backoff_agrees(spark, documents(spark, texts, extra=False))
