"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every word enters as a learned vector of its own, if it was seen in enough training documents,
and the mean of learned vectors of its character triples. Two gated recurrent layers read a window of words forwards and backwards,
attention pools their states, and a linear layer gives the window's logit. All overlapping
windows of a text are scored, many at a time. The text's score is a logistic function of its
best and second-best window, fitted so that the number of windows is taken into account.

The network is trained in numpy on windows of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.gam import sigmoid
from dimkeeper.llm.labelled import fold, sample
from dimkeeper.llm.names import any_names

WINDOW, STRIDE = 32, 16
TRIPLE_BITS = 12
#: Training documents that must have a word for it to get a vector of its own.
KNOWN_IN = 4
WORD_DIM, CHAR_DIM, HIDDEN = 8, 8, 8
#: Labelled documents to train on by label, and windows of each, at most.
SAMPLE, SAMPLE_WINDOWS = {0: 2400, 1: 1200}, 4
EPOCHS, BATCH, RATE = 3, 128, 0.05
SLOT_BITS = 17
#: Words whose gates are copied at a time.
COPIED = 1 << 15
INPUT = WORD_DIM + CHAR_DIM


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def word_inputs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its hash; the buckets of its character triples, and how many those are.

    A word of n bytes has n triples, with blanks for the bytes before and beyond it.
    """
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    at = np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))
    word = np.repeat(np.arange(len(starts)), sizes)
    before = np.where(at > starts[word], data[np.maximum(at - 1, 0)], 32).astype(np.uint64)
    after = np.where(at + 1 < ends[word], data[np.minimum(at + 1, len(data) - 1)], 32).astype(np.uint64)
    triple = before << np.uint64(16) | data[at].astype(np.uint64) << np.uint64(8) | after
    triples = (tx.mix(triple) >> np.uint64(64 - TRIPLE_BITS)).astype(np.int64)
    return tx.span_hashes(data, starts, ends), triples, sizes


@dataclass
class Network:
    """Parameters; ``g`` holds the sums of squared gradients."""

    p: dict[str, np.ndarray]
    #: Hashes of the words with a vector of their own, ascending; theirs follow that of all others.
    known: np.ndarray
    g: dict[str, np.ndarray] = field(default_factory=dict)
    calibration: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0, 0.0, 0.0]))

    @staticmethod
    def fresh(known: np.ndarray, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) * 0.15).astype(np.float32)
        p = {"word": draw(len(known) + 1, WORD_DIM), "char": draw(1 << TRIPLE_BITS, CHAR_DIM)}
        for side in "fb":
            p |= {f"W{side}": draw(INPUT, 3 * HIDDEN), f"U{side}": draw(HIDDEN, 3 * HIDDEN)}
            p |= {f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        return Network(p, known, {k: np.full_like(v, 1e-9) for k, v in p.items()})

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The row of each word in the table of word vectors; 0 stands for unknown words."""
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, at + 1, 0)

    def inputs(self, numbers: np.ndarray, triples: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        ends = np.concatenate([np.zeros((1, CHAR_DIM)), np.cumsum(self.p["char"][triples], axis=0, dtype=np.float64)])
        last = np.cumsum(sizes)
        chars = (ends[last] - ends[last - sizes]) / np.maximum(sizes, 1)[:, None]
        return np.concatenate([self.p["word"][numbers], chars.astype(np.float32)], axis=1)

    def projections(self, x: np.ndarray) -> np.ndarray:
        """What every word adds to the gates of both directions."""
        p = self.p
        return np.concatenate([x @ p["Wf"] + p["cf"], x @ p["Wb"] + p["cb"]], axis=1)

    def run(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False, at: np.ndarray | None = None):
        """Window logits from gates (windows, WINDOW, 6 * HIDDEN) and which places have words.

        With ``at`` gates are those of words (words, 6 * HIDDEN), and ``at`` is the word at each place, so that
        no copy for all places is made.
        """
        n = len(mask)
        states = np.zeros((n, WINDOW, 2 * HIDDEN), np.float32)
        trace = {"f": [None] * WINDOW, "b": [None] * WINDOW}
        for k, side in enumerate("fb"):
            h = np.zeros((n, HIDDEN), np.float32)
            u = self.p[f"U{side}"]
            for t in range(WINDOW) if side == "f" else reversed(range(WINDOW)):
                x = (gates[:, t] if at is None else gates[at[:, t]])[:, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)]
                a = h @ u
                zr = logistic(x[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = 2 * logistic(2 * (x[:, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])) - 1
                m = mask[:, t, None]
                new = np.where(m, (1 - z) * c + z * h, h)
                if keep:
                    trace[side][t] = h, z, r, c, a[:, 2 * HIDDEN :], m
                h = new
                states[:, t, HIDDEN * k : HIDDEN * (k + 1)] = h
        e = np.where(mask, states @ self.p["attend"], -1e9)
        e = np.exp(e - e.max(axis=1, keepdims=True)) * mask
        w = e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", w, states)
        logit = pooled @ self.p["out"] + self.p["bias"]
        return (logit, states, w, pooled, trace) if keep else logit

    def learn(self, kinds: tuple[np.ndarray, np.ndarray, np.ndarray], words: np.ndarray, mask: np.ndarray, y: np.ndarray) -> float:
        """One step on a batch of windows; ``words`` index the word kinds. Returns the loss."""
        p = self.p
        used, at = np.unique(words, return_inverse=True)
        at = at.reshape(words.shape)
        numbers, triples, sizes = kinds
        own_sizes, own_numbers = sizes[used], numbers[used]
        ends = np.cumsum(own_sizes)
        shift = (np.cumsum(sizes) - sizes)[used] - (ends - own_sizes)
        own_triples = triples[np.repeat(shift, own_sizes) + np.arange(int(ends[-1]))]
        x = self.inputs(own_numbers, own_triples, own_sizes)
        logit, states, w, pooled, trace = self.run(self.projections(x)[at], mask, keep=True)
        prob = logistic(logit)
        n = len(y)
        d_logit = ((prob - y) / n).astype(np.float32)
        grad = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "char")}
        grad["out"], grad["bias"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * p["out"]
        d_w = np.einsum("nh,nth->nt", d_pooled, states)
        d_e = w * (d_w - (w * d_w).sum(axis=1, keepdims=True))
        d_states = w[:, :, None] * d_pooled[:, None] + d_e[:, :, None] * p["attend"]
        grad["attend"] = np.einsum("nt,nth->h", d_e, states)
        d_gates = np.zeros((n, WINDOW, 6 * HIDDEN), np.float32)
        for k, side in enumerate("fb"):
            u, d_h = p[f"U{side}"], np.zeros((n, HIDDEN), np.float32)
            for t in reversed(range(WINDOW)) if side == "f" else range(WINDOW):
                h, z, r, c, ac, m = trace[side][t]
                d_h = d_h + d_states[:, t, HIDDEN * k : HIDDEN * (k + 1)]
                d_new = np.where(m, d_h, 0)
                d_c = d_new * (1 - z) * (1 - c * c)
                d_z = d_new * (h - c) * z * (1 - z)
                d_r = d_c * ac * r * (1 - r)
                d_a = np.concatenate([d_z, d_r, d_c * r], axis=1)
                grad[f"U{side}"] += h.T @ d_a
                d_gates[:, t, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)] = np.concatenate([d_z, d_r, d_c], axis=1)
                d_h = np.where(m, d_new * z, d_h) + d_a @ u.T
        flat = np.zeros((len(used), 6 * HIDDEN), np.float32)
        np.add.at(flat, at.ravel(), d_gates.reshape(-1, 6 * HIDDEN))
        d_x = np.zeros((len(used), INPUT), np.float32)
        for k, side in enumerate("fb"):
            part = flat[:, 3 * HIDDEN * k : 3 * HIDDEN * (k + 1)]
            grad[f"W{side}"], grad[f"c{side}"] = x.T @ part, part.sum(axis=0)
            d_x += part @ p[f"W{side}"].T
        for name, value in grad.items():
            self.g[name] += value * value
            p[name] -= RATE * value / np.sqrt(self.g[name])
        self._rows("word", own_numbers, d_x[:, :WORD_DIM])
        chars = d_x[:, WORD_DIM:] / np.maximum(own_sizes, 1)[:, None]
        self._rows("char", own_triples, np.repeat(chars, own_sizes, axis=0))
        return float(-np.mean(y * np.log(prob + 1e-9) + (1 - y) * np.log(1 - prob + 1e-9)))

    def _rows(self, name: str, rows: np.ndarray, values: np.ndarray) -> None:
        """A step on some rows of a table; a row named more than once gets the sum."""
        some, at = np.unique(rows, return_inverse=True)
        total = np.zeros((len(some), values.shape[1]), np.float32)
        np.add.at(total, at, values)
        self.g[name][some] += total * total
        self.p[name][some] -= RATE * total / np.sqrt(self.g[name][some])


def window_places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and first word (within the row) of all windows; every row with words has one."""
    n = np.where(counts > 0, np.maximum(0, -(-(counts - WINDOW) // STRIDE)) + 1, 0)
    row = np.repeat(np.arange(len(counts)), n)
    return row, (np.arange(len(row)) - (np.cumsum(n) - n)[row]) * STRIDE


class Scorer:
    """Scores texts; gates of words met before are found by a 64-bit hash."""

    def __init__(self, network: Network):
        self.network = network
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.values = np.zeros((1 << SLOT_BITS, 6 * HIDDEN), np.float32)

    def gates(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = tx.span_hashes(low, starts, ends)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        value = self.values[slot]
        new = np.flatnonzero(self.keys[slot] != h)
        if len(new):
            hashes, first = np.unique(h[new], return_index=True)
            at = new[first]
            net = self.network
            found, triples, sizes = word_inputs(low, starts[at], ends[at])
            fresh = net.projections(net.inputs(net.numbers(found), triples, sizes))
            self.keys[slot[at]], self.values[slot[at]] = hashes, fresh
            for i in range(0, len(new), COPIED):
                some = new[i : i + COPIED]
                value[some] = fresh[np.searchsorted(hashes, h[some])]
        return value

    def summaries(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Per text: best and second-best window logit and the logarithm of the number of windows."""
        low = tx.LOWER[data]
        starts, ends, owner = tx.words(low, offsets, tx.SPACES)
        n = len(offsets) - 1
        counts = np.bincount(owner, minlength=n)
        out = np.zeros((n, 3))
        if not len(starts):
            return out
        gates = self.gates(low, starts, ends)
        row, place = window_places(counts)
        first = (np.cumsum(counts) - counts)[row] + place
        logits = np.zeros(len(row), np.float32)
        for i in range(0, len(row), 4096):
            at = first[i : i + 4096, None] + np.arange(WINDOW)
            mask = place[i : i + 4096, None] + np.arange(WINDOW) < counts[row[i : i + 4096], None]
            logits[i : i + 4096] = self.network.run(gates, mask, at=np.minimum(at, len(gates) - 1))
        order = np.lexsort((-logits, row))
        begins = np.searchsorted(row, np.arange(n))
        some = np.flatnonzero(counts > 0)
        best = logits[order]
        n_windows = np.bincount(row, minlength=n)
        out[some, 0] = best[begins[some]]
        second = np.minimum(begins[some] + 1, len(best) - 1)
        out[some, 1] = np.where(n_windows[some] > 1, best[second], best[begins[some]])
        out[some, 2] = np.log1p(n_windows[some])
        return out

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        c = self.network.calibration
        return sigmoid(c[0] + self.summaries(data, offsets) @ c[1:])


def calibrate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, slightly held back."""
    a = np.column_stack([np.ones(len(x)), x])
    c = np.zeros(a.shape[1])
    for _ in range(30):
        p = sigmoid(a @ c)
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(len(c))
        c += np.linalg.solve(h, a.T @ (y - p) - 0.1 * c)
    return c


def _slices(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Whole texts, about SLICE_BYTES at a time: the first one's place, their bytes in lower case, and their words.

    The driver's memory then holds the arrays of one slice, not of all texts.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // tx.SLICE_BYTES)) + 1
    for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
        low = tx.LOWER[np.frombuffer(b"".join(texts[i:j]), np.uint8)]
        yield i, low, *tx.words(low, np.concatenate([[0], np.cumsum(sizes[i:j])]), tx.SPACES)


def _counted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each text's number of words, and the hashes of the words that KNOWN_IN texts have, ascending."""
    counts = np.zeros(len(texts), np.int64)
    hashes, shown = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for begin, low, starts, ends, owner in _slices(texts):
        found = np.bincount(owner)
        counts[begin : begin + len(found)] = found
        h = tx.span_hashes(low, starts, ends)
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        new, times = np.unique(h[first], return_counts=True)
        hashes, kind = np.unique(np.concatenate([hashes, new]), return_inverse=True)
        shown = np.bincount(kind, np.concatenate([shown, times]), len(hashes)).astype(np.int64)
    return counts, hashes[shown >= KNOWN_IN]


def _words_at(texts: list[bytes], places: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The kinds of the words at some places, counted over all texts, and ``word_inputs`` of each kind by hash."""
    flat, begin = places.ravel(), 0
    words, known = np.zeros(len(flat), np.uint64), np.zeros(0, np.uint64)
    kept, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for _, low, starts, ends, _ in _slices(texts):
        here = np.flatnonzero((flat >= begin) & (flat < begin + len(starts)))
        which = flat[here] - begin
        begin += len(starts)
        words[here] = tx.span_hashes(low, starts[which], ends[which])
        new, first = np.unique(words[here], return_index=True)
        fresh = ~np.isin(new, known)
        known = np.concatenate([known, new[fresh]])
        which = which[first[fresh]]
        sizes.append(ends[which] - starts[which])
        before = np.cumsum(sizes[-1]) - sizes[-1]
        kept.append(low[np.repeat(starts[which] - before, sizes[-1]) + np.arange(int(sizes[-1].sum()))])
    sizes = np.concatenate(sizes)
    ends, order = np.cumsum(sizes), np.argsort(known)
    inputs = word_inputs(np.concatenate(kept), (ends - sizes)[order], ends[order])
    return np.searchsorted(inputs[0], words).reshape(places.shape), inputs


def fit(texts: list[bytes], labels: np.ndarray) -> Network:
    """Train on windows of labelled texts.

    Without labels, or if all are 0, all texts score near 0; if all are 1, near 1.
    """
    if len(set(labels.tolist())) < 2:
        net = Network.fresh(np.zeros(0, np.uint64))
        net.calibration = np.array([5.0 if labels.any() else -5.0, 0, 0, 0])
        return net
    counts, known = _counted(texts)
    net = Network.fresh(known)
    r = np.random.default_rng(11)
    row, place = window_places(counts)
    turn = r.permutation(len(row))
    turn = turn[np.argsort(row[turn], kind="stable")]
    within = np.arange(len(row)) - np.searchsorted(row[turn], row[turn])
    chosen = turn[within < SAMPLE_WINDOWS]
    at = (np.cumsum(counts) - counts)[row[chosen], None] + place[chosen, None] + np.arange(WINDOW)
    mask = place[chosen, None] + np.arange(WINDOW) < counts[row[chosen], None]
    words, (hashes, triples, sizes) = _words_at(texts, np.minimum(at, int(counts.sum()) - 1))
    kinds = net.numbers(hashes), triples, sizes
    y = labels[row[chosen]].astype(np.float32)
    for _ in range(EPOCHS):
        order = r.permutation(len(y))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            net.learn(kinds, words[part], mask[part], y[part])
    scorer = Scorer(net)
    summaries = [scorer.summaries(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]
    net.calibration = calibrate(np.concatenate(summaries), labels)
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, held_out: int = 0) -> Network:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    chosen = sample(labels, label, SAMPLE, fold(modulus) != held_out)
    # The ids of the sample are broadcast, two numbers each, and as many texts collected.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    found = found.toArrow()
    order = np.argsort(found["doc_id"].to_numpy())
    texts, labels = found["text"].cast(pa.binary()).to_pylist(), found["label"].to_numpy()[order].astype(float)
    del found  # the texts are there a second time in it
    return fit([texts[i] for i in order], labels)


def score(docs: DataFrame, network: Network, threshold: float = 0.5) -> DataFrame:
    """Add ``score`` and ``predicted``; columns of these names are replaced.

    Null texts count as empty; texts without words get the score of a text in which nothing
    was found. Every row is scored from its text alone.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = tx.T.StructType([*(docs.schema[c] for c in kept), *tx.struct("score double, predicted int")])
    shared = docs.sparkSession.sparkContext.broadcast(Network(network.p, network.known, {}, network.calibration))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part in tx.slices(batches):
            p = scorer.scores(*tx.utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                schema.names,
            )

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document whether it is held out, its score and the prediction at 0.5."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (fold(5) == 0).alias("held_out"), "score", "predicted")


@any_names()
def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted not to be toxic, with their own columns."""
    # No column is called score or predicted here, and every text goes to Python once.
    return score(docs, train(docs, labels)).where("predicted = 0").select(*docs.columns)
