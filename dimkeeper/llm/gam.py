"""Quality scores by a generalised additive model with pairwise interactions.

Each document is described by shares and ratios of its bytes, words and lines. Every feature is
cut into bins. Boosting goes round the features; each turn fits a tree of two splits to what is
still unexplained and adds it to that feature's lookup table. Then the strongest pairs of
features get tables of their own from trees of one split on either side. A score is a sum of
table entries, so a whole batch is scored by indexing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.labelled import fold, sample

#: Labelled rows used per label, at most.
SAMPLE = 6000
BINS, PAIR_BINS, PAIRS = 24, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 40, 30, 0.15

#: Kinds of bytes: other, lower-case, upper-case, digit, blank, line end, stop, exclamation,
#: sign, bar, and bytes of characters outside ASCII.
KINDS = np.zeros(256, np.uint8)
KINDS[97:123], KINDS[65:91], KINDS[48:58] = 1, 2, 3
KINDS[[32, 9]], KINDS[[10, 13]] = 4, 5
KINDS[[ord(c) for c in ".,;:'?-\"()"]] = 6
KINDS[ord("!")], KINDS[ord("|")] = 7, 9
KINDS[[ord(c) for c in "#$%&*+/<=>@\\^_`~{}[]"]] = 8
KINDS[128:] = 10
N_KINDS = 11


def _repeats(keys: np.ndarray, owner: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the number of different keys and the count of its most frequent one."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
    runs = np.diff(np.append(np.flatnonzero(first), len(k)))
    most = np.zeros(n_rows)
    np.maximum.at(most, o[first], runs)
    return np.bincount(o[first], minlength=n_rows), most


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers per text; an empty text has zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    kinds = np.bincount(row * N_KINDS + KINDS[data], minlength=n * N_KINDS).reshape(n, N_KINDS)
    starts, ends, owner = tx.words(data, offsets, tx.SPACES)
    h = tx.span_hashes(data, starts, ends)
    words = np.bincount(owner, minlength=n)
    distinct, most = _repeats(h, owner, n)
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    line_ends = np.zeros(256, bool)
    line_ends[10] = True
    l_start, l_end, l_owner = tx.words(data, offsets, line_ends)
    lines = np.bincount(l_owner, minlength=n)
    l_distinct, _ = _repeats(tx.span_hashes(data, l_start, l_end), l_owner, n)
    signed = np.isin(KINDS[data[np.maximum(ends - 1, 0)]], [7, 8, 9]) if len(ends) else np.zeros(0, bool)
    letters = kinds[:, 1] + kinds[:, 2]
    part = lambda a, b: a / np.maximum(b, 1)
    return np.column_stack(
        [
            np.log1p(size),
            *(part(kinds[:, k], size) for k in (0, 3, 4, 5, 6, 7, 8, 9, 10)),
            part(kinds[:, 2], letters),
            part(size - kinds[:, 4] - kinds[:, 5], words),
            part(distinct, words),
            part(most, words),
            part(np.bincount(owner, weights=same, minlength=n), words),
            part(np.bincount(owner, weights=signed, minlength=n), words),
            part(l_distinct, lines),
            part(words, lines),
        ]
    )


@dataclass
class Model:
    cuts: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    tables: np.ndarray
    pairs: list[tuple[int, int]]
    pair_tables: np.ndarray
    base: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for f, cut in enumerate(self.cuts):
            out += self.tables[f][np.searchsorted(cut, x[:, f], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            i = np.searchsorted(self.pair_cuts[a], x[:, a], "right")
            out += table[i, np.searchsorted(self.pair_cuts[b], x[:, b], "right")]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _step(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values per bin of a tree with up to two splits, from summed gradients and curvatures."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    gain = lambda a, b: a * a / (b + 1.0)
    i, j = np.triu_indices(len(g))  # bins up to i, then up to j, then the rest
    whole = gain(cg[i], ch[i]) + gain(cg[j] - cg[i], ch[j] - ch[i]) + gain(cg[-1] - cg[j], ch[-1] - ch[j])
    best = int(np.argmax(whole))
    i, j = int(i[best]), int(j[best])
    out = np.empty(len(g))
    for a, b in ((0, i + 1), (i + 1, j + 1), (j + 1, len(g))):
        out[a:b] = _step(g[a:b].sum(), h[a:b].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A table from one split on either axis, and how much it explains."""
    cg = np.zeros((g.shape[0] + 1, g.shape[1] + 1))
    ch = cg.copy()
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, out = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            boxes = [(0, i, 0, j), (0, i, j, -1), (i, -1, 0, j), (i, -1, j, -1)]
            sums = [
                [c[b, d] - c[a, d] - c[b, e] + c[a, e] for c in (cg, ch)] for a, b, e, d in boxes
            ]
            gain = sum(x * x / (y + 1.0) for x, y in sums)
            if gain > best:
                best = gain
                (p, q, r, s) = (_step(x, y) for x, y in sums)
                out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = p, q, r, s
    return out, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables on labelled rows (labels 0 and 1). Without rows, every score is 0.5."""
    quantiles = lambda n: [np.unique(np.quantile(c, np.linspace(0, 1, n + 1)[1:-1])) for c in x.T]
    n_features = x.shape[1]
    if not len(x):
        none = [np.zeros(0)] * n_features
        return Model(none, none, np.zeros((n_features, 1)), [], np.zeros((0, 1, 1)), 0.0)
    cuts, pair_cuts = quantiles(BINS), quantiles(PAIR_BINS)
    bins = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(cuts)]
    coarse = [np.searchsorted(c, x[:, f], "right") for f, c in enumerate(pair_cuts)]
    p0 = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(p0 / (1 - p0)))
    tables, score = np.zeros((n_features, BINS)), np.full(len(x), base)
    for _ in range(ROUNDS):
        for f in range(n_features):
            p = sigmoid(score)
            g = np.bincount(bins[f], weights=y - p, minlength=BINS)
            h = np.bincount(bins[f], weights=p * (1 - p), minlength=BINS)
            step = RATE * _tree(g, h)
            tables[f] += step
            score += step[bins[f]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = coarse[a] * PAIR_BINS + coarse[b]
        p = sigmoid(score)
        shape = (PAIR_BINS, PAIR_BINS)
        g = np.bincount(at, weights=y - p, minlength=PAIR_BINS**2).reshape(shape)
        return at, g, np.bincount(at, weights=p * (1 - p), minlength=PAIR_BINS**2).reshape(shape)

    gains = {(a, b): _quadrants(*grid(a, b)[1:])[1] for a in range(n_features) for b in range(a)}
    pairs = sorted(gains, key=gains.get, reverse=True)[:PAIRS]
    pair_tables = np.zeros((len(pairs), PAIR_BINS, PAIR_BINS))
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            at, g, h = grid(a, b)
            step = RATE * _quadrants(g, h)[0]
            pair_tables[k] += step
            score += step.ravel()[at]
    return Model(cuts, pair_cuts, tables, pairs, pair_tables, base)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4, held_out: int = 2) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fold."""
    chosen = sample(labels, label, {0: SAMPLE, 1: SAMPLE}, fold(modulus) != held_out)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            x = features(*tx.utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array([r.tobytes() for r in x], pa.binary())],
                ["doc_id", "label", "x"],
            )

    # At most 2 * SAMPLE ids of two numbers each are broadcast, and as many rows collected.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    described = rows.mapInArrow(describe, tx.struct("doc_id long, label int, x binary"))
    found = described.groupBy("doc_id").agg(F.min("x").alias("x"), F.min("label").alias("label")).toArrow()
    found = found.sort_by("doc_id")
    n = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
    x = np.frombuffer(b"".join(found["x"].to_pylist())).reshape(-1, n)
    y = found["label"].to_numpy().astype(float)
    return fit(x, y)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """Add ``score`` and ``predicted``; columns of these names are replaced.

    Null texts count as empty, and every row gets a score from its text alone.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    source = [*kept, *(["text"] if "text" not in kept else [])]
    schema = tx.T.StructType([*(docs.schema[c] for c in kept), *tx.struct("score double, predicted int")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            p = sigmoid(model.logits(features(*tx.utf8(part.column("text")))))
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                schema.names,
            )

    return docs.select(*[F.col(f"`{c}`") for c in source]).mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document whether it is held out, its score and the prediction at 0.7."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", "predicted")
