"""Language identification by unigrams that are summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability per piece,
learned by expectation maximisation on words of a bounded sample. A forward pass over a word
sums the products of piece probabilities over every way to cut it into pieces. Pieces do not cross white
space, so a text's probability is the product over its words, and a worker keeps the sums of
words it has met. Words of any length are summed whole: sums of long ones are rescaled on the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.labelled import fold
from dimkeeper.session import stage

#: Documents to learn from per language, at most.
SAMPLE = 800
ITERATIONS = 3
#: In the sample longer words are learned from in parts; scored, they are summed with rescaling.
LONGEST = 40
#: Characters between two rescalings.
RESCALE = 8
#: Share of a language's probability left for characters and pieces it has not shown.
UNSEEN = 1e-3
SLOT_BITS = 20

#: Bytes that make words: ASCII letters and all bytes of other characters.
OTHERS = np.ones(256, bool)
OTHERS[65:91] = OTHERS[97:123] = OTHERS[128:] = False


def pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece vocabulary; control and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    numbers = range(model.get_piece_size())
    special = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i)
    return sorted({model.id_to_piece(i).lower() for i in numbers if not special(i)})


def numbered(vocabulary: list[str]) -> dict[str, int]:
    """The pieces' numbers; what only begins a piece has -1."""
    number = {p[:j]: -1 for p in vocabulary for j in range(1, len(p))}
    return number | {p: i for i, p in enumerate(vocabulary)}


class Lattice:
    """All pieces in some words: an edge per occurrence, from its first to beyond its last character.

    ``unknown`` is the number of a character that is no piece.
    """

    def __init__(self, words: list[str], number: dict[str, int], unknown: int):
        word, start, end, piece = [], [], [], []
        find = number.get
        for w, text in enumerate(words):
            n = len(text)
            for i in range(n):
                for j in range(i + 1, n + 1):
                    p = find(text[i:j], -2)
                    if p >= 0 or j == i + 1:
                        word.append(w)
                        start.append(i)
                        end.append(j)
                        piece.append(p if p >= 0 else unknown)
                    if p == -2:  # no piece begins like this
                        break
        self.n = len(words)
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.word, self.start, self.end, self.piece = (np.array(x, np.int64) for x in (word, start, end, piece))
        self.by_end, self.by_start = self._parts(self.end), self._parts(self.start)

    @staticmethod
    def _parts(key: np.ndarray) -> list[np.ndarray]:
        order = np.argsort(key, kind="stable")
        return np.split(order, np.flatnonzero(np.diff(key[order])) + 1) if len(key) else []

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sums over the segmentations of every word's beginnings; p: languages by pieces."""
        total = np.zeros((len(p), self.n, int(self.sizes.max(initial=0)) + 1))
        total[:, :, 0] = 1
        for edges in self.by_end:
            w, e = self.word[edges], int(self.end[edges[0]])
            value = total[:, w, self.start[edges]] * p[:, self.piece[edges]]
            for k in range(len(p)):
                total[k, :, e] += np.bincount(w, weights=value[k], minlength=self.n)
        return total

    def whole(self, p: np.ndarray) -> np.ndarray:
        """Each word's probability by language."""
        return self.forward(p)[:, np.arange(self.n), self.sizes]

    def expected(self, p: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, given their counts; p of one language."""
        ahead = self.forward(p[None])[0]
        back = np.zeros_like(ahead)
        back[np.arange(self.n), self.sizes] = 1
        for edges in reversed(self.by_start):
            w, s = self.word[edges], int(self.start[edges[0]])
            value = back[w, self.end[edges]] * p[self.piece[edges]]
            back[:, s] += np.bincount(w, weights=value, minlength=self.n)
        share = weights / np.maximum(back[:, 0], 1e-300)
        share = share[self.word]
        use = ahead[self.word, self.start] * p[self.piece] * back[self.word, self.end] * share
        return np.bincount(self.piece, weights=use, minlength=len(p))


def long_word(text: str, number: dict[str, int], unknown: int, longest: int, p: np.ndarray) -> np.ndarray:
    """The logarithm, by language, of the sum over all segmentations of a word of any length."""
    find = number.get
    # Sums of the last beginnings, by length modulo the ring's size; ``scale`` was taken out of all.
    ring = np.zeros((longest + 1, len(p)))
    ring[0] = 1
    scale = np.zeros(len(p))
    for end in range(1, len(text) + 1):
        one = find(text[end - 1], -2)
        total = ring[(end - 1) % len(ring)] * p[:, one if one >= 0 else unknown]
        for start in range(max(0, end - longest), end - 1):
            piece = find(text[start:end], -2)
            if piece >= 0:
                total = total + ring[start % len(ring)] * p[:, piece]
        ring[end % len(ring)] = total
        if end % RESCALE == 0:
            most = ring.max(axis=0)
            ring /= most
            scale += np.log(most)
    return scale + np.log(np.maximum(ring[len(text) % len(ring)], 1e-300))


def marked(word: str) -> str:
    """A lower-case word with a mark for its beginning."""
    return "▁" + word.lower()


def units(word: str) -> list[str]:
    """A marked word in parts of bounded length."""
    text = marked(word)
    return [text[i : i + LONGEST] for i in range(0, len(text), LONGEST)]


@dataclass
class Model:
    names: list[str]
    number: dict[str, int]
    longest: int
    p: np.ndarray
    prior: np.ndarray

    def log_words(self, words: list[str]) -> np.ndarray:
        """Words by languages: the logarithm of the sum over all segmentations."""
        texts = [marked(w) for w in words]
        unknown = self.p.shape[1] - 1
        out = np.zeros((len(words), len(self.names)))
        short = [i for i, t in enumerate(texts) if len(t) <= LONGEST]
        for at in range(0, len(short), 20000):
            some = short[at : at + 20000]
            lattice = Lattice([texts[i] for i in some], self.number, unknown)
            out[some] = np.log(np.maximum(lattice.whole(self.p), 1e-300)).T
        for i, text in enumerate(texts):
            if len(text) > LONGEST:
                out[i] = long_word(text, self.number, unknown, self.longest, self.p)
        return out


def fit(counts: list[tuple[str, str, int]], documents: dict[str, int], vocabulary: list[str]) -> Model:
    """Learn piece probabilities from (language, word, count), priors from documents per language."""
    number = numbered(vocabulary)
    longest = max(map(len, vocabulary), default=1)
    unknown = len(vocabulary)
    names = sorted(documents)
    own: dict[str, list[tuple[str, int]]] = {name: [] for name in names}
    for lang, w, n in counts:
        own[lang] += [(u, n) for u in units(w)]
    p = np.zeros((len(names), unknown + 1))
    for k, name in enumerate(names):
        # A start that favours no segmentation: all pieces alike.
        now = np.full(unknown + 1, 1 / (unknown + 1))
        parts = [own[name][i : i + 20000] for i in range(0, len(own[name]), 20000)]
        lattices = [Lattice([u for u, _ in x], number, unknown) for x in parts]
        weights = [np.array([n for _, n in x], float) for x in parts]
        for _ in range(ITERATIONS):
            use = sum((x.expected(now, w) for x, w in zip(lattices, weights, strict=True)), np.zeros(len(now)))
            now = (1 - UNSEEN) * use / max(use.sum(), 1e-9) + UNSEEN / len(now)
        p[k] = now
    total = sum(documents.values())
    prior = np.log([(documents[x] + 1) / (total + len(names)) for x in names]) if names else np.zeros(0)
    return Model(names, number, longest, p, prior)


def sample(rows: DataFrame, documents: dict[str, int]) -> DataFrame:
    """``lang`` and ``doc_id`` of up to SAMPLE documents of each language, chosen by a hash of the id.

    A share of each language passes by its hash before the documents are ranked, so the ranking
    sees some times SAMPLE rows of a language however many it has.
    """
    spark = rows.sparkSession
    share = [(lang, min(1 << 30, (4 * SAMPLE << 30) // n + 1)) for lang, n in documents.items()]
    limits = spark.createDataFrame(share, "lang STRING, most BIGINT")
    mark = F.xxhash64("doc_id")
    some = rows.join(F.broadcast(limits), "lang").where(F.pmod(mark, F.lit(1 << 30)) < F.col("most"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(mark, F.lit(1 << 30)), "doc_id"))
    return some.select("lang", "doc_id").distinct().withColumn("rank", rank).where(F.col("rank") <= SAMPLE).drop("rank")


def train(docs: DataFrame, vocabulary_path: str, modulus: int = 4, held_out: int = 2) -> Model:
    """Learn every language of the rows outside the held-out fold from at most SAMPLE of its documents.

    Priors follow the counts of all these rows. Of rows with equal id and language the least text is
    learned from. Languages are counted on the driver, and a model holds 256 KB for each.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(modulus) != held_out))
    rows = usable.select("lang", F.col("doc_id").cast("long").alias("doc_id"))
    documents = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not documents:
        return fit([], {}, pieces(vocabulary_path))
    # At most SAMPLE rows per language, written so that every use sees the same.
    ids = stage(sample(rows, documents), "language-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                s, e, _ = tx.words(data, np.array([0, len(data)]), OTHERS)
                raw = data.tobytes()
                found = [raw[i:j].decode() for i, j in zip(s, e, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.string())], ["lang", "word"])

    # Documents of the sample, one row per id, and their words with counts.
    chosen = usable.select("lang", F.col("doc_id").cast("long").alias("doc_id"), "text")
    chosen = chosen.join(ids, ["lang", "doc_id"]).groupBy("lang", "doc_id").agg(F.min("text").alias("text"))
    words = chosen.select("lang", "text").mapInArrow(count, tx.struct("lang string, word string"))
    counts = words.groupBy("lang", "word").count().orderBy("lang", "word").toArrow()
    table = list(zip(*(counts[c].to_pylist() for c in ("lang", "word", "count")), strict=True))
    return fit(table, documents, pieces(vocabulary_path))


class Scorer:
    """Adds up words' logarithms per text; words met before are found by a 64-bit hash."""

    def __init__(self, model: Model):
        self.model = model
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.values = np.zeros((1 << SLOT_BITS, max(1, len(model.names))), np.float32)

    def texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts by languages: logarithms without the prior."""
        low = tx.LOWER[data]
        starts, ends, row = tx.words(low, offsets, OTHERS)
        h = tx.span_hashes(low, starts, ends)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        value = self.values[slot]
        new = np.flatnonzero(self.keys[slot] != h)
        if len(new):
            hashes, first = np.unique(h[new], return_index=True)
            at = new[first]
            raw = low.tobytes()
            words = [raw[i:j].decode() for i, j in zip(starts[at], ends[at], strict=True)]
            logs = self.model.log_words(words).astype(np.float32)
            self.keys[slot[at]], self.values[slot[at]] = hashes, logs
            value[new] = logs[np.searchsorted(hashes, h[new])]
        n = len(offsets) - 1
        return np.column_stack(
            [np.bincount(row, weights=value[:, k], minlength=n) for k in range(len(self.model.names))]
        )


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    seen = np.concatenate([[0], np.cumsum(ascii_letter[data])])
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out).tolist():
        out[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score``; columns of these names are replaced.

    The score is the language's probability among those learned. A text that is null or has no
    letter, or any text if no language was learned, is "und" with score 0. A word of any length
    is summed whole, in time that grows with its length.
    """
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = tx.T.StructType([*(docs.schema[c] for c in kept), *tx.struct("lang_pred string, score double")])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        names = np.array([*scorer.model.names, "und"], object)
        for part in tx.slices(batches):
            data, offsets = tx.utf8(part.column("text"))
            some = has_letter(data, offsets)
            best, p = np.full(part.num_rows, len(names) - 1), np.zeros(part.num_rows)
            if len(names) > 1:
                logs = scorer.texts(data, offsets) + scorer.model.prior
                logs -= logs.max(axis=1, keepdims=True)
                share = np.exp(logs)
                share /= share.sum(axis=1, keepdims=True)
                best = np.where(some, share.argmax(axis=1), best)
                p = np.where(some, share.max(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(names[best], pa.string()), pa.array(p)], schema.names
            )

    return docs.mapInArrow(run, schema)


def report(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per document whether it is held out, its language and the probability of it."""
    found = predict(docs.select("doc_id", "text"), train(docs, vocabulary_path))
    return found.select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
