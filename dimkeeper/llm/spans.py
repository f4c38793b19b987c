"""Substring deduplication by sliding sentence spans.

A span is a run of consecutive sentences: for each sentence the shortest run of at least SENTENCES
sentences and MIN_WORDS words that starts with it, and the shortest one that ends with it. Together
they cover every longer run. Spans are hashed and compared over all documents. The first
occurrence of a span, by document id and then by position, stays; a sentence that any later
occurrence covers is removed.

A sentence ends with a word that ends in a stop, question or exclamation mark, at a line end, or
before a word with a capital: pasted text often starts in the middle of a sentence. Commas,
colons and semicolons end one too, so that one changed word in a long sentence does not hide the
rest of it. Marks of other scripts count alike. Where no such end lies within LONG words before and
after a word, the words themselves tell the ends: a sentence ends with a word if its hash and that
of the word before say so, for one pair of words in CUT. Copies of a passage without
punctuation are cut at the same words. Spans are compared by their words with A-Z in lower case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimkeeper.llm import text as tx
from dimkeeper.llm.frequency import frequency_tables, levels_passed
from dimkeeper.llm.names import any_names
from dimkeeper.session import stage

SENTENCES, MIN_WORDS = 2, 12
#: Words without an end around them before words are cut by hash, and one in how many pairs cuts.
LONG, CUT = 8, 4
U64 = tx.U64

_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?,;:"]] = True
#: Stops of other scripts, by their bytes: ideographic and full-width ones, Arabic, Devanagari, Greek.
_STOPS = ["。", "！", "？", "，", "、", "；", "：", "．", "؟", "،", "؛", "۔", "।", "॥", "·", "…"]


def _ends_with_stop(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each word ends in a stop of any script."""
    out = _STOP[data[ends - 1]]
    other = np.flatnonzero(data[ends - 1] >= 0x80)
    for stop in (np.frombuffer(c.encode(), np.uint8) for c in _STOPS):
        if not len(other):
            break
        size = len(stop)
        fits = other[ends[other] - starts[other] >= size]
        same = np.ones(len(fits), bool)
        for k in range(size):
            same &= data[ends[fits] - size + k] == stop[k]
        out[fits[same]] = True
    return out


def _far(first: np.ndarray) -> np.ndarray:
    """Whether no sentence begins, and no text ends, with a word, the LONG words before it or after it."""
    # Each text begins a sentence, so words see nothing of other texts; the last one ends here.
    sums = np.concatenate([[0], np.cumsum(first), [np.sum(first) + 1]])
    at = np.arange(len(first))
    return sums[np.minimum(at + LONG + 1, len(first) + 1)] == sums[np.maximum(at - LONG, 0)]


def cut_here(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether the hashes of two words in a row end a sentence where nothing else does."""
    return tx.mix(before * U64(0x9E3779B97F4A7C15) + last) % U64(CUT) == 0


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words; each sentence's first word (one entry more); its row; its first byte."""
    low = tx.LOWER[data]
    starts, ends, row = tx.words(low, offsets, tx.SPACES)
    h = tx.span_hashes(low, starts, ends)
    n = len(h)
    first = np.ones(n, bool)
    if n > 1:
        first[1:] = (row[1:] != row[:-1]) | _ends_with_stop(data, starts[:-1], ends[:-1])
        lines = np.concatenate([[0], np.cumsum(data == 10)])
        first[1:] |= lines[starts[1:]] > lines[ends[:-1]]
        lead, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
        first |= (lead >= 65) & (lead <= 90)
        # A to Þ outside ASCII, without the multiplication sign
        first |= (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        cut = np.zeros(n, bool)
        cut[2:] = _far(first)[2:] & cut_here(h[:-2], h[1:-1])
        first |= cut
    begins = np.flatnonzero(first)
    return h, np.append(begins, n), row[begins], starts[begins]


def spans(h: np.ndarray, begins: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every span its first sentence, the one beyond its last, and a hash of its words."""
    n = len(row)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    first = np.arange(n)
    beyond = np.searchsorted(begins, begins[:-1] + MIN_WORDS)
    beyond = np.maximum(beyond, first + SENTENCES)
    whole = beyond <= n
    # The same from the end: the last sentence that is early enough to begin with.
    other = np.searchsorted(begins, begins[1:] - MIN_WORDS, "right") - 1
    other = np.minimum(other, np.arange(n) + 1 - SENTENCES)
    early = other >= 0
    # Each run once, or it would seem to occur again.
    runs = np.concatenate([first[whole] * (n + 1) + beyond[whole], other[early] * (n + 1) + np.flatnonzero(early) + 1])
    first, beyond = np.divmod(np.unique(runs), n + 1)
    whole = row[first] == row[beyond - 1]
    first, beyond = first[whole], beyond[whole]
    return first, beyond, tx.sequence_hashes(h, begins[first], begins[beyond])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def _all_spans(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            found = spans(*sentences(*tx.utf8(part.column("text")))[:3])[2]
            value, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n, pa.int64())], ["hash", "df"])

    return docs.select("text").mapInArrow(run, tx.struct("hash long, df long"))


def _likely(docs: DataFrame, table: list[np.ndarray]) -> DataFrame:
    """The spans that may occur again, with their place."""
    schema = tx.struct("hash long, doc_id long, text_hash long, first long, beyond long")
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            h, begins, row, _ = sentences(*tx.utf8(part.column("text")))
            first, beyond, value = spans(h, begins, row)
            some = levels_passed(value, shared.value) > 0
            first, beyond, value = first[some], beyond[some], value[some]
            own = np.searchsorted(row, np.arange(part.num_rows))  # each row's first sentence
            at = row[first]
            columns = [part.column(c).take(pa.array(at)) for c in ("doc_id", "text_hash")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), *columns]
                + [pa.array(x - own[at], pa.int64()) for x in (first, beyond)],
                schema.names,
            )

    return _keyed(docs).mapInArrow(run, schema)


def repeated(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and ``spans`` (first sentence, beyond the last) to be removed from it."""
    tables = frequency_tables(_all_spans(docs), [1])
    likely = stage(_likely(docs, tables), "spans")
    place = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash", "first")
    firsts = likely.groupBy("hash").agg(F.min(place).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # Written, so that the join gets both sides straight from an exchange and can split a span
    # that very many documents share.
    firsts = stage(firsts.select("hash", "kept"), "firsts")
    later = likely.join(firsts, "hash").where(~place.eqNullSafe(F.col("kept")))
    return later.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("first", "beyond")).alias("spans"))


@any_names("n_sentences", "n_removed")
def remove(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with repeated sentences taken out of ``text``; adds two counts.

    ``n_sentences`` counts those there were, ``n_removed`` those taken out; columns of these
    names are replaced. What follows a sentence up to the next one goes with it. A text of
    nothing but repeated sentences becomes empty, a null text stays null. Documents with a null
    id come last in the order; rows with equal id and text count as one and change alike.
    """
    kept = [c for c in docs.columns if c not in ("n_sentences", "n_removed")]
    marks = stage(repeated(docs), "repeated").select(
        F.col("doc_id").alias("_mark_id"), F.col("text_hash").alias("_mark_hash"), F.col("spans").alias("_spans")
    )
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn("_text_hash", F.xxhash64("text"))
    at = F.col("doc_id").cast("long").eqNullSafe(F.col("_mark_id")) & (F.col("_text_hash") == F.col("_mark_hash"))
    marked = keyed.join(marks, at, "left").select(*[F.col(f"`{c}`") for c in kept], "_spans")
    schema = tx.T.StructType([*(docs.schema[c] for c in kept), *tx.struct("n_sentences long, n_removed long")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in tx.slices(batches):
            data, offsets = tx.utf8(part.column("text"))
            _, _, row, starts = sentences(data, offsets)
            begins = np.searchsorted(row, np.arange(part.num_rows + 1))
            texts = part.column("text").to_pylist()
            removed = np.zeros(part.num_rows, np.int64)
            for i, found in enumerate(part.column("_spans").to_pylist()):
                if not found:
                    continue
                n = begins[i + 1] - begins[i]
                gone = np.zeros(n + 1, np.int64)
                for s in found:
                    gone[s["first"]] += 1
                    gone[s["beyond"]] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                cuts = np.append(starts[begins[i] : begins[i + 1]], offsets[i + 1])
                parts = [data[offsets[i] : cuts[0]].tobytes()]
                parts += [data[cuts[k] : cuts[k + 1]].tobytes() for k in np.flatnonzero(~gone).tolist()]
                texts[i] = b"".join(parts).decode()
                removed[i] = gone.sum()
            columns = [pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in kept]
            counts = [pa.array(np.diff(begins), pa.int64()), pa.array(removed)]
            yield pa.RecordBatch.from_arrays([*columns, *counts], schema.names)

    return marked.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """Per document its text without repeated sentences, and how many there were and went."""
    return remove(docs.select("doc_id", "text")).select("doc_id", "n_sentences", "n_removed", "text")
