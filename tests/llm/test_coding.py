"""BPE coding and token files, compared with the tokenizers library."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dimkeeper.llm import bpe, huffman
from dimkeeper.llm import text as tx
from dimkeeper.llm.queries import BYTE_BPE, vocabulary
from tests.llm.fixtures import documents, empty

PATH = vocabulary(BYTE_BPE)
PARTS = ["'", "'s", "'re", "'ll", "a", "B", "zq", "qx", "th", "é", "中", "  ", "\n", " ", "\t", " ", " "]
PARTS += ["\x85", "’", "1", "42", "!", ".", "-", "<|endoftext|>", "<|", "|>", "_", "\x1c", "\x00", "😀", "²", "vv"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_fragments_give_the_ids_of_the_library(library):
    r = random.Random(3)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    code = bpe.Coder(PATH)
    for _ in range(2):  # the second time from memory
        ids, counts = code.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for text, found in zip(texts, parts, strict=True):
            assert found.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_memory_of_fragments_may_run_full(library, monkeypatch):
    monkeypatch.setattr(bpe, "ARENA_IDS", 64)
    code = bpe.Coder(PATH)
    for i in range(20):
        text = f"several words number {i} and {i * 7919} more of them"
        ids, _ = code.encode(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_follows_the_fragments(library, monkeypatch):
    """The library's results are held for a batch at a time, and entries lie side by side."""
    code, sizes = bpe.Coder(PATH), []

    class Counting:
        def encode_batch_fast(self, texts, **options):
            sizes.append(len(texts))
            return library.encode_batch_fast(texts, **options)

    monkeypatch.setattr(code, "library", Counting())
    text = " ".join(f"q{i}z" for i in range(12_000))
    raw = np.frombuffer(text.encode(), np.uint8)
    ids, _ = code.encode(raw, np.array([0, len(raw)]))
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(sizes) > 1 and max(sizes) <= bpe.BATCH
    assert np.flatnonzero(code.lengths).tolist() == list(range(1, code.known))


def test_decoding_makes_no_encoder(library, monkeypatch):
    monkeypatch.setattr(bpe, "_coders", {})
    monkeypatch.setattr(bpe, "Coder", None)
    ids = library.encode("some words", add_special_tokens=False).ids
    assert bpe.tokens(PATH).decode(np.array(ids)) == b"some words"


def test_tasks_of_other_operators_drop_the_encoder():
    batch = pa.RecordBatch.from_arrays([pa.array(["some words"])], ["text"])
    code = bpe.coder(PATH)
    list(tx.slices(iter([batch]), keep=True))
    assert bpe.coder(PATH) is code
    list(tx.slices(iter([batch])))
    assert not bpe._coders and not bpe._tokens
    assert bpe.coder(PATH) is not code


def alternating() -> tuple[str, str]:
    """Two texts that any running sum of powers modulo 2**64 takes for the same."""
    bits = [bin(i).count("1") & 1 for i in range(1024)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_texts_of_one_polynomial_hash(spark, library):
    texts = dict(enumerate(alternating()))
    found = bpe.encode(documents(spark, texts, extra=False), PATH).where("doc_id IN (0, 1)").collect()
    for row in found:
        if row["n_chars"] == 1024:
            want = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
            assert np.frombuffer(row["ids"], "<u4").tolist() == want


@pytest.mark.parametrize("bits", [0, 3])
def test_fragments_of_equal_hash_are_told_apart(library, monkeypatch, bits):
    """With a hash of hardly any bits, almost all fragments meet others in their slot."""
    real = tx.span_hashes
    monkeypatch.setattr(tx, "span_hashes", lambda *a: real(*a) & np.uint64((1 << bits) - 1))
    r = random.Random(6)
    code = bpe.Coder(PATH)
    for _ in range(60):
        text = "".join(r.choice(PARTS) for _ in range(r.randint(1, 60)))
        raw = np.frombuffer(text.encode(), np.uint8)
        ids, _ = code.encode(raw, np.array([0, len(raw)]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_sums_modulo_the_prime():
    r = np.random.default_rng(2)
    a, b = (r.integers(0, int(tx.PRIME), 1000, dtype=np.uint64) for _ in range(2))
    assert [int(x) for x in tx.times(a, b)] == [int(x) * int(y) % int(tx.PRIME) for x, y in zip(a, b, strict=True)]
    words = np.array([5, 2**64 - 1], np.uint64)
    bits = np.array([bin(i).count("1") & 1 for i in range(1024)])
    both = words[np.concatenate([bits, 1 - bits, bits])]
    h = tx.sequence_hashes(both, np.array([0, 1024, 2048]), np.array([1024, 2048, 3072]))
    assert h[0] == h[2] != h[1]


def test_span_hashes_depend_on_bytes_and_length_alone():
    r = random.Random(9)
    spans = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(0, 140))) for _ in range(3000)]
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(x) for x in spans])
    h = tx.span_hashes(data, ends - [len(x) for x in spans], ends)
    assert len(set(zip(spans, h.tolist(), strict=True))) == len(set(spans)) == len(set(h.tolist()))


def test_decoding_any_ids(library):
    ids = np.random.default_rng(1).integers(0, 50257, 2000).astype(np.uint32)
    text = bpe.coder(PATH).decode(ids).decode("utf-8", "replace")
    assert text == library.decode(ids.tolist(), skip_special_tokens=False)


def test_round_trip_of_a_table(spark, library):
    docs = documents(spark)
    rows = bpe.decode(bpe.encode(docs, PATH), PATH).select("doc_id", "ids", "text", "score").collect()
    assert len(rows) == docs.count()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for row in rows:
        want = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        assert row["text"] == texts[row["doc_id"]]
    assert bpe.digests(empty(spark), PATH).count() == 0


def test_token_files(spark, library):
    docs = documents(spark)
    found = huffman.digests(docs, PATH).collect()
    assert len(found) == docs.count()
    found = sorted(found, key=lambda r: r["start"])
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in found]
    assert keys == sorted(keys)
    texts, start = {r["doc_id"]: r["text"] or "" for r in docs.collect()}, 0
    for row in found:
        ids = np.array([*library.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert huffman.digests(empty(spark), PATH).count() == 0


def test_raw_ids_take_two_bytes_and_are_counted_where_they_are_made(spark):
    rows = huffman._ordered_ids(documents(spark), PATH, 0).collect()
    ids = np.concatenate([np.frombuffer(r["ids"], "<u2") for r in rows if r["ids"] is not None])
    assert len(ids) == sum(r["n_ids"] or 0 for r in rows)
    totals = [r for r in rows if r["totals"] is not None]
    assert len(totals) == len({r["part"] for r in rows})
    counts = np.bincount(ids)
    for r in totals:
        found = np.frombuffer(r["totals"], "<i8")
        counts[: len(found)] -= found
    assert not counts.any()
    assert [huffman._raw_type(n) for n in (1 << 16, (1 << 16) + 1)] == ["<u2", "<u4"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), min_size=1, max_size=300), st.integers(9, 16))
def test_code_lengths_are_complete_and_limited(counts, limit):
    counts = np.array(counts)
    lengths = huffman.code_lengths(counts, limit).astype(int)
    used = lengths[counts > 0]
    assert (lengths[counts == 0] == 0).all()
    assert (used <= limit).all()
    if len(used) > 1:
        assert sum(2.0**-x for x in used) == 1


def test_code_lengths_are_optimal_where_the_limit_does_not_bind():
    import heapq

    counts = np.random.default_rng(5).integers(1, 50, 200)
    heap, total = sorted(counts.tolist()), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert (counts * huffman.code_lengths(counts)).sum() == total


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 999), max_size=3000), st.integers(0, 2**32 - 1))
def test_streams_decode_from_every_checkpoint(ids, seed):
    counts = np.random.default_rng(seed).zipf(1.3, 1000)
    lengths = huffman.code_lengths(np.minimum(counts, 1 << 30))
    ids = np.array(ids, np.uint32)
    stream, checkpoints = huffman.pack(ids, huffman.canonical(lengths), lengths)
    table = huffman.decoding_table(lengths)
    assert (huffman.unpack(stream, checkpoints, len(ids), table) == ids).all()
    for k in range(0, len(ids), huffman.BLOCK):  # one block alone
        part = ids[k : k + huffman.BLOCK]
        at = checkpoints[4 * (k // huffman.BLOCK) :][:4]
        assert (huffman.unpack(stream, at, len(part), table) == part).all()
