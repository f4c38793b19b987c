"""BPE encoding by forced-boundary splitting, and decoding.

A merge can only join two bytes if their pair stands inside some token of the vocabulary. A
pair that stands in none is therefore a certain cut: whatever is left of it is encoded
independently of whatever is right of it. Texts are cut at such pairs, the tokenizers library
encodes the fragments, and their ids are joined. A worker remembers fragments by a 64-bit hash.

The library splits a text by a pattern before it merges, and that pattern looks at
neighbours. So of the certain cuts only those are used that the pattern cannot notice:
before white space after anything that is no white space (the pattern always ends a piece
there), between ASCII letters, digits and other signs where one kind follows another (so does
it end there, except after an apostrophe), and between two ASCII letters (one run of letters
stays one run of letters on either side; the pairs inside 're, 've and 'll occur in tokens). A text that holds a special
token, white space outside ASCII or an information separator is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimkeeper.llm import text as tx

#: Known fragments per Python worker: 2**SLOT_BITS places, ids of at most ARENA_IDS and texts of at most
#: ARENA_BYTES. Fixed sizes, whatever the input; what is not filled yet takes no memory but the places.
SLOT_BITS = 22
ARENA_IDS, ARENA_BYTES = 1 << 23, 1 << 25
#: Fragments that the library encodes at a time; each of its results takes some hundred bytes.
BATCH = 1 << 12
#: Beginnings of the white space that has more than one byte in UTF-8.
WIDE_SPACES = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80"]
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Other control characters that some definitions count as white space.
_CONTROLS = re.compile(b"[\x1c-\x1f]")


def byte_characters() -> dict[str, int]:
    """The characters that stand for the 256 bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokens:
    """The tokens of one vocabulary as bytes: all that decoding needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = byte_characters()
        vocabulary = spec["model"]["vocab"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*vocabulary.values(), *special.values()]))
        for token, number in vocabulary.items():
            if token not in special:
                self.tokens[number] = bytes(to_byte[c] for c in token)
        for token, number in special.items():
            self.tokens[number] = token.encode()
        self.special = [t.encode() for t in special]
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.token_ends = np.cumsum([len(t) for t in self.tokens])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of some ids, one after the other."""
        sizes = np.diff(self.token_ends, prepend=0)[ids]
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ids) else 0
        return self.token_bytes[np.repeat(self.token_ends[ids] - ends, sizes) + np.arange(n)].tobytes()


class Coder:
    """One vocabulary's library, the pairs inside its tokens, and known fragments."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        known = tokens(path)
        self.tokens, self.special, self.decode = known.tokens, known.special, known.decode
        inside = np.zeros((256, 256), bool)
        for token in self.tokens:
            b = np.frombuffer(token, np.uint8)
            inside[b[:-1], b[1:]] = True
        kind = np.zeros(256, np.uint8)  # of visible ASCII: letters 1, digits 2, others 3
        kind[33:127] = 3
        kind[48:58] = 2
        kind[65:91] = kind[97:123] = 1
        usable = ~tx.SPACES[:, None] & tx.SPACES[None, :]
        usable |= (kind[:, None] == 1) & (kind[None, :] == 1)
        changes = (kind[:, None] > 0) & (kind[None, :] > 0) & (kind[:, None] != kind[None, :])
        changes[ord("'")] = False
        usable |= changes
        self.cuts = (usable & ~inside).ravel()
        self.id_type = np.uint16 if len(self.tokens) <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        """Start with no known fragment."""
        # The entry of each place; entries lie side by side, the first is none and has no length.
        self.entries = np.zeros(1 << SLOT_BITS, np.int32)
        self.known = 1
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)
        self.begins = np.zeros(1 << SLOT_BITS, np.int32)
        self.counts = np.zeros(1 << SLOT_BITS, np.uint8)  # a remembered text has no more ids than bytes
        self.arena = np.zeros(ARENA_IDS, self.id_type)
        self.filled = 0
        self.places = np.zeros(1 << SLOT_BITS, np.int32)
        self.lengths = np.zeros(1 << SLOT_BITS, np.uint8)
        self.texts = np.zeros(ARENA_BYTES + 8, np.uint8)
        self.written = 0

    def _whole_rows(self, data: bytes, offsets: np.ndarray) -> list[int]:
        """Rows that are not cut: special tokens, wide or unusual white space."""
        odd = self.special + WIDE_SPACES
        if not (_CONTROLS.search(data) or any(w in data for w in odd)):
            return []
        found = []
        for row in range(len(offsets) - 1):
            text = data[offsets[row] : offsets[row + 1]]
            if (
                any(w in text for w in self.special)
                or _CONTROLS.search(text)
                or any(w in text for w in WIDE_SPACES)
                and _WIDE.search(text.decode())
            ):
                found.append(row)
        return found

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where fragments begin, over all rows; no fragment crosses a row."""
        if not len(data):
            return np.zeros(0, np.int64)
        begins = np.zeros(len(data), bool)
        begins[1:] = self.cuts[data[:-1].astype(np.uint16) << 8 | data[1:]]
        for row in self._whole_rows(data.tobytes(), offsets):
            begins[offsets[row] : offsets[row + 1]] = False
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        return np.flatnonzero(begins)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after the other, and how many each row has."""
        starts = self.cut(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        lengths = np.append(starts[1:], len(data)) - starts
        h = tx.span_hashes(data, starts, starts + lengths)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        entry = self.entries[slot]
        begin, count = self.begins[entry].astype(np.int64), self.counts[entry].astype(np.int64)
        known = (self.keys[entry] == h) & (self.lengths[entry] == lengths)
        # Equal hashes are no proof, so the remembered text is compared.
        at = np.flatnonzero(known)
        long = tx.padded(data)
        known[at] = tx.equal_spans(long, starts[at], lengths[at], self.texts, self.places[entry[at]].astype(np.int64))
        new = np.flatnonzero(~known)
        arena = self.arena
        if len(new):
            kinds, place = self._kinds(long, starts[new], lengths[new], h[new])
            at = new[kinds]
            fresh, sizes = self._library_ids(data.tobytes(), starts[at], lengths[at])
            put = self.filled + np.cumsum(sizes) - sizes
            short = lengths[at] <= tx.SHORT
            n_bytes = int(lengths[at][short].sum())
            full = self.known + len(at) > len(self.keys)
            if full or self.filled + len(fresh) > ARENA_IDS or self.written + n_bytes > ARENA_BYTES:
                # Ids of earlier fragments are still needed for this slice.
                arena = np.concatenate([self.arena[: self.filled], fresh])
                self.forget()
            else:
                arena[self.filled : self.filled + len(fresh)] = fresh
                self.filled += len(fresh)
                self._remember(data, starts[at[short]], lengths[at[short]], h[at[short]], put[short], sizes[short])
            begin[new], count[new] = put[place], sizes[place]
        ends_out = np.cumsum(count)
        ids = arena[np.repeat(begin - ends_out + count, count) + np.arange(ends_out[-1])].astype(np.uint32)
        ends_out = np.concatenate([[0], ends_out])
        return ids, np.diff(ends_out[np.searchsorted(starts, offsets)])

    def _library_ids(self, raw: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some fragments one after the other, and how many each has."""
        fresh, sizes = [np.zeros(0, self.id_type)], [np.zeros(0, np.int64)]
        for at in range(0, len(starts), BATCH):
            some = zip(starts[at : at + BATCH].tolist(), lengths[at : at + BATCH].tolist(), strict=True)
            texts = [raw[i : i + n].decode() for i, n in some]
            codes = [c.ids for c in self.library.encode_batch_fast(texts, add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, codes), np.int64, len(codes)))
            fresh.append(np.fromiter(chain.from_iterable(codes), self.id_type, int(sizes[-1].sum())))
        return np.concatenate(fresh), np.concatenate(sizes)

    @staticmethod
    def _kinds(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One of each different fragment, and which of those each one is."""
        _, first, kind = np.unique(h, return_index=True, return_inverse=True)
        first = first[kind]
        same = lengths == lengths[first]
        at = np.flatnonzero(same)
        same[at] = tx.equal_spans(data, starts[at], lengths[at], data, starts[first[at]])
        return np.unique(np.where(same, first, np.arange(len(h))), return_inverse=True)

    def _remember(
        self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, h: np.ndarray, put: np.ndarray, sizes: np.ndarray
    ) -> None:
        """Keep short fragments, their texts and where their ids are; longer ones are encoded each time."""
        places = self.written + np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(places - self.written, lengths)
        self.texts[self.written : self.written + len(step)] = data[np.repeat(starts, lengths) + step]
        self.written += len(step)
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        # Where two share a slot, the last one has it.
        _, last = np.unique(slot[::-1], return_index=True)
        last = len(slot) - 1 - last
        slot = slot[last]
        new = slice(self.known, self.known + len(slot))
        self.entries[slot] = np.arange(new.start, new.stop)
        self.keys[new], self.begins[new], self.counts[new] = h[last], put[last], sizes[last]
        self.places[new], self.lengths[new] = places[last], lengths[last]
        self.known = new.stop


#: Kept by the tasks that code, dropped by those of other operators.
_tokens: dict[str, Tokens] = tx.kept.setdefault("tokens", {})
_coders: dict[str, Coder] = tx.kept.setdefault("coders", {})


def tokens(path: str) -> Tokens:
    """The tokens of the vocabulary at this path, read once in each Python worker that codes."""
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def coder(path: str) -> Coder:
    """The vocabulary at this path, made once in each Python worker that codes."""
    if path not in _coders:
        _coders[path] = Coder(path)
    return _coders[path]


def parts(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per row with its ids."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * 4
    ids = np.ascontiguousarray(ids, "<u4")
    return pa.Array.from_buffers(
        pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids)]
    )


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace the text column by its ids (binary, little-endian unsigned 32-bit each).

    A null text has the ids of an empty one: none. Repeated rows stay. All other columns are
    kept as they are. ``path`` names the vocabulary file, which every executor must have.
    """
    if ids in docs.columns and ids != text:
        docs = docs.drop(ids)
    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(ids, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for part in tx.slices(batches, text, keep=True):
            out, counts = code.encode(*tx.utf8(part.column(text)))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), parts(out, counts)], [*kept, ids])

    return docs.select(*[F.col(f"`{c}`") for c in [*kept, text]]).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add the text of each row's ids. Bytes that are no UTF-8 become U+FFFD, null ids null."""
    if text in encoded.columns:
        encoded = encoded.drop(text)
    schema = T.StructType([*encoded.schema, T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = tokens(path)
        for part in tx.slices(batches, ids, keep=True):
            out = [
                None if b is None else code.decode(np.frombuffer(b, "<u4")).decode("utf-8", "replace")
                for b in part.column(ids).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], schema.names)

    return encoded.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every text; per document the counts and digests of both results."""
    both = decode(encode(docs.select("doc_id", "text"), path), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
