"""Byte-level BPE encoding and decoding of whole texts in Arrow functions.

A text is cut into units (a run of non-blank bytes with the blank before it, and the rest of each white-space
run) which no pretoken crosses, so each distinct unit of a block is encoded once: its pretokens are merged with
a priority queue of merge ranks over a doubly linked list of symbols, where entries that no longer match their
symbols are skipped. Texts with rarer white space, or with a special string, are cut by the pattern as a whole.
Decoding concatenates the bytes of the vocabulary strings.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.llm.shingles import span_hashes, text_buffers, word_spans

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KNOWN_UNITS = 1_000_000
_BLOCK = 2 << 20
_OTHER_SPACE = regex.compile(r"[^\S \t\n\x0b\x0c\r]|[\x1c-\x1f]")
_loaded: dict = {}


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, as letter -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Bpe:
    """Vocabulary, merges and special strings of a byte-level BPE definition (JSON of the tokenizers library)."""

    def __init__(self, definition: str):
        parsed = json.loads(definition)
        vocabulary, letters = parsed["model"]["vocab"], byte_letters()
        self.special = {x["content"]: x["id"] for x in parsed["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        strings = [b""] * size
        for token, i in vocabulary.items():
            strings[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            strings[i] = token.encode()
        self.byte_ids = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.ranks, self.merged = {}, []  # ids of the pair in one integer -> rank; rank -> merged id
        for rank, pair in enumerate(parsed["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocabulary[a] << 20 | vocabulary[b]] = rank
            self.merged.append(vocabulary[a + b])
        self.pattern = regex.compile(PATTERN)
        longest = sorted(self.special, key=len, reverse=True)
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        self.lengths = np.array([len(x) for x in strings], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)
        self.units: dict[int, list[int]] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pretoken."""
        ids = [self.byte_ids[b] for b in word]
        n, rank_of, merged = len(ids), self.ranks.get, self.merged
        # A queue entry is a rank and the place of its left symbol in one integer: the leftmost of equal ranks first.
        queue = [
            rank << 32 | i
            for i in range(n - 1)
            if (rank := rank_of(ids[i] << 20 | ids[i + 1])) is not None
        ]
        if not queue:
            return ids
        heapq.heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            entry = heapq.heappop(queue)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            j = after[i]
            if ids[i] < 0 or j >= n or rank_of(ids[i] << 20 | ids[j]) != rank:
                continue  # stale: one of the two symbols has been merged since
            new = ids[i] = merged[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (rank := rank_of(new << 20 | ids[k])) is not None:
                    heapq.heappush(queue, rank << 32 | i)
            h = before[i]
            if h >= 0 and (rank := rank_of(ids[h] << 20 | new)) is not None:
                heapq.heappush(queue, rank << 32 | h)
        return [x for x in ids if x >= 0]

    def pieces(self, text: str) -> list[int]:
        """Ids of a text without special strings."""
        if text.isascii() and text.removeprefix(" ").isalpha():  # one pretoken
            return self.merge(text.encode())
        out: list[int] = []
        for word in self.pattern.findall(text):
            out += self.merge(word.encode())
        return out

    def whole(self, text: str) -> list[int]:
        """Ids of a text, special strings included."""
        if not self.special_split:
            return self.pieces(text)
        out: list[int] = []
        for part in self.special_split.split(text):
            if part:
                out += [self.special[part]] if part in self.special else self.pieces(part)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        place = np.repeat(self.offsets[ids] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.bytes[place].tobytes()

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids (unsigned 32-bit) of each text of an Arrow column in turn; a null counts as an empty text."""
        data, offsets = text_buffers(column)
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, "right")) - 1)
            yield from self._block(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at])
            at = end

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        raw = data.tobytes()
        at = offsets.tolist()
        slow = {}
        for i in range(len(at) - 1):
            text = raw[at[i] : at[i + 1]].decode()
            if _OTHER_SPACE.search(text) or any(x in text for x in self.special):
                slow[i] = np.array(self.whole(text), np.uint32)
        starts, ends, of_text = word_spans(data, offsets)
        text_of = np.repeat(np.arange(len(at) - 1), np.diff(of_text))
        # The white space in front of each word, up to the word before it or the start of the text.
        gap_start = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, np.int64)
        gap_start = np.maximum(gap_start, offsets[text_of])
        blank = (starts > gap_start) & (data[np.maximum(starts - 1, 0)] == 0x20)
        unit_start = starts - blank
        gap_end = unit_start.copy()
        split = ~blank & (unit_start - gap_start > 1)  # without a blank the last white space is a token of its own
        gap_mid = np.where(split, gap_end - 1, gap_end)
        last_word_end = np.where(np.diff(of_text) > 0, ends[np.maximum(of_text[1:] - 1, 0)] if len(ends) else 0, offsets[:-1])
        n, m = len(starts), len(at) - 1
        # For each word: white space, its last byte, the unit; for each text: the white space at its end.
        begin = np.concatenate([np.column_stack([gap_start, gap_mid, unit_start]).ravel(), last_word_end])
        stop = np.concatenate([np.column_stack([gap_mid, gap_end, ends]).ravel(), offsets[1:]])
        order_text = np.concatenate([np.repeat(text_of, 3), np.arange(m)])
        order = np.argsort(order_text * 2 + np.concatenate([np.zeros(3 * n, np.int64), np.ones(m, np.int64)]), kind="stable")
        begin, stop, order_text = begin[order], stop[order], order_text[order]
        some = stop > begin
        if slow:
            some &= ~np.isin(order_text, list(slow))
        begin, stop, order_text = begin[some], stop[some], order_text[some]
        distinct, example, unit = np.unique(span_hashes(data, begin, stop), return_index=True, return_inverse=True)
        if len(self.units) > KNOWN_UNITS:
            self.units.clear()
        known, found = self.units, []
        for key, a, b in zip(distinct.tolist(), begin[example].tolist(), stop[example].tolist(), strict=True):
            ids = known.get(key)
            if ids is None:
                ids = known[key] = self.pieces(raw[a:b].decode())
            found.append(ids)
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.array([i for x in found for i in x], np.uint32)
        place = np.concatenate([[0], np.cumsum(sizes)])
        lengths = sizes[unit]
        token_ends = np.cumsum(lengths)
        ids = flat[np.repeat(place[unit] - (token_ends - lengths), lengths) + np.arange(int(token_ends[-1]) if len(token_ends) else 0)]
        cuts = np.concatenate([[0], token_ends])[np.searchsorted(order_text, np.arange(m + 1))]
        for i in range(m):
            yield slow[i] if i in slow else ids[cuts[i] : cuts[i + 1]]


def load_bpe(definition: str) -> Bpe:
    key = hash(definition)
    if key not in _loaded:
        _loaded[key] = Bpe(definition)
    return _loaded[key]


def encode(df: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int). A null or empty text has an empty array; every row stays as it is.

    Special strings inside a text become their ids. ``tokenizer_file`` is read by the driver; its content goes
    to the executors with the function. A column ``ids`` of ``df`` is replaced.
    """
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    kept = [c for c in df.columns if c.lower() != "ids"]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = list(load_bpe(definition).encode(batch.column(batch.schema.names.index(text))))
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            at = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32))
            column = pa.ListArray.from_arrays(at, pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*kept, "ids"])

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def decode(df: DataFrame, tokenizer_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text that ``ids`` stand for; a null array gives a null, bytes that are no UTF-8 U+FFFD."""
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    kept = [c for c in df.columns if c.lower() != text.lower()]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(text, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(ids))
            bpe = load_bpe(definition)
            texts = [
                bpe.decode(x.values.to_numpy(zero_copy_only=False).astype(np.int64)).decode("utf-8", "replace")
                if x.is_valid else None
                for x in column
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*kept, text])

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def round_trip_digests(df: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) per row: ``encode`` and ``decode`` in one pass over the texts."""
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    schema = T.StructType([
        df.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bpe, sizes, of_ids, of_text = load_bpe(definition), [], [], []
            for ids in bpe.encode(batch.column(1)):
                sizes.append(len(ids))
                of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                decoded = bpe.decode(ids).decode("utf-8", "replace")
                of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(F.col(f"`{key}`"), F.col(f"`{text}`")).mapInArrow(run, schema)
