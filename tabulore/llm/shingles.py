"""Word shingles of whole Arrow columns of text, as 64-bit hashes, without a Python loop over words.

Words are runs of bytes other than ASCII white space (0x20, 0x09-0x0D), with A-Z lower-cased.
A text of fewer words than the shingle length is one shingle; a text without words has none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 20  # bytes of text at a time; temporary arrays are a few dozen times as large


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


EXACT = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
FOLDED = EXACT.copy()
FOLDED[65:91] = EXACT[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD_BYTES = ~_SPACE
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get("up")
    if have is None or len(have) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.ones(size, np.uint64)
            done = 1
            while done < size:
                out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            _powers[name] = out
    return _powers["up"], _powers["down"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the len + 1 offsets into them; a null is an empty text."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if column.null_count:
        null = ~np.asarray(column.is_valid())
        if (np.diff(offsets)[null] > 0).any():  # bytes behind a null are none of its text
            return text_buffers(pa.array(["" if x is None else x for x in column.to_pylist()], pa.large_string()))
    return data, offsets


def word_spans(
    data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = WORD_BYTES
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word (a run of ``word_bytes``), and the offsets of each text's words."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = word_bytes[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    first[borders] = inside[borders]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = EXACT) -> np.ndarray:
    """Hash of every given span of bytes, independent of its place."""
    up, down = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(table[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[np.minimum(starts, len(down) - 1)] ^ (ends - starts).astype(np.uint64))


def byte_blocks(data: np.ndarray, offsets: np.ndarray, size: int = _BLOCK):
    """(first byte, end) of blocks of about ``size`` bytes that end where a text ends or at white space."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + size, n)
        if end < n:
            border = int(offsets[np.searchsorted(offsets, end)])
            while end < border and not _SPACE[data[end]]:
                gap = np.flatnonzero(_SPACE[data[end : min(border, end + size)]])
                end = end + int(gap[0]) if len(gap) else min(border, end + size)
        yield at, end
        at = end


def small_batches(batches: Iterator[pa.RecordBatch], text: int, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``size`` bytes of the text column (its number); a longer text is a batch of its own."""
    for batch in batches:
        offsets, at = text_buffers(batch.column(text))[1], 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
            yield batch.slice(at, end - at)
            at = end


class KnownWords:
    """Rows of numbers for words by hash, kept from block to block in a worker; takes no more at ``limit`` words."""

    def __init__(self, width: int, limit: int):
        self.hashes, self.rows, self.limit = np.zeros(0, np.uint64), np.zeros((0, width)), limit

    def of(self, hashes: np.ndarray, compute: Callable[[list[int]], np.ndarray]) -> np.ndarray:
        """A row for each of the distinct sorted ``hashes``; ``compute`` gives those of the given places."""
        place = np.searchsorted(self.hashes, hashes)
        seen = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        seen[inside] = self.hashes[place[inside]] == hashes[inside]
        out = np.empty((len(hashes), self.rows.shape[1]))
        out[seen] = self.rows[place[seen]]
        new = np.flatnonzero(~seen)
        if len(new):
            out[new] = compute(new.tolist())
            kept = new[: max(0, self.limit - len(self.hashes))]
            if len(kept):
                self.hashes = np.insert(self.hashes, place[kept], hashes[kept])
                self.rows = np.insert(self.rows, place[kept], out[kept], axis=0)
        return out


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and the len + 1 offsets of the texts."""
    data, offsets = text_buffers(column)
    parts, counts, at = [], [np.zeros(1, np.int64)], 0
    while at < len(column):  # blocks of a few MB keep the temporary arrays small
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, "right")) - 1)
        values, sizes = _block(data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at], words)
        parts.append(values)
        counts.append(sizes)
        at = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.cumsum(np.concatenate(counts))


def _block(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = word_spans(data, offsets)
    hashes = span_hashes(data, starts, ends, FOLDED)
    n_words = np.diff(at)
    n_out = np.where(n_words >= words, n_words - words + 1, np.minimum(n_words, 1))
    doc = np.repeat(np.arange(len(n_out)), n_out)
    start = np.repeat(at[:-1] - (np.cumsum(n_out) - n_out), n_out) + np.arange(int(n_out.sum()))
    length = np.minimum(n_words, words)[doc]
    out = mix(length.astype(np.uint64))
    for k in range(words):
        have = length > k
        position = np.minimum(start + k, max(len(hashes) - 1, 0))
        out = np.where(have, mix(out * np.uint64(0xD6E8FEB86659FD93) + hashes[position]), out)
    ends = np.cumsum(n_out).tolist()
    begin = 0
    for end in ends:  # texts are short against the block: sorting each beats one sort of all with their numbers
        out[begin:end].sort()
        begin = end
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[keep], np.bincount(doc[keep], minlength=len(n_out)).astype(np.int64)
