"""Token counts: batch encoding in Arrow functions that return lengths only.

The vocabulary drops white space and lets no token cross it, so ASCII white space is a safe place to cut a
text: the count of a text is the sum over its words. Texts are cut into blocks of equal bytes at such places
(a long text fills several, short ones share one), and the library encodes the distinct words of a block in
one batch. No row moves between tasks.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.llm.shingles import KnownWords, byte_blocks, span_hashes, text_buffers, word_spans

TOKEN_LIMIT = 2048
KNOWN_WORDS = 3_000_000
_loaded: dict[int, object] = {}


class WordCounts:
    """Token counts of words in one vocabulary."""

    def __init__(self, tokenizer):
        self.tokenizer, self.known = tokenizer, KnownWords(1, KNOWN_WORDS)

    def of(self, hashes: np.ndarray, word) -> np.ndarray:
        """Counts of distinct sorted ``hashes``; ``word(i)`` gives the i-th word."""

        def encode(places: list[int]) -> np.ndarray:
            encoded = self.tokenizer.encode_batch_fast([word(i) for i in places], add_special_tokens=False)
            return np.array([[len(e)] for e in encoded])

        return self.known.of(hashes, encode)[:, 0].astype(np.int64)


def word_counts(definition: str) -> WordCounts:
    key = hash(definition)
    if key not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(definition)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        _loaded[key] = WordCounts(tokenizer)
    return _loaded[key]


def text_token_counts(column: pa.Array, known: WordCounts) -> np.ndarray:
    """Number of tokens of each text of an Arrow column; a null counts as an empty text."""
    data, offsets = text_buffers(column)
    totals = np.zeros(len(column), np.int64)
    for begin, end in byte_blocks(data, offsets):
        block = data[begin:end]
        first = int(np.searchsorted(offsets, begin, "right")) - 1
        last = int(np.searchsorted(offsets, end, "left"))
        inner = np.clip(offsets[first : last + 1] - begin, 0, end - begin)
        starts, ends, at = word_spans(block, inner)
        if not len(starts):
            continue
        distinct, example, word = np.unique(span_hashes(block, starts, ends), return_index=True, return_inverse=True)
        raw = block.tobytes()
        first_byte, end_byte = starts[example].tolist(), ends[example].tolist()
        lengths = known.of(distinct, lambda i: raw[first_byte[i] : end_byte[i]].decode())
        sums = np.concatenate([[0], np.cumsum(lengths[word])])
        totals[first:last] += sums[at[1:]] - sums[at[:-1]]
    return totals


def count_tokens(df: DataFrame, tokenizer_file: str, text: str = "text", limit: int = TOKEN_LIMIT) -> DataFrame:
    """``df`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (n_tokens > ``limit``).

    ``tokenizer_file`` is a definition for the tokenizers library whose tokens do not cross white space; the
    driver reads it and ships its content, so executors need no such file. Null and empty texts have 0 bytes
    and tokens. Every row keeps its place and other columns; columns named like the three new ones are replaced.
    """
    definition = Path(tokenizer_file).read_text(encoding="utf-8")
    kept = [c for c in df.columns if c.lower() not in ("n_bytes", "n_tokens", "over_limit")]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("n_tokens", T.LongType(), False)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index(text))
            counts = text_token_counts(column, word_counts(definition))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], names=[*kept, "n_tokens"])

    out = df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(count, schema)
    return out.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"), "over_limit": F.col("n_tokens") > limit,
    })
