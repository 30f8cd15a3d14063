"""Label masks and sequence budgets on the tokens of a subword vocabulary.

The vocabulary is a file of the tokenizers library, read by each Python worker; its path is a parameter and has to be
readable on every executor. Texts go through it in Arrow batches cut by bytes; what comes back are numbers and labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulore.operators.instruct import IGNORED_LABEL
from tabulore.plans.templates import PROMPTS

if TYPE_CHECKING:
    from tokenizers import Encoding

BATCH_BYTES = 1 << 18  # of text encoded at a time; its tokens take up some fifty times that


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def _encoded(texts: pa.Array, path: str) -> Iterator[tuple[str, Encoding]]:
    """Each text, '' for NULL, with its encoding, in order; some ``BATCH_BYTES`` of text at a time are Python objects."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at, seen = 0, 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(upto, seen + BATCH_BYTES, "right")))
        some = [x or "" for x in texts.slice(at, end - at).to_pylist()]
        yield from zip(some, _tokenizer(path).encode_batch(some, add_special_tokens=False), strict=True)
        at, seen = end, int(upto[end - 1])


def subword_masks(df: DataFrame, path: str, max_len: int = 1024, column: str = "text") -> DataFrame:
    """``df`` with n_tokens, n_masked, n_trainable and ``labels`` of the first ``max_len`` tokens.

    Tokens that begin before the end of the instruction are masked: their label is the ignored one, that of the others
    is the token's id. A text without an instruction end has no masked token; a null or empty one has no tokens. The
    span of the instruction is measured in characters and compared with the tokens' offsets.
    """
    end = PROMPTS["instruction_end"]
    new = ["n_tokens", "n_masked", "n_trainable", "labels"]

    @F.arrow_udf("struct<n_tokens int, n_masked int, n_trainable int, labels array<int>>")
    def masked(texts: pa.Array) -> pa.Array:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        sizes, heads, labels = [], [], []
        for text, found in _encoded(texts, path):
            at = text.find(end)
            head = at + len(end) if at >= 0 else 0
            ids = np.array(found.ids[:max_len], np.int32)
            n = sum(a < head for a, _ in found.offsets[:max_len])
            ids[:n] = IGNORED_LABEL
            sizes.append(len(ids))
            heads.append(n)
            labels.append(ids)
        n_tokens, n_masked = np.array(sizes, np.int32), np.array(heads, np.int32)
        offsets = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *labels])))
        return pa.StructArray.from_arrays(
            [pa.array(n_tokens), pa.array(n_masked), pa.array(n_tokens - n_masked), listed], names=new)

    kept = [F.col(f"`{c}`") for c in df.columns if c not in new]
    return df.select(*kept, masked(F.col(f"`{column}`")).alias("_mask")).select(*kept, *[F.col("_mask")[c].alias(c) for c in new])


def subword_budget(df: DataFrame, path: str, max_len: int = 2048, column: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Tokens before and after truncation at ``max_len``, and the share of rows that are cut, per group."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(x) for _, x in _encoded(batch.column(len(by)), path)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(by)], pa.array(sizes, pa.int64())], names=schema.names)

    keys = df.select(*[F.col(f"`{c}`") for c in by])
    schema = keys.schema.add("n_tokens", "long")
    cut = F.count_if(F.col("n_tokens") > max_len)
    sized = df.select(*[F.col(f"`{c}`") for c in by], F.col(f"`{column}`").alias("_text")).mapInArrow(counted, schema)
    return sized.groupBy(*[F.col(f"`{c}`") for c in by]).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"),
        F.coalesce(F.sum(F.least(F.col("n_tokens"), F.lit(max_len))), F.lit(0)).alias("n_kept"),
        cut.alias("n_truncated"), F.try_divide(F.lit(100.0) * cut, F.count(F.lit(1))).alias("pct_truncated"))
