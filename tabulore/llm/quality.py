"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

Counts of hashed byte n-grams, and of which of the two words before it a word repeats, give one generative model for the target (texts labelled good, a bounded sample)
and one for the raw text (all of it). A text's log weight is the mean of log(target / raw) over its n-grams,
times a fixed length; a Gumbel variate from a hash of the row is added, and the k rows with the largest sums are the sample: k draws
without replacement with probabilities in proportion to the weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.llm.shingles import span_hashes, text_buffers, word_spans
from tabulore.session import cut_lineage

TARGET_DOCS = 20_000
GRAMS = (2, 3, 4)
BUCKET_BITS = 16
FEATURES = (1 << BUCKET_BITS) + 4  # the last four: which of the two words before it a word repeats
SMOOTHING = 1.0
LENGTH = 100
SLACK = 24.0
HISTOGRAM = 4096
FEW = 10_000
_BLOCK = 1 << 20


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first byte, bucket) of the byte n-grams inside the texts, for each n in turn, and of the words' repeats."""
    if not len(data):
        return
    starts, ends, of_text = word_spans(data, offsets)
    words, text = span_hashes(data, starts, ends), np.repeat(np.arange(len(offsets) - 1), np.diff(of_text))
    repeats = np.zeros(len(words), np.int64)
    for back in (1, 2):
        repeats[back:] += back * ((words[back:] == words[:-back]) & (text[back:] == text[:-back]))
    yield starts, repeats + (1 << BUCKET_BITS)
    end = np.repeat(offsets[1:], np.diff(offsets))
    code = data.astype(np.uint64)
    at = np.arange(len(data))
    rolled = code
    for n in range(2, max(GRAMS) + 1):
        rolled = (rolled[:-1] << np.uint64(8)) | code[n - 1 :]
        if n in GRAMS:
            inside = at[: len(rolled)] + n <= end[: len(rolled)]
            bucket = (rolled + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BUCKET_BITS)
            yield at[: len(rolled)][inside], bucket[inside].astype(np.int64)


def _blocks(data: np.ndarray, offsets: np.ndarray):
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _BLOCK, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def gram_counts(df: DataFrame, text: str, target: str) -> np.ndarray:
    """Counts of every bucket in all texts and in those where ``target`` holds: an array of two rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, FEATURES), np.int64)
        for batch in batches:
            chosen = np.asarray(batch.column(1).fill_null(False))
            data, offsets = text_buffers(batch.column(0))
            for first, last, part, inner in _blocks(data, offsets):
                wanted = np.repeat(chosen[first:last], np.diff(inner))
                for place, bucket in gram_buckets(part, inner):
                    counts[0] += np.bincount(bucket, minlength=FEATURES)
                    if wanted.any():
                        counts[1] += np.bincount(bucket[wanted[place]], minlength=FEATURES)
        some = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0][some]), pa.array(counts[1][some])], names=["bucket", "raw", "target"])

    rows = df.select(F.col(text), F.col(target)).mapInArrow(run, "bucket long, raw long, target long")
    out = np.zeros((2, FEATURES), np.int64)
    for bucket, raw, wanted in rows.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # one row per bucket
        out[:, bucket] = raw, wanted
    return out


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """log(target / raw) of each bucket; smoothed towards 0, which it is where nothing was counted or without target text."""
    raw, target = counts
    if not target.any():
        return np.zeros(counts.shape[1])
    share = target.sum() / raw.sum()
    return np.log((target + SMOOTHING * share) / (raw + SMOOTHING) / share)


def text_log_weights(column: pa.Array, ratios: np.ndarray) -> np.ndarray:
    """Log weight of each text as if it had ``LENGTH`` words and ``LENGTH`` byte n-grams, a share for each n.

    Without this a slight difference between the mixtures of the two corpora, such as the share of a language,
    would outweigh everything else in long texts.
    """
    data, offsets = text_buffers(column)
    out = np.zeros(len(column))
    for first, last, part, inner in _blocks(data, offsets):
        for place, bucket in gram_buckets(part, inner):
            each, some = np.zeros(len(part) + 1), np.zeros(len(part) + 1)
            each[place + 1], some[place + 1] = ratios[bucket], 1
            each, some = np.cumsum(each), np.cumsum(some)
            share = 1 if len(bucket) and bucket[0] >= 1 << BUCKET_BITS else 1 / len(GRAMS)
            mean = (each[inner[1:]] - each[inner[:-1]]) / np.maximum(some[inner[1:]] - some[inner[:-1]], 1)
            out[first:last] += LENGTH * share * mean
    return np.round(out, 6)  # sums differ in their last digits with a text's place in the batch


def kth_largest(df: DataFrame, value: str, k: int) -> float | None:
    """The k-th largest of a column of finite doubles, by counting rows in ever narrower histograms."""
    low, high, total = df.agg(F.min(value), F.max(value), F.count(value)).first()
    if not 0 < k <= total:
        return None
    above = 0
    while True:
        inside = df.where(F.col(value).between(low, high))
        width = (high - low) / HISTOGRAM
        if width <= 0 or low + width == low:
            return low
        cell = F.least(F.lit(HISTOGRAM - 1), F.floor((F.col(value) - F.lit(low)) / F.lit(width)).cast("int"))
        counts = sorted(((r[0], r[1], r[2], r[3]) for r in inside.groupBy(cell.alias("c")).agg(F.count(F.lit(1)), F.min(value), F.max(value)).collect()), reverse=True)
        for _, n, least, most in counts:  # at most HISTOGRAM rows
            if above + n >= k:
                break
            above += n
        if n <= FEW:
            values = sorted((r[0] for r in df.where(F.col(value).between(least, most)).select(value).collect()), reverse=True)
            return values[k - above - 1]
        if least == most:
            return least
        low, high = least, most


def resample(
    df: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text", k: int | None = None, slack: float = SLACK,
    target_docs: int = TARGET_DOCS,
) -> DataFrame:
    """(key, log_weight, sample_key, selected) per row.

    ``target_ids`` has the keys of texts known to be good in its first column; the ``target_docs`` first of them
    by hash make the target model, which bounds what is broadcast. ``k`` rows are selected, by default as many as
    have a log weight of ``-slack`` or more, that is all that are not clearly less likely in the target than in
    the raw text; rows that tie with the last one are selected too. Null and empty texts weigh 0. The variate
    comes from a hash of key and text, so that repeated rows share it and runs repeat. Without target rows all
    weights are 0. An empty table gives an empty result.
    """
    found = _resample(df, target_ids, key, text, k, slack, target_docs)
    return found.select(F.col("_key").alias(key), "log_weight", "sample_key", "selected")


def _draw(key: Column, text: Column) -> Column:
    """A row's number, which its variate comes from: the same for the same key and text."""
    return F.xxhash64(key, text, F.lit("gumbel"))


def _resample(df: DataFrame, target_ids: DataFrame, key: str, text: str, k: int | None, slack: float, target_docs: int) -> DataFrame:
    """(_key, _draw, log_weight, sample_key, selected) per row."""
    name = target_ids.columns[0]
    wanted = target_ids.select(F.col(f"`{name}`").alias("_target")).where("_target IS NOT NULL").distinct()
    wanted = cut_lineage(wanted.orderBy(F.xxhash64("_target"), "_target").limit(target_docs))
    rows = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    marked = rows.join(F.broadcast(wanted), F.col("_key") == F.col("_target"), "left").withColumn("_good", F.col("_target").isNotNull())
    ratios = log_ratios(gram_counts(marked, "_text", "_good"))
    schema = T.StructType([T.StructField("_key", df.schema[key].dataType), T.StructField("_draw", T.LongType()), T.StructField("log_weight", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = pa.array(text_log_weights(batch.column(2), ratios))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), weights], names=schema.names)

    weighed = rows.select("_key", _draw(F.col("_key"), F.col("_text")).alias("_draw"), "_text").mapInArrow(run, schema)
    uniform = (F.shiftrightunsigned("_draw", 11).cast("double") + 0.5) * F.lit(2.0**-53)
    weighed = weighed.withColumn("sample_key", F.col("log_weight") - F.log(-F.log(uniform)))
    weighed = cut_lineage(weighed)
    k = weighed.where(F.col("log_weight") >= -slack).count() if k is None else k
    least = kth_largest(weighed, "sample_key", min(k, weighed.count()))
    selected = F.lit(False) if least is None else F.col("sample_key") >= F.lit(least)
    return weighed.withColumn("selected", selected)


def selected_rows(
    df: DataFrame, target_ids: DataFrame, key: str = "doc_id", text: str = "text", k: int | None = None, slack: float = SLACK,
    target_docs: int = TARGET_DOCS,
) -> DataFrame:
    """The rows of ``df`` that ``resample`` selects, row by row.

    Key and text decide, so a row does not go because another of the same key goes, and repeated rows go or stay together.
    All columns come through, whatever they are called.
    """
    quoted = lambda c: F.col(f"`{c.replace('`', '``')}`")
    rows = df.select(_draw(quoted(key), quoted(text)).alias("draw"), F.struct(*map(quoted, df.columns)).alias("row"))
    others = _resample(df, target_ids, key, text, k, slack, target_docs).where("NOT selected").select(F.col("_draw").alias("other")).distinct()
    return rows.join(others, F.col("draw") == F.col("other"), "left_anti").select("row.*")
