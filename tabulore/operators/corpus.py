"""Document corpora: clean, filter, deduplicate, measure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulore.functions.text import WHITESPACE, clean_text, is_blank
from tabulore.operators.ranking import split_exact
from tabulore.session import cut_lineage
from tabulore.sources.tables import union_all

CHARS_PER_TOKEN = 4


def clean_column(df: DataFrame, column: str = "text") -> DataFrame:
    return df.withColumn(column, clean_text(F.col(column)))


def filter_by_length(df: DataFrame, lo: int = 100, hi: int = 50_000, column: str = "text") -> DataFrame:
    """Both bounds count characters and are inclusive."""
    return df.filter(F.length(column).between(lo, hi))


def drop_blank(df: DataFrame, column: str = "text") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~is_blank(F.col(column)))


def dedup_exact(df: DataFrame, order_by: Sequence[str], column: str = "text") -> DataFrame:
    """First row per distinct text.

    Rows are grouped by digest; the rank filter directly above the window lets
    each task forward one row per digest, so a text that makes up a large share
    of all rows does not pile up in one task.
    """
    window = Window.partitionBy("_digest").orderBy(*order_by)
    return (
        df.withColumn("_digest", F.sha2(column, 256))
        .withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_digest", "_place")
    )


def prepare_documents(
    df: DataFrame, key: str, lo: int = 100, hi: int = 50_000, val_share: float = 0.05, column: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Clean, filter by length, deduplicate and split; returns (train, val).

    Copies have equal length, so the length filter may follow the deduplication;
    there it reuses the cleaned text instead of cleaning once more below it.
    Cleaning only shortens, so texts that are too short go first.
    """
    long_enough = df.filter(F.length(column) >= lo)
    ready = filter_by_length(dedup_exact(clean_column(long_enough, column), [key], column), lo, hi, column)
    # The split passes over the keys several times; they read only the key column of this table.
    return split_exact(cut_lineage(ready), [key], val_share)


def corpus_stats(df: DataFrame, column: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Documents, characters, estimated tokens and mean length."""
    size = F.length(column)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum(size), F.lit(0)).alias("n_chars"),
        (F.coalesce(F.sum(size), F.lit(0)) / CHARS_PER_TOKEN).alias("est_tokens"),
        F.avg(size).alias("avg_chars"),
    )


def funnel(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows after each stage, with the rows before it."""
    counts = union_all(
        df.agg(F.count(F.lit(1)).alias("n_after")).select(
            F.lit(index).alias("step"), F.lit(stage).alias("stage"), "n_after"
        )
        for index, (stage, df) in enumerate(stages.items())
    )
    # One row per stage.
    before = F.lag("n_after").over(Window.orderBy("step"))
    return counts.select("step", "stage", F.coalesce(before, F.col("n_after")).alias("n_before"), "n_after")


def words(text: Column) -> Column:
    """Whitespace tokens; the empty text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITESPACE + "+"), "")


def sequence_budget(df: DataFrame, max_len: int = 2048, column: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """Tokens before and after truncation, and the share of rows that are cut."""
    size = F.size(words(F.col(column))).cast("bigint")
    sized = df.select(*by, size.alias("n_tokens"))
    return sized.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.least(F.col("n_tokens"), F.lit(max_len))).alias("n_kept"),
        F.count_if(F.col("n_tokens") > max_len).alias("n_truncated"),
        (F.lit(100.0) * F.count_if(F.col("n_tokens") > max_len) / F.count(F.lit(1))).alias("pct_truncated"),
    )
