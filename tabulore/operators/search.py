"""Keyword search by a stored index of character trigrams.

The index holds, per trigram and block of rows, the rows of the block that have it, sorted by trigram, so that a search reads
the parts of the file with its trigrams only. Rows found by the index are compared with the term itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.operators.skyline import quoted
from tabulore.session import cut_lineage

ROWS_BLOCK = 4096  # rows whose numbers stand in one list at most
MOST_GRAMS = 16  # trigrams of a term that are looked up; rows that have them are compared with the whole term
FEW_ROWS = 1000  # so many found rows are read by their numbers, more by a join


def trigrams(text: Column) -> Column:
    """The distinct runs of three characters of the text in lower case."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(...))"), F.lit(1)))


@dataclass(frozen=True)
class TrigramIndex:
    """``rows`` (number, row) and ``postings`` (gram, block, numbers), both stored; ``columns`` are the indexed texts."""

    rows: DataFrame
    postings: DataFrame
    columns: tuple[str, ...]

    @classmethod
    def build(cls, df: DataFrame, columns: Sequence[str]) -> TrigramIndex:
        """Index the given text columns of ``df``; a null text has no trigrams."""
        row = F.struct(*map(quoted, df.columns)).alias("row")
        rows = cut_lineage(df.select(F.monotonically_increasing_id().alias("number"), row))
        grams = F.array_distinct(F.flatten(F.array(*[
            F.coalesce(trigrams(F.col("row")[c]), F.array().cast("array<string>")) for c in columns
        ])))
        block = F.floor(F.col("number") / ROWS_BLOCK)
        postings = (
            rows.select(F.explode(grams).alias("gram"), block.alias("block"), "number")
            .groupBy("gram", "block").agg(F.sort_array(F.collect_list("number")).alias("numbers"))
            .repartitionByRange("gram", "block").sortWithinPartitions("gram", "block")
        )
        return cls(rows, cut_lineage(postings), tuple(columns))

    def candidates(self, term: str) -> DataFrame | None:
        """(number) of the rows that have the trigrams of ``term``; None where it is too short to have any."""
        spark = self.rows.sparkSession
        grams = spark.range(1).select(trigrams(F.lit(term))).first()[0]
        if not grams:
            return None
        step = -(-len(grams) // MOST_GRAMS)
        wanted = grams[::step]
        lists = self.postings.where(F.col("gram").isin(wanted)).groupBy("block").agg(F.collect_list("numbers").alias("lists"))
        # One list for each trigram, so a block that lacks one has fewer.
        common = F.aggregate(F.slice("lists", 2, len(wanted)), F.col("lists")[0], F.array_intersect)
        return lists.where(F.size("lists") == len(wanted)).select(F.explode(common).alias("number"))

    def search(self, term: str, n: int | None = None, order_by: Sequence[str] = ()) -> DataFrame:
        """Rows with ``term`` in one of the texts, ignoring case; the first ``n`` in the given order if asked for."""
        rows, found = self.rows, self.candidates(term)
        if found is not None:
            found = cut_lineage(found)
            few = [r[0] for r in found.limit(FEW_ROWS + 1).collect()]
            if len(few) <= FEW_ROWS:
                rows = rows.where(F.col("number").isin(few))
            else:
                rows = rows.join(found, "number", "left_semi")
        hit = F.lit(False)
        for column in self.columns:
            hit |= F.coalesce(F.lower(F.col("row")[column]).contains(F.lower(F.lit(term))), F.lit(False))
        hits = rows.where(hit).select("row.*")
        if order_by:
            hits = hits.orderBy(*order_by)
        return hits if n is None else hits.limit(n)
