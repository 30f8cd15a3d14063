"""Comparisons of numeric columns between the top categories of a column.

All functions work on ``Profile.groups``: a few rows per (category column,
numeric column), already reduced from the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulore.operators.profile import Profile

PAIR = ["table", "cat", "cat_position", "num", "num_position"]


def top_k_filter(df: DataFrame, top: DataFrame, column: str, k: int) -> DataFrame:
    """Rows of ``df`` whose ``column`` holds one of the k most frequent values.

    ``top`` is a ``Profile.values`` frame of the same table, so at most k rows
    are broadcast.
    """
    kept = top.filter((F.col("column") == column) & (F.col("rank") <= k)).select(F.col("value").alias("_top"))
    return df.join(F.broadcast(kept), F.col(column).cast("string") == F.col("_top"), "left_semi")


def compare_groups(profile: Profile, top: int = 3) -> DataFrame:
    """Average and count per top category, for every pair of a category and a numeric column."""
    parts = F.sort_array(F.collect_list(F.struct("rank", "value", "avg", "n")))
    compared = (
        profile.groups.filter((F.col("rank") <= top) & F.col("avg").isNotNull())
        .groupBy(*PAIR).agg(parts.alias("groups"))
        .filter(F.size("groups") >= 2)
    )
    place = F.row_number().over(Window.partitionBy("table").orderBy("cat_position", "num_position"))
    return compared.withColumn("place", place)


def subgroups(profile: Profile, top: int = 5) -> DataFrame:
    """Highest and lowest group of each numeric column per category column."""
    ordered = F.sort_array(F.collect_list(F.struct(
        F.round(F.coalesce("avg", F.lit(0.0)), 9).alias("key"), "rank", "value", "avg", "stddev", "n",
    )))
    spread = (
        profile.groups.filter(F.col("rank") <= top).groupBy(*PAIR).agg(ordered.alias("groups"))
        .filter(F.size("groups") >= 2)
        .withColumn("low", F.element_at("groups", 1))
        .withColumn("high", F.element_at("groups", -1))
        .filter(F.col("low.avg").isNotNull() & F.col("high.avg").isNotNull())
    )
    diff = F.col("high.avg") - F.col("low.avg")
    return (
        spread.withColumn("diff", diff)
        .withColumn(
            "pct_diff",
            F.when(F.col("high.avg") != 0, F.lit(100.0) * F.abs(diff) / F.abs("high.avg")).otherwise(F.lit(0.0)),
        )
    )


def surprising_groups(profile: Profile, top: int = 3, limit: float = 2.0) -> DataFrame:
    """Top categories in which a numeric column's mean lies more than ``limit`` deviations off its overall mean."""
    overall = profile.numeric.filter(F.col("stddev").isNotNull() & (F.col("stddev") != 0)).select(
        "table", F.col("column").alias("num"), F.col("avg").alias("overall_avg"), F.col("stddev").alias("overall_stddev")
    )
    several = (
        profile.groups.filter(F.col("rank") <= top).withColumn(
            "n_values", F.count(F.lit(1)).over(Window.partitionBy("table", "cat", "num"))
        ).filter((F.col("n_values") >= 2) & F.col("avg").isNotNull())
    )
    z = F.abs(F.col("avg") - F.col("overall_avg")) / F.col("overall_stddev")
    return (
        several.join(overall, ["table", "num"]).withColumn("z", z).filter(F.col("z") > limit)
        .select("table", "cat", "cat_position", "num", "value", "avg", "overall_avg", "z",
                (F.col("avg") > F.col("overall_avg")).alias("is_high"))
    )
