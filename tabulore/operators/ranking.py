"""Global numbering, reproducible samples and exact splits."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulore.functions.keys import in_share, key_md5, key_position
from tabulore.operators.quantiles import BUCKETS, DIRECT_LIMIT, Target, select_ranks
from tabulore.session import cut_lineage

DEAL_BLOCK = 1_000_000  # copies of one row written per task
ROW_BITS = 33  # monotonically_increasing_id(): partition in the upper bits, row in the lower 33


def number_rows(df: DataFrame, order_by: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """Number all rows 1..n in the given order (or in scan order), in parallel.

    A window over the whole table would put every row in one task. Instead rows
    are range-partitioned and sorted; the position inside the partition comes
    with ``monotonically_increasing_id`` and only one count per partition is
    summed up. The tie column splits runs of equal keys over partitions. The
    placed rows are written once because both uses must see the same placement;
    counting the partitions reads the position column only.
    """
    if order_by:
        tied = df.withColumn("_tie", F.monotonically_increasing_id())
        placed = tied.repartitionByRange(*order_by, "_tie").sortWithinPartitions(*order_by, "_tie").drop("_tie")
    else:
        placed = df
    placed = cut_lineage(placed.withColumn("_place", F.monotonically_increasing_id()))
    partition = F.shiftright("_place", ROW_BITS)
    row = F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
    sizes = placed.groupBy(partition.alias("_partition")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of the placed frame, so small by construction.
    offsets = sizes.select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .withColumn(name, F.col("_offset") + row + 1)
        .drop("_partition", "_offset", "_place")
    )


def sample_rows(df: DataFrame, n: int, key: Sequence[str | Column]) -> DataFrame:
    """``n`` rows in md5 order of the key; a bounded top-n, not a full sort."""
    return df.withColumn("_order", key_md5(key)).orderBy("_order").limit(n).drop("_order")


def take_first(df: DataFrame, n: int, order_key: Sequence[str]) -> DataFrame:
    return df.orderBy(*order_key).limit(n)


def sample_per_group(df: DataFrame, group: str, k: int, key: Sequence[str | Column]) -> DataFrame:
    """``k`` rows per group in md5 order; each task forwards at most k rows per group."""
    order = Window.partitionBy(group).orderBy(key_md5(key))
    return df.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")


def split_hash(df: DataFrame, key: Sequence[str | Column], share: float = 0.05) -> DataFrame:
    """Add ``is_val``: a map-side split that stays put as the data grows."""
    return df.withColumn("is_val", in_share(key, share))


def split_at_rank(
    df: DataFrame, key: Sequence[str], n_first: int,
    direct_limit: int = DIRECT_LIMIT, buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """Exactly ``n_first`` rows that come first in md5 order of the key, and the rest.

    The cut is found as an order statistic of the key hash, so splitting is a
    filter. Rows that share the key at the cut are split the same way by the
    hash of the whole row, and full copies of one row are dealt out by number.
    """
    nothing = df.filter(F.lit(False))
    if n_first <= 0:
        return nothing, df
    position = key_position(key)
    positions = df.select(position.alias("_position"))
    cut = select_ranks([(positions, [Target("cut", "_position", rank=n_first)])], direct_limit, buckets).get("cut")
    if cut is None:
        return df, nothing
    counts = df.agg(
        F.count_if(position < cut).alias("before"), F.count_if(position == cut).alias("at_cut")
    ).first()
    missing = n_first - counts["before"]
    before, at_cut, after = df.filter(position < cut), df.filter(position == cut), df.filter(position > cut)
    if missing == counts["at_cut"]:
        return df.filter(position <= cut), after
    if set(key) != set(df.columns):
        inner, outer = split_at_rank(at_cut, df.columns, missing, direct_limit, buckets)
    else:
        inner, outer = _deal_copies(at_cut, missing)
    return before.unionByName(inner), after.unionByName(outer)


def _deal_copies(df: DataFrame, n_first: int) -> tuple[DataFrame, DataFrame]:
    """Split rows that are copies of one row (or of the few whose row hashes collide)."""
    names = df.columns
    distinct = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_copies"))
    upto = F.sum("_copies").over(Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, 0))
    room = F.lit(n_first) - (upto - F.col("_copies"))
    dealt = distinct.withColumn("_taken", F.greatest(F.lit(0), F.least(F.col("_copies"), room)))

    def copies(count: Column) -> DataFrame:
        blocks = F.explode(F.sequence(F.lit(0), F.floor(count / DEAL_BLOCK)))
        block = dealt.withColumn("_count", count).withColumn("_block", blocks)
        size = F.least(F.lit(DEAL_BLOCK), F.col("_count") - F.col("_block") * DEAL_BLOCK).cast("int")
        return (
            block.repartition("_block").withColumn("_copy", F.explode(F.array_repeat(F.lit(1), size))).select(*names)
        )

    return copies(F.col("_taken")), copies(F.col("_copies") - F.col("_taken"))


def split_exact(
    df: DataFrame, key: Sequence[str], val_share: float = 0.05,
    direct_limit: int = DIRECT_LIMIT, buckets: int = BUCKETS,
) -> tuple[DataFrame, DataFrame]:
    """(train, val) with exactly ``int(n * (1 - val_share))`` training rows."""
    n = df.count()
    n_train = int(n * (1 - val_share))
    val, train = split_at_rank(df, key, n - n_train, direct_limit, buckets)
    return train, val


def replay_count(n_domain: int, n_pool: int, share: float) -> int:
    """Rows to add so that they make up ``share`` of the mix, as far as the pool goes."""
    return min(math.floor(n_domain * share / (1 - share)), n_pool)


def mix_replay(
    domain: DataFrame, pool: DataFrame, key: Sequence[str], share: float = 0.2,
) -> DataFrame:
    """Domain rows plus a seeded pick from the whole replay pool, tagged by source.

    ``mix_key`` is the reproducible shuffle position of each row.
    """
    n_replay = replay_count(domain.count(), pool.count(), share)
    picked = sample_rows(pool, n_replay, key)
    return (
        domain.withColumn("source_tag", F.lit("domain"))
        .unionByName(picked.withColumn("source_tag", F.lit("replay")))
        .withColumn("mix_key", key_md5(["source_tag", *key]))
    )


def cap_pairs(
    qa: DataFrame, max_pairs: int, priority: Sequence[str], key: Sequence[str] = ("instruction", "response"),
) -> DataFrame:
    """Keep every priority category and fill up to ``max_pairs`` from the others."""
    first = qa.filter(F.col("category").isin(*priority))
    rest = qa.filter(~F.col("category").isin(*priority))
    return first.unionByName(sample_rows(rest, max(0, max_pairs - first.count()), key))
