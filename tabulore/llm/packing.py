"""Packing: optimal length buckets over the global histogram, and token-budget batches inside each bucket.

Spark counts the lengths; dynamic programming over that histogram (one row per distinct length, so about the
square root of the number of tokens at most) picks the bucket bounds with the least padding. Documents get
consecutive places inside their bucket from many small slots and the slots' running counts, so that no bucket,
however large, is numbered in one task, and only a bucket's last batch is not full.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulore.session import cut_lineage

TOKEN_BUDGET = 16384
BUCKETS = 16
SLOT_ROWS = 500


def word_count(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def optimal_bounds(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The at most ``buckets`` upper bounds for which padding every length to its bound costs least.

    ``histogram`` is (length, count). Of equal costs, the one with fewer buckets is taken. A bucket over lengths
    i < x <= j costs length[j] * (N[j] - N[i]) - (S[j] - S[i]), which is a minimum over lines in length[j]:
    their lower hull gives each step of the programme in one pass.
    """
    rows = sorted((int(a), int(b)) for a, b in histogram if b > 0)
    if not rows:
        return []
    lengths = [a for a, _ in rows]
    counts, sums = [0], [0]
    for a, b in rows:
        counts.append(counts[-1] + b)
        sums.append(sums[-1] + a * b)
    d = len(rows)
    best = [0] + [None] * d
    chosen, final = [], None
    for k in range(min(buckets, d)):
        hull: list[tuple[int, int, int]] = []  # slope, intercept, index; slopes fall, so do wanted minima to the right
        now, source, at = [None] * (d + 1), [0] * (d + 1), 0
        for j in range(1, d + 1):
            i = j - 1
            if best[i] is not None:
                m, c = -counts[i], best[i] + sums[i]
                while len(hull) >= 2:
                    (m1, c1, _), (m2, c2, _) = hull[-2], hull[-1]
                    if (c - c1) * (m1 - m2) <= (c2 - c1) * (m1 - m):
                        hull.pop()
                    else:
                        break
                hull.append((m, c, i))
                at = min(at, len(hull) - 1)
            if hull:
                x = lengths[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                    at += 1
                m, c, i = hull[at]
                now[j], source[j] = x * counts[j] - sums[j] + m * x + c, i
        chosen.append(source)
        best = now
        if final is None or now[d] < final[0]:
            final = (now[d], k)
    bounds, j = [], d
    for k in range(final[1], -1, -1):
        bounds.append(lengths[j - 1])
        j = chosen[k][j]
    return bounds[::-1]


def pack(
    df: DataFrame, key: str = "doc_id", text: str = "text", length: Column | None = None, carry: tuple[str, ...] = (),
    budget: int = TOKEN_BUDGET, buckets: int = BUCKETS,
) -> DataFrame:
    """(key, *carry, n_tokens, bucket, bucket_length, batch, place) per row.

    ``length`` counts a row's tokens (by default its words); null counts as 0. A batch holds as many rows of its
    bucket as fit in ``budget`` tokens when padded to ``bucket_length``, and at least one: a text longer than the
    budget is a batch of its own. ``batch`` numbers the batches of a bucket from 0, ``place`` the rows of a batch.
    Rows without text have 0 tokens and are packed with the shortest. Order inside a bucket is by a hash of key
    and text; fully repeated rows are placed side by side. An empty table gives an empty result. Columns of
    ``df`` that are neither key nor carried are not returned.
    """
    tokens = F.greatest(F.coalesce((length if length is not None else word_count(F.col(text))).cast("long"), F.lit(0)), F.lit(0))
    named = [F.col(f"`{key}`").alias("_key"), *[F.col(f"`{c}`").alias(f"_carry{i}") for i, c in enumerate(carry)]]
    rows = cut_lineage(df.select(*named, tokens.alias("n_tokens"), F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("_order")))
    histogram = [(r[0], r[1]) for r in rows.groupBy("n_tokens").count().collect()]
    bounds = optimal_bounds(histogram, buckets) or [0]
    capacity = [max(1, budget // max(1, bound)) for bound in bounds]
    in_bucket = [sum(n for x, n in histogram if low < x <= high) for low, high in zip([-1, *bounds[:-1]], bounds, strict=True)]
    slots = [n // SLOT_ROWS + 1 for n in in_bucket]

    def by_bucket(values: list[int], kind: str) -> Column:
        out = F.lit(values[-1])
        for bound, value in zip(bounds[-2::-1], values[-2::-1], strict=True):
            out = F.when(F.col("n_tokens") <= bound, F.lit(value)).otherwise(out)
        return out.cast(kind)

    rows = rows.withColumn("bucket", by_bucket(list(range(len(bounds))), "int")).withColumn(
        "_slot", F.pmod(F.xxhash64("_order"), by_bucket(slots, "long"))
    )
    sizes = rows.groupBy("bucket", "_slot").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("bucket").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(sizes.select("bucket", "_slot", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("bucket", "_slot").orderBy("_order", "_key", "n_tokens")
    placed = rows.withColumn("_row", F.row_number().over(inside)).join(offsets, ["bucket", "_slot"])
    number = F.col("_before") + F.col("_row") - 1
    room = by_bucket(capacity, "long")
    return placed.select(
        F.col("_key").alias(key), *[F.col(f"_carry{i}").alias(c) for i, c in enumerate(carry)], "n_tokens", "bucket",
        by_bucket(bounds, "long").alias("bucket_length"), F.floor(number / room).cast("long").alias("batch"),
        F.pmod(number, room).cast("long").alias("place"),
    )
