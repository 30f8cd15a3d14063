"""Exact order statistics without sorting a table or gathering a column.

``percentile`` and ``percentile_disc`` keep every distinct value of a group in
one aggregation buffer, and sketch merges of a global aggregate meet in one
task. Here a value bracket around the wanted rank is narrowed by counting rows
per histogram bucket: each round is one map-side combined aggregation over at
most ``buckets`` groups per rank, and the driver sees one bracket per rank.
Once a bracket holds few enough rows, its values are ranked directly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import batched
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulore.sources.tables import union_all

DIRECT_LIMIT = 10_000  # rows in a bracket that are ranked one by one
BUCKETS = 4096
LARGEST = 1.7e308
SKETCH_SIZE = 4096
SKETCH_MARGIN = 0.002  # rank error to either side that a sketch of this size stays below with over 99 %
COUNTED = 4  # targets in one aggregation; sixteen of them make code that Java does not compile, which took eighteen times as long
SKETCH_PARTS = 64  # tasks that merge the sketches of all input partitions first


@dataclass
class Target:
    """The ``rank``-th smallest (1-based) of ``value`` (SQL) over the rows of a frame.

    ``share`` asks for the smallest value whose running count reaches that share.
    """

    key: str
    value: str
    rank: int | None = None
    share: float | None = None
    lo: Any = None
    hi: Any = None
    below: int = 0
    inside: int | None = None
    result: Any = None

    @property
    def done(self) -> bool:
        return self.result is not None or self.inside == 0

    @property
    def bracket(self) -> tuple:
        return self.value, self.lo, self.hi


def clean_double(x: str) -> str:
    """SQL: NaN does not take part in order statistics."""
    return f"nullif({x}, double('NaN'))"


def _literal(value: float | int) -> str:
    return f"{value}L" if isinstance(value, int) else f"double('{value!r}')"


def _inside(x: str, lo, hi) -> str:
    return f"{x} >= {_literal(lo)} and {x} <= {_literal(hi)}"


def _bucket(x: str, lo, hi, logarithmic: bool, buckets: int) -> str:
    """SQL: histogram bucket of ``x`` between ``lo`` and ``hi``; never decreases with ``x``."""
    if isinstance(lo, int):
        share = f"cast({x} - {lo}L as double) / {float(hi - lo)!r}D"
    else:
        def scaled(v: str) -> str:
            v = f"least(greatest({v}, -{LARGEST}D), {LARGEST}D)"
            return f"signum({v}) * log1p(abs({v}))" if logarithmic else f"{v} * 0.5D"

        low, high = scaled(_literal(lo)), scaled(_literal(hi))
        share = f"coalesce(try_divide({scaled(x)} - {low}, {high} - {low}), 0D)"
    return f"least(greatest(cast(floor({share} * {buckets}) as int), 0), {buckets - 1})"


def _long(sources: Sequence[tuple[DataFrame, Sequence[Target]]], cell) -> tuple[DataFrame, dict[int, list[Target]]]:
    """(id, bucket, value) for every row inside an open bracket, and the targets per bracket id.

    Targets of one frame with the same bracket share its rows.
    """
    frames, owners = [], {}
    for df, targets in sources:
        brackets: dict[tuple, list[Target]] = {}
        for t in targets:
            if not t.done:
                brackets.setdefault(t.bracket, []).append(t)
        cells = []
        for (value, lo, hi), waiting in brackets.items():
            owners[len(owners)] = waiting
            cells.append(f"named_struct('id', {len(owners) - 1}, 'bucket', {cell(value, lo, hi)}, 'value', {value})")
        if cells:
            frames.append(df.selectExpr(f"inline(filter(array({', '.join(cells)}), c -> c.bucket is not null))"))
    return union_all(frames), owners


def _sketch_ends(sources: Sequence[tuple[DataFrame, Sequence[Target]]]) -> dict[str, tuple[float, float]]:
    """Proposed ends of the brackets, by target key; every input partition adds one sketch per value."""
    frames, owners = [], {}
    for df, targets in sources:
        values: dict[str, list[Target]] = {}
        for t in targets:
            values.setdefault(t.value, []).append(t)
        if not values:
            continue
        first = len(owners)
        owners.update(enumerate(values.values(), first))
        sketches = [F.expr(f"kll_sketch_agg_double({x}, {SKETCH_SIZE})").alias(f"sketch_{n}") for n, x in enumerate(values)]
        name = _free_name(df)
        parts = df.withColumn(name, F.spark_partition_id() % SKETCH_PARTS)
        each = ", ".join(f"named_struct('id', {first + n}, 'sketch', sketch_{n})" for n in range(len(values)))
        frames.append(parts.groupBy(name).agg(*sketches).selectExpr(f"inline(array({each}))"))
    def points(t: Target) -> list[float]:
        share = t.rank / t.inside if t.share is None else t.share
        return [min(max(share + side, 0.0), 1.0) for side in (-SKETCH_MARGIN, SKETCH_MARGIN)]

    # The function takes one literal list of shares; quartiles of many columns have the same four.
    wanted = sorted({p for waiting in owners.values() for t in waiting for p in points(t)})
    merged = union_all(frames).groupBy("id").agg(F.expr(f"kll_merge_agg_double(sketch, {SKETCH_SIZE})").alias("sketch"))
    listed = ", ".join(f"{p!r}D" for p in wanted)
    found = {}
    for row in merged.selectExpr("id", f"kll_sketch_get_quantile_double(sketch, array({listed})) as ends").collect():
        at = dict(zip(wanted, row["ends"], strict=True))
        for t in owners[row["id"]]:
            found[t.key] = tuple(at[p] for p in points(t))
    return found


def _free_name(df: DataFrame) -> str:
    taken, name = {c.lower() for c in df.columns}, "part"
    while name in taken:
        name += "_"
    return name


def _narrow_by_sketch(sources: Sequence[tuple[DataFrame, Sequence[Target]]]) -> None:
    """Replace the brackets of all given targets, which hold every value, by what a sketch and one exact count give."""
    ends = _sketch_ends(sources)
    frames, owners = [], []
    for df, targets in sources:
        for some in batched(targets, COUNTED):
            counts = []
            for t in some:
                lo, hi = map(_literal, ends[t.key])
                counts.append(
                    f"named_struct('id', {len(owners)}, 'below', count_if({t.value} < {lo}), 'at_lo', count_if({t.value} = {lo}), "
                    f"'between', count_if({t.value} > {lo} and {t.value} < {hi}), 'at_hi', count_if({t.value} = {hi}))"
                )
                owners.append(t)
            frames.append(df.agg(F.expr(f"array({', '.join(counts)})").alias("counts")).select(F.inline("counts")))
    for row in union_all(frames).collect():  # one row per target
        t = owners[row["id"]]
        lo, hi = ends[t.key]
        at_hi = row["at_hi"] if hi > lo else 0
        parts = [
            (row["below"], t.lo, math.nextafter(lo, -math.inf)), (row["at_lo"], lo, lo),
            (row["between"], math.nextafter(lo, math.inf), math.nextafter(hi, -math.inf)), (at_hi, hi, hi),
            (t.inside - row["below"] - row["at_lo"] - row["between"] - at_hi, math.nextafter(hi, math.inf), t.hi),
        ]
        for n, low, high in parts:
            if t.rank <= t.below + n:
                t.inside, t.lo, t.hi = n, low, high
                break
            t.below += n
        if t.lo == t.hi:
            t.result = t.lo


def select_ranks(
    sources: Sequence[tuple[DataFrame, Sequence[Target]]],
    direct_limit: int = DIRECT_LIMIT,
    buckets: int = BUCKETS,
) -> dict[str, Any]:
    """Resolve all targets; values come back by target key (absent when there are no rows)."""
    targets = [t for _, group in sources for t in group]

    unbounded = [(df, [t for t in group if t.inside is None]) for df, group in sources]
    if any(group for _, group in unbounded):
        rows, owners = _long(unbounded, lambda x, lo, hi: f"if({x} is not null, 0, null)")
        bounds = rows.groupBy("id").agg(F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        for row in bounds.collect():
            for t in owners[row["id"]]:
                t.inside, t.lo, t.hi = row["n"], row["lo"], row["hi"]
    for t in targets:
        t.inside = t.inside or 0
        if t.rank is None:
            t.rank = max(1, math.ceil(t.share * t.inside))
        if not 1 <= t.rank <= t.inside:
            t.inside = 0
        elif t.lo == t.hi:
            t.result = t.lo

    def wide_doubles(group: Sequence[Target]) -> list[Target]:
        return [t for t in group if not t.done and t.inside > direct_limit and t.below == 0 and isinstance(t.lo, float)]

    doubles = [(df, wide_doubles(group)) for df, group in sources]
    if any(group for _, group in doubles):
        _narrow_by_sketch(doubles)

    logarithmic = False
    while any(not t.done and t.inside > direct_limit for t in targets):
        wide = [(df, [t for t in group if not t.done and t.inside > direct_limit]) for df, group in sources]
        rows, owners = _long(
            wide, lambda x, lo, hi, log=logarithmic: f"if({_inside(x, lo, hi)}, {_bucket(x, lo, hi, log, buckets)}, null)"
        )
        running = Window.partitionBy("id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        counts = (
            rows.groupBy("id", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .withColumn("upto", F.sum("n").over(running))
        )
        hit = " or ".join(
            f"(id = {key} and upto >= {t.rank - t.below} and upto - n < {t.rank - t.below})"
            for key, waiting in owners.items() for t in waiting
        )
        wanted = {t.key: t.rank - t.below for waiting in owners.values() for t in waiting}
        for row in counts.filter(hit).collect():
            for t in owners[row["id"]]:
                if row["upto"] - row["n"] < wanted[t.key] <= row["upto"]:
                    t.below += row["upto"] - row["n"]
                    t.inside, t.lo, t.hi = row["n"], row["lo"], row["hi"]
                    if t.lo == t.hi:
                        t.result = t.lo
        logarithmic = not logarithmic

    if any(not t.done for t in targets):
        rows, owners = _long(sources, lambda x, lo, hi: f"if({_inside(x, lo, hi)}, 0, null)")
        waiting = [(key, t) for key, group in owners.items() for t in group]
        ranked = _running_counts(rows, ["id"])
        picks = [
            F.expr(f"min(case when id = {key} and upto >= {t.rank - t.below} then value end)").alias(f"pick_{n}")
            for n, (key, t) in enumerate(waiting)
        ]
        row = ranked.agg(*picks).first()
        for n, (_, t) in enumerate(waiting):
            t.result = row[f"pick_{n}"]
    return {t.key: t.result for t in targets if t.result is not None}


def _running_counts(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    counts = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("upto", F.sum("n").over(running))

