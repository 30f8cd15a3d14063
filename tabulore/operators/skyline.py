"""Pareto fronts over any number of measures.

Distinct points of measures are compared, not rows. A first scan drops what a bounded window of good points beats
(a partial front per task, no shuffle); the rest is put in an order in which nothing is beaten by a later point,
cut into blocks, and every block meets the blocks before it under keys of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.operators.ranking import number_rows
from tabulore.session import cut_lineage

BLOCK = 2048  # points on each side of one comparison, and of the window of the first scan


def quoted(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def at_least_as_good(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a`` and of ``b``, whether no cost in ``a`` is above that in ``b``."""
    hit = np.ones((len(a), len(b)), bool)
    for k in range(a.shape[1]):
        hit &= a[:, k, None] <= b[None, :, k]
    return hit


def _partial_fronts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points that no better point of the window beats. Points of the window have been passed on, so copies may go."""
    window, scale = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            points = part.column(0).flatten().to_numpy().reshape(part.num_rows, -1)
            left = np.arange(len(points))
            if window is not None:
                left = left[~at_least_as_good(window, points).any(axis=0)]
            points = points[left]
            within = at_least_as_good(points, points)
            # Of equal points the first one counts as better.
            within &= ~(within.T & np.tril(np.ones_like(within)))
            first = ~within.any(axis=0)
            left, points = left[first], points[first]
            yield part.take(pa.array(left))
            if scale is None and len(points):
                scale = np.ptp(points, axis=0)
                scale[scale == 0] = 1
            window = points if window is None else np.concatenate([window, points])
            if len(window) > BLOCK:
                window = window[np.argsort((window / scale).sum(axis=1), kind="stable")[:BLOCK]]


def _beaten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers of the points of block b that a point of block a beats."""
    for batch in batches:
        for block_a, block_b, points_a, numbers, points_b in zip(*batch.columns, strict=True):
            numbers = numbers.values.to_numpy()
            b = points_b.values.to_numpy().reshape(len(numbers), -1)
            a = points_a.values.to_numpy().reshape(-1, b.shape[1])
            hit = at_least_as_good(a, b)
            if block_a.as_py() == block_b.as_py():
                np.fill_diagonal(hit, False)
            yield pa.RecordBatch.from_arrays([pa.array(numbers[hit.any(axis=0)], pa.int64())], names=["number"])


def front_points(points: DataFrame) -> DataFrame:
    """(costs): the distinct ones of the given arrays of finite costs that no other array beats."""
    left = points.mapInArrow(_partial_fronts, points.schema).distinct()
    # A point that is no worse in any cost has no greater total, and comes first among equal totals.
    total = F.aggregate("costs", F.lit(0.0), lambda s, x: s + x)
    numbered = number_rows(left.withColumn("total", total), ["total", "costs"], "number").drop("total")
    numbered = cut_lineage(numbered.withColumn("block", F.floor((F.col("number") - 1) / BLOCK)))
    last = numbered.agg(F.max("block")).first()[0]
    if last is None:
        return numbered.select("costs")
    held = F.sort_array(F.collect_list(F.struct("number", "costs")))
    blocks = numbered.groupBy("block").agg(held.alias("held")).select(
        "block", F.col("held.number").alias("numbers"), F.flatten("held.costs").alias("points")
    )
    a = blocks.select(
        F.col("block").alias("block_a"), F.col("points").alias("points_a"),
        F.explode(F.sequence("block", F.lit(last).cast("long"))).alias("block_b"),
    )
    b = blocks.select(
        F.col("block").alias("block_b"), "numbers", F.col("points").alias("points_b"),
        F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("block_a"),
    )
    pairs = a.join(b, ["block_a", "block_b"]).select("block_a", "block_b", "points_a", "numbers", "points_b")
    beaten = pairs.mapInArrow(_beaten, "number long").distinct()
    return numbered.join(beaten, "number", "left_anti").select("costs")


def pareto_front(df: DataFrame, lowest: Sequence[str] = (), highest: Sequence[str] = ()) -> DataFrame:
    """The rows of ``df`` that no other row beats: none is at least as good in every measure and better in one.

    Rows that agree in all measures stay together. A row with a null, NaN or infinite measure takes no part.
    """
    values = [quoted(c).cast("double") + 0.0 for c in lowest] + [-quoted(c).cast("double") + 0.0 for c in highest]
    if not values:
        raise ValueError("a front needs at least one measure")
    finite = F.lit(True)
    for value in values:
        finite &= F.coalesce(F.abs(value) < float("inf"), F.lit(False))
    rows = df.select(F.struct(*map(quoted, df.columns)).alias("row"), F.array(*values).alias("costs"), finite.alias("finite"))
    rows = rows.where("finite").drop("finite")
    front = front_points(rows.select("costs")).withColumnRenamed("costs", "best")
    return rows.join(front, F.col("costs") == F.col("best"), "left_semi").select("row.*")
