"""Correlations of many columns from a blocked Gram matrix.

Every task sums, for each pair of column blocks, the products that the correlations need over its rows, so a table is
scanned once whatever its number of columns, and Spark moves matrices, not cells. Tasks' matrices are added
in two steps, ``FAN_IN`` at a time, so that no task holds more than a bounded number of blocks of ``BLOCK`` x ``BLOCK``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulore.sources.tables import union_all

BLOCK = 64
FAN_IN = 32
ROWS = 4096  # rows multiplied at a time
KINDS = 6  # rows with both, sums and sums of squares of either side over these, sum of products
ROUNDING = 1e-13
MATRICES = "a int, b int, part long, sums binary"


def _products(values: np.ndarray, a: slice, b: slice, present: np.ndarray) -> np.ndarray:
    """The ``KINDS`` sums for all pairs of the columns ``a`` and ``b``; missing values are 0 in ``values``."""
    x, y, in_x, in_y = values[:, a], values[:, b], present[:, a], present[:, b]
    return np.stack([in_x.T @ in_y, x.T @ in_y, in_x.T @ y, (x * x).T @ in_y, in_x.T @ (y * y), x.T @ y])


def gram(df: DataFrame, columns: Sequence[str], centres: Sequence[float]) -> DataFrame:
    """(a, b, part, sums): matrices of the column blocks a <= b, packed as doubles.

    ``columns`` are SQL expressions of doubles; NULL and NaN are missing. Values are taken relative to ``centres``, which
    should be near the means, so that plain sums lose no digits.
    """
    count = len(columns)
    starts = range(0, count, BLOCK)
    middle = np.array(centres, np.float64)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(count)[0].as_py()
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                cells = np.column_stack([piece.column(i).fill_null(float("nan")).to_numpy(zero_copy_only=False) for i in range(count)])
                present = ~np.isnan(cells)
                values = np.where(present, cells - middle, 0.0)
                present = present.astype(np.float64)
                for i, a in enumerate(starts):
                    for j, b in enumerate(starts[i:], i):
                        more = _products(values, slice(a, a + BLOCK), slice(b, b + BLOCK), present)
                        totals[i, j] = totals[i, j] + more if (i, j) in totals else more
        for (i, j), sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([part], pa.int64()), pa.array([sums.tobytes()], pa.binary())],
                names=["a", "b", "part", "sums"])

    named = [F.expr(f"cast({c} as double)").alias(f"c{i}") for i, c in enumerate(columns)]
    return df.select(*named, F.floor(F.spark_partition_id() / FAN_IN).cast("long").alias("part")).mapInArrow(summed, MATRICES)


def _added(table: pa.Table) -> np.ndarray:
    total = None
    for sums in table["sums"]:
        more = np.frombuffer(sums.as_buffer(), np.float64)
        total = more.copy() if total is None else total + more
    return total


def table_correlations(tables: Sequence[tuple[str, DataFrame, Sequence[str], Sequence[float]]]) -> DataFrame:
    """(table, a, b, n, r) for all pairs a < b of the column numbers of each table.

    ``tables`` has names, frames, columns and centres as for ``gram``. n is the number of rows with both values, r is
    Pearson's over these; NULL where one of the two is constant there (up to rounding) or there are fewer than two.
    The matrices of all tables are added in the same two steps.
    """
    counts = {name: len(columns) for name, _, columns, _ in tables}
    kinds = "table string, " + MATRICES

    def add(table: pa.Table) -> pa.Table:
        return table.slice(0, 1).drop_columns("sums").append_column("sums", pa.array([_added(table).tobytes()], pa.binary()))

    def finish(table: pa.Table) -> pa.Table:
        name, i, j = (table[c][0].as_py() for c in ("table", "a", "b"))
        wide, high = (min(BLOCK, counts[name] - k * BLOCK) for k in (i, j))
        n, sx, sy, sxx, syy, sxy = _added(table).reshape(KINDS, wide, high)
        with np.errstate(all="ignore"):
            spread_x, spread_y = sxx - sx * sx / n, syy - sy * sy / n
            r = (sxy - sx * sy / n) / np.sqrt(spread_x * spread_y)
        varies = (n >= 2) & (spread_x > ROUNDING * sxx) & (spread_y > ROUNDING * syy)
        a, b = np.meshgrid(np.arange(wide) + i * BLOCK, np.arange(high) + j * BLOCK, indexing="ij")
        keep = a < b
        return pa.table({
            "table": pa.array([name] * int(keep.sum()), pa.string()),
            "a": pa.array(a[keep].astype(np.int32)), "b": pa.array(b[keep].astype(np.int32)), "n": pa.array(n[keep].astype(np.int64)),
            "r": pa.array(r[keep], mask=~(varies & np.isfinite(r))[keep])})

    parts = union_all([gram(df, columns, centres).select(F.lit(name).alias("table"), "a", "b", "part", "sums") for name, df, columns, centres in tables])
    summed = parts.groupBy("table", "a", "b", "part").applyInArrow(add, kinds)
    return summed.groupBy("table", "a", "b").applyInArrow(finish, "table string, a int, b int, n long, r double")


def correlations(df: DataFrame, columns: Sequence[str], centres: Sequence[float]) -> DataFrame:
    """(a, b, n, r): ``table_correlations`` of one table."""
    return table_correlations([("", df, columns, centres)]).drop("table")
