"""Hard negatives by a threshold join of anchors with all rows, after L2AP.

Vectors are whole numbers, scores inner products. For every anchor the first positives (rows of its label) and, for
each positive, the first negatives (rows of other labels) whose score lies in a window below the positive's are found,
exactly. Anchors and rows meet in cells of about ``CELL_ROWS`` rows each, dealt out by row number. A cell holds an
inverted index of its rows: dimensions come in the order of their energy in the whole table, and a row is left out of
the postings of the last dimensions once the norm of what remains of it, times that of the longest anchor, is below
the lowest threshold. Partial scores are summed dimension block by dimension block; a row goes as soon as its partial
scores plus the products of the remaining norms are below all thresholds, and what survives is computed exactly.

Thresholds: on a share of the rows each one is lowered, level by level, until the wanted number is found or its floor
(0 for positives, the lower end of a window for negatives) is reached. The last score found there is a bound that holds
for the whole table, so that the join with all rows, which follows, returns few rows an anchor whatever their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulore.session import cut_lineage

CELL_ROWS = 4096
ANCHORS = 256  # of a cell at a time
SHARE = 16  # one of so many rows gives the first bounds
BLOCK = 16  # dimensions of an index block
LEVELS = (0.9, 0.75, 0.6, 0.45, 0.3, 0.15, 0.0)  # thresholds as parts of the largest score that can be
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
FOUND = "anchor long, want int, row long, id long, score long"


def suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """The norm of each row from every dimension on; the last column is 0."""
    out = np.zeros((len(vectors), vectors.shape[1] + 1))
    out[:, :-1] = np.sqrt(np.cumsum((vectors**2)[:, ::-1], axis=1)[:, ::-1])
    return out


class Index:
    """Inverted index of rows for scores of at least ``least`` with vectors no longer than ``norm``.

    Rows stand by falling number of indexed dimensions, so the postings of a dimension are the first rows.
    """

    def __init__(self, vectors: np.ndarray, rest: np.ndarray, least: float, norm: float):
        dims = vectors.shape[1]
        # The slack covers the rounding of norms.
        indexed = (rest[:, :-1] * norm * (1 + 1e-9) + 1e-6 >= least).sum(1)
        indexed = np.minimum(-(-indexed // BLOCK) * BLOCK, dims)
        order = np.argsort(-indexed, kind="stable")
        self.rows = order[indexed[order] > 0] if least > 0 else order
        self.indexed, self.vectors, self.rest = indexed[self.rows], vectors[self.rows], rest[self.rows]

    def pairs(self, anchors: np.ndarray, rest: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score in double precision) of all pairs that reach the anchor's threshold up to rounding."""
        dims = anchors.shape[1]
        rows, indexed, vectors, remaining = self.rows, self.indexed, self.vectors, self.rest
        scores = np.zeros((len(anchors), len(rows)))
        slack = 1e-9 * rest[:, :1]
        upper = remaining[:, 0][None, :] * rest[:, :1]
        for start in range(0, dims, BLOCK):
            end = min(start + BLOCK, dims)
            reach = int(np.searchsorted(-indexed, -start, "left"))
            scores[:, :reach] += anchors[:, start:end] @ vectors[:reach, start:end].T
            at = np.minimum(indexed, end)
            upper = remaining[np.arange(len(rows)), at][None, :] * rest[:, at]
            reachable = scores + upper + slack * remaining[:, 0][None, :] + 1e-6 >= thresholds[:, None]
            alive = reachable.any(0)
            if end < dims and not alive.all():
                rows, indexed, vectors, remaining, scores = rows[alive], indexed[alive], vectors[alive], remaining[alive], scores[:, alive]
        if not dims:
            reachable = scores >= thresholds[:, None]
        i, j = np.nonzero(reachable)
        out, partly = scores[i, j], indexed[j] < dims
        out[partly] = np.einsum("ij,ij->i", anchors[i[partly]], vectors[j[partly]])
        return i, rows[j], out


@dataclass
class Side:
    """Rows of one kind in a cell: number, id, label, whole numbers, and the same in double precision."""

    number: np.ndarray
    id: np.ndarray
    label: np.ndarray
    whole: np.ndarray

    def __post_init__(self) -> None:
        self.vectors = self.whole.astype(np.float64)
        self.rest = suffix_norms(self.vectors)


def exact_scores(a: Side, b: Side, i: np.ndarray, j: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """Scores as 64-bit integers, computed with unbounded integers where double precision may be short; ends are clipped."""
    largest = [max(float(np.abs(x.vectors).max(initial=0)), 1.0) for x in (a, b)]
    if largest[0] * largest[1] * max(1, a.whole.shape[1]) < EXACT:
        return np.rint(scores).astype(np.int64)
    exact = [sum(x * y for x, y in zip(a.whole[p].tolist(), b.whole[q].tolist(), strict=True)) for p, q in zip(i.tolist(), j.tolist(), strict=True)]
    return np.array([max(-LONG, min(LONG, x)) for x in exact], np.int64)


def search(a: Side, b: Side, wants: list[list[tuple[int, int]]], count: int, same: bool, levels: tuple[float, ...]) -> dict[str, list]:
    """For each anchor and want (lowest, highest score) the first ``count`` rows of the same label, or of others.

    The thresholds of an anchor go down the levels until all its wants are filled or at their lowest score.
    """
    out: dict[str, list] = {"anchor": [], "want": [], "row": [], "id": [], "score": []}
    longest = float(b.rest[:, 0].max(initial=0))
    for first in range(0, len(a.number), ANCHORS):
        block = np.arange(first, min(first + ANCHORS, len(a.number)))
        open_wants = {int(i): list(enumerate(wants[i])) for i in block if wants[i]}
        for level in levels:
            if not open_wants:
                break
            active = np.array(sorted(open_wants))
            top = a.rest[active, 0] * longest
            at = {i: {k: max(low, int(level * min(high, t))) for k, (low, high) in open_wants[i]} for i, t in zip(active.tolist(), top.tolist(), strict=True)}
            thresholds = np.array([float(min(at[i].values())) for i in active.tolist()])
            index = Index(b.vectors, b.rest, float(thresholds.min()), float(a.rest[active, 0].max()))
            i, j, scores = index.pairs(a.vectors[active], a.rest[active], thresholds)
            i = active[i]
            fit = ((a.label[i] == b.label[j]) == same) & (a.number[i] != b.number[j])
            i, j, scores = i[fit], j[fit], scores[fit]
            scores = exact_scores(a, b, i, j, scores)
            order = np.lexsort((b.number[j], b.id[j], -scores, i))
            i, j, scores = i[order], j[order], scores[order]
            for x in active.tolist():
                begin, end = np.searchsorted(i, [x, x + 1])
                falling, left = -scores[begin:end], []
                for k, (low, high) in open_wants[x]:
                    p, q = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -at[x][k], "right")
                    if q - p < count and at[x][k] > low:
                        left.append((k, (low, high)))
                        continue
                    taken = slice(begin + p, begin + min(q, p + count))
                    out["row"] += b.number[j[taken]].tolist()
                    out["id"] += b.id[j[taken]].tolist()
                    out["score"] += scores[taken].tolist()
                    n = max(0, int(taken.stop - taken.start))
                    out["anchor"] += [int(a.number[x])] * n
                    out["want"] += [k] * n
                open_wants[x] = left
            open_wants = {x: left for x, left in open_wants.items() if left}
    return out


def _meet(rows: DataFrame, anchors: DataFrame, order: dict[int, list[int]], count: int, same: bool, levels: tuple[float, ...]) -> DataFrame:
    """``search`` over cells in which every anchor meets every row of its vector length once."""
    n_rows = rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("row_blocks"))
    n_anchors = anchors.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).alias("anchor_blocks"))
    sizes = n_rows.join(n_anchors, "dims")  # one row a vector length

    def dealt(side: DataFrame, own: str, other: str, wants: Column) -> DataFrame:
        mine = F.pmod(F.xxhash64("number"), F.col(f"{own}_blocks"))
        spread = F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"{other}_blocks") - 1))
        return side.join(sizes, "dims").select(
            "dims", mine.alias(f"{own}_block"), spread.alias(f"{other}_block"), F.lit(own == "anchor").alias("is_anchor"),
            "number", "id", "label", "vector", wants.alias("wants"))

    none = F.array().cast("array<struct<low:bigint,high:bigint>>")
    met = dealt(anchors, "anchor", "row", F.col("wants")).unionByName(dealt(rows, "row", "anchor", none))

    def cell(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims = table["dims"][0].as_py()
        vectors = table["vector"].combine_chunks().flatten().to_numpy().reshape(table.num_rows, dims)[:, order[dims]]
        anchor = table["is_anchor"].to_numpy(zero_copy_only=False)
        number, ids, label = (table[c].to_numpy() for c in ("number", "id", "label"))
        a, b = (Side(number[m], ids[m], label[m], vectors[m]) for m in (anchor, ~anchor))
        wants = [[(w["low"], w["high"]) for w in x] for x in table["wants"].filter(pa.array(anchor)).to_pylist()]
        found = search(a, b, wants, count, same, levels)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(found.items(), kinds, strict=True)})

    # One task for few cells each: left to itself Spark would join small partitions, whatever work they are.
    cells = sizes.agg(F.sum(F.col("row_blocks") * F.col("anchor_blocks"))).first()[0] or 1
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells)
    met = met.repartition(tasks, "dims", "anchor_block", "row_block")
    return met.groupBy("dims", "anchor_block", "row_block").applyInArrow(cell, FOUND)


def _first(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("anchor", "want").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _join(rows: DataFrame, anchors: DataFrame, order: dict[int, list[int]], count: int, same: bool) -> DataFrame:
    """The first ``count`` rows of every want of every anchor, with their rank."""
    share = rows.where(F.pmod(F.xxhash64("number", F.lit(1)), F.lit(SHARE)) == 0)
    last = _first(_meet(share, anchors, order, count, same, LEVELS), count).where(F.col("rank") == count)
    bounds = last.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("want", "score"))).alias("bounds"))
    raised = anchors.join(bounds, anchors["number"] == bounds["anchor"], "left").drop("anchor").withColumn(
        "wants", F.transform("wants", lambda w, k: F.struct(F.coalesce(F.col("bounds")[k], w["low"]).alias("low"), w["high"].alias("high")))
    ).drop("bounds")
    return _first(_meet(rows, raised, order, count, same, LEVELS[-1:]), count)


def whole_vectors(df: DataFrame, key: str, vector: str, label: str, anchors: Column, scale: int) -> DataFrame:
    """(number, id, label, vector of whole numbers, dims, is_anchor) of the rows that take part, stored."""
    quoted = lambda c: F.col(f"`{c}`")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(
        quoted(key).cast("long").alias("id"), quoted(label).alias("label"), quoted(vector).cast("array<double>").alias("vector"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return cut_lineage(rows.select(
        F.monotonically_increasing_id().alias("number"), "id", F.xxhash64("label").alias("label"),
        F.transform("vector", lambda x: F.floor(x * float(scale)).cast("long")).alias("vector"), F.size("vector").alias("dims"), "is_anchor"))


def energy_order(rows: DataFrame) -> dict[int, list[int]]:
    """For each vector length its dimensions by falling sum of squares over all rows; one number a dimension is collected."""

    def energies(batches):
        for batch in batches:
            dims = batch.column(0).to_numpy()
            flat = batch.column(1).flatten().to_numpy().astype(np.float64)
            ends = np.cumsum(dims)
            for d in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == d)
                at = (ends[mine] - d)[:, None] + np.arange(d)
                total = (flat[at] ** 2).sum(0)
                yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array(total)], names=["dims", "at", "energy"])

    sums = rows.select("dims", "vector").mapInArrow(energies, "dims int, at int, energy double")
    out: dict[int, list[tuple[float, int]]] = {0: []}
    for dims, at, energy in sums.groupBy("dims", "at").agg(F.sum("energy")).collect():
        out.setdefault(dims, []).append((-energy, at))
    return {dims: [at for _, at in sorted(found)] for dims, found in out.items()}


def mine_negatives(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchors: Column | None = None,
    positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(scale * x). The rows for which ``anchors`` holds are anchors (all rows, if None); the
    positives of one are the first other rows of its label by score, ties by smaller key. For each, the first rows of
    other labels whose score is from ``window[0]`` to ``window[1]`` hundredths of the positive's are ranked from 1.

    Rows with a null key, label or vector, or with a null or non-finite component take no part. Rows that share a key
    are rows of their own; where they are anchors, each has its results. Vectors of different length do not meet, and
    empty ones have scores of 0. A positive with a negative score has an empty window. Scores beyond 64 bits
    count as the largest number of 64 bits. An empty table gives no rows; other columns are not looked at.
    """
    rows = whole_vectors(df, key, vector, label, F.lit(True) if anchors is None else anchors, scale)
    order = energy_order(rows)
    chosen = rows.where("is_anchor").drop("is_anchor")
    rows = rows.drop("is_anchor")
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("low"), F.lit(LONG).alias("high")))
    near = _join(rows, chosen.withColumn("wants", any_score), order, positives, same=True)
    near = cut_lineage(near.select("anchor", "rank", "id", "score"))
    p, (low, high) = F.col("score"), window
    hundred, rest = F.expr("score div 100"), p % 100
    bottom = hundred * low + F.ceil(rest * low / 100).cast("long")
    top = hundred * high + F.floor(rest * high / 100).cast("long")
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", bottom.alias("low"), top.alias("high")))).alias("found"))
    wanting = chosen.join(windows, chosen["number"] == windows["anchor"]).withColumn(
        "wants", F.transform("found", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high")))).drop("anchor", "found")
    hard = _join(rows, wanting, order, negatives, same=False)
    hard = hard.select("anchor", (F.col("want") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    near = near.select("anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = chosen.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"))
    return hard.join(near, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mining_sql() -> str:
    """DuckDB SQL for the hard negatives of ``embeddings``: anchors divisible by 50, every seventh label moved."""
    return """
WITH fit AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id, b.r, a.label = b.label AS same,
         CASE WHEN len(a.v) = 0 THEN 0 ELSE list_dot_product(a.v, b.v)::BIGINT END AS score
  FROM fit a JOIN fit b ON a.vec_id % 50 = 0 AND a.r <> b.r AND len(a.v) = len(b.v)),
near AS (
  SELECT anchor, vec_id AS positive_id, r, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5),
hard AS (
  SELECT s.anchor_id, n.positive_id, s.vec_id AS negative_id, n.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY s.anchor, n.r ORDER BY s.score DESC, s.vec_id, s.r) AS rank
  FROM near n JOIN scored s ON s.anchor = n.anchor AND NOT s.same
   AND 50 * n.positive_score <= 100 * s.score AND 100 * s.score <= 95 * n.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM hard WHERE rank <= 3
"""
