"""Embedding near-dedup with randomised-rotation binary codes.

A unit vector is rotated at random; the signs are its code, and the inner product of vector and code direction
its correction factor. Code and factor estimate the inner product with another rotated vector without bias, with
an error bound; only pairs whose upper bound reaches the threshold are computed again in double precision.
Candidates are pairs of one label that agree in the first bits under one of several rotations. Their number of
bits follows the number of vectors of a label, and the number of rotations the wanted recall of pairs right at
the threshold (pairs above it are found more surely). Every agreement is looked at: large buckets are dealt out
in pairs of parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulore.llm.components import components
from tabulore.session import cut_lineage

COSINE = 0.93
RECALL = 0.98
BOUND = 4.0  # standard errors that the bound allows
LEAST_BITS, MOST_BITS = 8, 24
PART_ROWS = 1024
TASK_ROWS = 20_000


def rotation(dims: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def key_bits(vectors: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(2, vectors)))))


def tables_for(bits: int, cosine: float, recall: float) -> int:
    """Rotations after which a pair at the threshold has agreed in all its first bits once with the wanted chance."""
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - agree)))


def encode(units: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code of signs packed to bytes, correction factor) of each unit vector."""
    turned = units @ turn.T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(units.shape[1])


def estimate(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of all inner products of coded with rotated vectors, and the standard error per code."""
    dims = turned.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dims).astype(np.float32) * 2 - 1
    around = np.maximum(factors, 1e-9)
    error = np.sqrt(np.maximum(0, 1 - around**2)) / around / math.sqrt(max(1, dims - 1))
    return signs @ turned.T.astype(np.float32) / math.sqrt(dims) / around[:, None], error


def _units(column: pa.ListArray) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    with np.errstate(over="ignore"):
        rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str, label: str) -> str:
    """SQL: whether a row can link with others."""
    return (
        f"`{label}` IS NOT NULL AND `{vector}` IS NOT NULL AND size(`{vector}`) > 0 AND forall(`{vector}`, x -> x IS NOT NULL "
        f"AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(`{vector}`, x -> x != 0)"
    )


def near_vectors(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE, recall: float = RECALL
) -> DataFrame:
    """(key, n_links, component_id, kept) per row.

    ``n_links`` counts the other rows of the same label with a cosine of ``cosine`` or more, ``component_id`` is
    the smallest key reachable by links, ``kept`` whether it is the row's own. Vectors that are null, empty, zero
    or hold null or non-finite components, and rows without a label, link with nothing; nor do vectors of
    different length. Equal vectors of a label are handled once and linked with each other. Rows of one key
    are rows of their own, and rows with a null key have the smallest key of their component that is not null.
    """
    named = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector"))
    named = named.withColumn("fit", F.expr(usable("vector", "label")))
    # One point for equal vectors of a label, named by the digest of both.
    digest = F.xxhash64("label", "vector")
    rows = named.withColumn("point", F.when(F.col("fit"), digest))
    points = rows.where("fit").groupBy("point").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.min("key").alias("least"), F.count(F.lit(1)).alias("copies"))
    points = cut_lineage(points.withColumn("kind", F.xxhash64("label", F.size("vector"))).withColumn("dims", F.size("vector")))
    sizes = {(r[0], r[1]): r[2] for r in points.groupBy("kind", "dims").count().groupBy("dims").agg(F.max("kind"), F.max("count")).collect()}
    spans, degrees = None, None
    for (dims, _), most in sizes.items():  # one round per vector length
        found = _links(points.where(F.col("dims") == dims), dims, most, cosine, recall)
        spans = found if spans is None else spans.union(found)
    if spans is None:
        links = degrees = None
    else:
        spans = cut_lineage(spans)
        links = components(spans.where("b IS NOT NULL").select("a", "b"))
        degrees = spans.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("n"))
    if links is None:
        return rows.select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    known = points.select("point", "least", "copies")
    known = known.join(links, F.col("point") == F.col("node"), "left").withColumn("root", F.coalesce("root", "point"))
    known = known.join(degrees.withColumnRenamed("a", "_a"), F.col("point") == F.col("_a"), "left")
    ends = known.groupBy("root").agg(F.min("least").alias("end"))
    known = known.join(ends, "root").select(
        F.col("point").alias("_point"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "end")
    out = rows.join(known, F.col("point") == F.col("_point"), "left")
    component = F.when(F.col("fit"), F.col("end")).otherwise(F.col("key")).cast("long")
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )


def _links(points: DataFrame, dims: int, most: int, cosine: float, recall: float) -> DataFrame:
    """Rows (a, b, null) that connect linked points, and rows (a, null, n) whose sum over a is the number of links."""
    bits = key_bits(most)
    tables = tables_for(bits, cosine, recall)
    turn = rotation(dims, 0)
    # First bits of each table: the signs along as many of the directions of a rotation, or of several.
    per_turn = max(1, dims // bits)
    turns = [rotation(dims, 1 + i) for i in range(-(-tables // per_turn))] if dims >= bits else [
        np.vstack([rotation(dims, 1 + i * 1000 + j) for j in range(-(-bits // dims))]) for i in range(tables)]
    heads = np.stack([turns[i // per_turn][(i % per_turn) * bits : (i % per_turn + 1) * bits] for i in range(tables)])
    weights = 1 << np.arange(bits, dtype=np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _units(batch.column(2))
            codes, factors = encode(units, turn)
            keys = ((units @ heads.reshape(-1, dims).T) > 0).reshape(len(units), tables, bits) @ weights
            at = pa.array(np.arange(len(units) + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(list(units.astype(np.float64)), pa.list_(pa.float64())), batch.column(3),
                pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(factors),
                pa.ListArray.from_arrays(at, pa.array(keys.ravel())),
            ], names=["point", "kind", "unit", "copies", "code", "factor", "keys"])

    coded = cut_lineage(points.select("point", "kind", "vector", "copies").mapInArrow(
        code, "point long, kind long, unit array<double>, copies long, code binary, factor double, keys array<long>"))
    buckets = coded.select("point", "kind", F.posexplode("keys").alias("table", "head"))
    counts = buckets.groupBy("kind", "table", "head").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # Parts of large buckets meet in pairs; a small bucket is one part that meets itself.
    parts = F.ceil(F.col("size") / PART_ROWS).cast("int")
    met = buckets.join(counts, ["kind", "table", "head"]).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("point"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(
        F.least(j, F.col("part")).alias("low"), F.greatest(j, F.col("part")).alias("high")))
    met = met.withColumn("pair", F.explode(pairs)).select(
        "point", "table", "part", F.xxhash64("kind", "table", "head", "pair.low", "pair.high").alias("cell"), F.col("pair.low") != F.col("pair.high"))
    met = cut_lineage(met.toDF("point", "table", "part", "cell", "crossed"))
    groups = max(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), met.count() // TASK_ROWS + 1)

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order = np.argsort(table["cell"].to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        cell, ids, copies = (table[c].to_numpy() for c in ("cell", "point", "copies"))
        units = _units(table["unit"].chunk(0)) if table.num_rows else np.zeros((0, dims))
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
        factors, number, part = table["factor"].to_numpy(), table["table"].to_numpy(), table["part"].to_numpy()
        crossed = table["crossed"].to_numpy(zero_copy_only=False)
        keys = table["keys"].chunk(0).flatten().to_numpy().reshape(table.num_rows, tables) if table.num_rows else np.zeros((0, tables))
        turned = units @ turn.T
        links: list[tuple[int, int]] = []
        degree: dict[int, int] = {}
        cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]]).tolist()
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            guess, error = estimate(codes[a:b], factors[a:b], turned[a:b])
            upper = guess + (BOUND * error)[:, None]
            i, j = np.nonzero(np.triu((upper >= cosine) & (upper.T >= cosine), 1))
            if crossed[a]:
                apart = part[a:b][i] != part[a:b][j]
                i, j = i[apart], j[apart]
            exact = np.einsum("ij,ij->i", units[a:b][i], units[a:b][j])
            i, j = i[exact >= cosine], j[exact >= cosine]
            # A pair that already met in an earlier table has been counted there.
            new = ~(keys[a:b][i, : number[a]] == keys[a:b][j, : number[a]]).any(1)
            i, j = i[new], j[new]
            if not len(i):
                continue
            more = np.bincount(i, weights=copies[a:b][j], minlength=b - a) + np.bincount(j, weights=copies[a:b][i], minlength=b - a)
            for k in np.flatnonzero(more).tolist():
                degree[int(ids[a + k])] = degree.get(int(ids[a + k]), 0) + int(more[k])
            label = np.arange(b - a)
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if label[x] != label[y]:
                    links.append((int(ids[a + x]), int(ids[a + y])))
                    label[label == label[y]] = label[x]
        n = len(links)
        return pa.table({
            "a": pa.array([x for x, _ in links] + list(degree), pa.int64()),
            "b": pa.array([y for _, y in links] + [None] * len(degree), pa.int64()),
            "n": pa.array([None] * n + list(degree.values()), pa.int64()),
        })

    group = F.pmod(F.xxhash64("cell"), F.lit(groups))
    full = met.join(coded.select(F.col("point").alias("_p"), "unit", "copies", "code", "factor", "keys"), F.col("point") == F.col("_p")).drop("_p")
    return full.groupBy(group.alias("g")).applyInArrow(compare, "a long, b long, n long")
