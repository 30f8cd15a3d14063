import math
import random

import pytest
from pyspark.sql import functions as F

from tabulore.operators import corpus, quantiles, ranking
from tabulore.operators.quantiles import Target, clean_double, select_ranks


def brute(values, share):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(0, math.ceil(share * len(kept)) - 1)]


CASES = {
    "uniform": lambda r: [r.random() for _ in range(1500)],
    "hot": lambda r: [7.0] * 700 + [r.gauss(0, 1) for _ in range(900)],
    "tails": lambda r: [r.choice([-1, 1]) * 10 ** r.uniform(-12, 200) for _ in range(1200)],
    "gaps": lambda r: [None, float("nan"), 1e308, -1e308] + [float(r.randint(0, 9)) for _ in range(800)],
    "dense": lambda r: [1e12 + r.random() for _ in range(1000)] + [0.0],
    "one": lambda r: [3.5],
}


@pytest.mark.parametrize("case", CASES)
def test_order_statistics_equal_brute_force(spark, case):
    values = CASES[case](random.Random(5))
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    value = clean_double("x")
    targets = [Target(str(s), value, share=s) for s in (0.01, 0.25, 0.5, 0.75, 1.0)]
    found = select_ranks([(df, targets)], direct_limit=20, buckets=8)
    assert found == {str(s): brute(values, s) for s in (0.01, 0.25, 0.5, 0.75, 1.0)}
    direct = select_ranks([(df, [Target(str(s), value, share=s) for s in (0.25, 0.75)])])
    assert direct == {"0.25": brute(values, 0.25), "0.75": brute(values, 0.75)}


def test_order_statistics_of_close_large_integers(spark):
    values = [2**60] * 60 + [2**60 + 1] * 70 + [5]
    df = spark.createDataFrame([(v,) for v in values], "x bigint")
    found = select_ranks([(df, [Target(str(r), "x", rank=r) for r in (1, 61, 62, 131)])], direct_limit=10, buckets=4)
    assert found == {"1": 5, "61": 2**60, "62": 2**60 + 1, "131": 2**60 + 1}


@pytest.mark.parametrize("shift", [0, -40, 40])
def test_order_statistics_when_the_sketch_misses(spark, monkeypatch, shift):
    """The counts decide, wherever the proposed bracket lies."""
    values = [float(v) for v in range(300)] * 2 + [150.0] * 400 + [float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in values], "part double").repartition(3)
    shares = (0.0005, 0.1, 0.4, 0.5, 0.9, 1.0)
    found = quantiles._sketch_ends

    def moved(sources):
        return {key: (lo + shift, hi + shift) for key, (lo, hi) in found(sources).items()}

    monkeypatch.setattr(quantiles, "_sketch_ends", moved)
    got = select_ranks([(df, [Target(str(s), "part", share=s) for s in shares])], direct_limit=20, buckets=8)
    assert got == {str(s): brute(values, s) for s in shares}


def test_order_statistics_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert select_ranks([(df, [Target("q", "x", share=0.5)])]) == {}


def test_number_rows_with_a_hot_key(spark):
    rows = [(i if i % 3 else 0, i) for i in range(900)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(5)
    numbered = ranking.number_rows(df, ["k"]).collect()
    assert sorted(r.row_number for r in numbered) == list(range(1, 901))
    ordered = [r.k for r in sorted(numbered, key=lambda r: r.row_number)]
    assert ordered == sorted(ordered)
    plain = ranking.number_rows(df).collect()
    assert sorted(r.row_number for r in plain) == list(range(1, 901))


@pytest.mark.parametrize("n_first", [0, 1, 77, 300, 599, 600, 700])
def test_split_at_rank_is_exact_with_copies(spark, n_first):
    rows = [(0, "copy")] * 250 + [(1, f"v{i}") for i in range(150)] + [(i, "x") for i in range(2, 202)]
    df = spark.createDataFrame(rows, "k int, v string").repartition(4)
    first, rest = ranking.split_at_rank(df, ["k"], n_first, direct_limit=25, buckets=8)
    a, b = [tuple(r) for r in first.collect()], [tuple(r) for r in rest.collect()]
    assert len(a) == min(n_first, 600)
    assert sorted(a + b) == sorted(rows)
    again, _ = ranking.split_at_rank(df.repartition(3), ["k"], n_first)
    assert sorted(a) == sorted(tuple(r) for r in again.collect())


def test_split_exact_and_hash_are_partitions(spark):
    df = spark.range(1000).withColumn("text", F.concat(F.lit("t"), "id"))
    train, val = ranking.split_exact(df, ["id"], 0.05)
    assert (train.count(), val.count()) == (950, 50)
    assert train.unionByName(val).distinct().count() == 1000
    flagged = ranking.split_hash(df, ["id"], 0.05)
    small = ranking.split_hash(df.filter("id < 100"), ["id"], 0.05)
    assert 0 < ranking.split_hash(spark.range(2_000_000), ["id"], 0.000005).filter("is_val").count() < 30
    assert {r.id for r in small.filter("is_val").collect()} <= {r.id for r in flagged.filter("is_val").collect()}


def test_samples_are_reproducible(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    a = [r.id for r in ranking.sample_rows(df, 20, ["id"]).collect()]
    b = [r.id for r in ranking.sample_rows(df.repartition(7), 20, ["id"]).collect()]
    assert sorted(a) == sorted(b) and len(a) == 20
    per_group = ranking.sample_per_group(df, "g", 4, ["id"]).groupBy("g").count().collect()
    assert {r["count"] for r in per_group} == {4}


def test_replay_mix(spark):
    assert ranking.replay_count(80, 1000, 0.2) == 20 and ranking.replay_count(80, 5, 0.2) == 5
    domain = spark.range(80).withColumn("text", F.lit("d"))
    pool = spark.range(1000, 1500).withColumn("text", F.lit("p"))
    mixed = ranking.mix_replay(domain, pool, ["id"], 0.2)
    counts = {r.source_tag: r["count"] for r in mixed.groupBy("source_tag").count().collect()}
    assert counts == {"domain": 80, "replay": 20}
    assert mixed.filter("source_tag = 'replay' and id >= 1100").count() > 0


def test_cap_pairs_keeps_priority(spark):
    rows = [(f"q{i}", "a", "schema" if i < 30 else "row_level") for i in range(100)]
    qa = spark.createDataFrame(rows, "instruction string, response string, category string")
    counts = lambda cap: {r.category: r["count"] for r in ranking.cap_pairs(qa, cap, ("schema",)).groupBy("category").count().collect()}
    assert counts(200) == {"schema": 30, "row_level": 70}
    assert counts(50) == {"schema": 30, "row_level": 20}
    assert counts(10) == {"schema": 30}


def test_documents(spark):
    from tabulore.sources.registry import sample_documents

    docs = sample_documents(spark)
    assert docs.count() == 100
    once = corpus.dedup_exact(docs, ["doc_id"])
    assert sorted(r.doc_id for r in once.collect()) == [0, 1, 2, 3, 4]
    assert corpus.dedup_exact(once, ["doc_id"]).count() == 5
    train, val = corpus.prepare_documents(docs, "doc_id")
    assert (train.count(), val.count()) == (4, 1)
    lengths = spark.createDataFrame([("a" * n,) for n in (99, 100, 50000, 50001)], "text string")
    assert corpus.filter_by_length(lengths).count() == 2
    stats = corpus.corpus_stats(spark.createDataFrame([("abcd",), ("ab",)], "text string")).first()
    assert (stats.n_docs, stats.n_chars, stats.est_tokens, stats.avg_chars) == (2, 6, 1.5, 3.0)
    steps = corpus.funnel({"raw": docs, "dedup": once}).orderBy("step").collect()
    assert [(r.stage, r.n_before, r.n_after) for r in steps] == [("raw", 100, 100), ("dedup", 100, 5)]


def test_counting_aggregations_stay_small(spark, monkeypatch):
    """Quartiles of six columns: no aggregation of the counts holds more than a few of them, and all are found."""
    seen, united = [], quantiles.union_all

    def recorded(frames):
        frames = list(frames)
        seen.extend(f._jdf.queryExecution().analyzed().toString().count("count_if(") for f in frames)
        return united(frames)

    monkeypatch.setattr(quantiles, "union_all", recorded)
    df = spark.range(500, numPartitions=3).selectExpr(*[f"cast((id * {k + 3}) % 499 as double) as c{k}" for k in range(6)])
    targets = [Target(f"c{k} {share}", f"c{k}", share=share) for k in range(6) for share in (0.25, 0.75)]
    found = select_ranks([(df, targets)], direct_limit=20)
    rows = df.collect()
    assert found == {f"c{k} {share}": brute([r[k] for r in rows], share) for k in range(6) for share in (0.25, 0.75)}
    assert 0 < max(seen) <= 4 * quantiles.COUNTED
