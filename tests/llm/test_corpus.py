"""Operators that compare or gather texts and vectors."""

import itertools
import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import ROWS
from pyspark.sql import functions as F

from tabulore.llm import components, embedding_dedup, fingerprints, jaccard_join, packing, quality

TEXTS = "doc_id long, text string"


def near_copies(seed=5, groups=6):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(groups):
        base = draw.choices(vocabulary, k=draw.choice([6, 30, 80]))
        for _ in range(draw.choice([3, 15, 40])):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    common = draw.choices(vocabulary, k=14)
    texts += [" ".join(draw.choices(vocabulary, k=draw.randint(0, 3)) + common[: draw.randint(3, 14)]) for _ in range(60)]
    texts += [" ".join(draw.choices(vocabulary, k=draw.randint(0, 40))) for _ in range(40)]
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("leaf", [512, 12])
def test_jaccard_equals_brute_force(spark, monkeypatch, leaf):
    monkeypatch.setattr(jaccard_join, "LEAF_POINTS", leaf)
    monkeypatch.setattr(jaccard_join, "PART_POINTS", 16)
    rows = near_copies(groups=3 if leaf < 512 else 6)
    got = jaccard_join.jaccard_classes(spark.createDataFrame(rows, TEXTS).repartition(3))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute.jaccard(rows)


def test_jaccard_edges(spark, docs, no_docs):
    got = jaccard_join.jaccard_classes(docs.withColumn("n", F.lit(1)).withColumn("point", F.lit(2)))
    rows = Counter((r.doc_id, r.n_shingles, r.component_id) for r in got.collect())
    assert rows[(5, 6, 2)] == 2 and rows[(2, 6, 2)] == 1  # equal but for case, and a repeated row
    assert rows[(3, 0, 3)] == rows[(4, 0, 4)] == rows[(7, 0, 7)] == 1 and rows[(10, 1, 10)] == 1
    assert rows[(None, 3, None)] == 1 and sum(rows.values()) == len(ROWS)
    assert jaccard_join.jaccard_classes(no_docs).count() == 0
    kept = jaccard_join.one_of_each_class(docs)
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [2, 3, 4, 7, 8, 9, 10, 11, None]


def test_one_row_of_each_class_by_row(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    kept = lambda rows: sorted(map(tuple, jaccard_join.one_of_each_class(spark.createDataFrame(rows, "doc_id long, text string, _other int, `a.b` int")).collect()), key=str)
    assert kept([(1, a, 1, 1), (2, a, 1, 1), (2, b, 1, 1)]) == [(1, a, 1, 1), (2, b, 1, 1)]  # two texts share a key
    assert kept([(1, a, 1, 1), (1, a, 1, 1), (None, a, 1, 1)]) == [(1, a, 1, 1)]  # repeated rows and a null key
    assert kept([(None, a, 7, 1), (None, a, 7, 1)]) == [(None, a, 7, 1)]
    assert len(kept([(1, None, 1, 1), (1, None, 1, 1), (2, "", 1, 1)])) == 3  # no words: each row is its own class


def test_selection_by_row(spark):
    good = " ".join(f"w{i % 9}" for i in range(60))
    rows = [(i, good) for i in range(20)] + [(3, "zq xj " * 30), (None, good), (5, good)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_other", F.lit(1)).withColumn("draw", F.lit(2))
    labels = spark.createDataFrame([(i,) for i in range(10)], "doc_id long")
    decided = {r._draw: r.selected for r in quality._resample(frame, labels, "doc_id", "text", None, quality.SLACK, 100).collect()}
    drawn = frame.select("doc_id", "text", quality._draw(F.col("doc_id"), F.col("text")).alias("d")).collect()
    got = quality.selected_rows(frame, labels)
    assert got.columns == frame.columns
    want = Counter((r.doc_id, r.text) for r in drawn if decided[r.d])
    assert Counter((r.doc_id, r.text) for r in got.collect()) == want and want[(5, good)] == 2


def test_batches_of_equal_texts_in_another_order(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (2, b), (3, b), (4, a)]
    got = jaccard_join.jaccard_classes(spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), TEXTS))
    assert {r.doc_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 2, 4: 1}


@pytest.mark.parametrize("most", [jaccard_join.MOST_SLOTS, 64])
def test_copies_of_unlike_texts_are_counted_once(spark, monkeypatch, most):
    """Copies over many partitions bring no shingle back: all but the texts that share a passage own their shingles."""
    monkeypatch.setattr(jaccard_join, "MOST_SLOTS", most)
    texts = [" ".join(f"{i}x{k}" for k in range(40)) for i in range(30)] + [" ".join([f"s{k}" for k in range(40)] + [f"{i}t{k}" for k in range(8)]) for i in range(2)] + [None, ""]
    rows = [(c * len(texts) + i, x) for c in range(9) for i, x in enumerate(texts)]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), TEXTS)
    assert Counter(r.text for r in jaccard_join.distinct_texts(frame, "text").collect()) == Counter(texts)
    assert jaccard_join.distinct_texts(frame.limit(0), "text").count() == 0
    points = jaccard_join.shared_points(frame, "text", 5, 75, np.zeros(0, np.uint64), 3)
    assert points.count() == 2
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(frame).collect()}
    assert {got[i] for i, x in rows if x} == {i for i, x in enumerate(texts) if x}


def test_threshold_is_inclusive(spark):
    # n and n + 1 words share n - 4 of n - 3 shingles.
    for n, linked in ((7, True), (6, False)):
        words = [f"v{i}" for i in range(n + 1)]
        rows = [(1, " ".join(words)), (2, " ".join(words[:-1]))]
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_classes(spark.createDataFrame(rows, TEXTS)).collect()}
        assert (got[2] == 1) is linked


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randrange(80), draw.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 130)] + [(5, 5), (3, None)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.classes(200, [(a, b) for a, b in links if b is not None])
    linked = {x for a, b in links if b is not None and a != b for x in (a, b)}
    assert got == {i: want[i] for i in linked}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bounds_are_optimal():
    draw = random.Random(4)
    for _ in range(150):
        histogram = [(n, draw.randint(1, 9)) for n in draw.sample(range(40), draw.randint(1, 8))]
        lengths = [n for n, _ in histogram]
        cost = lambda bounds: sum(k * (min(b for b in bounds if b >= n) - n) for n, k in histogram)  # noqa: B023, E731
        for k in (1, 2, 3, 4):
            got = packing.optimal_bounds(histogram, k)
            best = min(cost((*c, max(lengths))) for r in range(k) for c in itertools.combinations(lengths, r))
            assert len(got) <= k and cost(got) == best
    assert packing.optimal_bounds([], 4) == []


def test_packing(spark, docs, no_docs):
    rows = packing.pack(docs.withColumn("bucket", F.lit("clash")), budget=60, buckets=3, carry=("lang",)).collect()
    assert Counter((r.doc_id, r.lang) for r in rows) == Counter((i, g) for i, _, g, _ in ROWS)
    by_batch = {}
    for r in rows:
        assert r.n_tokens <= r.bucket_length
        by_batch.setdefault((r.bucket, r.batch), []).append(r)
    for batch in by_batch.values():
        assert len(batch) == 1 or len(batch) * batch[0].bucket_length <= 60
        assert sorted(r.place for r in batch) == list(range(len(batch)))
    assert packing.pack(no_docs).count() == 0
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"))
    packed = packing.pack(many, budget=100, buckets=4)
    partial = packed.groupBy("bucket", "batch", "bucket_length").count().where("count < floor(100 / greatest(bucket_length, 1))")
    assert partial.groupBy("bucket").count().where("count > 1").count() == 0  # only the last batch of a bucket is not full


def test_fingerprints(spark, docs, no_docs):
    rows = near_copies(seed=8, groups=3) + [(1000, None), (1001, "")]
    got = {r.doc_id: r for r in fingerprints.edited_fingerprints(spark.createDataFrame(rows, TEXTS)).collect()}
    order = sorted(rows, reverse=True)
    texts = [t or "" for _, t in order]
    following = texts[1:] + texts[:1]
    edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, following, strict=True)]
    own, other, after = map(brute.sets_of, (texts, edited, following))
    errors = []
    for (i, _), text, a, b, c in zip(order, texts, own, other, after, strict=True):
        assert got[i].n_chars == len(text)
        likeness = lambda x, y: 1.0 if x == y else len(x & y) / len(x | y)
        errors += [got[i].near_edited - likeness(a, b), got[i].near_next - likeness(a, c)]
    assert np.sqrt(np.mean(np.square(errors))) < 0.05 and abs(np.mean(errors)) < 0.02
    assert got[1000].fingerprint == got[1001].fingerprint == ""
    repeated = fingerprints.edited_fingerprints(docs).collect()
    assert Counter(r.doc_id for r in repeated) == Counter(i for i, *_ in ROWS)
    assert len({r.fingerprint for r in repeated if r.doc_id in (2, 5)}) == 1
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    assert fingerprints.fingerprint(docs.withColumn("fingerprint", F.lit(1))).columns[-1] == "fingerprint"
    clash = ["_words", "_sorted", "_filled", "_bins", "_bits", "row", "bits"]
    got = fingerprints.fingerprint(docs.withColumns({c: F.lit(c) for c in clash}))
    assert got.columns == [*docs.columns, *clash, "fingerprint"]
    plain = Counter(r.fingerprint for r in fingerprints.fingerprint(docs).collect())
    assert Counter(r.fingerprint for r in got.collect()) == plain and all(r.bits == "bits" for r in got.collect())


def test_quality(spark, docs, no_docs):
    draw = random.Random(6)
    good = [(i, " ".join(draw.choices(["plain", "words", "about", "nothing", "much"], k=60))) for i in range(60)]
    bad = [(100 + i, " ".join(draw.choices(["$$$", "%%%x", "BUY!!", "###"], k=60))) for i in range(20)]
    bad += [(130 + i, "words " * 60) for i in range(5)]
    frame = spark.createDataFrame([*good, *bad, good[0], (None, "plain words"), (200, None), (201, "")], TEXTS)
    labelled = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,)], "doc_id long")
    rows = quality.resample(frame, labelled).collect()
    chosen = {r.doc_id for r in rows if r.selected}
    assert len(rows) == 89 and set(range(60)) | {None, 200, 201} == chosen
    assert len({r.sample_key for r in rows if r.doc_id == 0}) == 1
    kept = quality.selected_rows(frame, labelled)
    assert kept.count() == 64 and kept.columns == frame.columns
    assert sum(r.selected for r in quality.resample(frame, labelled, k=10).collect()) == 10
    assert quality.resample(docs, labelled.limit(0)).where("log_weight != 0").count() == 0
    assert quality.resample(no_docs, labelled).count() == 0


def test_gumbel_sample_follows_weights(spark):
    # 4000 rows of weight 1 and 4000 of weight e: of a small sample most but not all are of the second kind.
    frame = spark.range(8000).select((F.col("id") % 2).cast("double").alias("w"), "id")
    key = F.col("w") - F.log(-F.log((F.shiftrightunsigned(F.xxhash64("id", F.lit("gumbel")), 11).cast("double") + 0.5) * F.lit(2.0**-53)))
    frame = frame.withColumn("key", key)
    least = quality.kth_largest(frame, "key", 400)
    values = sorted((r.key for r in frame.select("key").collect()), reverse=True)
    assert least == values[399]
    share = frame.where(F.col("key") >= least).agg(F.avg("w")).first()[0]
    assert abs(share - np.e / (1 + np.e)) < 0.07


@pytest.mark.parametrize("part", [1024, 40])
def test_embeddings_equal_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(embedding_dedup, "PART_ROWS", part)
    draw = np.random.default_rng(3)
    centre = draw.standard_normal((4, 32))
    vectors = np.vstack([centre[i % 4] + 0.15 * draw.standard_normal(32) for i in range(200)] + [draw.standard_normal((100, 32))])
    rows = [(i, v.astype(np.float32).tolist(), i % 2) for i, v in enumerate(vectors)]
    rows += [(400, rows[0][1], 0), (401, rows[0][1], None), (402, None, 0), (403, [0.0] * 32, 0), (404, [float("nan")] + [1.0] * 31, 0),
             (405, [float("inf")] + [1.0] * 31, 0), (406, [None] + [1.0] * 31, 0), (407, [], 0), (408, [1.0, 2.0], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("point", F.lit(1))
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(frame).collect()}
    assert len(got) == len(rows)
    use = [(i, np.array(v, float) / np.linalg.norm(v), g) for i, v, g in rows if i <= 400]
    links = [(x, y) for x, y in itertools.combinations(range(len(use)), 2) if use[x][2] == use[y][2] and use[x][1] @ use[y][1] >= 0.93]
    found = sum(got[i].n_links for i, *_ in use)
    assert 0.97 * 2 * len(links) <= found <= 2 * len(links)
    classes = brute.classes(len(use), links)
    assert np.mean([got[i].component_id == use[classes[k]][0] for k, (i, *_) in enumerate(use)]) > 0.97
    assert got[400].n_links >= 1 and got[400].component_id == got[0].component_id
    for i in range(401, 409):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    nothing = embedding_dedup.near_vectors(frame.limit(0))
    assert nothing.count() == 0 and nothing.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_estimate_is_unbiased_and_bounded():
    draw = np.random.default_rng(1)
    turn = embedding_dedup.rotation(64, 0)
    units = draw.standard_normal((400, 64))
    units[200:] = units[:200] + 0.3 * draw.standard_normal((200, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes, factors = embedding_dedup.encode(units, turn)
    guess, error = embedding_dedup.estimate(codes, factors, units @ turn.T)
    off = (guess - units @ units.T)[~np.eye(400, dtype=bool)]
    assert abs(off.mean()) < 0.01
    wide = np.abs(guess - units @ units.T) > embedding_dedup.BOUND * error[:, None]
    assert wide[~np.eye(400, dtype=bool)].mean() < 1e-3
