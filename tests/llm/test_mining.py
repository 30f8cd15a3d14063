"""Phrases, hard negatives and URL filters."""

import math
import random
import re
import string
from collections import Counter

import pytest
from conftest import ROWS
from pyspark.sql import functions as F

from tabulore.llm import hard_negatives, phrases, url_filters

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def counted(rows, longest=3):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    return counts, totals


def collocations(rows, least, top, longest=3, within=50):
    counts, totals = counted(rows, longest)
    found, out = {x: a for x, a in counts.items() if a >= least and len(x[1]) > 1}, []
    for (lang, words), a in found.items():
        inside = (b for (other, long), b in found.items() if other == lang and len(long) > len(words)
                  and any(long[i : i + len(words)] == words for i in range(len(long) - len(words) + 1)))
        if any(100 * b >= within * a for b in inside):
            continue
        cuts = [(counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for k, (x, y) in enumerate(cuts))
        out.append((lang, score, a, " ".join(words), left, right))
    out.sort(key=lambda x: (x[0], -x[1], -x[2], x[3].encode()))
    ranks, rows = Counter(), []
    for lang, score, a, phrase, left, right in out:
        ranks[lang] += 1
        if ranks[lang] <= top:
            rows.append((lang, ranks[lang], phrase, a, left, right, totals[lang], score))
    return rows


def some_texts(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"{'Äw'[i % 2]}{i}" for i in range(30)] + ["en", "fr", "a'b", "\x00"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n", "\x0b", "! ", "?", ":", ";"]
    texts = []
    for _ in range(n):
        words = draw.choices(vocabulary[:8] if draw.random() < 0.5 else vocabulary, k=draw.randint(0, 60))
        texts.append("".join(x + draw.choice(ends) for x in words))
    return [(draw.choice(["en", "fr", None]), x) for x in texts]


@pytest.mark.parametrize(("block", "least", "top", "sample"), [(1 << 20, 3, 2000, 8), (97, 2, 20, 1_000_000)])
def test_collocations_equal_brute_force(spark, monkeypatch, block, least, top, sample):
    # The second case proposes nothing, so that every frequent phrase is a border failure.
    rows = some_texts(3, 80)
    if block < 100:  # so many groups that counts are packed twice
        monkeypatch.setattr(phrases, "BUCKET", 5000)
        monkeypatch.setattr(phrases, "RADIX", 4)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(df, least=least, top=top, sample=sample, block=block)
    assert sorted(map(tuple, got.collect())) == sorted(collocations(rows, least, top))


def test_longer_phrases(spark):
    rows = some_texts(4, 60)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(df, least=2, max_words=4, top=None)
    assert sorted(map(tuple, got.collect())) == sorted(collocations(rows, 2, 10**9, longest=4))


def test_blocks_cut_long_texts_without_loss():
    import numpy as np
    import pyarrow as pa

    rows = [("en", "a b. c d  e f g"), ("fr", ""), ("en", "x" * 50 + " y z"), (None, " \t"), ("fr", "en fr en")]
    batch = pa.record_batch({"lang": [x or "und" for x, _ in rows], "text": [x for _, x in rows]})
    for size in (1, 3, 7, 1000):
        counts = Counter()
        data, offsets = phrases.text_buffers(batch.column(1))
        for at, end, more in phrases._blocks(data, offsets, size, 2):
            low, high = int(np.searchsorted(offsets, at, "right")) - 1, int(np.searchsorted(offsets, more, "left"))
            inner = np.clip(offsets[low : high + 1], at, more) - at
            block = phrases.Words(data[at:more], inner, np.arange(low, high), np.arange(10, 20, dtype=np.uint64), end - at)
            for k in (1, 2, 3):
                begins = block.follow(k)
                begins[block.own :] = False
                places = np.flatnonzero(begins)
                found = block.phrases(places, k)[0].tobytes().decode().split("\n")[:-1]
                for text, phrase in zip(block.langs[places], found, strict=True):
                    counts[rows[text][0] or "und", tuple(phrase.split(" "))] += 1
        assert counts == counted(rows)[0]


def test_phrases_edges(spark, docs, no_docs):
    got = phrases.collocations(docs.withColumn("phrase", F.lit("x")).withColumn("n", F.lit(1)), least=2)
    rows = [(r[2], r[1]) for r in ROWS]
    assert sorted(map(tuple, got.collect())) == sorted(collocations(rows, 2, 2000))
    assert phrases.collocations(no_docs).count() == 0


def mined(rows, anchors, positives=5, negatives=3):
    fit = [(i, key, label, [math.floor(256 * x) for x in v]) for i, (key, v, label) in enumerate(rows)
           if key is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, key, label, v in fit:
        if not anchors(key):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), k, j, other) for j, k, other, w in fit if j != i and len(w) == len(v))
        for p, pk, _, _ in [x for x in scored if x[3] == label][:positives]:
            window = [(n, nk) for n, nk, _, other in scored if other != label and 50 * -p <= 100 * -n <= 95 * -p]
            out += [(key, pk, rank, nk, -p, -n) for rank, (n, nk) in enumerate(window[:negatives], 1)]
    return out


def some_vectors(seed, n, dims):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c, noise = draw.choice(centres), draw.choice([0.05, 0.4, 1.0])
        rows.append((i, [x + draw.gauss(0, noise) for x in c], draw.randrange(4)))
    return rows + [(n + i, list(rows[7][1]), i % 4) for i in range(40)]  # copies with ties


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("cell", [4096, 60])
def test_negatives_equal_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", cell)
    rows = some_vectors(1, 260, 40)
    got = hard_negatives.mine_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), anchors=F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(mined(rows, lambda k: k % 20 == 0))


def test_index_omits_dimensions_and_loses_no_pair():
    import numpy as np

    draw = np.random.default_rng(2)
    vectors = np.floor(draw.normal(0, 100, (300, 64)) * np.geomspace(4, 0.01, 64))
    anchors = vectors[:20]
    exact = anchors @ vectors.T
    least = float(np.quantile(exact, 0.97))
    index = hard_negatives.Index(vectors, hard_negatives.suffix_norms(vectors), least, float(np.linalg.norm(anchors, axis=1).max()))
    assert index.indexed.max(initial=0) < 64  # the last dimensions stand in no posting list
    i, j, scores = index.pairs(anchors, hard_negatives.suffix_norms(anchors), np.full(20, least))
    keep = scores >= least
    assert set(zip(i[keep], j[keep], strict=True)) == set(zip(*np.nonzero(exact >= least), strict=True))
    assert (scores == exact[i, j]).all()


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = some_vectors(5, 40, 3)
    rows += [(50, None, 1), (100, [1.0, None, 2.0], 1), (150, [nan, 1.0, 1.0], 1), (200, [inf, 0.0, 0.0], 1), (250, [1.0, 1.0, 1.0], None),
             (None, [1.0, 1.0, 1.0], 1), (300, [], 1), (301, [], 2), (302, [], 1), (350, [0.5, 0.25], 1), (351, [0.5, 0.5], 1), (352, [0.25, 0.5], 2)]
    rows += [rows[0], rows[0]]  # an anchor three times
    df = spark.createDataFrame(rows, VECTORS).withColumn("number", F.lit(1)).withColumn("wants", F.lit("x"))
    got = hard_negatives.mine_negatives(df, anchors=F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == sorted(mined(rows, lambda k: k % 50 == 0))
    assert hard_negatives.mine_negatives(spark.createDataFrame([], VECTORS)).count() == 0


def test_large_components_are_exact(spark):
    rows = [(0, [1e7, 1.0], 1), (1, [1e7, 1.0], 1), (2, [8e6, 1.0], 2), (3, [8e6, 1.0 + 1 / 256], 2)]
    got = hard_negatives.mine_negatives(spark.createDataFrame(rows, VECTORS), anchors=F.col("vec_id") == 0)
    whole = [[math.floor(256 * x) for x in v] for _, v, _ in rows]
    scores = [min((1 << 63) - 1, sum(a * b for a, b in zip(whole[0], w, strict=True))) for w in whole]
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(0, 1, 1, 3, scores[1], scores[3]), (0, 1, 2, 2, scores[1], scores[2])]


RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("Example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("org", "/fr/", "block"), ("a.b.org", "", "block"), ("", "/only", "block"), (None, "/", "block"), ("com", "/", "maybe"),
]
URLS = [
    "http://x.example.net/en/1", "http://x.example.net/en", "HTTP://X.EXAMPLE.NET/en/x1?y=/en/#z", "https://net/", "https://net", "http://net?x", "planet",
    "http://planet/", "ftp://example.com:80/de/", "http://sub.example.com/de/a/b#c", "http://example.com/DE/", "http://notexample.com/de/", "http://fr.org/fr/",
    "http://a.b.org", "http://b.org/x", "http://x.a.b.org/fr/9", "://", None, "", "no scheme", "http:///only/this", "http://É.ORG/fr/\n", "a://b://net/",
    "http://example.net./en/", "http://x.example.net/" + "en/" * 3000, "http://" + "a." * 3000 + "net/",
]


def judged(url):
    rest = (url or "").partition("://")[2]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = host.translate(FOLD)
    fitting = []
    for h, p, verdict in RULES:
        h = h and h.translate(FOLD)
        if h is not None and verdict != "maybe" and (host == h or host.endswith("." + h)) and path.startswith(p):
            fitting.append((len(h + p), len(h), verdict == "allow", h + p, verdict))
    return (host, path, *(max(fitting)[3:] if fitting else (None, "allow")))


@pytest.mark.parametrize("broadcast", [True, False])
def test_urls_equal_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(url_filters, "BROADCAST_ENTRIES", 3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i, x, "mine", 1) for i, x in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id long, url string, `path` string, `a.b` int")
    got = url_filters.judge_urls(pages, rules)
    assert got.columns == ["page_id", "url", "a.b", "host", "path", "rule", "verdict"]
    want = [(i, x, 1, *judged(x)) for i, x, _, _ in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert url_filters.judge_urls(pages.limit(0), rules).count() == 0
    alone = url_filters.judge_urls(pages.select("url"), rules.limit(0), default="block").collect()
    assert {(r.rule, r.verdict) for r in alone} == {(None, "block")} and len(alone) == len(rows)
