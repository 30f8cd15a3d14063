"""Operators that look at one text at a time."""

import hashlib
import random
import textwrap
from collections import Counter

import numpy as np
import pyarrow as pa
from conftest import LONG, ROWS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabulore.llm import bpe, language_id, licenses, line_dedup, shingles, token_counts

BYTES = "/opt/tokenizers/byte_bpe_50k.json"
WORDS = "/opt/tokenizers/word_bpe_49k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SIGNS = ["a", "B", "é", "é", " ", " ", " ", "\n", "\t", "\x1c", "\x85", "<|endoftext|>", "<|startoftext|>", "'s", "'", "9",
         "Σ", "İ", "$$", "中", "\x0b", "I'LL", "<|", "\x00", "the", "tion", "\r\n"]


def mixtures(n, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choices(SIGNS, k=draw.randint(0, 14))) for _ in range(n)] + ["", " ", "a ", LONG]


def test_bpe_equals_library():
    texts, library = mixtures(3000), Tokenizer.from_file(BYTES)
    own = bpe.Bpe(open(BYTES).read())
    for text, ids in zip(texts, own.encode(pa.array(texts)), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want
        assert own.decode(ids).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def test_bpe_frames(docs, no_docs):
    coded = bpe.decode(bpe.encode(docs.withColumn("ids", F.lit("clash")), BYTES), BYTES)
    assert coded.columns == ["doc_id", "text", "lang", "source", "ids", "decoded"]
    assert Counter((r.text or "") for r in coded.collect()) == Counter(r.decoded for r in coded.collect())
    rows = bpe.round_trip_digests(docs, BYTES).collect()
    assert len(rows) == len(ROWS)
    none = hashlib.sha256(b"").hexdigest()
    assert [(r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows if r.doc_id in (3, 4)] == [(0, none, none)] * 2
    assert bpe.encode(no_docs, BYTES).count() == bpe.round_trip_digests(no_docs, BYTES).count() == 0


def test_bpe_null_ids(spark):
    assert bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), BYTES).select("decoded").collect() == [(None,), ("",)]


def test_token_counts_equal_library():
    texts, known = mixtures(5000), token_counts.word_counts(open(WORDS).read())
    want = [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]
    assert token_counts.text_token_counts(pa.array(texts), known).tolist() == want
    assert token_counts.text_token_counts(pa.array(texts).slice(7, 50), known).tolist() == want[7:57]


def test_long_text_is_cut(monkeypatch):
    known = token_counts.word_counts(open(WORDS).read())
    texts = ["alpha beta", LONG[:999], None, "x" * 700, ""]
    whole = token_counts.text_token_counts(pa.array(texts), known).tolist()
    monkeypatch.setattr(token_counts, "byte_blocks", lambda d, o: shingles.byte_blocks(d, o, 64))
    assert token_counts.text_token_counts(pa.array(texts), known).tolist() == whole


def test_token_count_frame(docs, no_docs):
    rows = token_counts.count_tokens(docs.withColumn("n_tokens", F.lit("clash")), WORDS, limit=100).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in rows) == Counter((i, len((t or "").encode())) for i, t, *_ in ROWS)
    assert {r.doc_id for r in rows if r.over_limit} == {8}
    assert token_counts.count_tokens(no_docs, WORDS).count() == 0


def test_licenses(spark, no_docs):
    mit = licenses.FULL_TEXTS[1][1]
    rows = [
        (1, mit.replace("MIT License\n", "mit  licence\nCopyright (c) 2020 Some Body\n")),
        (2, mit + " and more"),
        (3, "Story.\nReleased under the MIT License.\nLicensed under the Apache License, v2.0\n"),
        (3, "Story.\nReleased under the MIT License.\nLicensed under the Apache License, v2.0\n"),
        (4, None), (5, ""), (None, "(c) 1999 Nobody"), (6, "We licensed it under the MIT License once."),
        (7, 'CC-BY-NC 4.0'),
    ]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").withColumn("raw", F.lit(1)))
    found = Counter((r.doc_id, r.text_license, ",".join(r.line_licenses)) for r in got.collect())
    assert found == Counter({
        (1, "MIT", "MIT"): 1, (2, None, "MIT"): 1, (3, None, "Apache-2.0,MIT"): 2, (4, None, ""): 1, (5, None, ""): 1,
        (None, None, ""): 1, (6, None, ""): 1, (7, "CC-BY-NC-4.0", "CC-BY-NC-4.0"): 1,
    })
    assert licenses.scan_licenses(no_docs).count() == 0


def test_licenses_in_wrapped_lines(spark):
    rows = [
        (i * 100 + width, "Copyright Some Body, 2020\n\n" + "\n\n".join(textwrap.fill(x, width) for x in text.split("\n\n")))
        for i, (_, text) in enumerate(licenses.FULL_TEXTS) for width in range(60, 81)
    ]
    want = {k: licenses.FULL_TEXTS[k // 100][0] for k, _ in rows}
    heads = ("Copyright 2020\nLicense", "Copyright holder: A, 2020", "Copyright 2020 Law Office", "© A")  # three notices, "License" stays
    rows += [(-1 - i, f"{head}\n\n{licenses.FULL_TEXTS[0][1]}") for i, head in enumerate(heads)]
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text_license for r in got.collect()} == want | {-1: None, -2: "MIT", -3: "MIT", -4: "MIT"}


def test_line_dedup(spark, no_docs):
    head = "Site menu"
    rows = [(i, f"{head}\nstory {i}\n\n{head} \nend", "h") for i in range(10)]
    rows += [(20, None, "h"), (21, "", "h"), (22, head, "h"), (23, f"{head}\nx", None), (24, f"{head}\nx", "lone"), (0, rows[0][1], "h")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_dropped", F.lit("clash"))
    got = line_dedup.drop_boilerplate(frame, ratio=0.6)
    texts = {(r.doc_id, r.text, r.n_dropped) for r in got.collect()}
    assert got.count() == len(rows)
    assert (3, "story 3\n", 2) in texts or (3, "story 3\n\nend", 2) in texts or (3, "story 3\n", 3) in texts
    assert {(20, None, 0), (21, "", 0), (22, "", 1), (23, f"{head}\nx", 0), (24, f"{head}\nx", 0)} <= texts
    assert line_dedup.drop_boilerplate(no_docs).count() == 0
    shares = {(r.host, r.pages, r.host_pages) for r in line_dedup.line_frequencies(frame).collect()}
    assert ("h", 12, 14) in shares and ("lone", 1, 1) in shares


def test_line_dedup_and_clashing_names(spark):
    rows = [(i, f"menu\nown line {i}", "a", i, -i, f"x{i}") for i in range(6)]
    names = ["doc_id", "text", "source"]
    for clash in (["_host", "_salt", "_boilerplate"], ["host", "salt", "boilerplate"], ["row", "of", "clean"], ["dropped", "page_salt", "a.b"]):
        got = line_dedup.drop_boilerplate(spark.createDataFrame(rows, names + clash))
        assert got.columns == [*names, *clash, "n_dropped"]
        assert sorted(map(tuple, got.collect())) == [(i, f"own line {i}", "a", i, -i, f"x{i}", 1) for i in range(6)]


def all_segmentations(word, chance, unknown):
    if not word:
        return 1.0
    total = 0.0
    for n in range(1, len(word) + 1):
        p = chance.get(word[:n], unknown if n == 1 else 0.0)
        total += p * all_segmentations(word[n:], chance, unknown) if p else 0.0
    return total


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "ab", "b", "▁abc", "bca", "c"]
    chances = np.random.default_rng(0).random((len(pieces) + 1, 2)) / 10
    words = ["abcab", "a", "zab", "é", "cabcabc", "b" * 60]
    got = language_id.word_log_likelihoods(words, language_id.Pieces(pieces), chances)
    for i, word in enumerate(words[:-1]):
        for j in range(2):
            want = all_segmentations("▁" + word, dict(zip(pieces, chances[:, j], strict=False)), chances[-1, j])
            assert abs(got[i, j] - np.log(want)) < 1e-9
    lattice = language_id.Lattice(words[:4], language_id.Pieces(pieces))
    uses = lattice.expected_counts(chances, np.ones((4, 2)))
    sizes = np.array([len(p) for p in pieces] + [1])
    assert np.allclose(sizes @ uses, sum(len(w) + 1 for w in words[:4]))


def test_language_id(spark, docs, no_docs):
    draw = random.Random(1)
    words = {"en": ["the", "and", "house", "water", "through"], "de": ["und", "straße", "wasser", "durch", "haus"]}
    rows = [(i, " ".join(draw.choices(words[k], k=20)), k) for i, k in enumerate(["en", "de"] * 30)] + [(99, "x", None), (98, None, "en")]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PIECES)
    assert model.languages == ["de", "en"]
    test = spark.createDataFrame(
        [(1, "Durch das HAUS"), (2, "the water house"), (3, None), (4, "123 !!"), (5, ""), (6, "— …")], "doc_id long, text string")
    got = {r.doc_id: r for r in language_id.identify(test.withColumn("score", F.lit("clash")), model).collect()}
    assert [got[i].lang_pred for i in range(1, 7)] == ["de", "en", "und", "und", "und", "und"]
    assert got[1].score > 0.9 and got[3].score == 0
    # A typographic apostrophe ends a word in scoring as in fitting, and long runs of letters are read whole.
    pairs = [(1, "the’water’house’through"), (2, "the'water'house'through"), (3, "wasser" * 40 + "the"), (4, "wasser" * 40)]
    pairs = {r.doc_id: r for r in language_id.identify(spark.createDataFrame(pairs, "doc_id long, text string"), model).collect()}
    assert pairs[1].score == pairs[2].score and pairs[1].lang_pred == "en" and pairs[3].score != pairs[4].score or pairs[4].score == 1
    assert language_id.word_parts(["a" * 100, "b"]) == (["a" * 48, "a" * 48, "aaaa", "b"], [0, 0, 0, 1])
    assert language_id.identify(docs, model).count() == len(ROWS)
    empty = language_id.fit(no_docs, PIECES)
    assert empty.languages == [] and {r.lang_pred for r in language_id.identify(docs, empty).collect()} == {"und"}
    assert language_id.identify(no_docs, model).count() == 0
