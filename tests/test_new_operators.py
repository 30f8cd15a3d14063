"""Overlaps of many tables, Gram matrices, subword masks, passages in place and the loss model, against plain versions."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabulore.operators import evals, gram, instruct, registry, relate, search, skyline, subwords
from tabulore.plans import verbalize
from tabulore.session import cut_lineage, stored_frames
from tabulore.sources.tables import TableSet

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def some_tables(spark, n):
    draw = random.Random(n)
    tables, values = {}, {}
    for i in range(n):
        held = set(draw.sample(range(40), 3)) if i % 5 else {1000 + i}  # every fifth shares nothing
        values[f"t{i:03}"] = held
        rows = [(v, "x", None if v % 2 else str(v)) for v in held] * 2 + [(None, None, None)]
        tables[f"t{i:03}"] = spark.createDataFrame(rows, "shared long, constant string, `odd name` string").coalesce(1)
    return TableSet(spark, tables), values


@pytest.mark.parametrize(("n", "planned", "skip"), [(9, 64, True), (9, 64, False), (9, 4, True)])
def test_overlap_equals_brute_force(spark, monkeypatch, n, planned, skip):
    monkeypatch.setattr(relate, "PLANNED", planned)
    tables, values = some_tables(spark, n)
    found = {(r.column, r.table_a, r.table_b): (r.n_a, r.n_b, r.n_overlap, r.pct_of_smaller) for r in relate.column_overlap(tables, skip).collect()}
    want, names = {}, sorted(values)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            for column, of in (("shared", lambda x: x), ("constant", lambda x: {"x"}), ("odd name", lambda x: {v for v in x if v % 2 == 0})):
                x, y = of(values[a]), of(values[b])
                if x & y:
                    want[column, a, b] = (len(x), len(y), len(x & y), 100.0 * len(x & y) / min(len(x), len(y)))
    assert found == want
    hopeful = relate.hopeful_holders(tables)
    assert {(c, t) for (c, a, b) in want for t in (a, b)} <= hopeful and ("shared", "t000") not in hopeful


def test_overlap_without_shared_columns(spark):
    one = TableSet(spark, {"a": spark.range(3)})
    assert relate.column_overlap(one).count() == 0
    empty = TableSet(spark, {"a": spark.range(0), "b": spark.range(0)})
    assert relate.column_overlap(empty).count() == 0


def test_gram_equals_numpy(spark, monkeypatch):
    draw = np.random.default_rng(1)
    rows, columns = 400, 70  # more than one block of columns
    data = draw.normal(1e6, 1, (rows, columns)) + draw.normal(0, 1, (rows, 1))
    data[draw.random(data.shape) < 0.1] = np.nan
    data[:, 3] = 5.0
    data[:, 4] = np.nan
    data[0, 4] = 1.0
    frame = spark.createDataFrame([tuple(None if i % 7 == 0 and math.isnan(v) else float(v) for v in x) for i, x in enumerate(data)],
                                  ", ".join(f"c{i} double" for i in range(columns))).repartition(5)
    got = {(r.a, r.b): (r.n, r.r) for r in gram.correlations(frame, [f"c{i}" for i in range(columns)], [1e6] * columns).collect()}
    assert len(got) == columns * (columns - 1) // 2
    for (a, b), (n, r) in got.items():
        both = ~np.isnan(data[:, a]) & ~np.isnan(data[:, b])
        assert n == both.sum()
        if {a, b} & {3, 4}:
            assert r is None
        else:
            assert abs(r - np.corrcoef(data[both, a], data[both, b])[0, 1]) < 1e-9
    assert gram.correlations(frame.limit(0), ["c0", "c1"], [0.0, 0.0]).count() == 0


TEXTS = [
    (1, "<s>[INST] How many? [/INST] Five thousand, naïve über-answers 🙂</s>"), (2, "no instruction here"), (3, ""), (4, None),
    (5, "[INST] a [/INST]"), (6, "x " * 3000 + "[/INST] y"), (7, "[/INST][/INST] twice"), (7, "[/INST][/INST] twice"),
]


@pytest.mark.parametrize("max_len", [8, 1024])
def test_subword_masks_equal_brute_force(spark, max_len):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    frame = spark.createDataFrame(TEXTS, "id long, text string").withColumn("labels", F.lit("clash"))
    got = subwords.subword_masks(frame, PATH, max_len)
    assert got.columns == ["id", "text", "n_tokens", "n_masked", "n_trainable", "labels"]
    want = []
    for i, text in TEXTS:
        found = library.encode(text or "", add_special_tokens=False)
        head = (text or "").find("[/INST]") + len("[/INST]") if "[/INST]" in (text or "") else 0
        labels = [instruct.IGNORED_LABEL if begin < head else token for token, (begin, _) in zip(found.ids, found.offsets, strict=True)][:max_len]
        masked = labels.count(instruct.IGNORED_LABEL)
        want.append((i, text, len(labels), masked, len(labels) - masked, labels))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_subword_budget_equals_brute_force(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    frame = spark.createDataFrame([(t, "a b"[2 * (i % 2)]) for i, t in TEXTS], "text string, `a group` string")
    got = {r["a group"]: r for r in subwords.subword_budget(frame, PATH, 10, by=["a group"]).collect()}
    for group in "ab":
        sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for i, t in TEXTS if "a b"[2 * (i % 2)] == group]
        r = got[group]
        assert (r.n_docs, r.n_tokens, r.n_kept, r.n_truncated) == (len(sizes), sum(sizes), sum(min(x, 10) for x in sizes), sum(x > 10 for x in sizes))
        assert abs(r.pct_truncated - 100 * r.n_truncated / len(sizes)) < 1e-9
    whole = subwords.subword_budget(frame.limit(0), PATH).first()
    assert (whole.n_docs, whole.n_tokens, whole.pct_truncated) == (0, 0, None)


@pytest.mark.parametrize(("rows", "size", "parts"), [(23, 5, 4), (25, 5, 3), (7, 1, 2), (3, 5, 7), (0, 5, 1)])
def test_groups_are_closed_in_place(spark, rows, size, parts):
    lines = spark.range(1, rows + 1, numPartitions=parts).select(F.col("id").alias("row"), F.concat(F.lit("line "), "id").alias("text"))
    closed, apart = verbalize.closed_groups(lines, size, rows)
    found = {r.passage_id: r.lines for r in closed.collect()}
    rest = {}
    for r in apart.collect():
        rest.setdefault(r.passage_id, []).append((r.row, r.text))
    assert not set(found) & set(rest)
    found |= {k: [t for _, t in sorted(v)] for k, v in rest.items()}
    assert found == {g: [f"line {i}" for i in range(g * size + 1, min((g + 1) * size, rows) + 1)] for g in range(-(-rows // size))}
    assert len(rest) <= 2 * parts  # only groups at borders travel


@pytest.mark.parametrize("share", [1000, 2])
def test_unigram_losses_equal_brute_force(spark, share):
    draw = random.Random(3)
    texts = lambda n: [(i, " ".join(draw.choices(["the"] * 5 + [f"w{j}" for j in range(30)], k=draw.randint(0, 20)))) for i in range(n)]
    train, evaluated = texts(40), texts(25) + [(100, None), (101, "unseen words only")]
    seen = Counter(w for _, t in train for w in t.split())
    total = sum(seen.values()) + len(seen) + 1
    frames = [spark.createDataFrame(x, "id long, text string") for x in (train, evaluated)]
    got = {r.id: (r.n_tokens, r.loss) for r in evals.unigram_losses(*frames, "id", heavy_share=share).collect()}
    want = {i: t.split() for i, t in evaluated if t and t.split()}
    assert set(got) == set(want)
    for i, tokens in want.items():
        loss = -sum(math.log((seen[w] + 1) / total) for w in tokens) / len(tokens)
        assert got[i][0] == len(tokens) and abs(got[i][1] - loss) < 1e-9


@pytest.mark.parametrize("shape", ["ties", "wide front"])
def test_pareto_front_equals_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(skyline, "BLOCK", 50)  # many blocks
    draw = random.Random(4)
    rows = []
    for i in range(1500):
        x, y = draw.random(), draw.gauss(0, 1)
        if shape == "ties":
            x, y = round(x, 1), draw.choice([round(y, 1), None, math.nan, math.inf, -0.0, 0.0])
        # On the wide front a better x costs z, so that most rows stay.
        rows.append((i, x, y, -x * 1e6 if shape == "wide front" else float(draw.randint(0, 3))))
    df = spark.createDataFrame(rows, "number long, `a.b` double, costs double, row double").repartition(5)
    got = sorted(r.number for r in skyline.pareto_front(df, ["a.b", "row"], ["costs"]).collect())
    fine = [r for r in rows if r[2] is not None and math.isfinite(r[2])]
    beats = lambda p, q: p[1] <= q[1] and p[2] >= q[2] and p[3] <= q[3] and p[1:] != q[1:]
    assert got == [q[0] for q in fine if not any(beats(p, q) for p in fine)]
    assert shape == "ties" or len(got) > 1000
    assert skyline.pareto_front(df.limit(0), ["costs"]).columns == df.columns and skyline.pareto_front(df.limit(0), ["costs"]).count() == 0
    with pytest.raises(ValueError, match="measure"):
        skyline.pareto_front(df)


def test_version_wins_are_the_sums_of_all_pairs(spark):
    draw = random.Random(6)
    versions = [
        (f"m{i // 3}", i % 3 + 1, "Staging", {m: float(draw.randint(0, 4)) for m in ("f1", "rmse", "r2") if draw.random() < 0.8} | {f"own{i}_loss": 1.0})
        for i in range(40)
    ]
    mm = registry.model_metrics(spark.createDataFrame(versions, "name string, version int, stage string, metrics map<string,double>"))
    want = Counter()
    for p in registry.pairwise_all(mm).collect():
        for key, won, lost in (((p.name_a, p.version_a), p.wins_a, p.wins_b), ((p.name_b, p.version_b), p.wins_b, p.wins_a)):
            want.update({(key, "duels"): p.n_shared, (key, "won"): won, (key, "lost"): lost, (key, "tied"): p.ties})
    got = Counter()
    for r in registry.version_wins(mm).collect():
        got.update({((r.name, r.version), k): v for k, v in (("duels", r.n_duels), ("won", r.wins), ("lost", r.losses), ("tied", r.ties))})
    assert +got == +want


def test_search_with_and_without_index(spark, monkeypatch):
    draw = random.Random(7)
    text = lambda: draw.choice([None, "", "".join(draw.choices("abcÀÉ \n😀", k=draw.randint(1, 60)))])
    rows = [(text(), text(), i) for i in range(400)]
    df = spark.createDataFrame(rows, "instruction string, response string, row long").repartition(3)
    index = search.TrigramIndex.build(df, ["instruction", "response"])
    for few in (1000, 3):  # rows read by number, rows read by a join
        monkeypatch.setattr(search, "FEW_ROWS", few)
        for term in ("a", "", "AB", "abc", "àé", "c\na", "😀a b", "b😀", "abcabcabcabcabcabcabcabc", "c" * 70):
            wanted = sorted(r.row for r in instruct.search_qa(df, term, 1000).collect())
            assert sorted(r.row for r in index.search(term).collect()) == wanted
    order = ["instruction", "response", "row"]
    assert index.search("ca", 5, order).collect() == instruct.search_qa(df, "ca", 5, order).collect()
    assert search.TrigramIndex.build(df.limit(0), ["response"]).search("abc").count() == 0


def test_stored_frames_are_deleted(spark, tmp_path):
    with stored_frames(spark):
        kept = cut_lineage(spark.range(5))
        with stored_frames(spark):
            inner = cut_lineage(spark.range(3))
            assert inner.count() == 3
        assert not inner_files(spark, inner) and inner_files(spark, kept) and kept.count() == 5
    assert not inner_files(spark, kept)


def inner_files(spark, df):
    path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0])
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def test_cells_of_an_overlap_are_moved_once(spark):
    """70 tables, so two words of bits; every other value is NULL or comes twice."""
    holds = {f"t{i:02d}": {v for v in range(40) if (v * 7 + i) % (i % 9 + 2) == 0} for i in range(70)}
    values = lambda found: [(v,) for v in found] + [(v,) for v in found if v % 2] + [(None,)]
    frames = {name: spark.createDataFrame(values(found), "id long") for name, found in holds.items()}
    overlap = relate.column_overlap(TableSet(spark, frames))
    got = {(r.table_a, r.table_b): (r.n_a, r.n_b, r.n_overlap) for r in overlap.collect()}
    names = sorted(holds)
    want = {
        (a, b): (len(holds[a]), len(holds[b]), len(holds[a] & holds[b]))
        for i, a in enumerate(names) for b in names[i + 1 :] if holds[a] & holds[b]
    }
    assert got == want
    plan = overlap._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation [id" not in plan and "LogicalRDD [id" not in plan  # the tables are not read again


def test_masks_hold_few_python_objects(spark, monkeypatch):
    """Texts are encoded some bytes at a time, at any place of the cuts, and the labels of a batch are no Python lists."""
    from pyspark.sql.types import ArrayType

    monkeypatch.setattr(subwords, "BATCH_BYTES", 7)
    texts = pa.array(["", None, "naïve", "a b c d e f g h", "x", "", "y z"])
    assert [(t, len(e)) for t, e in subwords._encoded(texts.slice(1), PATH)] == [
        (t, len(subwords._tokenizer(PATH).encode(t, add_special_tokens=False))) for t in ["", "naïve", "a b c d e f g h", "x", "", "y z"]]
    masked = subwords.subword_masks(spark.createDataFrame(TEXTS, "id long, text string"), PATH, 8)
    assert "ArrowEvalPython" in masked._jdf.queryExecution().executedPlan().toString()
    assert isinstance(masked.schema["labels"].dataType, ArrayType)


def test_pieces_of_a_batch_are_bounded(monkeypatch):
    monkeypatch.setattr(verbalize, "PIECE_BYTES", 10)
    texts = ["a" * n for n in (3, 3, 5, 40, 0, 0, 10, 1)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(1, 10), pa.int64()), pa.array(texts)], names=["row", "text"])
    pieces = [p["text"].to_pylist() for p in verbalize._pieces(iter([batch.slice(0, 0), batch.slice(1)]))]
    assert [t for p in pieces for t in p] == texts[1:]
    assert all(len(p) == 1 or sum(len(t or "") for t in p) <= 10 for p in pieces) and len(pieces) > 3
