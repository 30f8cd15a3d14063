import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from checks import queries
from tabulore.operators import duels
from tabulore.operators import registry as reg
from tabulore.plans import prompts, qa_registry
from tabulore.sources import registry as src

LOAF, ROLL, RYE = "bread_loaf", "bread_roll", "bread_rye"


@pytest.fixture(scope="module")
def versions(spark):
    return src.sample_registry(spark)


@pytest.fixture(scope="module")
def mm(versions):
    return reg.model_metrics(versions)


def test_best_per_metric(mm):
    ranked = reg.rank_metrics(mm)
    best = {r.metric: (r["name"], r.version) for r in reg.best_per_metric(ranked).collect()}
    assert best == {"mae": (RYE, 2), "accuracy": (RYE, 2), "latency_ms": (LOAF, 1)}
    winner = reg.overall_winner(ranked).first()
    assert (winner["name"], winner.version, winner.wins, winner.n_metrics) == (RYE, 2, 2, 3)
    rows = [r for r in ranked.collect() if r.metric == "latency_ms"]
    assert sorted(r.rank for r in rows) == [1, 2, 3, 4, 5, 6] and {r.n_models for r in rows} == {6}
    # 3, 6, 6, 9, 9 and 12 ms: holders of one value share their place from the end.
    assert sorted((r.value, r.worst_rank) for r in rows) == [(3.0, 6), (6.0, 4), (6.0, 4), (9.0, 2), (9.0, 2), (12.0, 1)]


def test_production_risk_is_first_by_name(mm):
    risk = reg.production_risk(reg.rank_metrics(mm)).collect()
    assert [(r["name"], r.metric, r.value) for r in risk] == [(LOAF, "accuracy", 0.6)]


def test_direction_by_substring_and_token(spark):
    df = spark.createDataFrame([(m,) for m in ("mape", "val_loss", "training_time", "r2", "swap")], "m string")
    whole = [r[0] for r in df.select(reg.direction(F.col("m"))).collect()]
    assert whole == ["lowest", "lowest", "lowest", "highest", "highest"]
    accuracy = [r[0] for r in df.select(reg.name_has(F.col("m"), reg.HIGHER_IS_BETTER, "substring")).collect()]
    assert accuracy == [True, False, False, True, True]
    tokens = [r[0] for r in df.select(reg.name_has(F.col("m"), reg.HIGHER_IS_BETTER)).collect()]
    assert tokens == [False, False, False, True, False]
    times = spark.createDataFrame([("sentiment_f1", ), ("fit_time",)], "m string")
    assert [r[0] for r in times.select(reg.name_has(F.col("m"), reg.LATENCY_HINTS)).collect()] == [False, True]


def test_pairwise_ties(spark):
    rows = [("a", 1, "None", "", None, {"rmse": 1.0, "f1": 0.5}, {}, {}), ("b", 1, "None", "", None, {"rmse": 1.0, "f1": 0.4}, {}, {})]
    mm = reg.model_metrics(spark.createDataFrame(rows, src.MODEL_VERSION_SCHEMA))
    pairs = reg.neighbours(mm)
    apart, second = reg.pairwise_models(mm, pairs).first(), reg.pairwise_models(mm, pairs, tie="second").first()
    assert (apart.wins_a, apart.wins_b, apart.ties) == (1, 0, 1)
    assert (second.wins_a, second.wins_b) == (1, 1)


@pytest.mark.parametrize("block", [2, 128])
def test_every_two_versions_are_compared(mm, monkeypatch, block):
    monkeypatch.setattr(reg, "PAIR_BLOCK", block)
    versions = sorted((r["name"], r.version) for r in mm.select("name", "version").distinct().collect())
    pairs = [(*a, *b) for i, a in enumerate(versions) for b in versions[i + 1 :]]
    named = mm.sparkSession.createDataFrame(pairs, "name_a string, version_a int, name_b string, version_b int")
    for tie in ("apart", "second"):
        got = [tuple(r) for r in reg.pairwise_all(mm, tie).collect()]
        assert sorted(got) == sorted(tuple(r) for r in reg.pairwise_models(mm, named, tie).collect())
    assert len(got) == len(pairs) > len(versions)
    texts = qa_registry.qa_model_comparison(mm).filter("template_id = 'pairwise'")
    assert texts.count() == len(pairs)


def test_pairs_are_compared_by_columns(spark, monkeypatch):
    """NaN, zeros of both signs, NULL values and names, sparse metrics: as by the joins, without a lambda for each pair."""
    monkeypatch.setattr(reg, "PAIR_BLOCK", 3)
    nan = float("nan")
    values = [
        {"rmse": 1.0, "f1": nan}, {"rmse": nan, "f1": 0.5}, {"rmse": nan, "z": 0.0}, {"z": -0.0, "f1": nan}, {"f1": 0.5, "é": 1.0},
        {"é": 0.25, "A": 7.0}, {}, {"rmse": float("inf"), "f1": float("-inf"), "A": 12345.678}, {"alone": 1.0},
    ]
    rows = [(f"v{i}", i % 2, "None", "", None, x, {}, {}) for i, x in enumerate(values)]
    mm = reg.model_metrics(spark.createDataFrame(rows, src.MODEL_VERSION_SCHEMA))
    mm = mm.withColumn("value", F.when((F.col("name") != "v0") | (F.col("metric") != "rmse"), F.col("value")))
    versions = sorted((r["name"], r.version) for r in mm.select("name", "version").distinct().collect())
    named = spark.createDataFrame(
        [(*a, *b) for i, a in enumerate(versions) for b in versions[i + 1 :]], "name_a string, version_a int, name_b string, version_b int")
    for tie in ("apart", "second"):
        got, want = reg.pairwise_all(mm, tie), reg.pairwise_models(mm, named, tie)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        bare = reg.pairwise_all(mm, tie, columns=())
        assert sorted(map(str, bare.collect())) == sorted(map(str, want.drop("metrics").collect()))
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    texts = [sorted(tuple(r) for r in qa_registry.qa_model_comparison(mm, of).filter("template_id = 'pairwise'").collect()) for of in (None, named)]
    assert texts[0] == texts[1] and len(texts[0]) == want.count()
    nameless = mm.withColumn("name", F.when(F.col("name") != "v1", F.col("name")))
    assert reg.pairwise_all(nameless).count() == want.count()
    with pytest.raises(Exception, match="a metric twice"):
        reg.pairwise_all(mm.union(mm))


@pytest.mark.parametrize("block", [4, 128])
def test_versions_with_the_same_metrics_are_compared_whole(spark, monkeypatch, block):
    """Pieces of cells in which all versions record the same metrics, names that are null, metrics with two directions."""
    monkeypatch.setattr(reg, "PAIR_BLOCK", block)
    monkeypatch.setattr(duels, "PIECE", 25)
    nan = float("nan")
    rows = [(f"v{i:02d}", i % 3, "None", "", None, {"rmse": [1.0, nan, -0.0, 0.0, 0.5][i % 5], "f1": i % 4 / 3, "é;": float(i % 2)}, {}, {}) for i in range(14)]
    mm = reg.model_metrics(spark.createDataFrame(rows, src.MODEL_VERSION_SCHEMA))
    mm = mm.withColumn("direction", F.when((F.col("metric") == "f1") & (F.col("version") == 1), "lowest").otherwise(F.col("direction")))
    versions = sorted((r["name"], r.version) for r in mm.select("name", "version").distinct().collect())
    named = spark.createDataFrame(
        [(*a, *b) for i, a in enumerate(versions) for b in versions[i + 1 :]], "name_a string, version_a int, name_b string, version_b int")
    for tie in ("apart", "second"):
        want = reg.pairwise_models(mm, named, tie)
        assert sorted(map(str, reg.pairwise_all(mm, tie).collect())) == sorted(map(str, want.collect()))
    for of in (mm, mm.withColumn("value", F.when((F.col("name") != "v03") | (F.col("metric") != "f1"), F.col("value")))):
        texts = [sorted(tuple(r) for r in qa_registry.qa_model_comparison(of, x).filter("template_id = 'pairwise'").collect()) for x in (None, named)]
        assert texts[0] == texts[1] and len(texts[0]) == want.count()
    shown = mm.withColumn("a_or_b", F.when(F.col("name") != "v03", F.lit("x")))
    parts = reg.pairwise_all(shown, columns=["a_or_b"], template="<{a_or_b_b}{metric}{a_or_b_a}>").filter("name_a = 'v02' and name_b < 'v05'").collect()
    assert {r.name_b: r.parts for r in parts} == {"v03": "", "v04": "<xf1x>; <xrmsex>; <xé;x>"}
    nameless = mm.withColumn("name", F.when(F.col("name") != "v01", F.col("name")))
    assert reg.pairwise_all(nameless).count() == want.count()


def test_pairwise_models_runs_the_whole_comparison(mm, monkeypatch):
    """Cells list the values they compare, as reg.pairwise_models does; the query shows the counts."""
    monkeypatch.setattr(queries, "metric_rows", lambda spark, sf_dir: mm)
    listed, cells = [], duels.compare_cells
    monkeypatch.setattr(reg, "compare_cells", lambda tie, columns, *rest: listed.append(tuple(columns)) or cells(tie, columns, *rest))
    got = {name: queries.QUERIES[name](mm.sparkSession, "") for name in ("pairwise_models", "pairwise_all")}
    assert listed == [("value",), ()]
    assert got["pairwise_models"].columns == got["pairwise_all"].columns
    assert sorted(got["pairwise_models"].collect()) == sorted(got["pairwise_all"].collect())


def test_versions_move_once_for_every_block(spark, monkeypatch):
    """Blocks grow with the versions, unless they record too many metrics, so rows of cells are few beside the pairs."""
    rows = [(f"v{i:03d}", 1, "None", "", None, {"rmse": float(i), "f1": 1.0}, {}, {}) for i in range(300)]
    mm = reg.model_metrics(spark.createDataFrame(rows, src.MODEL_VERSION_SCHEMA))
    monkeypatch.setattr(reg, "PAIR_BLOCK", 2)
    monkeypatch.setattr(reg, "PAIR_BLOCKS", 3)
    moved = []
    monkeypatch.setattr(reg, "compare_cells", lambda *a: lambda table: pa.table({
        "name_a": [""], "version_a": pa.array([1], pa.int32()), "name_b": [""], "version_b": pa.array([1], pa.int32()), "wins_a": [0], "wins_b": [0],
        "ties": [0], "n_shared": [table.num_rows]}))
    for entries in (1 << 17, 60):
        monkeypatch.setattr(reg, "BLOCK_ENTRIES", entries)
        moved.append(sum(r.n_shared for r in reg.pairwise_all(mm, columns=()).collect()))
    assert moved == [300 * 3, 300 * 10]


def test_runs_are_attached_per_version(spark):
    versions = spark.createDataFrame(
        [("m", 1, "Production", "", "r1"), ("m", 2, "Staging", "own", "r2"), ("m", 3, "None", None, "gone")],
        "name string, version int, stage string, description string, run_id string")
    runs = spark.createDataFrame(
        [("r1", {"f1": 0.5}, {"random_seed": "7"}, {"mlflow.user": "u", "team": "a"}), ("r2", {"f1": 0.6}, {}, {"team": "b"})],
        "run_id string, metrics map<string,double>, params map<string,string>, tags map<string,string>")
    models = spark.createDataFrame([("m", "about m", {"owner": "o", "team": "z"})],
                                   "name string, description string, tags map<string,string>")
    found = {r.version: r for r in src.attach_runs(versions, runs, models).collect()}
    assert found[1].tags == {"owner": "o", "team": "a"} and found[2].tags == {"owner": "o", "team": "b"}
    assert found[3].tags == {"owner": "o", "team": "z"} and found[3].metrics == {}
    assert [found[v].description for v in (1, 2, 3)] == ["about m", "own", "about m"]
    assert src.attach_runs(versions, runs, keep_missing=False).count() == 2
    history = {r["instruction"]: r["response"] for r in qa_registry.qa_trade_off(
        src.attach_runs(versions, runs, models), reg.model_metrics(src.attach_runs(versions, runs, models))).collect()}
    assert history["How has m improved across versions?"] == (
        "Version history for m: v1 (Production): f1: 0.5000; v2 (Staging): f1: 0.6000; v3 (None): no metrics.")
    seeds = [r.response for r in qa_registry.qa_reproducibility(src.attach_runs(versions, runs, models)).collect()]
    assert len(seeds) == 1 and "A random seed is recorded" in seeds[0]


def test_listing_and_limits(spark):
    names = ["Oak-2", "my_elm_model", "sales", "churn", "garden.oaks", "first_sales"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert sorted(r["name"] for r in src.exclude_models(df, ["first_sales"], ["oak", "elm"]).collect()) == ["churn", "sales"]
    assert src.exclude_models(df).count() == 6
    assert [r["name"] for r in src.registry_models(df, like="%s%", limit=2).collect()] == ["first_sales", "garden.oaks"]
    rows = [(n, v, "Staging" if v % 2 else "None") for n in ("a", "b", "c") for v in range(1, 13)]
    versions = spark.createDataFrame(rows, "name string, version int, stage string")
    newest = {(r["name"], r.stage): r.version for r in src.latest_versions(versions).collect()}
    assert newest["a", "Staging"] == 11 and newest["a", "None"] == 12
    capped = src.cap_versions(versions, 2, 5).collect()
    assert {(r["name"]) for r in capped} == {"a", "b"} and {r.version for r in capped} == {8, 9, 10, 11, 12}
    assert src.by_stage(versions, ("None",)).count() == 18


def test_limitations_and_acceptance(spark, versions, mm):
    found = {(r["name"], r.version, r.kind) for r in reg.limitations(versions).collect()}
    assert {(LOAF, 1, "params"), (LOAF, 1, "variance"), (ROLL, 2, "variance")} <= found and len({x[:2] for x in found}) == 6
    limits = spark.createDataFrame([("accuracy", ">", 0.7), ("mae", "<", 6.5), ("latency_ms", "<", 100.0)],
                                   "metric string, op string, threshold double")
    checked = {(r["name"], r.version, r.metric): (r.result, r.overall) for r in reg.acceptance(mm, limits).collect()}
    assert checked[ROLL, 2, "accuracy"] == ("PASS", "PASS") and checked[LOAF, 1, "latency_ms"] == ("PASS", "FAIL")


def test_texts(versions):
    answers = {}
    for r in qa_registry.qa_registry(versions).collect():
        answers.setdefault(r.instruction, []).append(r.response)
    assert answers["Which model is fastest for real-time inference?"] == [
        f"The fastest model is {LOAF} (v1) with latency_ms of 3.0000. However, if accuracy is more important, "
        f"{RYE} (v2) may be preferred despite higher latency."]
    assert answers["How many models are registered in MLflow?"] == [
        "There are 3 registered models in MLflow with 6 total versions tracked. Stages: Production: 3, Staging: 3."]
    assert answers[f"Compare {LOAF} and {ROLL}."][0].endswith("better across the majority of metrics.")


def test_long_lists_go_on_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(qa_registry, "LIST_BLOCK", 4)
    rows = [(f"m{i:02d}", 1, "Production", "", None, {"rmse": float(i), "f1": 1.0 - i / 100}, {}, {}) for i in range(10)]
    versions = spark.createDataFrame(rows, src.MODEL_VERSION_SCHEMA)
    deployed = [r.response for r in qa_registry.qa_deployment(versions).filter("template_id = 'in_production'").collect()]
    assert len(deployed) == 3 and sorted(x for x in (f"m{i:02d}" for i in range(10)) if any(x in d for d in deployed))[-1] == "m09"
    compared = qa_registry.qa_model_comparison(reg.model_metrics(versions))
    assert compared.filter("template_id = 'ranking'").count() == 6 and compared.filter("template_id = 'best_metric'").count() == 2


def test_prompt_and_record(spark, versions):
    tasks = spark.createDataFrame([("t1", "fast"), ("t2", "")], "task string, criteria string")
    asked = prompts.recommendation_prompt(tasks, versions, limit=2)
    texts = {r.task: r.prompt for r in asked.collect()}
    assert "## Additional Criteria to Consider\nfast\n\n## Response\n" in texts["t1"]
    assert texts["t2"].endswith("monitoring recommendations\n\n## Response\n")
    assert f"### Model 2: {LOAF} (v2)" in texts["t1"] and ROLL not in texts["t1"]
    answers = spark.createDataFrame([("t1", "take loaf")], "task string, recommendation string")
    record = prompts.recommendation_record(asked, versions, answers, limit=2).collect()
    assert len(record) == 1 and [m["name"] for m in record[0].models_evaluated] == [LOAF, LOAF]
