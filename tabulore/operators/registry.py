"""Rankings and comparisons of model versions.

``model_metrics`` turns the metric maps into rows; everything else is a join,
group or window on those rows. Model order in lists is (name, version).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore.functions.text import fill
from tabulore.operators.duels import compare_cells
from tabulore.operators.ranking import number_rows
from tabulore.operators.skyline import pareto_front
from tabulore.plans.templates import CLAUSES
from tabulore.session import cut_lineage

# Parts of metric names that tell which direction is better, and
# which class a metric belongs to.
LOWER_IS_BETTER = (
    "rmse", "mse", "mae", "loss", "error", "log_loss", "logloss",
    "inference_latency_ms", "latency", "latency_ms", "training_time",
)
# Names of errors that the list above only holds as parts of other words.
OTHER_ERRORS = ("mape", "smape", "msle", "rmsle", "nll", "perplexity", "wer", "cer")
HIGHER_IS_BETTER = (
    "accuracy", "r2", "r2_score", "f1", "precision", "recall", "auc", "roc_auc", "ap", "map", "ndcg",
)
LATENCY_HINTS = ("latency", "time")
VARIABILITY_HINTS = ("rmse", "mse", "mae", "std", "error")
VARIANCE_METRICS, VARIANCE_LIMIT = ("accuracy", "r2", "r2_score"), 0.8
MISS_METRICS, MISS_LIMIT = ("f1", "precision", "recall"), 0.7
FEW_PARAMS = 3

VERSION = ["name", "version"]
PAIR_BLOCK = 128  # versions on each side of the pairs that one task compares at a time, at least
PAIR_BLOCKS = 32  # blocks of versions; each version is moved once for every block
BLOCK_ENTRIES = 1 << 17  # versions of a larger block times their distinct metrics, at most
TASK_PAIRS = 1 << 18  # pairs in one task,
MOST_TASKS = 20_000  # or more beyond so many tasks


def name_has(metric: Column, hints: Sequence[str], match: str = "token") -> Column:
    """Whether a metric name contains one of the hints, anywhere or as a whole token."""
    lowered = F.lower(metric)
    if match == "token":
        return lowered.rlike(r"(^|[^a-z0-9])(" + "|".join(hints) + r")([^a-z0-9]|$)")
    return lowered.rlike("|".join(hints))


def direction(metric: Column, match: str = "token") -> Column:
    return F.when(name_has(metric, LOWER_IS_BETTER + OTHER_ERRORS, match), "lowest").otherwise("highest")


def label(model: str = "name", version: str = "version") -> str:
    """SQL: display label of a version."""
    return fill(CLAUSES["label"], model=model, version=version)


def model_metrics(versions: DataFrame, match: str = "token") -> DataFrame:
    """(name, version, stage, metric, value, direction, class flags) for recorded values."""
    rows = versions.select("name", "version", "stage", F.explode("metrics").alias("metric", "value")).filter(
        F.col("value").isNotNull()
    )
    name = F.col("metric")
    return (
        rows.withColumn("direction", direction(name, match))
        .withColumn("is_latency", name_has(name, LATENCY_HINTS, match))
        .withColumn("is_lower", name_has(name, LOWER_IS_BETTER + OTHER_ERRORS, match))
        .withColumn("is_accuracy", name_has(name, HIGHER_IS_BETTER, match))
    )


def signed(value: Column, direction_: Column) -> Column:
    """Value to sort ascending so that the best comes first."""
    return F.when(direction_ == "lowest", value).otherwise(-value)


def rank_metrics(mm: DataFrame) -> DataFrame:
    """Add per metric: rank (1 = best), worst_rank (1 = every holder of the worst value), n_models.

    Versions are numbered in one range-partitioned order of metric and value, so a metric that every version
    records does not meet in one task; its ranks are the numbers less the metric's first.
    """
    columns = mm.columns
    order = ["metric", "_cost", "name", "version"]
    numbered = cut_lineage(
        number_rows(mm.withColumn("_cost", signed(F.col("value"), F.col("direction"))), order, "_number")
    )
    metrics = numbered.groupBy("metric").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("n_models"))
    ties = numbered.groupBy("metric", "_cost").agg(F.max("_number").alias("_last"))
    return numbered.join(ties, ["metric", "_cost"]).join(metrics, "metric").select(
        *columns, (F.col("_number") - F.col("_first") + 1).cast("int").alias("rank"),
        (F.col("_first") + F.col("n_models") - F.col("_last")).cast("int").alias("worst_rank"), "n_models",
    )


def best_per_metric(ranked: DataFrame) -> DataFrame:
    return ranked.filter(F.col("rank") == 1)


def neighbours(mm: DataFrame) -> DataFrame:
    """(name_a, version_a, name_b, version_b): each version with the next in name order."""
    numbered = cut_lineage(number_rows(mm.select("name", "version").distinct(), ["name", "version"], "n"))
    after = numbered.select((F.col("n") - 1).alias("n"), F.col("name").alias("name_b"), F.col("version").alias("version_b"))
    return numbered.join(after, "n").select(
        F.col("name").alias("name_a"), F.col("version").alias("version_a"), "name_b", "version_b"
    )


def pairwise_all(mm: DataFrame, tie: str = "apart", columns: Sequence[str] = ("value",), template: str = "", sep: str = "; ") -> DataFrame:
    """``pairwise_models`` for every pair of versions that share a metric, the first in name order as a.

    The versions are numbered and cut into blocks, and every two blocks meet in a cell of their own, to which each version
    of theirs comes once with its metrics. Blocks grow with the versions as far as a cell fits a task, so that what is moved
    grows little faster than the versions. The V(V-1)/2 pairs are made and counted there (``operators.duels``). ``metrics`` lists the ``columns`` of the shared metrics for both sides; without columns it is left out. With a ``template``, such as
    ``{metric}: {text_a}, {text_b}`` over string columns, ``parts`` has one text a pair instead, filled for each shared metric.
    """
    entry = ["metric", "direction", "value", *[c for c in columns if c != "value"]]
    held = mm.groupBy(*VERSION).agg(F.sort_array(F.collect_list(F.struct(*entry))).alias("held"))
    unique = "exists(held, x -> x.metric is null) or size(array_distinct(held.metric)) < size(held)"
    held = held.withColumn("held", F.expr(f"if({unique}, raise_error('a version has a metric twice or without a name'), held)"))
    numbered = cut_lineage(number_rows(held, VERSION, "n"))
    wide = numbered.select(F.explode("held.metric")).distinct().count()
    many = numbered.count()
    size = max(PAIR_BLOCK, min(-(-many // PAIR_BLOCKS), BLOCK_ENTRIES // max(1, wide)))
    numbered = numbered.withColumn("block", F.floor((F.col("n") - 1) / size))
    last = max(0, many - 1) // size
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long")))
    spread = numbered.repartition(min(last + 1, MOST_TASKS), "block")
    cells = spread.withColumn("other", other).select(
        F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"), "block", *VERSION, "n", "held"
    )
    kind = {f.name: f.dataType for f in mm.schema}
    schema = T.StructType([T.StructField(f"{c}_{side}", kind[c]) for side in "ab" for c in VERSION])
    for c in ("wins_a", "wins_b", "ties", "n_shared"):
        schema = schema.add(c, "long")
    if template:
        schema = schema.add("parts", "string")
    elif columns:
        sides = [T.StructField(f"{c}_{side}", kind[c]) for c in columns for side in "ab"]
        schema = schema.add("metrics", T.ArrayType(T.StructType([T.StructField("metric", kind["metric"]), *sides])))
    # Rows are few beside the pairs they make, so the number of tasks follows the cells and not the bytes.
    tasks = min(max(1, (last + 1) * (last + 2) // 2 // max(1, TASK_PAIRS // size**2)), MOST_TASKS)
    return cells.repartition(tasks, "block_a", "block_b").groupBy("block_a", "block_b").applyInArrow(compare_cells(tie, columns, template, sep, schema), schema)


def version_wins(mm: DataFrame) -> DataFrame:
    """(name, version, n_duels, wins, losses, ties): each version against all others that record the same metrics.

    The sums of ``pairwise_all`` over all opponents, without its pairs: in the order of a metric the versions behind a
    version and its equals are those it beats, and the versions before them beat it.
    """
    ranked = rank_metrics(mm)
    ties = ranked.groupBy("metric", "value").agg(F.min("rank").alias("first"))
    placed = ranked.join(ties, ["metric", "value"]).select(
        *VERSION, (F.col("n_models") - 1).alias("duels"), (F.col("worst_rank") - 1).alias("won"), (F.col("first") - 1).alias("lost")
    )
    totals = placed.groupBy(*VERSION).agg(
        F.sum("duels").alias("n_duels"), F.sum("won").alias("wins"), F.sum("lost").alias("losses")
    )
    return totals.filter("n_duels > 0").withColumn("ties", F.expr("n_duels - wins - losses"))


def pareto_versions(mm: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Versions that record all the metrics and that no other one beats: (name, version, one column per metric).

    The direction of each metric follows from its name.
    """
    wide = mm.filter(F.col("metric").isin(list(metrics))).groupBy(*VERSION).pivot("metric", list(metrics)).agg(F.first("value"))
    low = {r["metric"] for r in mm.sparkSession.createDataFrame([(m,) for m in metrics], "metric string").filter(
        direction(F.col("metric")) == "lowest").collect()}
    return pareto_front(wide, [m for m in metrics if m in low], [m for m in metrics if m not in low])


def pairwise_models(mm: DataFrame, pairs: DataFrame, tie: str = "apart") -> DataFrame:
    """Wins of each given pair (name_a, version_a, name_b, version_b) over their shared metrics.

    Ties count for neither side, or for the second with ``tie="second"``.
    """
    side = lambda suffix: mm.select(
        "metric", F.col("direction").alias(f"direction_{suffix}"),
        F.col("name").alias(f"name_{suffix}"), F.col("version").alias(f"version_{suffix}"),
        F.col("value").alias(f"value_{suffix}"),
    )
    better = signed(F.col("value_a"), F.col("direction_a")) < signed(F.col("value_b"), F.col("direction_a"))
    tied = F.col("value_a") == F.col("value_b")
    b_wins = ~better if tie == "second" else (~better & ~tied)
    return (
        pairs.join(side("a"), ["name_a", "version_a"]).join(side("b"), ["name_b", "version_b", "metric"])
        .groupBy("name_a", "version_a", "name_b", "version_b")
        .agg(
            F.count_if(better).alias("wins_a"), F.count_if(b_wins).alias("wins_b"),
            F.count_if(tied).alias("ties"), F.count(F.lit(1)).alias("n_shared"),
            F.sort_array(F.collect_list(F.struct("metric", "value_a", "value_b"))).alias("metrics"),
        )
    )


def blocked(versions: DataFrame, size: int) -> DataFrame:
    """Add ``block``: consecutive numbers for every ``size`` rows in name order, so that lists have a bounded length."""
    numbered = number_rows(versions, ["name", "version"], "_n")
    return numbered.withColumn("block", F.floor((F.col("_n") - 1) / size)).drop("_n")


def overall_winner(ranked: DataFrame) -> DataFrame:
    """The version that leads most metrics, with the metrics it leads."""
    led = F.sort_array(F.collect_list(F.struct("metric", "value")))
    wins = best_per_metric(ranked).groupBy("name", "version", "stage").agg(
        F.count(F.lit(1)).alias("wins"), led.alias("led")
    )
    total = ranked.agg(F.count_distinct("metric").alias("n")).scalar()
    return wins.orderBy(F.desc("wins"), "name", "version").limit(1).withColumn("n_metrics", total)


def fastest(mm: DataFrame) -> DataFrame:
    """Best version per latency metric, and the most accurate one by the first accuracy metric."""
    speed = mm.filter("is_latency").groupBy("metric").agg(
        F.count(F.lit(1)).alias("n_models"),
        F.min_by(F.struct("name", "version", "stage", "value"), F.struct("value", "name", "version")).alias("fast"),
    ).filter(F.col("n_models") >= 2)
    accurate = mm.filter("is_accuracy").agg(
        F.min_by(
            F.struct("name", "version", "metric", "value"), F.struct("metric", -F.col("value"), "name", "version")
        ).alias("best")
    ).scalar()
    return speed.select(
        "metric", "n_models", "fast.name", "fast.version", "fast.stage", "fast.value", accurate.alias("accurate")
    )


def best_accuracy(mm: DataFrame) -> DataFrame:
    """Version with the highest value of each accuracy metric shared by two versions."""
    order = F.struct(-F.col("value"), F.col("name"), F.col("version"))
    return _leaders(mm.filter("is_accuracy"), order)


def lowest_error(mm: DataFrame) -> DataFrame:
    """Version with the lowest value of each error metric (no latency or time)."""
    return _leaders(mm.filter("is_lower and not is_latency"), F.struct("value", "name", "version"))


def _leaders(mm: DataFrame, order: Column) -> DataFrame:
    return mm.groupBy("metric").agg(
        F.count(F.lit(1)).alias("n_models"),
        F.min_by(F.struct("name", "version", "stage", "value"), order).alias("best"),
    ).filter(F.col("n_models") >= 2).select("metric", "n_models", "best.*")


def trade_off(mm: DataFrame) -> DataFrame:
    """Accuracy against latency for the first latency metric that has a partner.

    As in the rankings, metrics are taken in name order: the first latency
    metric, with the first accuracy metric recorded by two or more versions
    that also record the latency.
    """
    latency_name = mm.filter("is_latency").agg(F.min("metric")).scalar()
    latency = mm.filter(F.col("metric") == latency_name).select(
        "name", "version", F.col("metric").alias("latency"), F.col("value").alias("latency_value")
    )
    accuracy = mm.filter("is_accuracy").select(
        "name", "version", F.col("metric").alias("accuracy"), F.col("value").alias("accuracy_value")
    )
    both = accuracy.join(latency, VERSION)
    first = both.groupBy("accuracy").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2").agg(F.min("accuracy")).scalar()
    return both.filter(F.col("accuracy") == first)


def version_history(versions: DataFrame) -> DataFrame:
    """Versions of each model in order, with the metrics of each."""
    entries = F.array_sort(F.map_entries("metrics"))
    steps = F.sort_array(F.collect_list(F.struct("version", "stage", entries.alias("metrics"))))
    return versions.groupBy("name").agg(F.count(F.lit(1)).alias("n_versions"), steps.alias("steps")).filter(
        F.col("n_versions") >= 2
    )


def production_risk(ranked: DataFrame) -> DataFrame:
    """First metric (by name) where a production version is worst and not leading."""
    worst = ranked.filter(
        (F.col("stage") == "Production") & (F.col("worst_rank") == 1) & (F.col("rank") > 1) & (F.col("n_models") > 1)
    )
    return worst.groupBy("name", "version").agg(
        F.min_by(F.struct("metric", "value", "direction"), "metric").alias("risk")
    ).select("name", "version", "risk.*")


def variability(mm: DataFrame) -> DataFrame:
    """Lowest and highest value per error-like metric."""
    item = F.struct("name", "version", "value")
    order = F.struct("value", "name", "version")
    return (
        mm.filter(name_has(F.col("metric"), VARIABILITY_HINTS)).groupBy("metric")
        .agg(F.count(F.lit(1)).alias("n_models"), F.min_by(item, order).alias("best"), F.max_by(item, order).alias("worst"))
        .filter(F.col("n_models") >= 2)
    )


def metric_inventory(mm: DataFrame) -> DataFrame:
    """Versions per comparable metric (two or more versions)."""
    return mm.groupBy("metric").agg(F.count(F.lit(1)).alias("n_models")).filter(F.col("n_models") > 1)


def stage_counts(versions: DataFrame) -> DataFrame:
    return versions.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_versions"), F.count_distinct("name").alias("n_models")
    )


def registry_totals(versions: DataFrame) -> DataFrame:
    """One row: models, versions, distinct metrics and parameters, with their names."""
    names = lambda column: F.sort_array(F.collect_set(column))  # noqa: E731  one entry per distinct name
    known = lambda column, alias: (
        versions.select(F.explode(F.map_keys(column)).alias("key")).distinct().agg(names("key").alias(alias)).scalar()
    )
    return versions.agg(
        F.count_distinct("name").alias("n_models"), F.count(F.lit(1)).alias("n_versions"),
    ).withColumn("metrics", known("metrics", "metrics")).withColumn("params", known("params", "params")).withColumn(
        "n_metrics", F.size("metrics").cast("bigint")
    ).withColumn("n_params", F.size("params").cast("bigint"))


def limitations(versions: DataFrame) -> DataFrame:
    """(name, version, place, kind, metric, value, n_params) for each rule that fires."""
    mm = versions.filter(F.size("metrics") > 0)
    value, name = F.col("value"), F.col("metric")
    low = F.when(name_has(name, VARIANCE_METRICS) & (value < VARIANCE_LIMIT), "variance").when(
        name_has(name, MISS_METRICS) & (value < MISS_LIMIT), "misses"
    )
    by_metric = mm.select("name", "version", F.explode("metrics").alias("metric", "value")).select(
        "name", "version", F.lit(1).alias("place"), low.alias("kind"), "metric", "value",
        F.lit(None).cast("int").alias("n_params"),
    ).filter(F.col("kind").isNotNull())
    few = mm.filter(F.size("params") < FEW_PARAMS).select(
        "name", "version", F.lit(2).alias("place"), F.lit("params").alias("kind"),
        F.lit("").alias("metric"), F.lit(None).cast("double").alias("value"), F.size("params").alias("n_params"),
    )
    return by_metric.unionByName(few)


def acceptance(mm: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Check metrics against (metric, op, threshold) rows; verdict per criterion and version."""
    passed = (
        F.when(F.col("op") == ">", F.col("value") > F.col("threshold"))
        .when(F.col("op") == ">=", F.col("value") >= F.col("threshold"))
        .when(F.col("op") == "<", F.col("value") < F.col("threshold"))
        .when(F.col("op") == "<=", F.col("value") <= F.col("threshold"))
    )
    every = Window.partitionBy("name", "version")
    return (
        mm.select("name", "version", "metric", "value").join(thresholds, "metric").withColumn("_passed", passed)
        .select(
            "name", "version", "metric", "value", "op", "threshold",
            F.when(F.col("_passed"), "PASS").otherwise("FAIL").alias("result"),
            F.when(F.every("_passed").over(every), "PASS").otherwise("FAIL").alias("overall"),
        )
    )
