"""Question-answer pairs about the model versions of a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.functions.text import fixed, joined, metric_text, optional, ordered, sql
from tabulore.functions.values import entries_text, names_seed
from tabulore.operators import registry as reg
from tabulore.operators.ranking import number_rows
from tabulore.plans.qa_tables import clause
from tabulore.plans.qa_tables import pairs as render
from tabulore.plans.templates import CLAUSES, REGISTRY_QA
from tabulore.sources.tables import union_all

LIST_BLOCK = 100  # versions named in one text; longer lists go on in further pairs

METRICS = entries_text("metrics", metric_text("e.value"))
LABEL = reg.label()
VALUE = metric_text("value")
MODEL = {"model": "name", "label": LABEL}


def pairs(frame: DataFrame, template: str, **values: str) -> DataFrame:
    return render(frame, template, REGISTRY_QA, **values)


def label_of(item: str) -> str:
    return reg.label(f"{item}.name", f"{item}.version")


def name_of(item: str) -> str:
    return clause("best_label", model=f"{item}.name", version=f"{item}.version")


def params_text() -> str:
    return entries_text("params")


def about(description: str = "description") -> str:
    return optional(f"{description} != ''", clause("stage_description", description=description))


def model_summary() -> str:
    """SQL: label, stage, description, metrics and parameters of a version."""
    return "concat_ws('. ', " + ", ".join([
        clause("summary_head", label=LABEL, stage="stage"),
        f"if(description != '', {clause('summary_description', description='description')}, null)",
        f"if({METRICS} != '', {clause('summary_metrics', metrics=METRICS)}, null)",
        f"if(size(params) > 0, {clause('summary_params', params=params_text())}, null)",
    ]) + ")"


def qa_model_info(versions: DataFrame) -> DataFrame:
    each = versions.select("name", "version", F.explode("metrics").alias("metric", "value")).filter("value is not null")
    return union_all([
        pairs(versions, "describe", model="name", summary=model_summary()),
        pairs(versions.filter("size(metrics) > 0"), "metrics", label=LABEL, metrics=METRICS, stage="stage"),
        pairs(versions.filter("size(params) > 0"), "params", label=LABEL, params=params_text()),
        pairs(versions, "stage", stage="stage", description=about(), **MODEL),
        pairs(each, "one_metric", metric="metric", value=VALUE, **MODEL),
    ])


def qa_model_comparison(mm: DataFrame, compared: DataFrame | None = None) -> DataFrame:
    """Rankings, leaders and comparisons of two versions: of every pair, or of the given pairs ``compared``."""
    item = clause("ranked", model="name", version="version", value=VALUE)
    at = lambda k: F.expr(f"max(case when rank = {k} then struct(name, version, value) end)")
    ranked = reg.rank_metrics(mm).filter("n_models >= 2")
    leaders = ranked.filter("rank <= 2").groupBy("metric", "direction").agg(at(1).alias("best"), at(2).alias("second"))
    listed = ranked.withColumn("block", F.floor((F.col("rank") - 1) / LIST_BLOCK)).groupBy("metric", "block").agg(
        F.expr(joined(ordered(f"rank, {item} as text"), "; ")).alias("ranking")
    ).join(leaders, "metric")
    frame = leaders
    if compared is None:
        # Labels and values are written once per version; each pair's text is put together where the pair is made.
        shown = mm.withColumns({"label": F.expr(LABEL), "shown": F.expr(VALUE)})
        places = {"metric": "{metric}", "label_a": "{label_a}", "label_b": "{label_b}", "value_a": "{shown_a}", "value_b": "{shown_b}"}
        duel, parts = reg.pairwise_all(shown, columns=["label", "shown"], template=CLAUSES["pair_metric"].format(**places)), "parts"
    else:
        duel = reg.pairwise_models(mm, compared)
        parts = joined("metrics", "; ", clause(
            "pair_metric", metric="i.metric", label_a="label_a", label_b="label_b",
            value_a=metric_text("i.value_a"), value_b=metric_text("i.value_b"),
        ))
    duel = duel.selectExpr("*", f"{reg.label('name_a', 'version_a')} as label_a", f"{reg.label('name_b', 'version_b')} as label_b")
    overall = "case when wins_a > wins_b then label_a when wins_b > wins_a then label_b else 'neither clearly' end"
    best_value = metric_text("best.value")
    return union_all([
        pairs(listed, "ranking", metric="metric", direction="direction", ranking="ranking", best=name_of("best"),
              best_value=best_value),
        pairs(frame, "best_metric", metric="metric", best=label_of("best"), best_value=best_value,
              second=label_of("second"), second_value=metric_text("second.value")),
        pairs(duel, "pairwise", model_a="name_a", model_b="name_b", label_a="label_a", label_b="label_b",
              parts=parts, overall=overall),
    ])


def qa_overall(versions: DataFrame, mm: DataFrame) -> DataFrame:
    frame = reg.overall_winner(reg.rank_metrics(mm)).join(versions.select("name", "version", "description"), reg.VERSION)
    lead = f"concat(i.metric, ': ', {metric_text('i.value')})"
    shared = {"label": LABEL, "wins": "wins", "n_metrics": "n_metrics"}
    return pairs(
        frame, "deploy", led=joined("led", "; ", lead), stage="stage", description=about(), **shared
    ).unionByName(pairs(frame, "best_model", led=joined("led", "; ", lead), **shared))


def qa_speed(mm: DataFrame) -> DataFrame:
    frame = reg.fastest(mm)
    other = label_of("accurate")
    alternative = optional(f"accurate is not null and {other} != {LABEL}", clause("more_accurate", label=other))
    shared = {"label": LABEL, "metric": "metric", "value": VALUE}
    return pairs(frame, "fastest", alternative=alternative, **shared).unionByName(
        pairs(frame, "low_latency", stage="stage", **shared)
    )


def qa_accuracy(mm: DataFrame) -> DataFrame:
    shared = {"label": LABEL, "metric": "metric", "value": VALUE}
    return pairs(reg.best_accuracy(mm), "max_accuracy", stage="stage", **shared).unionByName(
        pairs(reg.lowest_error(mm), "lowest_error", **shared)
    )


def _stage_list(versions: DataFrame, suffix: str = "") -> Column:
    """One-row subquery: stages in name order with their number of versions."""
    item = f"stage, concat(stage, ': ', n_versions, {sql(suffix)}) as text"
    return reg.stage_counts(versions).agg(F.expr(joined(ordered(item), ", "))).scalar()


def qa_deployment(versions: DataFrame) -> DataFrame:
    live = versions.filter("stage = 'Production'")
    in_production = reg.blocked(live, LIST_BLOCK).groupBy("block").agg(
        F.expr(joined(ordered(f"name, version, {LABEL} as text"), "; ")).alias("models")
    )
    entry = clause("list_entry", model="name", version="version", stage="stage")
    everything = versions.agg(
        F.count_distinct("name").alias("n_models"), F.expr("count(1)").alias("n_versions"),
    ).withColumn("stages", _stage_list(versions))
    listed = reg.blocked(versions, LIST_BLOCK).groupBy("block").agg(
        F.expr(joined(ordered(f"name, version, {entry} as text"), "; ")).alias("models")
    )
    return union_all([
        pairs(in_production, "in_production", models="models"),
        pairs(live.filter("size(metrics) > 0"), "production_metrics", metrics=METRICS, **MODEL),
        pairs(everything, "how_many", n_models="n_models", n_versions="n_versions", stages="stages"),
        pairs(listed, "list_models", models="models"),
    ])


def qa_trade_off(versions: DataFrame, mm: DataFrame) -> DataFrame:
    entry = clause(
        "trade_off_entry", label=LABEL, accuracy="accuracy", latency="latency",
        accuracy_value=metric_text("accuracy_value"), latency_value=metric_text("latency_value"),
    )
    traded = number_rows(reg.trade_off(mm).withColumn("place", -F.col("accuracy_value")), ["place", "name", "version"], "n")
    trade = traded.withColumn("block", F.floor((F.col("n") - 1) / LIST_BLOCK)).groupBy("accuracy", "latency", "block").agg(
        F.expr(joined(ordered(f"place, name, version, {entry} as text"), "; ")).alias("parts")
    )
    shown = (
        "array_join(transform(filter(i.metrics, e -> e.value is not null), "
        f"e -> concat(e.key, ': ', {metric_text('e.value')})), ', ')"
    )
    step = clause(
        "history_entry", version="i.version", stage="i.stage",
        metrics=f"if(size(i.metrics) > 0, {shown}, 'no metrics')",
    )
    return union_all([
        pairs(trade, "trade_off", accuracy="accuracy", latency="latency", parts="parts"),
        pairs(reg.version_history(versions), "history", model="name", parts=joined("steps", "; ", step)),
        pairs(reg.production_risk(reg.rank_metrics(mm)), "risk", metric="metric", value=VALUE, **MODEL),
    ])


def qa_overview(versions: DataFrame, mm: DataFrame) -> DataFrame:
    totals = reg.registry_totals(versions).withColumn("stages", _stage_list(versions, " models"))
    shared = number_rows(mm.join(reg.metric_inventory(mm), "metric"), ["metric", "name", "version"], "n")
    starts = shared.groupBy("metric").agg(F.min("n").alias("first"))
    listed = shared.join(starts, "metric").withColumn("block", F.floor((F.col("n") - F.col("first")) / LIST_BLOCK))
    labels = listed.groupBy("metric", "block").agg(F.expr(joined(ordered(f"name, version, {LABEL} as text"), ", ")).alias("labels"))
    comparable = labels.selectExpr(f"{clause('comparable_entry', metric='metric', labels='labels')} as shared")
    return union_all([
        pairs(totals, "metrics_tracked", n_versions="n_versions", metrics="array_join(metrics, ', ')"),
        pairs(totals.filter("n_params > 0"), "params_tracked", params="array_join(params, ', ')"),
        pairs(totals, "summary", n_models="n_models", n_versions="n_versions", stages="stages",
              n_metrics="n_metrics", n_params="n_params"),
        pairs(comparable, "comparable", shared="shared"),
    ])


def _metrics_where(mm: DataFrame, condition: str, joint: str, sep: str) -> DataFrame:
    item = f"metric, concat(metric, {sql(joint)}, {VALUE}) as text"
    return mm.filter(condition).groupBy("name", "version").agg(F.expr(joined(ordered(item), sep)).alias("metrics"))


def qa_reliability(versions: DataFrame, mm: DataFrame) -> DataFrame:
    limit = (
        f"case kind when 'variance' then {clause('limit_variance', metric='metric', value=VALUE, pct=fixed('value * 100', 0))} "
        f"when 'misses' then {clause('limit_misses', metric='metric', value=VALUE)} "
        f"else {clause('limit_params', n='n_params')} end"
    )
    limits = reg.limitations(versions).groupBy("name", "version").agg(
        F.expr(joined(ordered(f"place, metric, {limit} as text"), "; ")).alias("limits")
    )
    return union_all([
        pairs(_metrics_where(mm, "is_lower and not is_latency", ": ", "; "), "reliability", metrics="metrics", **MODEL),
        pairs(_metrics_where(mm, "is_accuracy", ": ", "; "), "confidence", metrics="metrics", **MODEL),
        pairs(reg.variability(mm), "variability", metric="metric", best=label_of("best"), best_value=metric_text("best.value"),
              worst=label_of("worst"), worst_value=metric_text("worst.value")),
        pairs(limits, "limitations", limits="limits", **MODEL),
    ])


def qa_reproducibility(versions: DataFrame) -> DataFrame:
    frame = versions.filter("size(params) > 0").withColumn("has_seed", names_seed(F.col("params")))
    seed = f"if(has_seed, {sql(CLAUSES['seed_logged'])}, {sql(CLAUSES['seed_missing'])})"
    return pairs(frame, "reproduce", seed=seed, params=params_text(), **MODEL)


def qa_fitness(versions: DataFrame, mm: DataFrame) -> DataFrame:
    totals = reg.registry_totals(versions).filter("n_versions >= 2")
    several = totals.agg(F.count(F.lit(1))).scalar() > 0

    def models_with(condition: str) -> DataFrame:
        return reg.blocked(_metrics_where(mm, condition, "=", ", "), LIST_BLOCK).groupBy("block").agg(
            F.expr(joined(ordered(f"name, version, concat({LABEL}, ': ', metrics) as text"), "; ")).alias("models")
        ).filter(several)

    entry = clause("best_entry", metric="metric", label=LABEL, value=VALUE)
    best = reg.best_per_metric(reg.rank_metrics(mm)).agg(
        F.expr(joined(ordered(f"metric, {entry} as text"), "; "))
    ).scalar()
    known = totals.filter("n_metrics > 0").withColumn("best", best)
    shared = {"n_versions": "n_versions", "n_metrics": "n_metrics"}
    return union_all([
        pairs(models_with("is_lower and not contains(lower(metric), 'latency')"), "continuous", models="models"),
        pairs(models_with("is_accuracy"), "classification", models="models"),
        pairs(known, "choose", best="best", **shared),
        pairs(known, "trust", **shared),
    ])


def qa_registry(versions: DataFrame, match: str = "token", compared: DataFrame | None = None) -> DataFrame:
    """Every question-answer pair of a registry; versions are compared as in ``qa_model_comparison``."""
    mm = reg.model_metrics(versions, match)
    return union_all([
        qa_model_info(versions), qa_model_comparison(mm, compared), qa_overall(versions, mm), qa_speed(mm), qa_accuracy(mm),
        qa_deployment(versions), qa_trade_off(versions, mm), qa_overview(versions, mm), qa_reliability(versions, mm),
        qa_reproducibility(versions), qa_fitness(versions, mm),
    ])
