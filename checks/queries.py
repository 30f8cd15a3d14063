"""The engine's operators as queries over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.tables_sql import FULL_NAME, KEYS, RELATED, TABLES, gaps_sql
from tabulore.functions.text import fixed, format_value, g6, metric_text, yes_no
from tabulore.functions.values import head_map, lenient_json, user_tags
from tabulore.operators import corpus, evals, groups, instruct, ranking, registry, relate, search, skyline, subwords
from tabulore.operators.profile import Profile, ProfileOptions
from tabulore.plans import prompts, qa_registry, qa_tables, verbalize
from tabulore.session import cut_lineage, ensure_checkpoint_dir
from tabulore.sources import files
from tabulore.sources import registry as models
from tabulore.sources.tables import TableSet, extract_text, load_schema_text, union_all

Query = Callable[[SparkSession, str], DataFrame]
SEARCHED = ("THE ", "ab", "Licensed under", "wxyzq")
GIVEN = [name for name in TABLES if name != "labelled"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shop(spark: SparkSession, sf_dir: str) -> TableSet:
    """The given tables, and documents joined with their labels as a table with NULLs."""
    tables = {name: read(spark, sf_dir, name) for name in GIVEN}
    tables["labelled"] = tables["documents"].join(tables["labels"], "doc_id", "left").select(
        "doc_id", "lang", "n_chars", "quality", "toxic"
    )
    catalog, schema = FULL_NAME.split(".")
    return TableSet(spark, tables, schema_name=schema, catalog_name=catalog)


def related(spark: SparkSession, sf_dir: str) -> TableSet:
    """Tables whose key columns carry common names."""
    return TableSet(spark, {
        name: read(spark, sf_dir, name).withColumnsRenamed(renames) for name, renames in RELATED.items()
    })


def profile(spark: SparkSession, sf_dir: str, keep: bool = False) -> Profile:
    # Tables without a name column are identified by their key.
    ids = {"events": "event_id", "documents": "doc_id", "lineitem": "l_orderkey"}
    return Profile(shop(spark, sf_dir), ProfileOptions(id_columns=ids), keep=keep)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- profiles --------------------------------------------------------------------

def gaps(spark: SparkSession, sf_dir: str, keep: bool = True) -> Profile:
    """events with skewed, constant and related columns, NULL and NaN."""
    read(spark, sf_dir, "events").createOrReplaceTempView("events_with_gaps")
    df = spark.sql(gaps_sql("double('NaN')").replace("FROM events", "FROM events_with_gaps"))
    return Profile(TableSet(spark, {"gaps": df}), ProfileOptions(id_columns={"gaps": "event_id"}), keep=keep)


def numeric_profile(spark, sf_dir, of=None):
    df = (of or profile)(spark, sf_dir).numeric.select(
        "table", "column", "n", "min", "max", "avg", "stddev", "cv", "precision", "se", "ci_lo", "ci_hi"
    )
    return rounded(rounded(df, 4, "min", "max", "avg", "stddev", "se", "ci_lo", "ci_hi"), 6, "cv")


def compare_groups(spark, sf_dir):
    df = groups.compare_groups(profile(spark, sf_dir)).select("table", "cat", "num", F.inline("groups"))
    return rounded(df.select("table", "cat", "num", "value", "avg", "n"), 4, "avg")


def subgroups(spark, sf_dir, of=None):
    df = groups.subgroups((of or profile)(spark, sf_dir)).select(
        "table", "cat", "num", F.col("high.value").alias("high_value"), F.col("high.avg").alias("high_avg"),
        F.col("low.value").alias("low_value"), F.col("low.avg").alias("low_avg"), "diff", "pct_diff",
    )
    return rounded(df, 4, "high_avg", "low_avg", "diff", "pct_diff")


def iqr_outliers(spark, sf_dir, of=None):
    df = (of or profile)(spark, sf_dir, keep=True).outliers.select(
        "table", "column", "q1", "q3", "iqr", "lo_fence", "hi_fence", "n_outlier", "pct_of_rows"
    )
    return rounded(rounded(df, 4, "q1", "q3", "iqr", "lo_fence", "hi_fence"), 6, "pct_of_rows")


def bimodality(spark, sf_dir, of=None):
    return rounded((of or profile)(spark, sf_dir, keep=True).bimodality.select(
        "table", "column", "n_lower_half", "n_upper_half", "n_middle", "middle_pct", "is_bimodal"), 6, "middle_pct")


def metadata_presence(spark, sf_dir):
    p = profile(spark, sf_dir)
    return p.metadata_presence.join(p.summary.select("table", "n_rows"), "table")


def highlights(spark, sf_dir):
    df = profile(spark, sf_dir, keep=True).highlights.select("table", "top_cv_column", "top_cv", "col_a", "col_b", "r", "n_strong")
    return rounded(df, 6, "top_cv", "r")


def shared_columns(spark, sf_dir):
    p = profile(spark, sf_dir)
    shared = relate.shared_columns(p.tables.columns_frame())
    rows = shared.select("column", F.explode("tables").alias("table")).join(p.summary.select("table", "n_rows"), "table")
    return rows.groupBy("column").agg(F.sum("n_rows").alias("n_rows")).join(shared, "column").select(
        "column", F.array_join("tables", ", ").alias("tables"), "n_rows"
    )


def join_gain(spark, sf_dir):
    tables = related(spark, sf_dir)
    gains = relate.join_gain(tables.columns_frame(), relate.column_overlap(tables))
    return gains.withColumns({c: F.array_join(c, ", ") for c in ("gain_a", "gain_b")})


def top_categories(spark, sf_dir):
    lineitem, p = read(spark, sf_dir, "lineitem"), profile(spark, sf_dir)
    top = Profile(p.tables.subset(["lineitem"])).values
    return groups.top_k_filter(lineitem, top, "l_returnflag", 2).groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity")
    )


# ---- sources and corpora -----------------------------------------------------------

def scan_tables(spark, sf_dir):
    tables = TableSet.from_directory(spark, sf_dir, exclude=("labels",))
    return union_all(
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.tables.items()
    )


def extract(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return extract_text(docs, "text", limit=500, order_by=["doc_id"])


def jsonl_roundtrip(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    files.write_jsonl(read(spark, sf_dir, "documents"), folder)
    return files.read_jsonl(spark, folder)


def prepared(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return corpus.dedup_exact(corpus.filter_by_length(corpus.clean_column(docs)), ["doc_id"])


def document_funnel(spark, sf_dir):
    raw = read(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = corpus.clean_column(raw)
    sized = corpus.filter_by_length(cleaned)
    return corpus.funnel({
        "raw": raw, "clean": cleaned, "length": sized, "dedup": corpus.dedup_exact(sized, ["doc_id"]),
    })


def split_exact(spark, sf_dir):
    train, val = corpus.prepare_documents(read(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return train.select("doc_id", F.lit(False).alias("is_val")).unionByName(val.select("doc_id", F.lit(True).alias("is_val")))


def replay_mix(spark, sf_dir):
    domain = read(spark, sf_dir, "documents").select("doc_id", "text")
    pool = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return ranking.mix_replay(domain, pool, ["doc_id"]).select("doc_id", "source_tag", "mix_key")


def corpus_stats(spark, sf_dir):
    return rounded(corpus.corpus_stats(read(spark, sf_dir, "documents"), by=["lang"]), 4, "avg_chars")


def sequence_budget(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return rounded(corpus.sequence_budget(docs, max_len=256, by=["lang"]), 6, "pct_truncated")


# ---- instruction data -----------------------------------------------------------

def turn_pairs(spark, sf_dir) -> DataFrame:
    """A user turn and the assistant turn after it, as question and answer."""
    turns = read(spark, sf_dir, "conversations")
    asked = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    said = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("response"))
    category = F.when(F.col("conv_id") % 10 == 0, "schema").when(F.col("conv_id") % 3 == 0, "aggregation").otherwise("row_level")
    return asked.join(said, ["conv_id", "turn"]).withColumn("category", category)


def combined_pairs(spark, sf_dir) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        F.concat(F.lit("Which language is document "), "doc_id", F.lit("?")).alias("instruction"),
        F.col("lang").alias("response"), F.lit("document").alias("category"),
    )
    return instruct.combine_qa(turn_pairs(spark, sf_dir).select("instruction", "response", "category"), docs)


def extract_response(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    wrapped = F.concat(F.lit("<s>[INST] "), "text", F.lit(" [/INST]\n  "), "role", F.lit("\t\n"))
    generated = F.when(F.col("turn") % 2 == 0, wrapped).otherwise(F.concat("text", F.lit(" "), "role"))
    return turns.select("conv_id", "turn", instruct.extract_response(generated, F.col("text")).alias("response"))


def mask_spans(spark, sf_dir):
    masked = instruct.mask_spans(instruct.to_instruct(turn_pairs(spark, sf_dir)), max_len=64)
    return masked.select(
        "conv_id", "turn", "n_tokens", "n_masked", "n_trainable",
        F.size(F.filter("labels", lambda x: x == instruct.IGNORED_LABEL)).alias("n_ignored"), F.size("labels").alias("n_labels"),
    )


def subword_masks(spark, sf_dir):
    """Masks over subword tokens of all turn pairs; labels as their number and sum."""
    masked = subwords.subword_masks(instruct.to_instruct(turn_pairs(spark, sf_dir)), vocabulary())
    return masked.select(
        "conv_id", "turn", "n_tokens", "n_masked", "n_trainable",
        F.aggregate("labels", F.lit(0).cast("long"), lambda total, x: total + x).alias("label_sum"))


def subword_budget(spark, sf_dir):
    return rounded(subwords.subword_budget(read(spark, sf_dir, "documents"), vocabulary(), by=["lang"]), 6, "pct_truncated")


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cap_pairs(spark, sf_dir):
    qa = combined_pairs(spark, sf_dir)
    return ranking.cap_pairs(qa, 150, ("schema",)).select("category", "instruction", "response")


# ---- values ---------------------------------------------------------------------

def number_texts(spark, sf_dir):
    part, lineitem = read(spark, sf_dir, "part"), read(spark, sf_dir, "lineitem")
    x = "(l_extendedprice * element_at(array(1e-8D, 1e-5D, 1e-2D, 10D, 1e4D, 1e7D, 1e10D), l_linenumber))"
    return lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", f"{g6(x)} as g6", f"{metric_text('l_discount')} as metric",
        f"{fixed('l_extendedprice / 8', 2)} as two", f"{fixed('l_quantity / 2', 0)} as whole",
        f"{format_value('l_tax', True)} as value", f"{yes_no('l_discount > 0.05')} as high",
    ).join(part.select(F.col("p_partkey").alias("l_partkey")), "l_partkey")


def json_values(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    quoted = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"'))
    text = F.when(kind == 0, F.col("props")).when(kind == 1, quoted).when(
        kind == 2, F.replace("props", F.lit('"'), F.lit("'"))).otherwise(F.concat(F.lit("not json: "), "event_type"))
    parsed = lenient_json(text)
    return events.select(
        "event_id", F.try_variant_get(parsed, "$.k", "bigint").alias("k"),
        F.when(kind == 3, F.try_variant_get(parsed, "$", "string")).alias("raw"),
    )


# ---- registry --------------------------------------------------------------------

def registry_parts(spark, sf_dir):
    """Models, versions and runs of a registry derived from suppliers and their line items."""
    lineitem, supplier = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "supplier")
    measured = lineitem.groupBy("l_suppkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("l_discount"), 6).alias("disc"), F.round(F.avg("l_tax"), 6).alias("tax"),
        F.round(F.avg("l_quantity") / 50, 6).alias("qty"), F.round(F.avg("l_extendedprice") / 1000, 6).alias("price"),
        F.round(F.sum("l_quantity"), 2).alias("total"), F.min("l_partkey").alias("part"),
    ).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    run_id = "concat('run-', l_suppkey, '-', l_linenumber)"
    versions = measured.selectExpr(
        "s_name as name", "l_linenumber as version",
        "case when l_linenumber = 1 then 'Production' when l_linenumber <= 3 then 'Staging' "
        "when l_linenumber <= 5 then 'None' else 'Archived' end as stage",
        "if(l_linenumber % 2 = 1, concat('Trained on ', n, ' rows'), '') as description", f"{run_id} as run_id",
    )
    runs = measured.filter("l_linenumber != 7").selectExpr(
        f"{run_id} as run_id",
        "map_filter(map('rmse', disc, 'mae', tax, 'accuracy', qty, 'r2', round(1 - tax * 4, 6), 'f1', if(l_linenumber % 2 = 1, 1 - disc, null), "
        "'inference_latency_ms', price, 'training_time', total), (k, v) -> v is not null) as metrics",
        "map_filter(map('n_rows', cast(n as string), 'depth', cast(l_linenumber as string), "
        "'random_seed', if(l_linenumber % 3 = 0, cast(part as string), null)), (k, v) -> v is not null) as params",
        "map('mlflow.user', cast(part as string), 'team', concat('t', l_linenumber)) as tags",
    )
    registered = supplier.selectExpr(
        "s_name as name", "if(s_nationkey % 2 = 0, concat('Model of nation ', s_nationkey), '') as description",
        "map('owner', cast(s_nationkey as string), 'team', 'none') as tags",
    )
    return registered, versions, runs


def model_versions(spark, sf_dir) -> DataFrame:
    registered, versions, runs = registry_parts(spark, sf_dir)
    chosen = models.latest_versions(versions)
    return models.attach_runs(chosen, runs, registered)


def attached(spark, sf_dir):
    return model_versions(spark, sf_dir).select(
        "name", "version", "stage", "description", F.size("metrics").alias("n_metrics"), F.size("params").alias("n_params"),
        F.col("tags")["owner"].alias("owner"), F.col("tags")["team"].alias("team"), F.size("tags").alias("n_tags"),
    )


def metric_rows(spark, sf_dir) -> DataFrame:
    return registry.model_metrics(model_versions(spark, sf_dir))


def run_tags(spark, sf_dir):
    _, _, runs = registry_parts(spark, sf_dir)
    tags = user_tags(F.col("tags"))
    return runs.select("run_id", F.array_join(F.map_keys(tags), ", ").alias("keys"),
                       F.array_join(F.map_keys(head_map(F.col("metrics"), 2)), ", ").alias("first_metrics"))


def excluded(spark, sf_dir):
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), "p_type")
    return models.exclude_models(part, names=("cold widget", "hot widget"), patterns=("Giz", "a.b"))


def listed_models(spark, sf_dir):
    registered, _, _ = registry_parts(spark, sf_dir)
    return models.registry_models(registered, like="Supplier%1%", limit=10).select("name", "description")


def ranked(spark, sf_dir):
    return registry.rank_metrics(metric_rows(spark, sf_dir)).select(
        "name", "version", "metric", "direction", "value", "rank", "worst_rank", "n_models")


def fastest(spark, sf_dir):
    return registry.fastest(metric_rows(spark, sf_dir)).select(
        "metric", "name", "version", "value", F.col("accurate.name").alias("accurate_name"),
        F.col("accurate.version").alias("accurate_version"))


def leaders(spark, sf_dir):
    mm = metric_rows(spark, sf_dir)
    return registry.best_accuracy(mm).withColumn("kind", F.lit("accuracy")).unionByName(
        registry.lowest_error(mm).withColumn("kind", F.lit("error")))


def pairwise(spark, sf_dir):
    rows = metric_rows(spark, sf_dir)
    return registry.pairwise_models(rows, registry.neighbours(rows)).drop("metrics")


def pairwise_whole(spark, sf_dir):
    """The whole comparison of every two versions; the list of the compared values, made for each pair, is not shown."""
    return registry.pairwise_all(metric_rows(spark, sf_dir)).drop("metrics")


def pairwise_all(spark, sf_dir):
    """The counts of every comparison alone."""
    return registry.pairwise_all(metric_rows(spark, sf_dir), columns=())


def pareto_versions(spark, sf_dir):
    return registry.pareto_versions(metric_rows(spark, sf_dir), ["accuracy", "inference_latency_ms", "rmse", "r2"])


def pareto_items(spark, sf_dir):
    """Items that no other is at least as good as in quantity, price, discount and tax and better in one of them."""
    items = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return skyline.pareto_front(items, ["l_extendedprice", "l_tax"], ["l_quantity", "l_discount"])


def search_index(spark, sf_dir):
    """All pairs that mention each of some terms, one of them too short for trigrams, found by a stored index."""
    index = search.TrigramIndex.build(combined_pairs(spark, sf_dir), ["instruction", "response"])
    return union_all(index.search(term).withColumn("term", F.lit(term)) for term in SEARCHED)


def search_documents(spark, sf_dir):
    index = search.TrigramIndex.build(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), ["text"])
    return union_all(index.search(term).select("doc_id", "lang", F.lit(term).alias("term")) for term in SEARCHED)


def overall_winner(spark, sf_dir):
    return registry.overall_winner(registry.rank_metrics(metric_rows(spark, sf_dir))).select(
        "name", "version", "wins", "n_metrics")


def version_history(spark, sf_dir):
    steps = registry.version_history(model_versions(spark, sf_dir))
    return steps.select("name", F.inline("steps")).select("name", "version", "stage", F.size("metrics").alias("n_shown"))


def variability(spark, sf_dir):
    return registry.variability(metric_rows(spark, sf_dir)).select(
        "metric", "n_models", F.col("best.name").alias("best"), F.col("worst.name").alias("worst"),
        F.col("best.value").alias("best_value"), F.col("worst.value").alias("worst_value"))


def inventory(spark, sf_dir):
    return registry.metric_inventory(metric_rows(spark, sf_dir)).select("metric", "n_models")


def limitations(spark, sf_dir):
    return registry.limitations(model_versions(spark, sf_dir)).select("name", "version", "kind", "metric", "value", "n_params")


def acceptance(spark, sf_dir):
    limits = spark.sql(
        "select * from values ('r2', '>', 0.8D), ('rmse', '<', 0.05D), ('inference_latency_ms', '<=', 40D), ('f1', '>=', 0.95D) "
        "as t(metric, op, threshold)")
    return registry.acceptance(metric_rows(spark, sf_dir), limits)


def tasks(spark, sf_dir) -> DataFrame:
    """One task per nation."""
    return read(spark, sf_dir, "nation").select(
        F.concat(F.lit("Forecast demand in "), "n_name").alias("task"),
        F.when(F.col("n_regionkey") % 2 == 0, F.concat(F.lit("Region "), "n_regionkey")).otherwise("").alias("criteria"))


def recommendation_record(spark, sf_dir):
    versions, asked = model_versions(spark, sf_dir), tasks(spark, sf_dir)
    answers = asked.select("task", F.concat(F.lit("Use the first model for: "), "task").alias("recommendation"))
    record = prompts.recommendation_record(prompts.recommendation_prompt(asked, versions, 10), versions, answers, 10)
    return record.select(
        "task", "recommendation", F.length("prompt_used").alias("prompt_chars"), F.size("models_evaluated").alias("n_models"),
        F.col("models_evaluated")[0]["name"].alias("first_model"))


def registry_qa(spark, sf_dir) -> DataFrame:
    """All pairs of texts, but versions compared with the next one only, as in the SQL."""
    versions = model_versions(spark, sf_dir).transform(cut_lineage)
    return qa_registry.qa_registry(versions, compared=registry.neighbours(registry.model_metrics(versions)))


def registry_qa_all(spark, sf_dir) -> DataFrame:
    return qa_registry.qa_registry(model_versions(spark, sf_dir).transform(cut_lineage))


def registry_family(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def query(spark, sf_dir):
        versions = model_versions(spark, sf_dir).transform(cut_lineage)
        return build(versions, registry.model_metrics(versions))
    return query


# ---- evaluation -------------------------------------------------------------------

def losses(spark, sf_dir) -> DataFrame:
    """Losses of held-out texts under models of the other languages than English and of all languages."""
    docs = ranking.split_hash(read(spark, sf_dir, "documents"), ["doc_id"], 0.25)
    held_out = docs.filter("is_val")
    train = docs.filter("not is_val")
    base = evals.unigram_losses(train.filter("lang != 'en'"), held_out, "doc_id")
    adapted = evals.unigram_losses(train, held_out, "doc_id")
    return base.withColumn("model", F.lit("base")).unionByName(adapted.withColumn("model", F.lit("adapted")))


def perplexity(spark, sf_dir):
    scores = evals.perplexity(losses(spark, sf_dir), ["model"])
    return rounded(rounded(scores, 4, "perplexity"), 6, "avg_loss", "std_loss")


def verdict(spark, sf_dir):
    scores = evals.perplexity(losses(spark, sf_dir), ["model"]).withColumn("domain", F.lit("all"))
    return rounded(evals.compare_perplexity(scores, ["domain"]), 4, "base_perplexity", "adapted_perplexity", "improvement_pct")


def unigram_losses(spark, sf_dir):
    return rounded(losses(spark, sf_dir), 6, "loss")


def training_summary(spark, sf_dir):
    log = read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run"), F.col("o_orderkey").alias("step"), (F.col("o_totalprice") / 100000).alias("train_loss"),
        F.when(F.col("o_orderkey") % 50 == 0, F.col("o_totalprice") / 200000).alias("eval_loss"))
    return rounded(evals.training_summary(log, ["run"]), 6, "final_train_loss", "best_train_loss", "final_eval_loss",
                   "best_eval_loss", "eval_perplexity")


def compare_responses(spark, sf_dir):
    said = read(spark, sf_dir, "conversations").filter("role = 'assistant'").groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("first"), F.max_by("text", "turn").alias("last"))
    prompt = F.col("conv_id").cast("string").alias("prompt")
    return evals.compare_responses(
        said.select(prompt, F.col("first").alias("response")), said.select(prompt, F.col("last").alias("response")))


def on_profile(build: Callable[[Profile], DataFrame], keep: bool = False) -> Query:
    return lambda spark, sf_dir: build(profile(spark, sf_dir, keep))


def cross_table(spark, sf_dir):
    return qa_tables.qa_cross_table(Profile(related(spark, sf_dir)))


def row_sentences(spark, sf_dir):
    tables = shop(spark, sf_dir)
    return union_all(
        verbalize.row_to_text(tables.tables[name], name, tables.roles[name]).select(F.lit(name).alias("table"), "text")
        for name in tables.names
    )


def passages(spark, sf_dir):
    tables = shop(spark, sf_dir)
    sizes = tables.row_counts()
    return union_all(
        verbalize.build_passages(df, name, tables.roles[name], sizes[name], KEYS[name]) for name, df in tables.tables.items()
    )


def all_table_pairs(spark, sf_dir):
    return qa_tables.qa_tables(profile(spark, sf_dir, keep=True), KEYS)


def drop_blanked(spark, sf_dir):
    """pages where every third is blank and every fifth has no text."""
    pages = read(spark, sf_dir, "pages").withColumn("html", F.expr(
        "case when page_id % 3 = 0 then ' \\n\\t' when page_id % 5 = 0 then null else html end"))
    return corpus.drop_blank(pages, "html").select("page_id", "url")


def table_overwrite(spark, sf_dir):
    """All orders, saved under the name of a table that held all customers."""
    name = f"overwritten_{uuid.uuid4().hex}"
    files.save_table(read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), name)
    files.save_table(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), name)
    return spark.table(name)


def json_result(spark, sf_dir):
    folder = f"{ensure_checkpoint_dir(spark)}/result-{uuid.uuid4().hex}"
    nested = read(spark, sf_dir, "supplier").selectExpr("s_suppkey", "struct(s_name as name, s_nationkey as nation) as about")
    files.write_result(nested, folder)
    return spark.read.schema("s_suppkey long, about struct<name: string, nation: int>").json(folder).select(
        "s_suppkey", "about.name", "about.nation")


def catalog_tables(spark, sf_dir):
    """Row counts of two tables found by listing a database."""
    database = f"listed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database}")
    for name in ("nation", "supplier", "region"):
        files.save_table(read(spark, sf_dir, name), f"{database}.{name}")
    found = TableSet.from_catalog(spark, database, exclude=("region",))
    return union_all(df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows") for name, df in found.tables.items())


def overlap_types(spark, sf_dir):
    """Whole numbers beyond 2**53 as bigint and as decimal."""
    orders = read(spark, sf_dir, "orders")
    tables = TableSet(spark, {
        "whole": orders.selectExpr("o_orderkey + 9007199254740992 as key"),
        "exact": orders.selectExpr("cast(o_orderkey * 2 + 9007199254740992 as decimal(20, 0)) as key"),
    })
    return rounded(relate.column_overlap(tables), 6, "pct_of_smaller")


def metric_direction(spark, sf_dir):
    named = read(spark, sf_dir, "supplier").selectExpr(
        "element_at(array('mape', 'sentiment_f1', 'fit_time', 'val_loss', 'r2'), cast(s_suppkey % 5 as int) + 1) as metric")
    return named.groupBy("metric").agg(F.count(F.lit(1)).alias("n")).select(
        "metric", "n", registry.direction(F.col("metric")).alias("direction"),
        registry.name_has(F.col("metric"), registry.LATENCY_HINTS).alias("is_latency"))


QUERIES: dict[str, Query] = {
    # profiles
    "table_profile": on_profile(lambda p: p.table_sizes.drop("table_position")),
    "numeric_profile": numeric_profile,
    "null_profile": on_profile(lambda p: rounded(p.nulls.drop("position"), 6, "pct_null")),
    "completeness": on_profile(lambda p: rounded(p.completeness, 6, "pct_complete")),
    "value_counts": on_profile(lambda p: p.values.drop("position")),
    "correlations": on_profile(lambda p: rounded(p.correlations.select("table", "col_a", "col_b", "r"), 6, "r"), keep=True),
    "corr_classes": on_profile(lambda p: p.corr_classes.drop("pos_a", "pos_b", "r"), keep=True),
    "most_connected": on_profile(lambda p: rounded(p.most_connected.drop("partners"), 6, "mean_r"), keep=True),
    "iqr_outliers": iqr_outliers,
    "multi_outliers": on_profile(lambda p: p.multi_outliers, keep=True),
    "bimodality": bimodality,
    "class_balance": on_profile(lambda p: p.class_balance),
    "compare_groups": compare_groups,
    "subgroups": subgroups,
    "surprising_groups": on_profile(lambda p: rounded(
        groups.surprising_groups(p).select("table", "cat", "num", "value", "z", "is_high"), 4, "z"), keep=True),
    "sanity_checks": on_profile(lambda p: rounded(p.sanity.drop("check"), 4, "pct"), keep=True),
    "metadata_presence": metadata_presence,
    "sufficiency": on_profile(lambda p: rounded(p.sufficiency, 6, "ratio")),
    "highlights": highlights,
    "shared_columns": shared_columns,
    "column_overlap": lambda s, d: rounded(relate.column_overlap(related(s, d)), 6, "pct_of_smaller"),
    "join_gain": join_gain,
    "top_categories": top_categories,
    # sources and corpora
    "scan_tables": scan_tables,
    "schema_text": lambda s, d: load_schema_text(shop(s, d).subset(GIVEN)),
    "extract_text": extract,
    "take_first": lambda s, d: ranking.take_first(
        read(s, d, "documents").select("doc_id", "lang", "n_chars"), 300, ["n_chars", "doc_id"]),
    "jsonl_roundtrip": jsonl_roundtrip,
    "clean_text": lambda s, d: corpus.clean_column(read(s, d, "documents")).select("doc_id", "text"),
    "length_filter": lambda s, d: corpus.filter_by_length(read(s, d, "documents")).select("doc_id", "text"),
    "drop_blank": lambda s, d: corpus.drop_blank(read(s, d, "pages"), "html").select("page_id", "url"),
    "dedup_exact": lambda s, d: prepared(s, d).select("doc_id", "text"),
    "corpus_stats": corpus_stats,
    "document_funnel": document_funnel,
    "split_exact": split_exact,
    "split_hash": lambda s, d: ranking.split_hash(read(s, d, "orders"), ["o_orderkey"], 0.05).select("o_orderkey", "is_val"),
    "replay_mix": replay_mix,
    "sample_rows": lambda s, d: ranking.sample_rows(read(s, d, "orders"), 25, ["o_orderkey"]).select("o_orderkey", "o_totalprice"),
    "sample_per_group": lambda s, d: ranking.sample_per_group(read(s, d, "documents"), "lang", 3, ["doc_id"]).select("lang", "doc_id"),
    "numbered_rows": lambda s, d: ranking.number_rows(
        read(s, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"]),
    "sequence_budget": sequence_budget,
    # instruction data
    "instruct": lambda s, d: instruct.to_instruct(turn_pairs(s, d)).select("conv_id", "turn", "text"),
    "combine_qa": combined_pairs,
    "category_counts": lambda s, d: instruct.category_counts(combined_pairs(s, d)),
    "search_index": search_index,
    "search_documents": search_documents,
    "search_qa": lambda s, d: instruct.search_qa(combined_pairs(s, d), "THE "),
    "cap_pairs": cap_pairs,
    "chat_prompt": lambda s, d: instruct.chat_prompt(read(s, d, "conversations")),
    "extract_response": extract_response,
    "mask_spans": mask_spans,
    "subword_masks": subword_masks,
    "subword_budget": subword_budget,
    # values
    "number_texts": number_texts,
    "json_values": json_values,
    # verbalisation
    "row_text": row_sentences,
    "passages": passages,
    "table_overview": on_profile(verbalize.table_overviews),
    "schema_overview": on_profile(verbalize.schema_overview),
    "corpus": on_profile(lambda p: verbalize.build_corpus(p, KEYS), keep=True),
    # questions about tables
    "qa_rows": on_profile(lambda p: qa_tables.qa_rows(p, KEYS)),
    "qa_range": on_profile(qa_tables.qa_range),
    "qa_top_values": on_profile(qa_tables.qa_top_values, keep=True),
    "qa_comparison": on_profile(qa_tables.qa_comparison),
    "qa_schema": on_profile(qa_tables.qa_schema, keep=True),
    "qa_reasoning": on_profile(qa_tables.qa_reasoning, keep=True),
    "qa_nulls": on_profile(qa_tables.qa_nulls, keep=True),
    "qa_outliers": on_profile(qa_tables.qa_outliers, keep=True),
    # a table with NULL, NaN, constant, skewed and related columns
    "gaps_numeric": lambda s, d: numeric_profile(s, d, gaps),
    "gaps_nulls": lambda s, d: rounded(gaps(s, d).nulls.drop("position"), 6, "pct_null"),
    "gaps_corr_classes": lambda s, d: gaps(s, d).corr_classes.drop("pos_a", "pos_b", "r"),
    "gaps_outliers": lambda s, d: iqr_outliers(s, d, gaps),
    "gaps_multi_outliers": lambda s, d: gaps(s, d).multi_outliers,
    "gaps_bimodality": lambda s, d: bimodality(s, d, gaps),
    "gaps_subgroups": lambda s, d: subgroups(s, d, gaps),
    "gaps_surprising": lambda s, d: rounded(groups.surprising_groups(gaps(s, d)).select("table", "cat", "num", "value", "z", "is_high"), 4, "z"),
    "gaps_sanity": lambda s, d: rounded(gaps(s, d).sanity.drop("check"), 4, "pct"),
    "gaps_qa_correlation": lambda s, d: qa_tables.qa_correlation(gaps(s, d)),
    "gaps_qa_anomaly": lambda s, d: qa_tables.qa_anomaly(gaps(s, d)),
    "gaps_qa_sanity": lambda s, d: qa_tables.qa_sanity(gaps(s, d)),
    # sinks, sources and types
    "drop_blanked": drop_blanked,
    "table_overwrite": table_overwrite,
    "json_result": json_result,
    "catalog_tables": catalog_tables,
    "overlap_types": overlap_types,
    "metric_direction": metric_direction,
    "qa_sanity": on_profile(qa_tables.qa_sanity, keep=True),
    "qa_uncertainty": on_profile(qa_tables.qa_uncertainty, keep=True),
    "qa_reproducibility": on_profile(qa_tables.qa_reproducibility, keep=True),
    "qa_correlation": on_profile(qa_tables.qa_correlation, keep=True),
    "qa_cross_table": cross_table,
    "qa_subgroups": on_profile(qa_tables.qa_subgroups, keep=True),
    "qa_anomaly": on_profile(qa_tables.qa_anomaly, keep=True),
    "qa_interpretation": on_profile(qa_tables.qa_interpretation, keep=True),
    "qa_tables": all_table_pairs,
    # registry
    "registry_models": listed_models,
    "exclude_models": excluded,
    "versions_by_stage": lambda s, d: models.by_stage(registry_parts(s, d)[1], ("Production", "Staging")),
    "latest_versions": lambda s, d: models.latest_versions(registry_parts(s, d)[1]),
    "cap_versions": lambda s, d: models.cap_versions(registry_parts(s, d)[1], 20, 3),
    "attach_runs": attached,
    "run_tags": run_tags,
    "rank_metrics": ranked,
    "pairwise_models": pairwise_whole,
    "pairwise_neighbours": pairwise,
    "pairwise_all": pairwise_all,
    "version_wins": lambda s, d: registry.version_wins(metric_rows(s, d)),
    "pareto_versions": pareto_versions,
    "pareto_items": pareto_items,
    "overall_winner": overall_winner,
    "fastest": fastest,
    "metric_leaders": leaders,
    "trade_off": lambda s, d: registry.trade_off(metric_rows(s, d)),
    "version_history": version_history,
    "production_risk": lambda s, d: registry.production_risk(registry.rank_metrics(metric_rows(s, d))),
    "variability": variability,
    "metric_inventory": inventory,
    "stage_counts": lambda s, d: registry.stage_counts(model_versions(s, d)),
    "registry_totals": lambda s, d: registry.registry_totals(model_versions(s, d)).select(
        "n_models", "n_versions", "n_metrics", "n_params", F.array_join("metrics", ", ").alias("metrics")),
    "limitations": limitations,
    "acceptance": acceptance,
    "models_block": lambda s, d: prompts.models_block(model_versions(s, d), 10),
    "models_blocks": lambda s, d: prompts.models_blocks(model_versions(s, d), 25),
    "recommendation_prompts": lambda s, d: prompts.recommendation_prompts(tasks(s, d), model_versions(s, d), 25).select(
        "task", "block", "prompt"),
    "recommendation_prompt": lambda s, d: prompts.recommendation_prompt(tasks(s, d), model_versions(s, d), 10).select("task", "prompt"),
    "recommendation_record": recommendation_record,
    "qa_model_info": registry_family(lambda v, mm: qa_registry.qa_model_info(v)),
    "qa_model_comparison": registry_family(lambda v, mm: qa_registry.qa_model_comparison(mm)),
    "qa_model_comparison_neighbours": registry_family(lambda v, mm: qa_registry.qa_model_comparison(mm, registry.neighbours(mm))),
    "qa_model_comparison_all": registry_family(lambda v, mm: qa_registry.qa_model_comparison(mm)),
    "qa_recommendation": registry_family(lambda v, mm: union_all(
        [qa_registry.qa_overall(v, mm), qa_registry.qa_speed(mm), qa_registry.qa_accuracy(mm)])),
    "qa_deployment": registry_family(lambda v, mm: qa_registry.qa_deployment(v)),
    "qa_trade_off": registry_family(qa_registry.qa_trade_off),
    "qa_overview": registry_family(qa_registry.qa_overview),
    "qa_reliability": registry_family(qa_registry.qa_reliability),
    "qa_registry_reproducibility": registry_family(lambda v, mm: qa_registry.qa_reproducibility(v)),
    "qa_fitness": registry_family(qa_registry.qa_fitness),
    "qa_registry": registry_qa_all,
    "qa_registry_neighbours": registry_qa,
    "qa_registry_all": registry_qa_all,
    # evaluation
    "unigram_losses": unigram_losses,
    "perplexity": perplexity,
    "verdict": verdict,
    "training_summary": training_summary,
    "compare_responses": compare_responses,
}
