"""Model registry tables: listing, filters, run attachment and version limits.

A registry is three tables: models (name, description, tags), versions (name,
version, stage, description, run_id) and runs (run_id, metrics, params, tags).
Together they give ``model_versions``:
(name, version, stage, description, run_id, metrics, params, tags).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulore.functions.values import merge_tags, user_tags

DEFAULT_STAGES = ("Production", "Staging", "None")

MODEL_VERSION_SCHEMA = (
    "name string, version int, stage string, description string, run_id string, "
    "metrics map<string,double>, params map<string,string>, tags map<string,string>"
)


def registry_models(models: DataFrame, like: str | None = None, limit: int | None = None) -> DataFrame:
    """Registered models by name, optionally filtered by a LIKE pattern and cut to the first few."""
    listed = models if like is None else models.filter(F.col("name").like(like))
    return listed if limit is None else listed.orderBy("name").limit(limit)


def exclude_models(df: DataFrame, names: Sequence[str] = (), patterns: Sequence[str] = ()) -> DataFrame:
    """Drop models by exact name or by a case-insensitive part of the name."""
    kept = df.filter(~F.col("name").isin(*names)) if names else df
    if patterns:
        kept = kept.filter(~F.lower("name").rlike("|".join(re.escape(p.lower()) for p in patterns)))
    return kept


def by_stage(versions: DataFrame, stages: Sequence[str] = DEFAULT_STAGES) -> DataFrame:
    return versions.filter(F.col("stage").isin(*stages))


def latest_versions(versions: DataFrame) -> DataFrame:
    """Newest version of each model in each stage."""
    newest = Window.partitionBy("name", "stage").orderBy(F.desc("version"))
    return versions.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") == 1).drop("_place")


def cap_versions(versions: DataFrame, max_models: int, max_versions: int) -> DataFrame:
    """The first models by name and the newest versions of each."""
    names = versions.select("name").distinct().orderBy("name").limit(max_models)
    order = Window.partitionBy("name").orderBy(F.desc("version"))
    return (
        versions.join(names, "name", "left_semi")
        .withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= max_versions).drop("_place")
    )


def attach_runs(versions: DataFrame, runs: DataFrame, models: DataFrame | None = None,
                keep_missing: bool = True) -> DataFrame:
    """``model_versions``: metrics, params and tags of the run behind each version.

    Versions without a run keep empty maps, or are dropped with
    ``keep_missing=False``. Tags are merged per version, run tags first.
    """
    run = runs.select("run_id", "metrics", "params", F.col("tags").alias("run_tags"))
    joined = versions.join(run, "run_id", "left" if keep_missing else "inner")
    if models is not None:
        joined = joined.join(
            models.select("name", F.col("description").alias("model_description"), F.col("tags").alias("model_tags")),
            "name", "left",
        )
    else:
        joined = joined.withColumn("model_description", F.lit(None).cast("string")).withColumn(
            "model_tags", F.lit(None).cast("map<string,string>")
        )
    own = F.when(F.col("description") != "", F.col("description"))
    return joined.select(
        "name", F.col("version").cast("int").alias("version"), "stage",
        F.coalesce(own, F.col("model_description"), F.lit("")).alias("description"), "run_id",
        F.coalesce("metrics", F.create_map().cast("map<string,double>")).alias("metrics"),
        F.coalesce("params", F.create_map().cast("map<string,string>")).alias("params"),
        merge_tags(F.col("model_tags"), user_tags(F.col("run_tags"))).alias("tags"),
    )


def sample_registry(spark: SparkSession) -> DataFrame:
    """A few model versions to try things out without a registry: bakeries guessing tomorrow's bread sales."""
    kinds = ("loaf", "roll", "rye")
    rows = [
        (
            f"bread_{kind}", version, stage, f"Guesses how many of kind {kind} are sold", f"oven-{kind}-{version}",
            {"mae": 9.0 - 2 * version - i, "accuracy": 0.5 + 0.1 * version + 0.05 * i, "latency_ms": 3.0 * (version + i)},
            {"days": str(7 * version), "random_seed": str(i)}, {"shop": f"s{i}"},
        )
        for i, kind in enumerate(kinds)
        for version, stage in ((1, "Production"), (2, "Staging"))
    ]
    return spark.createDataFrame(rows, MODEL_VERSION_SCHEMA)


def sample_documents(spark: SparkSession, copies: int = 20) -> DataFrame:
    """Five short notes from a garden diary, repeated, for trying the preparation steps."""
    plants = ("beans", "carrots", "pears", "leeks", "plums")
    base = spark.createDataFrame(list(enumerate(plants)), "text_id int, plant string").select(
        "text_id",
        F.format_string(
            "Row %d of the garden has %s this year. They were watered on %d mornings, turned towards the south wall, and "
            "picked in the week after the fair, when the baskets were full.", F.col("text_id") + 1, F.col("plant"), 3 * F.col("text_id") + 4,
        ).alias("text"),
    )
    return base.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("copy") * len(plants) + F.col("text_id")).alias("doc_id"), "text"
    )
