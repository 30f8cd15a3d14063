"""Prompts that ask for a model recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulore.functions.text import fill, fixed, ordered, sql
from tabulore.functions.values import sorted_entries
from tabulore.operators.registry import blocked
from tabulore.plans.templates import PROMPTS
from tabulore.session import cut_lineage


def _entries(mapping: str, value: str) -> str:
    entry = fill(PROMPTS["model_entry"], key="e.key", value=value)
    text = f"array_join(transform({sorted_entries(mapping)}, e -> {entry}), {sql(chr(10))})"
    return f"if(size({mapping}) > 0, {text}, null)"


def models_block(versions: DataFrame, limit: int) -> DataFrame:
    """(models): one text describing the first ``limit`` versions by name."""
    shown = versions.orderBy("name", "version").limit(limit)
    return _described(shown).agg(F.expr(SHOWN).alias("models")).selectExpr(f"{_listed('0')} as models")


def models_blocks(versions: DataFrame, size: int) -> DataFrame:
    """(block, models): all versions by name, ``size`` in each text; numbers go on from block to block."""
    shown = _described(blocked(versions, size), "block").groupBy("block").agg(F.expr(SHOWN).alias("models"))
    return shown.selectExpr("block", f"{_listed(f'block * {int(size)}')} as models")


SHOWN = ordered("name, version, stage, description, metrics_text, params_text")


def _described(versions: DataFrame, *columns: str) -> DataFrame:
    return versions.selectExpr(
        *columns, "name", "version", "stage", "description",
        f"{_entries('metrics', fixed('e.value', 4))} as metrics_text",
        f"{_entries('params', 'e.value')} as params_text",
    )


def _listed(before: str) -> str:
    """SQL: the text of the versions in ``models``, after so many others."""
    lines = ", ".join([
        fill(PROMPTS["model_head"], index=f"{before} + k + 1", model="m.name", version="m.version"),
        fill(PROMPTS["model_stage"], stage="m.stage"),
        f"if(m.description != '', {fill(PROMPTS['model_description'], description='m.description')}, null)",
        sql(PROMPTS["model_metrics"]),
        "m.metrics_text",
        f"if(m.params_text is null, null, {sql(PROMPTS['model_params'])})",
        "m.params_text",
        "''",
    ])
    newline = sql("\n")
    return f"array_join(transform(models, (m, k) -> concat_ws({newline}, {lines})), {newline})"


def recommendation_prompt(tasks: DataFrame, versions: DataFrame, limit: int) -> DataFrame:
    """Add ``prompt`` to (task, criteria) rows; the models text is one shared value."""
    return tasks.withColumn("_models", models_block(versions, limit).scalar()).withColumn("prompt", F.expr(_prompt())).drop("_models")


def recommendation_prompts(tasks: DataFrame, versions: DataFrame, size: int) -> DataFrame:
    """(task, criteria, block, prompt): each task asked about all versions, ``size`` of them in each prompt."""
    blocks = cut_lineage(models_blocks(versions, size))
    last = blocks.agg(F.max("block")).first()[0]
    numbers = F.array().cast("array<bigint>") if last is None else F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))
    asked = tasks.withColumn("block", F.explode(numbers))
    return asked.join(blocks.withColumnRenamed("models", "_models"), "block").withColumn("prompt", F.expr(_prompt())).drop("_models")


def _prompt() -> str:
    criteria = f"if(criteria != '', {fill(PROMPTS['criteria'], criteria='criteria')}, null)"
    return fill(PROMPTS["recommendation"], task="task", models="_models", criteria=f"coalesce({criteria}, '')")


def recommendation_record(prompts: DataFrame, versions: DataFrame, responses: DataFrame, limit: int) -> DataFrame:
    """(task, models_evaluated, recommendation, prompt_used) from generated responses by task."""
    evaluated = versions.orderBy("name", "version").limit(limit).agg(
        F.collect_list(F.struct("name", "version", "stage", "metrics"))
    ).scalar()
    return prompts.join(responses, "task").select(
        "task", evaluated.alias("models_evaluated"), "recommendation", F.col("prompt").alias("prompt_used")
    )
