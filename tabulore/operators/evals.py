"""Evaluation aggregates: perplexity, verdicts, training logs, side-by-side responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.operators.corpus import words
from tabulore.session import cut_lineage

HEAVY_SHARE = 1000


def perplexity(losses: DataFrame, by: Sequence[str] = (), loss: str = "loss", tokens: str = "n_tokens") -> DataFrame:
    """Token-weighted perplexity and loss spread per group of evaluated samples."""
    avg_loss = F.sum(F.col(loss) * F.col(tokens)) / F.sum(tokens)
    return losses.groupBy(*by).agg(
        F.exp(avg_loss).alias("perplexity"),
        avg_loss.alias("avg_loss"),
        F.stddev_pop(loss).alias("std_loss"),
        F.count(F.lit(1)).alias("num_samples"),
        F.sum(tokens).alias("total_tokens"),
    )


def token_counts(df: DataFrame, by: Sequence[str], column: str = "text") -> DataFrame:
    return (
        df.select(*by, F.explode(words(F.col(column))).alias("token"))
        .groupBy(*by, "token").agg(F.count(F.lit(1)).alias("n"))
    )


def unigram_losses(train: DataFrame, evaluated: DataFrame, key: str, column: str = "text", heavy_share: int = HEAVY_SHARE) -> DataFrame:
    """(key, n_tokens, loss): mean negative log likelihood of each evaluated text.

    The model is an add-one smoothed unigram count of the training texts, with one extra class for unseen tokens. Counts
    of both sides are partitioned by token, so each row of the vocabulary is moved once. Tokens that make up
    one of ``heavy_share`` evaluated (text, token) rows or more would meet in one task; there are at most
    ``heavy_share`` of them, and their rows stay where they are and get the model's part by broadcast.
    """
    model = cut_lineage(token_counts(train, [], column).withColumnRenamed("n", "n_seen"))
    size = model.agg(F.count(F.lit(1)).alias("types"), F.coalesce(F.sum("n_seen"), F.lit(0)).alias("tokens")).first()
    total = float(size["tokens"] + size["types"] + 1)
    counted = cut_lineage(token_counts(evaluated, [key], column))
    least = F.lit(max(1, -(-counted.count() // heavy_share)))
    found = counted.groupBy("token").agg(F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= least).select("token")
    heavy = F.broadcast(cut_lineage(found.join(model, "token", "left").withColumn("heavy", F.lit(True))))
    # At most ``heavy_share`` rows are broadcast.
    split = counted.join(heavy, "token", "left")
    common = split.where("heavy").drop("heavy")
    rare = split.where("heavy IS NULL").drop("heavy", "n_seen").join(model, "token", "left")
    nll = -F.log((F.coalesce("n_seen", F.lit(0)) + 1) / F.lit(total))
    return common.select(key, "n", "n_seen").unionByName(rare.select(key, "n", "n_seen")).groupBy(key).agg(
        F.sum("n").alias("n_tokens"), (F.sum(F.col("n") * nll) / F.sum("n")).alias("loss")
    )


def unigram_perplexity(train: DataFrame, evaluated: DataFrame, key: str, column: str = "text", **options) -> DataFrame:
    return perplexity(unigram_losses(train, evaluated, key, column, **options))


def improvement(base: Column, adapted: Column) -> Column:
    return (base - adapted) / base * 100


def verdict(pct: Column) -> Column:
    return F.when(pct > 15, "SUCCESS").when(pct > 5, "PARTIAL").otherwise("MINIMAL")


def compare_perplexity(scores: DataFrame, key: Sequence[str], model: str = "model",
                       base: str = "base", adapted: str = "adapted") -> DataFrame:
    """Improvement and verdict per key from (key, model, perplexity) rows."""
    wide = scores.groupBy(*key).pivot(model, [base, adapted]).agg(F.first("perplexity"))
    pct = improvement(F.col(base), F.col(adapted))
    return wide.select(
        *key, F.col(base).alias("base_perplexity"), F.col(adapted).alias("adapted_perplexity"),
        pct.alias("improvement_pct"), verdict(pct).alias("verdict"),
    )


def compare_responses(base: DataFrame, adapted: DataFrame, prompt: str = "prompt", response: str = "response") -> DataFrame:
    """Responses of two models side by side."""
    return base.select(prompt, F.col(response).alias("base_response")).join(
        adapted.select(prompt, F.col(response).alias("adapted_response")), prompt
    )


def training_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Final and best losses of a training log; perplexity from the final evaluation loss."""
    evaluated = F.when(F.col("eval_loss").isNotNull(), F.col("step"))
    return log.groupBy(*by).agg(
        F.max("step").alias("total_steps"),
        F.max_by("train_loss", "step").alias("final_train_loss"),
        F.min("train_loss").alias("best_train_loss"),
        F.max_by("eval_loss", evaluated).alias("final_eval_loss"),
        F.min("eval_loss").alias("best_eval_loss"),
        F.exp(F.max_by("eval_loss", evaluated)).alias("eval_perplexity"),
    )
