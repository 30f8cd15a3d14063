"""Instruction data: combine, render, extract, mask."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulore.functions.text import WHITESPACE, fill, joined, ref
from tabulore.operators.corpus import words
from tabulore.plans.templates import PROMPTS
from tabulore.sources.tables import union_all

IGNORED_LABEL = -100


def combine_qa(*frames: DataFrame) -> DataFrame:
    return union_all(frames)


def category_counts(qa: DataFrame) -> DataFrame:
    return qa.groupBy("category").agg(F.count(F.lit(1)).alias("n"))


def search_qa(qa: DataFrame, term: str, n: int = 5, order_by=("instruction", "response")) -> DataFrame:
    """Pairs that mention a term in question or answer, ignoring case."""
    wanted = term.lower()
    hit = F.lower("instruction").contains(wanted) | F.lower("response").contains(wanted)
    return qa.filter(hit).orderBy(*order_by).limit(n)


def to_instruct(qa: DataFrame) -> DataFrame:
    """Add ``text``: question and answer in the instruction template."""
    return qa.withColumn("text", F.expr(fill(PROMPTS["instruct"], instruction="instruction", response="response")))


def chat_prompt(turns: DataFrame, key: str = "conv_id", turn: str = "turn",
                role: str = "role", text: str = "text") -> DataFrame:
    """One prompt per conversation from its turns; other roles are ignored."""
    said = F.expr(
        f"case {ref(role)} when 'user' then {fill(PROMPTS['chat_user'], text=ref(text))} "
        f"when 'assistant' then {fill(PROMPTS['chat_assistant'], text=ref(text))} end"
    )
    parts = f"sort_array(collect_list(struct({ref(turn)} as turn, said)))"
    prompt = fill(PROMPTS["chat_start"] + "{said}", said=joined(parts, "", "i.said"))
    return turns.withColumn("said", said).groupBy(key).agg(F.expr(prompt).alias("prompt"))


def extract_response(text: Column, prompt: Column) -> Column:
    """Text after the last instruction end, else after the prompt's length, without white space around it."""
    end = PROMPTS["instruction_end"]
    after_prompt = F.substring(text, F.length(prompt) + 1, F.length(text))
    answer = F.when(text.contains(end), F.substring_index(text, end, -1)).otherwise(after_prompt)
    return F.regexp_replace(answer, rf"^{WHITESPACE}+|{WHITESPACE}+$", "")


def mask_spans(df: DataFrame, max_len: int = 1024, column: str = "text") -> DataFrame:
    """Label mask over whitespace tokens: tokens up to the instruction end are ignored.

    Adds n_tokens, n_masked, n_trainable after truncation, and ``labels`` with
    the ignored label in place of masked tokens (positions elsewhere).
    """
    end = PROMPTS["instruction_end"]
    text = F.col(column)
    found = F.instr(text, end)
    head = F.when(found > 0, F.substring(text, F.lit(1), found + len(end) - 1)).otherwise(F.lit(""))
    sized = (
        df.withColumn("n_tokens", F.least(F.size(words(text)), F.lit(max_len)))
        .withColumn("n_masked", F.least(F.size(words(head)), F.col("n_tokens")))
        .withColumn("n_trainable", F.col("n_tokens") - F.col("n_masked"))
    )
    positions = F.when(
        F.col("n_trainable") > 0, F.sequence(F.col("n_masked"), F.col("n_tokens") - 1)
    ).otherwise(F.array().cast("array<int>"))
    return sized.withColumn(
        "labels", F.concat(F.array_repeat(F.lit(IGNORED_LABEL), F.col("n_masked")), positions)
    )
