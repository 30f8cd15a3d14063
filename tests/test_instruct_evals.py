import math

import pytest
from pyspark.sql import functions as F

from tabulore.operators import evals, instruct


def test_chat_prompt(spark):
    turns = spark.createDataFrame(
        [(1, 2, "user", "more"), (1, 1, "assistant", "yes"), (1, 0, "user", "hi"), (2, 0, "system", "be kind")],
        "conv_id int, turn int, role string, text string")
    prompt = {r.conv_id: r.prompt for r in instruct.chat_prompt(turns).collect()}
    assert prompt == {1: "<s>[INST] hi [/INST] yes</s><s>[INST] more [/INST] ", 2: "<s>"}


def test_instruction_and_mask(spark):
    qa = spark.createDataFrame([("a b", "c d e", "x")], "instruction string, response string, category string")
    text = instruct.to_instruct(qa)
    assert text.first().text == "<s>[INST] a b [/INST] c d e</s>"
    row = instruct.mask_spans(text).first()
    assert (row.n_tokens, row.n_masked, row.n_trainable) == (7, 4, 3)
    assert row.labels == [-100] * 4 + [4, 5, 6]
    cut = instruct.mask_spans(text, max_len=3).first()
    assert (cut.n_masked, cut.n_trainable, cut.labels) == (3, 0, [-100] * 3)
    plain = instruct.mask_spans(spark.createDataFrame([("no marker",)], "text string")).first()
    assert (plain.n_masked, plain.labels) == (0, [0, 1])


def test_extract_response(spark):
    df = spark.createDataFrame([("[INST] q [/INST] x [/INST]  y ", "p"), ("prompt rest ", "prompt")], "t string, p string")
    assert [r[0] for r in df.select(instruct.extract_response(F.col("t"), F.col("p"))).collect()] == ["y", "rest"]


def test_search(spark):
    qa = spark.createDataFrame([(f"q{i}", "The Average" if i % 2 else "none", "c") for i in range(20)],
                               "instruction string, response string, category string")
    assert [r.instruction for r in instruct.search_qa(qa, "average").collect()] == ["q1", "q11", "q13", "q15", "q17"]
    both = instruct.combine_qa(qa, qa.select("category", "response", "instruction"))
    assert instruct.category_counts(both).first().n == 40


def test_perplexity(spark):
    losses = spark.createDataFrame([(1.0, 10), (3.0, 30)], "loss double, n_tokens int")
    row = evals.perplexity(losses).first()
    assert row.avg_loss == pytest.approx(2.5) and row.perplexity == pytest.approx(math.exp(2.5))
    assert (row.std_loss, row.num_samples, row.total_tokens) == (1.0, 2, 40)


def test_unigram_losses_do_not_depend_on_heavy_tokens(spark):
    train = spark.createDataFrame([("the cat the dog",), ("the end",)], "text string")
    held = spark.createDataFrame([(1, "the the new"), (2, "cat dog"), (3, "the")], "id int, text string")
    key = lambda df: [(r.id, r.n_tokens, round(r.loss, 12)) for r in df.orderBy("id").collect()]
    small = key(evals.unigram_losses(train, held, "id"))
    # No token is heavy with a share of one, all are with the default.
    assert small == key(evals.unigram_losses(train, held, "id", heavy_share=1))
    # 6 tokens, 4 types, one class for unseen tokens: the smoothed total is 11.
    assert small[0] == (1, 3, round((-2 * math.log(4 / 11) - math.log(1 / 11)) / 3, 12))


def test_verdict(spark):
    df = spark.createDataFrame([(8.42, 4.66), (10.0, 9.0), (10.0, 9.9)], "base double, adapted double")
    rows = df.select(evals.improvement(F.col("base"), F.col("adapted")).alias("pct")).select(
        F.round("pct", 1).alias("pct"), evals.verdict(F.col("pct")).alias("v")).collect()
    assert [(r.pct, r.v) for r in rows] == [(44.7, "SUCCESS"), (10.0, "PARTIAL"), (1.0, "MINIMAL")]


def test_training_summary(spark):
    log = spark.createDataFrame([(500, 1.634, 1.712), (900, 1.507, None), (1000, 1.491, 1.538)],
                                "step int, train_loss double, eval_loss double")
    row = evals.training_summary(log).first()
    assert (row.total_steps, row.final_train_loss, row.final_eval_loss) == (1000, 1.491, 1.538)
    assert round(row.eval_perplexity, 2) == 4.66


def test_compare_responses(spark):
    a = spark.createDataFrame([("p", "x"), ("only", "y")], "prompt string, response string")
    b = spark.createDataFrame([("p", "z")], "prompt string, response string")
    assert [tuple(r) for r in evals.compare_responses(a, b).collect()] == [("p", "x", "z")]
