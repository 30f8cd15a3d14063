"""The pipeline stage by stage on the given small tables, and the registered queries."""

import brute
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tabulore.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_names():
    names = queries.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(names) <= set(contract.queries()) and set(queries.oracle_sql()) <= set(names)


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == columns
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = out.cache()
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "lines":
            assert set(after) == set(before)
        else:
            assert all(before[i] == t for i, t in after.items())
        if name == "near_copies":
            assert set(after) == {i for i, (_, c) in brute.jaccard(list(before.items())).items() if i == c}
        sizes.append(len(after))
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    assert docs.join(labels.where("quality = 0"), "doc_id").count() == 0
    packed = corpus_pipeline.packing_stage(spark, docs, SMALL)
    assert packed.count() == sizes[-1] == packed.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, SMALL).count() == sizes[-1]


@pytest.mark.parametrize("name", ["op1_licenses", "op5_line_dedup"])
def test_query_equals_sql(spark, name):
    from checks.compare import connect, difference

    problem, _ = difference(spark, connect(SMALL), SMALL, name, queries.oracle_sql()[name])
    assert not problem


def test_held_out_language_accuracy(spark):
    found = queries.op8_language_id(spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    share = found.join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert share > 0.95
