import json

import pytest

from tabulore.sources import files
from tabulore.sources.tables import TableSet, extract_text, find_text_column, load_schema_text


def test_jsonl_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("zwei\nZeilen ü",), ("b",)], "text string")
    files.write_jsonl(df, str(tmp_path / "out"))
    assert sorted(r.text for r in files.read_jsonl(spark, str(tmp_path / "out")).collect()) == ["b", "zwei\nZeilen ü"]
    (tmp_path / "raw.jsonl").write_text('{"text": "x"}\n{"other": 1}\n')
    assert sorted(r.text for r in files.read_jsonl(spark, str(tmp_path / "raw.jsonl")).collect()) == ["", "x"]


def test_write_result(spark, tmp_path):
    files.write_result(spark.sql("select 1 as a, map('r2', 0.5D) as metrics"), str(tmp_path / "r"))
    lines = [line for f in (tmp_path / "r").glob("part-*") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"a": 1, "metrics": {"r2": 0.5}}]


def test_text_column_rules(spark):
    schema = lambda ddl: spark.createDataFrame([], ddl).schema
    assert find_text_column(schema("id int, body string, note string")) == "body"
    assert find_text_column(schema("id int, note string"), "note") == "note"
    assert find_text_column(schema("id int, memo string")) == "memo"
    assert find_text_column(schema("id int")) is None


def test_schema_text(spark):
    tables = TableSet(spark, {
        "a": spark.createDataFrame([("x",), (" \t",), (None,)], "text string"),
        "b": spark.createDataFrame([(1,)], "n int"),
        "c": spark.createDataFrame([(1, "y")], "n int, memo string"),
    })
    assert sorted(tuple(r) for r in load_schema_text(tables).collect()) == [("a", "x"), ("c", "y")]
    with pytest.raises(ValueError):
        load_schema_text(tables.subset(["b"]))


def test_limit_comes_before_the_skip(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "b")], "id int, t string")
    assert [r.text for r in extract_text(df, "t", limit=3, order_by=["id"]).collect()] == ["a"]
    assert extract_text(df, "t").count() == 2


def test_catalog_discovery_excludes_outputs(spark, tmp_path):
    spark.sql("create database if not exists found_db")
    try:
        for name in ("one", "two"):
            spark.range(3).write.mode("overwrite").option("path", str(tmp_path / name)).saveAsTable(f"found_db.{name}")
        tables = TableSet.from_catalog(spark, "found_db", exclude=("two",))
        assert tables.names == ["one"] and tables.row_counts() == {"one": 3}
    finally:
        spark.sql("drop database found_db cascade")


def test_save_table(spark):
    try:
        files.save_table(spark.range(4), "saved_once")
        files.save_table(spark.range(2), "saved_once")
        assert spark.table("saved_once").count() == 2
    finally:
        spark.sql("drop table if exists saved_once")
