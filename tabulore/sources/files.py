"""File and table sinks and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, text_column: str = "text") -> None:
    """One ``{"text": ...}`` object per line, in as many files as there are partitions."""
    df.select(F.col(text_column).alias("text")).write.mode("overwrite").json(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Read JSON lines; a missing ``text`` becomes ''."""
    lines = spark.read.schema("text string").json(path)
    return lines.select(F.coalesce("text", F.lit("")).alias("text"))


def save_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def write_result(df: DataFrame, path: str) -> None:
    """Rows as JSON documents, nested fields kept."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
