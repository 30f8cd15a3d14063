"""What keeps passes over large tables few: seen in plans, with results against plain versions."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabulore.functions.text import g6
from tabulore.operators import ranking
from tabulore.operators.profile import Profile, ProfileOptions
from tabulore.plans import verbalize
from tabulore.sources.tables import TableSet, classify


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_rows_are_gathered_once_and_written_after_they_moved(spark):
    """Both kinds of passages come from one stored pass, and the rows that are sorted hold cells instead of sentences."""
    lines = spark.range(1, 24, numPartitions=3).select(F.col("id").alias("row"), F.col("id").cast("string").alias("text"))
    for frame in verbalize.closed_groups(lines, 5, 23):
        assert "MapInArrow" not in plan_of(frame)

    moved = []

    def number_rows(df, order_by, name):
        moved.append(df)
        return ranking.number_rows(df, order_by, name)

    rows = [(None if i % 5 == 0 else 7 - i % 7, i / 8, f"{i}", i % 3 == 0 if i % 4 else None, [i], datetime.timedelta(seconds=i)) for i in range(43)]
    df = spark.createDataFrame(rows, "`_place` int, x double, `a.name` string, flag boolean, bag array<int>, took interval day to second")
    roles = classify(df.schema)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(verbalize, "number_rows", number_rows)
        built = verbalize.build_passages(df, "t", roles, 43, ["_place", "x"]).orderBy("passage_id").collect()
    assert "Record from" not in plan_of(moved[0]) and "bag" not in moved[0].columns
    told = [r.text for r in verbalize.row_to_text(df.orderBy("_place", "x"), "t", roles).collect()]
    assert [r.text.split("\n")[2:-2] for r in built] == [told[i:i + 5] for i in range(0, 43, 5)]


def test_short_numbers_need_no_format(spark):
    values = [sign * k / 10000 for k in range(0, 1000000, 37) for sign in (1, -1)] + [999999.0, 999999.5, 1000000.0, 99.9999, 100.0001, 99.99995]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    assert [r.g for r in df.selectExpr(f"{g6('x')} as g").collect()] == [f"{x:.6g}" for x in values]


LONG = "a value of more than thirty-two bytes "


@pytest.mark.parametrize("keep", [True, False])
def test_values_are_counted_once_and_without_statistics(spark, keep):
    texts = ["b"] * 4 + ["a"] * 4 + [LONG + "1"] * 3 + [LONG + "2"] * 2 + [None] * 5 + ["", "x" * 31, "x" * 32, "d41d8cd98f00b204e9800998ecf8427e"]
    rows = [(t, i % 2 == 0, float(i), None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "t string, flag boolean, x double, nothing string")
    tables = TableSet(spark, {"t_long": df, "t_number": df.select("x")})
    found = Profile(tables, ProfileOptions(top_values=6), keep=keep)
    values = found.values
    got = {(r.column, r.value): r.n for r in values.collect()}
    assert got.items() >= {("t", "a"): 4, ("t", "b"): 4, ("t", LONG + "1"): 3, ("t", LONG + "2"): 2, ("flag", "True"): 11, ("flag", "False"): 11}.items()
    assert [r.value for r in values.filter("column = 't'").orderBy("rank").collect()][:4] == ["a", "b", LONG + "1", LONG + "2"]
    assert {r.column: r.n_values for r in found.distinct_values.collect()} == {"t": 8, "flag": 2}
    assert "_group_frame" not in found.__dict__ and "stddev" not in plan_of(values)
    grouped = {(r.cat, r.value): (r.n, r.max) for r in found.groups.filter("num = 'x'").collect()}
    assert grouped[("t", LONG + "2")] == (2, 12.0) and grouped[("flag", "True")] == (11, 20.0)
    assert {k: n for k, (n, _) in grouped.items()} == got
