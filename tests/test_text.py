import random

import pytest
from pyspark.sql import functions as F

from tabulore.functions.keys import in_share, key_position
from tabulore.functions.text import clean_text, fill, fixed, format_value, g6, is_blank, metric_text, sql, yes_no
from tabulore.functions.values import head_map, lenient_json, merge_tags, names_seed, user_tags


def numbers():
    rng = random.Random(3)
    spread = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 14) for _ in range(1500)]
    ties = [i / 8 for i in range(-200, 200)] + [1000005.0, 1234565.0, 999999.5, 999999.4, 123456.5, 2.5, 0.125]
    edges = [0.0, 1e-4, 9.9999996e-5, 0.00001, 1e5, 1e6, 9.999995, 99999.95, 1e22, 1e300, 1e-300]
    return spread + ties + edges


def test_number_formats_equal_c_formats(spark):
    df = spark.createDataFrame([(x,) for x in numbers()], "x double")
    rows = df.selectExpr("x", f"{g6('x')} as g", f"{fixed('x', 2)} as two", f"{fixed('x', 0)} as whole").collect()
    assert [r.g for r in rows] == [f"{r.x:.6g}" for r in rows]
    # Fixed formats are exact as far as a double has digits.
    usual = [r for r in rows if abs(r.x) < 1e15]
    assert [r.two for r in usual] == [f"{r.x:.2f}" for r in usual]
    assert [r.whole for r in usual] == [f"{r.x:.0f}" for r in usual]


def test_special_numbers(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r.g for r in df.selectExpr(f"{g6('x')} as g").collect()] == ["nan", "inf", "-inf", None]


def test_metric_and_value_texts(spark):
    df = spark.createDataFrame([(0.0234,), (0.001,), (12345.6,), (None,)], "x double")
    row = df.selectExpr(f"{metric_text('x')} as m", f"{format_value('x', True)} as v").collect()
    assert [r.m for r in row] == ["0.0234", "0.001", "12345.6", "N/A"]
    assert row[3].v == "not recorded"
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean").selectExpr(f"{yes_no('b')} as t").collect()
    assert [r.t for r in flags] == ["Yes", "No", None]


def test_clean_text_follows_python_whitespace(spark):
    texts = [" a\t b\n\nc ", " x  y　z ", "\x1c\x1da\x1fb", "plain text", "", "a b c", None, "\x85end"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(clean_text(F.col("t")).alias("c"), is_blank(F.col("t")).alias("b")).collect()
    assert [r.c for r in rows] == [" ".join((t or "").split()) for t in texts]
    assert [r.b for r in rows] == [None if t is None else not t.strip() for t in texts]


def test_fill_quotes_and_nulls(spark):
    text = fill("it's {a} \\ \"{b}\"\n", a="x", b=sql("q'uote"))
    rows = spark.createDataFrame([(1,), (None,)], "x int").selectExpr(f"{text} as t").collect()
    assert rows[0].t == "it's 1 \\ \"q'uote\"\n"
    assert rows[1].t is None


def test_hash_share(spark):
    with pytest.raises(ValueError):
        in_share(["id"], 1.5)
    df = spark.range(4000)
    assert df.filter(in_share(["id"], 1.0)).count() == 4000 and df.filter(in_share(["id"], 0.0)).count() == 0
    n = df.filter(in_share(["id"], 0.25)).count()
    assert 850 < n < 1150
    top = df.select(key_position(["id"]).alias("p"), F.md5(F.col("id").cast("string")).alias("m"))
    assert [r.m for r in top.orderBy("p").limit(50).collect()] == [r.m for r in top.orderBy("m").limit(50).collect()]


def test_maps(spark):
    df = spark.sql("select map('b', 2D, 'a', 1D, 'c', null) as m, map('mlflow.user', 'u', 'team', 't') as run, map('team', 'x', 'o', 'y') as own")
    row = df.select(
        head_map(F.col("m"), 2).alias("head"), user_tags(F.col("run")).alias("tags"),
        merge_tags(F.col("own"), F.col("run")).alias("merged"), names_seed(F.col("own")).alias("seed"),
    ).first()
    assert row["head"] == {"a": 1.0, "b": 2.0} and row.tags == {"team": "t"} and row.seed is False
    assert row.merged == {"mlflow.user": "u", "team": "t", "o": "y"}


def test_lenient_json(spark):
    texts = ['{"k": 1}', '"{\\"k\\": 2}"', "{'k': 3}", "no json"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(lenient_json(F.col("t")).alias("v"))
    rows = df.select(F.try_variant_get("v", "$.k", "int").alias("k"), F.try_variant_get("v", "$", "string").alias("s")).collect()
    assert [r.k for r in rows] == [1, 2, 3, None] and rows[3].s == "no json"
