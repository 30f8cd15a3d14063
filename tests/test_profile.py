import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulore import Profile, ProfileOptions, TableSet
from tabulore.operators import groups, relate
from tabulore.plans import qa_tables, verbalize
from tabulore.sources.tables import classify


@pytest.fixture(scope="module")
def tables(spark):
    day = datetime.date(2024, 5, 1)
    types = spark.createDataFrame(
        [("s1", True, day, Decimal("1.50"), "red", [1.0], 2.0), ("s2", False, day, Decimal("2.50"), "blue", None, 4.0),
         ("s3", True, None, None, "red", [2.0], 6.0)],
        "sample_id string, flag boolean, d date, dec decimal(10,2), v string, arr array<double>, x double",
    )
    nulls = spark.createDataFrame(
        [("a", 1.0, 2.0, None, " "), ("b", 2.0, 4.0, None, "z"), ("c", None, 7.0, None, None), ("d", 3.0, 6.0, None, "z")],
        "id string, a double, b double, c double, s string",
    )
    const = spark.createDataFrame([(f"k{i}", 5.0, float(i)) for i in range(6)], "code string, k double, y double")
    single = spark.createDataFrame([("one", 1.0), ("two", 10.0), ("two", 12.0)], "grp string, x double")
    bimodal = spark.createDataFrame([(f"i{i}", float(i % 15) / 10 + (0 if i < 15 else 100)) for i in range(30)], "id string, x double")
    empty = spark.createDataFrame([], "id string, x double")
    wild = spark.createDataFrame(
        [(f"n{i}", float(i % 7), float(i % 5), "hi" if i > 97 else "lo") for i in range(98)]
        + [("odd", 900.0, 800.0, "far"), ("odder", 950.0, 2.0, "far")],
        "name string, p double, q double, part string",
    )
    return TableSet(spark, {"t_types": types, "t_nulls": nulls, "t_const": const, "t_single": single,
                            "t_bimodal": bimodal, "t_empty": empty, "t_wild": wild}, "lab", "cat")


@pytest.fixture(scope="module")
def profile(tables):
    return Profile(tables, keep=True)


def rows(df, **where):
    for key, value in where.items():
        df = df.filter(F.col(key) == value)
    return df.collect()


def test_roles(tables):
    roles = {r.name: r for r in tables.roles["t_types"]}
    assert {n: r.role for n, r in roles.items()} == {
        "sample_id": "identifier", "flag": "categorical", "d": "categorical", "dec": "numeric", "v": "categorical",
        "arr": "nested", "x": "numeric"}
    assert [r.name for r in tables.roles["t_const"] if r.is_id] == ["code"]
    sized = T.StructType([T.StructField("v", T.VarcharType(20)), T.StructField("key_c", T.CharType(3))])
    assert [r.role for r in classify(sized)] == ["categorical", "identifier"]
    humid = tables.spark.createDataFrame([], "humidity string, lot_id string").schema
    assert [r.role for r in classify(humid)] == ["identifier", "identifier"]
    assert [r.role for r in classify(humid, whole_words=True)] == ["categorical", "identifier"]


def test_numeric_statistics(profile):
    dec = rows(profile.numeric, table="t_types", column="dec")[0]
    assert (dec.n, dec.min_text, dec.max_text, dec.avg) == (2, "1.50", "2.50", 2.0)
    lone = rows(profile.numeric, table="t_nulls", column="c")[0]
    assert (lone.n, lone.avg, lone.cv, lone.precision) == (0, None, None, None)
    const = rows(profile.numeric, table="t_const", column="k")[0]
    assert (const.stddev, const.precision) == (0.0, "high")


def test_correlation_is_pairwise_complete(profile):
    pairs = {(r.table, r.col_a, r.col_b): r.r for r in profile.correlations.collect()}
    assert pairs["t_nulls", "a", "b"] == pytest.approx(1.0)
    assert ("t_const", "k", "y") not in pairs and ("t_nulls", "a", "c") not in pairs
    assert all(abs(r) <= 1 + 1e-9 for r in pairs.values())


def test_nulls_and_completeness(profile):
    found = {(r.column): (r.n_null, r.pct_null) for r in rows(profile.nulls, table="t_nulls")}
    assert found == {"id": (0, 0.0), "a": (1, 25.0), "b": (0, 0.0), "c": (4, 100.0), "s": (1, 25.0)}
    assert rows(profile.nulls, table="t_empty")[0].pct_null is None
    text = [r.response for r in rows(qa_tables.qa_nulls(profile), table="t_nulls")]
    assert text == ["Yes, the t_nulls table has missing values in 3 columns: c has 4 nulls (100.0%); a has 1 nulls (25.0%); "
                    "s has 1 nulls (25.0%). The table has 4 total records."]


def test_value_counts_sum_to_non_null_rows(profile, tables):
    for name in ("t_types", "t_single", "t_wild"):
        for column, n in {r.column: r.n for r in profile.values.filter(F.col("table") == name).groupBy("column").agg(
                F.sum("n").alias("n"), F.max("rank").alias("top")).filter("top < 19").collect()}.items():
            assert n == tables.tables[name].filter(F.col(column).isNotNull()).count()
    assert {(r.value, r.n) for r in rows(profile.values, table="t_types", column="flag")} == {("True", 2), ("False", 1)}


def test_constant_column_has_no_fence_and_is_checked(profile):
    assert not rows(profile.fences, table="t_const", column="k")
    answer = rows(qa_tables.qa_sanity(profile), table="t_const")[0].response
    assert answer.startswith("For the t_const table (6 records), key checks include: investigate k — all values are identical (5.0).")


def test_single_row_group_has_text(profile):
    sub = rows(qa_tables.qa_subgroups(profile), table="t_single")
    assert [r.template_id for r in sub] == ["highest_group", "groups_differ"]
    assert "'one': mean 1, std 0, n=1; 'two': mean 11, std 1.41421, n=2" in sub[1].response
    assert "(90.9909%)" not in sub[0].response and "The difference is 10 (90.9%)." in sub[0].response


def test_bimodal_flag(profile):
    row = rows(profile.bimodality, table="t_bimodal")[0]
    assert (row.n_lower_half, row.n_upper_half, row.n_middle, row.is_bimodal) == (15, 15, 0, True)
    assert not rows(profile.bimodality, table="t_wild", column="p")[0].n_middle


def test_multi_outliers_and_surprise(profile):
    found = [(r.id, r.n_outlier) for r in rows(profile.multi_outliers, table="t_wild")]
    assert found == [("odd", 2)]
    answers = {r.template_id: r.response for r in rows(qa_tables.qa_anomaly(profile), table="t_wild")}
    assert answers["multi_outliers"].startswith(
        "The following samples in t_wild are outliers in more than one measurement simultaneously: odd (outlier in 2 measurements).")
    far = rows(groups.surprising_groups(profile), table="t_wild", cat="part")
    assert sorted((r.num, r.value, r.is_high) for r in far) == [("p", "far", True), ("q", "far", True)]


def test_narrowed_fences_equal_direct_fences(tables, profile):
    narrow = Profile(tables, ProfileOptions(direct_limit=3, buckets=4))
    key = lambda p: sorted((r.table, r.column, r.q1, r.q3) for r in p.fences.collect())
    assert key(narrow) == key(profile)


def test_every_column_is_profiled_and_fenced(spark):
    columns = [f"cast(id * {i + 1} % 37 as double) as c{i}" for i in range(15)]
    wide = Profile(TableSet(spark, {"wide": spark.range(200).selectExpr(*columns)}))
    names = {f"c{i}" for i in range(15)}
    assert {r.column for r in wide.numeric.collect()} == names == {r.column for r in wide.fences.collect()}
    assert wide.correlations.count() == 105 and wide.bimodality.count() == 15


def test_nan_is_missing(spark):
    rows = [(float(i), 2.0 * i, "a" if i % 2 else "b") for i in range(40)] + [(float("nan"), 1.0, "a"), (None, 3.0, "b")]
    p = Profile(TableSet(spark, {"t": spark.createDataFrame(rows, "x double, y double, g string")}))
    x = p.numeric.filter("column = 'x'").first()
    assert (x.n, x.max, x.avg) == (40, 39.0, 19.5)
    assert p.correlations.first().r == pytest.approx(1.0)
    assert not p.bimodality.filter("is_bimodal").count() and p.outliers.filter("n_outlier > 0").count() == 0
    assert groups.subgroups(p).filter("num = 'x'").first().high.avg == 20.0
    assert p.nulls.filter("column = 'x'").first().n_null == 1


def test_least_frequent_and_distinct_values(spark):
    rows = [(f"v{i:02d}",) for i in range(30) for _ in range(40 - i)]
    p = Profile(TableSet(spark, {"t": spark.createDataFrame(rows, "kind string")}))
    balance = p.class_balance.first()
    assert (balance.top_value, balance.top_n, balance.bottom_value, balance.bottom_n) == ("v00", 40, "v29", 11)
    assert p.distinct_values.first().n_values == 30 and p.values.count() == 20


def test_empty_table_survives_every_family(profile):
    pairs = qa_tables.qa_tables(profile).collect()
    assert {r.template_id for r in pairs if r.table == "t_empty"} >= {"quality", "no_missing_values", "completeness", "sufficiency"}
    assert all(r.instruction and r.response for r in pairs)


def test_row_text_skips_nulls(tables):
    text = [r.text for r in verbalize.row_to_text(tables.tables["t_types"], "t_types", tables.roles["t_types"]).collect()]
    assert text[0] == ("Record from T Types (t_types): Identification — sample id: s1. Measurements — dec: 1.50; x: 2. "
                       "Properties — flag: Yes; d: 2024-05-01; v: red.")
    assert text[2] == "Record from T Types (t_types): Identification — sample id: s3. Measurements — x: 6. Properties — flag: Yes; v: red."


def test_passages_cover_all_rows(tables):
    built = verbalize.build_passages(tables.tables["t_wild"], "t_wild", tables.roles["t_wild"], 100, ["name"]).collect()
    assert len(built) == 20 and {r.text.count("Record from") for r in built} == {5}
    first = min(built, key=lambda r: r.passage_id).text.split("\n")
    assert first[0] == "Data from T Wild (t_wild):" and first[1] == "" and first[-2] == ""
    assert first[-1] == "The above records are from the t wild dataset containing 100 total records with 4 measured properties."
    three = verbalize.build_passages(tables.tables["t_single"], "t_single", tables.roles["t_single"], 3).collect()
    assert len(three) == 1


def test_overlap_ignores_null_and_type(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (None, None)], "k int, t string")
    b = spark.createDataFrame([(2, None, 1.0), (3, None, 2.0), (None, "x", 3.0)], "k bigint, t string, m double")
    tables = TableSet(spark, {"a": a, "b": b})
    found = {r.column: (r.n_a, r.n_b, r.n_overlap, r.pct_of_smaller) for r in relate.column_overlap(tables).collect()}
    assert found == {"k": (2, 2, 1, 50.0), "t": (1, 1, 1, 100.0)}
    answers = {(r.template_id, r.instruction): r.response for r in qa_tables.qa_cross_table(Profile(tables)).collect()}
    assert answers["tables_related", "How are A and B related?"]
    assert any("measurements from b (m). This would give" in text for text in answers.values())


def test_row_questions(profile):
    asked = [r for r in qa_tables.qa_rows(profile).collect() if r.table == "t_nulls"]
    whole = {r.instruction: r.response for r in asked if r.template_id == "row_measurements"}
    assert whole["What are the measurements for id a in the T Nulls data?"] == (
        "For id a in the t_nulls table: Measurements: a of 1; b of 2. Properties: s is  .")
    assert all("id" not in r.instruction.split("for")[0] for r in asked if r.template_id == "row_cell")


def test_stored_profiles_are_planned_in_blocks_of_tables(spark):
    """Seven tables in blocks of three give what one plan over all gives, in one stored frame."""
    frames = {
        f"t{n}": spark.range(30 + n).selectExpr("id", "cast(id % 7 as double) as x", f"id * {n + 1}.5D as y", "cast(id % 3 as string) as kind")
        for n in range(7)
    }
    frames["t3"] = frames["t3"].drop("kind")
    tables = TableSet(spark, frames)
    stored, planned = Profile(tables, ProfileOptions(tables_per_plan=3), keep=True), Profile(tables)
    for name in ("summary", "spread", "values", "groups"):
        rows = [sorted(map(str, getattr(p, name).collect())) for p in (stored, planned)]
        assert rows[0] == rows[1] and rows[0], name
    assert len({f.rsplit("/", 1)[0] for f in stored.summary.inputFiles()}) == 1
