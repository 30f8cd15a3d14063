"""Question-answer pairs about tables.

Each function projects one or two small profile frames through the fixed texts.
Row-level pairs are the only ones that read table rows, and they read a bounded
sample per table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulore.functions.text import (
    clean_name, fill, fixed, format_value, g6, joined, optional, ordered, readable_name, ref, sql,
)
from tabulore.operators.groups import compare_groups, subgroups, surprising_groups
from tabulore.operators.profile import Profile
from tabulore.operators.ranking import cap_pairs, sample_rows
from tabulore.operators.relate import column_overlap, join_gain
from tabulore.plans.templates import CLAUSES, METADATA_KINDS, TABLE_QA
from tabulore.plans.verbalize import readable_tables, shared_text
from tabulore.sources.tables import union_all

# Limits of the generated set.
SAMPLED_ROWS = 20
PRIORITY_CATEGORIES = (
    "schema", "reasoning", "correlation", "cross_table", "anomaly", "interpretation", "subgroup",
)
CELL_LIMIT = "5555"  # md5 prefix below which a cell is asked about: about one in three

IN_TABLE = {"readable": "readable", "table": "table"}


def pairs(frame: DataFrame, template: str, texts=TABLE_QA, /, **values: str) -> DataFrame:
    """Render one template over a frame; ``values`` are SQL expressions on its columns."""
    category, instruction, response = texts[template]
    table = "table" if "table" in frame.columns else "''"
    return frame.selectExpr(
        f"{fill(instruction, **values)} as instruction", f"{fill(response, **values)} as response",
        f"{sql(category)} as category", f"{table} as table", f"{sql(template)} as template_id",
    )


def named(profile: Profile, frame: DataFrame) -> DataFrame:
    """Add the display name; one row per table is broadcast."""
    return frame.join(F.broadcast(readable_tables(profile)), "table")


def clause(key: str, /, **values: str) -> str:
    return fill(CLAUSES[key], **values)


# ---- rows ------------------------------------------------------------------------

def _row_pairs(profile: Profile, table: str, key: Sequence[str], n: int) -> DataFrame:
    roles = [r for r in profile.tables.roles[table] if r.role != "nested"]
    # First identifier that is present, else the first present column.
    candidates = [r for r in roles if r.is_id] + [r for r in roles if not r.is_id]
    first = lambda shown: "case " + " ".join(
        f"when {ref(r.name)} is not null then {shown(r)}" for r in candidates
    ) + " end"

    def cell(r) -> str:
        shown = format_value(ref(r.name), r.is_fractional) if r.is_numeric else r.shown_sql
        return (
            f"if({ref(r.name)} is not null, named_struct('position', {r.position}, 'column', {sql(r.name)}, "
            f"'is_numeric', {str(r.is_numeric).lower()}, 'value', {shown}), null)"
        )

    rows = (
        sample_rows(profile.tables.tables[table], n, key)
        .selectExpr(
            f"{sql(table)} as table", f"{sql(readable_name(table))} as readable",
            f"{first(lambda r: r.shown_sql)} as row_id", f"{first(lambda r: sql(r.name))} as id_column",
            f"array({', '.join(cell(r) for r in roles)}) as cells",
        )
        .filter(F.col("row_id").isNotNull())
        .withColumn("cells", F.expr("filter(cells, c -> c is not null and c.column != id_column)"))
    )
    part = lambda test, text: joined(f"filter(cells, c -> {test})", "; ", text)
    described = rows.selectExpr(
        "*",
        part("c.is_numeric", clause("measurement", name=clean_name("i.column"), value="i.value")) + " as measurements",
        part("not c.is_numeric", clause("property", name=clean_name("i.column"), value="i.value")) + " as properties",
    )
    shared = {"id_name": clean_name("id_column"), "row_id": "row_id", **IN_TABLE}

    def pair(template: str, **values: str) -> str:
        _, instruction, response = TABLE_QA[template]
        return (
            f"named_struct('instruction', {fill(instruction, **values)}, 'response', {fill(response, **values)}, "
            f"'template_id', {sql(template)})"
        )

    whole = pair(
        "row_measurements", measurements="measurements",
        properties=optional("properties != ''", clause("row_properties", properties="properties")), **shared,
    )
    asked = f"filter(cells, c -> substring(md5(concat(row_id, c.column)), 1, {len(CELL_LIMIT)}) < '{CELL_LIMIT}')"
    single = pair("row_cell", name=clean_name("c.column"), value="c.value", **shared)
    return described.selectExpr(
        "table", f"inline(concat(if(measurements != '', array({whole}), array()), transform({asked}, c -> {single})))"
    ).selectExpr("instruction", "response", f"{sql(TABLE_QA['row_cell'][0])} as category", "table", "template_id")


def qa_rows(profile: Profile, keys: Mapping[str, Sequence[str]] | None = None, n: int = SAMPLED_ROWS) -> DataFrame:
    """All-measurements and single-cell questions about a sample of rows per table."""
    keys = keys or {}
    frames = []
    for table in profile.tables.names:
        plain = [r.name for r in profile.tables.roles[table] if r.role != "nested"]
        if plain:
            frames.append(_row_pairs(profile, table, keys.get(table) or plain, n))
    return union_all(frames)


# ---- aggregation, comparison, schema -------------------------------------------------

def qa_range(profile: Profile) -> DataFrame:
    return pairs(
        named(profile, profile.numeric.filter(F.col("avg").isNotNull())), "value_range", name=clean_name("column"),
        min="min_text", max="max_text", avg=g6("avg"), n="n",
        stddev=optional("stddev != 0", clause("range_stddev", stddev=g6("stddev"))), **IN_TABLE,
    )


def qa_top_values(profile: Profile, shown: int = 5) -> DataFrame:
    item = clause("value_count", value="value", n="n")
    per_column = profile.values.groupBy("table", "column").agg(
        F.expr(joined(ordered(f"rank, {item} as text", limit=shown), ", ")).alias("values"),
        F.expr("min_by(struct(value, n), rank)").alias("top"),
    ).join(profile.distinct_values, ["table", "column"])
    frame = named(profile, per_column.join(profile.summary.select("table", "n_rows"), "table"))
    shared = {"name": clean_name("column"), **IN_TABLE}
    return pairs(frame, "most_common", values="values", n_rows="n_rows", **shared).unionByName(
        pairs(frame, "distinct_values", n_values="n_values", top_value="top.value", top_n="top.n", **shared)
    )


def qa_comparison(profile: Profile) -> DataFrame:
    average = clause("group_average", value="i.value", num_name=clean_name("num"), avg=g6("i.avg"), n="i.n")
    return pairs(
        named(profile, compare_groups(profile)), "compare_groups", num_name=clean_name("num"),
        cat_name=clean_name("cat"), parts=joined("groups", "; ", average), **IN_TABLE,
    )


def qa_schema(profile: Profile) -> DataFrame:
    tables = profile.tables
    size = clause("table_size", readable="readable", n_rows="n_rows")
    totals = named(profile, profile.table_sizes).agg(
        F.expr("count(1)").alias("n_tables"), F.sum("n_rows").alias("n_rows"), F.sum("n_cols").alias("n_cols"),
        F.expr(joined(ordered(f"table_position, {size} as text"), ", ")).alias("tables"),
    )
    shared = shared_text(profile, CLAUSES["shared_column"], "; ", clean=True).filter(F.col("shared").isNotNull())
    schema = sql(tables.schema_name)
    return union_all([
        pairs(totals, "tables_available", schema=schema, full_schema=sql(tables.full_schema_name),
              n_tables="n_tables", tables="tables"),
        pairs(totals, "data_volume", schema=schema, n_tables="n_tables", n_rows="n_rows", n_cols="n_cols"),
        pairs(shared, "shared_columns", schema=schema, shared="shared"),
        pairs(shared, "table_relations", schema=schema, shared="shared"),
    ])


# ---- reasoning, quality, uncertainty, reproducibility ------------------------------------

def qa_reasoning(profile: Profile) -> DataFrame:
    variable = profile.numeric.filter("cv > 0.3D and stddev != 0").groupBy("table").agg(
        F.expr("min_by(struct(column, cv, min_text, max_text, avg, stddev), position)").alias("top")
    )
    frame = named(profile, profile.table_sizes.join(variable, "table", "left"))
    name, cv = clean_name("top.column"), fixed("top.cv", 2)
    spread = pairs(
        frame.filter("top is not null"), "variability", name=name, cv=cv, min="top.min_text", max="top.max_text",
        avg=g6("top.avg"), stddev=g6("top.stddev"), **IN_TABLE,
    )
    quality = pairs(
        frame, "quality", n_rows="n_rows", n_cols="n_cols", n_numeric="n_numeric", n_categorical="n_categorical",
        most_variable=optional("top is not null", clause("most_variable", name=name, cv=cv)), **IN_TABLE,
    )
    balance = pairs(
        named(profile, profile.class_balance), "class_balance", cat_name=clean_name("column"), top_value="top_value",
        top_n="top_n", bottom_value="bottom_value", bottom_n="bottom_n", **IN_TABLE,
    )
    return union_all([spread, quality, balance])


def qa_nulls(profile: Profile) -> DataFrame:
    item = clause("null_column", name=clean_name("column"), n="n_null", pct=fixed("pct_null", 1))
    gaps = profile.nulls.groupBy("table", "n_rows").agg(
        F.expr("count(1)").alias("n_cols"), F.expr("count_if(n_null > 0)").alias("n_columns"),
        F.expr(joined(ordered(f"-n_null as place, position, {item} as text", "n_null > 0"), "; ")).alias("columns"),
    )
    frame = named(profile, gaps)
    return pairs(
        frame.filter("n_columns > 0"), "missing_values", n_columns="n_columns", columns="columns", n_rows="n_rows", **IN_TABLE
    ).unionByName(
        pairs(frame.filter("n_columns = 0"), "no_missing_values", n_cols="n_cols", n_rows="n_rows", **IN_TABLE)
    )


def qa_outliers(profile: Profile) -> DataFrame:
    frame = named(profile, profile.outliers)
    shared = {"name": clean_name("column"), "n_rows": "n_rows", "lower": g6("lo_fence"), "upper": g6("hi_fence"), **IN_TABLE}
    return pairs(
        frame.filter("n_outlier > 0"), "outliers", n_outlier="n_outlier", q1=g6("q1"), q3=g6("q3"), iqr=g6("iqr"),
        pct=fixed("pct_of_rows", 1), **shared
    ).unionByName(pairs(frame.filter("n_outlier = 0"), "no_outliers", **shared))


def qa_sanity(profile: Profile) -> DataFrame:
    name = clean_name("column")
    text = (
        f"case kind when 'nulls' then {clause('check_nulls', name=name, n='n', pct=fixed('pct', 1))} "
        f"when 'constant' then {clause('check_constant', name=name, value='value')} "
        f"else {clause('check_dominant', name=name, value='value', pct=fixed('pct', 0))} end"
    )
    checks = profile.sanity.groupBy("table").agg(F.expr(joined(ordered(f"check, {text} as text"), "; ")).alias("checks"))
    frame = named(profile, checks.join(profile.summary.select("table", "n_rows"), "table"))
    return pairs(frame, "sanity_checks", n_rows="n_rows", checks="checks", **IN_TABLE)


def qa_uncertainty(profile: Profile) -> DataFrame:
    frame = named(profile, profile.numeric.filter("n >= 2 and stddev is not null and avg is not null"))
    shared = {"name": clean_name("column"), "n": "n", "avg": g6("avg"), **IN_TABLE}
    return pairs(
        frame.filter("avg != 0"), "precision", precision="precision", cv=fixed("cv", 4), cv_pct=fixed("cv * 100", 1),
        stddev=g6("stddev"), **shared
    ).unionByName(pairs(frame, "mean_interval", ci_lo=g6("ci_lo"), ci_hi=g6("ci_hi"), se=g6("se"), **shared))


def qa_reproducibility(profile: Profile) -> DataFrame:
    left = "coalesce(100 * (1 - try_divide(cast(n_null as double), n_rows)), 0D)"
    gap = clause("gap", name=clean_name("column"), pct=fixed(left, 0))
    gaps = profile.nulls.groupBy("table").agg(
        F.expr(f"nullif({joined(ordered(f'position, {gap} as text', 'n_null > 0'), ', ')}, '')").alias("gaps")
    )
    complete = pairs(
        named(profile, profile.completeness.join(gaps, "table")), "completeness", pct=fixed("pct_complete", 0),
        n_complete="n_complete", n_cols="n_cols",
        gaps=optional("gaps is not null", clause("gaps", columns="gaps"), CLAUSES["no_gaps"]), **IN_TABLE,
    )
    present = ", ".join(f"if(has_{kind}, {sql(word)}, null)" for kind, _, _, word in METADATA_KINDS if word)
    missing = ", ".join(f"if(has_{kind}, null, {sql(word)})" for kind, _, word, _ in METADATA_KINDS)
    known = named(profile, profile.metadata_presence).selectExpr(
        "table", "readable", f"concat_ws(', ', {present}) as present", f"concat_ws(', ', {missing}) as missing"
    )
    return complete.unionByName(pairs(
        known, "missing_metadata",
        present=optional("present != ''", clause("metadata_present", present="present")),
        missing=optional("missing != ''", clause("metadata_missing", missing="missing"), CLAUSES["metadata_all"]),
        **IN_TABLE,
    ))


# ---- correlation, cross-table, subgroup, anomaly, interpretation -----------------------------

PAIR = {"a": clean_name("col_a"), "b": clean_name("col_b"), "r": fixed("r", 3)}


def qa_correlation(profile: Profile) -> DataFrame:
    classes = profile.corr_classes
    chosen = lambda test, template, limit, order="rank": ordered(
        f"{order}, {clause(template, **PAIR)} as text", test, limit
    )
    strong = "concat({}, {})".format(*[
        f"transform({chosen(f'class = {sql(name)}', name, 5)}, i -> i.text)" for name in ("strong_positive", "strong_negative")
    ])
    frame = named(profile, classes.groupBy("table").agg(
        F.expr(f"array_join({strong}, '; ')").alias("strong"),
        F.expr(joined(chosen("class = 'weak'", "pair", 5), "; ")).alias("weak"),
        F.expr(joined(chosen("is_redundant", "pair", 3, "pos_a, pos_b"), "; ")).alias("redundant"),
    ))
    meaning = f"if(r > 0, {clause('meaning_up', a=PAIR['a'], b=PAIR['b'])}, {clause('meaning_down', a=PAIR['a'], b=PAIR['b'])})"
    partner = clause("partner", name=clean_name("i.partner"), r=fixed("i.r", 3))
    return union_all([
        pairs(frame.filter("strong != ''"), "correlated", pairs="strong", **IN_TABLE),
        pairs(frame.filter("weak != ''"), "independent", pairs="weak", **IN_TABLE),
        pairs(
            named(profile, classes.filter("rank <= 3 and abs(r) >= 0.3D")), "affects",
            strength="if(abs(r) > 0.7D, 'strong', 'moderate')", direction="if(r > 0, 'positive', 'negative')",
            meaning=meaning, **PAIR, **IN_TABLE,
        ),
        pairs(frame.filter("redundant != ''"), "redundant", pairs="redundant", **IN_TABLE),
        pairs(
            named(profile, profile.most_connected), "most_connected", name=clean_name("column"),
            mean_r=fixed("mean_r", 3), partners=joined("partners", "; ", partner), **IN_TABLE,
        ),
    ])


def qa_cross_table(profile: Profile, overlap: DataFrame | None = None) -> DataFrame:
    overlap = column_overlap(profile.tables) if overlap is None else overlap
    names = readable_tables(profile)
    frame = (
        overlap.join(join_gain(profile.tables.columns_frame(), overlap), ["column", "table_a", "table_b"])
        .join(F.broadcast(names.toDF("table_a", "readable_a")), "table_a")
        .join(F.broadcast(names.toDF("table_b", "readable_b")), "table_b")
        .withColumn("table", F.col("table_a"))
    )
    cleaned = lambda c: joined(c, ", ", clean_name("i"))
    shared = {key: key for key in ("readable_a", "readable_b", "table_a", "table_b")} | {"name": clean_name("column")}
    has_a, has_b = "size(gain_a) > 0", "size(gain_b) > 0"
    return pairs(
        frame, "tables_related", n_a="n_a", n_b="n_b", n_overlap="n_overlap", pct=fixed("pct_of_smaller", 0), **shared
    ).unionByName(pairs(
        frame.filter(f"{has_a} or {has_b}"), "join_gain",
        gain_a=optional(has_a, clause("gain_a", table="table_a", columns=cleaned("gain_a"))),
        joint=optional(f"{has_a} and {has_b}", sql("with ")),
        gain_b=optional(has_b, clause("gain_b", table="table_b", columns=cleaned("gain_b"))), **shared,
    ))


def qa_subgroups(profile: Profile) -> DataFrame:
    frame = named(profile, subgroups(profile))
    detail = clause(
        "group_detail", value="i.value", avg=g6("coalesce(i.avg, 0D)"), stddev=g6("coalesce(i.stddev, 0D)"), n="i.n"
    )
    shared = {"cat_name": clean_name("cat"), "num_name": clean_name("num"), "pct": fixed("pct_diff", 1), **IN_TABLE}
    return pairs(
        frame, "highest_group", high_value="high.value", high_avg=g6("high.avg"), high_n="high.n",
        low_value="low.value", low_avg=g6("low.avg"), low_n="low.n", diff=g6("diff"), **shared
    ).unionByName(pairs(frame.filter("pct_diff > 20"), "groups_differ", groups=joined("groups", "; ", detail), **shared))


def qa_anomaly(profile: Profile, shown: int = 5) -> DataFrame:
    item = clause("multi_outlier", id="id", n="n_outlier")
    worst = F.row_number().over(Window.partitionBy("table").orderBy(F.desc("n_outlier"), "id"))
    several = profile.multi_outliers.withColumn("place", worst).filter(F.col("place") <= shown).drop("place").groupBy("table").agg(
        F.expr(joined(ordered(f"-n_outlier as place, id, {item} as text"), "; ")).alias("samples")
    )
    first = F.row_number().over(Window.partitionBy("table").orderBy("position"))
    bimodal = profile.bimodality.filter("is_bimodal").withColumn("first", first).filter("first = 1")
    return union_all([
        pairs(named(profile, several), "multi_outliers", samples="samples", **IN_TABLE),
        pairs(
            named(profile, bimodal), "bimodal", name=clean_name("column"), pct=fixed("middle_pct", 0),
            n_lower="n_lower_half", n_upper="n_upper_half", **IN_TABLE,
        ),
        pairs(
            named(profile, surprising_groups(profile)), "surprising_group", num_name=clean_name("num"),
            cat_name=clean_name("cat"), value="value", direction="if(is_high, 'unusually high', 'unusually low')",
            group_avg=g6("avg"), avg=g6("overall_avg"), z=fixed("z", 1), **IN_TABLE,
        ),
    ])


def qa_interpretation(profile: Profile) -> DataFrame:
    cleaned = lambda c: joined(c, ", ", clean_name("i"))
    when = lambda test, text: f"case when {test} then {text} end"
    focus = ", ".join([
        clause("focus_cv", name=clean_name("top_cv_column"), cv=fixed("top_cv", 2)),
        clause("focus_pair", **PAIR),
        when("n_rows < 30", clause("focus_few", n_rows="n_rows")),
        when("n_rows > 1000", clause("focus_many", n_rows="n_rows")),
    ])
    findings = ", ".join([
        when("size(stable) > 0", clause("story_stable", columns=cleaned("stable"))),
        when("size(variable) > 0", clause("story_variable", columns=cleaned("variable"))),
        when("n_strong > 0", clause("story_strong", n="n_strong")),
    ])
    told = named(profile, profile.highlights).selectExpr(
        "*", f"concat_ws('. ', {focus}) as focus", f"concat_ws('. ', {findings}) as findings"
    )
    opening = clause("story_size", table="table", n_rows="n_rows", n_numeric="n_numeric")
    related = clause("related_pair", direction="if(r > 0, 'positively', 'negatively')", **PAIR)
    strongest = profile.correlations.filter("rank <= 5").groupBy("table").agg(
        F.expr(joined(ordered(f"rank, {related} as text"), "; ")).alias("pairs")
    )
    note = "case power " + " ".join(
        f"when {sql(power)} then {clause(power, ratio=fixed('ratio', 0))}" for power in ("underpowered", "adequate", "well_powered")
    ) + " end"
    return union_all([
        pairs(told.filter("focus != ''"), "focus", highlights="focus", **IN_TABLE),
        pairs(told.filter("findings != ''"), "story", parts=f"concat_ws('. ', {opening}, findings)", **IN_TABLE),
        pairs(named(profile, strongest), "relationships", pairs="pairs", **IN_TABLE),
        pairs(named(profile, profile.sufficiency), "sufficiency", n_rows="n_rows", n_numeric="n_numeric", note=note, **IN_TABLE),
    ])


def qa_tables(profile: Profile, keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Every question-answer pair of a table set."""
    return union_all([
        qa_rows(profile, keys), qa_range(profile), qa_top_values(profile), qa_comparison(profile), qa_schema(profile),
        qa_reasoning(profile), qa_nulls(profile), qa_outliers(profile), qa_sanity(profile), qa_uncertainty(profile),
        qa_reproducibility(profile), qa_correlation(profile), qa_cross_table(profile), qa_subgroups(profile),
        qa_anomaly(profile), qa_interpretation(profile),
    ])


def capped(qa: DataFrame, max_pairs: int) -> DataFrame:
    return cap_pairs(qa, max_pairs, PRIORITY_CATEGORIES)
