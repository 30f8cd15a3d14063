"""Reference SQL for table profiles and the questions built on them.

Written independently of the Spark plans: plain SQL over the same tables, with
C-style number formats. Only the fixed texts are shared.
"""

from __future__ import annotations

from itertools import combinations
from string import Formatter

from tabulore.plans.templates import CLAUSES, METADATA_KINDS, PASSAGES, TABLE_QA

# The given tables as read by Spark, in the order the queries use.
SCHEMAS = {
    "region": "r_regionkey i, r_name s",
    "nation": "n_nationkey i, n_name s, n_regionkey i",
    "customer": "c_custkey l, c_name s, c_nationkey i, c_acctbal d, c_mktsegment s",
    "supplier": "s_suppkey l, s_name s, s_nationkey i, s_acctbal d",
    "part": "p_partkey l, p_name s, p_brand s, p_type s, p_size i, p_retailprice d",
    "orders": "o_orderkey l, o_custkey l, o_orderstatus s, o_totalprice d, o_orderdate t, o_orderpriority s",
    "lineitem": "l_orderkey l, l_partkey l, l_suppkey l, l_linenumber i, l_quantity d, l_extendedprice d, "
                "l_discount d, l_tax d, l_returnflag s, l_linestatus s, l_shipdate t",
    "events": "event_id l, ts t, user_id l, event_type s, value d, props s",
    "documents": "doc_id l, text s, lang s, source s, n_chars l",
    "embeddings": "vec_id l, embedding a, label i",
    "pages": "page_id l, url s, html s",
    "benchmark": "item_id l, text s",
    "labels": "doc_id l, quality i, toxic i",
    "conversations": "conv_id l, turn l, role s, text s",
}
SPARK_TYPES = {
    "i": "IntegerType()", "l": "LongType()", "d": "DoubleType()", "s": "StringType()",
    "t": "TimestampNTZType()", "a": "ArrayType(FloatType(), True)",
}
TABLES = {t: [tuple(c.split()) for c in cols.split(", ")] for t, cols in SCHEMAS.items()}
# documents with the labels that exist: the one table with NULLs.
TABLES["labelled"] = [("doc_id", "l"), ("lang", "s"), ("n_chars", "l"), ("quality", "i"), ("toxic", "i")]
# events with skewed, constant and related columns, NULL and NaN; not one of the shop's tables.
GAPS = {"gaps": [tuple(c.split()) for c in
                 "event_id l, kind s, value d, twice d, minus d, flat i, heavy d, halves d, shift d".split(", ")]}
GAPS_KIND = "CASE WHEN event_id % 40 = 0 THEN 'rare' WHEN event_id % 10 = 3 THEN event_type ELSE 'usual' END"


def gaps_sql(nan: str) -> str:
    """``nan``: what stands for NaN. Statistics are to treat it as missing, which the SQL has as NULL."""
    return f"""SELECT event_id, {GAPS_KIND} AS kind,
  CASE WHEN event_id % 97 = 0 THEN {nan} WHEN event_id % 89 = 0 THEN NULL ELSE value END AS value, value * 2 + event_id % 7 AS twice,
  event_id % 13 * 5 - value AS minus, 7 AS flat, CASE WHEN event_id % 50 = 0 THEN value * 1000 ELSE value + event_id % 3 END AS heavy,
  value / 1000000 + event_id % 2 * 1000 AS halves, CASE WHEN event_id % 40 = 0 THEN 9000 ELSE 0 END + value AS shift FROM events"""


LABELLED = "SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
SCHEMA_NAME, FULL_NAME = "shop", "lake.shop"
KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"], "labelled": ["doc_id"],
}


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def say(template: str, /, **values: str) -> str:
    parts = []
    for literal, place, _, _ in Formatter().parse(template):
        if literal:
            parts.append(lit(literal))
        if place is not None:
            parts.append(f"({values[place]})::VARCHAR")
    return "(" + " || ".join(parts) + ")"


def clause(key: str, /, **values: str) -> str:
    return say(CLAUSES[key], **values)


def g6(x: str) -> str:
    return f"format('{{:.6g}}', ({x})::DOUBLE)"


def fixed(x: str, digits: int) -> str:
    return f"format('{{:.{digits}f}}', ({x})::DOUBLE)"


def clean(x: str) -> str:
    return f"replace({x}, '_', ' ')"


def title(name: str) -> str:
    return name.replace("_", " ").title()


def numeric(table: str):
    return [(c, p, k) for p, (c, k) in enumerate((TABLES | GAPS)[table]) if k in "ild"]


def categorical(table: str):
    """Columns used as categories: everything but numbers, arrays and id/key strings."""
    return [
        (c, p, k) for p, (c, k) in enumerate((TABLES | GAPS)[table])
        if k == "t" or (k == "s" and not ("id" in c or "key" in c))
    ]


def id_columns(table: str):
    return [c for c, k in (TABLES | GAPS)[table] if k == "s" and any(h in c for h in ("id", "key", "name", "code", "sample"))]


def source(table: str, nan: str = "NULL") -> str:
    return f"({gaps_sql(nan)})" if table == "gaps" else f"({LABELLED})" if table == "labelled" else table


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def prelude(tables: dict = TABLES) -> str:
    """Common table expressions shared by the profile queries."""
    order = {t: i for i, t in enumerate(tables)}
    ids = {t: id_columns(t) for t in tables}
    cats = {t: [c for c, _, _ in categorical(t)] for t in tables}
    cols = ", ".join(
        f"({lit(t)}, {order[t]}, {lit(title(t))}, {p}, {lit(c)}, {lit(SPARK_TYPES[k])}, {str(k in 'ild').lower()}, "
        f"{str(c in cats[t]).lower()}, {str(c in ids[t]).lower()}, {str(k == 's').lower()})"
        for t, columns in tables.items() for p, (c, k) in enumerate(columns)
    )
    rows = union(f"SELECT {lit(t)} AS tbl, count(*) AS n_rows FROM {source(t)} x" for t in tables)
    nulls = union(
        f"SELECT {lit(t)} AS tbl, {lit(c)} AS col, {p} AS pos, count(*) AS n_rows, count(*) - count({c}) AS n_null "
        f"FROM {source(t, chr(39) + 'nan' + chr(39) + '::DOUBLE')} x" for t, columns in tables.items() for p, (c, _) in enumerate(columns)
    )
    num = union(
        f"SELECT {lit(t)} AS tbl, {lit(c)} AS col, {p} AS pos, count({c}) AS n, min({c})::DOUBLE AS mn, max({c})::DOUBLE AS mx, "
        f"avg({c}::DOUBLE) AS av, stddev_samp({c}::DOUBLE) AS sd, "
        f"{g6(f'min({c})') if k == 'd' else f'min({c})::VARCHAR'} AS mn_text, "
        f"{g6(f'max({c})') if k == 'd' else f'max({c})::VARCHAR'} AS mx_text, min({c})::VARCHAR AS mn_raw FROM {source(t)} x"
        for t in tables for c, p, k in numeric(t)
    )
    corr = union(
        f"SELECT {lit(t)} AS tbl, {lit(a)} AS col_a, {pa} AS pos_a, {lit(b)} AS col_b, {pb} AS pos_b, "
        f"corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM {source(t)} x"
        for t in tables for (a, pa, _), (b, pb, _) in combinations(numeric(t), 2)
    )
    vals = union(
        f"SELECT {lit(t)} AS tbl, {lit(c)} AS col, {p} AS pos, {c}::VARCHAR AS val, count(*) AS n FROM {source(t)} x GROUP BY {c}"
        for t in tables for c, p, _ in categorical(t)
    )
    grp = union(
        f"SELECT v.tbl, v.col AS cat, v.pos AS cat_pos, v.rnk, v.val, {lit(c)} AS num, {p} AS num_pos, count(x.{c}) AS n, "
        f"avg(x.{c}::DOUBLE) AS av, stddev_samp(x.{c}::DOUBLE) AS sd, min(x.{c})::DOUBLE AS mn, max(x.{c})::DOUBLE AS mx "
        f"FROM vals v JOIN {source(t)} x ON v.val = x.{cat}::VARCHAR WHERE v.tbl = {lit(t)} AND v.col = {lit(cat)} "
        "GROUP BY ALL"
        for t in tables for cat, _, _ in categorical(t) for c, p, _ in numeric(t)
    )
    quart = union(
        f"SELECT {lit(t)} AS tbl, {lit(c)} AS col, {p} AS pos, quantile_disc({c}::DOUBLE, 0.25) AS q1, "
        f"quantile_disc({c}::DOUBLE, 0.75) AS q3 FROM {source(t)} x"
        for t in tables for c, p, _ in numeric(t)
    )
    spread = union(
        f"SELECT {lit(t)} AS tbl, {lit(c)} AS col, {p} AS pos, "
        f"count(*) FILTER (WHERE {c} < f.lo OR {c} > f.hi) AS n_outlier, "
        f"count(*) FILTER (WHERE {c} < (m.mn + m.mx) / 2) AS n_lower, count(*) FILTER (WHERE {c} >= (m.mn + m.mx) / 2) AS n_upper, "
        f"count(*) FILTER (WHERE {c} >= m.mn + (m.mx - m.mn) * 0.33::DOUBLE AND {c} <= m.mn + (m.mx - m.mn) * 0.66::DOUBLE) AS n_middle "
        f"FROM {source(t)} x, (SELECT max(lo) AS lo, max(hi) AS hi FROM fences WHERE tbl = {lit(t)} AND col = {lit(c)}) f, "
        f"(SELECT max(mn) AS mn, max(mx) AS mx FROM num WHERE tbl = {lit(t)} AND col = {lit(c)}) m"
        for t in tables for c, p, _ in numeric(t)
    )
    return f"""WITH cols(tbl, tpos, readable, pos, col, dtype, is_num, is_cat, is_id, is_str) AS (VALUES {cols}),
nrows AS ({rows}),
sizes AS (SELECT c.tbl, c.tpos, c.readable, max(r.n_rows) AS n_rows, count(*) AS n_cols, count(*) FILTER (WHERE is_num) AS n_num,
  count(*) FILTER (WHERE is_cat) AS n_cat, count(*) FILTER (WHERE is_id) AS n_id FROM cols c JOIN nrows r ON c.tbl = r.tbl GROUP BY ALL),
nulls AS ({nulls}),
num0 AS ({num}),
num AS (SELECT *, abs(sd / nullif(av, 0)) AS cv, CASE WHEN n >= 2 THEN sd / sqrt(n) END AS se FROM num0),
corr0 AS ({corr}),
corr AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY round(abs(r), 12) DESC, pos_a, pos_b) AS rnk FROM corr0
  WHERE r IS NOT NULL AND NOT isnan(r)),
vals0 AS ({vals}),
vals1 AS (SELECT *, row_number() OVER (PARTITION BY tbl, col ORDER BY n DESC, md5(val) NULLS LAST) AS r0 FROM vals0),
vals AS (SELECT tbl, col, pos, val, n, row_number() OVER (PARTITION BY tbl, col ORDER BY r0) AS rnk FROM vals1
  WHERE r0 <= 20 AND val IS NOT NULL),
tail AS (SELECT tbl, col, pos, count(*) AS k, arg_max(val, (-n, md5(val))) AS low_val, min(n) AS low_n FROM vals0 WHERE val IS NOT NULL GROUP BY ALL),
grp AS ({grp}),
quart AS ({quart}),
fences AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM quart WHERE q3 - q1 <> 0),
spread AS ({spread}),
connected0 AS (SELECT tbl, col, pos, avg(abs(r)) AS mean_r FROM (SELECT tbl, col_a AS col, pos_a AS pos, r FROM corr
  UNION ALL SELECT tbl, col_b, pos_b, r FROM corr) GROUP BY ALL),
connected AS (SELECT tbl, col, mean_r FROM connected0 QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY round(mean_r, 12) DESC, pos) = 1),
balance0 AS (SELECT t.tbl, t.col, t.pos, v.val AS top_val, v.n AS top_n, low_val, low_n
  FROM tail t JOIN vals v ON t.tbl = v.tbl AND t.col = v.col AND v.rnk = 1 WHERE k >= 2),
balance AS (SELECT * FROM balance0 QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY pos) = 1),
cmp0 AS (SELECT tbl, cat, cat_pos, num, num_pos, count(*) AS k FROM grp WHERE rnk <= 3 AND av IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
cmp AS (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY cat_pos, num_pos) AS place FROM cmp0),
sub0 AS (SELECT *, row_number() OVER w AS lo_place, row_number() OVER (PARTITION BY tbl, cat, num ORDER BY round(coalesce(av, 0), 9) DESC, rnk DESC) AS hi_place,
  count(*) OVER (PARTITION BY tbl, cat, num) AS k FROM grp WHERE rnk <= 5
  WINDOW w AS (PARTITION BY tbl, cat, num ORDER BY round(coalesce(av, 0), 9), rnk)),
sub1 AS (SELECT lo.tbl, lo.cat, lo.num, lo.num_pos, lo.val AS low_val, lo.av AS low_avg, lo.n AS low_n, hi.val AS high_val, hi.av AS high_avg,
  hi.n AS high_n, hi.av - lo.av AS diff, CASE WHEN hi.av <> 0 THEN 100.0::DOUBLE * abs(hi.av - lo.av) / abs(hi.av) ELSE 0 END AS pct
  FROM sub0 lo JOIN sub0 hi ON lo.tbl = hi.tbl AND lo.cat = hi.cat AND lo.num = hi.num AND lo.lo_place = 1 AND hi.hi_place = 1
  WHERE lo.k >= 2 AND lo.av IS NOT NULL AND hi.av IS NOT NULL),
sub AS (SELECT * FROM sub1),
surprise0 AS (SELECT g.*, l.av AS all_avg, abs(g.av - l.av) / l.sd AS z, count(*) OVER (PARTITION BY g.tbl, g.cat, g.num) AS k
  FROM grp g JOIN num l ON g.tbl = l.tbl AND g.num = l.col WHERE g.rnk <= 3 AND l.sd <> 0),
surprise AS (SELECT * FROM surprise0 WHERE k >= 2 AND z > 2),
bimodal AS (SELECT s.*, n.sd, s.n_lower + s.n_upper AS n_valid, 100.0::DOUBLE * s.n_middle / nullif(s.n_lower + s.n_upper, 0) AS middle_pct
  FROM spread s JOIN num n ON s.tbl = n.tbl AND s.col = n.col),
sanity AS (
  SELECT tbl, 1 AS chk, 'nulls' AS kind, col, NULL::VARCHAR AS val, n_null AS n, 100.0::DOUBLE * n_null / n_rows AS pct FROM nulls WHERE n_null > 0
    QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY n_null DESC, pos) = 1
  UNION ALL SELECT tbl, 2, 'constant', col, mn_raw, n, NULL FROM num WHERE mn = mx QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY pos) = 1
  UNION ALL SELECT v.tbl, 3, 'dominant', v.col, v.val, v.n, 100.0::DOUBLE * v.n / s.n_rows FROM vals v JOIN sizes s ON v.tbl = s.tbl
    JOIN (SELECT tbl, min_by(col, pos) AS col FROM cols WHERE is_cat GROUP BY tbl) f ON v.tbl = f.tbl AND v.col = f.col
    WHERE v.rnk = 1 AND v.n > 0.8 * s.n_rows),
shared AS (SELECT col, min(tpos * 1000 + pos) AS first_seen, string_agg(tbl, ', ' ORDER BY tpos) AS tables, count(*) AS k FROM cols GROUP BY col HAVING count(*) > 1)
"""


PRELUDE = prelude()
T, C = 'tbl AS "table"', 'col AS "column"'


def multi_sql(ids: dict[str, str]) -> str:
    parts = []
    for t, id_column in ids.items():
        score = " + ".join(
            f"CASE WHEN {c} < (SELECT lo FROM fences WHERE tbl = {lit(t)} AND col = {lit(c)}) OR "
            f"{c} > (SELECT hi FROM fences WHERE tbl = {lit(t)} AND col = {lit(c)}) THEN 1 ELSE 0 END" for c, _, _ in numeric(t)
        )
        parts.append(f"(SELECT {lit(t)} AS \"table\", {id_column}::VARCHAR AS id, {score} AS n_outlier FROM {source(t)} x WHERE {score} >= 2)")
    return union(parts)


IDS = {"customer": "c_name", "supplier": "s_name", "part": "p_name", "events": "event_id", "documents": "doc_id", "lineitem": "l_orderkey"}


def gaps_queries() -> dict[str, str]:
    """Some of the profile frames and questions over the table with gaps."""
    names = {
        "gaps_numeric": "numeric_profile", "gaps_nulls": "null_profile", "gaps_corr_classes": "corr_classes", "gaps_outliers": "iqr_outliers",
        "gaps_bimodality": "bimodality", "gaps_subgroups": "subgroups", "gaps_surprising": "surprising_groups", "gaps_sanity": "sanity_checks",
    }
    own, frames, asked = prelude(GAPS), profile_sql(), qa_sql()
    out = {key: own + frames[name][len(PRELUDE):] for key, name in names.items()}
    out["gaps_multi_outliers"] = own + multi_sql({"gaps": "event_id"})
    for key, name in (("gaps_qa_correlation", "qa_correlation"), ("gaps_qa_anomaly", "qa_anomaly"), ("gaps_qa_sanity", "qa_sanity")):
        out[key] = own + asked[name][len(PRELUDE):].replace(multi_sql(IDS), multi_sql({"gaps": "event_id"}))
    return out


def profile_sql() -> dict[str, str]:
    """Profile frames."""
    kinds = ", ".join(
        f"bool_or({' OR '.join(f'lower(c.col) LIKE {lit(chr(37) + h + chr(37))}' for h in hints)}) AS has_{k}"
        for k, hints, _, _ in METADATA_KINDS
    )
    P = PRELUDE
    return {
        "table_profile": P + f"SELECT {T}, n_rows, n_cols, n_num AS n_numeric, n_cat AS n_categorical, n_id FROM sizes",
        "numeric_profile": P + f"""SELECT {T}, {C}, n, round(mn, 4) AS min, round(mx, 4) AS max, round(av, 4) AS avg, round(sd, 4) AS stddev,
            round(cv, 6) AS cv, CASE WHEN n >= 2 THEN CASE WHEN cv < 0.1 THEN 'high' WHEN cv < 0.3 THEN 'moderate' WHEN cv >= 0.3 THEN 'low' END END AS precision,
            round(se, 4) AS se, round(av - 1.96 * se, 4) AS ci_lo, round(av + 1.96 * se, 4) AS ci_hi FROM num""",
        "null_profile": P + f"SELECT {T}, {C}, n_rows, n_null, round(100.0::DOUBLE * n_null / n_rows, 6) AS pct_null FROM nulls",
        "completeness": P + f"""SELECT {T}, count(*) AS n_cols, count(*) FILTER (WHERE n_null = 0) AS n_complete,
            round(100.0::DOUBLE * count(*) FILTER (WHERE n_null = 0) / count(*), 6) AS pct_complete FROM nulls GROUP BY tbl""",
        "value_counts": P + f"SELECT {T}, {C}, rnk AS rank, val AS value, n FROM vals",
        "correlations": P + f"SELECT {T}, col_a, col_b, round(r, 6) AS r FROM corr",
        "corr_classes": P + f"""SELECT {T}, col_a, col_b, rnk AS rank, CASE WHEN abs(r) > 0.7 THEN CASE WHEN r > 0 THEN 'strong_positive' ELSE 'strong_negative' END
            WHEN abs(r) < 0.2 THEN 'weak' WHEN abs(r) >= 0.3 THEN 'moderate' ELSE 'slight' END AS class, abs(r) > 0.95 AS is_redundant FROM corr""",
        "most_connected": P + f"SELECT {T}, {C}, round(mean_r, 6) AS mean_r FROM connected",
        "iqr_outliers": P + f"""SELECT f.tbl AS "table", f.col AS "column", round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(lo, 4) AS lo_fence,
            round(hi, 4) AS hi_fence, n_outlier, round(100.0::DOUBLE * n_outlier / n_rows, 6) AS pct_of_rows
            FROM fences f JOIN spread s ON f.tbl = s.tbl AND f.col = s.col JOIN nrows r ON f.tbl = r.tbl""",
        "multi_outliers": P + multi_sql(IDS),
        "bimodality": P + f"""SELECT {T}, {C}, n_lower AS n_lower_half, n_upper AS n_upper_half, n_middle, round(middle_pct, 6) AS middle_pct,
            coalesce(sd <> 0 AND middle_pct < 15 AND n_valid > 20, false) AS is_bimodal FROM bimodal""",
        "class_balance": P + f"SELECT {T}, {C}, top_val AS top_value, top_n, low_val AS bottom_value, low_n AS bottom_n FROM balance",
        "compare_groups": P + """SELECT g.tbl AS "table", g.cat, g.num, g.val AS value, round(g.av, 4) AS avg, g.n FROM grp g JOIN cmp c
            ON g.tbl = c.tbl AND g.cat = c.cat AND g.num = c.num WHERE g.rnk <= 3 AND g.av IS NOT NULL""",
        "subgroups": P + f"""SELECT {T}, cat, num, high_val AS high_value, round(high_avg, 4) AS high_avg, low_val AS low_value,
            round(low_avg, 4) AS low_avg, round(diff, 4) AS diff, round(pct, 4) AS pct_diff FROM sub""",
        "surprising_groups": P + f"SELECT {T}, cat, num, val AS value, round(z, 4) AS z, av > all_avg AS is_high FROM surprise",
        "sanity_checks": P + f"SELECT {T}, kind, {C}, val AS value, n, round(pct, 4) AS pct FROM sanity",
        "metadata_presence": P + f"SELECT c.tbl AS \"table\", max(r.n_rows) AS n_rows, {kinds} FROM cols c JOIN nrows r ON c.tbl = r.tbl GROUP BY c.tbl",
        "sufficiency": P + f"""SELECT {T}, n_rows, n_num AS n_numeric, round(n_rows::DOUBLE / greatest(n_num, 1), 6) AS ratio,
            CASE WHEN n_rows::DOUBLE / greatest(n_num, 1) < 5 THEN 'underpowered' WHEN n_rows::DOUBLE / greatest(n_num, 1) < 20 THEN 'adequate' ELSE 'well_powered' END AS power,
            CASE WHEN n_rows < 30 THEN 'caution' WHEN n_rows > 1000 THEN 'robust' END AS size_note FROM sizes""",
        "highlights": P + """, top AS (SELECT tbl, min_by(col, struct_pack(a := -cv, b := pos)) AS col, max(cv) AS cv FROM num WHERE sd <> 0 AND cv IS NOT NULL GROUP BY tbl),
            best AS (SELECT * FROM corr WHERE rnk = 1), strong AS (SELECT tbl, count(*) FILTER (WHERE abs(r) > 0.7) AS k FROM corr GROUP BY tbl)
            SELECT s.tbl AS "table", t.col AS top_cv_column, round(t.cv, 6) AS top_cv, b.col_a, b.col_b, round(b.r, 6) AS r, coalesce(g.k, 0) AS n_strong
            FROM sizes s LEFT JOIN top t ON s.tbl = t.tbl LEFT JOIN best b ON s.tbl = b.tbl LEFT JOIN strong g ON s.tbl = g.tbl""",
        "shared_columns": P + """SELECT c.col AS "column", string_agg(c.tbl, ', ' ORDER BY c.tpos) AS tables, sum(r.n_rows)::BIGINT AS n_rows
            FROM cols c JOIN nrows r ON c.tbl = r.tbl GROUP BY c.col HAVING count(*) > 1""",
    }


RELATED = {
    "customer": {"c_custkey": "custkey", "c_nationkey": "nationkey"},
    "supplier": {"s_suppkey": "suppkey", "s_nationkey": "nationkey"},
    "nation": {"n_nationkey": "nationkey", "n_regionkey": "regionkey"},
    "region": {"r_regionkey": "regionkey"},
    "orders": {"o_orderkey": "orderkey", "o_custkey": "custkey"},
    "lineitem": {"l_orderkey": "orderkey", "l_partkey": "partkey", "l_suppkey": "suppkey"},
    "part": {"p_partkey": "partkey"},
    "documents": {}, "labels": {}, "benchmark": {}, "conversations": {},
}


def related_ctes(tables: dict[str, dict[str, str]] = RELATED) -> str:
    holders: dict[str, list[tuple[str, str]]] = {}
    for t, renames in tables.items():
        for c, k in TABLES[t]:
            if k != "a":
                holders.setdefault(renames.get(c, c), []).append((t, c))
    position = {t: i for i, t in enumerate(tables)}
    rows, order = [], 0
    for column, holding in holders.items():
        if len(holding) > 1:
            for (a, ca), (b, cb) in combinations(holding, 2):
                rows.append(
                    f"SELECT {lit(column)} AS col, {order} AS col_order, {lit(a)} AS a, {lit(b)} AS b, {position[a]} AS pa, {position[b]} AS pb, "
                    f"(SELECT count(DISTINCT {ca}) FROM {source(a)} x) AS n_a, (SELECT count(DISTINCT {cb}) FROM {source(b)} x) AS n_b, "
                    f"(SELECT count(*) FROM (SELECT DISTINCT {ca} AS v FROM {source(a)} x WHERE {ca} IS NOT NULL) p JOIN "
                    f"(SELECT DISTINCT {cb} AS v FROM {source(b)} x WHERE {cb} IS NOT NULL) q ON p.v = q.v) AS n_overlap"
                )
            order += 1
    names = ", ".join(
        f"({lit(t)}, {lit(renames.get(c, c))}, {p}, {str(k in 'ild').lower()})"
        for t, renames in tables.items() for p, (c, k) in enumerate(TABLES[t])
    )
    gain = lambda this, other: (
        f"(SELECT list(n.col ORDER BY n.pos) FROM rcols n WHERE n.tbl = o.{this} AND n.is_num "
        f"AND n.col NOT IN (SELECT m.col FROM rcols m WHERE m.tbl = o.{other}))"
    )
    return f"""overlap0 AS ({union(rows)}),
overlap AS (SELECT *, 100.0::DOUBLE * n_overlap / least(n_a, n_b) AS pct FROM overlap0 WHERE n_overlap > 0),
rcols(tbl, col, pos, is_num) AS (VALUES {names}),
gains AS (SELECT o.*, coalesce({gain('a', 'b')}, []) AS gain_a, coalesce({gain('b', 'a')}, []) AS gain_b FROM overlap o)
"""


def related_sql() -> dict[str, str]:
    R = "WITH " + related_ctes()
    return {
        "column_overlap": R + 'SELECT col AS "column", a AS table_a, b AS table_b, n_a, n_b, n_overlap, round(pct, 6) AS pct_of_smaller FROM overlap',
        "join_gain": R + """SELECT col AS "column", a AS table_a, b AS table_b, array_to_string(gain_a, ', ') AS gain_a,
            array_to_string(gain_b, ', ') AS gain_b FROM gains""",
        "qa_cross_table": R + cross_table_pairs(RELATED),
    }


def cross_table_pairs(tables) -> str:
    shared = {"readable_a": "ra", "readable_b": "rb", "table_a": "a", "table_b": "b", "name": clean("col")}
    names = lambda c: f"(SELECT string_agg({clean('u.x')}, ', ' ORDER BY u.k) FROM (SELECT unnest({c}) AS x, generate_subscripts({c}, 1) AS k) u)"
    readable = ", ".join(f"({lit(t)}, {lit(title(t))})" for t in tables)
    frame = f"(SELECT g.*, x.r AS ra, y.r AS rb FROM gains g JOIN (VALUES {readable}) x(t, r) ON x.t = g.a JOIN (VALUES {readable}) y(t, r) ON y.t = g.b) f"

    def qa(key: str, where: str = "true", /, **values: str) -> str:
        category, question, answer = TABLE_QA[key]
        return (f"SELECT {say(question, **values)} AS instruction, {say(answer, **values)} AS response, {lit(category)} AS category, "
                f"a AS \"table\", {lit(key)} AS template_id FROM {frame} WHERE {where}")

    has_a, has_b = "len(gain_a) > 0", "len(gain_b) > 0"
    return union([
        qa("tables_related", n_a="n_a", n_b="n_b", n_overlap="n_overlap", pct=fixed("pct", 0), **shared),
        qa("join_gain", f"{has_a} OR {has_b}",
           gain_a=f"CASE WHEN {has_a} THEN {clause('gain_a', table='a', columns=names('gain_a'))} ELSE '' END",
           joint=f"CASE WHEN {has_a} AND {has_b} THEN 'with ' ELSE '' END",
           gain_b=f"CASE WHEN {has_b} THEN {clause('gain_b', table='b', columns=names('gain_b'))} ELSE '' END", **shared),
    ])


def qa(key: str, frame: str, where: str = "true", owner: str = "tbl", /, **values: str) -> str:
    category, question, answer = TABLE_QA[key]
    return (f"SELECT {say(question, **values)} AS instruction, {say(answer, **values)} AS response, {lit(category)} AS category, "
            f"{owner} AS \"table\", {lit(key)} AS template_id FROM {frame} WHERE {where}")


def named(frame: str) -> str:
    return f"(SELECT f.*, z.readable, z.n_rows AS all_rows, z.n_cols AS all_cols FROM {frame} f JOIN sizes z ON f.tbl = z.tbl) q"


def shown_cell(c: str, kind: str) -> str:
    return g6(c) if kind == "d" else f"{c}::VARCHAR"


def md5_key(columns) -> str:
    if len(columns) == 1:
        return f"md5(coalesce({columns[0]}::VARCHAR, ''))"
    return "md5(concat_ws('|', " + ", ".join(f"coalesce({c}::VARCHAR, '')" for c in columns) + "))"


def rows_sql(tables) -> str:
    parts = []
    for t in tables:
        plain = [(c, p, k) for p, (c, k) in enumerate(TABLES[t]) if k != "a"]
        ids = id_columns(t)
        candidates = ids + [c for c, _, _ in plain if c not in ids]
        first = lambda show: "CASE " + " ".join(f"WHEN {c} IS NOT NULL THEN {show(c)}" for c in candidates) + " END"
        sample = f"(SELECT *, {first(lambda c: f'{c}::VARCHAR')} AS row_id, {first(lit)} AS id_column FROM {source(t)} s ORDER BY {md5_key(KEYS[t])} LIMIT 20) x"
        use = lambda c: f"{c} IS NOT NULL AND id_column <> {lit(c)}"
        listing = lambda kind, chosen: "concat_ws('; ', " + ", ".join(
            f"CASE WHEN {use(c)} THEN {clause(kind, name=lit(c.replace('_', ' ')), value=shown_cell(c, k))} END" for c, k in chosen) + ")"
        numbers = [(c, k) for c, _, k in plain if k in "ild"]
        others = [(c, k) for c, _, k in plain if k not in "ild"]
        measurements = listing("measurement", numbers) if numbers else "''"
        properties = listing("property", others) if others else "''"
        shared = {"id_name": clean("id_column"), "row_id": "row_id", "readable": lit(title(t)), "table": lit(t)}
        parts.append(qa("row_measurements", sample, f"{measurements} <> ''", lit(t), measurements=measurements,
                        properties=f"CASE WHEN {properties} <> '' THEN {clause('row_properties', properties=properties)} ELSE '' END", **shared))
        parts += [
            qa("row_cell", sample, f"{use(c)} AND substr(md5(row_id || {lit(c)}), 1, 4) < '5555'", lit(t),
               name=lit(c.replace("_", " ")), value=shown_cell(c, k), **shared)
            for c, _, k in plain
        ]
    return union(parts)


def qa_sql() -> dict[str, str]:
    """Question-answer pairs per family."""
    P = PRELUDE
    in_table = {"readable": "readable", "table": "tbl"}
    name = clean("col")
    pair = {"a": clean("col_a"), "b": clean("col_b"), "r": fixed("r", 3)}
    opt = lambda test, text, other="''": f"CASE WHEN {test} THEN {text} ELSE {other} END"
    top = named("""(SELECT s.tbl, v.col, v.cv, v.mn_text, v.mx_text, v.av, v.sd, s.n_num, s.n_cat FROM sizes s LEFT JOIN
        (SELECT * FROM num WHERE cv > 0.3 AND sd <> 0 QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY pos) = 1) v ON s.tbl = v.tbl)""")
    values = named(f"""(SELECT tbl, col, string_agg(CASE WHEN rnk <= 5 THEN {clause('value_count', value='val', n='n')} END, ', ' ORDER BY rnk) AS vals,
        (SELECT max(t.k) FROM tail t WHERE t.tbl = vals.tbl AND t.col = vals.col) AS k, min_by(val, rnk) AS top_val, max(n) AS top_n FROM vals GROUP BY tbl, col)""")
    compared = named(f"""(SELECT g.tbl, g.cat, g.num, string_agg({clause('group_average', value='g.val', num_name=clean('g.num'), avg=g6('g.av'), n='g.n')},
        '; ' ORDER BY g.rnk) AS parts FROM grp g JOIN cmp c ON g.tbl = c.tbl AND g.cat = c.cat AND g.num = c.num
        WHERE g.rnk <= 3 AND g.av IS NOT NULL GROUP BY ALL)""")
    totals = f"""(SELECT count(*) AS n_tables, sum(n_rows)::BIGINT AS n_rows, sum(n_cols)::BIGINT AS n_cols,
        string_agg({clause('table_size', readable='readable', n_rows='n_rows')}, ', ' ORDER BY tpos) AS tables FROM sizes) q"""
    shared = f"""(SELECT string_agg({clause('shared_column', name=name, tables='tables')}, '; ' ORDER BY first_seen) AS shared FROM shared) q"""
    gaps = named(f"""(SELECT tbl, count(*) FILTER (WHERE n_null > 0) AS k, count(*) FILTER (WHERE n_null = 0) AS n_complete,
        string_agg(CASE WHEN n_null > 0 THEN {clause('null_column', name=name, n='n_null', pct=fixed('100.0::DOUBLE * n_null / n_rows', 1))} END, '; ' ORDER BY n_null DESC, pos) AS columns,
        string_agg(CASE WHEN n_null > 0 THEN {clause('gap', name=name, pct=fixed('100 * (1 - n_null::DOUBLE / n_rows)', 0))} END, ', ' ORDER BY pos) AS gaps
        FROM nulls GROUP BY tbl)""")
    outliers = named("(SELECT f.*, s.n_outlier FROM fences f JOIN spread s ON f.tbl = s.tbl AND f.col = s.col)")
    sanity = named(f"""(SELECT tbl, string_agg(CASE kind WHEN 'nulls' THEN {clause('check_nulls', name=name, n='n', pct=fixed('pct', 1))}
        WHEN 'constant' THEN {clause('check_constant', name=name, value='val')} ELSE {clause('check_dominant', name=name, value='val', pct=fixed('pct', 0))} END,
        '; ' ORDER BY chk) AS checks FROM sanity GROUP BY tbl)""")
    measured = named("(SELECT * FROM num WHERE n >= 2 AND sd IS NOT NULL AND av IS NOT NULL)")
    has = {k: f"bool_or({' OR '.join(f'lower(col) LIKE {lit(chr(37) + h + chr(37))}' for h in hints)})" for k, hints, _, _ in METADATA_KINDS}
    present = "concat_ws(', ', " + ", ".join(f"CASE WHEN {has[k]} THEN {lit(w)} END" for k, _, _, w in METADATA_KINDS if w) + ")"
    missing = "concat_ws(', ', " + ", ".join(f"CASE WHEN NOT {has[k]} THEN {lit(w)} END" for k, _, w, _ in METADATA_KINDS) + ")"
    metadata = named(f"(SELECT tbl, {present} AS present, {missing} AS missing FROM cols GROUP BY tbl)")

    def pair_list(test: str, template: str, limit: int, order: str = "rnk") -> str:
        return named(f"""(SELECT tbl, string_agg({clause(template, **pair)}, '; ' ORDER BY {order}) AS parts FROM
            (SELECT * FROM corr WHERE {test} QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY {order}) <= {limit}) GROUP BY tbl)""")

    strong = named(f"""(SELECT tbl, string_agg(CASE WHEN r > 0 THEN {clause('strong_positive', **pair)} ELSE {clause('strong_negative', **pair)} END,
        '; ' ORDER BY r <= 0, rnk) AS parts FROM (SELECT * FROM corr WHERE abs(r) > 0.7 QUALIFY row_number() OVER (PARTITION BY tbl, r > 0 ORDER BY rnk) <= 5) GROUP BY tbl)""")
    partners = named(f"""(SELECT c.tbl, c.col, c.mean_r, string_agg({clause('partner', name=clean('p.partner'), r=fixed('p.r', 3))}, '; ' ORDER BY p.rnk) AS parts
        FROM connected c JOIN (SELECT *, row_number() OVER (PARTITION BY tbl, col ORDER BY rnk) AS k FROM (
            SELECT tbl, col_a AS col, col_b AS partner, r, rnk FROM corr UNION ALL SELECT tbl, col_b, col_a, r, rnk FROM corr)) p
        ON c.tbl = p.tbl AND c.col = p.col WHERE p.k <= 3 GROUP BY ALL)""")
    detail = clause("group_detail", value="s.val", avg=g6("coalesce(s.av, 0)"), stddev=g6("coalesce(s.sd, 0)"), n="s.n")
    subgroup = named(f"""(SELECT b.*, (SELECT string_agg({detail}, '; ' ORDER BY s.lo_place) FROM sub0 s
        WHERE s.tbl = b.tbl AND s.cat = b.cat AND s.num = b.num) AS groups FROM sub b)""")
    sub_shared = {"cat_name": clean("cat"), "num_name": clean("num"), "pct": fixed("pct", 1), **in_table}
    multi = named(f"""(SELECT tbl, string_agg({clause('multi_outlier', id='id', n='n_outlier')}, '; ' ORDER BY n_outlier DESC, id) AS samples
        FROM (SELECT "table" AS tbl, id, n_outlier FROM ({multi_sql(IDS)})
        QUALIFY row_number() OVER (PARTITION BY "table" ORDER BY n_outlier DESC, id) <= 5) GROUP BY tbl)""")
    first_bimodal = named("(SELECT * FROM bimodal WHERE sd <> 0 AND middle_pct < 15 AND n_valid > 20 QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY pos) = 1)")
    cv_list = lambda test: (
        f"(SELECT string_agg({clean('u.col')}, ', ' ORDER BY u.cv DESC, u.pos) FROM (SELECT *, row_number() OVER (PARTITION BY tbl ORDER BY cv DESC, pos) AS k "
        f"FROM num WHERE sd <> 0 AND cv IS NOT NULL AND {test}) u WHERE u.tbl = h.tbl AND u.k <= 3)"
    )
    told = named(f"""(SELECT h.tbl, h.n_num, concat_ws('. ',
          (SELECT {clause('focus_cv', name=clean('u.col'), cv=fixed('u.cv', 2))} FROM num u WHERE u.tbl = h.tbl AND u.sd <> 0 AND u.cv IS NOT NULL ORDER BY u.cv DESC, u.pos LIMIT 1),
          (SELECT {clause('focus_pair', a=clean('u.col_a'), b=clean('u.col_b'), r=fixed('u.r', 3))} FROM corr u WHERE u.tbl = h.tbl AND u.rnk = 1),
          CASE WHEN h.n_rows < 30 THEN {clause('focus_few', n_rows='h.n_rows')} WHEN h.n_rows > 1000 THEN {clause('focus_many', n_rows='h.n_rows')} END) AS focus,
        concat_ws('. ', {clause('story_stable', columns=cv_list('cv < 0.1'))}, {clause('story_variable', columns=cv_list('cv > 0.3'))},
          (SELECT {clause('story_strong', n='count(*)')} FROM corr u WHERE u.tbl = h.tbl AND abs(u.r) > 0.7 HAVING count(*) > 0)) AS findings FROM sizes h)""")
    ratio = fixed("n_rows::DOUBLE / greatest(n_num, 1)", 0)
    note = (f"CASE WHEN n_rows::DOUBLE / greatest(n_num, 1) < 5 THEN {clause('underpowered', ratio=ratio)} "
            f"WHEN n_rows::DOUBLE / greatest(n_num, 1) < 20 THEN {clause('adequate', ratio=ratio)} ELSE {clause('well_powered', ratio=ratio)} END")
    related = clause("related_pair", direction="CASE WHEN r > 0 THEN 'positively' ELSE 'negatively' END", **pair)
    opening = clause("story_size", table="tbl", n_rows="all_rows", n_numeric="n_num")
    schema = {"schema": lit(SCHEMA_NAME)}
    queries = {
        "qa_rows": [rows_sql(TABLES)],
        "qa_range": [qa("value_range", named("(SELECT * FROM num WHERE av IS NOT NULL)"), name=name, min="mn_text", max="mx_text", avg=g6("av"), n="n",
                        stddev=opt("sd <> 0", clause("range_stddev", stddev=g6("sd"))), **in_table)],
        "qa_top_values": [
            qa("most_common", values, name=name, values="vals", n_rows="all_rows", **in_table),
            qa("distinct_values", values, name=name, n_values="k", top_value="top_val", top_n="top_n", **in_table)],
        "qa_comparison": [qa("compare_groups", compared, num_name=clean("num"), cat_name=clean("cat"), parts="parts", **in_table)],
        "qa_schema": [
            qa("tables_available", totals, "true", "''", full_schema=lit(FULL_NAME), n_tables="n_tables", tables="tables", **schema),
            qa("data_volume", totals, "true", "''", n_tables="n_tables", n_rows="n_rows", n_cols="n_cols", **schema),
            qa("shared_columns", shared, "true", "''", shared="shared", **schema),
            qa("table_relations", shared, "true", "''", shared="shared", **schema)],
        "qa_reasoning": [
            qa("variability", top, "col IS NOT NULL", name=name, cv=fixed("cv", 2), min="mn_text", max="mx_text", avg=g6("av"), stddev=g6("sd"), **in_table),
            qa("quality", top, n_rows="all_rows", n_cols="all_cols", n_numeric="n_num", n_categorical="n_cat",
               most_variable=opt("col IS NOT NULL", clause("most_variable", name=name, cv=fixed("cv", 2))), **in_table),
            qa("class_balance", named("balance"), cat_name=name, top_value="top_val", top_n="top_n", bottom_value="low_val", bottom_n="low_n", **in_table)],
        "qa_nulls": [
            qa("missing_values", gaps, "k > 0", n_columns="k", columns="columns", n_rows="all_rows", **in_table),
            qa("no_missing_values", gaps, "k = 0", n_cols="all_cols", n_rows="all_rows", **in_table)],
        "qa_outliers": [
            qa("outliers", outliers, "n_outlier > 0", name=name, n_outlier="n_outlier", q1=g6("q1"), q3=g6("q3"), iqr=g6("iqr"), lower=g6("lo"), upper=g6("hi"),
               pct=fixed("100.0::DOUBLE * n_outlier / all_rows", 1), n_rows="all_rows", **in_table),
            qa("no_outliers", outliers, "n_outlier = 0", name=name, lower=g6("lo"), upper=g6("hi"), n_rows="all_rows", **in_table)],
        "qa_sanity": [qa("sanity_checks", sanity, checks="checks", n_rows="all_rows", **in_table)],
        "qa_uncertainty": [
            qa("precision", measured, "av <> 0", name=name, n="n", avg=g6("av"), stddev=g6("sd"), cv=fixed("cv", 4), cv_pct=fixed("cv * 100", 1),
               precision="CASE WHEN cv < 0.1 THEN 'high' WHEN cv < 0.3 THEN 'moderate' ELSE 'low' END", **in_table),
            qa("mean_interval", measured, name=name, n="n", avg=g6("av"), se=g6("se"), ci_lo=g6("av - 1.96 * se"), ci_hi=g6("av + 1.96 * se"), **in_table)],
        "qa_reproducibility": [
            qa("completeness", gaps, pct=fixed("100.0::DOUBLE * n_complete / all_cols", 0), n_complete="n_complete", n_cols="all_cols",
               gaps=opt("gaps IS NOT NULL", clause("gaps", columns="gaps"), lit(CLAUSES["no_gaps"])), **in_table),
            qa("missing_metadata", metadata, present=opt("present <> ''", clause("metadata_present", present="present")),
               missing=opt("missing <> ''", clause("metadata_missing", missing="missing"), lit(CLAUSES["metadata_all"])), **in_table)],
        "qa_correlation": [
            qa("correlated", strong, pairs="parts", **in_table),
            qa("independent", pair_list("abs(r) < 0.2", "pair", 5), pairs="parts", **in_table),
            qa("affects", named("(SELECT * FROM corr WHERE rnk <= 3 AND abs(r) >= 0.3)"), strength="CASE WHEN abs(r) > 0.7 THEN 'strong' ELSE 'moderate' END",
               direction="CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END",
               meaning=f"CASE WHEN r > 0 THEN {clause('meaning_up', a=pair['a'], b=pair['b'])} ELSE {clause('meaning_down', a=pair['a'], b=pair['b'])} END", **pair, **in_table),
            qa("redundant", pair_list("abs(r) > 0.95", "pair", 3, "pos_a, pos_b"), pairs="parts", **in_table),
            qa("most_connected", partners, name=name, mean_r=fixed("mean_r", 3), partners="parts", **in_table)],
        "qa_subgroups": [
            qa("highest_group", subgroup, high_value="high_val", high_avg=g6("high_avg"), high_n="high_n", low_value="low_val", low_avg=g6("low_avg"),
               low_n="low_n", diff=g6("diff"), **sub_shared),
            qa("groups_differ", subgroup, "pct > 20", groups="groups", **sub_shared)],
        "qa_anomaly": [
            qa("multi_outliers", multi, samples="samples", **in_table),
            qa("bimodal", first_bimodal, name=name, pct=fixed("middle_pct", 0), n_lower="n_lower", n_upper="n_upper", **in_table),
            qa("surprising_group", named("surprise"), num_name=clean("num"), cat_name=clean("cat"), value="val",
               direction="CASE WHEN av > all_avg THEN 'unusually high' ELSE 'unusually low' END", group_avg=g6("av"), avg=g6("all_avg"), z=fixed("z", 1), **in_table)],
        "qa_interpretation": [
            qa("focus", told, "focus <> ''", highlights="focus", **in_table),
            qa("story", told, "findings <> ''", parts=f"({opening} || '. ' || findings)", **in_table),
            qa("relationships", named(f"(SELECT tbl, string_agg({related}, '; ' ORDER BY rnk) AS parts FROM corr WHERE rnk <= 5 GROUP BY tbl)"), pairs="parts", **in_table),
            qa("sufficiency", "sizes q", n_rows="n_rows", n_numeric="n_num", note=note, **in_table)],
    }
    whole_set = {t: {} for t in TABLES}
    every = union([part for parts in queries.values() for part in parts] + [cross_table_pairs(whole_set)])
    every_pair = f", {related_ctes(whole_set)} {every}"
    return {key: P + union(parts) for key, parts in queries.items()} | {"qa_tables": P.rstrip() + every_pair}


# ---- verbalisation ---------------------------------------------------------------

def row_text(t: str) -> str:
    groups: dict[str, list[str]] = {"identification": [], "measurements": [], "properties": []}
    for c, k in TABLES[t]:
        if k == "a":
            continue
        hinted = any(h in c for h in ("id", "name", "code", "key", "sample"))
        group = "measurements" if k in "ild" else "identification" if k == "s" and hinted else "properties"
        groups[group].append(say(PASSAGES["field"], name=lit(c.replace("_", " ")), value=shown_cell(c, k)))
    parts = [lit(PASSAGES["record"].format(readable=title(t), table=t))]
    for group, fields in groups.items():
        if fields:
            parts.append(say(PASSAGES[group], fields=f"nullif(concat_ws('; ', {', '.join(fields)}), '')"))
    return f"concat_ws(' ', {', '.join(parts)})"


def passages_sql(t: str, order: str) -> str:
    text = say(PASSAGES["passage"], readable=lit(title(t)), table=lit(t), name=lit(t.replace("_", " ")),
               rows="string_agg(line, chr(10) ORDER BY rn)", n_rows=f"(SELECT count(*) FROM {source(t)} y)", n_cols=str(len(TABLES[t])))
    return (f"SELECT {lit(t)} AS \"table\", (rn - 1) // 5 AS passage_id, {text} AS text FROM (SELECT row_number() OVER (ORDER BY {order}) AS rn, "
            f"{row_text(t)} AS line FROM {source(t)} s) x GROUP BY (rn - 1) // 5")


def verbal_sql() -> dict[str, str]:
    P = PRELUDE
    overview = f"""SELECT o.tbl AS "table", {say(PASSAGES['table_overview'], table='o.tbl', readable='o.readable', n_rows='o.n_rows', n_cols='o.n_cols',
        columns='o.columns', numeric='o.numeric', text='o.strings')} AS text FROM (SELECT s.tbl, s.readable, s.n_rows, s.n_cols,
        string_agg(c.col || ' (' || c.dtype || ')', ', ' ORDER BY c.pos) AS columns,
        coalesce(string_agg(CASE WHEN c.is_num THEN c.col END, ', ' ORDER BY c.pos), 'None') AS numeric,
        coalesce(string_agg(CASE WHEN c.is_str THEN c.col END, ', ' ORDER BY c.pos), 'None') AS strings
        FROM sizes s JOIN cols c ON s.tbl = c.tbl GROUP BY ALL) o"""
    line = say(PASSAGES["schema_table"], readable="readable", table="tbl", n_rows="n_rows", n_cols="n_cols")
    entry = say(PASSAGES["schema_shared"], column="col", tables="tables")
    schema = f"""SELECT {say(PASSAGES['schema_overview'], full_schema=lit(FULL_NAME), n_tables='count(*)', n_rows='sum(n_rows)::BIGINT',
        tables=f"string_agg({line}, '' ORDER BY tpos)",
        shared=f"coalesce({lit(PASSAGES['schema_shared_head'])} || (SELECT string_agg({entry}, '' ORDER BY first_seen) FROM shared), '')")} AS text FROM sizes"""
    orders = {t: ", ".join(KEYS[t]) for t in TABLES}
    passages = [passages_sql(t, orders[t]) for t in TABLES]
    corpus = union(
        [f"SELECT 'schema' AS kind, '' AS \"table\", NULL::BIGINT AS passage_id, text FROM ({schema})",
         f"SELECT 'table', \"table\", NULL::BIGINT, text FROM ({overview})"]
        + [f"SELECT 'passage', \"table\", passage_id, text FROM ({p})" for p in passages]
    )
    return {
        "row_text": union(f"SELECT {lit(t)} AS \"table\", {row_text(t)} AS text FROM {source(t)} s" for t in TABLES),
        "passages": union(passages),
        "table_overview": P + overview,
        "schema_overview": P + schema,
        "corpus": P + corpus,
    }
