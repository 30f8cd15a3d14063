"""Reference SQL for corpora, instruction data, registries and evaluation."""

from __future__ import annotations

from checks.tables_sql import TABLES, clean, clause, fixed, g6, lit, say, union
from tabulore.plans.templates import CLAUSES, PROMPTS, REGISTRY_QA

SPACE = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def cleaned(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{SPACE}', ' ', 'g'), ' '), '')"


def blank(x: str) -> str:
    return f"regexp_full_match({x}, '{SPACE[:-1]}*')"


def words(x: str) -> str:
    c = cleaned(x)
    return f"(CASE WHEN {c} = '' THEN [] ELSE string_split({c}, ' ') END)"


def metric(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 'N/A' WHEN abs({x}) < 0.01 OR abs({x}) > 10000 THEN {g6(x)} ELSE {fixed(x, 4)} END"


READY = f"""(SELECT min(doc_id) AS doc_id, text FROM (SELECT doc_id, {cleaned('text')} AS text FROM documents)
    WHERE length(text) BETWEEN 100 AND 50000 GROUP BY text)"""
TURNS = """(SELECT a.conv_id, a.turn, a.text AS instruction, b.text AS response,
    CASE WHEN a.conv_id % 10 = 0 THEN 'schema' WHEN a.conv_id % 3 = 0 THEN 'aggregation' ELSE 'row_level' END AS category
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')"""
COMBINED = f"""(SELECT instruction, response, category FROM {TURNS} UNION ALL
    SELECT 'Which language is document ' || doc_id || '?', lang, 'document' FROM documents)"""
SEARCHED = "(VALUES ('THE '), ('ab'), ('Licensed under'), ('wxyzq')) t(term)"
TEXT_COLUMNS = {
    "region": "r_name", "nation": "n_name", "customer": "c_name", "supplier": "s_name", "part": "p_name", "orders": "o_orderstatus",
    "lineitem": "l_returnflag", "events": "event_type", "documents": "text", "pages": "url", "benchmark": "text", "conversations": "text",
}


def corpus_sql() -> dict[str, str]:
    size = "length(text)"
    instruct_text = say(PROMPTS["instruct"], instruction="instruction", response="response")
    n_words = f"len({words('text')})"
    return {
        "top_categories": """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem WHERE l_returnflag IN
            (SELECT l_returnflag FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, md5(l_returnflag) LIMIT 2) GROUP BY 1""",
        "scan_tables": union(f"SELECT {lit(t)} AS \"table\", count(*) AS n_rows FROM {t}" for t in TABLES if t not in ("labels", "labelled")),
        "schema_text": union(f"SELECT {lit(t)} AS \"table\", {c} AS text FROM {t} WHERE {c} IS NOT NULL AND NOT {blank(c)}" for t, c in TEXT_COLUMNS.items()),
        "extract_text": "SELECT text FROM (SELECT text FROM documents ORDER BY doc_id LIMIT 500) WHERE text IS NOT NULL AND text <> ''",
        "take_first": "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 300",
        "jsonl_roundtrip": "SELECT text FROM documents",
        "clean_text": f"SELECT doc_id, {cleaned('text')} AS text FROM documents",
        "length_filter": "SELECT doc_id, text FROM documents WHERE length(text) BETWEEN 100 AND 50000",
        "drop_blank": f"SELECT page_id, url FROM pages WHERE html IS NOT NULL AND NOT {blank('html')}",
        "drop_blanked": "SELECT page_id, url FROM pages WHERE page_id % 3 <> 0 AND page_id % 5 <> 0",
        "table_overwrite": "SELECT o_orderkey, o_totalprice FROM orders",
        "json_result": "SELECT s_suppkey, s_name AS name, s_nationkey AS nation FROM supplier",
        "catalog_tables": """SELECT 'nation' AS "table", count(*) AS n_rows FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier""",
        "overlap_types": """WITH w AS (SELECT DISTINCT o_orderkey AS k FROM orders), e AS (SELECT DISTINCT o_orderkey * 2 AS k FROM orders)
            SELECT 'key' AS "column", 'whole' AS table_a, 'exact' AS table_b, (SELECT count(*) FROM w) AS n_a, (SELECT count(*) FROM e) AS n_b, count(*) AS n_overlap,
            round(100.0::DOUBLE * count(*) / least((SELECT count(*) FROM w), (SELECT count(*) FROM e)), 6) AS pct_of_smaller FROM w JOIN e ON w.k = e.k""",
        "metric_direction": """SELECT ['mape', 'sentiment_f1', 'fit_time', 'val_loss', 'r2'][s_suppkey % 5 + 1] AS metric, count(*) AS n,
            CASE WHEN metric IN ('mape', 'val_loss') THEN 'lowest' ELSE 'highest' END AS direction, metric = 'fit_time' AS is_latency FROM supplier GROUP BY metric""",
        "dedup_exact": f"SELECT doc_id, text FROM {READY}",
        "corpus_stats": f"""SELECT lang, count(*) AS n_docs, sum({size})::BIGINT AS n_chars, sum({size})::DOUBLE / 4 AS est_tokens,
            round(avg({size}), 4) AS avg_chars FROM documents GROUP BY lang""",
        "document_funnel": f"""WITH c AS (SELECT {cleaned('text')} AS text FROM documents), l AS (SELECT text FROM c WHERE length(text) BETWEEN 100 AND 50000),
            n AS (SELECT (SELECT count(*) FROM documents) AS a, (SELECT count(*) FROM c) AS b, (SELECT count(*) FROM l) AS d, (SELECT count(DISTINCT text) FROM l) AS e)
            SELECT 0 AS step, 'raw' AS stage, a AS n_before, a AS n_after FROM n UNION ALL SELECT 1, 'clean', a, b FROM n
            UNION ALL SELECT 2, 'length', b, d FROM n UNION ALL SELECT 3, 'dedup', d, e FROM n""",
        "split_exact": f"""SELECT doc_id, row_number() OVER (ORDER BY md5(doc_id::VARCHAR)) <= (SELECT count(*) - floor(count(*) * (1 - 0.05::DOUBLE)) FROM {READY}) AS is_val FROM {READY}""",
        "split_hash": "SELECT o_orderkey, substr(md5(o_orderkey::VARCHAR), 1, 15) < '" + format(round(0.05 * 16**15), '015x') + "' AS is_val FROM orders",
        "replay_mix": """WITH d AS (SELECT doc_id FROM documents), p AS (SELECT item_id AS doc_id FROM benchmark),
            r AS (SELECT doc_id FROM p QUALIFY row_number() OVER (ORDER BY md5(doc_id::VARCHAR)) <=
              (SELECT least(floor(count(*) * 0.2::DOUBLE / (1 - 0.2::DOUBLE)), (SELECT count(*) FROM p)) FROM d))
            SELECT doc_id, 'domain' AS source_tag, md5('domain|' || doc_id) AS mix_key FROM d UNION ALL
            SELECT doc_id, 'replay', md5('replay|' || doc_id) FROM r""",
        "sample_rows": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR) LIMIT 25",
        "sample_per_group": "SELECT lang, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR)) <= 3",
        "numbered_rows": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_number FROM orders",
        "sequence_budget": f"""SELECT lang, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens, sum(least(n, 256))::BIGINT AS n_kept, count(*) FILTER (WHERE n > 256) AS n_truncated,
            round(100.0::DOUBLE * count(*) FILTER (WHERE n > 256) / count(*), 6) AS pct_truncated FROM (SELECT lang, {n_words} AS n FROM documents) GROUP BY lang""",
        "instruct": f"SELECT conv_id, turn, {instruct_text} AS text FROM {TURNS}",
        "combine_qa": f"SELECT * FROM {COMBINED}",
        "category_counts": f"SELECT category, count(*) AS n FROM {COMBINED} GROUP BY category",
        "search_index": f"SELECT q.*, t.term FROM {COMBINED} q, {SEARCHED} WHERE contains(lower(instruction), lower(term)) OR contains(lower(response), lower(term))",
        "search_documents": f"SELECT doc_id, lang, term FROM documents, {SEARCHED} WHERE contains(lower(text), lower(term))",
        "pareto_items": """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem a WHERE NOT EXISTS (SELECT 1 FROM
            (SELECT DISTINCT l_quantity AS q, l_extendedprice AS p, l_discount AS d, l_tax AS t FROM lineitem) b
            WHERE q >= l_quantity AND p <= l_extendedprice AND d >= l_discount AND t <= l_tax AND (q > l_quantity OR p < l_extendedprice OR d > l_discount OR t < l_tax))""",
        "search_qa": f"SELECT * FROM {COMBINED} WHERE contains(lower(instruction), 'the ') OR contains(lower(response), 'the ') ORDER BY instruction, response LIMIT 5",
        "cap_pairs": f"""WITH q AS (SELECT * FROM {COMBINED}), f AS (SELECT * FROM q WHERE category = 'schema'), o AS (SELECT * FROM q WHERE category <> 'schema')
            SELECT category, instruction, response FROM q WHERE (SELECT count(*) FROM q) <= 150
            UNION ALL SELECT category, instruction, response FROM f WHERE (SELECT count(*) FROM q) > 150
            UNION ALL SELECT category, instruction, response FROM (SELECT * FROM o WHERE (SELECT count(*) FROM q) > 150
              QUALIFY row_number() OVER (ORDER BY md5(instruction || '|' || response)) <= greatest(0, 150 - (SELECT count(*) FROM f)))""",
        "chat_prompt": """SELECT conv_id, '<s>' || coalesce(string_agg(CASE role WHEN 'user' THEN '[INST] ' || text || ' [/INST] '
            WHEN 'assistant' THEN text || '</s><s>' END, '' ORDER BY turn), '') AS prompt FROM conversations GROUP BY conv_id""",
        "extract_response": """SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN trim(role) WHEN contains(text, '[/INST]') THEN trim(string_split(text || ' ' || role, '[/INST]')[-1])
            ELSE trim(role) END AS response FROM conversations""",
        "mask_spans": f"""WITH t AS (SELECT conv_id, turn, {instruct_text} AS text FROM {TURNS}),
            n AS (SELECT conv_id, turn, least({n_words}, 64) AS n_tokens, len({words("substr(text, 1, instr(text, '[/INST]') + 6)")}) AS head FROM t)
            SELECT conv_id, turn, n_tokens::INT AS n_tokens, least(head, n_tokens)::INT AS n_masked, (n_tokens - least(head, n_tokens))::INT AS n_trainable,
            least(head, n_tokens)::INT AS n_ignored, n_tokens::INT AS n_labels FROM n""",
        "number_texts": f"""SELECT l_orderkey, l_linenumber, l_partkey, {g6('l_extendedprice * [1e-8, 1e-5, 1e-2, 10, 1e4, 1e7, 1e10][l_linenumber]')} AS g6, {metric('l_discount')} AS metric,
            {fixed('l_extendedprice / 8', 2)} AS two, {fixed('l_quantity / 2', 0)} AS whole, {g6('l_tax')} AS value,
            CASE WHEN l_discount > 0.05::DOUBLE THEN 'Yes' ELSE 'No' END AS high FROM lineitem""",
        "json_values": """SELECT event_id, CASE WHEN event_id % 4 < 3 THEN (props->>'k')::BIGINT END AS k,
            CASE WHEN event_id % 4 = 3 THEN 'not json: ' || event_type END AS raw FROM events""",
    }


# ---- registry ---------------------------------------------------------------------

METRICS = ("accuracy", "f1", "inference_latency_ms", "mae", "r2", "rmse", "training_time")
LOWER = ("inference_latency_ms", "mae", "rmse", "training_time")
ACCURATE = ("accuracy", "f1", "r2")
LATENCY = ("inference_latency_ms", "training_time")

BASE = """WITH meas AS (SELECT l_suppkey, l_linenumber AS version, count(*) AS n, round(avg(l_discount), 6) AS disc, round(avg(l_tax), 6) AS tax,
  round(avg(l_quantity) / 50, 6) AS qty, round(avg(l_extendedprice) / 1000, 6) AS price, round(sum(l_quantity), 2) AS total, min(l_partkey) AS part
  FROM lineitem GROUP BY ALL),
ver AS (SELECT s_name AS name, version, CASE WHEN version = 1 THEN 'Production' WHEN version <= 3 THEN 'Staging' WHEN version <= 5 THEN 'None' ELSE 'Archived' END AS stage,
  CASE WHEN version % 2 = 1 THEN 'Trained on ' || n || ' rows' ELSE '' END AS description, 'run-' || l_suppkey || '-' || version AS run_id, m.*  EXCLUDE (version), s_nationkey
  FROM meas m JOIN supplier ON l_suppkey = s_suppkey),
latest AS (SELECT * FROM ver QUALIFY row_number() OVER (PARTITION BY name, stage ORDER BY version DESC) = 1)
"""
REG = BASE + """, mv AS (SELECT name, version, stage, run_id, n, part, version <> 7 AS has_run,
  CASE WHEN description <> '' THEN description WHEN s_nationkey % 2 = 0 THEN 'Model of nation ' || s_nationkey ELSE '' END AS description, s_nationkey,
  disc AS rmse, tax AS mae, qty AS accuracy, round(1 - tax * 4, 6) AS r2, CASE WHEN version % 2 = 1 THEN 1 - disc END AS f1, price AS inference_latency_ms, total AS training_time
  FROM latest),
mm0 AS (""" + union(f"SELECT name, version, stage, '{m}' AS metric, {m}::DOUBLE AS value FROM mv WHERE has_run AND {m} IS NOT NULL" for m in METRICS) + f"""),
mm AS (SELECT *, metric IN ({', '.join(map(lit, LOWER))}) AS is_lower, metric IN ({', '.join(map(lit, ACCURATE))}) AS is_acc,
  metric IN ({', '.join(map(lit, LATENCY))}) AS is_lat, CASE WHEN metric IN ({', '.join(map(lit, LOWER))}) THEN value ELSE -value END AS cost,
  CASE WHEN metric IN ({', '.join(map(lit, LOWER))}) THEN 'lowest' ELSE 'highest' END AS direction FROM mm0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY cost, name, version) AS rnk, rank() OVER (PARTITION BY metric ORDER BY cost DESC) AS worst,
  count(*) OVER (PARTITION BY metric) AS k FROM mm),
params AS (SELECT name, version, 'n_rows' AS p, n::VARCHAR AS v FROM mv WHERE has_run UNION ALL SELECT name, version, 'depth', version::VARCHAR FROM mv WHERE has_run
  UNION ALL SELECT name, version, 'random_seed', part::VARCHAR FROM mv WHERE has_run AND version % 3 = 0),
mtext AS (SELECT name, version, string_agg(metric || ': ' || {metric('value')}, '; ' ORDER BY metric) AS metrics FROM mm GROUP BY ALL),
ptext AS (SELECT name, version, count(*) AS n_params, string_agg(p || ': ' || v, '; ' ORDER BY p) AS params FROM params GROUP BY ALL),
full_mv AS (SELECT m.name, m.version, m.stage, m.description, t.metrics, p.params, coalesce(p.n_params, 0) AS n_params
  FROM mv m LEFT JOIN mtext t ON m.name = t.name AND m.version = t.version LEFT JOIN ptext p ON m.name = p.name AND m.version = p.version),
nxt AS (SELECT name, version, lead(name) OVER w AS name_b, lead(version) OVER w AS version_b FROM (SELECT DISTINCT name, version FROM mm) WINDOW w AS (ORDER BY name, version)),
duel AS (SELECT a.name AS name_a, a.version AS version_a, b.name AS name_b, b.version AS version_b, count(*) FILTER (WHERE a.cost < b.cost) AS wins_a,
  count(*) FILTER (WHERE b.cost < a.cost) AS wins_b, count(*) FILTER (WHERE a.value = b.value) AS ties, count(*) AS n_shared,
  string_agg({say(CLAUSES['pair_metric'], metric='a.metric', label_a=clause('label', model='a.name', version='a.version'),
                  label_b=clause('label', model='b.name', version='b.version'), value_a=metric('a.value'), value_b=metric('b.value'))}, '; ' ORDER BY a.metric) AS parts
  FROM mm a JOIN nxt ON a.name = nxt.name AND a.version = nxt.version JOIN mm b ON b.name = nxt.name_b AND b.version = nxt.version_b AND a.metric = b.metric GROUP BY ALL),
wins AS (SELECT name, version, stage, count(*) AS wins, list(metric || ': ' || {metric('value')} ORDER BY metric) AS led FROM ranked WHERE rnk = 1 GROUP BY ALL),
winner AS (SELECT *, (SELECT count(DISTINCT metric) FROM mm) AS n_metrics FROM wins ORDER BY wins DESC, name, version LIMIT 1),
acc1 AS (SELECT name, version FROM mm WHERE is_acc ORDER BY metric, value DESC, name, version LIMIT 1),
fast AS (SELECT * FROM mm WHERE is_lat AND metric IN (SELECT metric FROM mm GROUP BY metric HAVING count(*) >= 2)
  QUALIFY row_number() OVER (PARTITION BY metric ORDER BY value, name, version) = 1),
best_acc AS (SELECT * FROM ranked WHERE is_acc AND rnk = 1 AND k >= 2),
best_err AS (SELECT * FROM ranked WHERE is_lower AND NOT is_lat AND rnk = 1 AND k >= 2),
tr AS (SELECT a.name, a.version, a.metric AS accuracy, a.value AS av, l.metric AS latency, l.value AS lv FROM mm a JOIN mm l ON a.name = l.name AND a.version = l.version
  WHERE l.metric = (SELECT min(metric) FROM mm WHERE is_lat) AND a.is_acc),
trade AS (SELECT * FROM tr WHERE accuracy = (SELECT min(accuracy) FROM (SELECT accuracy FROM tr GROUP BY accuracy HAVING count(*) >= 2))),
risk AS (SELECT * FROM ranked WHERE stage = 'Production' AND worst = 1 AND rnk > 1 AND k > 1 QUALIFY row_number() OVER (PARTITION BY name, version ORDER BY metric) = 1),
vary AS (SELECT metric, count(*) AS k, arg_min(struct_pack(name, version, value), (value, name, version)) AS best, arg_max(struct_pack(name, version, value), (value, name, version)) AS worst
  FROM mm WHERE metric IN ('rmse', 'mae') GROUP BY metric HAVING count(*) >= 2),
stages AS (SELECT stage, count(*) AS n_versions, count(DISTINCT name) AS n_models FROM mv GROUP BY stage),
totals AS (SELECT count(DISTINCT name) AS n_models, count(*) AS n_versions, (SELECT count(DISTINCT metric) FROM mm) AS n_metrics, (SELECT count(DISTINCT p) FROM params) AS n_params,
  (SELECT string_agg(DISTINCT metric, ', ' ORDER BY metric) FROM mm) AS metrics, (SELECT string_agg(DISTINCT p, ', ' ORDER BY p) FROM params) AS params FROM mv),
inv AS (SELECT metric, count(*) AS k FROM mm GROUP BY metric HAVING count(*) > 1),
inv_list AS (SELECT metric, string_agg({clause('label', model='name', version='version')}, ', ' ORDER BY name, version) AS labels FROM
  (SELECT *, (row_number() OVER (PARTITION BY metric ORDER BY name, version) - 1) // 100 AS block FROM mm) WHERE metric IN (SELECT metric FROM inv) GROUP BY metric, block),
limits AS (SELECT name, version, 1 AS place, CASE WHEN metric IN ('accuracy', 'r2') THEN 'variance' ELSE 'misses' END AS kind, metric, value, NULL::INT AS n_params FROM mm
  WHERE (metric IN ('accuracy', 'r2') AND value < 0.8) OR (metric = 'f1' AND value < 0.7)
  UNION ALL SELECT m.name, m.version, 2, 'params', '', NULL, f.n_params::INT FROM mv m JOIN full_mv f ON m.name = f.name AND m.version = f.version WHERE m.has_run AND f.n_params < 3)
"""


# As duel, with every two versions instead of each and its next.
EVERY = REG + f""", duel_all AS (SELECT a.name AS name_a, a.version AS version_a, b.name AS name_b, b.version AS version_b, count(*) FILTER (WHERE a.cost < b.cost) AS wins_a,
  count(*) FILTER (WHERE b.cost < a.cost) AS wins_b, count(*) FILTER (WHERE a.value = b.value) AS ties, count(*) AS n_shared,
  string_agg({say(CLAUSES['pair_metric'], metric='a.metric', label_a=clause('label', model='a.name', version='a.version'),
                  label_b=clause('label', model='b.name', version='b.version'), value_a=metric('a.value'), value_b=metric('b.value'))}, '; ' ORDER BY a.metric) AS parts
  FROM mm a JOIN mm b ON a.metric = b.metric AND (a.name < b.name OR (a.name = b.name AND a.version < b.version)) GROUP BY ALL)
"""


def qa(key: str, frame: str, where: str = "true", /, **values: str) -> str:
    category, question, answer = REGISTRY_QA[key]
    return (f"SELECT {say(question, **values)} AS instruction, {say(answer, **values)} AS response, {lit(category)} AS category, '' AS \"table\", "
            f"{lit(key)} AS template_id FROM {frame} WHERE {where}")


def registry_qa_sql() -> dict[str, list[str]]:
    label = clause("label", model="name", version="version")
    value = metric("value")
    model = {"model": "name", "label": label}
    opt = lambda test, text: f"CASE WHEN {test} THEN {text} ELSE '' END"
    about = opt("description <> ''", clause("stage_description", description="description"))
    summary = "concat_ws('. ', " + ", ".join([
        clause("summary_head", label=label, stage="stage"),
        f"CASE WHEN description <> '' THEN {clause('summary_description', description='description')} END",
        clause("summary_metrics", metrics="metrics"), clause("summary_params", params="params")]) + ")"
    of = lambda item: clause("label", model=f"{item}.name", version=f"{item}.version")
    first_two = """(SELECT metric, direction, max(CASE WHEN rnk = 1 THEN struct_pack(name, version, value) END) AS best,
        max(CASE WHEN rnk = 2 THEN struct_pack(name, version, value) END) AS second FROM ranked WHERE k >= 2 GROUP BY ALL)"""
    ranking = f"""(SELECT f.*, r.ranking FROM {first_two} f JOIN (SELECT metric, string_agg({clause('ranked', model='name', version='version', value=value)}, '; ' ORDER BY rnk) AS ranking
        FROM ranked WHERE k >= 2 GROUP BY metric, (rnk - 1) // 100) r ON f.metric = r.metric) q"""
    label_a, label_b = clause("label", model="name_a", version="version_a"), clause("label", model="name_b", version="version_b")
    winner = "(SELECT w.*, m.description FROM winner w JOIN mv m ON w.name = m.name AND w.version = m.version) q"
    other = "(SELECT " + label + " FROM acc1)"
    stage_list = lambda suffix: f"(SELECT string_agg(stage || ': ' || n_versions || '{suffix}', ', ' ORDER BY stage) FROM stages)"
    listed = lambda text, where="true": (
        f"(SELECT string_agg({text}, '; ' ORDER BY name, version) AS models FROM (SELECT *, (row_number() OVER (ORDER BY name, version) - 1) // 100 AS block "
        f"FROM mv WHERE {where}) GROUP BY block) q")
    entry = clause("trade_off_entry", label=label, accuracy="accuracy", latency="latency", accuracy_value=metric("av"), latency_value=metric("lv"))
    trade = (f"(SELECT accuracy, latency, string_agg({entry}, '; ' ORDER BY av DESC, name, version) AS parts FROM "
             "(SELECT *, (row_number() OVER (ORDER BY av DESC, name, version) - 1) // 100 AS block FROM trade) GROUP BY accuracy, latency, block) q")
    first5 = f"""(SELECT name, version, string_agg(metric || ': ' || {value}, ', ' ORDER BY metric) AS shown FROM
        mm GROUP BY ALL)"""
    history = f"""(SELECT m.name, string_agg({clause('history_entry', version='m.version', stage='m.stage', metrics="coalesce(s.shown, 'no metrics')")}, '; ' ORDER BY m.version) AS parts
        FROM mv m LEFT JOIN {first5} s ON m.name = s.name AND m.version = s.version GROUP BY m.name HAVING count(*) >= 2) q"""
    by_version = lambda test, joint, sep: f"(SELECT name, version, string_agg(metric || '{joint}' || {value}, '{sep}' ORDER BY metric) AS metrics FROM mm WHERE {test} GROUP BY ALL)"
    limit = (f"CASE kind WHEN 'variance' THEN {clause('limit_variance', metric='metric', value=value, pct=fixed('value * 100', 0))} "
             f"WHEN 'misses' THEN {clause('limit_misses', metric='metric', value=value)} ELSE {clause('limit_params', n='n_params')} END")
    limits = f"(SELECT name, version, string_agg({limit}, '; ' ORDER BY place, metric) AS limits FROM limits GROUP BY ALL) q"
    fit = lambda test: f"(SELECT string_agg({label} || ': ' || metrics, '; ' ORDER BY name, version) AS models FROM (SELECT *, (row_number() OVER (ORDER BY name, version) - 1) // 100 AS block FROM {by_version(test, '=', ', ')}) GROUP BY block) q"
    best = f"(SELECT string_agg({clause('best_entry', metric='metric', label=label, value=value)}, '; ' ORDER BY metric) FROM ranked WHERE rnk = 1)"
    shared_totals = {"n_versions": "n_versions", "n_metrics": "n_metrics"}
    return {
        "qa_model_info": [
            qa("describe", "full_mv", model="name", summary=summary),
            qa("metrics", "full_mv", "metrics IS NOT NULL", label=label, metrics="metrics", stage="stage"),
            qa("params", "full_mv", "params IS NOT NULL", label=label, params="params"),
            qa("stage", "full_mv", stage="stage", description=about, **model),
            qa("one_metric", "mm", metric="metric", value=value, **model)],
        "qa_model_comparison": [
            qa("ranking", ranking, metric="metric", direction="direction", ranking="ranking", best=clause("best_label", model="best.name", version="best.version"),
               best_value=metric("best.value")),
            qa("best_metric", first_two + " q", metric="metric", best=of("best"), best_value=metric("best.value"), second=of("second"), second_value=metric("second.value")),
            qa("pairwise", "duel", model_a="name_a", model_b="name_b", label_a=label_a, label_b=label_b, parts="parts",
               overall=f"CASE WHEN wins_a > wins_b THEN {label_a} WHEN wins_b > wins_a THEN {label_b} ELSE 'neither clearly' END")],
        "qa_recommendation": [
            qa("deploy", winner, label=label, wins="wins", n_metrics="n_metrics", led="array_to_string(led, '; ')", stage="stage", description=about),
            qa("best_model", winner, label=label, wins="wins", n_metrics="n_metrics", led="array_to_string(led, '; ')"),
            qa("fastest", "fast", label=label, metric="metric", value=value, alternative=opt(f"{other} <> {label}", clause("more_accurate", label=other))),
            qa("low_latency", "fast", label=label, metric="metric", value=value, stage="stage"),
            qa("max_accuracy", "best_acc", label=label, metric="metric", value=value, stage="stage"),
            qa("lowest_error", "best_err", label=label, metric="metric", value=value)],
        "qa_deployment": [
            qa("in_production", listed(label, "stage = 'Production'"), models="models"),
            qa("production_metrics", "full_mv", "stage = 'Production' AND metrics IS NOT NULL", metrics="metrics", **model),
            qa("how_many", "totals", n_models="n_models", n_versions="n_versions", stages=stage_list("")),
            qa("list_models", listed(clause("list_entry", model="name", version="version", stage="stage")), models="models")],
        "qa_trade_off": [
            qa("trade_off", trade, accuracy="accuracy", latency="latency", parts="parts"),
            qa("history", history, model="name", parts="parts"),
            qa("risk", "risk", metric="metric", value=value, **model)],
        "qa_overview": [
            qa("metrics_tracked", "totals", n_versions="n_versions", metrics="metrics"),
            qa("params_tracked", "totals", params="params"),
            qa("summary", "totals", n_models="n_models", n_versions="n_versions", stages=stage_list(" models"), n_metrics="n_metrics", n_params="n_params"),
            qa("comparable", "inv_list q", shared=clause("comparable_entry", metric="metric", labels="labels"))],
        "qa_reliability": [
            qa("reliability", by_version("is_lower AND NOT is_lat", ": ", "; ") + " q", metrics="metrics", **model),
            qa("confidence", by_version("is_acc", ": ", "; ") + " q", metrics="metrics", **model),
            qa("variability", "vary", metric="metric", best=of("best"), best_value=metric("best.value"), worst=of("worst"), worst_value=metric("worst.value")),
            qa("limitations", limits, limits="limits", **model)],
        "qa_registry_reproducibility": [
            qa("reproduce", "full_mv", "params IS NOT NULL", params="params",
               seed=f"CASE WHEN version % 3 = 0 THEN {lit(CLAUSES['seed_logged'])} ELSE {lit(CLAUSES['seed_missing'])} END", **model)],
        "qa_fitness": [
            qa("continuous", fit("is_lower AND metric <> 'inference_latency_ms'"), models="models"),
            qa("classification", fit("is_acc"), models="models"),
            qa("choose", "totals", best=best, **shared_totals),
            qa("trust", "totals", **shared_totals)],
    }


def registry_sql() -> dict[str, str]:
    head = say(PROMPTS["model_head"], index="i", model="name", version="version")
    texts = f"""(SELECT (i - 1) // BLOCK_SIZE AS block, string_agg(concat_ws(chr(10), {head}, {say(PROMPTS['model_stage'], stage='stage')},
        CASE WHEN description <> '' THEN {say(PROMPTS['model_description'], description='description')} END, 'Metrics:', mlist,
        CASE WHEN plist IS NOT NULL THEN 'Parameters:' END, plist, ''), chr(10) ORDER BY i) AS models FROM
        (SELECT m.*, row_number() OVER (ORDER BY name, version) AS i,
          (SELECT string_agg({say(PROMPTS['model_entry'], key='x.metric', value=fixed('x.value', 4))}, chr(10) ORDER BY x.metric) FROM mm x WHERE x.name = m.name AND x.version = m.version) AS mlist,
          (SELECT string_agg({say(PROMPTS['model_entry'], key='x.p', value='x.v')}, chr(10) ORDER BY x.p) FROM params x WHERE x.name = m.name AND x.version = m.version) AS plist
         FROM mv m) GROUP BY block)"""
    by_25 = texts.replace("BLOCK_SIZE", "25")
    block = "(SELECT models FROM " + texts.replace("BLOCK_SIZE", "10") + " WHERE block = 0)"
    task = "'Forecast demand in ' || n_name"
    criteria = say(PROMPTS["criteria"], criteria="'Region ' || n_regionkey")
    prompt = say(PROMPTS["recommendation"], task=task, models=block, criteria=f"CASE WHEN n_regionkey % 2 = 0 THEN {criteria} ELSE '' END")
    prompts = say(PROMPTS["recommendation"], task=task, models="models", criteria=f"CASE WHEN n_regionkey % 2 = 0 THEN {criteria} ELSE '' END")
    ops = "CASE t.op WHEN '>' THEN value > threshold WHEN '>=' THEN value >= threshold WHEN '<' THEN value < threshold ELSE value <= threshold END"
    sql = {
        "registry_models": """SELECT s_name AS name, CASE WHEN s_nationkey % 2 = 0 THEN 'Model of nation ' || s_nationkey ELSE '' END AS description
            FROM supplier WHERE s_name LIKE 'Supplier%1%' ORDER BY s_name LIMIT 10""",
        "exclude_models": """SELECT p_partkey AS id, p_name AS name, p_type FROM part WHERE p_name NOT IN ('cold widget', 'hot widget')
            AND NOT contains(lower(p_name), 'giz') AND NOT contains(lower(p_name), 'a.b')""",
        "versions_by_stage": BASE + "SELECT name, version, stage, description, run_id FROM ver WHERE stage IN ('Production', 'Staging')",
        "latest_versions": BASE + "SELECT name, version, stage, description, run_id FROM latest",
        "cap_versions": BASE + """SELECT name, version, stage, description, run_id FROM ver WHERE name IN (SELECT DISTINCT name FROM ver ORDER BY name LIMIT 20)
            QUALIFY row_number() OVER (PARTITION BY name ORDER BY version DESC) <= 3""",
        "attach_runs": REG + """SELECT m.name, m.version, m.stage, m.description, coalesce((SELECT count(*) FROM mm x WHERE x.name = m.name AND x.version = m.version), 0)::INT AS n_metrics,
            coalesce((SELECT count(*) FROM params x WHERE x.name = m.name AND x.version = m.version), 0)::INT AS n_params, s_nationkey::VARCHAR AS owner,
            CASE WHEN has_run THEN 't' || version ELSE 'none' END AS team, 2 AS n_tags FROM mv m""",
        "run_tags": BASE + """SELECT run_id, 'team' AS keys, CASE WHEN version % 2 = 1 THEN 'accuracy, f1' ELSE 'accuracy, inference_latency_ms' END AS first_metrics FROM ver WHERE version <> 7""",
        "rank_metrics": REG + "SELECT name, version, metric, direction, value, rnk AS rank, worst AS worst_rank, k AS n_models FROM ranked",
        "overall_winner": REG + "SELECT name, version, wins, n_metrics FROM winner",
        "fastest": REG + "SELECT metric, f.name, f.version, value, (SELECT name FROM acc1) AS accurate_name, (SELECT version FROM acc1) AS accurate_version FROM fast f",
        "metric_leaders": REG + """SELECT metric, k AS n_models, name, version, stage, value, 'accuracy' AS kind FROM best_acc
            UNION ALL SELECT metric, k, name, version, stage, value, 'error' FROM best_err""",
        "trade_off": REG + "SELECT name, version, accuracy, av AS accuracy_value, latency, lv AS latency_value FROM trade",
        "version_history": REG + """SELECT name, version, stage, (SELECT count(*) FROM mm x WHERE x.name = m.name AND x.version = m.version)::INT AS n_shown
            FROM mv m WHERE name IN (SELECT name FROM mv GROUP BY name HAVING count(*) >= 2)""",
        "production_risk": REG + "SELECT name, version, metric, value, direction FROM risk",
        "variability": REG + "SELECT metric, k AS n_models, best.name AS best, worst.name AS worst, best.value AS best_value, worst.value AS worst_value FROM vary",
        "metric_inventory": REG + "SELECT metric, k AS n_models FROM inv",
        "stage_counts": REG + "SELECT stage, n_versions, n_models FROM stages",
        "registry_totals": REG + "SELECT n_models, n_versions, n_metrics, n_params, metrics FROM totals",
        "limitations": REG + "SELECT name, version, kind, metric, value, n_params FROM limits",
        "acceptance": REG + f"""SELECT name, version, m.metric, value, op, threshold::DOUBLE AS threshold, CASE WHEN {ops} THEN 'PASS' ELSE 'FAIL' END AS result,
            CASE WHEN bool_and({ops}) OVER (PARTITION BY name, version) THEN 'PASS' ELSE 'FAIL' END AS overall FROM mm m
            JOIN (VALUES ('r2', '>', 0.8), ('rmse', '<', 0.05), ('inference_latency_ms', '<=', 40), ('f1', '>=', 0.95)) t(metric, op, threshold) ON m.metric = t.metric""",
        "version_wins": REG + """SELECT a.name, a.version, count(*) AS n_duels, count(*) FILTER (WHERE a.cost < b.cost) AS wins, count(*) FILTER (WHERE b.cost < a.cost) AS losses,
            count(*) FILTER (WHERE a.value = b.value) AS ties FROM mm a JOIN mm b ON a.metric = b.metric AND (a.name <> b.name OR a.version <> b.version) GROUP BY ALL""",
        "pareto_versions": REG + """, m4 AS (SELECT name, version, accuracy, inference_latency_ms, rmse, r2 FROM mv WHERE has_run)
            SELECT * FROM m4 a WHERE NOT EXISTS (SELECT 1 FROM m4 b WHERE b.accuracy >= a.accuracy AND b.inference_latency_ms <= a.inference_latency_ms AND b.rmse <= a.rmse
            AND b.r2 >= a.r2 AND (b.accuracy > a.accuracy OR b.inference_latency_ms < a.inference_latency_ms OR b.rmse < a.rmse OR b.r2 > a.r2))""",
        "models_blocks": REG + f"SELECT * FROM {by_25}",
        "recommendation_prompts": REG + f"SELECT {task} AS task, block, {prompts} AS prompt FROM nation, {by_25}",
        "models_block": REG + f"SELECT {block} AS models",
        "recommendation_prompt": REG + f"SELECT {task} AS task, {prompt} AS prompt FROM nation",
        "recommendation_record": REG + f"""SELECT {task} AS task, 'Use the first model for: ' || {task} AS recommendation, length({prompt})::INT AS prompt_chars,
            (SELECT least(10, count(*)) FROM mv)::INT AS n_models, (SELECT name FROM mv ORDER BY name, version LIMIT 1) AS first_model FROM nation""",
    }
    families = registry_qa_sql()
    sql |= {key: REG + union(parts) for key, parts in families.items()}
    sql["qa_model_comparison_neighbours"] = sql["qa_model_comparison"]
    sql["pairwise_neighbours"] = REG + "SELECT name_a, version_a, name_b, version_b, wins_a, wins_b, ties, n_shared FROM duel"
    sql["qa_registry_neighbours"] = REG + union(part for parts in families.values() for part in parts)
    every = {key: [part.replace(" FROM duel WHERE ", " FROM duel_all WHERE ") for part in parts] for key, parts in families.items()}
    sql["qa_model_comparison_all"] = EVERY + union(every["qa_model_comparison"])
    sql["qa_registry_all"] = EVERY + union(part for parts in every.values() for part in parts)
    sql["pairwise_all"] = EVERY + "SELECT name_a, version_a, name_b, version_b, wins_a, wins_b, ties, n_shared FROM duel_all"
    # Under their plain names these compare every two versions.
    sql |= {key: sql[f"{key}_all"] for key in ("qa_model_comparison", "qa_registry")} | {"pairwise_models": sql["pairwise_all"]}
    return sql


def evals_sql() -> dict[str, str]:
    scored = lambda model, train: f"""SELECT e.doc_id, '{model}' AS model, count(*) AS n_tokens, avg(-ln((coalesce(m.c, 0) + 1) / z.total)) AS loss
        FROM held e LEFT JOIN {train} m ON e.token = m.token, (SELECT (sum(c) + count(*) + 1)::DOUBLE AS total FROM {train}) z GROUP BY e.doc_id"""  # noqa: E731
    cte = f"""WITH d AS (SELECT doc_id, lang, substr(md5(doc_id::VARCHAR), 1, 15) < '400000000000000' AS is_val, {words('text')} AS w FROM documents),
        held AS (SELECT doc_id, unnest(w) AS token FROM d WHERE is_val),
        base AS (SELECT token, count(*) AS c FROM (SELECT unnest(w) AS token FROM d WHERE NOT is_val AND lang <> 'en') GROUP BY token),
        adapted AS (SELECT token, count(*) AS c FROM (SELECT unnest(w) AS token FROM d WHERE NOT is_val) GROUP BY token),
        losses AS ({scored('base', 'base')} UNION ALL {scored('adapted', 'adapted')}),
        scores AS (SELECT model, exp(sum(loss * n_tokens) / sum(n_tokens)) AS perplexity, sum(loss * n_tokens) / sum(n_tokens) AS avg_loss,
          stddev_pop(loss) AS std_loss, count(*) AS num_samples, sum(n_tokens)::BIGINT AS total_tokens FROM losses GROUP BY model)
        """
    return {
        "unigram_losses": cte + "SELECT doc_id, model, n_tokens, round(loss, 6) AS loss FROM losses",
        "perplexity": cte + "SELECT model, round(perplexity, 4) AS perplexity, round(avg_loss, 6) AS avg_loss, round(std_loss, 6) AS std_loss, num_samples, total_tokens FROM scores",
        "verdict": cte + """SELECT 'all' AS domain, round(b.perplexity, 4) AS base_perplexity, round(a.perplexity, 4) AS adapted_perplexity,
            round((b.perplexity - a.perplexity) / b.perplexity * 100, 4) AS improvement_pct,
            CASE WHEN (b.perplexity - a.perplexity) / b.perplexity * 100 > 15 THEN 'SUCCESS' WHEN (b.perplexity - a.perplexity) / b.perplexity * 100 > 5 THEN 'PARTIAL' ELSE 'MINIMAL' END AS verdict
            FROM scores b JOIN scores a ON b.model = 'base' AND a.model = 'adapted'""",
        "training_summary": """WITH l AS (SELECT o_orderpriority AS run, o_orderkey AS step, o_totalprice / 100000 AS tl, CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice / 200000 END AS el FROM orders)
            SELECT run, max(step) AS total_steps, round(arg_max(tl, step), 6) AS final_train_loss, round(min(tl), 6) AS best_train_loss,
            round(arg_max(el, step) FILTER (WHERE el IS NOT NULL), 6) AS final_eval_loss, round(min(el), 6) AS best_eval_loss,
            round(exp(arg_max(el, step) FILTER (WHERE el IS NOT NULL)), 6) AS eval_perplexity FROM l GROUP BY run""",
        "compare_responses": """SELECT conv_id::VARCHAR AS prompt, arg_min(text, turn) AS base_response, arg_max(text, turn) AS adapted_response
            FROM conversations WHERE role = 'assistant' GROUP BY conv_id""",
    }
