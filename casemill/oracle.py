"""DuckDB SQL for the registered queries."""

from __future__ import annotations

from casemill.cases import DEFINITIONS
from casemill.plans.selection import REVIEWED

# The roles of the driver's tables, as common table expressions.
BASE = """base AS (
    SELECT o_orderkey AS case_id, CAST(o_orderstatus = 'F' AS BIGINT) AS target, strftime(o_orderdate, '%Y-%m-%d') AS date_decision,
           CAST(floor(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) / 7) AS INTEGER) AS "WEEK_NUM",
           CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS "MONTH"
    FROM orders)"""
HISTORY = """history AS (
    SELECT l_orderkey AS case_id, CAST(l_linenumber AS BIGINT) AS num_group1, l_quantity AS quantity, l_extendedprice AS extendedprice, l_discount AS discount,
           strftime(l_shipdate, '%Y-%m-%d') AS "shipdate_1D", l_returnflag AS "returnflag_1M", l_linestatus AS "linestatus_1M"
    FROM lineitem)"""
EVENTS = """person AS (
    SELECT user_id AS case_id, event_id % 50 AS num_group1, event_id // 50 AS num_group2, value, event_type, strftime(ts, '%Y-%m-%d') AS "event_time_2D"
    FROM events)"""
STATIC = """static_0 AS (
    SELECT o_orderkey AS case_id, o_totalprice AS totalprice, o_orderpriority AS priority, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS acctbal,
           c_mktsegment AS mktsegment, c_nationkey AS nation
    FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 7 <> 0)"""
SPLIT = """weekly AS (
    SELECT "WEEK_NUM", count(*) AS row_count, CAST(sum(target) AS BIGINT) AS positive_cases, avg(target) AS default_rate, min(date_decision) AS min_date_decision, max(date_decision) AS max_date_decision
    FROM base GROUP BY 1),
profile AS (
    SELECT *, CAST(sum(row_count) OVER (ORDER BY "WEEK_NUM") AS BIGINT) AS cumulative_row_count,
           CAST(sum(row_count) OVER (ORDER BY "WEEK_NUM") AS DOUBLE) / CAST(sum(row_count) OVER () AS DOUBLE) AS cumulative_pct, row_number() OVER (ORDER BY "WEEK_NUM") AS k, count(*) OVER () AS weeks
    FROM weekly),
train_end AS (SELECT least(k, weeks - 2) AS a, weeks FROM profile ORDER BY abs(cumulative_pct - CAST(0.70 AS DOUBLE)), k LIMIT 1),
both_ends AS (
    SELECT a, greatest(a + 1, least((SELECT k FROM profile ORDER BY abs(cumulative_pct - (CAST(0.70 AS DOUBLE) + CAST(0.15 AS DOUBLE))), k LIMIT 1), weeks - 1)) AS b FROM train_end),
bounds AS (
    SELECT max(CASE WHEN k = a THEN "WEEK_NUM" END) AS train_end_week, max(CASE WHEN k = a + 1 THEN "WEEK_NUM" END) AS validation_start_week,
           max(CASE WHEN k = b THEN "WEEK_NUM" END) AS validation_end_week, max(CASE WHEN k = b + 1 THEN "WEEK_NUM" END) AS test_start_week
    FROM profile, both_ends),
split AS (
    SELECT case_id, CASE WHEN "WEEK_NUM" <= train_end_week THEN 'train' WHEN "WEEK_NUM" <= validation_end_week THEN 'validation' ELSE 'test' END AS split, "WEEK_NUM", date_decision, target
    FROM base, bounds)"""
SCORED = """scored AS (
    SELECT o_orderkey AS case_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y, round(1 / (1 + round(o_totalprice / 1000) * 1000 / 150000), 6) AS score FROM orders)"""
RANKED = """ranked AS (
    SELECT *, row_number() OVER w AS n, sum(y) OVER w AS cp, count(*) OVER () AS total, sum(y) OVER () AS pos FROM scored WINDOW w AS (ORDER BY score DESC, case_id ROWS UNBOUNDED PRECEDING))"""
DECILES = """deciled AS (SELECT *, ntile(10) OVER (ORDER BY score DESC, case_id) AS decile FROM scored),
parts AS (
    SELECT CAST(decile AS BIGINT) AS decile, count(*) AS "rows", CAST(sum(y) AS BIGINT) AS positive_cases, min(score) AS score_min, max(score) AS score_max FROM deciled GROUP BY 1),
upto AS (
    SELECT *, CAST(sum("rows") OVER (ORDER BY decile) AS BIGINT) AS cumulative_rows, CAST(sum(positive_cases) OVER (ORDER BY decile) AS BIGINT) AS cumulative_positives,
           sum("rows") OVER () AS total, sum(positive_cases) OVER () AS pos FROM parts),
deciles AS (
    SELECT decile, "rows", positive_cases, positive_cases / "rows" AS default_rate, score_min, score_max, cumulative_rows, cumulative_rows / total AS cumulative_row_pct, cumulative_positives,
           cumulative_positives / pos AS cumulative_positive_pct, positive_cases / "rows" / (pos / total) AS lift, cumulative_positives / cumulative_rows / (pos / total) AS cumulative_lift FROM upto)"""


def _number(table: str, c: str, summed: bool) -> list[tuple[str, str]]:
    steps = [("min", f'min("{c}")'), ("mean", f'avg("{c}")'), ("max", f'max("{c}")'), ("std", f'stddev_samp("{c}")')]
    return [(f"{table}__{c.lower()}__{s}", f"CAST({e} AS DOUBLE)") for s, e in steps + [("sum", f'sum("{c}")')] * summed]


def _date(table: str, c: str) -> list[tuple[str, str]]:
    gap = f"date_diff('day', CAST(\"{c}\" AS DATE), CAST(date_decision AS DATE))"
    return [(f"{table}__{c.lower()}__{s}_days_before_decision", f"CAST({f}({gap}) AS DOUBLE)") for s, f in (("min", "min"), ("mean", "avg"), ("max", "max"))]


def _distinct(table: str, c: str) -> list[tuple[str, str]]:
    return [(f"{table}__{c.lower()}__n_distinct", f'CAST(count(DISTINCT "{c}") AS DOUBLE)')]


def _count(table: str) -> list[tuple[str, str]]:
    return [(f"{table}__records__count", "CAST(count(*) AS DOUBLE)")]


APPLPREV = [
    *_count("applprev_1"), *_number("applprev_1", "quantity", True), *_number("applprev_1", "extendedprice", True), *_number("applprev_1", "discount", False), *_date("applprev_1", "shipdate_1D"),
    *_distinct("applprev_1", "returnflag_1M"), *_distinct("applprev_1", "linestatus_1M"),
]
PERSON = [*_count("person_2"), *_number("person_2", "value", True), *_distinct("person_2", "event_type"), *_date("person_2", "event_time_2D")]
STATIC_COLUMNS = [("totalprice", True), ("priority", False), ("acctbal", True), ("mktsegment", False), ("nation", False)]
COLUMNS = 'case_id, target, date_decision, "WEEK_NUM", "MONTH"'


def _grouped(name: str, source: str, features: list[tuple[str, str]], where: str = "") -> str:
    return f"{name} AS (SELECT case_id, {', '.join(f'{e} AS {n}' for n, e in features)} FROM {source} JOIN base USING (case_id) {where} GROUP BY case_id)"


def _round(x: str, places: int = 4) -> str:
    """With the push that all rounded numbers get."""
    return f"round({x} + 1e-{places + 5}, {places})"


def _rounded(features: list[tuple[str, str]], places: int = 4) -> str:
    return ", ".join(f"{_round(n, places)} AS {n}" for n, _ in features)


def _static(flag: str) -> str:
    return ", ".join(f"static_0.{c} AS static_0__{c}__direct" + (f", {flag.format(c=c)} AS static_0__{c}__is_missing" if f else "") for c, f in STATIC_COLUMNS)


MISSING = "CAST(static_0.{c} IS NULL AS INTEGER)"
IN_SOURCE = "CASE WHEN static_0.case_id IS NOT NULL THEN CAST(static_0.{c} IS NULL AS INTEGER) END"


def _layer(base: str = "base", flag: str = MISSING, static: str = "") -> str:
    static = static or ", ".join(f"{_round(f'static_0.{c}')} AS static_0__{c}__direct" if c in ("totalprice", "acctbal") else f"static_0.{c} AS static_0__{c}__direct" for c, _ in STATIC_COLUMNS)
    flags = ", ".join(f"{flag.format(c=c)} AS static_0__{c}__is_missing" for c, f in STATIC_COLUMNS if f)
    return (
        f"SELECT {COLUMNS}, {_rounded(APPLPREV)}, {_rounded(PERSON)}, {static}, {flags} "
        f"FROM {base} LEFT JOIN applprev USING (case_id) LEFT JOIN persons USING (case_id) LEFT JOIN static_0 USING (case_id)"
    )


def _with(*parts: str) -> str:
    return f"WITH {', '.join(parts)} "


GROUPS = (BASE, HISTORY, EVENTS, STATIC, _grouped("applprev", "history", APPLPREV), _grouped("persons", "person", PERSON))


def _profile_sql(name: str, depth: str, source: str, groups: int) -> str:
    grain = ", ".join(["case_id", "num_group1", "num_group2"][: groups + 1])
    group = lambda k, test, kind: (f"count(*) FILTER (WHERE num_group{k} {test})" if k <= groups else "CAST(NULL AS BIGINT)") + f" AS {kind}_num_group{k}_count"
    return f"""SELECT '{name}' AS table_name, '{depth}' AS logical_depth, round(count(DISTINCT case_id) / (SELECT count(DISTINCT case_id) FROM base) * 100, 6) AS base_case_coverage_pct,
        count(*) AS row_count, count(DISTINCT case_id) AS distinct_case_id_count, count(*) FILTER (WHERE case_id IS NULL) AS null_case_id_count,
        {", ".join(group(k, t, w) for k in (1, 2) for t, w in (("IS NULL", "null"), ("< 0", "negative")))},
        (SELECT count(DISTINCT case_id) FROM {source} WHERE case_id NOT IN (SELECT case_id FROM base)) AS orphan_case_id_count,
        (SELECT min(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY case_id)) AS min_rows_per_case,
        round((SELECT quantile_cont(n, 0.5) FROM (SELECT count(*) AS n FROM {source} GROUP BY case_id)), 6) AS median_rows_per_case,
        round((SELECT avg(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY case_id)), 6) AS mean_rows_per_case,
        round((SELECT quantile_cont(n, 0.95) FROM (SELECT count(*) AS n FROM {source} GROUP BY case_id)), 6) AS p95_rows_per_case,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM {source} GROUP BY case_id)) AS max_rows_per_case,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT {grain} FROM {source})) AS duplicate_key_count
    FROM {source}"""


def _check(name: str, status: str, table: str, message: str) -> str:
    return f"SELECT '{name}' AS check_name, {status} AS status, '{table}' AS table_name, {message} AS message"


def _checks() -> str:
    """The rules of all tables; the base comes twice, as itself and among the tables."""
    fail = lambda n: f"CASE WHEN {n} > 0 THEN 'FAIL' ELSE 'PASS' END"
    warn = lambda n: f"CASE WHEN {n} > 0 THEN 'WARNING' ELSE 'PASS' END"
    others = "(SELECT count(*) FROM base WHERE target NOT IN (0, 1))"
    out = [_check("target_validity", fail(others), "base", f"'0 null, ' || {others} || ' neither 0 nor 1'"), _check("row_preservation", "'PASS'", "base", "(SELECT count(*) FROM base) || ' raw, ' || (SELECT count(*) FROM base) || ' staged'").replace("'row_preservation'", "'source_to_staging_row_preservation'")]
    tables = [("base", "base", "case_id"), ("base", "base", "case_id"), ("static_0", "static_0", "case_id"), ("applprev_1", "history", "case_id, num_group1"), ("person_2", "person", "case_id, num_group1, num_group2")]
    for i, (name, source, grain) in enumerate(tables):
        nulls = f"(SELECT count(*) FROM {source} WHERE case_id IS NULL)"
        twins = f"(SELECT (SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT {grain} FROM {source})))"
        orphans = f"(SELECT count(DISTINCT case_id) FROM {source} WHERE case_id NOT IN (SELECT case_id FROM base))"
        negative = [f"(SELECT count(*) FROM {source} WHERE {g} < 0)" if g in grain else "0" for g in ("num_group1", "num_group2")]
        out += [_check("required_columns", "'PASS'", name, "'all there'"), _check("null_keys", fail(nulls), name, f"{nulls} || ' rows without case_id'"), _check("duplicate_expected_grain", warn(twins), name, f"{twins} || ' duplicates by {grain}'")]
        if i:
            out += [_check("orphan_case_ids", fail(orphans), name, f"{orphans} || ' cases not in base'"), _check("group_identifier_validity", fail(f"{negative[0]} + {negative[1]}"), name, f"{negative[0]} || ' and ' || {negative[1]} || ' negative'")]
    return " UNION ALL ".join(out)


def _values(rows, names: str) -> str:
    text = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"(VALUES {', '.join('(' + ', '.join(map(text, r)) + ')' for r in rows)}) AS v({names})"


TABLE_COLUMNS = [
    *(("base", c, t) for c, t in (("case_id", "bigint"), ("target", "bigint"), ("date_decision", "string"), ("WEEK_NUM", "int"), ("MONTH", "int"))),
    *(("static_0", c, t) for c, t in (("case_id", "bigint"), ("totalprice", "double"), ("priority", "string"), ("acctbal", "double"), ("mktsegment", "string"), ("nation", "int"))),
    *(("applprev_1", c, t) for c, t in (("case_id", "bigint"), ("num_group1", "bigint"), ("quantity", "double"), ("extendedprice", "double"), ("discount", "double"), ("shipdate_1D", "string"), ("returnflag_1M", "string"), ("linestatus_1M", "string"))),
    *(("person_2", c, t) for c, t in (("case_id", "bigint"), ("num_group1", "bigint"), ("num_group2", "bigint"), ("value", "double"), ("event_type", "string"), ("event_time_2D", "string"))),
]
CATEGORY = """CASE WHEN regexp_matches(t, 'payment|installment|paid|dpd|past due') THEN 'payment' WHEN regexp_matches(t, 'amount|annuity|income|price|payment|paid|debt') THEN 'amount' WHEN regexp_matches(t, 'date|days|dpd|past due|month|week') THEN 'date/days'
                WHEN regexp_matches(t, 'status|type|category|role|education|marital') THEN 'categorical status' WHEN regexp_matches(t, 'number of|count|times') THEN 'count'
                WHEN regexp_matches(t, 'person|birth|employment|address|district|gender') THEN 'demographic' WHEN regexp_matches(t, 'application|applicant|request|decision') THEN 'application'
                WHEN regexp_matches(t, 'credit bureau|bureau|contract|loan|debt') THEN 'bureau/credit history' WHEN regexp_matches(t, 'collateral|property|real estate') THEN 'collateral/property'
                WHEN regexp_matches(t, 'tax|registry|deduction') THEN 'tax/registry' ELSE 'ambiguous' END"""
CATALOG = f"""defined AS (SELECT * FROM {_values(sorted(DEFINITIONS.items()), 'column_name, description')}),
    known AS (SELECT * FROM {_values(TABLE_COLUMNS, 'logical_table, column_name, data_type')}),
    described AS (SELECT known.*, description, lower(coalesce(description, '')) AS t, column_name IN ('case_id', 'num_group1', 'num_group2') AS k, column_name = 'target' AS o, column_name IN ('WEEK_NUM', 'MONTH', 'date_decision') AS m FROM known LEFT JOIN defined USING (column_name)),
    catalog AS (
        SELECT logical_table, column_name, description, data_type, CASE right(logical_table, 2) WHEN '_0' THEN 'depth 0' WHEN '_1' THEN 'depth 1' WHEN '_2' THEN 'depth 2' ELSE 'base' END AS table_depth,
               k AS is_key_or_grouping_field, o AS is_target, m AS is_metadata_field, CASE WHEN k THEN 'key/grouping' WHEN o THEN 'target' WHEN column_name = 'date_decision' THEN 'date/days' WHEN m THEN 'time index' ELSE {CATEGORY} END AS semantic_category,
               CASE WHEN right(logical_table, 2) IN ('_1', '_2') THEN 'repeated/history-based' ELSE 'static' END AS static_or_repeated,
               CASE WHEN k THEN 'key/grouping' WHEN o THEN 'target' WHEN m THEN 'metadata/time' WHEN description IS NULL THEN 'candidate predictor; meaning ambiguous' ELSE 'candidate predictor' END AS modeling_role,
               o OR (description IS NOT NULL AND regexp_matches(lower(column_name || ' ' || description), 'target|default|decision|approval')) AS leakage_candidate FROM described)"""
REGISTRY = """steps AS (SELECT * FROM (VALUES ('direct'), ('is_missing'), ('min'), ('mean'), ('max'), ('std'), ('sum'), ('n_distinct'), ('min_days_before_decision'), ('mean_days_before_decision'), ('max_days_before_decision')) AS v(s)),
    made AS (
        SELECT DISTINCT logical_table, 'records' AS part, 'case_id' AS source_columns, 'count' AS s, '' AS category FROM catalog WHERE static_or_repeated <> 'static'
        UNION ALL SELECT logical_table, column_name, column_name, s, semantic_category FROM catalog, steps WHERE logical_table <> 'base' AND NOT is_key_or_grouping_field AND CASE
            WHEN table_depth = 'depth 0' THEN s = 'direct' OR (s = 'is_missing' AND semantic_category IN ('amount', 'date/days', 'payment'))
            WHEN data_type IN ('double', 'int', 'bigint') THEN s IN ('min', 'mean', 'max', 'std') OR (s = 'sum' AND semantic_category IN ('amount', 'payment', 'count'))
            WHEN semantic_category = 'date/days' THEN s LIKE '%days_before_decision' ELSE s = 'n_distinct' END),
    registry AS (
        SELECT logical_table || '__' || lower(part) || '__' || s AS feature_name, CASE logical_table WHEN 'static_0' THEN 'static applicant/bureau snapshots' WHEN 'applprev_1' THEN 'previous applications' ELSE 'person/participant histories' END AS feature_family,
               logical_table AS source_table, source_columns, s AS transformation, category FROM made)"""


def _decisions() -> str:
    """The registry with a decision for each feature, by what its values are in the whole layer."""
    names = [n for n, _ in APPLPREV + PERSON] + [f"static_0__{c}__{k}" for c, f in STATIC_COLUMNS for k in ("direct", "is_missing") if f or k == "direct"]
    one = lambda n: f"SELECT '{n}' AS feature_name, count({n}) AS n, count(DISTINCT {n}) AS d, (SELECT max(c) FROM (SELECT count(*) AS c FROM layer WHERE {n} IS NOT NULL GROUP BY {n})) AS top FROM layer"
    return f"""layer AS ({_layer()}), stats AS ({' UNION ALL '.join(map(one, names))}),
    judged AS (
        SELECT registry.*, CASE WHEN n IS NULL THEN 'Absent from the sample.' WHEN category = 'ambiguous' THEN 'Meaning ambiguous.' WHEN n > 0 AND n < 10 AND transformation IN ('direct', 'is_missing') THEN 'Very sparse in the sample.'
            WHEN n > 0 AND d <= 1 AND transformation IN ('direct', 'is_missing', 'n_distinct') THEN 'Constant in the sample.' WHEN n > 0 AND top / n >= 0.995 AND transformation IN ('direct', 'is_missing', 'n_distinct') THEN 'Nearly constant in the sample.' ELSE 'Supported lineage.' END AS reason
        FROM registry LEFT JOIN stats USING (feature_name)),
    decisions AS (SELECT *, CASE reason WHEN 'Absent from the sample.' THEN 'exclude' WHEN 'Supported lineage.' THEN 'keep' ELSE 'review_later' END AS decision FROM judged)"""


def _newton(steps: int = 20) -> str:
    """Newton steps for intercept a and slope b, each a row of its own."""
    out = ["i0 AS (SELECT CAST(0 AS DOUBLE) AS a, CAST(1 AS DOUBLE) AS b)"]
    for k in range(steps):
        sums = f"SELECT a, b, sum(y - n * p) AS g, sum((y - n * p) * x) AS gx, sum(n * p * (1 - p)) AS h, sum(n * p * (1 - p) * x) AS hx, sum(n * p * (1 - p) * x * x) AS hxx FROM (SELECT a, b, x, y, n, 1 / (1 + exp(-(a + b * x))) AS p FROM points, i{k}) GROUP BY a, b"
        out.append(f"i{k + 1} AS (SELECT a + (hxx * g - hx * gx) / (h * hxx - hx * hx) AS a, b + (h * gx - hx * g) / (h * hxx - hx * hx) AS b FROM ({sums}))")
    return ", ".join(out)


IDEAS = {"payment": "how late and how complete payments are", "date/days": "time since and between dates", "amount": "sums and shares of amounts", "bureau/credit history": "obligations open and settled", "demographic": "who takes part in the case"}
SELECTED = [
    ("static_0__acctbal__direct", "keep"), ("static_0__acctbal__is_missing", "keep"), ("static_0__eir_270l__direct", "keep"), ("static_0__isdebitcard_729l__direct", "review_later"), ("static_0__mktsegment__direct", "keep"),
    ("static_0__nation__direct", "keep"), ("static_0__priority__direct", "keep"), ("static_0__totalprice__direct", "keep"), ("static_0__totalprice__is_missing", "keep"), ("static_0__workplace_1m__direct", "exclude"),
]


def _planned() -> dict[str, str]:
    """Of catalogs, registries, selections and runs."""
    listed = lambda test: f"coalesce(string_agg(column_name, ',' ORDER BY column_name) FILTER (WHERE {test}), '')"
    sizes = "SELECT 'base' AS logical_table, 'base' AS logical_family, count(*) AS n FROM base UNION ALL SELECT 'static_0', 'static', count(*) FROM static_0 UNION ALL SELECT 'applprev_1', 'previous_application', count(*) FROM history UNION ALL SELECT 'person_2', 'person', count(*) FROM person"
    kept = [f"{_round(f'static_0.{c}')} AS static_0__{c}__direct, {IN_SOURCE.format(c=c).replace('AS INTEGER', 'AS BIGINT')} AS static_0__{c}__is_missing" for c in ("acctbal", "totalprice")]
    modeling = ", m AS (SELECT case_id, totalprice, acctbal, CAST(nation AS DOUBLE) AS nation, acctbal > 5000 AS rich FROM base LEFT JOIN static_0 USING (case_id)), s AS (SELECT avg(totalprice) AS a, stddev_pop(totalprice) AS b, avg(acctbal) AS c, stddev_pop(acctbal) AS d, avg(nation) AS e, stddev_pop(nation) AS f FROM m) "
    return {
        "catalog_columns": _with(CATALOG) + "SELECT *, CASE WHEN semantic_category = 'ambiguous' THEN 'Meaning ambiguous from supplied definition.' ELSE '' END AS notes FROM catalog",
        "table_summaries": _with(BASE, HISTORY, EVENTS, STATIC, CATALOG) + f""", sizes AS ({sizes}), ideas AS (
            SELECT logical_table, idea FROM catalog JOIN {_values(IDEAS.items(), 'semantic_category, idea')} USING (semantic_category) UNION SELECT logical_table, CASE WHEN static_or_repeated = 'static' THEN 'values as they are and whether they are missing' ELSE 'numbers of rows, extremes and means by case' END FROM catalog),
            said AS (SELECT logical_table, string_agg(idea, '; ' ORDER BY idea) AS feature_ideas FROM ideas GROUP BY 1)
            SELECT logical_table, logical_family, table_depth, static_or_repeated, n AS row_count, count(*) AS column_count, {listed('is_key_or_grouping_field')} AS grain_columns, {listed('is_key_or_grouping_field OR is_target OR is_metadata_field')} AS key_columns,
                   {listed("modeling_role LIKE 'candidate%'")} AS predictor_columns, {listed("semantic_category = 'ambiguous'")} AS unclear_columns, {listed('leakage_candidate')} AS leakage_columns, feature_ideas
            FROM catalog JOIN sizes USING (logical_table) JOIN said USING (logical_table) GROUP BY ALL""",
        "definition_coverage": _with(CATALOG) + """, c AS (SELECT DISTINCT column_name FROM known), lacking AS (SELECT column_name FROM c EXCEPT SELECT column_name FROM defined), unused AS (SELECT column_name FROM defined EXCEPT SELECT column_name FROM c)
            SELECT column_name AS value, 'columns_without_descriptions' AS kind FROM lacking UNION ALL SELECT column_name, 'definitions_not_in_training_tables' FROM unused UNION ALL SELECT CAST(count(*) AS VARCHAR), 'definition_count' FROM defined
            UNION ALL SELECT CAST(count(*) AS VARCHAR), 'source_column_count' FROM c UNION ALL SELECT CAST(count(*) AS VARCHAR), 'represented_source_column_count' FROM c JOIN defined USING (column_name)
            UNION ALL SELECT CAST(count(*) AS VARCHAR), 'missing_description_count' FROM lacking UNION ALL SELECT CAST(count(*) AS VARCHAR), 'unused_definition_count' FROM unused""",
        "definitions_file": f"SELECT * FROM {_values(sorted(DEFINITIONS.items()), 'name, description')}",
        "feature_registry": _with(CATALOG, REGISTRY) + "SELECT feature_name, feature_family, source_table, source_columns, transformation FROM registry",
        "registry_family_counts": _with(CATALOG, REGISTRY) + "SELECT feature_family, count(*) AS features FROM registry GROUP BY 1",
        "feature_selection": _with(*GROUPS, CATALOG, REGISTRY, _decisions()) + "SELECT feature_name, feature_family, source_table, transformation, decision, reason, 'reviewed' AS leakage_status FROM decisions",
        "selection_counts": _with(*GROUPS, CATALOG, REGISTRY, _decisions()) + "SELECT feature_family, decision, count(*) AS features FROM decisions GROUP BY 1, 2",
        "selection_manifest": f"SELECT * FROM {_values(SELECTED, 'feature_name, decision')}",
        "modeling_frame": _with(BASE, STATIC) + f"SELECT {COLUMNS}, {', '.join(kept)}, {_round('static_0.totalprice / 4')} AS static_0__eir_270l__direct, mktsegment AS static_0__mktsegment__direct, CAST(nation AS BIGINT) AS static_0__nation__direct, priority AS static_0__priority__direct FROM base LEFT JOIN static_0 USING (case_id)",
        "reviewed_columns": f"SELECT * FROM {_values(REVIEWED, 'source_table, source_column, decision')}",
        "export_validation": "SELECT f AS file, e AS exported, CASE WHEN e THEN (SELECT count(*) FROM orders) END AS \"rows\", e AS ok FROM (VALUES ('base_labels', true), ('static_features', true), ('previous_application_features', false), ('person_features', false)) AS v(f, e)",
        "store_validation": "SELECT 'applprev_1' AS table_name, true AS loaded, count(*) AS source_rows, count(*) AS loaded_rows, true AS ok FROM lineitem UNION ALL SELECT 'base', true, count(*), count(*), true FROM orders UNION ALL SELECT 'static_0', false, NULL, NULL, false",
        "predictor_kinds": f"SELECT * FROM {_values([('totalprice', 'numeric'), ('acctbal', 'numeric'), ('nation', 'numeric'), ('priority', 'categorical'), ('mktsegment', 'categorical'), ('rich', 'boolean')], 'predictor, kind')}",
        "hashed_design": _with(BASE, STATIC) + modeling + f"""SELECT case_id, 4100 AS size, {_round('(coalesce(totalprice, a) - a) / b + (coalesce(acctbal, c) - c) / d + (coalesce(nation, e) - e) / f', 5)} AS numbers,
            {_round('coalesce(CAST(rich AS DOUBLE), -1.0)', 5)} AS booleans, {_round('2.0', 5)} AS hashed FROM m, s""",
        "calibration": _with(SCORED) + f", points AS (SELECT ln(score / (1 - score)) AS x, sum(y) AS y, count(*) AS n FROM scored GROUP BY 1), {_newton()} SELECT round(a, 6) AS intercept, round(b, 6) AS slope FROM i20",
        "baseline_artifacts": _with(BASE, SPLIT) + "SELECT split, count(*) AS \"rows\", CAST(sum(target) AS BIGINT) AS positive_cases, 10 AS deciles, CAST(sum(target) AS BIGINT) AS decile_positives, true AS auc_in_range, count(*) AS scores FROM split GROUP BY 1",
        "model_registry": _with(BASE, SPLIT) + "SELECT m AS model, m = 'first' AS official, (SELECT min(\"WEEK_NUM\") FROM split WHERE split = 'test') AS test_week_start, (SELECT max(\"WEEK_NUM\") FROM split WHERE split = 'test') AS test_week_end FROM (VALUES ('first'), ('second')) AS v(m)",
        "training_throughput": _with(BASE, SPLIT) + "SELECT least(count(*), 1000) AS \"rows\", 6 AS predictors, true AS go FROM split WHERE split = 'train'",
    }


def oracle_sql() -> dict[str, str]:
    out = {
        "quality_checks": _with(BASE, HISTORY, EVENTS, STATIC) + _checks(),
        "quality_summary": _with(BASE, HISTORY, EVENTS, STATIC) + f"SELECT s AS status, (SELECT count(*) FROM ({_checks()}) WHERE status = s) AS checks FROM (VALUES ('PASS'), ('WARNING'), ('FAIL')) AS v(s)",
        "family_export": "SELECT f AS family, (SELECT count(*) FROM orders) AS row_count, c AS column_count, 'success' AS completion_status FROM (VALUES ('base_labels', 5), ('static_features', 8), ('previous_application_features', 21), ('person_features', 11)) AS v(f, c)",
        "file_inventory": _with(STATIC) + """SELECT 'train_base.parquet' AS file_name, (SELECT count(*) FROM orders) AS row_count, 5 AS column_count, 'base' AS logical_family, CAST(NULL AS BIGINT) AS depth, 'case_id,target,date_decision,WEEK_NUM,MONTH' AS key_columns
            UNION ALL SELECT 'train_applprev_1_0.parquet', (SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 0), 8, 'previous_application', 1, 'case_id,num_group1'
            UNION ALL SELECT 'train_applprev_1_1.parquet', (SELECT count(*) FROM lineitem WHERE l_orderkey % 2 = 1), 8, 'previous_application', 1, 'case_id,num_group1'
            UNION ALL SELECT 'train_static_0_0.parquet', (SELECT count(*) FROM static_0), 6, 'static', 0, 'case_id'""",
        "evaluation": _with(SCORED, RANKED, DECILES) + """, g AS (SELECT score, sum(y) AS p, count(*) AS n FROM scored GROUP BY 1),
            r AS (SELECT p, n, coalesce(sum(n - p) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS up FROM g),
            one AS (SELECT sum(p * (below + (n - p) / 2.0)) / sum(p) / sum(n - p) AS auc, sum(p * tp / up) / sum(p) AS ap FROM r)
            SELECT (SELECT count(*) FROM scored) AS "rows", (SELECT CAST(sum(y) AS BIGINT) FROM scored) AS positive_cases, (SELECT round(avg(y), 9) FROM scored) AS positive_rate, round(auc, 9) AS roc_auc, round(ap, 9) AS pr_auc,
                   (SELECT round(max(abs(cp / pos - (n - cp) / (total - pos))), 9) FROM ranked) AS ks, (SELECT round(avg((score - y) * (score - y)), 9) FROM scored) AS brier_score, (SELECT round(lift, 9) FROM deciles WHERE decile = 1) AS top_decile_lift FROM one""",
        "history_features": _with(*GROUPS) + f"SELECT {COLUMNS}, {_rounded(APPLPREV)} FROM base LEFT JOIN applprev USING (case_id)",
        "event_features": _with(*GROUPS) + f"SELECT {COLUMNS}, {_rounded(PERSON)} FROM base LEFT JOIN persons USING (case_id)",
        "static_features": _with(BASE, STATIC) + f"SELECT {COLUMNS}, {_static(MISSING)} FROM base LEFT JOIN static_0 USING (case_id)",
        "static_features_in_source": _with(BASE, STATIC) + f"SELECT {COLUMNS}, {_static(IN_SOURCE)} FROM base LEFT JOIN static_0 USING (case_id)",
        "feature_layer": _with(*GROUPS) + _layer(),
        "feature_layer_smoke": _with(*GROUPS) + _layer("(SELECT * FROM base ORDER BY case_id LIMIT 100)"),
        "family_join": _with(*GROUPS) + _layer(flag="CAST(" + IN_SOURCE + " AS BIGINT)", static=", ".join(
            f"{_round(f'static_0.{c}')} AS static_0__{c}__direct" if c in ("totalprice", "acctbal") else f"CAST(static_0.{c} AS BIGINT) AS static_0__{c}__direct" if c == "nation" else f"static_0.{c} AS static_0__{c}__direct" for c, _ in STATIC_COLUMNS)),
        "base_projection": _with(BASE) + f"SELECT {COLUMNS} FROM base ORDER BY case_id LIMIT 1000",
        "static_one_per_case": _with(HISTORY) + "SELECT case_id, num_group1, quantity FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY num_group1, quantity) AS n FROM history) WHERE n = 1",
        "distinct_values_as_sets": _with(HISTORY) + 'SELECT case_id, CAST(count(DISTINCT "linestatus_1M") AS DOUBLE) AS applprev_1__linestatus_1m__n_distinct, CAST(count(DISTINCT "returnflag_1M") AS DOUBLE) AS applprev_1__returnflag_1m__n_distinct FROM history GROUP BY 1',
        "history_rows_of_base": _with(BASE, EVENTS) + 'SELECT case_id, num_group1, num_group2, date_decision, "event_time_2D" FROM person JOIN base USING (case_id)',
        "days_before_decision": _with(BASE, HISTORY) + "SELECT case_id, num_group1, date_diff('day', CAST(\"shipdate_1D\" AS DATE), CAST(date_decision AS DATE)) AS days FROM history JOIN base USING (case_id)",
        "feature_stats": " UNION ALL ".join(
            f"SELECT '{c}' AS feature_name, CAST(sum(n) AS BIGINT) AS non_null_count, count(*) AS distinct_count, max(n) AS max_value_count FROM (SELECT {c}, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)" for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
        ),
        "sample_values": " UNION ALL ".join(f"SELECT '{c}' AS column_name, c_custkey_rank AS place, CAST({c} AS VARCHAR) AS value FROM (SELECT *, row_number() OVER (ORDER BY c_custkey) - 1 AS c_custkey_rank FROM customer) WHERE c_custkey_rank < 5" for c in ("c_custkey", "c_name", "c_mktsegment")),
        "logical_tables": "SELECT 'applprev_1' AS table_name, 2 AS files, 8 AS columns, (SELECT count(*) FROM lineitem) AS row_count UNION ALL SELECT 'base', 1, 5, (SELECT count(*) FROM orders) UNION ALL SELECT 'static_0', 1, 6, (SELECT count(*) FROM orders WHERE o_custkey % 7 <> 0 AND o_custkey IN (SELECT c_custkey FROM customer))",
        "ingested_history": _with(HISTORY) + 'SELECT case_id, num_group1, quantity, extendedprice, discount, "shipdate_1D", nullif("returnflag_1M", \'N\') AS "returnflag_1M", "linestatus_1M" FROM history',
        "staged_base": _with(BASE) + f"SELECT {COLUMNS} FROM base",
        "arrived_files": _with(BASE) + f"SELECT {COLUMNS} FROM base",
        "blank_texts": "SELECT p_partkey, CASE WHEN p_size % 3 > 0 THEN p_brand END AS p_brand FROM part",
        "table_names": "SELECT p_partkey, trim(regexp_replace(lower(p_brand || '--' || p_type || '!'), '[^0-9a-z]+', '_', 'g'), '_') AS part, 'credit_bureau_a_2' AS logical FROM part",
        "base_profile": _with(BASE) + """SELECT count(*) AS row_count, count(DISTINCT case_id) AS total_cases, count(*) FILTER (WHERE case_id IS NULL) AS null_case_id_count, count(*) FILTER (WHERE target IS NULL) AS target_null_count,
            count(*) FILTER (WHERE target = 0) AS target_0_count, count(*) FILTER (WHERE target = 1) AS target_1_count, count(*) FILTER (WHERE target NOT IN (0, 1)) AS target_other_count,
            min(date_decision) AS date_decision_min, max(date_decision) AS date_decision_max, min("WEEK_NUM") AS week_num_min, max("WEEK_NUM") AS week_num_max, count(DISTINCT "WEEK_NUM") AS week_num_cardinality,
            min("MONTH") AS month_min, max("MONTH") AS month_max, count(DISTINCT "MONTH") AS month_cardinality, count(*) - count(DISTINCT case_id) AS duplicate_case_id_count,
            round(count(*) FILTER (WHERE target = 1) / count(*) FILTER (WHERE target IN (0, 1)), 6) AS default_rate, count(*) = count(DISTINCT case_id) AS case_id_unique FROM base""",
        "rows_per_case": _with(HISTORY) + "SELECT case_id, count(*) AS rows_per_case FROM history GROUP BY 1",
        "row_distribution": _with(HISTORY) + "SELECT min(n) AS min_rows_per_case, round(quantile_cont(n, 0.5), 6) AS median_rows_per_case, round(avg(n), 6) AS mean_rows_per_case, round(quantile_cont(n, 0.95), 6) AS p95_rows_per_case, max(n) AS max_rows_per_case FROM (SELECT count(*) AS n FROM history GROUP BY case_id)",
        "relationship_profiles": _with(BASE, HISTORY, EVENTS, STATIC) + " UNION ALL ".join([_profile_sql("static_0", "depth 0", "static_0", 0), _profile_sql("applprev_1", "depth 1", "history", 1), _profile_sql("person_2", "depth 2", "person", 2)]),
        "orphan_cases": "SELECT DISTINCT user_id AS case_id FROM events WHERE user_id NOT IN (SELECT o_orderkey FROM orders)",
        "cases_without_history": "SELECT o_orderkey AS case_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
        "duplicate_grain": "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicate_key_count FROM lineitem",
        "negative_groups": "SELECT count(*) FILTER (WHERE c_acctbal >= 9000) AS nulls, count(*) FILTER (WHERE c_acctbal < 0) AS negatives, count(*) FILTER (WHERE c_acctbal < 9000 AND c_nationkey NOT IN (0, 1)) AS others FROM customer",
        "weekly_profile": _with(BASE, SPLIT) + 'SELECT "WEEK_NUM", row_count, positive_cases, round(default_rate, 9) AS default_rate, min_date_decision, max_date_decision, cumulative_row_count, round(cumulative_pct, 9) AS cumulative_pct FROM profile',
        "week_boundaries": _with(BASE, SPLIT) + "SELECT * FROM bounds",
        "split_labels": _with(BASE, SPLIT) + "SELECT * FROM split",
        "split_diagnostics": _with(BASE, SPLIT) + """SELECT split, count(*) AS "rows", CAST(sum(target) AS BIGINT) AS positive_cases, round(avg(target), 9) AS default_rate, min(date_decision) AS date_start, max(date_decision) AS date_end,
            min("WEEK_NUM") AS week_start, max("WEEK_NUM") AS week_end, count(DISTINCT case_id) AS unique_case_ids, round(count(*) / (SELECT count(*) FROM split), 9) AS row_pct FROM split GROUP BY 1""",
        "split_validation": _with(BASE, SPLIT) + "SELECT count(*) AS assigned_rows, count(DISTINCT case_id) AS unique_case_ids, count(*) = count(DISTINCT case_id) AS every_case_assigned_once, count(*) - count(DISTINCT case_id) AS duplicate_case_id_count, 0 AS overlapping_weeks, true AS no_overlapping_weeks, true AS chronological_ordering FROM split",
        "target_drift": _with(BASE, SPLIT) + """, rates AS (SELECT avg(target) FILTER (WHERE split = 'train') AS a, avg(target) FILTER (WHERE split = 'validation') AS b, avg(target) FILTER (WHERE split = 'test') AS c FROM split)
            SELECT round(abs(b - a), 9) AS train_validation_abs_diff, round(abs(c - a), 9) AS train_test_abs_diff, round(abs(c - b), 9) AS validation_test_abs_diff, round(greatest(abs(b - a), abs(c - a), abs(c - b)), 9) AS max_abs_diff, greatest(abs(b - a), abs(c - a), abs(c - b)) >= 0.02 AS material_shift FROM rates""".replace(", rates", "", 0),
        "split_overlaps": """WITH s AS (SELECT l_orderkey AS case_id, CASE WHEN l_linenumber < 3 THEN 'train' WHEN l_linenumber < 5 THEN 'validation' ELSE 'test' END AS split FROM lineitem),
            f AS (SELECT case_id, bool_or(split = 'train') AS a, bool_or(split = 'validation') AS b, bool_or(split = 'test') AS c FROM s GROUP BY 1)
            SELECT count(*) FILTER (WHERE a AND b) AS train_validation, count(*) FILTER (WHERE a AND c) AS train_test, count(*) FILTER (WHERE b AND c) AS validation_test FROM f""",
        "split_scan": _with(BASE, SPLIT) + "SELECT case_id, target, date_decision FROM split WHERE split = 'validation'",
        "limited_split_scan": _with(BASE, SPLIT) + "SELECT case_id, target, \"MONTH\" FROM base WHERE case_id IN (SELECT case_id FROM split WHERE split = 'train') ORDER BY \"WEEK_NUM\", case_id LIMIT 500",
        "split_row_counts": _with(BASE, SPLIT) + 'SELECT split, least(count(*), 1000) AS "rows" FROM split GROUP BY 1',
        "target_values": _with(BASE) + "SELECT DISTINCT target FROM base",
        "numeric_stats": _with(BASE, STATIC, SPLIT) + ", m AS (SELECT totalprice, acctbal, nation FROM split LEFT JOIN static_0 USING (case_id) WHERE split = 'train') " + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS scale FROM m" for c in ("totalprice", "acctbal", "nation")),
        "standardised": _with(BASE, STATIC) + """, m AS (SELECT case_id, totalprice, acctbal FROM base LEFT JOIN static_0 USING (case_id)), s AS (SELECT avg(totalprice) AS a, stddev_pop(totalprice) AS b, avg(acctbal) AS c, stddev_pop(acctbal) AS d FROM m)
            SELECT case_id, round((coalesce(totalprice, a) - a) / b, 5) AS totalprice, round((coalesce(acctbal, c) - c) / d, 5) AS acctbal FROM m, s""",
        "booleans_and_tokens": _with(BASE, STATIC) + "SELECT case_id, coalesce(CAST(acctbal > 5000 AS DOUBLE), -1.0) AS rich, 'mktsegment=' || coalesce(mktsegment, '__MISSING__') AS mktsegment, CAST(acctbal IS NULL AS BIGINT) AS no_balance FROM base LEFT JOIN static_0 USING (case_id)",
        "class_weights": _with(BASE) + "SELECT target, round((SELECT count(*) FROM base) / (2 * count(*)), 9) AS weight FROM base GROUP BY 1",
        "baseline_inputs": "SELECT '0,1' AS target_values, 6 AS predictors, true AS labels_excluded, true AS no_overlap",
        "roc_auc": _with(SCORED) + """, g AS (SELECT score, sum(y) AS p, count(*) - sum(y) AS m FROM scored GROUP BY 1), r AS (SELECT *, coalesce(sum(m) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
            a AS (SELECT sum(p * (below + m / 2.0)) / sum(p) / sum(m) AS auc FROM r) SELECT round(auc, 9) AS roc_auc, round(2 * auc - 1, 9) AS gini FROM a""",
        "average_precision": _with(SCORED) + """, g AS (SELECT score, sum(y) AS p, count(*) AS n FROM scored GROUP BY 1), r AS (SELECT p, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS up FROM g)
            SELECT round(sum(p * tp / up) / sum(p), 9) AS pr_auc FROM r""",
        "ks": _with(SCORED, RANKED) + "SELECT round(max(abs(cp / pos - (n - cp) / (total - pos))), 9) AS ks FROM ranked",
        "brier": _with(SCORED) + "SELECT round(avg((score - y) * (score - y)), 9) AS brier_score FROM scored",
        "probability_summary": _with(SCORED) + "SELECT round(min(score), 9) AS min, round(quantile_cont(score, 0.01), 9) AS p01, round(quantile_cont(score, 0.05), 9) AS p05, round(median(score), 9) AS median, round(quantile_cont(score, 0.95), 9) AS p95, round(quantile_cont(score, 0.99), 9) AS p99, round(avg(score), 9) AS mean, round(max(score), 9) AS max FROM scored",
        "decile_table": _with(SCORED, DECILES) + "SELECT decile, \"rows\", positive_cases, round(default_rate, 9) AS default_rate, score_min, score_max, cumulative_rows, round(cumulative_row_pct, 9) AS cumulative_row_pct, cumulative_positives, round(cumulative_positive_pct, 9) AS cumulative_positive_pct, round(lift, 9) AS lift, round(cumulative_lift, 9) AS cumulative_lift FROM deciles",
        "top_deciles": _with(SCORED, DECILES) + "SELECT decile, round(default_rate, 9) AS default_rate, round(lift, 9) AS lift, round(cumulative_positive_pct, 9) AS cumulative_positive_pct, round(cumulative_lift, 9) AS cumulative_lift FROM deciles WHERE decile IN (1, 3)",
        "score_logits": _with(SCORED) + ", c AS (SELECT case_id, CASE WHEN case_id % 10 = 0 THEN 1 - 1e-6 ELSE score END AS p FROM scored) SELECT case_id, round(ln(p / (1 - p)), 6) AS logit FROM c",
        "labelled_documents": "SELECT labels.doc_id AS case_id, CAST(quality AS BIGINT) AS target, CAST(toxic AS BIGINT) AS toxic, lang, n_chars FROM labels LEFT JOIN documents USING (doc_id)",
        "storage_estimate": "SELECT count(*) AS row_count, 42 AS column_count, CAST(floor(count(*) * 42 * 8 * 1.35) AS BIGINT) AS bytes FROM orders",
        "joined_validation": "SELECT count(*) AS row_count, count(DISTINCT o_orderkey) AS distinct_cases, 42 AS column_count, 0 AS missing_columns, 0 AS extra_columns, 0 AS duplicate_columns, true AS one_row_per_case, true AS lineage_matches FROM orders",
        "ingestion_records": "SELECT 'applprev_1' AS table_name, 'success' AS status, count(*) AS source_rows, count(*) AS loaded_rows FROM lineitem UNION ALL SELECT 'base', 'success', count(*), count(*) FROM orders UNION ALL SELECT 'static_0', 'success', count(*), count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_custkey % 7 <> 0",
        "reset_records": "SELECT 'applprev_1' AS table_name, 'success' AS status, count(*) AS loaded_rows FROM lineitem UNION ALL SELECT 'base', 'success', count(*) FROM orders",
        "semantic_categories": """WITH d AS (SELECT 'col_' || CAST(p_partkey AS VARCHAR) AS column_name, lower(p_type || ' ' || list_extract(['price', 'status', 'dpd date', 'loan', 'number of', 'tax', 'person', 'x'], p_partkey % 8 + 1)) AS t FROM part),
            m AS (SELECT column_name, t, regexp_matches(t, 'payment|installment|paid|dpd|past due') AS pay FROM d)
            SELECT column_name, CASE WHEN pay THEN 'payment' WHEN regexp_matches(t, 'amount|annuity|income|price|payment|paid|debt') THEN 'amount' WHEN regexp_matches(t, 'date|days|dpd|past due|month|week') THEN 'date/days'
                WHEN regexp_matches(t, 'status|type|category|role|education|marital') THEN 'categorical status' WHEN regexp_matches(t, 'number of|count|times') THEN 'count'
                WHEN regexp_matches(t, 'person|birth|employment|address|district|gender') THEN 'demographic' WHEN regexp_matches(t, 'application|applicant|request|decision') THEN 'application'
                WHEN regexp_matches(t, 'credit bureau|bureau|contract|loan|debt') THEN 'bureau/credit history' WHEN regexp_matches(t, 'collateral|property|real estate') THEN 'collateral/property'
                WHEN regexp_matches(t, 'tax|registry|deduction') THEN 'tax/registry' ELSE 'ambiguous' END AS semantic_category FROM m""",
    }
    out |= _planned()
    for name in ("target_drift", "numeric_stats", "standardised", "roc_auc", "average_precision", "score_logits", "evaluation", "table_summaries", "definition_coverage", "hashed_design", "calibration"):
        # _with() ends in a blank; a further expression follows it by a comma.
        out[name] = out[name].replace(") , ", "), ", 1)
    return out
