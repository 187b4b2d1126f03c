"""SQL with the same result as each registered query, for an independent engine over the same tables."""

from __future__ import annotations

from riskloom.operators.imputation import REPAIRS
from riskloom.operators.validation import ALL_RULES
from riskloom.plans import views

ORACLES: dict[str, str] = {}


def plain(text: str) -> str:
    """A view's text with bare table names."""
    for name in views.TABLES:
        text = text.replace(f"{{{name}}}", name)
    return text.strip()


def rounded(expression: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS {name}"


# ---- features: the columns the tables must have, stated here apart from the operators ---------------

BUREAU_SPEC = {
    "DAYS_CREDIT": ["min", "max", "mean", "var"],
    "CREDIT_DAY_OVERDUE": ["max", "mean"],
    "DAYS_CREDIT_ENDDATE": ["min", "max", "mean"],
    "DAYS_ENDDATE_FACT": ["min", "max", "mean"],
    "AMT_CREDIT_MAX_OVERDUE": ["max", "mean"],
    "CNT_CREDIT_PROLONG": ["sum", "mean"],
    "AMT_CREDIT_SUM": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_DEBT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_LIMIT": ["max", "mean", "sum"],
    "AMT_CREDIT_SUM_OVERDUE": ["max", "mean", "sum"],
    "DAYS_CREDIT_UPDATE": ["min", "max", "mean"],
    "AMT_ANNUITY": ["max", "mean"],
    "BB_MONTHS_BALANCE_MIN": ["min"],
    "BB_MONTHS_BALANCE_MAX": ["max"],
}
PREVIOUS_SPEC = {
    "AMT_ANNUITY": ["min", "max", "mean"],
    "AMT_APPLICATION": ["min", "max", "mean"],
    "AMT_CREDIT": ["min", "max", "mean"],
    "APP_CREDIT_RATIO": ["min", "max", "mean", "var"],
    "AMT_DOWN_PAYMENT": ["min", "max", "mean"],
    "AMT_GOODS_PRICE": ["min", "max", "mean"],
    "HOUR_APPR_PROCESS_START": ["min", "max", "mean"],
    "RATE_DOWN_PAYMENT": ["min", "max", "mean"],
    "DAYS_DECISION": ["min", "max", "mean"],
    "CNT_PAYMENT": ["max", "mean", "sum"],
    "DAYS_FIRST_DUE": ["min", "max", "mean"],
    "DAYS_LAST_DUE_1ST_VERSION": ["min", "max", "mean"],
    "DAYS_LAST_DUE": ["min", "max", "mean"],
    "DAYS_TERMINATION": ["min", "max", "mean"],
}
POS_SPEC = {
    "MONTHS_BALANCE": ["max", "mean", "size"],
    "CNT_INSTALMENT": ["mean", "sum"],
    "CNT_INSTALMENT_FUTURE": ["mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
INSTALMENT_SPEC = {
    "NUM_INSTALMENT_VERSION": ["nunique"],
    "DPD": ["max", "mean", "sum"],
    "DBD": ["max", "mean", "sum"],
    "PAYMENT_RATIO": ["min", "max", "mean", "var"],
    "PAYMENT_DIFF": ["min", "max", "mean", "sum"],
    "AMT_INSTALMENT": ["min", "max", "mean", "sum"],
    "AMT_PAYMENT": ["min", "max", "mean", "sum"],
    "DAYS_ENTRY_PAYMENT": ["min", "max", "mean"],
    "DAYS_INSTALMENT": ["min", "max", "mean"],
}
CARD_SPEC = {
    "MONTHS_BALANCE": ["min", "max", "mean", "size"],
    "AMT_BALANCE": ["min", "max", "mean", "sum"],
    "AMT_CREDIT_LIMIT_ACTUAL": ["max", "mean"],
    "AMT_DRAWINGS_ATM_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_OTHER_CURRENT": ["max", "mean", "sum"],
    "AMT_DRAWINGS_POS_CURRENT": ["max", "mean", "sum"],
    "AMT_INST_MIN_REGULARITY": ["max", "mean"],
    "AMT_PAYMENT_CURRENT": ["max", "mean", "sum"],
    "AMT_PAYMENT_TOTAL_CURRENT": ["max", "mean", "sum"],
    "AMT_RECEIVABLE_PRINCIPAL": ["max", "mean", "sum"],
    "AMT_RECIVABLE": ["max", "mean", "sum"],
    "AMT_TOTAL_RECEIVABLE": ["max", "mean", "sum"],
    "CNT_DRAWINGS_ATM_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_OTHER_CURRENT": ["max", "mean", "sum"],
    "CNT_DRAWINGS_POS_CURRENT": ["max", "mean", "sum"],
    "CNT_INSTALMENT_MATURE_CUM": ["max", "mean", "sum"],
    "SK_DPD": ["max", "mean"],
    "SK_DPD_DEF": ["max", "mean"],
}
ORDER_SPEC = {
    "O_TOTAL_CENTS": ["min", "max", "mean", "sum"],
    "LI_L_QUANTITY_SUM": ["max", "mean", "sum"],
    "LI_L_LINENUMBER_MAX": ["max", "mean"],
}
BUREAU_SUBSETS = [
    ("ACTIVE", "CREDIT_ACTIVE = 'Active'", {
        "AMT_CREDIT_SUM": ["sum", "mean"],
        "AMT_CREDIT_SUM_DEBT": ["sum", "mean"],
        "AMT_CREDIT_SUM_OVERDUE": ["sum", "mean"],
        "AMT_ANNUITY": ["mean", "max"],
    }),
    ("CLOSED", "CREDIT_ACTIVE = 'Closed'", {
        "AMT_CREDIT_SUM": ["sum", "mean"],
        "DAYS_ENDDATE_FACT": ["max", "mean"],
    }),
]
PREVIOUS_SUBSETS = [
    ("APPROVED", "NAME_CONTRACT_STATUS = 'Approved'", {
        "AMT_CREDIT": ["max", "mean"],
        "AMT_ANNUITY": ["max", "mean"],
        "CNT_PAYMENT": ["mean", "sum"],
    }),
    ("REFUSED", "NAME_CONTRACT_STATUS = 'Refused'", {
        "AMT_APPLICATION": ["max", "mean"],
        "AMT_CREDIT": ["max", "mean"],
    }),
]
ORDER_SUBSETS = [
    ("OPEN", "o_orderstatus = 'O'", {
        "O_TOTAL_CENTS": ["sum", "mean"],
    }),
    ("FINISHED", "o_orderstatus = 'F'", {
        "O_TOTAL_CENTS": ["sum", "max", "mean"],
    }),
]


def feature_name(prefix: str, *parts: str) -> str:
    return "_".join([prefix, *(p.upper() for p in parts)])


def aggregate_sql(spec: dict[str, list[str]], prefix: str, digits: int = 4, where: str | None = None) -> list[str]:
    columns = []
    for column, aggs in spec.items():
        for agg in aggs:
            x = column if where is None else f"CASE WHEN {where} THEN {column} END"
            whole = column.endswith(("_SIZE", "_MAX")) and prefix == "BURO"
            body = {
                "min": f"min({x})", "max": f"max({x})", "mean": f"avg({x})", "var": f"var_samp({x})",
                "sum": f"coalesce(sum({x}), 0)", "nunique": f"count(DISTINCT {x})", "size": "count(*)",
            }[agg]
            if where is not None:
                body = f"CASE WHEN count(*) FILTER ({where}) > 0 THEN {body} END"
            name = feature_name(prefix, column, agg)
            if agg in ("nunique", "size"):
                columns.append(f"CAST({body} AS BIGINT) AS {name}")
            elif agg == "sum" and whole:
                columns.append(f"CAST({body} AS BIGINT) AS {name}")
            else:
                columns.append(rounded(body, name, digits))
    return columns


def subset_sql(subsets: list[tuple[str, str, dict[str, list[str]]]], digits: int = 4) -> list[str]:
    return [
        c for prefix, condition, spec in subsets for c in aggregate_sql(spec, prefix, digits, condition)
    ]


def share_sql(prefix: str, column: str, values: list[str], digits: int = 4) -> list[str]:
    columns = [
        rounded(f"avg(CASE WHEN {column} = '{v}' THEN 1.0 ELSE 0.0 END)", feature_name(prefix, f"{column}_{v}", "mean"), digits)
        for v in values
    ]
    missing = f"avg(CASE WHEN {column} IS NULL THEN 1.0 ELSE 0.0 END)"
    return [*columns, rounded(missing, feature_name(prefix, f"{column}_nan", "mean"), digits)]


def grouped(key: str, source: str, columns: list[str], ctes: str = "") -> str:
    return f"WITH {ctes}src AS ({source}) SELECT {key}, {', '.join(columns)} FROM src GROUP BY {key}"


CENTS = "SELECT *, round(o_totalprice * 100) AS O_TOTAL_CENTS FROM orders"
LINES = """li AS (SELECT l_orderkey, sum(l_quantity) AS LI_L_QUANTITY_SUM, max(l_linenumber) AS LI_L_LINENUMBER_MAX
FROM lineitem GROUP BY l_orderkey), """


def _flagship() -> str:
    parts = []
    for column, aggs in ORDER_SPEC.items():
        for agg in aggs:
            sql = {"mean": f"avg({column})", "sum": f"coalesce(sum({column}), 0)"}.get(agg, f"{agg}({column})")
            parts.append(f"{sql} AS {feature_name('ORD', column, agg)}")
    return f"""WITH {LINES} src AS (SELECT o.*, LI_L_QUANTITY_SUM, LI_L_LINENUMBER_MAX FROM ({CENTS}) o
LEFT JOIN li ON o_orderkey = l_orderkey),
per AS (SELECT o_custkey, {', '.join(parts)}, CAST(count(*) AS INT) AS ORD_COUNT FROM src GROUP BY o_custkey)
SELECT c_custkey, c_mktsegment, c_acctbal, per.* EXCLUDE (o_custkey)
FROM customer LEFT JOIN per ON c_custkey = o_custkey"""


ORACLES["client_features"] = _flagship()
ORACLES["client_features_subset"] = grouped(
    "o_custkey", CENTS,
    [c.replace("round(CAST(", "(CAST(").replace(", 4) + 0.0", ")") for c in subset_sql(ORDER_SUBSETS)],
)
ORACLES["onehot_share"] = grouped(
    "o_custkey", "SELECT * FROM orders",
    [c.replace("round(CAST(", "(CAST(").replace(", 4) + 0.0", ")")
     for c in share_sql("ORD", "o_orderstatus", ["F", "O", "P"])],
)
ORACLES["share_rows_long"] = f"""WITH long AS (
SELECT o_custkey, 'o_orderstatus' AS "column", o_orderstatus AS level FROM orders
UNION ALL SELECT o_custkey, 'o_orderpriority', o_orderpriority FROM orders)
SELECT o_custkey, "column", level, {rounded("count(*) / any_value(n)", "share")}
FROM long JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) USING (o_custkey) GROUP BY o_custkey, "column", level"""
ORACLES["bureau_feature_table"] = grouped(
    "SK_ID_CURR",
    "SELECT b.*, BB_MONTHS_BALANCE_MIN, BB_MONTHS_BALANCE_MAX, BB_MONTHS_BALANCE_SIZE FROM b LEFT JOIN bb USING (SK_ID_BUREAU)",
    [*aggregate_sql(BUREAU_SPEC, "BURO"),
     rounded("avg(BB_MONTHS_BALANCE_SIZE)", "BURO_BB_MONTHS_BALANCE_SIZE_MEAN", 4),
     "CAST(coalesce(sum(BB_MONTHS_BALANCE_SIZE), 0) AS BIGINT) AS BURO_BB_MONTHS_BALANCE_SIZE_SUM",
     *share_sql("BURO", "CREDIT_ACTIVE", ["Active", "Closed", "Sold"]), *subset_sql(BUREAU_SUBSETS),
     "CAST(count(*) AS INT) AS BURO_LOAN_COUNT"],
    f"""b AS ({plain(views.BUREAU)}), bb AS (SELECT SK_ID_BUREAU, min(MONTHS_BALANCE) AS BB_MONTHS_BALANCE_MIN,
max(MONTHS_BALANCE) AS BB_MONTHS_BALANCE_MAX, count(*) AS BB_MONTHS_BALANCE_SIZE
FROM ({plain(views.BUREAU_BALANCE)}) GROUP BY SK_ID_BUREAU), """,
)
_day_columns = [
    "DAYS_FIRST_DRAWING", "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
ORACLES["previous_feature_table"] = grouped(
    "SK_ID_CURR",
    "SELECT * REPLACE (" + ", ".join(f"nullif({c}, 365243) AS {c}" for c in _day_columns) + "), "
    f"AMT_APPLICATION / nullif(AMT_CREDIT, 0) AS APP_CREDIT_RATIO FROM ({plain(views.PREVIOUS)})",
    [*aggregate_sql(PREVIOUS_SPEC, "PREV", 5),
     *share_sql("PREV", "NAME_CONTRACT_STATUS", ["Approved", "Canceled", "Refused"], 5),
     *subset_sql(PREVIOUS_SUBSETS, 5), "CAST(count(*) AS INT) AS PREV_APPLICATION_COUNT"],
)
ORACLES["pos_feature_table"] = grouped(
    "SK_ID_CURR", plain(views.POS),
    [*aggregate_sql(POS_SPEC, "POS", 5), *share_sql("POS", "NAME_CONTRACT_STATUS", ["Active", "Completed"], 5),
     "CAST(count(*) AS INT) AS POS_CASH_COUNT"],
)
ORACLES["instalment_feature_table"] = grouped(
    "SK_ID_CURR",
    f"""SELECT *, AMT_PAYMENT / nullif(AMT_INSTALMENT, 0) AS PAYMENT_RATIO, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
CASE WHEN DAYS_ENTRY_PAYMENT IS NULL OR DAYS_INSTALMENT IS NULL THEN NULL
     ELSE greatest(DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT, 0) END AS DPD,
CASE WHEN DAYS_ENTRY_PAYMENT IS NULL OR DAYS_INSTALMENT IS NULL THEN NULL
     ELSE greatest(DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT, 0) END AS DBD
FROM ({plain(views.INSTALMENTS)})""",
    [*aggregate_sql(INSTALMENT_SPEC, "INSTAL", 5), "CAST(count(*) AS INT) AS INSTALLMENTS_COUNT"],
)
ORACLES["card_feature_table"] = grouped(
    "SK_ID_CURR", plain(views.CARDS),
    [*aggregate_sql(CARD_SPEC, "CC", 5), *share_sql("CC", "NAME_CONTRACT_STATUS", ["Active", "Completed"], 5),
     "CAST(count(*) AS INT) AS CREDIT_CARD_LINE_COUNT",
     "CAST(count(DISTINCT SK_ID_PREV) AS INT) AS CREDIT_CARD_PREV_COUNT"],
)

APP = f"""app AS (SELECT * REPLACE (nullif(DAYS_EMPLOYED, 365243) AS DAYS_EMPLOYED, nullif(CODE_GENDER, 'XNA') AS CODE_GENDER),
CAST(coalesce(DAYS_EMPLOYED = 365243, false) AS INT) AS DAYS_EMPLOYED_ANOM FROM ({plain(views.APPLICATIONS)}))"""


def _ratio(numerator: str, denominator: str, name: str) -> str:
    return rounded(f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)", name)


ORACLES["row_features"] = f"WITH {APP} SELECT SK_ID_CURR, " + ", ".join([
    rounded("-DAYS_BIRTH / 365.25E0", "AGE_YEARS"), rounded("-DAYS_EMPLOYED / 365.25E0", "EMPLOYED_YEARS"),
    _ratio("abs(DAYS_EMPLOYED)", "abs(DAYS_BIRTH)", "EMPLOYED_TO_AGE_RATIO"),
    _ratio("AMT_CREDIT", "AMT_INCOME_TOTAL", "CREDIT_TO_INCOME_RATIO"),
    _ratio("AMT_ANNUITY", "AMT_INCOME_TOTAL", "ANNUITY_TO_INCOME_RATIO"),
    _ratio("AMT_CREDIT", "AMT_ANNUITY", "CREDIT_TO_ANNUITY_RATIO"),
    _ratio("AMT_GOODS_PRICE", "AMT_CREDIT", "GOODS_TO_CREDIT_RATIO"),
    _ratio("AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS", "INCOME_PER_PERSON"),
    _ratio("AMT_ANNUITY", "CNT_FAM_MEMBERS", "ANNUITY_PER_PERSON"),
    _ratio("CNT_CHILDREN", "CNT_FAM_MEMBERS", "CHILDREN_RATIO"),
]) + " FROM app"
ORACLES["rowwise_stats"] = f"""WITH {APP}, long AS (SELECT SK_ID_CURR, unnest([EXT_SOURCE_1, EXT_SOURCE_2, EXT_SOURCE_3]) AS e FROM app),
stats AS (SELECT SK_ID_CURR, {rounded("avg(e)", "EXT_SOURCES_MEAN")}, {rounded("stddev_samp(e)", "EXT_SOURCES_STD")},
{rounded("min(e)", "EXT_SOURCES_MIN")}, {rounded("max(e)", "EXT_SOURCES_MAX")},
CAST(count(*) FILTER (e IS NULL) AS INT) AS EXT_SOURCES_NA_COUNT FROM long GROUP BY SK_ID_CURR)
SELECT stats.*, coalesce(FLAG_DOCUMENT_2, 0) + coalesce(FLAG_DOCUMENT_3, 0) AS DOCUMENT_COUNT,
FLAG_MOBIL + FLAG_PHONE AS PHONE_FLAG_COUNT, REG_CITY_NOT_LIVE_CITY + REG_CITY_NOT_WORK_CITY AS ADDRESS_MISMATCH_COUNT
FROM stats JOIN app USING (SK_ID_CURR)"""
ORACLES["sentinel_clean"] = f"WITH {APP} SELECT SK_ID_CURR, DAYS_EMPLOYED, DAYS_EMPLOYED_ANOM, CODE_GENDER FROM app"
ORACLES["union_train_test_rows"] = """SELECT *, CASE WHEN c_custkey % 2 = 0 THEN CAST(c_acctbal < 0 AS INT) END AS TARGET
FROM customer"""
ORACLES["join_coverage_report"] = f"""WITH hits AS (SELECT c_custkey % 2 = 0 AS labelled,
c_custkey IN (SELECT o_custkey FROM orders) AS orders,
c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01') AS recent_orders FROM customer),
long AS (UNPIVOT hits ON orders, recent_orders INTO NAME source VALUE hit)
SELECT source, 2 AS feature_columns, count(*) FILTER (hit) AS matched_clients_all,
{rounded("avg(hit::INT)", "coverage_ratio_all")},
count(*) FILTER (hit AND labelled) AS matched_clients_train,
{rounded("avg(CASE WHEN labelled THEN hit::INT END)", "coverage_ratio_train")},
count(*) FILTER (hit AND NOT labelled) AS matched_clients_test,
{rounded("avg(CASE WHEN NOT labelled THEN hit::INT END)", "coverage_ratio_test")} FROM long GROUP BY source"""
ORACLES["dedup_exact"] = """WITH d AS (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_tax FROM lineitem)
SELECT (SELECT count(*) FROM lineitem) AS rows, (SELECT count(*) FROM d) AS distinct_rows,
(SELECT count(*) FROM lineitem) - (SELECT count(*) FROM d) AS duplicates_removed"""

# ---- sources and sinks --------------------------------------------------------------------------

ORACLES["raw_csv_load"] = f"""SELECT SK_ID_CURR, SK_ID_BUREAU, CREDIT_ACTIVE, AMT_CREDIT_SUM, AMT_CREDIT_SUM_DEBT,
(SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0) AS duplicates_removed FROM ({plain(views.BUREAU)})"""
ORACLES["raw_file_overview"] = f"""WITH b AS ({plain(views.BUREAU)}), bb AS ({plain(views.BUREAU_BALANCE)})
SELECT 'bureau.csv' AS table_name, count(*) AS rows, 15 AS columns, count(DISTINCT SK_ID_CURR) AS sk_id_curr_nunique,
count(*) - count(DISTINCT SK_ID_CURR) AS sk_id_curr_duplicate_rows, count(DISTINCT SK_ID_BUREAU) AS sk_id_bureau_nunique,
count(*) - count(DISTINCT SK_ID_BUREAU) AS sk_id_bureau_duplicate_rows,
'SK_ID_CURR, SK_ID_BUREAU' AS available_key_columns, 'key_columns_only' AS profile_scope, TRUE AS size_is_whole FROM b
UNION ALL SELECT 'bureau_balance.csv', count(*), 3, NULL, NULL, count(DISTINCT SK_ID_BUREAU),
count(*) - count(DISTINCT SK_ID_BUREAU), 'SK_ID_BUREAU', 'key_columns_only', TRUE FROM bb"""
ORACLES["table_roundtrip"] = "SELECT * FROM customer"
CALLS, PREDICTIONS = f"calls AS ({plain(views.CALLS)})", f"preds AS ({plain(views.PREDICTIONS)})"
ORACLES["json_lines_sink"] = f"WITH {CALLS} SELECT id AS request_index, status_code, latency_ms FROM calls"
ORACLES["log_store"] = f"""WITH {PREDICTIONS} SELECT 1 AS feature_count, CAST(json_extract_string(request_payload, '$.k') AS INT) AS k,
default_probability, CAST(default_probability >= 0.22 AS INT) AS predicted_default,
CASE WHEN default_probability >= 0.22 THEN 'refused' ELSE 'approved' END AS credit_decision, latency_ms FROM preds"""
ORACLES["call_log"] = f"""WITH {CALLS} SELECT 'POST' AS method, path, status_code, latency_ms,
CASE WHEN status_code >= 400 THEN request_payload END AS request_payload,
CASE WHEN status_code >= 400 THEN 'http_' || status_code END AS error_type,
CASE WHEN status_code >= 400 THEN substring('failed: ' || repeat(path, 100), 1, 500) END AS error_message FROM calls"""

# ---- profiling and association ----------------------------------------------------------------

GAPS = f"gaps AS ({plain(views.GAPS)})"
GAP_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _per_gap_column(body: str) -> str:
    return " UNION ALL ".join(body.replace("$", c) for c in GAP_COLUMNS)


ORACLES["table_profile"] = f"""WITH {GAPS} SELECT 'orders' AS table_name, count(*) AS rows, 5 AS columns,
{rounded("(5.0 * count(*) - " + " - ".join(f"count({c})" for c in GAP_COLUMNS) + ") / (5.0 * count(*))", "total_missing_ratio")},
3 AS numeric_columns, 2 AS categorical_columns, CAST(0 AS BIGINT) AS full_row_duplicates_removed,
count(DISTINCT o_orderkey) + 1 AS o_orderkey_nunique, count(*) - count(DISTINCT o_orderkey) - 1 AS o_orderkey_key_repetitions,
count(DISTINCT o_custkey) AS o_custkey_nunique, count(*) - count(DISTINCT o_custkey) AS o_custkey_key_repetitions FROM gaps"""
ORACLES["missingness"] = f"""WITH {GAPS}, per AS ({_per_gap_column("SELECT '$' AS c, count($) AS n, count(*) AS total FROM gaps")})
SELECT c AS "column", {rounded("1.0 - (total - n) / total::DOUBLE", "coverage_rate")},
{rounded("(total - n) / total::DOUBLE", "missing_ratio")}, total - n AS missing_count FROM per WHERE n < total"""
ORACLES["schema_summary"] = f"""WITH {GAPS}, per AS ({_per_gap_column("SELECT '$' AS c, count($) AS n, count(*) AS total, count(DISTINCT $) AS d FROM gaps")})
SELECT c AS "column", n AS non_null_count, total - n AS missing_count, round((total - n) / total::DOUBLE * 100, 2) + 0.0 AS missing_ratio,
d + CAST(n < total AS INT) AS nunique FROM per"""
ORACLES["numeric_describe"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, {rounded(f"avg({c})", "mean", 5)}, {rounded(f"stddev_samp({c})", "std", 5)},
{rounded(f"min({c})", "min", 5)}, {rounded(f"quantile_cont({c}, 0.25)", "p25", 5)}, {rounded(f"quantile_cont({c}, 0.5)", "p50", 5)},
{rounded(f"quantile_cont({c}, 0.75)", "p75", 5)}, {rounded(f"max({c})", "max", 5)} FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
)
ORACLES["categorical_summary"] = f"""WITH {GAPS}, cells AS (
SELECT 'o_orderstatus' AS c, o_orderstatus AS v, count(*) AS n FROM gaps GROUP BY v
UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM gaps GROUP BY o_orderpriority),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY n DESC, v NULLS LAST) AS place FROM cells)
SELECT c AS "column", count(*) AS nunique, round(coalesce(sum(n) FILTER (v IS NULL), 0) / sum(n)::DOUBLE * 100, 2) + 0.0 AS missing_ratio,
max(v) FILTER (place = 1) AS top_value FROM placed GROUP BY c"""
ORACLES["target_distribution"] = f"""WITH {GAPS} SELECT o_orderstatus AS target, count(*) AS count,
{rounded("count(*) / sum(count(*)) OVER ()", "ratio")} FROM gaps GROUP BY o_orderstatus"""
LABELLED = f"rows_ AS ({plain(views.LABELLED)})"
NUMBERS = ["l_quantity", "price", "l_discount"]
ORACLES["target_correlations"] = f"WITH {LABELLED} " + " UNION ALL ".join(
    [f"SELECT '{c}' AS feature, {rounded(f'corr({c}, label)', 'correlation')} FROM rows_" for c in [*NUMBERS, "label"]]
    + ["SELECT 'constant_number', NULL"]
)
ORACLES["constant_columns"] = "SELECT * FROM (VALUES ('one'), ('absent')) t(\"column\") WHERE EXISTS (SELECT 1 FROM lineitem)"
ORACLES["dataset_facts"] = f"""WITH {LABELLED} SELECT count(*) AS rows, 9 AS columns, count(label) AS labelled_rows,
{rounded("avg(label)", "target_rate")}, 0 AS constant_columns_removed FROM rows_"""


def _cramers(features: list[str]) -> str:
    cells = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS x, label AS y, count(*) AS n FROM rows_ WHERE {c} IS NOT NULL "
        f"AND (SELECT count(DISTINCT {c}) FROM rows_) <= 40 GROUP BY {c}, label"
        for c in features
    )
    return f"""cells AS ({cells}),
marg AS (SELECT *, sum(n) OVER (PARTITION BY feature, x) AS nx, sum(n) OVER (PARTITION BY feature, y) AS ny,
sum(n) OVER (PARTITION BY feature) AS total FROM cells),
full_ AS (SELECT a.feature, a.x, b.y, a.nx, b.ny, a.total, coalesce(m.n, 0) AS n
FROM (SELECT DISTINCT feature, x, nx, total FROM marg) a JOIN (SELECT DISTINCT feature, y, ny FROM marg) b USING (feature)
LEFT JOIN cells m ON m.feature = a.feature AND m.x = a.x AND m.y = b.y),
chi AS (SELECT feature, sum(pow(n - nx * ny / total::DOUBLE, 2) / (nx * ny / total::DOUBLE)) AS chi2,
max(total)::DOUBLE AS n, count(DISTINCT x) AS r, count(DISTINCT y) AS c FROM full_ GROUP BY feature),
cv AS (SELECT feature, sqrt(greatest(0, chi2 / n - (c - 1) * (r - 1) / (n - 1)) /
least(c - pow(c - 1, 2) / (n - 1) - 1, r - pow(r - 1, 2) / (n - 1) - 1)) AS score FROM chi)"""


ORACLES["cramers_v"] = f"WITH {LABELLED}, {_cramers(['l_linestatus', 'band', 'priority'])} SELECT feature, {rounded('score', 'score')} FROM cv"
_numeric_rows = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, NULL AS modality, '{c}' AS label, 'point_biserial' AS method, {rounded(f"corr({c}, label)", "score")},
count({c}) AS n, NULL AS target_rate_modality, NULL AS target_rate_rest FROM rows_""" for c in NUMBERS
)
_modal_rows = " UNION ALL ".join(
    f"""SELECT '{c}' AS feature, m AS modality, '{c} = ' || m AS label, 'modality_vs_rest' AS method,
{rounded("(SELECT corr((coalesce(" + c + ", 'MISSING') = m)::INT, label) FROM rows_)", "score")}, n,
{rounded("(SELECT avg(label) FROM rows_ WHERE coalesce(" + c + ", 'MISSING') = m)", "target_rate_modality")},
{rounded("(SELECT avg(label) FROM rows_ WHERE coalesce(" + c + ", 'MISSING') <> m)", "target_rate_rest")}
FROM (SELECT coalesce({c}, 'MISSING') AS m, count(*) AS n FROM rows_ GROUP BY 1)
WHERE n >= 30 AND (SELECT count(DISTINCT {c}) FROM rows_) <= 40"""
    for c in ("l_linestatus", "band", "priority", "crowded")
)
ORACLES["signed_association"] = f"WITH {LABELLED} {_numeric_rows} UNION ALL {_modal_rows}"
_strengths = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, 'numeric' AS type_feature, 'point_biserial' AS method, corr({c}, label) AS score FROM rows_"
    for c in NUMBERS
)
ORACLES["feature_target_assoc"] = f"""WITH {LABELLED}, {_cramers(['l_linestatus', 'band', 'priority', 'crowded'])},
strength AS ({_strengths} UNION ALL SELECT feature, 'categorical', 'cramers_v', score FROM cv)
SELECT feature, upper(substring(replace(feature, '_', ' '), 1, 1)) || substring(replace(feature, '_', ' '), 2) AS feature_label,
type_feature, method, {rounded("score", "score")}, {rounded("abs(score)", "score_abs")}
FROM strength WHERE score IS NOT NULL ORDER BY abs(score) DESC, feature LIMIT 5"""

# ---- scores -----------------------------------------------------------------------------------

SCORED = f"rows_ AS ({plain(views.SCORED)})"


def _metrics(fn_cost: float = 10.0) -> dict[str, str]:
    return {
        "business_cost": f"({fn_cost} * fn + fp) / (tn + fp + fn + tp)::DOUBLE",
        "business_score": f"-(({fn_cost} * fn + fp) / (tn + fp + fn + tp)::DOUBLE)",
        "precision": "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)",
        "recall": "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)",
        "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)",
        "accuracy": "(tp + tn) / (tn + fp + fn + tp)::DOUBLE",
        "balanced_accuracy": "(tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2",
    }


def _metric_columns(fn_cost: float = 10.0) -> str:
    return ", ".join([
        *[rounded(sql, name) for name, sql in _metrics(fn_cost).items()],
        *[rounded(c, c) for c in ("roc_auc", "average_precision", "brier_score", "ks_statistic")],
        *[f"CAST({s} AS BIGINT) AS {n}" for s, n in
          [("tn", "true_negatives"), ("fp", "false_positives"), ("fn", "false_negatives"), ("tp", "true_positives")]],
    ])


def _constants(key: str) -> str:
    """AUC, AP, Brier and KS per key from windows over distinct scores."""
    return f"""pts AS (SELECT {key} AS g, score AS s, sum(label) AS p, sum(1 - label) AS q FROM rows_ GROUP BY ALL),
cum AS (SELECT *, sum(p) OVER (PARTITION BY g) AS pt, sum(q) OVER (PARTITION BY g) AS qt,
sum(p) OVER (PARTITION BY g ORDER BY s DESC) AS tp_, sum(q) OVER (PARTITION BY g ORDER BY s DESC) AS fp_ FROM pts),
const AS (SELECT g, sum(p * ((qt - fp_) + 0.5 * q)) / (max(pt) * max(qt))::DOUBLE AS roc_auc,
sum(p / pt::DOUBLE * tp_ / (tp_ + fp_)) AS average_precision,
sum(p * pow(s - 1, 2) + q * pow(s, 2)) / (max(pt) + max(qt)) AS brier_score,
greatest(max(tp_ / pt::DOUBLE - fp_ / qt::DOUBLE), 0) AS ks_statistic FROM cum GROUP BY g)"""


def _sweep(key: str, candidates: str) -> str:
    """Confusion counts at every (key, threshold) of ``candidates``, by cumulative counts."""
    return f"""cand AS ({candidates}),
marks AS (SELECT g, t, 0 AS p, 0 AS q FROM cand UNION ALL SELECT {key}, score, label, 1 - label FROM rows_),
steps AS (SELECT g, t, sum(p) AS p, sum(q) AS q FROM marks GROUP BY g, t),
sweep AS (SELECT g, t, sum(p) OVER w AS tp, sum(q) OVER w AS fp, sum(p) OVER (PARTITION BY g) - sum(p) OVER w AS fn,
sum(q) OVER (PARTITION BY g) - sum(q) OVER w AS tn FROM steps WINDOW w AS (PARTITION BY g ORDER BY t DESC))"""


GRID = "SELECT i * 0.0025E0 AS t FROM range(401) r(i)"
ORACLES["business_cost"] = f"""WITH {SCORED}, c AS (SELECT l_linestatus,
count(*) FILTER (label = 0 AND score < 0.5) AS tn, count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
count(*) FILTER (label = 1 AND score < 0.5) AS fn, count(*) FILTER (label = 1 AND score >= 0.5) AS tp FROM rows_ GROUP BY ALL)
SELECT l_linestatus, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives,
{rounded("(10.0 * fn + fp) / (tn + fp + fn + tp)", "business_cost")}, {rounded("10.0 * fn + fp", "total_cost")} FROM c"""
ORACLES["evaluate_threshold"] = f"""WITH {SCORED}, {_constants("0")}, c AS (SELECT 0 AS g,
count(*) FILTER (label = 0 AND score < 0.35) AS tn, count(*) FILTER (label = 0 AND score >= 0.35) AS fp,
count(*) FILTER (label = 1 AND score < 0.35) AS fn, count(*) FILTER (label = 1 AND score >= 0.35) AS tp FROM rows_)
SELECT 0.35E0 AS threshold, {_metric_columns()} FROM c JOIN const USING (g)"""
ORACLES["auc_ap_ks_brier"] = f"""WITH {SCORED}, {_constants("l_linestatus")} SELECT g AS l_linestatus,
{", ".join(rounded(c, c) for c in ("roc_auc", "average_precision", "brier_score", "ks_statistic"))} FROM const"""
ORACLES["roc_points"] = f"""WITH {SCORED}, {_sweep("0", "SELECT 0 AS g, score AS t FROM rows_")}
SELECT {rounded("t", "threshold")}, {rounded("fp / (fp + tn)::DOUBLE", "false_positive_rate")},
{rounded("tp / (tp + fn)::DOUBLE", "true_positive_rate")}, {rounded("tp / (tp + fp)::DOUBLE", "precision")},
CAST(tn AS BIGINT) AS true_negatives, CAST(fp AS BIGINT) AS false_positives, CAST(fn AS BIGINT) AS false_negatives,
CAST(tp AS BIGINT) AS true_positives FROM sweep"""
ORACLES["threshold_sweep"] = f"""WITH {SCORED}, {_constants("0")},
{_sweep("0", f"SELECT 0 AS g, t FROM ({GRID}) UNION ALL SELECT 0, 0.3333E0")}
SELECT {rounded("t", "threshold")}, {_metric_columns()} FROM sweep JOIN const USING (g)"""


def _best(key: str, name: str, fn_cost: float) -> str:
    cost, recall = _metrics(fn_cost)["business_cost"], _metrics()["recall"]
    return f"""WITH {SCORED}, {_constants(key)},
{_sweep(key, f"SELECT DISTINCT {key} AS g, t FROM rows_, ({GRID})")},
best AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY {cost}, {recall} DESC, t) AS place FROM sweep)
SELECT g AS {name}, {rounded("t", "threshold")}, {_metric_columns(fn_cost)} FROM best JOIN const USING (g) WHERE place = 1"""


ORACLES["best_threshold"] = _best("l_linestatus", "l_linestatus", 2.0)
ORACLES["leaderboard"] = f"""WITH best_ AS ({_best("l_linenumber", "l_linenumber", 2.0)})
SELECT 'RandomForest_' || l_linenumber AS model, business_cost AS cv_business_cost, average_precision AS cv_average_precision,
roc_auc AS cv_roc_auc,
{rounded("5 * (true_positives / (true_positives + false_positives)::DOUBLE) * (true_positives / (true_positives + false_negatives)::DOUBLE) / (4 * (true_positives / (true_positives + false_positives)::DOUBLE) + true_positives / (true_positives + false_negatives)::DOUBLE)", "f2")},
CAST(row_number() OVER (ORDER BY business_cost, average_precision DESC, roc_auc DESC) AS INT) AS rank, 'bagging_tree' AS family FROM best_"""


def _selected(split: str, where: str) -> str:
    fn, fp, tp = (f"count(*) FILTER ({c})" for c in (
        "label = 1 AND score < 0.35", "label = 0 AND score >= 0.35", "label = 1 AND score >= 0.35"))
    return f"""SELECT {rounded(f"(10.0 * {fn} + {fp}) / count(*)", f"{split}_business_cost_at_selected_threshold")},
{rounded(f"{tp} / ({tp} + {fn})::DOUBLE", f"{split}_recall_at_selected_threshold")},
{rounded(f"{tp} / ({tp} + {fp})::DOUBLE", f"{split}_precision_at_selected_threshold")} FROM rows_ WHERE {where}"""


ORACLES["threshold_selection"] = f"""WITH {SCORED},
{_sweep("CASE WHEN l_linenumber = 1 THEN 'holdout' ELSE 'oof' END", f"SELECT g, t FROM (VALUES ('oof'), ('holdout')) s(g), ({GRID}) UNION ALL VALUES ('oof', 0.35E0), ('holdout', 0.35E0)")},
least_ AS (SELECT {", ".join(rounded(f"min({_metrics()['business_cost']}) FILTER (g = '{s}')", f"{s}_min_business_cost") for s in ("oof", "holdout"))} FROM sweep)
SELECT 'by_line' AS model_name, 0.35E0 AS selected_threshold, 'out_of_fold_business_cost_minimization' AS selection_basis,
10.0E0 AS fn_cost, 1.0E0 AS fp_cost, a.*, b.*, least_.* FROM ({_selected("oof", "l_linenumber <> 1")}) a,
({_selected("holdout", "l_linenumber = 1")}) b, least_"""
ORACLES["decision"] = f"""WITH {PREDICTIONS} SELECT id, default_probability, 0.22E0 AS business_threshold,
CAST(default_probability >= 0.22E0 AS INT) AS predicted_default,
CASE WHEN default_probability >= 0.22E0 THEN 'refused' ELSE 'approved' END AS credit_decision FROM preds"""

# ---- fairness ---------------------------------------------------------------------------------

DECIDED = f"decided AS ({plain(views.DECIDED)})"
BAND = """CASE WHEN {x} >= 20 AND {x} < 30 THEN '20-29' WHEN {x} >= 30 AND {x} < 40 THEN '30-39'
WHEN {x} >= 40 AND {x} < 50 THEN '40-49' WHEN {x} >= 50 AND {x} < 60 THEN '50-59' WHEN {x} >= 60 AND {x} < 100 THEN '60+' END"""


def _fairness(group: str, name: str) -> str:
    return f"""{name} AS (SELECT {group} AS grp, count(*) AS n, count(*) FILTER (TARGET = 1) AS n_positive_target,
avg(prediction) AS selection_rate, avg(CASE WHEN TARGET = 1 THEN prediction END) AS recall,
avg(CASE WHEN TARGET = 0 THEN prediction END) AS fpr,
(10.0 * count(*) FILTER (TARGET = 1 AND prediction = 0) + count(*) FILTER (TARGET = 0 AND prediction = 1)) / count(*)::DOUBLE AS business_cost
FROM decided WHERE {group} IS NOT NULL GROUP BY 1)"""


_disparity = f"""{rounded("min(selection_rate) / max(selection_rate)", "disparate_impact_ratio")},
{rounded("max(recall) - min(recall)", "equal_opportunity_difference")},
min(selection_rate) / max(selection_rate) < 0.8 AS flag_disparate_impact"""
ORACLES["fairness_table"] = f"""WITH {DECIDED}, {_fairness("segment", "f")} SELECT grp AS "group", n, n_positive_target,
{", ".join(rounded(c, c) for c in ("selection_rate", "recall", "fpr", "business_cost"))} FROM f"""
ORACLES["disparity"] = f"""WITH {DECIDED}, {_fairness("segment", "f")} SELECT {_disparity} FROM f"""
ORACLES["fairness_summary"] = f"""WITH {DECIDED}, {_fairness("segment", "f")}, {_fairness(BAND.format(x="age"), "h")}
SELECT 'gender' AS attribute, {_disparity} FROM f UNION ALL SELECT 'age_band', {_disparity} FROM h"""
ORACLES["age_bands"] = f"SELECT p_partkey, {BAND.format(x='p_size')} AS band FROM part"
ORACLES["enrich_sensitive"] = """SELECT o_custkey AS c_custkey, o_orderkey, o_orderstatus, c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey"""

# ---- drift ------------------------------------------------------------------------------------

PERIODS = f"periods AS ({plain(views.PERIODS)})"
DRIFT_NUMBERS = ["quantity", "price", "tax", "rare_flag"]


def _level(ks: bool) -> str:
    high = "psi >= 0.25 OR abs(missing_rate_delta) >= 0.1" + (" OR ks_statistic >= 0.2" if ks else "")
    moderate = "psi >= 0.1" + (" OR ks_statistic >= 0.1" if ks else "")
    return (f"CASE WHEN current_rows < 30 THEN 'insufficient_data' WHEN {high} THEN 'high' "
            f"WHEN {moderate} THEN 'moderate' ELSE 'low' END AS drift_level")


def _ks_series(scaled: str) -> str:
    terms = f"list_transform(range(1, 41), lambda k: CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * ({scaled}) * ({scaled})))"
    return f"CASE WHEN {scaled} < 0.04 THEN 1.0 ELSE greatest(least(list_sum({terms}), 1.0), 0.0) END"


_probes = ", ".join(f"{i / 10}" for i in range(11))
_long_numbers = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, is_current AS cur FROM periods" for c in DRIFT_NUMBERS
)
_PSI = "sum((greatest(o, 1e-6) - greatest(e, 1e-6)) * ln(greatest(o, 1e-6) / greatest(e, 1e-6)))"
NUMERIC = f"""long AS ({_long_numbers}),
basic AS (SELECT feature, 'numeric' AS feature_type,
1 - count(v) FILTER (NOT cur) / count(*) FILTER (NOT cur)::DOUBLE AS reference_missing_rate,
1 - count(v) FILTER (cur) / count(*) FILTER (cur)::DOUBLE AS current_missing_rate,
avg(v) FILTER (NOT cur) AS reference_mean, avg(v) FILTER (cur) AS current_mean, count(*) FILTER (cur) AS current_rows,
count(v) FILTER (NOT cur) AS nr, count(v) FILTER (cur) AS nc FROM long GROUP BY feature),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{_probes}]) FILTER (NOT cur))) AS e FROM long GROUP BY feature),
inner_ AS (SELECT feature, CASE WHEN len(e) >= 3 THEN e[2:len(e) - 1] ELSE [] END AS e FROM edges),
bins AS (SELECT feature, len(list_filter(e, lambda x: x <= v)) AS b, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c
FROM long JOIN inner_ USING (feature) WHERE v IS NOT NULL GROUP BY ALL),
psis AS (SELECT feature, {_PSI} AS psi FROM (SELECT feature, r / nr::DOUBLE AS e, c / nc::DOUBLE AS o FROM bins JOIN basic USING (feature)) GROUP BY feature),
vals AS (SELECT feature, v, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM long WHERE v IS NOT NULL GROUP BY ALL),
cdf AS (SELECT feature, sum(r) OVER (PARTITION BY feature ORDER BY v) AS cr, sum(c) OVER (PARTITION BY feature ORDER BY v) AS cc FROM vals),
kss AS (SELECT feature, max(abs(cr / nr::DOUBLE - cc / nc::DOUBLE)) AS ks_statistic FROM cdf JOIN basic USING (feature) GROUP BY feature),
num AS (SELECT *, current_missing_rate - reference_missing_rate AS missing_rate_delta, current_mean - reference_mean AS mean_delta
FROM basic JOIN psis USING (feature) JOIN kss USING (feature)),
numeric_report AS (SELECT *, {_level(True)} FROM num)"""
ORACLES["numeric_drift"] = f"""WITH {PERIODS}, {NUMERIC} SELECT feature, feature_type,
{", ".join(rounded(c, c) for c in ("reference_missing_rate", "current_missing_rate", "missing_rate_delta", "reference_mean", "current_mean", "mean_delta", "psi", "ks_statistic"))},
{rounded(_ks_series("sqrt(nr * nc / (nr + nc)::DOUBLE) * ks_statistic"), "ks_pvalue")}, current_rows, drift_level FROM numeric_report"""
# Paths of one step per value, row by row: prev[j + 2] counts those to (i, j) that stay inside the band, as a share of 2 ** (i + j).
ORACLES["ks_small_samples"] = f"""WITH RECURSIVE sides AS (SELECT s_nationkey >= 12 AS cur, floor(s_acctbal) AS balance, CAST(s_suppkey % 7 AS DOUBLE) AS week FROM supplier),
vals AS (SELECT cur, feature, v FROM (UNPIVOT sides ON balance, week INTO NAME feature VALUE v)),
sizes AS (SELECT feature, count(*) FILTER (NOT cur) AS n, count(*) FILTER (cur) AS m FROM vals GROUP BY feature),
gaps AS (SELECT feature, max(abs(cr * m - cc * n)) AS h FROM (SELECT DISTINCT feature, v, count(*) FILTER (NOT cur) OVER w AS cr, count(*) FILTER (cur) OVER w AS cc
  FROM vals WINDOW w AS (PARTITION BY feature ORDER BY v)) JOIN sizes USING (feature) GROUP BY feature),
paths AS (
  SELECT feature, n, m, h, CAST(0 AS BIGINT) AS i, list_prepend(0.0::DOUBLE, list_transform(range(0, m + 1), lambda j: CASE WHEN j * n < h THEN pow(0.5::DOUBLE, j) ELSE 0.0 END)) AS prev
  FROM sizes JOIN gaps USING (feature)
  UNION ALL SELECT feature, n, m, h, i + 1, list_reduce(list_prepend([0.0::DOUBLE], list_transform(range(0, m + 1), lambda j: [j::DOUBLE])),
    lambda acc, x: list_append(acc, CASE WHEN abs((i + 1) * m - x[1] * n) < h THEN (prev[CAST(x[1] AS INT) + 2] + acc[len(acc)]) / 2 ELSE 0.0 END))
  FROM paths WHERE i < n
)
SELECT feature, {rounded("h / (n * m)::DOUBLE", "ks_statistic")},
{rounded("1 - exp(ln(greatest(prev[m + 2], 1e-300)) + (n + m) * ln(2) - lgamma(n + m + 1) + lgamma(n + 1) + lgamma(m + 1))", "ks_pvalue")}, m AS current_rows
FROM paths WHERE i = n"""
_long_texts = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, is_current AS cur FROM periods" for c in ("status", "source"))
CATEGORICAL = f"""texts AS ({_long_texts}),
tbasic AS (SELECT feature, 'categorical' AS feature_type,
count(*) FILTER (NOT cur AND v IS NULL) / count(*) FILTER (NOT cur)::DOUBLE AS reference_missing_rate,
count(*) FILTER (cur AND v IS NULL) / count(*) FILTER (cur)::DOUBLE AS current_missing_rate,
count(DISTINCT v) FILTER (NOT cur) AS reference_unique_count, count(DISTINCT v) FILTER (cur) AS current_unique_count,
count(*) FILTER (NOT cur) AS nr, count(*) FILTER (cur) AS current_rows FROM texts GROUP BY feature),
cells AS (SELECT feature, coalesce(v, '__MISSING__') AS k, count(*) FILTER (NOT cur) AS r, count(*) FILTER (cur) AS c FROM texts GROUP BY ALL),
tops AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY r DESC, k) AS place FROM cells),
buckets AS (SELECT feature, CASE WHEN (place <= 20 AND r > 0) OR k = '__MISSING__' THEN k ELSE '__OTHER__' END AS b, sum(r) AS r, sum(c) AS c FROM tops GROUP BY ALL),
tpsi AS (SELECT feature, {_PSI} AS psi FROM (SELECT feature, r / nr::DOUBLE AS e, c / current_rows::DOUBLE AS o FROM buckets JOIN tbasic USING (feature)) GROUP BY feature),
cat AS (SELECT *, current_missing_rate - reference_missing_rate AS missing_rate_delta FROM tbasic JOIN tpsi USING (feature)),
categorical_report AS (SELECT *, {_level(False)} FROM cat)"""
ORACLES["categorical_drift"] = f"""WITH {PERIODS}, {CATEGORICAL} SELECT feature, feature_type,
{", ".join(rounded(c, c) for c in ("reference_missing_rate", "current_missing_rate", "missing_rate_delta", "psi"))},
reference_unique_count, current_unique_count, current_rows, drift_level FROM categorical_report"""
_both = f"""WITH {PERIODS}, {NUMERIC}, {CATEGORICAL}, everything AS (
SELECT feature, feature_type, psi, drift_level FROM numeric_report UNION ALL SELECT feature, feature_type, psi, drift_level FROM categorical_report)"""
ORACLES["drift_summary"] = f"""{_both} SELECT count(*) AS feature_count, count(*) FILTER (drift_level = 'high') AS high_drift_count,
count(*) FILTER (drift_level = 'moderate') AS moderate_drift_count,
count(*) FILTER (drift_level = 'insufficient_data') AS insufficient_data_count, {rounded("max(psi)", "max_psi")},
{rounded("avg(psi)", "mean_psi")} FROM everything"""
ORACLES["top_drift"] = f"""{_both} SELECT feature, feature_type, {rounded("psi", "psi")}, drift_level FROM everything
ORDER BY everything.psi DESC, feature LIMIT 3"""
ORACLES["stream_drift"] = f"""WITH {PERIODS}, {NUMERIC}, {CATEGORICAL}
SELECT feature, {rounded("psi", "psi")}, drift_level, current_rows FROM numeric_report
UNION ALL SELECT feature, {rounded("psi", "psi")}, drift_level, current_rows FROM categorical_report"""
# Windows of 90 days since 1970; every bin of the reference takes part in every window.
_window = "time_bucket(INTERVAL 90 DAY, created_at, TIMESTAMP '1970-01-01')"
_timed_numbers = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, is_current AS cur, {_window} AS w FROM periods" for c in DRIFT_NUMBERS)
_timed_texts = " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS v, is_current AS cur, {_window} AS w FROM periods" for c in ("status", "source"))
ORACLES["stream_window_drift"] = f"""WITH periods AS ({plain(views.TIMED_PERIODS)}), nums AS ({_timed_numbers}), texts AS ({_timed_texts}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{_probes}]) FILTER (NOT cur))) AS e FROM nums GROUP BY feature),
inner_ AS (SELECT feature, CASE WHEN len(e) >= 3 THEN e[2:len(e) - 1] ELSE [] END AS e FROM edges WHERE len(e) >= 2),
tops AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, v) AS place FROM texts WHERE NOT cur AND v IS NOT NULL GROUP BY feature, v),
binned AS (SELECT feature, 'numeric' AS kind, cur, w, CASE WHEN v IS NULL THEN -1 ELSE len(list_filter(e, lambda x: x <= v)) + 1 END AS bin FROM nums JOIN inner_ USING (feature)
  UNION ALL SELECT t.feature, 'categorical', cur, w, CASE WHEN t.v IS NULL THEN -1 WHEN place <= 20 THEN place ELSE 0 END FROM texts t LEFT JOIN tops p ON t.feature = p.feature AND t.v = p.v),
ref AS (SELECT feature, kind, bin, count(*) AS r FROM binned WHERE NOT cur GROUP BY ALL),
cur AS (SELECT w, feature, bin, count(*) AS c FROM binned WHERE cur GROUP BY ALL),
slots AS (SELECT DISTINCT feature, kind, bin FROM binned),
grid AS (SELECT ws.w, s.feature, s.kind, s.bin, coalesce(r, 0) AS r, coalesce(c, 0) AS c FROM (SELECT DISTINCT w FROM cur) ws, slots s
  LEFT JOIN ref ON ref.feature = s.feature AND ref.bin = s.bin LEFT JOIN cur ON cur.w = ws.w AND cur.feature = s.feature AND cur.bin = s.bin),
based AS (SELECT *, sum(c) OVER f AS rows_, sum(r) OVER f AS ref_rows, sum(CASE WHEN kind = 'categorical' OR bin >= 0 THEN r END) OVER f AS rb,
  sum(CASE WHEN kind = 'categorical' OR bin >= 0 THEN c END) OVER f AS cb, sum(CASE WHEN bin >= 0 THEN r ELSE 0 END) OVER o AS rbelow,
  sum(CASE WHEN bin >= 0 THEN c ELSE 0 END) OVER o AS cbelow FROM grid WINDOW f AS (PARTITION BY w, feature), o AS (PARTITION BY w, feature ORDER BY bin)),
told AS (SELECT w, feature, kind, sum(CASE WHEN bin = -1 THEN r ELSE 0 END) / max(ref_rows)::DOUBLE AS reference_missing_rate,
  sum(CASE WHEN bin = -1 THEN c ELSE 0 END) / max(rows_)::DOUBLE AS current_missing_rate, max(rows_) AS current_rows,
  max(CASE WHEN kind = 'numeric' AND bin >= 0 THEN abs(rbelow / rb::DOUBLE - cbelow / cb::DOUBLE) END) AS ks_statistic,
  sum(CASE WHEN (kind = 'categorical' OR bin >= 0) AND r + c > 0 THEN (greatest(c / cb::DOUBLE, 1e-6) - greatest(r / rb::DOUBLE, 1e-6))
  * ln(greatest(c / cb::DOUBLE, 1e-6) / greatest(r / rb::DOUBLE, 1e-6)) ELSE 0 END) AS psi FROM based GROUP BY w, feature, kind),
levels AS (SELECT *, current_missing_rate - reference_missing_rate AS missing_rate_delta FROM told)
SELECT w AS window_start, w + INTERVAL 90 DAY AS window_end, feature, kind AS feature_type, {rounded("reference_missing_rate", "reference_missing_rate")},
{rounded("current_missing_rate", "current_missing_rate")}, {rounded("psi", "psi")}, {rounded("ks_statistic", "border_gap")},
CAST(current_rows AS BIGINT) AS current_rows, CASE WHEN kind = 'numeric' THEN num_level ELSE cat_level END AS drift_level
FROM (SELECT *, {_level(True).replace("drift_level", "num_level")}, {_level(False).replace("drift_level", "cat_level")} FROM levels)"""
ORACLES["histogram"] = f"""WITH s AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w FROM events)
SELECT CAST(least(floor((value - lo) / w), 29) + 1 AS INT) AS bin,
{rounded("any_value(lo + least(floor((value - lo) / w), 29) * w)", "bin_start")},
{rounded("any_value(lo + (least(floor((value - lo) / w), 29) + 1) * w)", "bin_end")}, count(*) AS count FROM events, s GROUP BY 1"""

# ---- operations -------------------------------------------------------------------------------

_api = f"""api AS (SELECT count(*) AS total_calls, count(*) FILTER (path = '/predict') AS predict_calls,
count(*) FILTER (status_code >= 400) AS error_calls, count(*) FILTER (status_code >= 400) / count(*)::DOUBLE AS error_rate,
avg(latency_ms) AS latency_mean_ms, quantile_cont(latency_ms, 0.5) AS latency_p50_ms, quantile_cont(latency_ms, 0.95) AS latency_p95_ms,
quantile_cont(latency_ms, 0.99) AS latency_p99_ms, max(latency_ms) AS latency_max_ms, min(created_at) AS first_call_at,
max(created_at) AS last_call_at, count(latency_ms) AS timed FROM calls)"""
LATENCIES = ["latency_mean_ms", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms", "latency_max_ms"]
_latency_columns = ", ".join(rounded(c, c) for c in LATENCIES)
ORACLES["api_call_summary"] = f"""WITH {CALLS}, {_api} SELECT total_calls, predict_calls, error_calls, {rounded("error_rate", "error_rate")},
{_latency_columns}, first_call_at, last_call_at FROM api"""
ORACLES["latency_summary"] = f"WITH {CALLS}, {_api} SELECT 'api' AS source, timed AS count, {_latency_columns} FROM api"
ORACLES["latency_by_path"] = f"""WITH {CALLS} SELECT path, count(latency_ms) AS count, {rounded("avg(latency_ms)", "latency_mean_ms")},
{rounded("quantile_cont(latency_ms, 0.95)", "latency_p95_ms")}, {rounded("max(latency_ms)", "latency_max_ms")} FROM calls GROUP BY path"""
ORACLES["status_codes"] = f"""WITH {CALLS} SELECT status_code, count(*) AS count, {rounded("count(*) / sum(count(*)) OVER ()", "rate")}
FROM calls GROUP BY status_code"""
_decided = """count(*) FILTER (credit_decision = 'refused')"""
ORACLES["prediction_summary"] = f"""WITH {PREDICTIONS} SELECT count(*) AS prediction_count,
{rounded("avg(default_probability)", "default_probability_mean")}, {rounded("quantile_cont(default_probability, 0.5)", "default_probability_p50")},
{rounded("quantile_cont(default_probability, 0.95)", "default_probability_p95")}, {_decided} AS refused_count,
count(*) FILTER (credit_decision = 'approved') AS approved_count, {rounded(f"{_decided} / count(*)::DOUBLE", "refused_rate")},
{rounded("count(*) FILTER (credit_decision = 'approved') / count(*)::DOUBLE", "approved_rate")} FROM preds"""
ORACLES["measurement_summary"] = f"""WITH {CALLS}, {_api} SELECT total_calls AS request_count, total_calls - error_calls AS success_count,
error_calls AS error_count, {", ".join(rounded(c, f"client_{c}") for c in LATENCIES)} FROM api"""
ORACLES["monitoring_summary"] = f"""WITH {CALLS}, {PREDICTIONS}, {_api}, counted AS (
SELECT CAST(status_code AS VARCHAR) AS counted, count(*) AS n FROM calls GROUP BY 1
UNION ALL SELECT credit_decision, count(*) FROM preds WHERE credit_decision IS NOT NULL GROUP BY 1)
SELECT total_calls AS total_api_calls, predict_calls, {rounded("error_rate", "error_rate")}, {rounded("latency_p95_ms", "latency_p95_ms")},
(SELECT {rounded(f"{_decided} / count(*)::DOUBLE", "r")} FROM preds) AS refused_rate, counted, n FROM api, counted"""
ORACLES["alerts"] = f"""WITH {CALLS}, {_api}
SELECT 'warning' AS severity, 'error_rate' AS metric, {rounded("error_rate", "observed_value")}, 0.05E0 AS threshold,
'Le taux d''erreur HTTP dépasse le seuil de vigilance.' AS message FROM api WHERE error_rate > 0.05
UNION ALL SELECT 'warning', 'latency_p95_ms', {rounded("latency_p95_ms", "observed_value")}, 100.0E0,
'La latence p95 dépasse le seuil de vigilance.' FROM api WHERE latency_p95_ms > 100"""
ORACLES["bottlenecks"] = f"""WITH {CALLS}, {_api}, m AS (SELECT quantile_cont(latency_ms, 0.95) AS p FROM calls WHERE path = '/predict')
SELECT 'Latence API p95 élevée' AS bottleneck, 'high' AS severity,
format('p95 API = {{:.1f}} ms > seuil 100.0 ms', latency_p95_ms) AS evidence,
'Profiler le endpoint /predict et surveiller CPU/RAM du conteneur.' AS recommendation FROM api WHERE latency_p95_ms > 100
UNION ALL SELECT 'Latence API', 'low', format('p95 API = {{:.1f}} ms', latency_p95_ms),
'Configuration acceptable sur les seuils actuels.' FROM api WHERE latency_p95_ms <= 100
UNION ALL SELECT 'Taux d''erreur HTTP', 'high', format('taux d''erreur = {{:.1f}}%', error_rate * 100),
'Distinguer erreurs de validation attendues et erreurs serveur.' FROM api WHERE error_rate > 0.05
UNION ALL SELECT 'Inférence modèle', 'moderate', format('p95 modèle = {{:.1f}} ms pour p95 API = {{:.1f}} ms', p, latency_p95_ms),
'Étudier batching, simplification du preprocessing ou conversion ONNX.' FROM api, m WHERE p / latency_p95_ms >= 0.7
UNION ALL SELECT 'Overhead API / sérialisation / logs', 'moderate',
format('p95 modèle = {{:.1f}} ms pour p95 API = {{:.1f}} ms', p, latency_p95_ms),
'Conserver les logs en tâche de fond et éviter les payloads dupliqués.' FROM api, m WHERE p / latency_p95_ms < 0.7"""
ORACLES["fk_integrity"] = """WITH c AS (SELECT l_orderkey * 2 AS prediction_log_id FROM lineitem)
SELECT 'orphan' AS violation, prediction_log_id, count(*) AS rows FROM c WHERE prediction_log_id NOT IN (SELECT o_orderkey FROM orders) GROUP BY ALL
UNION ALL SELECT 'repeated_reference', prediction_log_id, count(*) FROM c GROUP BY ALL HAVING count(*) > 1"""
ORACLES["latest_rows"] = f"WITH {CALLS} SELECT id, path, created_at FROM calls ORDER BY created_at DESC, id LIMIT 50"
ORACLES["latest_event_by_type"] = f"""WITH {CALLS}, p AS (SELECT *, row_number() OVER (PARTITION BY path ORDER BY created_at DESC, id DESC) AS place FROM calls)
SELECT path, id, created_at, latency_ms FROM p WHERE place = 1"""
ORACLES["risk_extremes"] = """(SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 5)
UNION (SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey LIMIT 5)"""

# ---- payloads, text, validation, repair -----------------------------------------------------------

ORACLES["flatten_payload"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
ORACLES["json_key_values"] = "SELECT event_id, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events"
ORACLES["payload_kinds"] = """SELECT doc_id, 'text' AS kind, CASE WHEN NOT coalesce(json_valid(text), FALSE) THEN NULL
WHEN json_type(text) = 'OBJECT' THEN text ELSE '{"payload":' || text || '}' END AS payload FROM documents
UNION ALL SELECT doc_id, 'object', '{"n_chars":' || n_chars || ',"lang":"' || lang || '"}' FROM documents
UNION ALL SELECT doc_id, 'number', '{"payload":' || n_chars || '}' FROM documents"""
ORACLES["file_sizes"] = f"SELECT t || '.parquet' AS table_name, TRUE AS size_is_whole FROM (SELECT unnest({list(views.TABLES)!r}) AS t)"
_previous_columns = [
    "SK_ID_CURR", "SK_ID_PREV", "NAME_CONTRACT_STATUS", "AMT_ANNUITY", "AMT_APPLICATION", "AMT_CREDIT", "AMT_DOWN_PAYMENT",
    "AMT_GOODS_PRICE", "HOUR_APPR_PROCESS_START", "RATE_DOWN_PAYMENT", "DAYS_DECISION", "CNT_PAYMENT", "DAYS_FIRST_DRAWING",
    "DAYS_FIRST_DUE", "DAYS_LAST_DUE_1ST_VERSION", "DAYS_LAST_DUE", "DAYS_TERMINATION",
]
ORACLES["most_missing_columns"] = f"""WITH p AS ({plain(views.PREVIOUS)}), m AS (""" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing_count, count(*) AS n FROM p""" for c in _previous_columns
) + f""") SELECT "column", {rounded("missing_count / n", "missing_ratio")}, missing_count FROM m WHERE missing_count > 0
ORDER BY missing_count / n DESC, "column" LIMIT 5"""
ORACLES["text_labels"] = """SELECT p_partkey,
trim(regexp_replace(lower(trim('  ' || p_name || ' ' || p_brand || '!')), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) || ' ' || lower(p_name) AS label FROM part"""
_request_columns = [
    "AGE_YEARS", "AMT_INCOME_TOTAL", "AMT_CREDIT", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
    "HOUR_APPR_PROCESS_START", "REGION_RATING_CLIENT", "FLAG_MOBIL", "EXT_SOURCE_1",
]


def _on(predicate: str, column: str) -> str:
    return " ".join(column if word == "x" else word for word in predicate.split())


ORACLES["validate_clients"] = f"""WITH r AS ({plain(views.REQUESTS)}) SELECT SK_ID_CURR, concat_ws('|', """ + ", ".join(
    f"CASE WHEN NOT ({_on(rule.accept, rule.column)}) THEN '{rule.message}' END" for rule in ALL_RULES if rule.column in _request_columns
) + ") AS violations FROM r"
ORACLES["validate_requests"] = """SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract(props, '$.k') AS INT) END AS k,
CASE WHEN event_id % 10 = 0 THEN 'payload: not a JSON object.' ELSE '' END AS violations FROM events"""
ORACLES["repair_clients"] = f"WITH r AS ({plain(views.REQUESTS)}) SELECT SK_ID_CURR, " + ", ".join([
    *[f"CAST(CASE WHEN {_on(rule.accept, rule.column)} THEN {rule.column} ELSE {rule.default} END AS DOUBLE) AS {rule.column}"
      for rule in REPAIRS if rule.column in _request_columns],
    "CAST(FLAG_MOBIL >= 0.5 AS INT) AS FLAG_MOBIL", "least(greatest(coalesce(EXT_SOURCE_1, 0), 0), 1) AS EXT_SOURCE_1",
]) + " FROM r"
ORACLES["median_mode_impute"] = f"""WITH {GAPS} SELECT o_orderkey,
coalesce(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.5) FROM gaps)) AS o_totalprice,
coalesce(o_orderstatus, (SELECT o_orderstatus FROM gaps WHERE o_orderstatus IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderstatus
FROM gaps"""

# ---- sampling ---------------------------------------------------------------------------------

_quotas = """counts AS (SELECT toxic, count(*) AS n, sum(count(*)) OVER () AS total FROM labels GROUP BY toxic),
parts AS (SELECT *, floor(size * n / total) AS low, size * n / total::DOUBLE - floor(size * n / total) AS rest FROM (SELECT *, {size} AS size FROM counts)),
quota AS (SELECT toxic, n, CAST(low + CAST(row_number() OVER (ORDER BY rest DESC, toxic) <= size - sum(low) OVER () AS INT) AS BIGINT) AS q FROM parts)"""
ORACLES["stratified_sample"] = f"WITH {_quotas.format(size='60')} SELECT toxic, q AS n, q AS ids FROM quota"
ORACLES["stratified_split"] = f"""WITH {_quotas.format(size='ceil(total * 0.2)')} SELECT toxic, true AS is_holdout, q AS n, q AS ids FROM quota
UNION ALL SELECT toxic, false, n - q, n - q FROM quota"""
ORACLES["kfold"] = """SELECT toxic, CAST(f AS INT) AS fold, n // 5 + CAST(f < n % 5 AS INT) AS n, n // 5 + CAST(f < n % 5 AS INT) AS ids
FROM (SELECT toxic, count(*) AS n FROM labels GROUP BY toxic), range(5) r(f)"""
ORACLES["undersample"] = """WITH c AS (SELECT count(*) FILTER (toxic = 1) AS p, count(*) FILTER (toxic = 0) AS q FROM labels)
SELECT 1 AS toxic, p AS n, p AS ids FROM c
UNION ALL SELECT 0, CAST(least(q, floor(p / 0.7)) AS BIGINT), CAST(least(q, floor(p / 0.7)) AS BIGINT) FROM c"""
ORACLES["random_sample"] = "SELECT least(count(*), 50) AS n, least(count(*), 50) AS ids FROM labels"
ORACLES["class_weights"] = f"""SELECT count(*) FILTER (toxic = 1) AS positives, count(*) FILTER (toxic <> 1) AS negatives,
{rounded("count(*) FILTER (toxic <> 1) / greatest(count(*) FILTER (toxic = 1), 1)::DOUBLE", "ratio")} FROM labels"""
ORACLES["balanced_class_weights"] = f"""SELECT toxic, {rounded("(SELECT count(*) FROM labels) / (2.0 * count(*))", "class_weight")}, count(*) AS n
FROM labels GROUP BY toxic"""

# ---- neighbours and rebalancing -----------------------------------------------------------------

_vectors = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST(label = 3 AS INT) AS minority FROM embeddings)"""


def _near(k: int) -> str:
    return f"""pairs AS (SELECT a.vec_id, a.minority AS mine, b.vec_id AS near_id, b.minority AS other, list_distance(a.e, b.e) AS distance
FROM v a JOIN v b ON a.vec_id <> b.vec_id),
near AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, near_id) AS place FROM pairs QUALIFY place <= {k})"""


ORACLES["knn_join"] = f"""WITH {_vectors}, {_near(5)} SELECT vec_id, CAST(place AS INT) AS place, near_id, {rounded("distance", "distance")} FROM near"""
ORACLES["border_points"] = f"""WITH {_vectors}, {_near(10)} SELECT vec_id AS id FROM near WHERE mine = 1 GROUP BY vec_id
HAVING sum(1 - other) >= 5 AND sum(1 - other) < 10"""
_class_rows = """SELECT minority, false AS synthetic, count(*) AS n, min(len(e)) AS width FROM v GROUP BY minority"""
_raised = "CAST(floor(0.3 * count(*) FILTER (minority = 0)) - count(*) FILTER (minority = 1) AS BIGINT)"
_smote = f"{_class_rows} UNION ALL SELECT 1, true, {_raised}, 64 FROM v"
ORACLES["smote_rows"] = f"WITH {_vectors} {_smote}"
ORACLES["borderline_smote_rows"] = f"WITH {_vectors} {_smote}"
ORACLES["adasyn_rows"] = f"""WITH {_vectors}, {_near(5)}, share AS (SELECT vec_id, sum(1 - other) / 5.0 AS r FROM near WHERE mine = 1 GROUP BY vec_id),
need AS (SELECT {_raised} AS n FROM v)
{_class_rows} UNION ALL SELECT 1, true, CAST(sum(round_even(r / (SELECT sum(r) FROM share) * (SELECT n FROM need), 0)) AS BIGINT), 64 FROM share"""
for _name in ("smote", "borderline_smote", "adasyn"):  # all synthetic rows lie between a base and one of its neighbours
    _made = ORACLES[f"{_name}_rows"]
    ORACLES[f"{_name}_segments"] = f"SELECT CAST(n AS BIGINT) AS synthetic, CAST(n AS BIGINT) AS between, CAST(n AS BIGINT) AS near FROM ({_made}) WHERE synthetic"
ORACLES["knn_index_recall"] = """SELECT count(*) FILTER (vec_id % 100 = 0) AS queries, count(*) FILTER (vec_id % 100 = 0) * least(5, count(*) - 1) AS neighbours,
TRUE AS recall_reached FROM embeddings"""
ORACLES["smote_under_rows"] = f"""WITH {_vectors}, k AS (SELECT {_raised} AS made, count(*) FILTER (minority = 1) AS p FROM v)
SELECT 1 AS minority, false AS synthetic, p AS n, 64 AS width FROM k UNION ALL SELECT 1, true, made, 64 FROM k
UNION ALL SELECT 0, false, CAST(floor((p + made) / 0.7) AS BIGINT), 64 FROM k"""

# ---- models and streams -------------------------------------------------------------------------

ORACLES["linear_shap_values"] = f"""WITH m AS (SELECT avg(c_acctbal) AS a, avg(c_nationkey) AS b FROM customer)
SELECT c_custkey AS client_id, 'c_acctbal' AS source_feature, {rounded("0.001 * (c_acctbal - a)", "shap_value")} FROM customer, m
UNION ALL SELECT c_custkey, 'c_nationkey', {rounded("-0.25 * (c_nationkey - b)", "shap_value")} FROM customer, m"""
ORACLES["stream_kpis"] = f"""WITH {CALLS}, w AS (SELECT *, date_trunc('hour', created_at) AS window_start FROM calls)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, path, count(*) AS total_calls,
count(*) FILTER (status_code >= 400) AS error_calls, {rounded("count(*) FILTER (status_code >= 400) / count(*)::DOUBLE", "error_rate")},
{rounded("coalesce(avg(latency_ms), 0)", "latency_mean_ms")}, {rounded("coalesce(max(latency_ms), 0)", "latency_max_ms")},
{rounded("quantile_cont(latency_ms, 0.5)", "latency_p50_ms")}, {rounded("quantile_cont(latency_ms, 0.95)", "latency_p95_ms")},
{rounded("quantile_cont(latency_ms, 0.99)", "latency_p99_ms")}
FROM w GROUP BY window_start, path"""
ORACLES["stream_counts"] = f"WITH {CALLS} SELECT status_code, count(*) AS count FROM calls GROUP BY status_code"
ORACLES["stream_dedup"] = "SELECT event_id AS request_id, event_type FROM events"
ORACLES["stream_scoring"] = """SELECT CASE WHEN c_custkey % 10 = 0 THEN 422 ELSE 200 END AS status_code, '/predict' AS path, count(*) AS calls,
count(*) FILTER (c_custkey % 10 = 0) AS payloads, count(*) FILTER (c_custkey % 10 <> 0) AS scored,
CAST(sum(c_custkey % 100) AS DOUBLE) AS latency_total FROM customer GROUP BY ALL"""

_clients = """clients AS (SELECT c_custkey, CAST(c_acctbal < 1500 AND coalesce(f, 0) > 0.2 AS INT) AS TARGET FROM customer LEFT JOIN
(SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS f FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""
ORACLES["oof_coverage"] = f"""WITH {_clients} SELECT TARGET, count(*) AS predictions, count(*) AS clients, count(*) AS valid
FROM clients GROUP BY TARGET"""
ORACLES["selection_recomputed"] = "SELECT count(*) AS predictions, TRUE AS threshold_is_cheapest, TRUE AS counts_follow, TRUE AS cost_follows FROM customer"
ORACLES["batch_score_coverage"] = "SELECT count(*) AS scored, count(*) AS clients, count(*) AS consistent FROM customer"
ORACLES["boosting_smote"] = """SELECT 'boosting_shallow__smote' AS model_name, 'smote' AS sampling_strategy, count(*) AS predictions,
count(*) AS clients FROM customer"""
_cells = f"""{_clients}, cells AS (SELECT clients.c_custkey, TARGET AS y, n AS n_orders, floor(c_acctbal / 100) AS balance,
CAST(c_nationkey AS DOUBLE) AS nation FROM clients JOIN customer USING (c_custkey) LEFT JOIN
(SELECT o_custkey, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""
# Gradients and second derivatives of the logistic loss at the common share of ones, in whole units of 2 ** -24.
ORACLES["boosting_split_gains"] = f"""WITH {_cells}, long AS (
  SELECT 'n_orders' AS feature, n_orders AS v, y FROM cells UNION ALL SELECT 'balance', balance, y FROM cells UNION ALL SELECT 'nation', nation, y FROM cells
), p AS (SELECT avg(y) AS p FROM cells), graded AS (
  SELECT feature, v, CAST(round((p - y) * 16777216) AS BIGINT) AS g, CAST(round(p * (1 - p) * 16777216) AS BIGINT) AS h FROM long, p
), absent AS (
  SELECT feature, coalesce(sum(g) FILTER (v IS NULL), 0) AS mg, coalesce(sum(h) FILTER (v IS NULL), 0) AS mh, count(*) FILTER (v IS NULL) AS mn,
  sum(g) AS tg, sum(h) AS th, count(*) AS tn, max(v) AS top FROM graded GROUP BY feature
), below AS (
  SELECT DISTINCT feature, v, sum(g) OVER w AS g, sum(h) OVER w AS h, count(*) OVER w AS n FROM graded WHERE v IS NOT NULL
  WINDOW w AS (PARTITION BY feature ORDER BY v)
), sides AS (
  SELECT feature, v, side, g + side * mg AS lg, h + side * mh AS lh, n + side * mn AS ln, tg, th, tn, top
  FROM below JOIN absent USING (feature), (VALUES (0), (1)) AS s(side)
), gains AS (
  SELECT *, (lg / 16777216.0) * (lg / 16777216.0) / (lh / 16777216.0) + ((tg - lg) / 16777216.0) * ((tg - lg) / 16777216.0) / ((th - lh) / 16777216.0)
  - (tg / 16777216.0) * (tg / 16777216.0) / (th / 16777216.0) AS gain FROM sides
  WHERE ln >= 20 AND tn - ln >= 20 AND lh >= 16777.216 AND th - lh >= 16777.216
), best AS (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gain DESC, side, v) AS place FROM gains
)
SELECT feature, CASE WHEN v < top THEN v END AS threshold, side = 1 AS missing_left, {rounded("gain", "gain", 4)}, ln AS left_rows
FROM best WHERE place = 1 AND gain > 1e-9"""
ORACLES["perceptron_grid"] = "SELECT unnest([0, 1, 2, 3]) AS setting, count(*) AS clients, count(*) AS valid, TRUE AS stopped FROM customer"
ORACLES["tree_shap_additivity"] = "SELECT c_custkey AS client_id, TRUE AS additive, TRUE AS base_is_mean FROM customer"
# All eight sets of known features; an unknown one splits a client in the shares of all clients that reach the node.
ORACLES["tree_shap_values"] = f"""WITH {_cells}, told AS (
  SELECT c_custkey, CAST(coalesce(n_orders <= 10, TRUE) AS INT) AS o10, CAST(coalesce(n_orders <= 20, TRUE) AS INT) AS o20,
  CAST(balance <= 20 AS INT) AS b20, CAST(balance <= 50 AS INT) AS b50, CAST(nation <= 12 AS INT) AS n12 FROM cells
), shares AS (
  SELECT avg(o10) AS so, avg(b20) FILTER (o10 = 1) AS sb, avg(n12) FILTER (o10 = 0) AS sn, avg(b50) AS sb50, avg(o20) FILTER (b50 = 0) AS so20 FROM told
), known AS (
  SELECT * FROM (VALUES (0), (1)) AS x(ko), (VALUES (0), (1)) AS y(kb), (VALUES (0), (1)) AS z(kn)
), chances AS (
  SELECT c_custkey, ko, kb, kn, CASE ko WHEN 1 THEN o10 ELSE so END AS po, CASE kb WHEN 1 THEN b20 ELSE coalesce(sb, 0.5) END AS pb,
  CASE kn WHEN 1 THEN n12 ELSE coalesce(sn, 0.5) END AS pn, CASE kb WHEN 1 THEN b50 ELSE sb50 END AS qb, CASE ko WHEN 1 THEN o20 ELSE coalesce(so20, 0.5) END AS qo
  FROM told, shares, known
), game AS (
  SELECT c_custkey, ko, kb, kn, CASE ko + kb + kn WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 2 END / 6.0 AS w_out,
  CASE ko + kb + kn WHEN 1 THEN 2 WHEN 2 THEN 1 WHEN 3 THEN 2 END / 6.0 AS w_in,
  po * (pb * 0.1 + (1 - pb) * -0.2) + (1 - po) * (pn * 0.3 + (1 - pn) * -0.1) + qb * 0.05 + (1 - qb) * (qo * -0.3 + (1 - qo) * 0.2) AS v FROM chances
), sums AS (
  SELECT c_custkey, sum(CASE ko WHEN 1 THEN w_in ELSE -w_out END * v) AS n_orders, sum(CASE kb WHEN 1 THEN w_in ELSE -w_out END * v) AS balance,
  sum(CASE kn WHEN 1 THEN w_in ELSE -w_out END * v) AS nation, sum(v) FILTER (ko + kb + kn = 0) AS base FROM game GROUP BY c_custkey
)
SELECT c_custkey AS client_id, source_feature, {rounded("shap_value", "shap_value")}, {rounded("base", "base_value")}
FROM (UNPIVOT sums ON n_orders, balance, nation INTO NAME source_feature VALUE shap_value)"""
ORACLES["shap_additivity"] = "SELECT 6 AS clients, 6 AS additive, TRUE AS one_base"

# ---- report views -----------------------------------------------------------------------------------
_placed = f"""placed AS (SELECT *, CAST(row_number() OVER (ORDER BY cv_business_cost, cv_average_precision DESC, cv_roc_auc DESC, model_name) AS INT) AS rank,
model_name AS model, base_model_name AS base_model, sampling_strategy AS sampling FROM ({plain(views.RESULTS).replace("{{}}", "{}")}))"""
_who = "rank = 1 AS selected_as_best, model, base_model, sampling"
_matrix = "true_negatives, false_positives, false_negatives, true_positives"
ORACLES["report_cv"] = f"""WITH {_placed} SELECT {_who}, threshold, cv_business_cost, cv_roc_auc, cv_average_precision, cv_accuracy,
cv_balanced_accuracy, oof_roc_auc, oof_average_precision, oof_precision, oof_recall, oof_f1, oof_accuracy, oof_balanced_accuracy,
best_params, run_id FROM placed"""
ORACLES["report_holdout"] = f"""WITH {_placed} SELECT {_who}, threshold, holdout_business_cost, holdout_business_score, holdout_roc_auc,
holdout_average_precision, holdout_accuracy, holdout_balanced_accuracy, holdout_precision, holdout_recall, holdout_f1,
holdout_brier_score, holdout_ks_statistic, {_matrix}, best_params, run_id FROM placed"""
ORACLES["report_threshold"] = f"""WITH {_placed} SELECT {_who}, 'out_of_fold_business_cost_minimization' AS selection_basis, threshold,
holdout_business_cost, holdout_business_score, holdout_precision, holdout_recall, holdout_f1, {_matrix}, run_id FROM placed"""
ORACLES["report_performance"] = f"""WITH {_placed} SELECT rank, {_who},
CASE base_model WHEN 'base0' THEN 'linear' WHEN 'base1' THEN 'boosting_tree' ELSE 'other' END AS family,
CASE base_model WHEN 'base0' THEN 'LogisticRegression' WHEN 'base1' THEN 'GBTClassifier' END AS estimator_class,
'cv_business_cost_optimized' AS strategie_seuil, {", ".join(rounded(c, c) for c in ("threshold", "holdout_business_cost",
"holdout_business_score", "cv_business_cost", "cv_roc_auc", "cv_average_precision"))},
{rounded("holdout_precision", "precision_1")}, {rounded("holdout_recall", "recall_1")}, {rounded("holdout_f1", "f1_1")},
{rounded("CASE WHEN 4 * holdout_precision + holdout_recall = 0 THEN 0 ELSE 5 * holdout_precision * holdout_recall / (4 * holdout_precision + holdout_recall) END", "f2_1")},
{rounded("holdout_average_precision", "prc_auc")}, {rounded("oof_precision", "train_precision_1")},
{rounded("oof_recall", "train_recall_1")}, {rounded("oof_f1", "train_f1_1")},
{rounded("CASE WHEN 4 * oof_precision + oof_recall = 0 THEN 0 ELSE 5 * oof_precision * oof_recall / (4 * oof_precision + oof_recall) END", "train_f2_1")},
{rounded("oof_average_precision", "train_prc_auc")}, true_negatives AS tn, false_positives AS fp, false_negatives AS fn,
true_positives AS tp, best_params, run_id FROM placed"""
ORACLES["report_best"] = f"WITH {_placed} SELECT model, rank, TRUE AS selected_as_best, {rounded('threshold', 'threshold')} FROM placed WHERE rank = 1"
ORACLES["report_runs"] = f"""WITH {_placed} SELECT 'campaign' AS scope, 'Spring run' AS campaign_name, '' AS model, '' AS base_model,
'' AS sampling, 'root' AS run_id, FALSE AS selected_as_best, CAST(NULL AS DOUBLE) AS threshold,
CAST(NULL AS DOUBLE) AS holdout_business_cost, CAST(NULL AS DOUBLE) AS holdout_roc_auc
UNION ALL SELECT 'model', 'Spring run', model, base_model, sampling, coalesce(run_id, ''), rank = 1, threshold,
holdout_business_cost, holdout_roc_auc FROM placed"""
