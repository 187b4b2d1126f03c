"""Registered queries: every operator run over the whole given tables.

Roles: customer = client, orders = loan, lineitem = instalment or scored row, events = call log,
documents and labels = labelled rows, embeddings = feature vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import capitalize_label, f_beta, slugify
from riskloom.functions.payload import flatten_json, payload_object
from riskloom.operators import association, drift, fairness, oplogs, profiling, sampling, scorecurve
from riskloom.operators.aggregates import Subset, aggregate_by, category_levels, share_rows
from riskloom.operators.cleaning import category_columns, clean_applications, split_by_label, union_train_test
from riskloom.operators.decisions import decide
from riskloom.operators.explain import extreme_clients
from riskloom.operators.features import (
    bureau_features,
    card_features,
    instalment_features,
    join_coverage,
    join_features,
    pos_features,
    previous_features,
)
from riskloom.operators.imputation import fill_values, impute, repair_ranges
from riskloom.operators.leaderboard import family, ranked
from riskloom.operators.neighbors import nearest_neighbors
from riskloom.operators.rebalance import adasyn, borderline_smote, danger_points, rebalance, smote
from riskloom.operators.validation import RequestField, parse_requests, validate_rows
from riskloom.plans import views
from riskloom.session import scratch_path
from riskloom.settings import CostModel
from riskloom.sources import logs
from riskloom.sources.documents import key_values, latest_by_name
from riskloom.sources.tables import (
    duplicate_count,
    file_inventory,
    load_raw,
    read_table,
    sort_for_write,
    write_json_lines,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A derived view from ``views``; the text names its tables in braces."""
    used = [t for t in views.TABLES if f"{{{t}}}" in text]
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round away summation-order noise so results compare across engines."""
    doubles = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(F.col(f"`{c}`").cast("double"), digits) + 0.0 for c in doubles})


# ---- features ---------------------------------------------------------------------------------

ORDER_SPEC = {
    "O_TOTAL_CENTS": ["min", "max", "mean", "sum"],
    "LI_L_QUANTITY_SUM": ["max", "mean", "sum"],
    "LI_L_LINENUMBER_MAX": ["max", "mean"],
}
LINE_SPEC = {
    "L_QUANTITY": ["sum", "mean"],
    "L_LINENUMBER": ["max", "size"],
}
ORDER_SUBSETS = [
    Subset("OPEN", "o_orderstatus", "O", {
        "O_TOTAL_CENTS": ["sum", "mean"],
    }),
    Subset("FINISHED", "o_orderstatus", "F", {
        "O_TOTAL_CENTS": ["sum", "max", "mean"],
    }),
]


def _orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = aggregate_by(table(spark, sf, "lineitem"), "l_orderkey", prefix="LI", spec=LINE_SPEC)
    orders = table(spark, sf, "orders").withColumn("O_TOTAL_CENTS", F.round(F.col("o_totalprice") * 100))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")


@query
def client_features(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: customers left-joined with their order features, which include line-item aggregates."""
    loans = _orders_with_lines(spark, sf)
    per_client = aggregate_by(
        loans, "o_custkey", prefix="ORD", spec=ORDER_SPEC,
        extra=[F.count("*").cast("int").alias("ORD_COUNT")],
    ).withColumnRenamed("o_custkey", "c_custkey")
    clients = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return join_features(clients, {"orders": per_client}, "c_custkey")


@query
def client_features_subset(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("O_TOTAL_CENTS", F.round(F.col("o_totalprice") * 100))
    return aggregate_by(orders, "o_custkey", prefix="ORD", subsets=ORDER_SUBSETS)


@query
def onehot_share(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    levels = category_levels(orders, ["o_orderstatus"])
    return aggregate_by(orders, "o_custkey", prefix="ORD", levels=levels)


def _levels(df: DataFrame) -> dict[str, list[str]]:
    return category_levels(df, category_columns(df))


@query
def share_rows_long(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(share_rows(table(spark, sf, "orders"), "o_custkey", ["o_orderstatus", "o_orderpriority"]))


@query
def bureau_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    loans = view(spark, sf, views.BUREAU)
    return tidy(bureau_features(loans, view(spark, sf, views.BUREAU_BALANCE), _levels(loans)), 4)


@query
def previous_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, views.PREVIOUS)
    return tidy(previous_features(rows, _levels(rows)), 5)


@query
def pos_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, views.POS)
    return tidy(pos_features(rows, _levels(rows)), 5)


@query
def instalment_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(instalment_features(view(spark, sf, views.INSTALMENTS)), 5)


@query
def card_feature_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = view(spark, sf, views.CARDS)
    return tidy(card_features(rows, _levels(rows)), 5)


@query
def row_features(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean_applications(view(spark, sf, views.APPLICATIONS))
    return tidy(cleaned.select(
        "SK_ID_CURR", "AGE_YEARS", "EMPLOYED_YEARS", "EMPLOYED_TO_AGE_RATIO", "CREDIT_TO_INCOME_RATIO",
        "ANNUITY_TO_INCOME_RATIO", "CREDIT_TO_ANNUITY_RATIO", "GOODS_TO_CREDIT_RATIO", "INCOME_PER_PERSON",
        "ANNUITY_PER_PERSON", "CHILDREN_RATIO",
    ))


@query
def rowwise_stats(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean_applications(view(spark, sf, views.APPLICATIONS))
    return tidy(cleaned.select(
        "SK_ID_CURR", "EXT_SOURCES_MEAN", "EXT_SOURCES_STD", "EXT_SOURCES_MIN", "EXT_SOURCES_MAX",
        "EXT_SOURCES_NA_COUNT", "DOCUMENT_COUNT", "PHONE_FLAG_COUNT", "ADDRESS_MISMATCH_COUNT",
    ))


@query
def sentinel_clean(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = clean_applications(view(spark, sf, views.APPLICATIONS))
    return cleaned.select("SK_ID_CURR", "DAYS_EMPLOYED", "DAYS_EMPLOYED_ANOM", "CODE_GENDER")


def _split_clients(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    clients = table(spark, sf, "customer").withColumn("TARGET", (F.col("c_acctbal") < 0).cast("int"))
    even = F.col("c_custkey") % 2 == 0
    return clients.filter(even), clients.filter(~even).drop("TARGET")


@query
def union_train_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split_clients(spark, sf)
    labelled, unlabelled = split_by_label(union_train_test(train, test))
    return labelled.unionByName(unlabelled, allowMissingColumns=True)


@query
def join_coverage_report(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _split_clients(spark, sf)
    orders = table(spark, sf, "orders")
    recent = orders.filter(F.col("o_orderdate") >= "2001-01-01")
    frames = {
        name: df.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count("*").alias(f"{name}_n"), F.max("o_totalprice").alias(f"{name}_max")
        )
        for name, df in {"orders": orders, "recent_orders": recent}.items()
    }
    joined = join_features(union_train_test(train, test), frames, "c_custkey")
    return tidy(join_coverage(joined, frames, key="c_custkey"))


@query
def dedup_exact(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_count(table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_tax"))


# ---- sources and sinks --------------------------------------------------------------------------

@query
def raw_csv_load(spark: SparkSession, sf: str) -> DataFrame:
    """Bureau rows, every third one twice, written as CSV, then read with schema, NULL tokens and dedup."""
    folder = scratch_path(spark, "raw")
    loans = view(spark, sf, views.BUREAU)
    repeated = loans.unionByName(loans.filter(F.col("SK_ID_BUREAU") % 3 == 0))
    write_table(repeated, f"{folder}/bureau.csv")
    loaded, removed = load_raw(spark, folder, "bureau.csv")
    return loaded.select("SK_ID_CURR", "SK_ID_BUREAU", "CREDIT_ACTIVE", "AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT").withColumn(
        "duplicates_removed", removed.select("duplicates_removed").scalar()
    )


@query
def raw_file_overview(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "overview")
    for name, text in {"bureau.csv": views.BUREAU, "bureau_balance.csv": views.BUREAU_BALANCE}.items():
        write_table(view(spark, sf, text), f"{folder}/{name}")
    overview = profiling.raw_overview(spark, folder, ["bureau.csv", "bureau_balance.csv"])
    parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).agg(F.sum("length")).first()[0]
    whole = F.abs(F.sum("file_size_mb").over(Window.partitionBy()) - parts / 1024 / 1024) < 0.02
    return overview.withColumn("size_is_whole", (F.col("file_size_mb") > 0) & whole).drop("file_size_mb")


@query
def table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{scratch_path(spark, 'table')}/clients.parquet"
    write_table(sort_for_write(table(spark, sf, "customer"), "c_custkey"), path)
    return read_table(spark, path)


@query
def json_lines_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    calls = _calls(spark, sf).select(F.col("id").alias("request_index"), "status_code", "latency_ms")
    write_json_lines(calls, path)
    return spark.read.schema("request_index BIGINT, status_code INT, latency_ms DOUBLE").json(path)


@query
def file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Inventory of all tables; each size is held against the sum of its part files' lengths, listed table by table."""
    folder = sf.rstrip("/")
    sizes = file_inventory(spark, f"{folder}/*.parquet")
    listed = None
    for name in views.TABLES:
        parts = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/{name}.parquet")
        one = parts.agg(F.sum("length").alias("bytes"), F.count("*").alias("parts")).withColumn("table_name", F.lit(f"{name}.parquet"))
        listed = one if listed is None else listed.unionByName(one)
    joined = sizes.join(listed, "table_name", "left")
    whole = (F.col("parts") > 0) & (F.col("file_size_mb") == F.round(F.col("bytes") / F.lit(1024 * 1024), 2))
    return joined.select("table_name", F.coalesce(whole, F.lit(False)).alias("size_is_whole"))


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.CALLS)


def _predictions(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.PREDICTIONS)


@query
def log_store(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions appended as three log tables, read back flattened: snapshot and stored output side by side."""
    root = scratch_path(spark, "logs")
    scored = decide(_predictions(spark, sf), probability="default_probability", threshold=0.22).select(
        F.col("id").cast("string").alias("request_id"), "request_payload", "default_probability",
        "business_threshold", "predicted_default", "credit_decision", "latency_ms", "created_at",
    )
    logs.append_logs(logs.prediction_log_rows(scored), root)
    inputs = logs.load_production_inputs(spark, root, "k INT").select("prediction_log_id", "feature_count", "k")
    outputs = logs.load_production_outputs(spark, root).select(
        "prediction_log_id", "default_probability", "predicted_default", "credit_decision", "latency_ms"
    )
    return inputs.join(outputs, "prediction_log_id").drop("prediction_log_id")


@query
def call_log(spark: SparkSession, sf: str) -> DataFrame:
    """Call log rows: error type, reason and payload for failed calls only."""
    calls = _calls(spark, sf).withColumns({"request_id": F.col("id").cast("string"), "method": F.lit("POST")})
    rows = logs.api_call_rows(calls.withColumn("error_message", F.concat(F.lit("failed: "), F.repeat("path", 100))))
    return rows.select("method", "path", "status_code", "latency_ms", "request_payload", "error_type", "error_message")


# ---- profiling and association ----------------------------------------------------------------

@query
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    gaps = view(spark, sf, views.GAPS)
    return tidy(profiling.table_profile(gaps, "orders", keys=["o_orderkey", "o_custkey"], duplicates_removed=0))


@query
def missingness(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.missingness_report(view(spark, sf, views.GAPS), with_coverage=True).drop("dtype"))


@query
def schema_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.schema_summary(view(spark, sf, views.GAPS)).drop("dtype"))


@query
def numeric_describe(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    return tidy(profiling.numeric_summary(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]), 5)


@query
def categorical_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.categorical_summary(view(spark, sf, views.GAPS)))


@query
def target_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.target_distribution(view(spark, sf, views.GAPS), "o_orderstatus"))


@query
def target_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.target_correlations(view(spark, sf, views.LABELLED), "label"))


@query
def constant_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumns(
        {"one": F.lit(1), "absent": F.lit(None).cast("double"), "kept": F.lit(1)}
    )
    return profiling.constant_columns(lines, excluded=["kept"])


@query
def dataset_facts(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.dataset_metadata(view(spark, sf, views.LABELLED), target="label"))


@query
def cramers_v(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(association.cramers_v(view(spark, sf, views.LABELLED), ["l_linestatus", "band", "priority"], "label"))


@query
def signed_association(spark: SparkSession, sf: str) -> DataFrame:
    report = association.signed_associations(view(spark, sf, views.LABELLED), "label")
    return tidy(report.select("feature", "modality", "label", "method", "score", "n", "target_rate_modality", "target_rate_rest"))


@query
def feature_target_assoc(spark: SparkSession, sf: str) -> DataFrame:
    report = association.feature_target_associations(view(spark, sf, views.LABELLED), "label")
    return tidy(association.strongest(report, 5).select("feature", "feature_label", "type_feature", "method", "score", "score_abs"))


# ---- scores -----------------------------------------------------------------------------------

def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.SCORED)


@query
def business_cost(spark: SparkSession, sf: str) -> DataFrame:
    decided = _scored(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return tidy(scorecurve.business_cost(decided, label="label", prediction="prediction", keys=["l_linestatus"]))


@query
def evaluate_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(scorecurve.evaluate_threshold(_scored(spark, sf), label="label", score="score", threshold=0.35))


@query
def auc_ap_ks_brier(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(scorecurve.ranking_metrics(_scored(spark, sf), label="label", score="score", keys=["l_linestatus"]))


@query
def roc_points(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(scorecurve.curve_points(_scored(spark, sf), label="label", score="score"))


@query
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(scorecurve.threshold_sweep(_scored(spark, sf), label="label", score="score", extra_thresholds=[0.3333]))


@query
def best_threshold(spark: SparkSession, sf: str) -> DataFrame:
    cost = CostModel(fn_cost=2.0)
    return tidy(scorecurve.best_threshold(_scored(spark, sf), label="label", score="score", cost=cost, keys=["l_linestatus"]))


@query
def threshold_selection(spark: SparkSession, sf: str) -> DataFrame:
    rows = _scored(spark, sf)
    return tidy(scorecurve.threshold_selection_summary(
        rows.filter("l_linenumber <> 1"), rows.filter("l_linenumber = 1"), label="label", score="score",
        selected=0.35, model_name="by_line",
    ))


@query
def leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Every line number as a candidate: cost at its best threshold, rank and F2."""
    best = scorecurve.best_threshold(
        _scored(spark, sf), label="label", score="score", keys=["l_linenumber"], cost=CostModel(fn_cost=2.0)
    )
    named = best.select(
        F.concat(F.lit("RandomForest_"), F.col("l_linenumber").cast("string")).alias("model"),
        F.col("business_cost").alias("cv_business_cost"), F.col("average_precision").alias("cv_average_precision"),
        F.col("roc_auc").alias("cv_roc_auc"), f_beta("precision", "recall").alias("f2"),
    )
    placed = ranked(named.withColumn("model_name", F.col("model"))).drop("model_name")
    return tidy(placed.withColumn("family", family("model")))


@query
def decision(spark: SparkSession, sf: str) -> DataFrame:
    decided = decide(_predictions(spark, sf).drop("credit_decision"), probability="default_probability", threshold=0.22)
    return decided.select("id", "default_probability", "business_threshold", "predicted_default", "credit_decision")


# ---- fairness ---------------------------------------------------------------------------------

def _decided(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.DECIDED)


@query
def fairness_table(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(fairness.fairness_table(_decided(spark, sf), group="segment"))


@query
def disparity(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(fairness.disparity_summary(fairness.fairness_table(_decided(spark, sf), group="segment")))


@query
def fairness_summary(spark: SparkSession, sf: str) -> DataFrame:
    report = fairness.fairness_report(_decided(spark, sf), gender="segment", age="age")
    return tidy(report["fairness_summary"])


@query
def age_bands(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", fairness.age_band("p_size").alias("band"))


@query
def enrich_sensitive(spark: SparkSession, sf: str) -> DataFrame:
    predictions = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    attributes = table(spark, sf, "customer").filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment")
    kept = fairness.enrich_predictions(predictions, attributes, "c_custkey")
    lost = fairness.lost_predictions(predictions, attributes, "c_custkey")
    return kept.unionByName(lost, allowMissingColumns=True)


# ---- drift ------------------------------------------------------------------------------------

def _periods(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = view(spark, sf, views.PERIODS)
    return rows.filter("NOT is_current").drop("is_current"), rows.filter("is_current").drop("is_current")


@query
def numeric_drift(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.numeric_drift(*_periods(spark, sf)))


@query
def ks_small_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers of the first nations against the others: samples small enough for exact p-values."""
    suppliers = table(spark, sf, "supplier").select(
        "s_nationkey", F.floor("s_acctbal").cast("double").alias("balance"), (F.col("s_suppkey") % 7).cast("double").alias("week")
    )
    sides = [suppliers.filter(side).drop("s_nationkey") for side in ("s_nationkey < 12", "s_nationkey >= 12")]
    return tidy(drift.numeric_drift(*sides).select("feature", "ks_statistic", "ks_pvalue", "current_rows"))


@query
def categorical_drift(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.categorical_drift(*_periods(spark, sf)))


@query
def drift_summary(spark: SparkSession, sf: str) -> DataFrame:
    reference, current = _periods(spark, sf)
    everything = drift.all_drift(drift.numeric_drift(reference, current), drift.categorical_drift(reference, current))
    return tidy(drift.drift_summary(everything))


@query
def top_drift(spark: SparkSession, sf: str) -> DataFrame:
    reference, current = _periods(spark, sf)
    everything = drift.all_drift(drift.numeric_drift(reference, current), drift.categorical_drift(reference, current))
    return tidy(drift.strongest_drift(everything, 3).select("feature", "feature_type", "psi", "drift_level"))


@query
def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.histogram(table(spark, sf, "events"), "value", bins=30))


# ---- operations -------------------------------------------------------------------------------

@query
def api_call_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(oplogs.api_call_summary(_calls(spark, sf)))


@query
def latency_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(oplogs.latency_summary(_calls(spark, sf), source="api"))


@query
def latency_by_path(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(oplogs.latency_by_path(_calls(spark, sf)))


@query
def status_codes(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(oplogs.status_code_summary(_calls(spark, sf)))


@query
def prediction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(oplogs.prediction_summary(_predictions(spark, sf)))


@query
def measurement_summary(spark: SparkSession, sf: str) -> DataFrame:
    measured = _calls(spark, sf).select(
        (F.col("status_code") < 400).alias("success"), F.col("latency_ms").alias("client_latency_ms")
    )
    return tidy(oplogs.measurement_summary(measured))


@query
def monitoring_summary(spark: SparkSession, sf: str) -> DataFrame:
    """One summary row; the two count maps as rows next to it."""
    summary = oplogs.monitoring_summary(_calls(spark, sf), _predictions(spark, sf))
    maps = F.map_concat("status_code_counts", "decision_counts")
    return tidy(summary.select(
        "total_api_calls", "predict_calls", "error_rate", "latency_p95_ms", "refused_rate", F.explode(maps).alias("counted", "n")
    ))


@query
def alerts(spark: SparkSession, sf: str) -> DataFrame:
    summary = oplogs.api_call_summary(_calls(spark, sf))
    return tidy(oplogs.operational_alerts(summary, latency_warning_ms=100.0, error_rate_warning=0.05))


@query
def bottlenecks(spark: SparkSession, sf: str) -> DataFrame:
    calls = _calls(spark, sf)
    model = oplogs.latency_summary(calls.filter("path = '/predict'"), source="model")
    return oplogs.bottlenecks(
        oplogs.api_call_summary(calls), model, latency_warning_ms=100.0, error_rate_warning=0.05
    )


@query
def fk_integrity(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 2).alias("prediction_log_id"))
    return oplogs.fk_violations(lines, table(spark, sf, "orders").select(F.col("o_orderkey").alias("id")))


@query
def latest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return oplogs.latest_rows(_calls(spark, sf), 50, ties=["id"]).select("id", "path", "created_at")


@query
def latest_event_by_type(spark: SparkSession, sf: str) -> DataFrame:
    calls = _calls(spark, sf).select("path", "id", "created_at", "latency_ms")
    return latest_by_name(calls, name="path", order="created_at", ties="id")


@query
def risk_extremes(spark: SparkSession, sf: str) -> DataFrame:
    clients = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return extreme_clients(clients, 5, id_column="c_custkey", probability="c_acctbal")


# ---- payloads and text --------------------------------------------------------------------------

@query
def flatten_payload(spark: SparkSession, sf: str) -> DataFrame:
    return flatten_json(table(spark, sf, "events"), "props", keep=["event_id"])


@query
def json_key_values(spark: SparkSession, sf: str) -> DataFrame:
    return key_values(table(spark, sf, "events"), "props", keep=("event_id",))


@query
def payload_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' texts, an object and a number per document as payload cells."""
    docs = table(spark, sf, "documents")
    cells = {
        "text": F.col("text"), "object": F.to_json(F.struct("n_chars", "lang")), "number": F.col("n_chars").cast("string"),
    }
    parts = [docs.select("doc_id", F.lit(kind).alias("kind"), payload_object(cell).alias("payload")) for kind, cell in cells.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def most_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(profiling.most_missing(view(spark, sf, views.PREVIOUS), 5).select("column", "missing_ratio", "missing_count"))


@query
def text_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey", slugify(F.concat(F.lit("  "), "p_name", F.lit(" "), "p_brand", F.lit("!"))).alias("slug"),
        capitalize_label(F.concat("p_type", F.lit("_"), "p_name")).alias("label"),
    )


# ---- validation and repair ----------------------------------------------------------------------

@query
def validate_clients(spark: SparkSession, sf: str) -> DataFrame:
    checked = validate_rows(view(spark, sf, views.REQUESTS))
    return checked.select("SK_ID_CURR", F.concat_ws("|", "violations").alias("violations"))


@query
def validate_requests(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 == 0, F.col("event_type")).otherwise(F.col("props")).alias("request_payload")
    )
    fields = [RequestField("k", "int"), RequestField("note", "string", required=False)]
    parsed = parse_requests(rows, fields, rules=())
    return parsed.select("event_id", "k", F.concat_ws("|", "violations").alias("violations"))


@query
def repair_clients(spark: SparkSession, sf: str) -> DataFrame:
    fixed = repair_ranges(view(spark, sf, views.REQUESTS))
    return fixed.select(
        "SK_ID_CURR", "AGE_YEARS", "AMT_INCOME_TOTAL", "AMT_CREDIT", "CNT_CHILDREN", "CNT_FAM_MEMBERS",
        "HOUR_APPR_PROCESS_START", "REGION_RATING_CLIENT", "FLAG_MOBIL", "EXT_SOURCE_1",
    )


@query
def median_mode_impute(spark: SparkSession, sf: str) -> DataFrame:
    gaps = view(spark, sf, views.GAPS).select("o_orderkey", "o_totalprice", "o_orderstatus")
    return impute(gaps, fill_values(gaps.drop("o_orderkey")))


# ---- sampling: class sizes of exact draws -------------------------------------------------------

def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels")


def _sizes(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids"))


@query
def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    drawn = sampling.stratified_sample(_labels(spark, sf), label="toxic", ids=["doc_id"], size=60)
    return _sizes(drawn, "toxic")


@query
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes(sampling.stratified_split(_labels(spark, sf), label="toxic", ids=["doc_id"]), "toxic", "is_holdout")


@query
def kfold(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes(sampling.stratified_folds(_labels(spark, sf), label="toxic", ids=["doc_id"], k=5), "toxic", "fold")


@query
def undersample(spark: SparkSession, sf: str) -> DataFrame:
    return _sizes(sampling.undersample(_labels(spark, sf), label="toxic", ids=["doc_id"]), "toxic")


@query
def random_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.random_sample(_labels(spark, sf), 50, ids=["doc_id"]).agg(
        F.count("*").alias("n"), F.count_distinct("doc_id").alias("ids")
    )


@query
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(sampling.class_weight_ratio(_labels(spark, sf), "toxic"))


@query
def balanced_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    weighted = sampling.balanced_weights(_labels(spark, sf), "toxic")
    return tidy(weighted.groupBy("toxic").agg(F.max("class_weight").alias("class_weight"), F.count("*").alias("n")))


# ---- neighbours and rebalancing -----------------------------------------------------------------

VECTORS = dict(id_column="vec_id", vector="embedding", label="minority")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").withColumn("minority", (F.col("label") == 3).cast("int")).drop("label")


@query
def knn_join(spark: SparkSession, sf: str) -> DataFrame:
    found = nearest_neighbors(_vectors(spark, sf), 5, id_column="vec_id", vector="embedding")
    near = found.select(F.col("id").alias("vec_id"), F.posexplode("neighbors").alias("place", "near"))
    return tidy(near.select("vec_id", (F.col("place") + 1).alias("place"), F.col("near.id").alias("near_id"), F.col("near.distance").alias("distance")))


@query
def knn_index_recall(spark: SparkSession, sf: str) -> DataFrame:
    """Lists of the hashed index over all vectors, for ids divisible by 100, against the exact join."""
    points = _vectors(spark, sf)
    asked = points.filter(F.col("vec_id") % 100 == 0)
    exact, found = (
        nearest_neighbors(points, 5, id_column="vec_id", vector="embedding", queries=asked, recall=recall)
        .select("id", F.posexplode("neighbors").alias("place", "m")).select("id", "place", "m.distance")
        for recall in (None, 0.95)
    )
    limit = exact.groupBy("id").agg(F.max("distance").alias("limit"), F.count("*").alias("n"))
    hits = found.join(limit, "id").groupBy("id", "n").agg(F.count_if(F.col("distance") <= F.col("limit") * (1 + 1e-9)).alias("hits"))
    return hits.agg(F.count("*").alias("queries"), F.sum("n").alias("neighbours"), (F.sum("hits") >= 0.9 * F.sum("n")).alias("recall_reached"))


def _segments(made: DataFrame, points: DataFrame) -> DataFrame:
    """Every synthetic row again: does it lie between its base and its partner, and is the partner one of the base's
    five nearest minority rows (as the exact join of its own query finds them)?"""
    minority = points.filter("minority = 1").select("vec_id", "embedding")
    base, partner = (minority.select(F.col("vec_id").alias(f"{n}_id"), F.col("embedding").cast("array<double>").alias(n)) for n in ("base", "partner"))
    near = nearest_neighbors(minority, 5, id_column="vec_id", vector="embedding").select(F.col("id").alias("base_id"), F.explode("neighbors.id").alias("partner_id"))
    rows = made.filter("synthetic").join(base, "base_id").join(partner, "partner_id").join(near.withColumn("is_near", F.lit(True)), ["base_id", "partner_id"], "left")

    def apart(a: str, b: str) -> Column:
        return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda t, v: t + v))

    rows = rows.withColumn("row", F.col("embedding").cast("array<double>"))
    between = F.abs(apart("row", "base") + apart("row", "partner") - apart("base", "partner")) < 1e-6
    return rows.agg(F.count("*").alias("synthetic"), F.count_if(between).alias("between"), F.count("is_near").alias("near"))


@query
def smote_segments(spark: SparkSession, sf: str) -> DataFrame:
    points = _vectors(spark, sf)
    return _segments(smote(points, **VECTORS, trace=True), points)


@query
def borderline_smote_segments(spark: SparkSession, sf: str) -> DataFrame:
    points = _vectors(spark, sf)
    return _segments(borderline_smote(points, **VECTORS, trace=True), points)


@query
def adasyn_segments(spark: SparkSession, sf: str) -> DataFrame:
    points = _vectors(spark, sf)
    return _segments(adasyn(points, **VECTORS, trace=True), points)


@query
def border_points(spark: SparkSession, sf: str) -> DataFrame:
    return danger_points(_vectors(spark, sf), **VECTORS)


def _class_sizes(df: DataFrame) -> DataFrame:
    """Rows per class and origin, with the vector width as a check of the synthetic rows."""
    return df.groupBy("minority", "synthetic").agg(
        F.count("*").alias("n"), F.min(F.size("embedding")).alias("width"),
    )


@query
def smote_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _class_sizes(smote(_vectors(spark, sf), **VECTORS))


@query
def borderline_smote_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _class_sizes(borderline_smote(_vectors(spark, sf), **VECTORS))


@query
def adasyn_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _class_sizes(adasyn(_vectors(spark, sf), **VECTORS))


@query
def smote_under_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _class_sizes(rebalance(_vectors(spark, sf), "smote_under", **VECTORS))


