"""Registered queries that train models or run streams over the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.payload import to_payload
from riskloom.operators import explain, leaderboard
from riskloom.operators.boosting import BoostingSettings, first_splits, margin_column, train
from riskloom.operators.decisions import batch_predictions, positive_probability
from riskloom.operators.ranking import running_totals
from riskloom.operators.tree_shap import counted_cover, shap_arrays, tree_shap
from riskloom.plans import views
from riskloom.plans.candidates import BASE_CANDIDATES, Candidate, TrainingShape, expand_candidates, grid
from riskloom.plans.experiment import feature_columns, refit, run_experiment
from riskloom.plans.registry import query, table, tidy, view
from riskloom.session import scratch_path
from riskloom.settings import DatasetSettings, ExperimentSettings
from riskloom.sources.logs import read_log
from riskloom.sources.models import ScoringBundle, load_bundle, save_bundle
from riskloom.streaming import monitoring
from riskloom.streaming.scoring import deduplicated, start_scoring

SETTINGS = ExperimentSettings(dataset=DatasetSettings(id_column="c_custkey", drop_columns=("c_custkey",)), folds=5)
PARAMS = {"C": 1.0, "penalty": "l2"}


def _clients(spark: SparkSession, sf: str) -> DataFrame:
    """Clients with order features; the label marks clients whose order value and balance are low."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"),
        F.avg("o_totalprice").alias("mean_price"),
        F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("finished_share"),
    )
    joined = table(spark, sf, "customer").join(orders, "c_custkey", "left")
    late = (F.col("c_acctbal") < 1500) & (F.coalesce("finished_share", F.lit(0.0)) > 0.2)
    return joined.select(
        "c_custkey", "c_acctbal", "c_mktsegment", "n_orders", "mean_price", "finished_share",
        late.cast("int").alias("TARGET"),
    )


def _logistic(**axes) -> Candidate:
    return replace(BASE_CANDIDATES["logistic_regression"], grid=grid(**axes))


def _experiment(spark: SparkSession, sf: str, **axes):
    base = {"logistic_regression": _logistic(**(axes or {"C": [1.0], "penalty": ["l2"]}))}
    return run_experiment(_clients(spark, sf), expand_candidates(base=base), SETTINGS)


@query
def train_select_score(spark: SparkSession, sf: str) -> DataFrame:
    """The whole grid of logistic regressions on five folds, out-of-fold threshold, hold-out check: one row."""
    return _experiment(spark, sf, C=[0.1, 0.5, 1.0, 2.0], penalty=["l1", "l2"])[0]


@query
def selection_recomputed(spark: SparkSession, sf: str) -> DataFrame:
    """The same selection, its result row recomputed from the written predictions: is the threshold as cheap as the
    cheapest of all out-of-fold probabilities, and do the hold-out's counts and cost follow from it?"""
    results, outcomes, best = _experiment(spark, sf, C=[0.1, 0.5, 1.0, 2.0], penalty=["l1", "l2"])
    told, oof, holdout, cost = results.first(), outcomes[best].oof, outcomes[best].holdout, SETTINGS.cost
    totals = running_totals(oof, value="probability", measures={"n": F.lit(1), "p": F.col("TARGET")})
    # a threshold at a probability misses the ones below it and flags the zeros from it on
    wrong = cost.fn_cost * F.col("p_before") + cost.fp_cost * ((F.col("n_total") - F.col("p_total")) - (F.col("n_before") - F.col("p_before")))
    curve = totals.select("probability", (wrong / F.col("n_total")).alias("cost"))
    least = curve.agg(F.min("cost").alias("least"), F.min(F.when(F.col("probability") >= told["threshold"], F.struct("probability", "cost")))["cost"].alias("own"))
    flagged, default = F.col("probability") >= told["threshold"], F.col("TARGET") == 1
    fn, fp = F.count_if(default & ~flagged), F.count_if(~default & flagged)
    checked = holdout.agg(
        (F.count("*") + oof.count()).alias("predictions"),
        ((fn == told["false_negatives"]) & (fp == told["false_positives"]) & (F.count_if(default & flagged) == told["true_positives"])
         & (F.count_if(~default & ~flagged) == told["true_negatives"])).alias("counts_follow"),
        (F.abs((cost.fn_cost * fn + cost.fp_cost * fp) / F.count("*") - told["holdout_business_cost"]) < 1e-9).alias("cost_follows"),
    )
    cheapest = least.select(F.col("own") <= F.col("least") + 1e-9).scalar()
    return checked.select("predictions", cheapest.alias("threshold_is_cheapest"), "counts_follow", "cost_follows")


@query
def oof_predictions(spark: SparkSession, sf: str) -> DataFrame:
    _, outcomes, best = _experiment(spark, sf)
    outcome = outcomes[best]
    return outcome.oof.withColumn("split", F.lit("oof")).unionByName(outcome.holdout.withColumn("split", F.lit("holdout")))


def _fitted(spark: SparkSession, sf: str):
    clients = _clients(spark, sf)
    return clients, refit(clients, _logistic(C=[1.0], penalty=["l2"]), PARAMS, SETTINGS)


@query
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    clients, model = _fitted(spark, sf)
    return batch_predictions(clients.drop("TARGET"), model, id_column="c_custkey", threshold=0.3)


@query
def oof_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every client is predicted once, out of fold or held out, with a probability and its own label."""
    rows = oof_predictions(spark, sf)
    valid = F.count_if(F.col("probability").between(0, 1))
    return rows.groupBy("TARGET").agg(
        F.count("*").alias("predictions"), F.count_distinct("c_custkey").alias("clients"), valid.alias("valid")
    )


@query
def batch_score_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Every client is scored, and the decision follows its probability and the threshold."""
    rows = batch_score(spark, sf)
    follows = F.col("default_prediction") == (F.col("default_probability") >= 0.3).cast("int")
    return rows.agg(F.count("*").alias("scored"), F.count_distinct("c_custkey").alias("clients"), F.count_if(follows).alias("consistent"))


@query
def boosting_smote(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees on synthetic minority rows made inside each training fold; counts of its out-of-fold rows."""
    base = {"boosting_shallow": replace(
        BASE_CANDIDATES["boosting_shallow"], grid=grid(n_estimators=[5], learning_rate=[0.1], max_depth=[3])
    )}
    results, outcomes, best = run_experiment(_clients(spark, sf), expand_candidates(sampling=["smote"], base=base), SETTINGS)
    outcome = outcomes[best]
    rows = outcome.oof.unionByName(outcome.holdout)
    named = results.select(F.col("model_name"), F.col("sampling_strategy"))
    return rows.agg(F.count("*").alias("predictions"), F.count_distinct("c_custkey").alias("clients")).select(
        named.select("model_name").scalar().alias("model_name"), named.select("sampling_strategy").scalar().alias("sampling_strategy"), "*"
    )


CELLS = ["n_orders", "balance", "nation"]


def _client_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every client with whole-number features as an array; clients without orders lack their count."""
    balance = F.floor(F.col("c_acctbal") / 100).cast("double")
    named = _clients(spark, sf).join(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    cells = F.array(F.col("n_orders").cast("double"), balance, F.col("c_nationkey").cast("double"))
    return named.select("c_custkey", F.col("TARGET").alias("label"), cells.alias("cells"))


@query
def boosting_split_gains(spark: SparkSession, sf: str) -> DataFrame:
    """The best first split of every feature, from the summed histograms of all clients."""
    return tidy(first_splits(_client_cells(spark, sf), features="cells", label="label", names=CELLS), 4)


@query
def tree_shap_additivity(spark: SparkSession, sf: str) -> DataFrame:
    """Leaf-wise boosting on all clients; each client's Shapley values add up to its margin, their base is the mean."""
    clients = _client_cells(spark, sf)
    settings = BoostingSettings(trees=10, max_leaves=16, learning_rate=0.2)
    base, trees = train(clients, features="cells", label="label", settings=settings)
    trees = [vars(t) for t in trees]
    present = clients.withColumn("cells", F.transform("cells", lambda v: F.coalesce(v, F.lit(float("nan")))))
    margins = present.select(F.col("c_custkey").alias("client_id"), margin_column(F.col("cells"), base, trees).alias("margin"))
    values = shap_arrays(present, id_column="c_custkey", cells="cells", base=base, trees=trees)
    total = F.aggregate("values", F.lit(0.0), lambda a, v: a + v) + F.col("base_value")
    joined = values.select("client_id", total.alias("total"), "base_value").join(margins, "client_id")
    mean = margins.agg(F.avg("margin")).scalar()
    return joined.select(
        "client_id", (F.abs(F.col("total") - F.col("margin")) < 1e-9).alias("additive"),
        (F.abs(F.col("base_value") - mean) < 1e-6).alias("base_is_mean"),
    )


#: Two trees on (orders, balance, nation): nodes as (feature, largest value to the left, missing left, left, right, value).
SMALL_FOREST = [
    [(0, 10.0, True, 1, 2, 0.0), (1, 20.0, False, 3, 4, 0.0), (2, 12.0, False, 5, 6, 0.0),
     (-1, 0.0, False, 0, 0, 0.1), (-1, 0.0, False, 0, 0, -0.2), (-1, 0.0, False, 0, 0, 0.3), (-1, 0.0, False, 0, 0, -0.1)],
    [(1, 50.0, False, 1, 2, 0.0), (-1, 0.0, False, 0, 0, 0.05), (0, 20.0, True, 3, 4, 0.0),
     (-1, 0.0, False, 0, 0, -0.3), (-1, 0.0, False, 0, 0, 0.2)],
]


@query
def perceptron_grid(spark: SparkSession, sf: str) -> DataFrame:
    """All four settings of the perceptron on every client: rounds taken within the limit, a probability for each."""
    clients = _client_cells(spark, sf)
    filled = F.transform("cells", lambda v: F.coalesce(v, F.lit(0.0)) / 100.0)
    rows = clients.withColumn("features", array_to_vector(filled))
    found = None
    for place, params in enumerate(BASE_CANDIDATES["mlp"].grid):
        estimator = BASE_CANDIDATES["mlp"].build({**params, "max_iter": 30}, TrainingShape(rows=0, width=3), 42)
        model = estimator.setFeaturesCol("features").setLabelCol("label").fit(rows)
        chance = positive_probability().alias("p")
        one = model.transform(rows).select(chance).agg(F.count("*").alias("clients"), F.count_if(F.col("p").between(0, 1)).alias("valid"))
        one = one.select(F.lit(place).alias("setting"), "clients", "valid", F.lit(0 < model.rounds <= 31).alias("stopped"))
        found = one if found is None else found.unionByName(one)
    return found


@query
def tree_shap_values(spark: SparkSession, sf: str) -> DataFrame:
    """Exact Shapley values of a small given forest for every client, covers counted over all clients."""
    columns = ["feature", "threshold", "missing_left", "left", "right", "value"]
    trees = [dict(zip(columns, map(list, zip(*nodes, strict=True)), strict=True)) for nodes in SMALL_FOREST]
    clients = _client_cells(spark, sf).withColumn("cells", F.transform("cells", lambda v: F.coalesce(v, F.lit(float("nan")))))
    trees = counted_cover(clients, cells="cells", trees=trees)
    values = tree_shap(clients, id_column="c_custkey", vector="cells", base=0.0, trees=trees, names=[f"{c}__num" for c in CELLS])
    return tidy(values.select("client_id", "source_feature", "shap_value", "base_value"))


@query
def shap_additivity(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation values of some clients add up to their probability above one common base value."""
    clients, model = _fitted(spark, sf)
    prepared = model.transform(clients)
    names, fitted = explain.feature_names(prepared), model.stages[-1]
    plain = prepared.drop("rawPrediction", "prediction").withColumn("p", positive_probability()).drop("probability")
    chosen = explain.extreme_clients(plain, 3, id_column="c_custkey", probability="p")
    values = explain.permutation_shap(
        chosen.select("c_custkey", "features"), fitted, id_column="c_custkey", vector="features", names=names,
        background=plain.select("c_custkey", "features"), background_rows=20,
    )
    sums = values.groupBy("client_id").agg(F.sum("shap_value").alias("total"), F.max("base_value").alias("base"))
    joined = sums.join(chosen.select(F.col("c_custkey").alias("client_id"), "p"), "client_id")
    exact = F.count_if(F.abs(F.col("total") + F.col("base") - F.col("p")) < 1e-9)
    return joined.agg(F.count("*").alias("clients"), exact.alias("additive"), (F.max("base") - F.min("base") < 1e-12).alias("one_base"))


@query
def importance_rollup(spark: SparkSession, sf: str) -> DataFrame:
    clients, model = _fitted(spark, sf)
    names = explain.feature_names(model.transform(clients))
    return explain.importance_by_source(explain.importance_table(spark, model.stages[-1], names))


@query
def linear_shap_values(spark: SparkSession, sf: str) -> DataFrame:
    """Closed form for given coefficients over the whole customer table."""
    inputs = VectorAssembler(inputCols=["c_acctbal", "c_nationkey"], outputCol="features").transform(
        table(spark, sf, "customer")
    )
    values = explain.linear_shap(
        inputs, id_column="c_custkey", vector="features", coefficients=[0.001, -0.25],
        names=["c_acctbal__num", "c_nationkey__num"],
    )
    return tidy(values.select("client_id", "source_feature", "shap_value"))


@query
def global_shap_values(spark: SparkSession, sf: str) -> DataFrame:
    clients, model = _fitted(spark, sf)
    prepared = model.transform(clients)
    names, fitted = explain.feature_names(prepared), model.stages[-1]
    values = explain.linear_shap(
        prepared, id_column="c_custkey", vector="features", coefficients=fitted.coefficients.toArray(), names=names,
    )
    return explain.global_shap_by_source(values)


@query
def local_explanations(spark: SparkSession, sf: str) -> DataFrame:
    """Permutation Shapley values of the three riskiest and three safest clients, top features each."""
    clients, model = _fitted(spark, sf)
    prepared = model.transform(clients)
    names, fitted = explain.feature_names(prepared), model.stages[-1]
    plain = prepared.drop("rawPrediction", "prediction").withColumn("predicted_probability", positive_probability())
    plain = plain.drop("probability")
    chosen = explain.extreme_clients(plain, 3, id_column="c_custkey", probability="predicted_probability")
    values = explain.permutation_shap(
        chosen.select("c_custkey", "features"), fitted, id_column="c_custkey", vector="features", names=names,
        background=plain.select("c_custkey", "features"),
    )
    clients_of = chosen.select(F.col("c_custkey").alias("client_id"), "predicted_probability")
    return explain.local_shap(values, clients_of, top=5, by_source=True)


# ---- report views over one row per candidate ------------------------------------------------------

def _results(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, views.RESULTS)


@query
def report_cv(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard.cv_view(_results(spark, sf))


@query
def report_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard.holdout_view(_results(spark, sf))


@query
def report_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard.threshold_view(_results(spark, sf))


@query
def report_performance(spark: SparkSession, sf: str) -> DataFrame:
    classes = {"base0": "LogisticRegression", "base1": "GBTClassifier"}
    return tidy(leaderboard.performance_view(_results(spark, sf), classes))


@query
def report_best(spark: SparkSession, sf: str) -> DataFrame:
    best = leaderboard.best_model_view(report_performance(spark, sf))
    return best.select("model", "rank", "selected_as_best", "threshold")


@query
def report_runs(spark: SparkSession, sf: str) -> DataFrame:
    return leaderboard.runs_view(_results(spark, sf), campaign_name="Spring run", root_run_id="root")


# ---- streams over the given files ---------------------------------------------------------------

def stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    file = f"{name}.parquet"
    schema = spark.read.parquet(f"{sf.rstrip('/')}/{file}").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file).parquet(sf)


def _finish(running: StreamingQuery) -> None:
    running.awaitTermination()


def _calls(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(views.CALLS, events=stream(spark, sf, "events"))


@query
def stream_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly KPIs per path of all windows of a finished stream, open ones too."""
    root = scratch_path(spark, "kpis")
    _finish(monitoring.start_window_counts(_calls(spark, sf), path=f"{root}/out", checkpoint=f"{root}/checkpoint"))
    return tidy(monitoring.current_kpis(spark, f"{root}/out", view(spark, sf, views.CALLS)))


@query
def stream_counts(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "counts")
    _finish(monitoring.start_counts(_calls(spark, sf), "status_code", path=f"{root}/out", checkpoint=f"{root}/checkpoint"))
    return monitoring.latest_counts(spark, f"{root}/out")


@query
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event sent twice; repeats within the watermark are dropped."""
    root = scratch_path(spark, "dedup")
    sent = stream(spark, sf, "events").select(
        F.col("event_id").alias("request_id"), F.col("ts").cast("timestamp").alias("created_at"), "event_type",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"),
    )
    running = (
        deduplicated(sent).writeStream.format("parquet").option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    _finish(running)
    return spark.read.parquet(f"{root}/out").select("request_id", "event_type")


@query
def stream_drift(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "drift")
    reference = view(spark, sf, views.PERIODS).filter("NOT is_current").drop("is_current")
    current = spark.sql(views.PERIODS, lineitem=stream(spark, sf, "lineitem")).filter("is_current").drop("is_current")
    _finish(monitoring.start_drift(current, reference, path=f"{root}/out", checkpoint=f"{root}/checkpoint"))
    features = spark.read.parquet(f"{root}/out/features")
    return tidy(features.select("feature", "psi", "drift_level", "current_rows"))


@query
def stream_window_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Drift of every 90 days of later lines against all earlier ones, by the time of the lines."""
    root = scratch_path(spark, "window-drift")
    profile = monitoring.drift_profile(view(spark, sf, views.PERIODS).filter("NOT is_current").drop("is_current"))
    current = spark.sql(views.TIMED_PERIODS, lineitem=stream(spark, sf, "lineitem")).filter("is_current").drop("is_current")
    running = monitoring.start_window_drift(current, profile, path=f"{root}/out", checkpoint=f"{root}/checkpoint", window="90 days")
    _finish(running)
    found = monitoring.current_drift(spark, f"{root}/out", profile)
    return tidy(found.drop("missing_rate_delta"))


@query
def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Requests built from customers, scored by a saved bundle; the call log by status."""
    root = scratch_path(spark, "scoring")
    clients, model = _fitted(spark, sf)
    schema = feature_columns(clients, SETTINGS).schema
    for field in schema:
        field.nullable = field.name != "c_acctbal"
    bundle = load_bundle(spark, save_bundle(spark, ScoringBundle(model, 0.3, schema), f"{root}/bundle"))
    customers = stream(spark, sf, "customer")
    sound = to_payload(["c_acctbal", "c_mktsegment"])
    requests = customers.select(
        F.col("c_custkey").cast("string").alias("request_id"),
        F.when(F.col("c_custkey") % 10 == 0, F.to_json(F.struct("c_mktsegment"))).otherwise(sound).alias("request_payload"),
        (F.col("c_custkey") % 100).cast("double").alias("latency_ms"),
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("c_custkey")).alias("created_at"),
    )
    _finish(start_scoring(requests, bundle, log_root=f"{root}/logs", checkpoint=f"{root}/checkpoint"))
    calls = read_log(spark, f"{root}/logs", "api_call_logs")
    scored = read_log(spark, f"{root}/logs", "prediction_logs").select("id", F.lit(1).alias("scored"))
    return calls.join(scored, "id", "left").groupBy("status_code", "path").agg(
        F.count("*").alias("calls"), F.count("request_payload").alias("payloads"), F.count("scored").alias("scored"),
        F.sum("latency_ms").alias("latency_total"),
    )
