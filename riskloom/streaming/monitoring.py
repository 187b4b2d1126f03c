"""Streaming KPIs, counters and drift, all with state of bounded size per window.

A percentile of a window would need all of the window's values in the state. The stream keeps a mergeable order sketch
instead: counts per (window, path, latency bucket), with buckets that grow by two per cent, at most 2 * BUCKETS + 2 of
them however many calls there are. From the counts it is known which buckets hold a quantile's neighbours and how many
values stand below; one pass over the call log then reads the values of those buckets only and gives the exact quantile.

Drift is judged per event-time window: the state counts rows per (window, feature, bin) against the fixed bins of a
reference, so results do not depend on how rows were dealt to micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions import bucket_index, nan_to_null, number, safe_ratio, share
from riskloom.operators.cleaning import numeric_columns
from riskloom.operators.drift import PSI_FLOOR, all_drift, categorical_drift, drift_level, drift_summary, numeric_drift
from riskloom.operators.oplogs import FIRST_ERROR_STATUS
from riskloom.operators.ranking import exact_quantiles, match_keys, quantile_at, quantile_hits, running_totals
from riskloom.settings import DriftSettings

WINDOW_KEYS = ["window_start", "window_end", "path"]
#: Buckets of the order sketch: values below LOWEST share one, each next one reaches GROWTH times further.
LOWEST, GROWTH, BUCKETS = 1e-3, 1.02, 1200


def _timed(rows: DataFrame, watermark: str) -> DataFrame:
    timed = rows.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return timed.withWatermark("created_at", watermark) if timed.isStreaming else timed


def latency_bucket(value: Column) -> Column:
    """Whole number that never falls as ``value`` grows; the outermost buckets are open, NULL stays NULL."""
    steps = F.floor(F.ln(F.abs(value) / LOWEST) / F.ln(F.lit(GROWTH))) + 1
    size = F.when(F.abs(value) < LOWEST, 0).otherwise(F.least(steps, F.lit(BUCKETS)))
    return F.when(value < 0, -size).when(value >= 0, size).cast("int")


def latency_counts(calls: DataFrame, *, window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """The order sketch of calls per window and path: calls, errors, sum and largest latency of each bucket."""
    latency = number("latency_ms")
    failed = F.col("status_code").cast("int") >= FIRST_ERROR_STATUS
    return (
        _timed(calls, watermark)
        .groupBy(F.window("created_at", window).alias("w"), "path", latency_bucket(latency).alias("bucket"))
        .agg(F.count("*").alias("calls"), F.count_if(failed).alias("errors"), F.sum(latency).alias("latency_sum"), F.max(latency).alias("latency_max"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path", "bucket", "calls",
                "errors", "latency_sum", "latency_max")
    )


def _bracketed(counts: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """The buckets that hold a neighbour of a quantile: keys, bucket, values below it and in all."""
    ordered = Window.partitionBy(*WINDOW_KEYS).orderBy("bucket")  # at most 2 * BUCKETS + 1 rows
    placed = counts.filter("bucket IS NOT NULL").withColumns({
        "below": F.sum("calls").over(ordered) - F.col("calls"),
        "total": F.sum("calls").over(Window.partitionBy(*WINDOW_KEYS)),
    })
    spots = [side(F.lit(float(q)) * (F.col("total") - 1)) for q in quantiles for side in (F.floor, F.ceil)]
    holds = [(F.col("below") <= s) & (s < F.col("below") + F.col("calls")) for s in spots]
    return placed.filter(reduce(Column.__or__, holds)).select(*WINDOW_KEYS, "bucket", "below", "total")


def window_kpis(counts: DataFrame, calls: DataFrame, *, window: str = "1 hour") -> DataFrame:
    """KPIs per window and path from its sketch, and exact quantiles from the values of the bracketing buckets.

    ``calls`` is the call log as a table; it has to hold the calls that were counted.
    """
    n = F.col("calls")
    timed = F.sum(F.when(F.col("bucket").isNotNull(), n))
    base = counts.groupBy(*WINDOW_KEYS).agg(
        F.sum("calls").alias("total_calls"),
        F.sum("errors").alias("error_calls"),
        share(F.sum("errors"), F.sum("calls")).alias("error_rate"),
        share(F.sum("latency_sum"), timed).alias("latency_mean_ms"),
        F.coalesce(F.max("latency_max"), F.lit(0.0)).alias("latency_max_ms"),
    )
    spots = {"latency_p50_ms": 0.50, "latency_p95_ms": 0.95, "latency_p99_ms": 0.99}
    wanted = _bracketed(counts, list(spots.values()))
    latency = number("latency_ms")
    log = calls.select(F.window(F.col("created_at").cast("timestamp"), window).alias("w"), "path", latency.alias("latency_ms"))
    log = log.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "path", "latency_ms", latency_bucket(F.col("latency_ms")).alias("bucket"))
    inside = match_keys(log, wanted, [*WINDOW_KEYS, "bucket"])
    keys = [*WINDOW_KEYS, "bucket", "below", "total"]
    ordered = running_totals(inside, value="latency_ms", keys=keys, measures={"n": F.lit(1)})
    ordered = ordered.withColumns({"n_before": F.col("below") + F.col("n_before"), "n_total": F.col("total")})
    hits = ordered.groupBy(*WINDOW_KEYS).agg(quantile_hits("latency_ms", list(spots.values())).alias("hits"))
    tail = hits.select(*WINDOW_KEYS, *[quantile_at("hits", i).alias(name) for i, name in enumerate(spots)])
    return match_keys(base, tail, WINDOW_KEYS, "left")


def kpi_sink(path: str, log: Callable[[], DataFrame], window: str) -> Callable[[DataFrame, int], None]:
    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = window_kpis(batch, log(), window=window).withColumn("batch_id", F.lit(int(batch_id)))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    return handle


def start_kpis(
    calls: DataFrame, log: Callable[[], DataFrame], *, path: str, checkpoint: str, window: str = "1 hour",
    watermark: str = "10 minutes", **trigger,
) -> StreamingQuery:
    """Write the KPIs of every window once, when the watermark has passed its end. ``log`` reads the call log anew."""
    return (
        latency_counts(calls, window=window, watermark=watermark)
        .writeStream.outputMode("append")
        .foreachBatch(kpi_sink(path, log, window))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_window_counts(
    calls: DataFrame, *, path: str, checkpoint: str, window: str = "1 hour", watermark: str = "10 minutes", **trigger
) -> StreamingQuery:
    """Keep the counts of all windows, open ones too: each micro-batch writes the counts it has changed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("batch_id", F.lit(int(batch_id)))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    return (
        latency_counts(calls, window=window, watermark=watermark)
        .writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _newest(counts: DataFrame) -> DataFrame:
    """The newest counts of every bucket; counts only grow, so the newest row has the most calls."""
    newest = F.max(F.struct("calls", "errors", "latency_sum", "latency_max")).alias("newest")
    return counts.groupBy(*WINDOW_KEYS, "bucket").agg(newest).select(*WINDOW_KEYS, "bucket", "newest.*")


def current_kpis(spark: SparkSession, path: str, calls: DataFrame, *, window: str = "1 hour") -> DataFrame:
    """KPIs of all windows so far from the newest counts."""
    return window_kpis(_newest(spark.read.parquet(path).drop("batch_id")), calls, window=window)


def compact_counts(spark: SparkSession, path: str, target: str) -> str:
    """The newest counts alone, written to ``target``: what ``current_kpis`` needs of a finished stream's folder."""
    _newest(spark.read.parquet(path).drop("batch_id")).write.mode("overwrite").parquet(target)
    return target


def running_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Running counters, e.g. per decision or status code."""
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def start_counts(df: DataFrame, *keys: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Write each full set of counters to its own batch folder, so that a reader always finds a whole one."""

    def add(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("batch_id", F.lit(int(batch_id)))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    return (
        running_counts(df, *keys)
        .writeStream.outputMode("complete")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest full set of counters."""
    sets = spark.read.parquet(path)
    newest = sets.agg(F.max("batch_id")).first()[0]
    return sets.filter(F.col("batch_id") == newest).drop("batch_id")


# ---- drift per event-time window ------------------------------------------------------------------

MISSING_BIN, OTHER_BIN = -1, 0


def drift_profile(reference: DataFrame, *, settings: DriftSettings = DriftSettings(), columns: Sequence[str] | None = None) -> list[dict]:
    """Bins of each feature of ``reference`` and their reference counts: features x bins, held on the driver.

    Numbers (flags too) are cut at their quantiles, as in batch drift; other columns have a bin for each of the most
    frequent values and one for the rest. Features with one value only have no bins to compare and are left out.
    """
    chosen = reference if columns is None else reference.select(*columns)
    numeric = numeric_columns(chosen, booleans=True)
    profile = []
    shares = {f"q{i}": i / settings.bins for i in range(settings.bins + 1)}
    if numeric:
        long = nan_to_null(chosen.select(*[F.col(c).cast("double").alias(c) for c in numeric])).unpivot([], numeric, "feature", "value")
        found = {r["feature"]: r.asDict() for r in exact_quantiles(long, value="value", quantiles=shares, keys=["feature"]).collect()}
        for name in numeric:
            borders = sorted({found[name][q] for q in shares}) if name in found else []
            if len(borders) >= 2:
                profile.append({"feature": name, "kind": "numeric", "bins": borders[1:-1] if len(borders) >= 3 else []})
    texts = [c for c in chosen.columns if c not in numeric]
    if texts:
        long = chosen.select(*[F.col(c).cast("string").alias(c) for c in texts]).unpivot([], texts, "feature", "value")
        counted = long.filter("value IS NOT NULL").groupBy("feature", "value").agg(F.count("*").alias("n"))
        place = F.row_number().over(Window.partitionBy("feature").orderBy(F.desc("n"), "value"))
        kept: dict[str, list[str]] = {c: [] for c in texts}
        for r in counted.withColumn("place", place).filter(F.col("place") <= settings.max_categories).orderBy("place").collect():
            kept[r["feature"]].append(r["value"])
        profile += [{"feature": name, "kind": "categorical", "bins": values} for name, values in kept.items()]
    if profile:
        counts = _binned(chosen, profile).groupBy("feature", "bin").agg(F.count("*").alias("n"))
        by_feature: dict[str, dict[int, int]] = {p["feature"]: {} for p in profile}
        for r in counts.collect():
            by_feature[r["feature"]][r["bin"]] = r["n"]
        for p in profile:
            p["counts"] = by_feature[p["feature"]]
    return profile


def _binned(rows: DataFrame, profile: Sequence[dict], *keep: Column) -> DataFrame:
    """A row for each row and feature of the profile, with its bin; a feature the rows lack is missing in all of them."""
    cells = []
    for p in profile:
        name, bins = p["feature"], p["bins"]
        if name not in rows.columns:
            at = F.lit(MISSING_BIN)
        elif p["kind"] == "numeric":
            value = F.col(name).cast("double")
            present = value.isNotNull() & ~F.isnan(value)
            spot = bucket_index(F.array(*map(F.lit, bins)).cast("array<double>"), value, max_splits=max(1, len(bins))) if bins else F.lit(0)
            at = F.when(present, spot + 1).otherwise(MISSING_BIN)
        else:
            value = F.col(name).cast("string")
            spot = F.array_position(F.array(*map(F.lit, bins)).cast("array<string>"), value).cast("int")
            at = F.when(value.isNotNull(), spot).otherwise(MISSING_BIN)
        cells.append(F.struct(F.lit(name).alias("feature"), at.cast("int").alias("bin")))
    return rows.select(*keep, F.explode(F.array(*cells)).alias("cell")).select("*", "cell.*").drop("cell")


def drift_counts(inputs: DataFrame, profile: Sequence[dict], *, window: str = "1 day", watermark: str = "10 minutes") -> DataFrame:
    """Rows per event-time window, feature and bin; works on streams and on tables."""
    binned = _binned(_timed(inputs, watermark), profile, F.col("created_at"))
    counted = binned.groupBy(F.window("created_at", window).alias("w"), "feature", "bin").agg(F.count("*").alias("rows"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "feature", "bin", "rows")


def window_drift(counts: DataFrame, profile: Sequence[dict], *, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Drift of each window and feature against the reference: missing rates, PSI over the bins, level, and for numbers
    the largest gap between the distributions at the bins' borders (a lower bound of the KS statistic)."""
    spark, keys = counts.sparkSession, ["window_start", "window_end", "feature"]
    rows = []
    for p in profile:
        size = len(p["bins"]) + (p["kind"] == "numeric")
        bins = [MISSING_BIN, *range(0 if p["kind"] == "categorical" else 1, size + 1)]
        whole = sum(p["counts"].values())
        rows += [(p["feature"], p["kind"], b, p["counts"].get(b, 0), whole) for b in bins]
    reference = spark.createDataFrame(rows, "feature STRING, feature_type STRING, bin INT, ref LONG, ref_rows LONG")
    seen = counts.select(*keys).distinct()
    grid = seen.join(F.broadcast(reference), "feature")  # features x bins of the profile
    cells = grid.join(counts, [*keys, "bin"], "left").withColumn("cur", F.coalesce("rows", F.lit(0)))
    whole, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin")
    numeric, present = F.col("feature_type") == "numeric", F.col("bin") != MISSING_BIN
    cells = cells.withColumns({
        "cur_rows": F.sum("cur").over(whole),
        "ref_base": F.when(numeric, F.sum(F.when(present, F.col("ref")).otherwise(0)).over(whole)).otherwise(F.col("ref_rows")),
        "cur_base": F.sum(F.when(present | ~numeric, F.col("cur")).otherwise(0)).over(whole),
        "ref_below": F.sum(F.when(present, F.col("ref")).otherwise(0)).over(ordered),
        "cur_below": F.sum(F.when(present, F.col("cur")).otherwise(0)).over(ordered),
    })
    expected, observed = safe_ratio("ref", "ref_base"), F.coalesce(safe_ratio("cur", "cur_base"), F.lit(0.0))
    counted = (present | ~numeric) & ((F.col("ref") > 0) | (F.col("cur") > 0))
    floor = F.lit(PSI_FLOOR)
    e, o = F.greatest(expected, floor), F.greatest(observed, floor)
    gap = F.abs(safe_ratio("ref_below", "ref_base") - safe_ratio("cur_below", "cur_base"))
    absent = {side: F.sum(F.when(~present, F.col(side)).otherwise(0)) for side in ("ref", "cur")}
    report = cells.groupBy(*keys, "feature_type").agg(
        safe_ratio(absent["ref"], F.max("ref_rows")).alias("reference_missing_rate"),
        safe_ratio(absent["cur"], F.max("cur_rows")).alias("current_missing_rate"),
        F.sum(F.when(counted, (o - e) * F.ln(o / e)).otherwise(0.0)).alias("psi"),
        F.max(F.when(numeric & present, gap)).alias("border_gap"),
        F.max("cur_rows").alias("current_rows"),
    )
    report = report.withColumn("missing_rate_delta", F.col("current_missing_rate") - F.col("reference_missing_rate"))
    level = drift_level(F.col("psi"), F.col("missing_rate_delta"), F.col("current_rows"), settings.min_current_rows, F.col("border_gap"))
    return report.withColumn("drift_level", level)


def start_window_drift(
    inputs: DataFrame, profile: Sequence[dict], *, path: str, checkpoint: str, window: str = "1 day",
    watermark: str = "10 minutes", **trigger,
) -> StreamingQuery:
    """Keep the counts of all windows, open ones too: each micro-batch writes the counts it has changed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = batch.withColumn("batch_id", F.lit(int(batch_id)))
        writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(path)

    return (
        drift_counts(inputs, profile, window=window, watermark=watermark)
        .writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def current_drift(spark: SparkSession, path: str, profile: Sequence[dict], *, settings: DriftSettings = DriftSettings()) -> DataFrame:
    """Drift of all windows so far, from the newest counts."""
    counts = spark.read.parquet(path)
    newest = counts.groupBy("window_start", "window_end", "feature", "bin").agg(F.max("rows").alias("rows"))
    return window_drift(newest, profile, settings=settings)


# ---- drift per micro-batch ------------------------------------------------------------------------

def drift_sink(
    reference: DataFrame, path: str, *, settings: DriftSettings = DriftSettings()
) -> Callable[[DataFrame, int], None]:
    """Drift of each micro-batch against a fixed reference, one partition per batch: rows are judged as they arrive,
    so what a batch is, is set by the trigger."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        drift = all_drift(
            numeric_drift(reference, batch, settings=settings), categorical_drift(reference, batch, settings=settings)
        )
        for name, table in {"features": drift, "summary": drift_summary(drift)}.items():
            marked = table.withColumn("batch_id", F.lit(int(batch_id)))
            writer = marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("batch_id").parquet(f"{path.rstrip('/')}/{name}")

    return handle


def start_drift(
    inputs: DataFrame, reference: DataFrame, *, path: str, checkpoint: str, columns: Sequence[str] | None = None,
    settings: DriftSettings = DriftSettings(), **trigger,
) -> StreamingQuery:
    chosen = inputs if columns is None else inputs.select(*columns)
    return (
        chosen.writeStream.foreachBatch(drift_sink(reference, path, settings=settings))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
