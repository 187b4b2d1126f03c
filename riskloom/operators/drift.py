"""Distribution drift between a reference and a current table.

All numeric features go through one long (feature, value) table that is aggregated once; its running
totals give the reference quantile edges, both histograms and the two-sample KS statistic together.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions import bucket_index, nan_to_null, safe_ratio
from riskloom.operators.cleaning import align_columns, numeric_columns
from riskloom.operators.ranking import quantile_at, quantile_hits, running_totals
from riskloom.settings import DriftSettings

# ---- Fixed values -----------------------------------------------------------------------------
PSI_FLOOR = 1e-6
PSI_MODERATE, PSI_HIGH = 0.10, 0.25
KS_MODERATE, KS_HIGH = 0.10, 0.20
MISSING_DELTA_HIGH = 0.10
MISSING_BUCKET, OTHER_BUCKET = "__MISSING__", "__OTHER__"
# -----------------------------------------------------------------------------------------------

NUMERIC_COLUMNS = [
    "feature", "feature_type", "reference_missing_rate", "current_missing_rate", "missing_rate_delta",
    "reference_mean", "current_mean", "mean_delta", "psi", "ks_statistic", "ks_pvalue", "current_rows", "drift_level",
]
CATEGORICAL_COLUMNS = [
    "feature", "feature_type", "reference_missing_rate", "current_missing_rate", "missing_rate_delta",
    "reference_unique_count", "current_unique_count", "psi", "current_rows", "drift_level",
]


def psi(expected: Column, observed: Column) -> Column:
    """Population stability index over one row per bin."""
    e, o = F.greatest(expected, F.lit(PSI_FLOOR)), F.greatest(observed, F.lit(PSI_FLOOR))
    return F.sum((o - e) * F.ln(o / e))


def drift_level(
    psi_value: Column, missing_delta: Column, current_rows: Column, min_rows: int, ks: Column | None = None
) -> Column:
    high = (psi_value >= PSI_HIGH) | (F.abs(missing_delta) >= MISSING_DELTA_HIGH)
    moderate = psi_value >= PSI_MODERATE
    if ks is not None:
        high = high | F.coalesce(ks >= KS_HIGH, F.lit(False))
        moderate = moderate | F.coalesce(ks >= KS_MODERATE, F.lit(False))
    return (
        F.when(current_rows < min_rows, "insufficient_data")
        .when(high, "high")
        .when(moderate, "moderate")
        .otherwise("low")
    )


#: The KS p-value is exact up to this many values on the larger side, asymptotic beyond.
EXACT_KS_ROWS = 10_000


def _path_share():
    """A function that gives the share of lattice paths from (0, 0) to (n, m) that reach |i m - j n| >= steps."""

    def share(steps: int, n: int, m: int) -> float:
        if steps <= 0:
            return 1.0
        outside, low, chance = 0.0, 0, np.ones(1)  # chance of being at (low + place, k - low - place), still inside
        for k in range(1, n + m + 1):
            rest = n + m - k + 1
            i = np.arange(low, low + len(chance) + 1)
            moved = np.zeros(len(i))
            moved[:-1] += chance * ((m - (k - 1 - i[:-1])) / rest)
            moved[1:] += chance * ((n - i[:-1]) / rest)
            inside = np.abs(i * m - (k - i) * n) < steps
            outside += moved[~inside].sum()
            kept = np.flatnonzero(inside)
            if not len(kept):
                break
            low, chance = low + int(kept[0]), moved[kept[0] : kept[-1] + 1]
        return min(float(outside), 1.0)

    return share


def exact_ks_pvalue(steps: Column, n: Column, m: Column) -> Column:
    """Chance that two samples of n and m values from one distribution are at least ``steps / (n m)`` apart.

    All orders of the values are equally likely, and each is a path of steps to the right and up; the chances of being
    inside the band are carried from diagonal to diagonal, so nothing overflows, and what leaves the band is summed.
    NULL beyond EXACT_KS_ROWS.
    """
    share, most = _path_share(), EXACT_KS_ROWS

    @F.pandas_udf("double")
    def pvalue(steps: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        rows = zip(steps, n, m, strict=True)
        return pd.Series([share(int(s), int(a), int(b)) if pd.notna(s) and 0 < min(a, b) and max(a, b) <= most else None for s, a, b in rows], dtype="float64")

    return pvalue(steps, n, m)


def asymptotic_ks_pvalue(statistic: Column, n: Column, m: Column, terms: int = 40) -> Column:
    """Two-sided p-value of the two-sample KS statistic for large samples."""
    scaled = F.sqrt(n * m / (n + m)) * statistic
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * scaled * scaled),
    )
    return F.when(scaled < 0.04, 1.0).otherwise(F.greatest(F.least(series, F.lit(1.0)), F.lit(0.0)))


def ks_pvalue(statistic: Column, steps: Column, n: Column, m: Column) -> Column:
    """Exact where ``steps`` (the statistic times n m) is given, that is for small samples, else asymptotic."""
    return F.when(statistic.isNotNull(), F.coalesce(exact_ks_pvalue(steps, n, m), asymptotic_ks_pvalue(statistic, n, m)))


def _side_by_side(reference: DataFrame, current: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(feature, value, ref, cur) with one row per distinct value and how often each side holds it."""

    def long(df: DataFrame, ref: int) -> DataFrame:
        cast = nan_to_null(df).select(*[F.col(c).cast(kind).alias(c) for c in columns])
        if kind == "double":
            cast = nan_to_null(cast)
        return cast.unpivot([], list(columns), "feature", "value").select(
            "feature", "value", F.lit(ref).alias("ref"), F.lit(1 - ref).alias("cur")
        )

    stacked = long(reference, 1).unionByName(long(current, 0))
    return stacked.groupBy("feature", "value").agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))


def numeric_drift(
    reference: DataFrame,
    current: DataFrame,
    *,
    settings: DriftSettings = DriftSettings(),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """PSI over reference quantile bins, two-sample KS, means and missing rates per numeric feature."""
    reference, current = align_columns(reference, current)
    columns = list(columns or numeric_columns(reference, booleans=True))
    if not columns:
        return reference.sparkSession.createDataFrame([], _numeric_schema())
    values = _side_by_side(reference, current, columns, "double")
    ordered = running_totals(
        values, value="value", keys=["feature"], measures={"ref": F.col("ref"), "cur": F.col("cur")}, distinct=True
    )
    bins = settings.bins
    gap = F.abs(
        safe_ratio(F.col("ref_before") + F.col("ref"), "ref_total")
        - safe_ratio(F.col("cur_before") + F.col("cur"), "cur_total")
    )
    # The same gap in whole steps, for the exact p-value of small samples.
    whole = (F.col("ref_before") + F.col("ref")) * F.col("cur_total") - (F.col("cur_before") + F.col("cur")) * F.col("ref_total")
    small = F.greatest("ref_total", "cur_total") <= EXACT_KS_ROWS
    profile = ordered.groupBy("feature").agg(
        F.max(F.when(small, F.abs(whole))).alias("steps"),
        quantile_hits("value", [i / bins for i in range(bins + 1)], count="ref").alias("hits"),
        F.count_if(F.col("ref") > 0).alias("ref_distinct"),
        F.max(gap).alias("gap"),
        F.max("ref_total").alias("nr"),
        F.max("cur_total").alias("nc"),
        F.sum(F.col("value") * F.col("ref")).alias("ref_sum"),
        F.sum(F.col("value") * F.col("cur")).alias("cur_sum"),
    )
    profile = profile.withColumn(
        "edges", F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: quantile_at("hits", i)))
    )
    edges = F.col("edges")
    profile = profile.filter("ref_distinct >= 2").select(
        "feature",
        "nr",
        "nc",
        "steps",
        F.when((F.col("nr") > 1) & (F.col("nc") > 1), F.col("gap")).alias("ks_statistic"),
        safe_ratio("ref_sum", "nr").alias("reference_mean"),
        safe_ratio("cur_sum", "nc").alias("current_mean"),
        # Outer edges are open; with fewer than three distinct edges a single bin remains.
        F.when(F.size(edges) >= 3, F.slice(edges, 2, F.size(edges) - 2))
        .otherwise(F.array().cast("array<double>"))
        .alias("inner_edges"),
    )

    facts = ["nr", "nc", "steps", "ks_statistic", "reference_mean", "current_mean"]
    binned = (
        values.filter("value IS NOT NULL")
        .join(F.broadcast(profile), "feature")  # one row per numeric column of the table
        .groupBy("feature", bucket_index("inner_edges", "value", max_splits=bins).alias("bin"))
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"), *[F.max(c).alias(c) for c in facts])
    )
    stability = binned.groupBy("feature").agg(
        psi(safe_ratio("ref", "nr"), F.coalesce(safe_ratio("cur", "nc"), F.lit(0.0))).alias("psi"),
        *[F.max(c).alias(c) for c in facts],
    )
    # Every feature has the same row counts; they are counted without reading a column.
    report = stability.withColumns(
        {"ref_rows": reference.agg(F.count("*")).scalar(), "current_rows": current.agg(F.count("*")).scalar()}
    ).withColumns(
        {
            "feature_type": F.lit("numeric"),
            "reference_missing_rate": 1.0 - safe_ratio("nr", "ref_rows"),
            "current_missing_rate": 1.0 - safe_ratio("nc", "current_rows"),
            "mean_delta": F.col("current_mean") - F.col("reference_mean"),
            "ks_pvalue": ks_pvalue(F.col("ks_statistic"), F.col("steps"), F.col("nr"), F.col("nc")),
        }
    )
    return _finish(report, settings, ks=F.col("ks_statistic")).select(*NUMERIC_COLUMNS).orderBy(F.desc("psi"), "feature")


def _finish(report: DataFrame, settings: DriftSettings, ks: Column | None = None) -> DataFrame:
    with_delta = report.withColumn(
        "missing_rate_delta", F.col("current_missing_rate") - F.col("reference_missing_rate")
    )
    return with_delta.withColumn(
        "drift_level",
        drift_level(F.col("psi"), F.col("missing_rate_delta"), F.col("current_rows"), settings.min_current_rows, ks),
    )


def _numeric_schema() -> str:
    kinds = {"feature": "STRING", "feature_type": "STRING", "drift_level": "STRING", "current_rows": "BIGINT"}
    return ", ".join(f"{c} {kinds.get(c, 'DOUBLE')}" for c in NUMERIC_COLUMNS)


def _categorical_schema() -> str:
    longs = ("reference_unique_count", "current_unique_count", "current_rows")
    texts = ("feature", "feature_type", "drift_level")
    return ", ".join(
        f"{c} {'STRING' if c in texts else 'BIGINT' if c in longs else 'DOUBLE'}" for c in CATEGORICAL_COLUMNS
    )


def categorical_drift(
    reference: DataFrame,
    current: DataFrame,
    *,
    settings: DriftSettings = DriftSettings(),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """PSI over the most frequent reference categories, a missing bucket and a rest bucket."""
    reference, current = align_columns(reference, current)
    numeric_only = set(numeric_columns(reference))
    columns = list(columns or [c for c in reference.columns if c not in numeric_only])
    if not columns:
        return reference.sparkSession.createDataFrame([], _categorical_schema())
    values = _side_by_side(reference, current, columns, "string")

    absent = F.col("value").isNull()
    present = {side: F.count_if(~absent & (F.col(side) > 0)) for side in ("ref", "cur")}
    gone = {side: F.sum(F.when(absent, F.col(side)).otherwise(0)) for side in ("ref", "cur")}
    basics = values.groupBy("feature").agg(
        F.sum("ref").alias("ref_rows"),
        F.sum("cur").alias("current_rows"),
        gone["ref"].alias("ref_absent"),
        gone["cur"].alias("cur_absent"),
        present["ref"].alias("reference_unique_count"),
        present["cur"].alias("current_unique_count"),
    )
    keyed = values.groupBy("feature", F.coalesce("value", F.lit(MISSING_BUCKET)).alias("key")).agg(
        F.sum("ref").alias("ref"), F.sum("cur").alias("cur")
    )
    # Rank filter with a constant bound: Spark keeps only the leading rows of each task before the shuffle.
    leading = Window.partitionBy("feature").orderBy(F.desc("ref"), "key")
    top = (
        keyed.filter(F.col("ref") > 0)
        .withColumn("place", F.row_number().over(leading))
        .filter(F.col("place") <= settings.max_categories)
        .select("feature", "key", F.lit(True).alias("kept"))
    )
    bucket = F.when(F.col("kept") | (F.col("key") == MISSING_BUCKET), F.col("key")).otherwise(OTHER_BUCKET)
    bucketed = (
        keyed.join(top, ["feature", "key"], "left")
        .groupBy("feature", bucket.alias("bucket"))
        .agg(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))
        .join(basics.select("feature", "ref_rows", "current_rows"), "feature")
    )
    stability = bucketed.groupBy("feature").agg(
        psi(
            F.coalesce(safe_ratio("ref", "ref_rows"), F.lit(0.0)),
            F.coalesce(safe_ratio("cur", "current_rows"), F.lit(0.0)),
        ).alias("psi")
    )
    report = basics.join(stability, "feature").withColumns(
        {
            "feature_type": F.lit("categorical"),
            "reference_missing_rate": safe_ratio("ref_absent", "ref_rows"),
            "current_missing_rate": safe_ratio("cur_absent", "current_rows"),
        }
    )
    return _finish(report, settings).select(*CATEGORICAL_COLUMNS).orderBy(F.desc("psi"), "feature")


def all_drift(numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    """Numeric and categorical rows in one table; columns of the other kind are NULL."""
    return numeric.unionByName(categorical, allowMissingColumns=True)


def drift_summary(drift: DataFrame) -> DataFrame:
    """Feature counts by level and PSI extremes; one row of zeros when nothing was compared."""
    level = F.col("drift_level")
    return drift.agg(
        F.count("*").alias("feature_count"),
        F.count_if(level == "high").alias("high_drift_count"),
        F.count_if(level == "moderate").alias("moderate_drift_count"),
        F.count_if(level == "insufficient_data").alias("insufficient_data_count"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.coalesce(F.avg("psi"), F.lit(0.0)).alias("mean_psi"),
    )


def strongest_drift(drift: DataFrame, top_n: int = 20) -> DataFrame:
    return drift.orderBy(F.desc("psi"), "feature").limit(top_n)


def histogram(df: DataFrame, column: str, *, bins: int = 30) -> DataFrame:
    """Equal-width bin counts between the observed extremes; the last bin is closed."""
    value = F.col(column).cast("double")
    data = nan_to_null(df.select(value.alias("value"))).filter("value IS NOT NULL")
    span = data.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi"))).scalar()
    placed = data.select("value", span.alias("span"))
    low, high = F.col("span.lo"), F.col("span.hi")
    slot = F.when(high == low, 1).otherwise(
        F.least(F.width_bucket("value", low, F.when(high > low, high).otherwise(low + 1), F.lit(bins)), F.lit(bins))
    )
    width = (high - low) / F.lit(bins)
    counted = placed.groupBy(slot.cast("int").alias("bin"), low.alias("lo"), width.alias("width")).agg(
        F.count("*").alias("count")
    )
    return counted.select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * F.col("width")).alias("bin_start"),
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_end"),
        "count",
    ).orderBy("bin")
