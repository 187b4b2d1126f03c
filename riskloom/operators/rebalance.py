"""Synthetic minority rows: SMOTE, borderline SMOTE and ADASYN over exact nearest neighbours.

All random choices are hashes of the synthetic row's number, so a recomputed task makes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import hash_order, safe_ratio
from riskloom.operators.neighbors import nearest_neighbors
from riskloom.operators.ranking import hashed_rank
from riskloom.operators.sampling import class_counts, undersample
from riskloom.session import materialize
from riskloom.settings import RebalanceSettings

STRATEGIES = ("baseline", "smote", "borderline_smote", "adasyn", "smote_under")
DRAWS_AT_ONCE = 10_000
BORDERLINE_NEIGHBORHOOD = 10  # fixed value: neighbours inspected to find the border


def _unit(seed: int, *columns: str) -> Column:
    """Hash of the columns mapped to [0, 1)."""
    return F.pmod(hash_order(*columns, seed=seed), F.lit(2**40)).cast("double") / F.lit(float(2**40))


def _wanted(counts: dict, minority: object, ratio: float) -> int:
    largest = max((n for c, n in counts.items() if c != minority), default=0)
    return int(largest * ratio) - counts.get(minority, 0)


def _with_flag(df: DataFrame, flag: bool) -> DataFrame:
    return df.withColumn("synthetic", F.lit(flag))


ORIGIN = ["base_id", "partner_id"]


def _interpolate(
    choices: DataFrame, df: DataFrame, partners: DataFrame, *, id_column: str, vector: str, label: str,
    minority: object, k: int, seed: int, trace: bool = False,
) -> DataFrame:
    """Rows between a base point and one of its minority neighbours; ``choices`` is (draw, id). With ``trace`` they
    carry the ids of both."""
    points = df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    chosen = choices.join(partners, "id").filter(F.size("neighbors") > 0)
    pick = F.floor(_unit(seed + 1, "draw", "id") * F.size("neighbors")).cast("int")
    linked = chosen.select("draw", "id", F.get("neighbors", pick)["id"].alias("partner"))
    base = linked.join(points, "id").withColumnRenamed("vec", "base")
    other = points.select(F.col("id").alias("partner"), F.col("vec").alias("other"))
    gap = _unit(seed + 2, "draw", "id")
    made = base.join(other, "partner").withColumn("gap", gap)
    mixed = F.zip_with("base", "other", lambda a, b: a + F.col("gap") * (b - a))
    kinds = {f.name: f.dataType for f in df.schema}
    return made.select(
        F.lit(None).cast(kinds[id_column]).alias(id_column),
        mixed.cast(kinds[vector]).alias(vector),
        F.lit(minority).cast(kinds[label]).alias(label),
        *([F.col("id").alias(ORIGIN[0]), F.col("partner").alias(ORIGIN[1])] if trace else []),
    )


def _minority_partners(
    df: DataFrame, label: str, minority: object, *, id_column: str, vector: str, settings: RebalanceSettings, seed: int
):
    chosen = df.filter(F.col(label) == F.lit(minority))
    return nearest_neighbors(chosen, settings.neighbors, id_column=id_column, vector=vector, seed=seed, recall=settings.recall)


def _draw_uniform(bases: DataFrame, need: int, seed: int) -> DataFrame:
    """``need`` draws with replacement from ``bases`` (id)."""
    ranked = hashed_rank(bases, keys=[], ids=["id"], seed=seed)
    size = ranked.count()
    draws = bases.sparkSession.range(need).withColumnRenamed("id", "draw")
    spot = F.pmod(hash_order("draw", seed=seed), F.lit(size)) + 1
    return draws.withColumn("rank", spot.cast("bigint")).join(
        ranked.withColumn("rank", F.col("rank").cast("bigint")), "rank"
    ).select("draw", "id")


def smote(
    df: DataFrame, *, id_column: str, vector: str, label: str, minority: object = 1,
    settings: RebalanceSettings = RebalanceSettings(), seed: int = 42, trace: bool = False,
) -> DataFrame:
    """Raise the minority to ``oversampling_ratio`` x majority; unchanged if it is already there."""
    base = df.select(id_column, vector, label)
    need = _wanted(class_counts(df, label), minority, settings.oversampling_ratio)
    if need <= 0:
        return _with_flag(base, False)
    partners = materialize(
        _minority_partners(base, label, minority, id_column=id_column, vector=vector, settings=settings, seed=seed),
        "smote-neighbors",
    )
    choices = _draw_uniform(partners.select("id"), need, seed)
    made = _interpolate(choices, base, partners, id_column=id_column, vector=vector, label=label,
                        minority=minority, k=settings.neighbors, seed=seed, trace=trace)
    return _with_flag(base, False).unionByName(_with_flag(made, True), allowMissingColumns=True)


def _majority_share(
    df: DataFrame, *, id_column: str, vector: str, label: str, minority: object, k: int, seed: int,
    recall: float | None = None,
) -> DataFrame:
    """(id, others, found): other-class rows among the k nearest rows of every minority row."""
    around = nearest_neighbors(
        df, k, id_column=id_column, vector=vector, carry=[label], seed=seed,
        queries=df.filter(F.col(label) == F.lit(minority)), recall=recall,
    )
    others = F.size(F.filter("neighbors", lambda m: m[label] != F.lit(minority)))
    return around.select("id", others.alias("others"), F.size("neighbors").alias("found"))


def danger_points(
    df: DataFrame, *, id_column: str, vector: str, label: str, minority: object = 1,
    neighborhood: int = BORDERLINE_NEIGHBORHOOD, seed: int = 42,
) -> DataFrame:
    """Minority rows with at least half, but not all, of their neighbours in another class."""
    share = _majority_share(
        df, id_column=id_column, vector=vector, label=label, minority=minority, k=neighborhood, seed=seed
    )
    return share.filter((2 * F.col("others") >= F.col("found")) & (F.col("others") < F.col("found"))).select("id")


def borderline_smote(
    df: DataFrame, *, id_column: str, vector: str, label: str, minority: object = 1,
    settings: RebalanceSettings = RebalanceSettings(), seed: int = 42, trace: bool = False,
) -> DataFrame:
    """SMOTE whose base points are the minority rows at the class border."""
    base = df.select(id_column, vector, label)
    need = _wanted(class_counts(df, label), minority, settings.oversampling_ratio)
    if need <= 0:
        return _with_flag(base, False)
    danger = materialize(
        danger_points(base, id_column=id_column, vector=vector, label=label, minority=minority, seed=seed),
        "border-points",
    )
    if danger.isEmpty():
        return _with_flag(base, False)
    partners = materialize(
        _minority_partners(base, label, minority, id_column=id_column, vector=vector, settings=settings, seed=seed),
        "border-neighbors",
    )
    made = _interpolate(_draw_uniform(danger, need, seed), base, partners, id_column=id_column, vector=vector,
                        label=label, minority=minority, k=settings.neighbors, seed=seed, trace=trace)
    return _with_flag(base, False).unionByName(_with_flag(made, True), allowMissingColumns=True)


def adasyn(
    df: DataFrame, *, id_column: str, vector: str, label: str, minority: object = 1,
    settings: RebalanceSettings = RebalanceSettings(), seed: int = 42, trace: bool = False,
) -> DataFrame:
    """Synthetic rows per minority row in proportion to the other-class share around it."""
    base = df.select(id_column, vector, label)
    need = _wanted(class_counts(df, label), minority, settings.oversampling_ratio)
    if need <= 0:
        return _with_flag(base, False)
    share = materialize(
        _majority_share(base, id_column=id_column, vector=vector, label=label, minority=minority,
                        k=settings.neighbors, seed=seed, recall=settings.recall),
        "adasyn-share",
    )
    weight = safe_ratio("others", "found")
    total = share.agg(F.sum(weight)).scalar()
    planned = share.withColumn("made", F.rint(safe_ratio(weight, total) * F.lit(need)).cast("bigint"))
    # a base row with many draws becomes ranges of draws on different tasks before the draws themselves
    ranges = planned.filter("made > 0").select(
        "id", "made", F.explode(F.sequence(F.lit(0), F.floor((F.col("made") - 1) / DRAWS_AT_ONCE))).alias("range")
    ).repartition("id", "range")
    first = F.col("range") * DRAWS_AT_ONCE + 1
    last = F.least(F.col("made").cast("bigint"), (F.col("range") + 1) * DRAWS_AT_ONCE)
    choices = ranges.select("id", F.explode(F.sequence(first, last)).alias("draw"))
    partners = materialize(
        _minority_partners(base, label, minority, id_column=id_column, vector=vector, settings=settings, seed=seed),
        "adasyn-neighbors",
    )
    made = _interpolate(choices.select(F.col("draw").cast("bigint").alias("draw"), "id"), base, partners,
                        id_column=id_column, vector=vector, label=label, minority=minority,
                        k=settings.neighbors, seed=seed, trace=trace)
    return _with_flag(base, False).unionByName(_with_flag(made, True), allowMissingColumns=True)


def rebalance(
    df: DataFrame, strategy: str, *, id_column: str, vector: str, label: str, minority: object = 1,
    settings: RebalanceSettings = RebalanceSettings(), seed: int = 42,
) -> DataFrame:
    """Apply one named strategy to a training table (never to the rows it is evaluated on)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"Unsupported sampling strategy: {strategy}")
    # synthetic values may be NULL to the type checker, so the vectors' elements must be allowed to be
    df = df.withColumn(vector, F.col(vector).cast("array<double>"))
    shared = dict(id_column=id_column, vector=vector, label=label, minority=minority, settings=settings, seed=seed)
    if strategy == "baseline":
        return _with_flag(df.select(id_column, vector, label), False)
    if strategy == "borderline_smote":
        return borderline_smote(df, **shared)
    if strategy == "adasyn":
        return adasyn(df, **shared)
    raised = smote(df, **shared)
    if strategy == "smote":
        return raised
    keyed = raised.withColumn("__key", F.xxhash64(vector, id_column))
    return undersample(
        keyed, label=label, ids=["__key"], ratio=settings.undersampling_ratio, minority=minority, seed=seed
    ).drop("__key")


def strategies(names: Sequence[str] | None) -> list[str]:
    chosen = list(dict.fromkeys(names or ["baseline"]))
    unknown = [n for n in chosen if n not in STRATEGIES]
    if unknown:
        raise ValueError(f"Unknown sampling strategies: {unknown}")
    return chosen
