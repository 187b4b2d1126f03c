"""Exact, repeatable samples, splits and folds.

Row identity decides the random order (a seeded hash), so a recomputed task draws the same rows. Exact
sizes need a rank, but not a ranking of the whole table: the hash range is cut into equal slices, the
slice counts give every slice's rank interval, and only the few slices that contain a cut are ranked.
All other rows are decided by a map-side lookup, so the table itself is not shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import hash_order, safe_ratio

ROWS_PER_SLICE = 250_000
BROADCAST_ROWS = 200_000
#: Classes whose boundaries are written into an expression.
FEW_CLASSES = 64


def class_counts(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class, on the driver: one entry per class, however many classes there are."""
    return {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}


def proportional_quotas(counts: Mapping[object, int], size: int) -> dict[object, int]:
    """Class sizes of a proportional sample of exactly ``size`` rows (largest remainders)."""
    total = sum(counts.values())
    exact = {c: size * n / total for c, n in counts.items()}
    quotas = {c: math.floor(x) for c, x in exact.items()}
    leftover = size - sum(quotas.values())
    for c in sorted(counts, key=lambda c: (quotas[c] - exact[c], str(c)))[:leftover]:
        quotas[c] += 1
    return quotas


def _with_cuts(intervals: DataFrame, df: DataFrame, label: str, cuts: Mapping[object, Sequence[int]]) -> DataFrame:
    """The intervals with the rank boundaries of their class: a few as an expression, many from a table of classes."""
    if len(cuts) > FEW_CLASSES:
        return intervals.join(_cut_table(df, label, cuts), F.col("__c").eqNullSafe(F.col("__k"))).drop("__k")
    chosen = F.lit(None).cast("array<bigint>")
    for value, ranks in cuts.items():
        bounds = F.array(*[F.lit(int(r)) for r in ranks]).cast("array<bigint>")
        chosen = F.when(F.col("__c").eqNullSafe(F.lit(value)), bounds).otherwise(chosen)
    return intervals.withColumn("__cuts", chosen)


def _cut_table(df: DataFrame, label: str, cuts: Mapping[object, Sequence[int]]) -> DataFrame:
    """One row per class: its value and its rank boundaries."""
    kind = T.StructType([T.StructField("__k", df.schema[label].dataType), T.StructField("__cuts", T.ArrayType(T.LongType()))])
    return df.sparkSession.createDataFrame([(c, [int(r) for r in ranks]) for c, ranks in cuts.items()], kind)


def _part_of(cuts: Column, rank: Column) -> Column:
    return F.size(F.filter(cuts, lambda bound: bound < rank))


def partition_by_rank(
    df: DataFrame,
    *,
    label: str,
    ids: Sequence[str],
    cuts: Mapping[object, Sequence[int]],
    seed: int,
    part: str = "part",
    total: int | None = None,
    slice_bits: int | None = None,
) -> DataFrame:
    """Number of class boundaries below each row's 1-based rank in hashed-id order."""
    rows = total or max(1, sum(class_counts(df, label).values()))
    # Slices are the top bits of the hash, so the order is the order of the hashes however many slices there are.
    bits = slice_bits or max(4, (rows // ROWS_PER_SLICE).bit_length())
    hashed = df.withColumn("__h", hash_order(*ids, seed=seed)).withColumn("__s", F.shiftright("__h", 64 - bits))
    bounds = F.col("__cuts")
    lower = Window.partitionBy("__c").orderBy("__t").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        hashed.groupBy(F.col(label).alias("__c"), F.col("__s").alias("__t"))
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(lower), F.lit(0)))
    )
    intervals = _with_cuts(counted, df, label, cuts).withColumns(
        {
            "__first": _part_of(bounds, F.col("__before") + 1),
            "__last": _part_of(bounds, F.col("__before") + F.col("__n")),
        }
    ).drop("__n")
    # One row per class and slice of 250,000 rows; broadcast where that is provably small, else joined on the slice.
    same = F.col(label).eqNullSafe(F.col("__c")) & (F.col("__s") == F.col("__t"))
    small = len(cuts) << bits <= BROADCAST_ROWS
    placed = hashed.join(F.broadcast(intervals) if small else intervals, same)
    settled = placed.filter("__first = __last").withColumn(part, F.col("__first"))
    inside = Window.partitionBy("__c", "__t").orderBy("__h", *ids)
    ranked = placed.filter("__first <> __last").withColumn("__r", F.row_number().over(inside) + F.col("__before"))
    contested = ranked.withColumn(part, _part_of(bounds, F.col("__r"))).drop("__r")
    return settled.unionByName(contested).drop("__h", "__s", "__c", "__t", "__before", "__first", "__last", "__cuts")


def stratified_sample(df: DataFrame, *, label: str, ids: Sequence[str], size: int, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows with the class mix of the table; the table itself when it is not larger."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    if size >= total:
        return df
    quotas = proportional_quotas(counts, size)
    parted = partition_by_rank(
        df, label=label, ids=ids, cuts={c: [q] for c, q in quotas.items()}, seed=seed, part="__part", total=total
    )
    return parted.filter("__part = 0").drop("__part")


def stratified_split(
    df: DataFrame, *, label: str, ids: Sequence[str], holdout: float = 0.2, seed: int = 42, flag: str = "is_holdout"
) -> DataFrame:
    """The table with a hold-out flag; both sides keep the class mix."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    quotas = proportional_quotas(counts, math.ceil(total * holdout))
    parted = partition_by_rank(
        df, label=label, ids=ids, cuts={c: [q] for c, q in quotas.items()}, seed=seed, part="__part", total=total
    )
    return parted.withColumn(flag, F.col("__part") == 0).drop("__part")


def stratified_folds(
    df: DataFrame, *, label: str, ids: Sequence[str], k: int = 5, seed: int = 42, fold: str = "fold"
) -> DataFrame:
    """Shuffled stratified folds; a class differs by at most one row between folds."""
    counts = class_counts(df, label)

    def ends(n: int) -> list[int]:
        sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
        return [sum(sizes[: i + 1]) for i in range(k - 1)]

    return partition_by_rank(
        df, label=label, ids=ids, cuts={c: ends(n) for c, n in counts.items()}, seed=seed, part=fold,
        total=sum(counts.values()),
    )


def random_sample(df: DataFrame, n: int, *, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows whose hashed ids come first; any ``n``, as no task holds more than a slice."""
    total = df.count()
    if n >= total:
        return df
    whole = df.withColumn("__all", F.lit(0))
    parted = partition_by_rank(whole, label="__all", ids=ids, cuts={0: [n]}, seed=seed, part="__part", total=total)
    return parted.filter("__part = 0").drop("__part", "__all")


def undersample(
    df: DataFrame, *, label: str, ids: Sequence[str], ratio: float = 0.7, minority: object = 1, seed: int = 42
) -> DataFrame:
    """Keep every minority row and as many others as make minority / majority equal ``ratio``."""
    counts = class_counts(df, label)
    quota = int(counts.get(minority, 0) / ratio)
    cuts = {c: [n if c == minority else min(n, quota)] for c, n in counts.items()}
    parted = partition_by_rank(
        df, label=label, ids=ids, cuts=cuts, seed=seed, part="__part", total=sum(counts.values())
    )
    return parted.filter("__part = 0").drop("__part")


def class_weight_ratio(df: DataFrame, label: str, positive: object = 1) -> DataFrame:
    """negatives / max(positives, 1): the weight of a positive row for an unbalanced training set."""
    hits = F.count_if(F.col(label) == F.lit(positive))
    others = F.count_if(F.col(label) != F.lit(positive))
    return df.agg(
        hits.alias("positives"), others.alias("negatives"), safe_ratio(others, F.greatest(hits, F.lit(1))).alias("ratio")
    )


def balanced_weights(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    """Weight total / (classes * class rows) per row."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    column = None
    for value, n in counts.items():
        share = F.lit(total / (len(counts) * n))
        hit = F.col(label).eqNullSafe(F.lit(value))
        column = F.when(hit, share) if column is None else column.when(hit, share)
    return df.withColumn(weight, column)
