"""Distributed order statistics.

A window without a partition key, or with one hot key, puts every row in one task; the built-in
exact ``percentile`` keeps every distinct value of a group in one task's memory. The operators here
reach the same exact results in bounded tasks:

1. pre-aggregate to one row per (keys, value), so copies of a value collapse before the shuffle;
2. cut each group's value range at approximate quantiles of its distinct values (a bounded,
   mergeable sketch), which gives balanced buckets whatever the distribution;
3. take running sums inside (keys, bucket) and add the sum of all lower buckets, which comes from a
   table of at most ``buckets`` rows per group.

The pre-aggregated shuffle is read by all three steps; Spark reuses that exchange, so the input is
scanned once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.columns import ColumnLike

MIN_BUCKETS = 64


def bucket_count(df: DataFrame) -> int:
    """Buckets per group: twice the session's shuffle partitions, which are set by the size of the data."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_BUCKETS, 2 * partitions)


def match_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL = NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = None
    for key in keys:
        part = left[key].eqNullSafe(renamed[f"__{key}"])
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the per-group columns of ``right``; without keys it is a one-row table, read as a scalar."""
    if keys:
        return match_keys(left, right, keys)
    row = right.select(F.struct(*right.columns).alias("row")).scalar()
    held = left.withColumn("__row", row)
    return held.select(*left.columns, *[F.col(f"__row.{c}").alias(c) for c in right.columns])


def _group(keys: Sequence[str]) -> list[Column]:
    """The group keys as one struct column: it is never NULL, and NULL fields compare as equal.

    Plain equality on it keeps the hash partitioning of the windows usable for the joins.
    """
    return [F.struct(*keys).alias("__k")] if keys else []


def _with_bucket(df: DataFrame, value: str, max_cuts: int) -> DataFrame:
    """``functions.bucket_index`` of ``value`` in ``__cuts``, one compiled column per step of the search."""
    found = F.lit(0)
    for power in reversed(range(max_cuts.bit_length())):
        jump = 1 << power
        taken = F.get("__cuts", found + (jump - 1)) <= F.col(value)
        df = df.withColumn("__bucket", found + F.when(taken, jump).otherwise(0))
        found = F.col("__bucket")
    return df


def running_totals(
    df: DataFrame,
    *,
    value: str,
    measures: Mapping[str, Column],
    keys: Sequence[str] = (),
    buckets: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """One row per (keys, value), ascending running sums per group.

    Output: keys, value, each measure ``m``, ``m_before`` (sum over strictly smaller values) and
    ``m_total``. NULL values are left out; measures must not be NULL. ``distinct`` declares that the
    input already has one row per (keys, value).
    """
    keys, names = list(keys), list(measures)
    buckets = buckets or bucket_count(df)
    present = df.filter(F.col(value).isNotNull())
    number = F.col(value).cast("double").alias(value)
    if distinct:
        counts = present.select(*_group(keys), number, *[e.alias(n) for n, e in measures.items()])
    else:
        grouped = present.groupBy(*keys, number).agg(*[F.sum(e).alias(n) for n, e in measures.items()])
        counts = grouped.select(*_group(keys), value, *names)
    group = ["__k"] if keys else []

    # Reading the measures here too keeps this branch's shuffle identical to the others', so it is reused.
    counts = counts.withColumn("__seen", F.when(F.greatest(*names, F.lit(0)) >= 0, F.col(value)))
    cuts = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    layout = counts.groupBy(*group).agg(
        F.expr(f"array_distinct(percentile_approx(__seen, array({cuts}), {buckets * 8}))").alias("__cuts")
    )
    counts = counts.drop("__seen")
    if keys:
        # A group's rows are met by its cuts in several salted places, so no task holds all values of one group.
        salts = max(1, buckets // 8)
        spread = layout.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        # never NULL, so that no filter on it keeps this branch's shuffle apart from the layout's
        salted = counts.withColumn("__salt", F.coalesce(F.pmod(F.hash(value), F.lit(salts)), F.lit(0)))
        laid_out = salted.join(spread, ["__k", "__salt"]).drop("__salt")
    else:
        laid_out = attach(counts, layout, [])
    placed = _with_bucket(laid_out, value, buckets - 1).drop("__cuts")
    slot = [*group, "__bucket"]

    below = Window.partitionBy(*slot).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"{m}_before": F.coalesce(F.sum(m).over(below), F.lit(0)) for m in names})

    # At most ``buckets`` rows per group.
    lower = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = placed.groupBy(*slot).agg(*[F.sum(m).alias(f"__sum_{m}") for m in names]).select(
        *slot,
        *[F.coalesce(F.sum(f"__sum_{m}").over(lower), F.lit(0)).alias(f"__off_{m}") for m in names],
        *[F.sum(f"__sum_{m}").over(whole).alias(f"{m}_total") for m in names],
    )
    return local.join(offsets, slot).select(
        *[F.col(f"__k.{k}").alias(k) for k in keys],
        value,
        *names,
        *[(F.col(f"{m}_before") + F.col(f"__off_{m}")).alias(f"{m}_before") for m in names],
        *[f"{m}_total" for m in names],
    )


def quantile_hits(value: str, quantiles: Sequence[float], *, count: str = "n") -> Column:
    """Aggregate over a ``running_totals`` table: the order statistics that enclose each quantile.

    A row contributes only the positions it holds, so the collected array has two entries per quantile
    (lower and upper neighbour), whatever the size of the group.
    """
    n, before, total = F.col(count), F.col(f"{count}_before"), F.col(f"{count}_total")
    cells = [
        f"named_struct('slot', {2 * i + side}, 'q', {float(q)!r}D, 'side', {side})"
        for i, q in enumerate(quantiles)
        for side in (0, 1)
    ]
    probes = F.expr(f"array({', '.join(cells)})")

    def position(probe: Column) -> Column:
        spot = probe["q"] * (total - 1).cast("double")
        return F.when(probe["side"] == 0, F.floor(spot)).otherwise(F.ceil(spot))

    held = F.filter(probes, lambda p: (before <= position(p)) & (position(p) < before + n))
    marked = F.transform(
        held,
        lambda p: F.struct(
            p["slot"].alias("slot"),
            F.col(value).alias("value"),
            (p["q"] * (total - 1) - F.floor(p["q"] * (total - 1))).alias("weight"),
        ),
    )
    # Few rows hold a position: a compiled test keeps the array work off all the others.
    b, t = f"`{count}_before`", f"(`{count}_total` - 1)"
    tests = [
        f"({b} <= {side}({float(q)!r}D * {t}) AND {side}({float(q)!r}D * {t}) < {b} + `{count}`)"
        for q in quantiles
        for side in ("floor", "ceil")
    ]
    return F.sort_array(F.flatten(F.collect_list(F.when(F.expr(" OR ".join(tests)), marked))))


def quantile_at(hits: ColumnLike, index: Column | int) -> Column:
    """Linearly interpolated ``index``-th quantile of a ``quantile_hits`` array; NULL for an empty group."""
    found = F.col(hits) if isinstance(hits, str) else hits
    low, high = F.get(found, index * 2), F.get(found, index * 2 + 1)
    return low["value"] + (high["value"] - low["value"]) * low["weight"]


def exact_quantiles(
    df: DataFrame,
    *,
    value: str,
    quantiles: Mapping[str, float],
    keys: Sequence[str] = (),
    weight: Column | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group, computed without collecting a group in one task."""
    totals = running_totals(
        df, value=value, measures={"n": F.lit(1) if weight is None else weight}, keys=keys, buckets=buckets
    )
    hits = totals.groupBy(*keys).agg(quantile_hits(value, list(quantiles.values())).alias("__hits"))
    return hits.select(*keys, *[quantile_at("__hits", i).alias(name) for i, name in enumerate(quantiles)])


def _hash_slice(column: str, slices: int) -> Column:
    """Slice of a 64-bit hash, in the order of the hash's top 32 bits."""
    return F.floor((F.shiftright(column, 32) + F.lit(1 << 31)) * F.lit(slices) / F.lit(1 << 32)).cast("int")


def hashed_rank(
    df: DataFrame, *, keys: Sequence[str], ids: Sequence[str], seed: int, rank: str = "rank", buckets: int | None = None
) -> DataFrame:
    """1-based rank of every row in its group, in hashed-id order.

    Hash values are uniform, so equal slices of the hash range are balanced even when one group holds
    most rows; each slice is ranked alone and shifted by the row count of the lower slices.
    """
    buckets = buckets or bucket_count(df)
    ordered = df.select("*", *_group(keys), F.xxhash64(*ids, F.lit(seed)).alias("__hash"))
    ordered = ordered.withColumn("__slice", _hash_slice("__hash", buckets))
    group = ["__k"] if keys else []
    slot = [*group, "__slice"]
    lower = Window.partitionBy(*group).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(*slot)
        .agg(F.count("*").alias("__n"))
        .select(*slot, F.coalesce(F.sum("__n").over(lower), F.lit(0)).alias("__off"))
    )
    local = ordered.withColumn("__local", F.row_number().over(Window.partitionBy(*slot).orderBy("__hash", *ids)))
    ranked = local.join(offsets, slot)
    return ranked.select(*df.columns, (F.col("__local") + F.col("__off")).alias(rank))
