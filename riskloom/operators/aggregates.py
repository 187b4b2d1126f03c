"""Spec-driven group aggregation: one pass over the child table, no join back.

A spec maps columns to their aggregates. Whole-table aggregates, subset
aggregates and category shares of a table all land in one ``groupBy``, so the child table is shuffled
once on its client key, after a map-side partial aggregation that also flattens a hot client. Distinct counts are
the exception: inside that ``groupBy`` they would send its wide buffers through two shuffles, so they are counted from
the narrow pairs of key and value, and joined on the key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import sum0

AGGREGATES = {
    "min": F.min,
    "max": F.max,
    "mean": lambda c: F.avg(c.cast("double")),
    "sum": sum0,
    "var": lambda c: F.var_samp(c.cast("double")),
    "size": lambda c: F.count("*"),
}

#: Counted apart from the others.
DISTINCT = "nunique"

Spec = Mapping[str, Sequence[str]]


@dataclass(frozen=True)
class Subset:
    """Aggregates over the rows where ``column = value``; NULL for a group without such rows."""

    prefix: str
    column: str
    value: str
    spec: Spec


def feature_name(prefix: str, *parts: object) -> str:
    """``PREFIX_COLUMN_AGG``, upper-cased parts, empty parts skipped."""
    tail = "_".join(str(p).strip().upper() for p in parts if p not in (None, ""))
    return f"{prefix}_{tail}"


def spec_columns(spec: Spec, prefix: str) -> list[Column]:
    return [
        AGGREGATES[agg](F.col(column)).alias(feature_name(prefix, column, agg))
        for column, aggs in spec.items()
        for agg in aggs
        if agg != DISTINCT
    ]


def distinct_counts(df: DataFrame, key: str, column: str, name: str) -> DataFrame:
    """Rows (key, name): distinct non-NULL values of a column per key."""
    pairs = df.filter(F.col(column).isNotNull()).select(key, F.col(column).alias("__value")).distinct()
    return pairs.groupBy(key).agg(F.count("*").alias(name))


def subset_columns(subset: Subset) -> list[Column]:
    inside = F.col(subset.column) == F.lit(subset.value)
    hits = F.count_if(inside)
    columns = []
    for column, aggs in subset.spec.items():
        for agg in aggs:
            value = AGGREGATES[agg](F.when(inside, F.col(column)))
            columns.append(F.when(hits > 0, value).alias(feature_name(subset.prefix, column, agg)))
    return columns


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, level): the distinct non-NULL levels, however many. Save it next to the data to score later."""
    long = df.unpivot([], [F.col(c).cast("string").alias(c) for c in columns], "column", "level")
    return long.filter(F.col("level").isNotNull()).distinct()


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Levels per column, sorted: the fitted part of the wide share features.

    Every level becomes a column of the wide table, so the list reaches the driver like the table's own schema.
    For columns with more levels than a table should have columns, use ``share_rows``.
    """
    found: dict[str, list[str]] = {c: [] for c in columns}
    for column, level in level_table(df, columns).collect() if columns else ():
        found[column].append(level)
    return {c: sorted(levels) for c, levels in found.items()}


def share_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows (key, column, level, share) for any number of levels; a NULL level stands for missing values.

    Only levels a group has get a row; nothing is collected, and copies of a level collapse before the shuffle.
    """
    known = df.filter(F.col(key).isNotNull())
    long = known.unpivot([key], [F.col(c).cast("string").alias(c) for c in columns], "column", "level")
    counted = long.groupBy(key, "column", "level").agg(F.count("*").alias("n"))
    total = known.groupBy(key).agg(F.count("*").alias("rows"))
    return counted.join(total, key).select(key, "column", "level", (F.col("n") / F.col("rows")).alias("share"))


def share_columns(levels: Mapping[str, Sequence[str]], prefix: str) -> list[Column]:
    """Share of a group's rows in each level, and in NULL (present for every column)."""
    columns = []
    for column, values in levels.items():
        text = F.col(column).cast("string")
        for value in values:
            hit = F.coalesce((text == F.lit(value)).cast("double"), F.lit(0.0))
            columns.append(F.avg(hit).alias(feature_name(prefix, f"{column}_{value}", "mean")))
        columns.append(F.avg(text.isNull().cast("double")).alias(feature_name(prefix, f"{column}_nan", "mean")))
    return columns


def aggregate_by(
    df: DataFrame,
    key: str,
    *,
    prefix: str,
    spec: Spec | None = None,
    subsets: Sequence[Subset] = (),
    levels: Mapping[str, Sequence[str]] | None = None,
    extra: Sequence[Column] = (),
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per non-NULL key. ``distinct`` names further distinct counts: result column -> counted column."""
    counted = {feature_name(prefix, c, DISTINCT): c for c, aggs in (spec or {}).items() if DISTINCT in aggs}
    counted |= distinct or {}
    columns = [
        *spec_columns(spec or {}, prefix),
        *share_columns(levels or {}, prefix),
        *extra,
        *[c for subset in subsets for c in subset_columns(subset)],
    ]
    known = df.filter(F.col(key).isNotNull())
    wide = known.groupBy(key).agg(*columns)
    for name, column in counted.items():
        wide = wide.join(distinct_counts(known, key, column, name), key, "left").fillna(0, [name])
    return wide
