"""Column expressions that give NULL, NaN and zero the meaning the analytics rely on.

Every helper is a composition of built-in functions, so it stays on the JVM side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str


def _col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def missing(value: ColumnLike) -> Column:
    return _col(value).isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN marks a missing number at the sources; Spark would treat it as the largest value."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floating}) if floating else df


def number(value: ColumnLike) -> Column:
    """Lenient numeric coercion: unreadable text and NaN become NULL."""
    as_double = _col(value).try_cast("double")
    return F.nanvl(as_double, F.lit(None))


def null_if(value: ColumnLike, sentinel) -> Column:
    return F.nullif(_col(value), F.lit(sentinel))


def safe_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    return F.try_divide(_col(numerator).cast("double"), F.nullif(_col(denominator).cast("double"), F.lit(0.0)))


def share(part: ColumnLike, whole: ColumnLike) -> Column:
    """Ratio reported as 0.0 when there is nothing to divide by."""
    return F.coalesce(safe_ratio(part, whole), F.lit(0.0))


def sum0(value: ColumnLike) -> Column:
    """Sum that is 0 for an all-NULL group."""
    return F.coalesce(F.sum(_col(value)), F.lit(0))


def clip_low(value: ColumnLike, low: float = 0.0) -> Column:
    """Lower clip that keeps NULL (``greatest`` would skip it)."""
    column = _col(value)
    return F.when(column < low, F.lit(low)).otherwise(column)


def sum_available(columns: Sequence[ColumnLike]) -> Column:
    """Row-wise sum that skips NULL; 0 when nothing is available."""
    total = F.lit(0)
    for column in columns:
        total = total + F.coalesce(_col(column), F.lit(0))
    return total


def _available_count(columns: Sequence[ColumnLike]) -> Column:
    return sum_available([_col(c).isNotNull().cast("int") for c in columns])


def average_available(columns: Sequence[ColumnLike]) -> Column:
    """Row-wise mean over the non-NULL values."""
    return safe_ratio(sum_available(columns), _available_count(columns))


def spread_available(columns: Sequence[ColumnLike]) -> Column:
    """Row-wise sample standard deviation over the non-NULL values (NULL below two values)."""
    mean = average_available(columns)
    squares = sum_available([F.pow(_col(c) - mean, F.lit(2.0)) for c in columns])
    count = _available_count(columns)
    return F.when(count > 1, F.sqrt(safe_ratio(squares, count - 1)))


def best_of(columns: Sequence[ColumnLike], *, largest: bool) -> Column:
    picked = [_col(c) for c in columns]
    if len(picked) == 1:
        return picked[0]
    return F.greatest(*picked) if largest else F.least(*picked)


def safe_corr(x: ColumnLike, y: ColumnLike) -> Column:
    """Pearson correlation over pairwise-complete rows; NULL when a side is constant."""
    a, b = _col(x).cast("double"), _col(y).cast("double")
    a_pair, b_pair = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    spread = F.stddev_pop(a_pair) * F.stddev_pop(b_pair)
    return F.try_divide(F.covar_pop(a_pair, b_pair), F.nullif(spread, F.lit(0.0)))


def f_beta(precision: ColumnLike, recall: ColumnLike, beta: float = 2.0) -> Column:
    weight = beta * beta
    p, r = _col(precision), _col(recall)
    return share((1.0 + weight) * p * r, weight * p + r)


def isclose(a: ColumnLike, b: ColumnLike, *, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    left, right = _col(a), _col(b)
    return F.abs(left - right) <= F.lit(atol) + F.lit(rtol) * F.abs(right)


def linspace(index: ColumnLike, points: int) -> Column:
    """``index``-th of ``points`` evenly spaced values on [0, 1] (multiply by the step, do not divide)."""
    return _col(index).cast("double") * F.lit(1.0 / (points - 1))


def bucket_index(splits: ColumnLike, value: ColumnLike, *, max_splits: int) -> Column:
    """Number of entries of the ascending array ``splits`` that are <= ``value``.

    Binary search in log2(max_splits) steps: a probe past the end of the array reads NULL, compares
    as unknown and is therefore not taken.
    """
    edges, probe = _col(splits), _col(value)
    step, steps = 1, []
    while step <= max_splits:
        steps.append(step)
        step *= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in reversed(steps)]),
        F.lit(0),
        lambda found, jump: F.when(F.get(edges, found + jump - 1) <= probe, found + jump).otherwise(found),
    )


def hash_order(*columns: ColumnLike, seed: int) -> Column:
    """Deterministic pseudo-random order: re-computation of a lost task gives the same values."""
    return F.xxhash64(*[_col(c) for c in columns], F.lit(seed))
