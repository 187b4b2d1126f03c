"""Logistic regressions of many penalties, strengths and folds, trained together: one pass over the rows per step.

Every setting of every fold is a problem of its own on the driver. Each names the point where it needs loss and gradient
next; one Spark job evaluates all of these points, so the number of jobs is that of the slowest problem, not their sum. A
task multiplies its rows of a fold with the coefficients of all the fold's settings at once and emits one sum per number.

With few features a pass also sums the second derivatives, and a problem takes Newton steps, the L1 penalty being part of
the quadratic model that the driver solves. Flat directions (all levels of a category beside the intercept), which only the
penalty decides, then cost no passes. With many features, where these sums would be too many, a problem has a quasi-Newton
memory (limited-memory BFGS, with the orthant-wise rules for an L1 penalty).

Features are centred and scaled inside the passes; penalties hold for the coefficients of the features as they are.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, stored

MEMORY, STEPS, HALVINGS = 10, 500, 40
TOLERANCE, NOISE = 1e-9, 1e-15
#: Second derivatives that a task may sum in a pass; share of the loss that a Newton step must promise to be looked at.
CURVATURES, PROMISE = 200_000, 1e-11
#: Of a stored block of rows.
BLOCK_BYTES = 1 << 19


@dataclass(frozen=True)
class Penalty:
    """``strength`` times the sum of absolute values (kind "l1") or half the sum of squares ("l2") of the coefficients,
    beside the mean log loss; the intercept is free."""

    kind: str
    strength: float


@dataclass(frozen=True)
class LinearModel:
    coefficients: np.ndarray
    intercept: float
    passes: int


Point = Generator[np.ndarray, tuple[float, np.ndarray, np.ndarray | None], tuple[np.ndarray, int]]


def lowest(bend: np.ndarray, slope: np.ndarray, l1: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Minimum of ``slope @ z + z @ bend @ z / 2 + l1 @ |z|``, by a search over the signs of its entries.

    Steps solve the equations of the present signs and end at the best of the points where one changes. ``bend`` may be
    singular: a small multiple of the unit matrix bounds the steps, not the minimum.
    """
    z, free = start.copy(), l1 == 0
    sign, active = np.sign(start), (start != 0) | free
    firm = bend + np.eye(len(z)) * max(1e-10 * bend.diagonal().max(), 1e-14)
    near, settled = 1e-13 * (1.0 + np.abs(slope).max()), False

    def height(points: np.ndarray) -> np.ndarray:
        return points @ slope + 0.5 * ((points @ bend) * points).sum(axis=1) + np.abs(points) @ l1

    for _ in range(50 + 20 * len(z)):
        down = -(slope + bend @ z + l1 * sign * ~free)
        added = settled or not active.any() or np.abs(down[active]).max() <= near
        if added:
            excess = np.where(active, 0.0, np.abs(slope + bend @ z) - l1)
            place = int(excess.argmax())
            if excess[place] <= near:
                break
            active[place], sign[place] = True, -np.sign(slope[place] + bend[place] @ z)
            down = -(slope + bend @ z + l1 * sign * ~free)
        step, own = np.zeros(len(z)), np.ix_(active, active)
        for _ in range(2):  # the second takes back what the multiple has bent
            step[active] += np.linalg.solve(firm[own], down[active] - bend[own] @ step[active])
        crossed = active & ~free & (z != 0) & (z * (z + step) < 0)
        at = np.append(-z[crossed] / step[crossed], 1.0)
        points = z + at[:, None] * step
        points[np.arange(len(at) - 1), np.flatnonzero(crossed)] = 0.0
        heights = height(points)
        best = int(heights.argmin())
        if not heights[best] < height(z[None])[0]:  # as low as doubles allow
            if added:
                break
            settled = True  # with the present signs; entries at zero are still to be tried
            continue
        z, settled = points[best], False
        active = (z != 0) | free
        sign = np.sign(z)
    return z


def newton(size: int, l1: np.ndarray, l2: np.ndarray) -> Point:
    """As ``minimised``, from second derivatives: each step leads to the minimum of the quadratic model with the penalty."""
    x, asked = np.zeros(size), 1

    def penalty(x: np.ndarray) -> float:
        return 0.5 * float(l2 @ (x * x)) + float(l1 @ np.abs(x))

    loss, gradient, bend = yield x
    for _ in range(STEPS):
        slope, bend = gradient + l2 * x, bend + np.diag(l2)
        direction = lowest(bend, slope - bend @ x, l1, x) - x
        fall = slope @ direction + float(l1 @ (np.abs(x + direction) - np.abs(x)))
        promise, value = -fall - 0.5 * direction @ bend @ direction, loss + penalty(x)
        if not promise > PROMISE * abs(value) + NOISE:
            return (x + direction if promise > 0 else x), asked  # the rest is a step's square
        step = 1.0
        for _ in range(HALVINGS):
            moved = x + step * direction
            asked += 1
            loss, gradient, bend = yield moved
            if loss + penalty(moved) <= value + 1e-4 * step * fall + NOISE * abs(value):
                break
            step /= 2
        else:
            break  # no step lowers the value any more
        x = moved
    return x, asked


def minimised(size: int, l1: np.ndarray, l2: np.ndarray) -> Point:
    """Asks for loss and gradient at one point after the other; returns the minimum and how many it has asked for."""

    def full(x: np.ndarray, loss: float, gradient: np.ndarray) -> tuple[float, np.ndarray]:
        return loss + 0.5 * float(l2 @ (x * x)) + float(l1 @ np.abs(x)), gradient + l2 * x

    def steepest(x: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The gradient, at the kinks of the absolute values that of the side where the function falls, else 0."""
        at_kink = np.where(g + l1 < 0, g + l1, np.where(g - l1 > 0, g - l1, 0.0))
        return np.where(x != 0, g + l1 * np.sign(x), at_kink)

    x, asked, memory, still = np.zeros(size), 1, [], 0
    curvature = 1.0 / (0.25 + l2)  # the features are scaled, so the log loss bends by a quarter at most
    value, gradient = full(x, *(yield x)[:2])
    for _ in range(STEPS):
        slope = steepest(x, gradient)
        if np.abs(slope).max() <= TOLERANCE:
            break
        direction, weights = -slope, []
        for s, y, rho in reversed(memory):
            weights.append(rho * (s @ direction))
            direction = direction - weights[-1] * y
        direction = direction * curvature
        if memory:
            s, y, _ = memory[-1]
            direction = direction * ((s @ y) / (y @ (curvature * y)))
        for (s, y, rho), a in zip(memory, reversed(weights), strict=True):
            direction = direction + s * (a - rho * (y @ direction))
        direction = np.where((l1 > 0) & (direction * slope >= 0), 0.0, direction)
        if direction @ slope >= 0:
            direction, memory = -slope * curvature, []
        orthant = np.where(x != 0, np.sign(x), -np.sign(slope))
        step = 1.0 if memory else min(1.0, 1.0 / np.abs(slope).sum())
        for _ in range(HALVINGS):
            moved = x + step * direction
            moved = np.where((l1 > 0) & (moved * orthant < 0), 0.0, moved)
            asked += 1
            new_value, new_gradient = full(moved, *(yield moved)[:2])
            if new_value <= value + 1e-4 * (slope @ (moved - x)) + NOISE * abs(value):
                break
            step /= 2
        else:
            break  # no step lowers the value any more: as near as doubles allow
        s, y = moved - x, new_gradient - gradient
        if s @ y > 1e-14:
            memory = [*memory[1 - MEMORY :], (s, y, 1.0 / (s @ y))]
        still = still + 1 if value - new_value <= NOISE * abs(value) else 0
        x, value, gradient = moved, new_value, new_gradient
        if still == 3:
            break  # the value does not fall any more
    return x, asked


def _packed(rows: DataFrame) -> DataFrame:
    """Blocks of rows of one fold as bytes (label, weight and cells of each row), which passes read without converting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, made = np.asarray(batch["fold"]), []
            for one in np.unique(fold).tolist():
                part = batch.filter(pa.array(fold == one))
                cells = np.asarray(part["cells"].flatten(), float).reshape(part.num_rows, -1)
                block = np.column_stack([np.asarray(part["label"], float), np.asarray(part["weight"], float), cells])
                most = max(1, BLOCK_BYTES // (8 * block.shape[1]))
                made += [(one, len(x), x.tobytes()) for x in (block[i : i + most] for i in range(0, len(block), most))]
            for one, n, cells in made:
                yield pa.RecordBatch.from_arrays([pa.array([one], pa.int32()), pa.array([n], pa.int32()), pa.array([cells], pa.binary())], ["fold", "rows", "block"])

    return rows.mapInArrow(run, "fold int, rows int, block binary")


def _moments(rows: DataFrame) -> dict[int, tuple[float, int, np.ndarray, np.ndarray]]:
    """Of each fold: weight, rows, and means and standard deviations of the features (1 for constant ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for one, n, block in zip(*batch.columns, strict=True):
                one, held = one.as_py(), np.frombuffer(block.as_buffer()).reshape(n.as_py(), -1)
                w, cells = held[:, 1], held[:, 2:]
                own = [w.sum(), float(len(w)), w @ cells, w @ cells**2]
                sums[one] = own if one not in sums else [a + b for a, b in zip(sums[one], own, strict=True)]
        rows = [(one, float(a), b, c.tolist(), d.tolist()) for one, (a, b, c, d) in sums.items()]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        kinds = [pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["fold", "w", "n", "first", "second"])

    parts = rows.mapInArrow(run, "fold int, w double, n double, first array<double>, second array<double>")
    long = parts.select("fold", "w", "n", F.posexplode(F.arrays_zip("first", "second")).alias("at", "m"))
    summed = long.groupBy("fold", "at").agg(F.sum("w").alias("w"), F.sum("n").alias("n"), F.sum("m.first").alias("a"), F.sum("m.second").alias("b"))
    found: dict[int, tuple[float, int, np.ndarray, np.ndarray]] = {}
    table = summed.toPandas()
    for fold, part in table.sort_values("at").groupby("fold"):
        w = float(part.w.iloc[0])
        mean = part.a.to_numpy() / w
        spread = np.sqrt(np.maximum(part.b.to_numpy() / w - mean**2, 0.0))
        found[int(fold)] = (w, int(part.n.iloc[0]), mean, np.where(spread > 1e-9 * np.maximum(1.0, np.abs(mean)), spread, 1.0))
    return found


def _evaluated(rows: DataFrame, points: dict[int, np.ndarray], scales: dict[int, tuple[np.ndarray, np.ndarray]], curved: bool) -> dict[int, np.ndarray]:
    """Sums of loss and gradient (settings x (1 + size)) of each fold at its points, in one pass. ``curved``: and behind
    them the upper triangles of the second derivatives."""
    corners = {fold: np.triu_indices(p.shape[1]) for fold, p in points.items()}
    widths = {fold: 1 + p.shape[1] + (len(corners[fold][0]) if curved else 0) for fold, p in points.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {fold: np.zeros((len(p), widths[fold])) for fold, p in points.items()}
        for batch in batches:
            for one, n, block in zip(*batch.columns, strict=True):
                one = one.as_py()
                if one not in points:
                    continue
                mean, spread = scales[one]
                size, held = len(mean) + 1, np.frombuffer(block.as_buffer()).reshape(n.as_py(), -1)
                cells = np.ones((len(held), size))
                cells[:, :-1] = (held[:, 2:] - mean) / spread
                y, w = held[:, :1], held[:, 1:2]
                margin = cells @ points[one].T
                sums[one][:, 0] += (w * (np.logaddexp(0.0, margin) - y * margin)).sum(axis=0)
                chance = 1 / (1 + np.exp(-margin))
                sums[one][:, 1 : 1 + size] += (w * (chance - y)).T @ cells
                if curved:
                    for place, bend in enumerate((w * chance * (1 - chance)).T):
                        sums[one][place, 1 + size :] += ((cells * bend[:, None]).T @ cells)[corners[one]]
        for one, found in sums.items():
            size = found.size
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, one, np.int32)), pa.array(np.arange(size)), pa.array(found.ravel())], ["fold", "at", "value"])

    parts = rows.mapInArrow(run, "fold int, at long, value double").groupBy("fold", "at").agg(F.sum("value").alias("value"))
    table = parts.toArrow()
    fold, at, value = (np.asarray(table[c]) for c in ("fold", "at", "value"))
    out = {}
    for one, p in points.items():
        flat = np.zeros(len(p) * widths[one])
        chosen = fold == one
        flat[at[chosen]] = value[chosen]
        out[one] = flat.reshape(len(p), -1)
    return out


def _square(corner: np.ndarray, size: int) -> np.ndarray | None:
    """The symmetric matrix of an upper triangle; None of nothing."""
    if not len(corner):
        return None
    whole = np.zeros((size, size))
    whole[np.triu_indices(size)] = corner
    return whole + np.triu(whole, 1).T


def fit_logistic_grid(rows: DataFrame, strengths: Sequence, *, fold: str = "fold", features: str = "features", label: str = "label", weight: str | None = None) -> dict[int, list[LinearModel]]:
    """Models of every fold, in the order of the settings.

    ``rows`` has the training rows of each fold, named by ``fold`` (a row that trains several folds comes several
    times); all vectors of a fold have the same width. A setting is a Penalty, or a function of the number of the
    fold's rows that gives one. NULL features are not allowed; a fold without rows has no models.
    """
    spark = rows.sparkSession
    cells = F.col(features).cast("array<double>") if rows.schema[features].dataType.typeName() == "array" else vector_to_array(features)
    weights: Column = F.col(weight).cast("double") if weight else F.lit(1.0)
    plain = rows.select(F.col(fold).cast("int").alias("fold"), F.col(label).cast("double").alias("label"), weights.alias("weight"), cells.alias("cells"))
    plain, path = stored(_packed(plain), "linear-grid")
    moments = _moments(plain)
    curved = sum(len(strengths) * (len(mean) + 1) * (len(mean) + 2) // 2 for _, _, mean, _ in moments.values()) <= CURVATURES
    waiting: dict[tuple[int, int], Point] = {}
    asked: dict[tuple[int, int], np.ndarray] = {}
    done: dict[tuple[int, int], tuple[np.ndarray, int]] = {}
    for one, (_, n, mean, spread) in moments.items():
        for place, setting in enumerate(strengths):
            penalty = setting if isinstance(setting, Penalty) else setting(n)
            size = len(mean) + 1
            by_kind = {kind: np.zeros(size) for kind in ("l1", "l2")}
            # the solver works on coefficients times their feature's spread
            by_kind[penalty.kind][:-1] = penalty.strength / (spread if penalty.kind == "l1" else spread**2)
            waiting[one, place] = (newton if curved else minimised)(size, by_kind["l1"], by_kind["l2"])
            asked[one, place] = next(waiting[one, place])
    while asked:
        folds = sorted({one for one, _ in asked})
        order = {one: [place for f, place in asked if f == one] for one in folds}
        points = {one: np.stack([asked[one, place] for place in order[one]]) for one in folds}
        found = _evaluated(plain, points, {one: moments[one][2:] for one in folds}, curved)
        asked = {}
        for one in folds:
            whole, size = moments[one][0], points[one].shape[1]
            for place, sums in zip(order[one], found[one] / whole, strict=True):
                try:
                    asked[one, place] = waiting[one, place].send((float(sums[0]), sums[1 : 1 + size], _square(sums[1 + size :], size)))
                except StopIteration as end:
                    done[one, place] = end.value
    discard(spark, path)
    models: dict[int, list[LinearModel]] = {}
    for one, (_, _, mean, spread) in moments.items():
        models[one] = []
        for place in range(len(strengths)):
            x, passes = done[one, place]
            coefficients = x[:-1] / spread
            models[one].append(LinearModel(coefficients, float(x[-1] - coefficients @ mean), passes))
    return models


def probabilities(cells: Column, models: Sequence[LinearModel]) -> Column:
    """Array of the probability of class 1 by each of the models, for an array column."""
    coefficients, intercepts = np.stack([m.coefficients for m in models]), np.array([m.intercept for m in models])

    @F.pandas_udf("array<double>")
    def chances(batch: pd.Series) -> pd.Series:
        if not len(batch):
            return pd.Series([], dtype=object)
        margin = np.stack(batch.to_numpy()).astype(float) @ coefficients.T + intercepts
        return pd.Series(list(1 / (1 + np.exp(-margin))))

    return chances(cells)


def as_classifier(spark, model: LinearModel) -> LogisticRegressionModel:
    """The built-in model with these coefficients, so that it can be saved and applied like any other."""
    ml = spark._jvm.org.apache.spark.ml
    values = spark.sparkContext._gateway.new_array(spark._jvm.double, len(model.coefficients))
    for place, value in enumerate(model.coefficients):
        values[place] = float(value)
    uid = f"logreg_{id(model):x}"
    return LogisticRegressionModel(ml.classification.LogisticRegressionModel(uid, ml.linalg.Vectors.dense(values), model.intercept))
