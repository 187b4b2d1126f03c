"""Multilayer perceptron for two classes: mini-batch gradients inside tasks, an L2 term, and early stopping.

A round is one pass over the rows. Each task starts from the common weights, takes mini-batches of its training rows in
an order drawn by hash, and the tasks' weights are averaged by their rows. In the same pass every task counts how many
of its held-out rows (a share drawn by hash of the row) the common weights classify rightly; training ends when that
share has not risen for ``patience`` rounds, and the best weights are kept.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.boosting import _Columns
from riskloom.session import discard, stored


@dataclass(frozen=True)
class PerceptronSettings:
    hidden: tuple[int, ...] = (64,)
    alpha: float = 1e-4
    max_rounds: int = 300
    patience: int = 10
    tolerance: float = 1e-4
    held_out: float = 0.1
    batch_rows: int = 200
    rate: float = 1e-3
    seed: int = 42


def _network():
    """The passes over a batch, as functions of one flat array: (unpack, forward, gradient)."""

    def unpack(flat: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
        parts, at = [], 0
        for a, b in zip(layers[:-1], layers[1:], strict=True):
            parts.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
            at += a * b + b
        return parts

    def forward(flat: np.ndarray, layers: Sequence[int], rows: np.ndarray) -> list[np.ndarray]:
        seen = [rows]
        parts = unpack(flat, layers)
        for place, (weights, bias) in enumerate(parts):
            out = seen[-1] @ weights + bias
            seen.append(np.maximum(out, 0.0) if place + 1 < len(parts) else out)
        return seen

    def gradient(flat: np.ndarray, layers: Sequence[int], rows: np.ndarray, labels: np.ndarray, alpha: float) -> tuple[float, np.ndarray]:
        """Mean log loss plus half of alpha times the squared weights (not the biases) by the rows of the batch."""
        seen, parts = forward(flat, layers, rows), unpack(flat, layers)
        n, margin = len(rows), seen[-1][:, 0]
        loss = float((np.logaddexp(0.0, margin) - labels * margin).mean())
        loss += 0.5 * alpha * sum(float((w * w).sum()) for w, _ in parts) / n
        back = ((1 / (1 + np.exp(-margin)) - labels) / n)[:, None]
        out = []
        for (weights, _), inputs in zip(reversed(parts), reversed(seen[:-1]), strict=True):
            out.append(np.concatenate([(inputs.T @ back + alpha * weights / n).ravel(), back.sum(axis=0)]))
            back = (back @ weights.T) * (inputs > 0)
        return loss, np.concatenate(out[::-1])

    return unpack, forward, gradient


unpack, forward, gradient = _network()


def first_weights(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform in the range that keeps the size of signals, by the widths of the neighbouring layers."""
    draw, parts = np.random.default_rng(seed), []
    for a, b in zip(layers[:-1], layers[1:], strict=True):
        bound = np.sqrt((6.0 if b > 1 else 2.0) / (a + b))
        parts += [draw.uniform(-bound, bound, a * b), draw.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def _round(rows: DataFrame, state: np.ndarray, layers: Sequence[int], settings: PerceptronSettings, turn: int) -> tuple[np.ndarray, int, float, float]:
    """Averaged state (weights and the two moments of their gradients), rows trained on, held-out rows right and in all."""
    _, forward_, gradient_ = _network()
    alpha, size, rate, seed, share = settings.alpha, settings.batch_rows, settings.rate, settings.seed, settings.held_out
    layers, start, done = list(layers), state, turn

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(start) // 3
        weights, first, second = (start[k * n : (k + 1) * n].copy() for k in range(3))
        trained, steps, right, held = 0, 0, 0, 0
        for batch in batches:
            key = np.asarray(batch["key"]).view(np.uint64)
            cells = np.asarray(batch["cells"].flatten(), float).reshape(batch.num_rows, -1)
            labels = np.asarray(batch["label"])
            out = (key >> np.uint64(40)) < share * (1 << 24)
            if out.any():
                right += int(((forward_(start[:n], layers, cells[out])[-1][:, 0] > 0) == (labels[out] == 1)).sum())
                held += int(out.sum())
            order = np.random.default_rng([seed, done, int(key[0] & np.uint64(0xFFFFFFFF))]).permutation(np.flatnonzero(~out))
            for at in range(0, len(order), size):
                chosen = order[at : at + size]
                _, slope = gradient_(weights, layers, cells[chosen], labels[chosen], alpha)
                steps += 1
                first = 0.9 * first + 0.1 * slope
                second = 0.999 * second + 0.001 * slope * slope
                seen = done * 1000 + steps
                weights = weights - rate * (first / (1 - 0.9**seen)) / (np.sqrt(second / (1 - 0.999**seen)) + 1e-8)
                trained += len(chosen)
        values = np.concatenate([np.concatenate([weights, first, second]) * trained, [trained, right, held]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["at", "value"])

    summed = rows.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    values = np.zeros(len(start) + 3)
    values[np.asarray(summed["at"])] = np.asarray(summed["value"])
    trained, right, held = values[-3:]
    return (values[:-3] / trained if trained else start), int(trained), float(right), float(held)


def train(df: DataFrame, *, features: str, label: str, settings: PerceptronSettings = PerceptronSettings()) -> tuple[list[int], np.ndarray, list[float]]:
    """Layers, the best weights, and the held-out share of right answers before each round.

    Without held-out rows (a very small table) all rounds are taken and the last weights kept.
    """
    kind = df.schema[features].dataType.typeName()
    cells = F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)
    rows = df.select(F.col(label).cast("double").alias("label"), cells.alias("cells"))
    rows, path = stored(rows.withColumn("key", F.xxhash64("cells", "label")), "perceptron-rows")
    one = rows.first()
    if one is None:
        raise ValueError("no rows to learn from")
    layers = [len(one["cells"]), *settings.hidden, 1]
    weights = first_weights(layers, settings.seed)
    state = np.concatenate([weights, np.zeros(2 * len(weights))])
    best, kept, waited, shares = -np.inf, weights, 0, []
    for turn in range(settings.max_rounds + 1):
        moved, _, right, held = _round(rows, state, layers, settings, turn)
        now = state[: len(weights)]
        if held:
            shares.append(right / held)
            waited = 0 if shares[-1] > best + settings.tolerance else waited + 1
            if shares[-1] > best:
                best, kept = shares[-1], now
            if waited >= settings.patience:
                break
        else:
            kept = now
        state = moved
    discard(df.sparkSession, path)
    return layers, kept, shares


class Perceptron(Estimator, _Columns):
    """Binary classifier; fits ``PerceptronModel``."""

    def __init__(self, settings: PerceptronSettings = PerceptronSettings()):
        super().__init__()
        self.settings = settings

    def _fit(self, dataset: DataFrame) -> PerceptronModel:
        layers, weights, shares = train(dataset, features=self.getFeaturesCol(), label=self.getLabelCol(), settings=self.settings)
        packed = base64.b64encode(weights.astype(np.float64).tobytes()).decode()
        network = {"layers": layers, "weights": packed, "rounds": len(shares)}
        return PerceptronModel()._set(network=json.dumps(network), featuresCol=self.getFeaturesCol())


class PerceptronModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    network: Param = Param(Params._dummy(), "network", "layers and weights as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(probabilityCol="probability")

    def parts(self) -> tuple[list[int], np.ndarray]:
        told = json.loads(self.getOrDefault(self.network))
        return told["layers"], np.frombuffer(base64.b64decode(told["weights"]))

    @property
    def rounds(self) -> int:
        return json.loads(self.getOrDefault(self.network))["rounds"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        layers, weights = self.parts()
        _, forward_, _ = _network()

        @F.pandas_udf("double")
        def margin(batch: pd.Series) -> pd.Series:
            if not len(batch):
                return pd.Series([], dtype="float64")
            return pd.Series(forward_(weights, layers, np.stack(batch.to_numpy()).astype(float))[-1][:, 0])

        chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(vector_to_array(self.getFeaturesCol()))))
        scored = dataset.withColumn("__chance", chance)
        return scored.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - F.col("__chance"), F.col("__chance")))).drop("__chance")
