"""Gradient boosting of leaf-wise trees on quantile bins, with histograms as an aggregated table.

Rows are binned once (one byte per feature) and stay where they are. A pass over them gives, for some leaves of the
growing tree, the sums of gradients, second derivatives and rows per (leaf, feature, bin): each task adds up its own
rows, and Spark sums the tasks' tables by slot. Sums are integers, so they depend neither on the order of rows nor on
the number of tasks. The driver holds one histogram per leaf (leaves x bins of all features x 24 bytes) and looks for
splits there; a pass only computes the smaller child of a split, its sibling is the parent less the child.

Trees grow best first. The children of a leaf depend on its own rows alone, so one pass prepares every leaf that may
still be split, and the order of the splits is the same as with one pass per split. Missing values have a bin of their
own and go where the gain is larger. Margins are written out after some trees; trees since then are replayed in a pass.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasWeightCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.session import discard, stored

#: Gradients are counted in these units: with weights around 1, some 10**11 rows fit the sums.
UNITS = 1 << 24
#: A split has to gain more than the noise of doubles.
LEAST_GAIN = 1e-9
#: Bytes of histograms a task may hold; more leaves take more passes.
PASS_BYTES = 64 << 20
#: Tables of all tasks up to this size are sent to the driver as they are.
DIRECT_BYTES = 32 << 20
BINNED = "key long, label double, weight double, bins binary, margin double"


@dataclass(frozen=True)
class BoostingSettings:
    trees: int = 100
    learning_rate: float = 0.1
    max_leaves: int = 31
    max_depth: int | None = None
    min_rows: int = 20
    min_hessian: float = 1e-3
    penalty: float = 0.0
    row_share: float = 1.0
    column_share: float = 1.0
    max_bins: int = 255
    rewrite_every: int = 10
    seed: int = 42


@dataclass
class Tree:
    """Nodes as parallel lists; node 0 is the root, a leaf has feature -1.

    ``split`` is the last bin and ``threshold`` the largest value that goes left; ``cover`` counts training rows.
    """

    feature: list[int] = field(default_factory=list)
    split: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    cover: list[int] = field(default_factory=list)

    def add(self, value: float, cover: int) -> int:
        cells = {"feature": -1, "split": 0, "threshold": 0.0, "missing_left": False, "left": 0, "right": 0, "gain": 0.0}
        for name, cell in {**cells, "value": value, "cover": cover}.items():
            getattr(self, name).append(cell)
        return len(self.feature) - 1


def _router():
    """A function that finds the leaf of each row, by bins (missing: 0) or by values (missing: NaN)."""

    def route(cells: np.ndarray, tree: dict, binned: bool) -> np.ndarray:
        feature, left, right = (np.asarray(tree[c]) for c in ("feature", "left", "right"))
        border = np.asarray(tree["split" if binned else "threshold"])
        missing_left = np.asarray(tree["missing_left"], bool)
        node = np.zeros(len(cells), np.int64)
        rows = np.arange(len(cells))
        while True:
            rows = rows[feature[node[rows]] >= 0]
            if not len(rows):
                return node
            at = node[rows]
            cell = cells[rows, feature[at]]
            absent = cell == 0 if binned else np.isnan(cell)
            goes_left = np.where(absent, missing_left[at], cell <= border[at])
            node[rows] = np.where(goes_left, left[at], right[at])

    return route


# ---- bins -----------------------------------------------------------------------------------------

def _few_values(matrix: DataFrame, width: int, most: int) -> dict[int, list[float]]:
    """Sorted distinct values of the slots that have at most ``most`` of them, missing ones aside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: list[np.ndarray | None] = [np.zeros(0)] * width
        for batch in batches:
            cells = np.asarray(batch.column(0).flatten(), float).reshape(-1, width)
            for slot, values in enumerate(known):
                if values is not None:
                    own = cells[:, slot] + 0.0  # one zero
                    values = np.union1d(values, own[~np.isnan(own)])
                    known[slot] = values if len(values) <= most else None
        columns = [pa.array(range(width), pa.int32()), pa.array([v is None for v in known]), pa.array([[] if v is None else v.tolist() for v in known], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "many", "found"])

    parts = matrix.select("cells").mapInArrow(run, "slot int, many boolean, found array<double>")
    # A task tells at most ``most`` values of a slot.
    joined = parts.groupBy("slot").agg(F.bool_or("many").alias("many"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found"))
    few = joined.where(~F.col("many") & (F.size("found") <= most))
    return {r["slot"]: r["found"] for r in few.collect()}


def feature_cuts(matrix: DataFrame, width: int, max_bins: int = 255) -> list[np.ndarray]:
    """Upper borders of the bins of every slot of ``cells``: all values if there are few, else quantiles."""
    few = _few_values(matrix, width, max_bins)
    cuts = [np.array(few.get(slot, [])[:-1]) for slot in range(width)]
    many = [slot for slot in range(width) if slot not in few]
    if many:
        number = F.when(~F.isnan("pair.value"), F.col("pair.value"))
        pairs = F.transform(F.array(*map(F.lit, many)), lambda s: F.struct(s.alias("slot"), F.get("cells", s).alias("value")))
        shares = [i / max_bins for i in range(1, max_bins)]
        long = matrix.select(F.explode(pairs).alias("pair")).select("pair.slot", number.alias("value"))
        found = long.groupBy("slot").agg(F.percentile_approx("value", shares, max_bins * 40).alias("at"), F.max("value").alias("top"))
        for row in found.collect():
            cuts[row["slot"]] = np.unique([v for v in row["at"] if v < row["top"]])
    return cuts


def binned_rows(matrix: DataFrame, cuts: Sequence[np.ndarray], base: float) -> DataFrame:
    cuts = [np.asarray(c) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.asarray(batch["cells"].flatten(), float).reshape(-1, len(cuts))
            bins = np.zeros(cells.shape, np.uint8)
            for slot, borders in enumerate(cuts):
                own = cells[:, slot]
                bins[:, slot] = np.where(np.isnan(own), 0, np.searchsorted(borders, own, "left") + 1)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            margin = pa.array(np.full(len(bins), base))
            yield pa.RecordBatch.from_arrays([batch["key"], batch["label"], batch["weight"], packed, margin], ["key", "label", "weight", "bins", "margin"])

    return matrix.select("key", "label", "weight", "cells").mapInArrow(run, BINNED)


# ---- histograms -----------------------------------------------------------------------------------

def _pass(rows: DataFrame, *, pending: list[dict], tree: dict, targets: Sequence[int], starts: np.ndarray,
          total: int, row_share: float, turn: int) -> DataFrame:
    """Sums per slot of the rows in the target leaves of ``tree``: slot, gradient, hessian, rows (integers)."""
    route, units = _router(), UNITS
    target_of = {node: i for i, node in enumerate(targets)}
    turned = np.uint64((turn * 0x9E3779B97F4A7C15) % 2**64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, len(targets) * total), np.int64)
        place = np.full(len(tree["feature"]), -1, np.int64)
        for node, i in target_of.items():
            place[node] = i
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                bins = np.frombuffer(b"".join(part["bins"].to_pylist()), np.uint8).reshape(part.num_rows, -1)
                margin = np.asarray(part["margin"]).copy()
                for done in pending:
                    margin += np.asarray(done["value"])[route(bins, done, True)]
                at = place[route(bins, tree, True)]
                if row_share < 1:
                    drawn = np.asarray(part["key"]).view(np.uint64) ^ turned
                    for shift, scale in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                        drawn = (drawn ^ (drawn >> np.uint64(shift))) * np.uint64(scale)
                    at = np.where((drawn >> np.uint64(40)) < row_share * (1 << 24), at, -1)
                inside = np.flatnonzero(at >= 0)
                if not len(inside):
                    continue
                weight, chance = np.asarray(part["weight"])[inside], 1 / (1 + np.exp(-margin[inside]))
                first = np.rint(weight * (chance - np.asarray(part["label"])[inside]) * units)
                second = np.rint(weight * chance * (1 - chance) * units)
                slots = at[inside, None] * total + starts[None, :] + bins[inside]
                width = slots.shape[1]
                for k, values in enumerate((first, second, np.ones(len(inside)))):
                    added = np.bincount(slots.ravel(), np.repeat(values, width), sums.shape[1])
                    sums[k] += added.astype(np.int64)
        used = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(s[used]) for s in sums]], ["slot", "gradient", "hessian", "rows"])

    return rows.mapInArrow(run, "slot long, gradient long, hessian long, rows long")


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in ("gradient", "hessian", "rows")])


def _collected(parts: DataFrame, leaves: int, total: int) -> np.ndarray:
    """Histograms on the driver, from rows with a slot each or several."""
    found = parts.toArrow()
    sums = np.zeros((3, leaves * total), np.int64)
    for k, name in enumerate(("gradient", "hessian", "rows")):
        np.add.at(sums[k], np.asarray(found["slot"]), np.asarray(found[name]))
    return sums.reshape(3, leaves, total)


@dataclass(frozen=True)
class Layout:
    """Where the bins of each feature stand in a histogram; a feature's first slot is its missing bin."""

    starts: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, cuts: Sequence[np.ndarray]) -> Layout:
        counts = np.array([len(c) + 2 for c in cuts], np.int64)
        return cls(np.cumsum(counts) - counts, counts)

    @property
    def total(self) -> int:
        return int(self.counts.sum())


def split_gains(sums: np.ndarray, layout: Layout, settings: BoostingSettings) -> np.ndarray:
    """Gain of a split after every slot, missing values to the right (first row) and to the left; -inf where none is."""
    owner = np.repeat(np.arange(len(layout.counts)), layout.counts)
    first = layout.starts[owner]
    running = np.cumsum(sums, axis=1)
    absent = sums[:, first]
    below = running - running[:, first]
    whole = running[:, first + layout.counts[owner] - 1] - running[:, first] + absent

    def score(part: np.ndarray) -> np.ndarray:
        g, h = part[0] / UNITS, part[1] / UNITS
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(h + settings.penalty > 0, g * g / (h + settings.penalty), 0.0)

    gains = []
    for left in (below, below + absent):
        right = whole - left
        fits = np.arange(len(first)) > first
        for side in (left, right):
            fits &= (side[2] >= max(1, settings.min_rows)) & (side[1] >= settings.min_hessian * UNITS)
        gains.append(np.where(fits, score(left) + score(right) - score(whole), -np.inf))
    return np.stack(gains)


@dataclass
class _Leaf:
    """A node while the tree grows: its histogram, its best split and, once a pass has found them, its children."""

    sums: np.ndarray | None
    totals: np.ndarray
    depth: int
    gain: float = -np.inf
    slot: int = 0
    missing_left: bool = False
    left_totals: np.ndarray | None = None
    explored: tuple[int, int] | None = None


class _Grower:
    """Grows one tree best first; the explored tree may be larger than the chosen one."""

    def __init__(self, cuts, layout: Layout, settings: BoostingSettings, used: np.ndarray, histograms):
        self.cuts, self.layout, self.settings, self.used, self.histograms = cuts, layout, settings, used, histograms
        self.explored = Tree()
        self.leaves: dict[int, _Leaf] = {}

    def _leaf(self, sums: np.ndarray, depth: int) -> _Leaf:
        layout = self.layout
        leaf = _Leaf(sums, sums[:, : layout.counts[0]].sum(axis=1), depth)  # every feature's bins hold all rows
        deepest = self.settings.max_depth
        if deepest is None or depth < deepest:
            gains = split_gains(sums, layout, self.settings)
            gains[:, ~np.repeat(self.used, layout.counts)] = -np.inf
            side, slot = divmod(int(gains.argmax()), layout.total)
            leaf.gain, leaf.slot, leaf.missing_left = float(gains[side, slot]), slot, bool(side)
            start = layout.starts[np.searchsorted(layout.starts, slot, "right") - 1]
            leaf.left_totals = sums[:, start + (not side) : slot + 1].sum(axis=1)
        if leaf.gain <= LEAST_GAIN:
            leaf.sums = None
        return leaf

    def _split(self, tree: Tree, node: int, leaf: _Leaf, children: tuple[int, int]) -> None:
        feature = int(np.searchsorted(self.layout.starts, leaf.slot, "right") - 1)
        last = int(leaf.slot - self.layout.starts[feature])
        borders = self.cuts[feature]
        tree.feature[node], tree.split[node], tree.missing_left[node] = feature, last, leaf.missing_left
        tree.threshold[node] = float(borders[last - 1]) if last <= len(borders) else float("inf")
        tree.left[node], tree.right[node] = children
        tree.gain[node] = leaf.gain

    def _explore(self, nodes: Sequence[int]) -> None:
        """Children of the nodes: one pass for the smaller ones, subtraction for the others."""
        smaller = []
        for node in nodes:
            leaf = self.leaves[node]
            leaf.explored = (self.explored.add(0.0, 0), self.explored.add(0.0, 0))
            self._split(self.explored, node, leaf, leaf.explored)
            smaller.append(leaf.explored[int(2 * leaf.left_totals[2] > leaf.totals[2])])
        found = self.histograms(asdict(self.explored), smaller)
        for node, small, sums in zip(nodes, smaller, found, strict=True):
            leaf = self.leaves[node]
            sides = {small: sums, sum(leaf.explored) - small: leaf.sums - sums}
            for child in leaf.explored:
                self.leaves[child] = self._leaf(sides[child], leaf.depth + 1)
            leaf.sums = None

    def grow(self) -> Tree:
        self.explored.add(0.0, 0)
        (root,) = self.histograms(asdict(self.explored), [0])
        self.leaves[0] = self._leaf(root, 0)
        chosen, open_nodes = {0}, [0]
        for leaves in range(1, self.settings.max_leaves):
            open_nodes = sorted((n for n in open_nodes if self.leaves[n].gain > LEAST_GAIN), key=lambda n: (-self.leaves[n].gain, n))
            if not open_nodes:
                break
            best = self.leaves[open_nodes[0]]
            if best.explored is None:
                waiting = [n for n in open_nodes if self.leaves[n].explored is None]
                self._explore(waiting[: self.settings.max_leaves - leaves])
            chosen.update(best.explored)
            open_nodes = [*open_nodes[1:], *best.explored]
        return self._chosen(chosen)

    def _chosen(self, chosen: set[int]) -> Tree:
        """The chosen part of the explored tree, numbered in order of the parents."""
        tree, rate, penalty = Tree(), self.settings.learning_rate, self.settings.penalty
        waiting = [(0, tree.add(0.0, 0))]
        while waiting:
            node, own = waiting.pop(0)
            leaf = self.leaves[node]
            g, h, rows = (leaf.totals[0] / UNITS, leaf.totals[1] / UNITS, int(leaf.totals[2]))
            tree.cover[own] = rows
            if leaf.explored and leaf.explored[0] in chosen:
                children = (tree.add(0.0, 0), tree.add(0.0, 0))
                self._split(tree, own, leaf, children)
                waiting += zip(leaf.explored, children, strict=True)
            else:
                tree.value[own] = -rate * g / (h + penalty) if h + penalty > 0 else 0.0
        return tree


# ---- training -------------------------------------------------------------------------------------

def training_rows(df: DataFrame, *, features: str, label: str, weight: str | None) -> DataFrame:
    """key (a hash of the row, for sampling), label, weight and cells; NULL cells are NaN, that is, missing."""
    kind = df.schema[features].dataType.typeName()
    cells = F.col(features).cast("array<double>") if kind == "array" else vector_to_array(features)
    cells = F.transform(cells, lambda v: F.coalesce(v, F.lit(float("nan"))))
    weights: Column = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(label).cast("double").alias("label"), weights.alias("weight"), cells.alias("cells"))
    return rows.withColumn("key", F.xxhash64("cells", "label", "weight"))


def base_margin(rows: DataFrame) -> float:
    """Log odds of the weighted share of ones, kept finite for one-class tables."""
    sums = rows.agg(F.sum(F.col("label") * F.col("weight")).alias("ones"), F.sum("weight").alias("all")).first()
    share = min(max((sums["ones"] or 0.0) / sums["all"], 1e-6), 1 - 1e-6) if sums["all"] else 0.5
    return float(np.log(share / (1 - share)))


def _moved(rows: DataFrame, pending: list[dict]) -> DataFrame:
    """The binned rows with the margins of the pending trees added."""
    route = _router()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.frombuffer(b"".join(batch["bins"].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            margin = np.asarray(batch["margin"]).copy()
            for done in pending:
                margin += np.asarray(done["value"])[route(bins, done, True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(margin)], batch.schema.names)

    return rows.mapInArrow(run, BINNED)


def _histograms(rows: DataFrame, layout: Layout, pending: list[dict], settings: BoostingSettings, turn: int):
    """A function of (tree, leaves) that gives the histogram of each leaf, in as many passes as memory asks for."""
    at_once = max(1, PASS_BYTES // (24 * layout.total))
    tasks = rows.rdd.getNumPartitions()

    def find(tree: dict, leaves: Sequence[int]) -> list[np.ndarray]:
        found = []
        for start in range(0, len(leaves), at_once):
            targets = list(leaves[start : start + at_once])
            table = _pass(rows, pending=pending, tree=tree, targets=targets, starts=layout.starts, total=layout.total,
                          row_share=settings.row_share, turn=settings.seed * 1_000_003 + turn)
            # a few small tables are added up here, which saves a shuffle; the sums are the same
            few = 32 * tasks * len(targets) * layout.total <= DIRECT_BYTES
            sums = _collected(table if few else _summed(table), len(targets), layout.total)
            found += [sums[:, i] for i in range(len(targets))]
        return found

    return find


def root_histogram(df: DataFrame, *, features: str, label: str, weight: str | None = None, settings: BoostingSettings = BoostingSettings()) -> tuple[DataFrame, list[np.ndarray]]:
    """The first histogram of the first tree as a table (feature, bin, gradient, hessian, rows), and the bins' borders.

    ``gradient`` and ``hessian`` are in units of 1 / UNITS; bin 0 holds missing values.
    """
    rows, width = _measured(training_rows(df, features=features, label=label, weight=weight))
    cuts = feature_cuts(rows, width, settings.max_bins)
    layout = Layout.of(cuts)
    binned = binned_rows(rows, cuts, base_margin(rows))
    tree = Tree()
    tree.add(0.0, 0)
    table = _summed(_pass(binned, pending=[], tree=asdict(tree), targets=[0], starts=layout.starts, total=layout.total, row_share=1.0, turn=0))
    slots = [(int(s + b), f, b) for f, (s, n) in enumerate(zip(layout.starts, layout.counts, strict=True)) for b in range(n)]
    named = df.sparkSession.createDataFrame(slots, "slot long, feature int, bin int")  # the bins of all features
    return named.join(table, "slot").select("feature", "bin", "gradient", "hessian", "rows"), cuts


def first_splits(df: DataFrame, *, features: str, label: str, names: Sequence[str], weight: str | None = None, settings: BoostingSettings = BoostingSettings()) -> DataFrame:
    """The best split of each feature at the root of the first tree: feature, threshold, missing_left, gain, left_rows.

    ``threshold`` is NULL where all present values go left; a feature without any valid split has no row.
    """
    table, cuts = root_histogram(df, features=features, label=label, weight=weight, settings=settings)
    layout = Layout.of(cuts)
    at = F.element_at(F.lit(layout.starts.tolist()), F.col("feature") + 1) + F.col("bin")
    sums = _collected(table.select(at.alias("slot"), "gradient", "hessian", "rows"), 1, layout.total)[:, 0]
    gains, found = split_gains(sums, layout, settings), []
    for name, start, count, borders in zip(names, layout.starts, layout.counts, cuts, strict=True):
        own = gains[:, start : start + count]
        side, last = divmod(int(own.argmax()), int(count))
        if own[side, last] > LEAST_GAIN:
            border = float(borders[last - 1]) if last <= len(borders) else None
            rows = int(sums[2, start + (not side) : start + last + 1].sum())
            found.append((name, border, bool(side), float(own[side, last]), rows))
    return df.sparkSession.createDataFrame(found, "feature STRING, threshold DOUBLE, missing_left BOOLEAN, gain DOUBLE, left_rows LONG")


def _measured(rows: DataFrame) -> tuple[DataFrame, int]:
    first = rows.select(F.size("cells").alias("n")).first()
    if first is None:
        raise ValueError("no rows to learn from")
    return rows, first["n"]


def train(df: DataFrame, *, features: str, label: str, weight: str | None = None, settings: BoostingSettings = BoostingSettings()) -> tuple[float, list[Tree]]:
    """Base margin and trees. ``features`` is a vector or an array of numbers of one length; NULL and NaN are missing."""
    spark = df.sparkSession
    rows, width = _measured(training_rows(df, features=features, label=label, weight=weight))
    rows, rows_path = stored(rows, "boosting-rows")
    cuts = feature_cuts(rows, width, settings.max_bins)
    layout, base = Layout.of(cuts), base_margin(rows)
    binned, path = stored(binned_rows(rows, cuts, base), "boosting-bins")
    discard(spark, rows_path)
    trees: list[Tree] = []
    pending: list[dict] = []
    for turn in range(settings.trees):
        draw = np.random.default_rng([settings.seed, turn])
        used = np.zeros(width, bool)
        used[draw.choice(width, max(1, round(settings.column_share * width)), replace=False)] = True
        tree = _Grower(cuts, layout, settings, used, _histograms(binned, layout, pending, settings, turn)).grow()
        trees.append(tree)
        pending.append(asdict(tree))
        if len(pending) == settings.rewrite_every and turn + 1 < settings.trees:
            moved, new_path = stored(_moved(binned, pending), "boosting-bins")
            discard(spark, path)
            binned, path, pending = moved, new_path, []
    discard(spark, path)
    return base, trees


def margin_column(cells: Column, base: float, trees: Sequence[Mapping]) -> Column:
    """Base margin plus the trees' values for an array column; NaN is missing."""
    route, trees = _router(), [dict(t) for t in trees]

    @F.pandas_udf("double")
    def margin(batch: pd.Series) -> pd.Series:
        total = np.full(len(batch), base)
        if len(batch):
            values = np.stack(batch.to_numpy()).astype(float)
            for tree in trees:
                total += np.asarray(tree["value"])[route(values, tree, False)]
        return pd.Series(total)

    return margin(cells)


class _Columns(HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasWeightCol):
    def setFeaturesCol(self, value: str):  # noqa: N802  (the names of the library's own estimators)
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str):  # noqa: N802
        return self._set(labelCol=value)

    def setWeightCol(self, value: str):  # noqa: N802
        return self._set(weightCol=value)


class LeafwiseBoosting(Estimator, _Columns):
    """Binary classifier; fits ``BoostingModel``."""

    def __init__(self, settings: BoostingSettings = BoostingSettings(), weightCol: str | None = None):  # noqa: N803
        super().__init__()
        self.settings = settings
        if weightCol:
            self._set(weightCol=weightCol)

    def _fit(self, dataset: DataFrame) -> BoostingModel:
        weight = self.getWeightCol() if self.isSet(self.weightCol) else None
        base, trees = train(dataset, features=self.getFeaturesCol(), label=self.getLabelCol(), weight=weight, settings=self.settings)
        width = dataset.select(self.getFeaturesCol()).first()[0]
        ensemble = {"base": base, "width": len(width), "trees": [asdict(t) for t in trees]}
        return BoostingModel()._set(ensemble=json.dumps(ensemble), featuresCol=self.getFeaturesCol())


class BoostingModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble, kept as one JSON parameter so that it is saved with any pipeline."""

    ensemble: Param = Param(Params._dummy(), "ensemble", "base margin, width and trees as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(probabilityCol="probability")

    def forest(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Gains per slot, as shares of their sum."""
        forest = self.forest()
        total = np.zeros(forest["width"])
        for tree in forest["trees"]:
            for feature, gain in zip(tree["feature"], tree["gain"], strict=True):
                if feature >= 0:
                    total[feature] += gain
        return DenseVector(total / total.sum() if total.sum() else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        forest = self.forest()
        margin = margin_column(vector_to_array(self.getFeaturesCol()), forest["base"], forest["trees"])
        chance = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        scored = dataset.withColumn("__chance", chance)
        return scored.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1 - F.col("__chance"), F.col("__chance")))).drop("__chance")
