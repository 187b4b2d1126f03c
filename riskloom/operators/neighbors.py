"""Exact k-nearest-neighbour join with bounded tasks.

Copies of a vector are collapsed first, so a group of copies costs one point. Points are then cut into
cells around pivot points. The triangle inequality gives every cell an upper bound on the distance of
its points' k-th neighbour, and a point is sent to a cell only if it can lie within that bound (the
published pivot-partitioned kNN join). Cells are cut into blocks of at most ``block`` rows on both
sides; a task holds one block of each and emits k rows per query point, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.neighbor_index import neighbor_lists
from riskloom.session import materialize

BLOCK_ROWS = 8_192
MAX_PIVOTS = 1_024
CHUNK_ROWS = 256
SLACK = 1e-9


def collapse_copies(points: DataFrame, *, id_column: str, vector: str, keep: int, carry: Sequence[str] = ()) -> DataFrame:
    """One row per distinct vector: representative id, vector and its ``keep`` smallest-id members."""
    first = Window.partitionBy("vec").orderBy("id")
    rows = points.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vec"), *carry)
    # The constant rank bound lets Spark drop surplus copies of a hot vector before the shuffle.
    leading = rows.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= keep)
    members = F.sort_array(F.collect_list(F.struct("id", *carry)))
    return leading.groupBy("vec").agg(F.min("id").alias("rep"), members.alias("members"))


def _choose_pivots(reps: DataFrame, wanted: int, seed: int) -> np.ndarray:
    rows = reps.orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(wanted).select("vec").collect()
    return np.array([r["vec"] for r in rows], dtype=np.float64)


def _with_cell(reps: DataFrame, pivots: np.ndarray) -> DataFrame:
    # Closures sent to the workers hold only plain values, so workers need not have this package.
    chunk_rows = CHUNK_ROWS

    @F.pandas_udf("cell INT, radius DOUBLE")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        cells, radii = [], []
        points = np.stack(vectors.to_numpy()).astype(np.float64)
        for start in range(0, len(points), chunk_rows):
            chunk = points[start : start + chunk_rows]
            squared = (chunk**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2.0 * chunk @ pivots.T
            best = squared.argmin(1)
            cells.append(best)
            radii.append(np.sqrt(((chunk - pivots[best]) ** 2).sum(1)))
        return pd.DataFrame({"cell": np.concatenate(cells).astype("int32"), "radius": np.concatenate(radii)})

    return reps.withColumn("at", nearest("vec")).select("*", "at.cell", "at.radius").drop("at")


def _cell_bounds(queries: DataFrame, candidates: DataFrame, pivots: np.ndarray, k: int):
    """Per cell: query radius, query rows and an upper bound on the k-th neighbour distance."""
    nearest = Window.partitionBy("cell").orderBy("radius", "rep")
    closest = (
        candidates.select("cell", "radius", "rep")
        .withColumn("place", F.row_number().over(nearest))
        .filter(F.col("place") <= k + 1)
        .collect()
    )
    stats = queries.groupBy("cell").agg(F.max("radius").alias("far"), F.count("*").alias("n")).collect()
    between = np.sqrt(np.maximum(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2), 0.0))
    far, rows = np.full(len(pivots), -1.0), np.zeros(len(pivots), dtype=int)
    for r in stats:
        far[r["cell"]], rows[r["cell"]] = r["far"], r["n"]
    owner = np.array([r["cell"] for r in closest], dtype=int)
    inner = np.array([r["radius"] for r in closest], dtype=float)
    reach = np.full(len(pivots), np.inf)
    for cell in np.flatnonzero(rows):
        bounds = np.sort(far[cell] + between[cell, owner] + inner)
        if len(bounds) > k:
            reach[cell] = bounds[k] * (1 + SLACK) + SLACK
    return between, far, rows, reach


def _block_neighbors(k: int):
    """Top-k of one query block against one candidate block.

    A matrix product narrows the candidates; the survivors' distances are recomputed directly.
    """
    chunk_rows, relative, cells_at_once = CHUNK_ROWS, SLACK, 65_536

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        ids, near_ids, distances = [], [], []
        if len(queries) and len(candidates):
            left = np.stack(queries["vec"].to_numpy()).astype(np.float64)
            right = np.stack(candidates["near_vec"].to_numpy()).astype(np.float64)
            left_ids, right_ids = queries["rep"].to_numpy(), candidates["near"].to_numpy()
            right_norm = (right**2).sum(1)
            top = min(k, len(right))
            for start in range(0, len(left), chunk_rows):
                chunk, chunk_ids = left[start : start + chunk_rows], left_ids[start : start + chunk_rows]
                norm = (chunk**2).sum(1)
                squared = norm[:, None] + right_norm[None, :] - 2.0 * chunk @ right.T
                squared[chunk_ids[:, None] == right_ids[None, :]] = np.inf
                limits = np.partition(squared, top - 1, axis=1)[:, top - 1]
                limits = limits + relative * (1.0 + norm + right_norm.max())
                squared[squared > limits[:, None]] = np.inf
                width = int(np.isfinite(squared).sum(axis=1).max())
                if not width:
                    continue
                part = np.argpartition(squared, width - 1, axis=1)[:, :width]
                kept = np.isfinite(np.take_along_axis(squared, part, axis=1))
                exact = np.full(part.shape, np.inf)
                rows, places = np.nonzero(kept)
                for at in range(0, len(rows), cells_at_once):
                    r, c = rows[at : at + cells_at_once], places[at : at + cells_at_once]
                    exact[r, c] = np.sqrt(((right[part[r, c]] - chunk[r]) ** 2).sum(axis=1))
                order = np.lexsort((right_ids[part], exact), axis=1)[:, :top]
                found = np.take_along_axis(exact, order, axis=1)
                valid = np.isfinite(found)
                ids.append(np.repeat(chunk_ids, valid.sum(axis=1)))
                near_ids.append(right_ids[np.take_along_axis(part, order, axis=1)][valid])
                distances.append(found[valid])
        if not ids:
            return pd.DataFrame({"rep": [], "near": [], "distance": []})
        return pd.DataFrame(
            {"rep": np.concatenate(ids), "near": np.concatenate(near_ids), "distance": np.concatenate(distances)}
        )

    return search


def nearest_representatives(
    queries: DataFrame, candidates: DataFrame, k: int, *, seed: int = 42, block: int = BLOCK_ROWS
) -> DataFrame:
    """(rep, near, distance): the k nearest other representatives of every query representative.

    Inputs have columns rep and vec; ``rep`` identifies a vector across both.
    """
    total = candidates.count()
    pivots = _choose_pivots(candidates, max(1, min(MAX_PIVOTS, math.ceil(total / block))), seed)
    located = _with_cell(candidates.select("rep", "vec"), pivots)
    asked = _with_cell(queries.select("rep", "vec"), pivots)
    between, far, query_rows, reach = _cell_bounds(asked, located, pivots, k)

    @F.pandas_udf("array<int>")
    def targets(cells: pd.Series, radii: pd.Series) -> pd.Series:
        own = cells.to_numpy()
        lower = between[own] - far[None, :] - radii.to_numpy()[:, None]
        wanted = (lower <= reach[None, :]) & (query_rows[None, :] > 0)
        return pd.Series([np.flatnonzero(row).astype("int32") for row in wanted])

    sent = located.select(F.explode(targets("cell", "radius")).alias("cell"), "rep", "vec")
    arriving = {r["cell"]: r["n"] for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    cells = range(len(pivots))
    query_blocks = [max(1, math.ceil(int(query_rows[c]) / block)) for c in cells]
    candidate_blocks = [max(1, math.ceil(arriving.get(c, 0) / block)) for c in cells]
    layout = F.broadcast(  # one row per pivot
        queries.sparkSession.createDataFrame(
            [(c, query_blocks[c], candidate_blocks[c]) for c in cells], "cell INT, q_blocks INT, c_blocks INT"
        )
    )

    def spread(name: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0), F.col(name) - 1))

    left = (
        asked.join(layout, "cell")
        .withColumn("q", F.pmod(F.xxhash64("rep"), F.col("q_blocks")).cast("int"))
        .withColumn("c", spread("c_blocks"))
    )
    right = (
        sent.join(layout, "cell")
        .withColumn("c", F.pmod(F.xxhash64("rep"), F.col("c_blocks")).cast("int"))
        .withColumn("q", spread("q_blocks"))
    )
    keys = ["cell", "q", "c"]
    block_rows = left.select(*[F.col(c).alias(c) for c in (*keys, "rep", "vec")])
    candidate_rows = right.select(
        *[F.col(c).alias(c) for c in keys], F.col("rep").alias("near"), F.col("vec").alias("near_vec")
    )
    kind = T._parse_datatype_string(f"rep {queries.schema['rep'].dataType.simpleString()}, "
                                    f"near {candidates.schema['rep'].dataType.simpleString()}, distance double")
    partial = (
        block_rows.groupBy(*keys)
        .cogroup(candidate_rows.groupBy(*keys))
        .applyInPandas(_block_neighbors(k), kind)
    )
    order = Window.partitionBy("rep").orderBy("distance", "near")
    return partial.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")


def nearest_neighbors(
    points: DataFrame,
    k: int,
    *,
    id_column: str,
    vector: str,
    queries: DataFrame | None = None,
    carry: Sequence[str] = (),
    seed: int = 42,
    block: int = BLOCK_ROWS,
    recall: float | None = None,
) -> DataFrame:
    """(id, neighbors) with the k nearest other points by (distance, id), closest first.

    ``queries`` is a subset of ``points``; all points by default. Each neighbour carries its ``carry``
    columns. With ``recall`` the lists come from the hashed index, which holds that share of the exact ones (as it
    measures) and whose cost does not grow with the square of the table.
    """
    asked = points if queries is None else queries
    pool = materialize(
        collapse_copies(points, id_column=id_column, vector=vector, keep=k + 1, carry=carry), "knn-points"
    )
    reps = pool.select("rep", "vec")
    wanted = asked.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    owners = wanted.join(reps, "vec").select("id", "rep")
    query_reps = reps if queries is None else reps.join(wanted.select("vec").distinct(), "vec", "left_semi")

    if recall is None:
        near = nearest_representatives(query_reps, reps, k, seed=seed, block=block)
    else:
        lists, _ = neighbor_lists(reps, k, recall=recall, seed=seed)
        near = lists.join(query_reps.select("rep"), "rep", "left_semi").select("rep", F.explode("found").alias("m"))
        near = near.select("rep", "m.near", "m.distance")
    own = query_reps.select("rep", F.col("rep").alias("near"), F.lit(0.0).alias("distance"))
    members = pool.select(F.col("rep").alias("near"), "members")
    ranked = (
        near.unionByName(own)
        .join(members, "near")
        .select("rep", F.transform("members", lambda m: F.struct(
            F.col("distance").alias("distance"), m["id"].alias("id"), *[m[c].alias(c) for c in carry]
        )).alias("found"))
        .groupBy("rep")
        # at most (k + 1) representatives with k + 1 members each
        .agg(F.sort_array(F.flatten(F.collect_list("found"))).alias("found"))
    )
    others = F.filter("found", lambda m: m["id"] != F.col("id"))
    return owners.join(ranked, "rep").select("id", F.slice(others, 1, k).alias("neighbors"))
