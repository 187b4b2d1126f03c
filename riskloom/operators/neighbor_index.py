"""Approximate k-nearest-neighbour lists from projection hashes, refined over rounds until a measured recall is reached.

A round turns all vectors by a random rotation and puts a vector into the bucket of the axis it is nearest to (a
cross-polytope hash: two buckets for each axis taken), and by further rotations into finer buckets, until a bucket has
at most ``rows`` vectors. Only vectors of one bucket are compared, a block of bounded size a task, and each keeps
the k nearest of all rounds so far. The cost of a round is n x rows, whatever the size of the table; the exact join
(``neighbors.nearest_neighbors`` without ``recall``) costs n x n.

How many rounds are enough depends on the data, so it is measured: for CHECKED vectors, drawn by hash, the exact
lists are computed (one pass over all vectors), and rounds go on until the lists found hold the wanted share of them.
Distances in the lists are exact. The rotations depend on no data; nothing is fitted on a sample.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import discard, stored

#: Vectors whose exact lists measure the recall, rounds taken at a time, and at most.
CHECKED, ROUNDS_AT_ONCE, MOST_ROUNDS = 256, 4, 64
#: Vectors of a bucket, and levels of rotations that cut larger ones.
BUCKET_ROWS, LEVELS = 512, 4


def _axes(total: int, rows: int, width: int) -> list[int]:
    """Axes of each level: as many as buckets of ``rows / 2`` vectors need; levels for dense places take all."""
    wanted, axes = 2 * total / rows, []
    for _ in range(LEVELS):
        axes.append(min(width, math.ceil(wanted / 2)) if wanted > 1 else width)
        wanted /= 2 * axes[-1]
    return axes


def _hashed(reps: DataFrame, rounds: range, width: int, axes: list[int], seed: int) -> DataFrame:
    """A row per vector and round: round, and the codes of all levels as one string each, coarse to fine."""
    wanted = list(rounds)

    @F.pandas_udf("array<struct<round: int, codes: array<int>>>")
    def codes(vectors: pd.Series) -> pd.Series:
        points = np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, width))
        found = [[] for _ in range(len(points))]
        for one in wanted:
            per_level = []
            for level, taken in enumerate(axes):
                draw = np.random.default_rng([seed, one, level])
                turned = points @ np.linalg.qr(draw.normal(size=(width, width)))[0][:, :taken]
                axis = np.abs(turned).argmax(axis=1)
                negative = turned[np.arange(len(points)), axis] < 0
                per_level.append(2 * axis + negative)
            for row, own in zip(found, np.stack(per_level, axis=1).tolist(), strict=True):
                row.append({"round": one, "codes": own})
        return pd.Series(found)

    coded = reps.select("rep", "vec", F.explode(codes("vec")).alias("at"))
    prefixes = [F.concat_ws("-", F.slice("at.codes", 1, level + 1)).alias(f"code{level}") for level in range(LEVELS)]
    return coded.select("rep", "vec", "at.round", *prefixes)


def _blocks(hashed: DataFrame, rows: int) -> DataFrame:
    """round, bucket, rep, vec: the coarsest bucket of at most ``rows`` vectors; what is larger at the finest level is
    dealt into such parts by hash."""
    placed, left = None, hashed
    for level in range(LEVELS):
        code = f"code{level}"
        sizes, _ = stored(left.groupBy("round", code).agg(F.count("*").alias("n")), "bucket-sizes")
        sized = left.join(sizes, ["round", code])  # both sides are plain exchanges, so a hot bucket can be split
        if level + 1 < LEVELS:
            fits = sized.where(F.col("n") <= rows).select("round", F.col(code).alias("bucket"), "rep", "vec")
            left, _ = stored(sized.where(F.col("n") > rows).drop("n"), "large-buckets")
        else:
            part = F.pmod(F.xxhash64("rep", "round"), F.ceil(F.col("n") / rows))
            fits = sized.select("round", F.concat_ws("/", code, part.cast("string")).alias("bucket"), "rep", "vec")
        placed = fits if placed is None else placed.unionByName(fits)
    return placed


def _nearest_in_block(k: int):
    def search(block: pd.DataFrame) -> pd.DataFrame:
        points, ids = np.stack(block["vec"].to_numpy()).astype(np.float64), block["rep"].to_numpy()
        top = min(k, len(ids) - 1)
        lists: list[list] = []
        for start in range(0, len(ids), 256):
            chunk = points[start : start + 256]
            squared = (chunk**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2.0 * chunk @ points.T
            squared[np.arange(len(chunk)), start + np.arange(len(chunk))] = np.inf
            near = np.argpartition(squared, top - 1, axis=1)[:, :top] if top else np.zeros((len(chunk), 0), int)
            exact = np.sqrt(((points[near] - chunk[:, None, :]) ** 2).sum(axis=2))
            lists += [[{"distance": float(d), "near": i} for d, i in zip(ds, ids[js].tolist(), strict=True)] for ds, js in zip(exact, near, strict=True)]
        return pd.DataFrame({"rep": ids, "found": lists, "compared": np.full(len(ids), len(ids) - 1, dtype="int64")})

    return search


def _merged(parts: DataFrame, k: int) -> DataFrame:
    """One row per vector: its k nearest of all its lists, and how many vectors it was compared with."""
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("found"))))
    return parts.groupBy("rep").agg(F.slice(every, 1, k).alias("found"), F.sum("compared").alias("compared"))


def recall_of(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact rows (rep, near, distance) whose place is filled as well: equal distances are equally good."""
    farthest = exact.groupBy("rep").agg(F.max("distance").alias("limit"), F.count("*").alias("n"))
    good = F.size(F.filter("found", lambda m: m["distance"] <= F.col("limit") * (1 + 1e-9)))
    hits = farthest.join(found, "rep", "left").select("n", F.least(F.coalesce(good, F.lit(0)), F.col("n")).alias("hits"))
    row = hits.agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).first()
    return row["hits"] / row["n"] if row["n"] else 1.0


def exact_sample(reps: DataFrame, k: int, *, checked: int, seed: int) -> DataFrame:
    """rep, near, distance of the k nearest of ``checked`` vectors among all, by one pass over the table."""
    draw = reps.orderBy(F.xxhash64("rep", F.lit(seed)), "rep").limit(checked).collect()  # a fixed number of vectors
    ids = [r["rep"] for r in draw]
    asked = np.array([r["vec"] for r in draw], dtype=np.float64)
    number = {r: i for i, r in enumerate(ids)}
    kind = reps.schema["rep"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            points, near = np.stack(batch["vec"].to_numpy()).astype(np.float64), batch["rep"].to_numpy()
            squared = (asked**2).sum(1)[:, None] + (points**2).sum(1)[None, :] - 2.0 * asked @ points.T
            for place, one in enumerate(near.tolist()):
                if one in number:
                    squared[number[one], place] = np.inf
            top = min(k, len(near))
            best = np.argpartition(squared, top - 1, axis=1)[:, :top]
            rows, places = np.nonzero(np.isfinite(np.take_along_axis(squared, best, axis=1)))
            cells = best[rows, places]
            distance = np.sqrt(((points[cells] - asked[rows]) ** 2).sum(axis=1))
            yield pd.DataFrame({"rep": np.array(ids)[rows], "near": near[cells], "distance": distance})

    parts = reps.select("rep", "vec").mapInPandas(run, f"rep {kind}, near {kind}, distance double")
    place = F.row_number().over(Window.partitionBy("rep").orderBy("distance", "near"))
    return parts.withColumn("place", place).filter(F.col("place") <= k).drop("place")


def neighbor_lists(
    reps: DataFrame, k: int, *, recall: float = 0.95, seed: int = 42, rows: int = BUCKET_ROWS, checked: int = CHECKED,
) -> tuple[DataFrame, dict]:
    """rep and found (distance, near; ascending) for all of ``reps`` (rep, vec), and facts: rounds, recall, compared.

    Rounds end when the recall measured reaches ``recall``, or after MOST_ROUNDS; the facts tell which. ``compared`` is
    the number of distances computed in rounds. A table of at most ``rows`` vectors is one bucket, so it is exact.
    """
    spark = reps.sparkSession
    reps, _ = stored(reps.select("rep", "vec"), "index-points")
    first = reps.first()
    kind = reps.schema["rep"].dataType.simpleString()
    schema = f"rep {kind}, found array<struct<distance: double, near: {kind}>>, compared long"
    if first is None:
        return spark.createDataFrame([], schema), {"rounds": 0, "recall": 1.0, "compared": 0}
    width, total = len(first["vec"]), reps.count()
    if total <= rows:
        whole = reps.groupBy(F.col("rep").isNull().alias("bucket")).applyInPandas(_nearest_in_block(k), schema)
        lists, _ = stored(whole, "neighbor-lists")
        return lists, {"rounds": 1, "recall": 1.0, "compared": total * (total - 1)}
    exact, _ = stored(exact_sample(reps, k, checked=checked, seed=seed), "exact-sample")
    lists, path, reached, done = None, None, 0.0, 0
    axes = _axes(total, rows, width)
    while reached < recall and done < MOST_ROUNDS:
        hashed, hashed_path = stored(_hashed(reps, range(done, done + ROUNDS_AT_ONCE), width, axes, seed), "hashes")
        fresh = _blocks(hashed, rows).groupBy("round", "bucket").applyInPandas(_nearest_in_block(k), schema)
        merged, new_path = stored(_merged(fresh if lists is None else fresh.unionByName(lists), k), "neighbor-lists")
        discard(spark, hashed_path)
        if path:
            discard(spark, path)
        lists, path, done = merged, new_path, done + ROUNDS_AT_ONCE
        reached = recall_of(lists, exact)
    compared = lists.agg(F.sum("compared")).first()[0]
    return lists, {"rounds": done, "recall": reached, "compared": compared}
