"""Connected components of a link table by alternating large-star and small-star rounds.

Every round replaces the links of a node by links to the smallest node near it; the rounds end when all links
point from a node to the smallest node of its component. Only link tables move, written to the shared folder
after each round; nothing but two totals a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import materialize


def _to_smallest(links: DataFrame) -> DataFrame:
    """Columns node, near and the smallest node within reach of ``node`` in one step."""
    least = links.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
    # written before the join: both sides then come from plain exchanges, so a hot node's links can be split
    return links.join(materialize(least, "least"), "node")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("near").alias("node"), F.col("node").alias("near")))
    wide = _to_smallest(both).where("near > node")
    return wide.select(F.col("near").alias("node"), F.col("least").alias("near")).where("node <> near").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("node", "near").alias("node"), F.least("node", "near").alias("near"))
    wide = _to_smallest(down)
    moved = wide.select(F.explode(F.array("node", "near")).alias("node"), F.col("least").alias("near"))
    return moved.where("node <> near").distinct()


def components(links: DataFrame) -> DataFrame:
    """Columns node, component (the smallest node reachable) for every node that has a link to another one.

    ``links`` has two long columns, in either direction, repeated or not; links with a null and links of a node
    to itself say nothing. No links: an empty result.
    """
    first, second = (F.col(c).cast("long") for c in links.columns[:2])
    current = links.select(F.greatest(first, second).alias("node"), F.least(first, second).alias("near"))
    current = materialize(current.where("near < node").distinct(), "links")
    state = None
    while True:
        current = materialize(_small_star(materialize(_large_star(current), "links")), "links")
        totals = current.agg(F.count("*"), F.sum(F.xxhash64("node", "near").cast("decimal(20,0)"))).first()
        if totals == state:
            return current.select("node", F.col("near").alias("component"))
        state = totals
