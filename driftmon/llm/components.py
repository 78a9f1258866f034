"""Connected components over links, as Spark jobs; no links reach the driver."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftmon.session import written


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node reachable) that connect what the links (a, b) connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (label[a], label[b], a, b):
            np.minimum.at(label, end, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _settle(links: DataFrame) -> tuple[DataFrame, tuple]:
    links = written(links.distinct(), "links")
    return links, tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _nearest(sides: DataFrame) -> DataFrame:
    return sides.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with links (a, b); root is the smallest node reachable.

    Alternates two rewirings of the links until they are stars: larger neighbours of each
    node move to its smallest neighbour, then the smaller ones do. Rounds grow with the
    logarithm of the longest chain. A node with very many links is reduced map-side first.
    """
    links, mark = _settle(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b"))
    while True:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = _nearest(sides)
        large = sides.join(near, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "links")
        near = _nearest(large)
        small = large.join(near, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            near.select("a", F.col("m").alias("b"))
        )
        links, now = _settle(small.where("a <> b"))
        if now == mark:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
