"""Connected components by alternating stars; no node's neighbours are ever gathered in one place."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from millrace.sources.staging import stage


def local_stars(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links (left, right) as stars around the smallest node of each of their components.

    What one task has found thus leaves it as at most one row per node, however many links there were.
    """
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[:len(left)], at[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); component is the smallest node reachable.

    Each round joins edges to the minimum of their end (a join that adaptive execution may split, where
    one node has very many edges) and is written to the shared folder, so lineage stays short. The number
    of rounds grows with the logarithm of the longest chain. Without links the result is empty.
    """
    def step(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        stars = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = stars.groupBy("u").agg(F.min("v").alias("m"))
        return (stars.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .union(low.select("u", F.col("m").alias("v"))).distinct())

    def mark(edges: DataFrame):
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = stage(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(),
                  "links")
    before = mark(edges)
    while before[0]:
        edges = stage(step(edges), "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
