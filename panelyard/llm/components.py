"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelyard.session import materialise


def local_stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of one batch as stars: (smallest member, other member) of each of the batch's components."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (label[x], label[y]):
            np.minimum.at(new, side, low)
        while True:                      # halve the paths until every label is a root
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def _oriented(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``: the smallest node reachable.

    Each round links all larger neighbours of a node, then all smaller ones, to its smallest neighbour; the number of
    rounds grows with the logarithm of the longest path.  Every round is written to the shared folder.  The smallest
    neighbours are written too, so the join with the links of a node with very many can be split at run time.
    """
    edges = materialise(_oriented(links), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "low")
        large = materialise(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        # done when every node has one link and no link leads to a node that has one itself
        open_ = after.groupBy("u").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        if not open_ and not after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count():
            break
        edges = after
    return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        after.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
