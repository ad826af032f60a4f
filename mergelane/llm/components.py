"""Connected components of links between integer nodes."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from mergelane.session import discard, materialize


def _written(links: DataFrame) -> tuple[DataFrame, dict]:
    """`links` (src > dst), each once, as a table, with their number and two sums over them, which come with the write."""
    seen = Observation(uuid.uuid4().hex)
    digest = lambda seed: F.sum(F.xxhash64(F.lit(seed), "src", "dst").cast("decimal(20,0)"))
    watched = links.distinct().observe(
        seen, F.count(F.lit(1)).alias("n"), digest(1).alias("one"), digest(2).alias("two")
    )
    return materialize(watched, "links"), seen.get


def _onto_lowest(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest node that it knows, itself included."""
    ends = links.select("src", "dst").unionAll(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = ends.groupBy(F.col("src").alias("dst")).agg(F.min("dst").alias("low"))
    moved = links.join(low, "dst").select("src", F.least("dst", "low").alias("dst"))
    # Then each node's smaller neighbours, and the node itself, to the smallest of them.
    least = moved.groupBy("src").agg(F.min("dst").alias("least"))
    both = moved.join(least, "src")
    return both.select(
        F.when(F.col("dst") == F.col("least"), F.col("src")).otherwise(F.col("dst")).alias("src"), F.col("least").alias("dst")
    ).filter("src <> dst")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes with links but the labels themselves; label = smallest node of the component.

    `links` has long columns src and dst in any order; links of a node with itself, repeated ones and none at all are
    fine. Alternating stars (Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014): the rounds grow
    with the logarithm of the longest chain, and no task holds the neighbours of a node. Each round is a table in the
    shared folder, so a lost executor repeats a part of one round only. Jobs run while it is planned.
    """
    ordered = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src <> dst")
    current, before = _written(ordered)
    while before["n"]:
        following, after = _written(_onto_lowest(current))
        discard(current)
        current = following
        if after == before:
            break
        before = after
    return current.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("label"))


def joined(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column of a table of links reaches."""
    most = np.iinfo(np.int64).max
    a, b = left.copy(), right.copy()
    while True:
        new_b = np.minimum(b, np.where(linked, a[:, None], most).min(axis=0, initial=most))
        new_a = np.minimum(a, np.where(linked, new_b[None, :], most).min(axis=1, initial=most))
        if (new_a == a).all() and (new_b == b).all():
            return a, b
        a, b = new_a, new_b
