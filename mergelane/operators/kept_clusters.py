"""Cluster labels kept in tables, to which batches of links are added.

A node is stored once, with the label that it had when it came. Where a batch joins clusters, the larger labels are stored with
the smallest one of the joined clusters, which stands for them from then on. So a batch solves its own links only, between
labels, and rewrites no node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelane.operators.clusters import connected_components
from mergelane.operators.lookups import lookup
from mergelane.session import discard, materialize
from mergelane.sources import buckets
from mergelane.sources.loads import append_load, committed, read_loads


def create_labels(spark: SparkSession, path: str, node_type: str = "long", parts: int = 64) -> None:
    """Empty tables for nodes of `node_type` in a folder that holds none yet."""
    roots = spark.createDataFrame([], f"label {node_type}, root {node_type}")
    buckets.create_buckets(roots, f"{path}/roots", ["label"], parts)


def _nodes(spark: SparkSession, path: str) -> DataFrame:
    kind = buckets.read_buckets(spark, f"{path}/roots").schema["label"].dataType.simpleString()
    return read_loads(spark, f"{path}/nodes", f"node {kind}, label {kind}")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(node, label) of every node that a link named; the label is the smallest node of its cluster."""
    roots = buckets.read_buckets(spark, f"{path}/roots")
    found = lookup(_nodes(spark, path), roots, ["label"], ["root"])
    return found.select("node", F.coalesce("root", "label").alias("label"))


def add_links(path: str, links: DataFrame, left: str = "src", right: str = "dst") -> None:
    """Add the links between columns `left` and `right`; a node linked with itself is a node, links with a null are none.

    The stored nodes are scanned for the ends of the batch, which Spark broadcasts if they are few; nothing else of them is
    shuffled or written. Joined labels are committed before new nodes. After a stop in between, the same batch given again
    completes it, as does a batch given twice at any time. One batch at a time.
    """
    spark = links.sparkSession
    batch = links.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna().distinct()
    batch = materialize(batch, "links")
    ends = materialize(batch.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")
    stored, loads = _nodes(spark, path), len(committed(spark, f"{path}/nodes"))
    roots = buckets.read_buckets(spark, f"{path}/roots")
    # The stored rows of the batch's ends only, so that a small batch is what is shuffled.
    held = lookup(stored.join(ends, "node"), roots, ["label"], ["root"])
    held = held.select("node", F.coalesce("root", "label").alias("held"))
    # A batch that was stopped may have joined nodes that were not stored yet: their roots hold as well.
    known = lookup(lookup(ends, held, ["node"], ["held"]), roots, [("node", "label")], ["root"])
    labels = known.select("node", F.coalesce("held", "root", "node").alias("at"), F.col("held").isNull().alias("new"))
    labels = materialize(labels, "labels")
    pairs = lookup(batch, labels.withColumnRenamed("at", "at_a"), [("a", "node")], ["at_a"])
    pairs = lookup(pairs, labels.withColumnRenamed("at", "at_b"), [("b", "node")], ["at_b"])
    edges = pairs.filter("at_a <> at_b").select(F.greatest("at_a", "at_b").alias("src"), F.least("at_a", "at_b").alias("dst"))
    joined = connected_components(edges.distinct()).select(F.col("node").alias("label"), F.col("label").alias("root"))
    joined = materialize(joined.filter("label <> root"), "joined")
    # Labels that stood for others hand them on; new nodes alone in the batch need no entry of their own.
    handed = roots.join(joined.select(F.col("label").alias("root"), F.col("root").alias("to")), "root")
    new = labels.filter("new").select("node", "at")
    lost = joined.join(new.select(F.col("node").alias("label")), "label", "left_anti")
    changed = materialize(handed.select("label", F.col("to").alias("root")).unionByName(lost), "changed")
    buckets.upsert_buckets(f"{path}/roots", changed, ["root"])
    fresh = lookup(new, joined, [("at", "label")], ["root"]).select("node", F.coalesce("root", "at").alias("label"))
    if not new.isEmpty():
        append_load(fresh, f"{path}/nodes", loads)
    for table in (batch, ends, labels, joined, changed):
        discard(table)
