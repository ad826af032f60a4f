"""Transitive clusters of matched records, and values shared within a cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergelane.operators.lookups import lookup
from mergelane.session import discard, materialize


def match_edges(df: DataFrame, match_columns: Sequence[str], id_column: str) -> DataFrame:
    """Distinct links (src > dst) between each id and the ids in its match columns."""
    kind = df.schema[id_column].dataType
    ends = F.explode(F.array(*[F.col(c).try_cast(kind) for c in match_columns]))
    links = df.select(F.col(id_column).alias("id"), ends.alias("other"))
    return (
        links.filter(F.col("id") != F.col("other"))
        .select(F.greatest("id", "other").alias("src"), F.least("id", "other").alias("dst"))
        .distinct()
    )


def _lower_hubs(edges: DataFrame) -> DataFrame:
    """Link the larger end of every edge to the smallest node around the smaller end ("large star")."""
    sides = F.array(
        F.struct(F.col("src").alias("node"), F.col("dst").alias("around")),
        F.struct(F.col("dst").alias("node"), F.col("src").alias("around")),
    )
    smallest = edges.select(F.explode(sides).alias("s")).groupBy("s.node").agg(F.min("s.around").alias("around"))
    lows = smallest.select("node", F.least("node", "around").alias("low"))
    moved = lookup(edges, lows, [("dst", "node")], ["low"])
    return moved.select("src", F.col("low").alias("dst")).distinct()


def _join_hubs(edges: DataFrame) -> DataFrame:
    """Link all smaller neighbours of a node to the smallest of them ("small star")."""
    smallest = edges.groupBy("src").agg(F.min("dst").alias("low"))
    joined = lookup(edges, smallest, ["src"], ["low"])
    # (src, low) comes out of the edge whose other end is the smallest one.
    end = F.when(F.col("dst") == F.col("low"), F.col("src")).otherwise(F.col("dst"))
    return joined.select(end.alias("src"), F.col("low").alias("dst")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    """The number of edges and two sums over them; no round that moves an edge keeps all three."""
    hashes = [F.xxhash64(F.lit(seed), "src", "dst").cast("decimal(20,0)") for seed in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *[F.sum(h) for h in hashes]).first())


def connected_components(edges: DataFrame, max_iterations: int | None = None) -> DataFrame:
    """(node, label) for every node but the hubs themselves; label = smallest node of the component.

    Alternating stars (Kiveris et al., "Connected Components in MapReduce and Beyond", SoCC 2014):
    a number of rounds that grows with the logarithm of the longest chain, not with its length, and
    no task ever holds the neighbours of a node. A round that changes nothing is the last. Each round
    is written to the shared folder, and the one before it is deleted. Labels that `max_iterations` leaves
    incomplete are an error.
    """
    current = materialize(edges, "edges")
    before, done = _fingerprint(current), 0
    while before[0]:
        following = materialize(_join_hubs(_lower_hubs(current)), "edges")
        discard(current)
        current, after = following, _fingerprint(following)
        if after == before:
            break
        before, done = after, done + 1
        if max_iterations is not None and done >= max_iterations:
            raise RuntimeError(f"clusters not complete after {done} rounds")
    return current.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("label"))


def unify_ids(
    df: DataFrame,
    match_columns: Sequence[str],
    id_column: str,
    label_column: str,
    max_iterations: int | None = None,
) -> DataFrame:
    """`df` with a cluster label: the smallest id among all records linked to it, directly or not.

    Runs jobs while it is planned, two per round.
    """
    labels = connected_components(match_edges(df, match_columns, id_column), max_iterations)
    labels = labels.withColumnRenamed("label", "__label")
    out = lookup(df, labels, [(id_column, "node")], ["__label"])
    return out.withColumn(label_column, F.coalesce("__label", id_column)).drop("__label")


def first_rule_wins(cols: Sequence[Column | str]) -> Column:
    """The first non-null of the rule results, in order of priority."""
    return F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in cols])


def fill_in_cluster(df: DataFrame, cluster: str, col: str, out: str) -> DataFrame:
    """`out` = the smallest non-null `col` of the cluster, the same on all its rows; `col` stays.

    Aggregated and joined back rather than windowed: a window would hold a whole cluster in one task.
    """
    values = df.groupBy(cluster).agg(F.min(col).alias(out))
    return lookup(df, values, [cluster], [out], null_safe=True)


def cluster_occurrence(
    df: DataFrame, cluster: str, filled: str, direct: str, out: str = "customer_number_Occurrence"
) -> DataFrame:
    """`out` = number of distinct (filled, direct) pairs of the cluster; pairs with a null do not count."""
    pair = F.when(F.col(filled).isNotNull() & F.col(direct).isNotNull(), F.struct(filled, direct))
    # Counted per pair first, so that a cluster is spread over its pairs before it is summed up.
    pairs = df.select(cluster, pair.alias("p")).distinct()
    counts = pairs.groupBy(cluster).agg(F.count("p").cast("int").alias(out))
    return lookup(df, counts, [cluster], [out])
