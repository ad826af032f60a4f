"""Tables that are added to load by load: keys, cluster labels, and the loads below them."""

import random

import pytest
from pyspark.sql import functions as F

from mergelane.operators import kept_clusters, key_registry
from mergelane.sources import buckets, loads


def stop(*_args, **_kwargs):
    raise KeyboardInterrupt


def test_keys_are_dense_and_stay(spark, tmp_path, monkeypatch):
    path, columns = str(tmp_path / "keys"), ["name", "number"]
    rows = [("a", 1), ("a", None), (None, 1), (None, None), ("a", 1), ("a_1", None), ("", 1)]
    first = spark.createDataFrame(rows, "name string, number int").withColumn("entity", F.lit("x"))
    # A load that is stopped before its commit leaves nothing behind that a reader sees.
    with monkeypatch.context() as patch:
        patch.setattr(key_registry, "append_load", stop)
        with pytest.raises(KeyboardInterrupt):
            key_registry.register_keys(first, columns, path)
    assert key_registry.read_keys(spark, path, first, columns).count() == 0
    assert key_registry.register_keys(first, columns, path) == 6
    before = {(r[0], r[1]): r[2] for r in key_registry.read_keys(spark, path, first, columns).collect()}
    assert sorted(before.values()) == [1, 2, 3, 4, 5, 6]
    assert key_registry.register_keys(first, columns, path) == 0
    more = first.unionByName(spark.range(500).selectExpr("concat('n', id) AS name", "cast(id AS int) AS number", "'y' AS entity"))
    assert key_registry.with_keys(more, columns, path).filter("entity_id IS NULL").count() == 500
    assert key_registry.register_keys(more.repartition(7), columns, path) == 500
    after = {(r[0], r[1]): r[2] for r in key_registry.read_keys(spark, path, first, columns).collect()}
    assert sorted(after.values()) == list(range(1, 507)) and {k: after[k] for k in before} == before
    assert key_registry.with_keys(more, columns, path).filter("entity_id IS NULL").count() == 0
    assert key_registry.register_keys(first.limit(0), columns, path) == 0


def test_two_loads_at_once_are_an_error(spark, tmp_path):
    path = str(tmp_path / "table")
    loads.append_load(spark.range(3), path, 0)
    loads.append_load(spark.range(3), path, 0)
    with pytest.raises(RuntimeError, match="same time"):
        loads.read_loads(spark, path, "id long")


def components(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("seed", [1, 2])
def test_labels_equal_a_full_run(spark, tmp_path, monkeypatch, seed):
    rng = random.Random(seed)
    path, schema = str(tmp_path / "labels"), "src long, dst long"
    kept_clusters.create_labels(spark, path, parts=4)
    assert kept_clusters.read_labels(spark, path).count() == 0
    so_far = []
    for step in range(3):
        batch = [(rng.randrange(60), rng.randrange(60)) for _ in range(14)]
        so_far += batch
        frame = spark.createDataFrame([*batch, batch[0], (None, 3), (4000, None)], schema)
        if step == 1:
            # Stopped after the joined labels were committed, then given again.
            with monkeypatch.context() as patch:
                patch.setattr(kept_clusters, "append_load", stop)
                with pytest.raises(KeyboardInterrupt):
                    kept_clusters.add_links(path, frame)
        kept_clusters.add_links(path, frame)
        assert {r.node: r.label for r in kept_clusters.read_labels(spark, path).collect()} == components(so_far)
    stored = len(loads.committed(spark, f"{path}/nodes"))
    kept_clusters.add_links(path, spark.createDataFrame(so_far[:5], schema))
    assert len(loads.committed(spark, f"{path}/nodes")) == stored
    assert all(r.label > r.root for r in buckets.read_buckets(spark, f"{path}/roots").collect())


def test_a_batch_shuffles_no_stored_node(spark, tmp_path):
    path = str(tmp_path / "labels")
    kept_clusters.create_labels(spark, path, node_type="string", parts=2)
    links = spark.range(200).selectExpr("concat('n', id) AS src", "concat('n', id - id % 10) AS dst")
    kept_clusters.add_links(path, links)
    stored = {p.name for p in (tmp_path / "labels" / "nodes" / "data").iterdir()}
    kept_clusters.add_links(path, spark.createDataFrame([("n15", "n25"), ("new", "n30")], "src string, dst string"))
    again = {p.name for p in (tmp_path / "labels" / "nodes" / "data").iterdir()}
    assert stored < again and len(again) == len(stored) + 1
    found = {r.node: r.label for r in kept_clusters.read_labels(spark, path).collect()}
    assert found["n29"] == found["n11"] == "n10" and found["new"] == found["n31"] == "n30"
