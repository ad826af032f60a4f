"""The inverted multi-index against brute force."""

import heapq
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergelane.llm import multi_index

SCHEMA = "vec_id long, embedding array<float>"


def _brute(rows, threshold):
    """(id, links, component, kept) of each row (id, vector or None), all pairs compared."""
    good = [i for i, (_, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, parent = {i: 0 for i in range(len(rows))}, list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_dim = {}
    for i in good:
        by_dim.setdefault(len(rows[i][1]), []).append(i)
    for members in by_dim.values():
        units = multi_index.unit_rows(np.array([rows[i][1] for i in members], dtype=np.float32))
        cosine = units @ units.T
        np.fill_diagonal(cosine, -1)
        for a, b in zip(*np.nonzero(cosine >= threshold)):
            links[members[a]] += 1
            parent[top(members[a])] = top(members[b])
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[top(i)] = min(least.get(top(i), id_), id_)
    return sorted(
        ((id_, links[i], c := least.get(top(i)), id_ == c) for i, (id_, _) in enumerate(rows)), key=lambda r: (str(r), r[1])
    )


def _found(spark, rows, threshold=0.9, **more):
    table = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)
    out = multi_index.near_duplicates(table.repartition(3), threshold, **more).collect()
    return sorted((tuple(r) for r in out), key=lambda r: (str(r), r[1]))


def _corpus(n, groups, dim=16, seed=1, noise=0.05):
    """Random vectors, and groups of near copies whose noise differs from copy to copy."""
    rng = np.random.default_rng(seed)
    vectors = list(rng.normal(size=(n, dim)))
    for size in groups:
        base = rng.normal(size=dim)
        vectors += [base + rng.normal(size=dim) * noise * rng.uniform(0, 6) for _ in range(size)]
    order = rng.permutation(len(vectors))
    return [(int(i), vectors[i].astype(np.float32).tolist()) for i in order]


@pytest.mark.parametrize("strip", [1024, 16])
def test_all_cells_is_exact(spark, strip):
    """With every cell visited nothing is missed, whether cells are whole, in strips, or made smaller by balls."""
    rows = _corpus(150, [90, 40, 7, 3], seed=strip)
    rows += [(i + 10_000, v) for i, v in rows[:30]]  # equal vectors under other ids
    assert _found(spark, rows, target=None, strip=strip) == _brute(rows, 0.9)


def test_balls_stand_for_their_members(spark, monkeypatch):
    """Crowded cells form balls; pairs that the triangle inequality leaves open are settled by the members."""
    monkeypatch.setattr(multi_index, "CROWDED", 1)
    made = []
    real = multi_index._balls
    monkeypatch.setattr(multi_index, "_balls", lambda *a: made.append(real(*a)) or made[-1])
    rows = _corpus(60, [120, 60], dim=12, seed=9)
    assert _found(spark, rows, target=None, strip=12) == _brute(rows, 0.9)
    units, members = made[0]
    assert members is not None and members.count() > 60
    assert units.count() < len(rows) - 50


def test_recall_of_the_traversal(spark):
    """Pairs just above the threshold, in random directions: at least 0.9 are found, and no others."""
    rng = np.random.default_rng(3)
    base = multi_index.unit_rows(rng.normal(size=(1500, 64)))
    aside = rng.normal(size=base.shape)
    aside = multi_index.unit_rows(aside - (aside * base).sum(1)[:, None] * base)
    twins = 0.905 * base + math.sqrt(1 - 0.905**2) * aside
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(np.concatenate([base, twins]))]
    expected = {i: n for i, n, _, _ in _brute(rows, 0.9)}
    found = {i: n for i, n, _, _ in _found(spark, rows)}
    assert all(found[i] <= expected[i] for i in expected)
    assert sum(found.values()) >= 0.9 * sum(expected.values()) > 0


def test_odd_vectors(spark):
    one = [1.0] * 16
    rows = [
        (1, one), (2, None), (3, [0.0] * 16), (4, [float("nan")] + one[1:]), (5, one[:-1] + [float("inf")]), (6, [None] + one[1:]),
        (None, one), (None, [1.0] + [0.0] * 15), (7, [1.0, 2.0]), (8, [1.0, 2.1]), (9, [2.0]), (9, [2.0]), (10, []), (11, [-1.0] * 16),
        (12, [3e-30] * 16), (13, [1e30] * 16),
    ]
    got = _found(spark, rows)
    assert {(r[0], r[1], r[2], r[3]) for r in got if r[0] is not None} == {
        (1, 3, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True),
        (8, 1, 7, False), (9, 1, 9, True), (10, 0, 10, True), (11, 0, 11, True), (12, 3, 1, False), (13, 3, 1, False),
    }
    assert len(got) == len(rows)
    assert sorted((r[1], r[2] or 0, r[3]) for r in got if r[0] is None) == [(0, 0, True), (3, 1, False)]


def test_empty_table_and_clashing_columns(spark):
    assert _found(spark, []) == [] and _found(spark, [(1, None)]) == [(1, 0, 1, True)]
    table = spark.createDataFrame([(1, [1.0] * 8), (2, [1.0] * 8)], SCHEMA)
    for name in ("cell", "uid", "vector", "rows", "id", "label", "n_links", "component_id", "kept", "cid"):
        table = table.withColumn(name, F.lit("x"))
    assert sorted(tuple(r) for r in multi_index.near_duplicates(table).collect()) == [(1, 1, 1, True), (2, 1, 1, False)]
    with pytest.raises(ValueError):
        multi_index.near_duplicates(table, threshold=1.5)


def test_multi_sequence_gives_cells_by_distance():
    rng = np.random.default_rng(0)
    one, two = sorted(rng.random(9).tolist()), sorted(rng.random(7).tolist())
    found = multi_index.multi_sequence(one, two, 0.6)
    sums = [one[x] + two[y] for x, y in found]
    every = sorted(a + b for a in one for b in two)
    assert sums == heapq.nsmallest(len(sums), every) and len(set(found)) == len(found)
    assert every[len(sums)] > one[0] + two[0] + 0.6 >= sums[-1]
