"""Connected components against a plain union-find."""

import random

from mergelane.llm.components import components


def _expected(edges):
    parent = {}

    def top(i):
        parent.setdefault(i, i)
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in edges:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    return {i: top(i) for i in parent if top(i) != i}


def _run(spark, edges):
    found = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert len(found) == len({r["node"] for r in found})
    return {r["node"]: r["label"] for r in found}


def test_chains_stars_and_random_graphs(spark):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(200, i) for i in range(100, 150)]
    loose = [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(90)]
    edges = [*chain, *star, *loose, (7, 7), (3, 2), (-5, 100)]
    rng.shuffle(edges)
    assert _run(spark, edges) == _expected(edges)


def test_nothing_and_loops(spark):
    assert _run(spark, []) == {} and _run(spark, [(4, 4)]) == {}
