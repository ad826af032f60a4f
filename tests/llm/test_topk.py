import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergelane.llm import topk_bitslice as tk


def brute(rows, k, factor=256):
    good = [
        (i, [math.floor(factor * float(x)) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, v in good:
        if q % 3 == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q and len(w) == len(v))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k, **sizes):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("x")).withColumn("id", F.lit(1))
    out = tk.top_k(frame, F.col("vec_id") % 3 == 0, k, **sizes)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect())


def vectors(n, dim, seed, scale=0.3):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, scale, dim)]) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 70, "chunk_queries": 9}, {"block_rows": 1, "chunk_queries": 100}])
def test_against_brute_force(spark, sizes):
    rows = vectors(60 if sizes.get("block_rows") == 1 else 400, 16, 1)
    assert found(spark, rows, 5, **sizes) == brute(rows, 5)


def test_ties_copies_and_bad_vectors(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(30)] + [(40, [0.0] * 3), (41, None), (42, [1.0, None, 2.0]), (43, [float("nan")] * 3)]
    rows += [(44, [float("inf"), 0.0, 0.0]), (None, same), (45, []), (48, []), (51, [1.0]), (60, [-1.0]), (61, [1000.0, -1000.0, 5.0])]
    assert found(spark, rows, 5, block_rows=8) == brute(rows, 5)


def test_repeated_rows(spark):
    rows = [(3, [1.0]), (3, [2.0]), (4, [1.0]), (4, [1.0])]
    assert found(spark, rows, 5) == sorted([(3, 1, 4, 256**2), (3, 2, 4, 256**2), (3, 1, 4, 2 * 256**2), (3, 2, 4, 2 * 256**2)])


def test_empty(spark):
    assert found(spark, [], 5) == [] and found(spark, [(1, [1.0])], 5) == [] and found(spark, [(3, [1.0])], 5) == []


@pytest.mark.parametrize("spread", [3, 40, 5000, 10**9])
def test_block(spread):
    rng = np.random.default_rng(3)
    values = rng.integers(-spread, spread, (300, 9))
    weights = rng.integers(-spread, spread, (70, 9))
    for weight, (rows, scores) in zip(weights, tk.Block(values).search(weights, 4)):
        exact = [sum(int(a) * int(b) for a, b in zip(weight, v)) for v in values]
        last = sorted(exact)[-4]
        assert rows.tolist() == [i for i, s in enumerate(exact) if s >= last]
        assert [int(s) for s in scores] == [exact[i] for i in rows]


def test_sums_are_the_slices_of_the_sums():
    rng = np.random.default_rng(4)
    values, weights = rng.integers(0, 64, (100, 5)), rng.integers(-9, 9, (3, 5))
    block = tk.Block(values)
    sums = block.sums(weights)
    bits = [np.unpackbits(s.view(np.uint8), axis=1, bitorder="little")[:, :100].astype(int) << i for i, s in enumerate(sums)]
    quantised = (values - block.low) >> block.cut
    for q, weight in enumerate(weights):
        expected = [sum(abs(w) * (x if w >= 0 else 63 - x) for w, x in zip(weight, v)) for v in quantised]
        assert sum(bits)[q].tolist() == expected
