"""Whitening against numpy in extended precision where it matters."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mergelane.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def _table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], SCHEMA)


def _check(got, rows, components):
    """`got` is the whitening of rows (id, vector), up to the sign of each component."""
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, dim = x.shape
    sums = x.sum(axis=0)
    apart = n * x - sums
    centred = apart.astype(np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(values)[::-1]
    values, vectors = values[order], vectors[:, order]
    width = min(components, dim)
    assert len(got) == n * width and {r["component"] for r in got} == set(range(1, width + 1))
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
        assert r["n"] == n and r["identity_error"] <= 1e-4
    for c, part in by.items():
        white = centred @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        expected = sorted((i, int((apart[k] ** 2).sum()), white[k]) for k, (i, _) in enumerate(rows))
        found = sorted((r["vec_id"], r["deviation"], r["whitened"]) for r in part)
        assert [e[:2] for e in expected] == [f[:2] for f in found]
        a, b = np.array([e[2] for e in expected]), np.array([f[2] for f in found])
        sign = np.sign(a @ b)
        assert np.allclose(a, sign * b, rtol=1e-7, atol=1e-8)
        assert all(abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-8 for r in part)


@pytest.mark.parametrize("dim, components", [(40, 32), (6, 32), (12, 5)])
def test_against_numpy(spark, monkeypatch, dim, components):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 64)  # several blocks and sums
    rng = np.random.default_rng(dim)
    mixed = rng.normal(size=(300, dim)) @ rng.normal(size=(dim, dim)) + rng.normal(size=dim) * 50
    rows = [(int(i), v.astype(np.float32).tolist()) for i, v in enumerate(mixed)]
    got = whitening.whiten(_table(spark, rows).repartition(7), components=components).collect()
    _check(got, rows, components)


def test_odd_rows_go(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(30)]
    odd = [(90, None), (91, []), (92, [1, 2, 3, None]), (93, [1, 2, 3, float("nan")]), (94, [float("-inf"), 0, 0, 0]), (95, [1, 2])]
    again = [rows[3], (3, rows[4][1])]
    _check(whitening.whiten(_table(spark, [*rows, *odd, *again])).collect(), [*rows, *again], 32)
    null_id = whitening.whiten(_table(spark, [*rows, (None, [0.5] * 4)])).filter("vec_id IS NULL")
    assert null_id.count() == 4


def test_directions_without_variance(spark):
    rows = [(i, [float(i), 5.0, float(2 * i)]) for i in range(10)]
    got = whitening.whiten(_table(spark, rows)).collect()
    assert len(got) == 30
    for r in got:
        assert (r["whitened"] is None) == (r["component"] > 1)
        assert r["identity_error"] < 1e-9 and abs(r["explained"] - (r["component"] == 1)) < 1e-9
    alone = whitening.whiten(_table(spark, [(1, [1.0, 2.0])])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == [(0, None, None, 0.0)] * 2


def test_empty_and_clashing_columns(spark):
    assert whitening.whiten(_table(spark, [])).collect() == [] and whitening.whiten(_table(spark, [(1, None)])).count() == 0
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(20)]
    table = _table(spark, rows)
    for name in ("row", "id", "v", "x", "values", "vector", "component", "n", "at", "slice"):
        table = table.withColumn(name, F.lit("x"))
    _check(whitening.whiten(table).collect(), rows, 32)


def test_numbers_have_no_gaps(spark):
    table = spark.range(1000).repartition(6).filter("id % 3 <> 1")
    numbers = sorted(r["row"] for r in whitening.numbered(table).collect())
    assert numbers == list(range(len(numbers)))


def test_rows_stay_in_the_jvm(spark):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(20)]
    plan = whitening.whiten(_table(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
