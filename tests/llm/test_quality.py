import random

import numpy as np
import pytest

from frames import CLASHES, SCHEMA, documents
from mergelane.llm import quality
from mergelane.llm.queries import table


def corpus(n, seed=1):
    """(text, good): prose of invented words, and repeated or marked words."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeilmnorst") for _ in range(rng.randrange(2, 8))) for _ in range(200)]
    out = []
    for i in range(n):
        own = [rng.choice(words) for _ in range(rng.randrange(20, 200))]
        good = i % 4 != 0
        text = ". ".join(" ".join(own[k : k + 9]).capitalize() for k in range(0, len(own), 9)) + "."
        if not good:
            text = rng.choice([" ".join([own[0]] * 80), "!! ".join(own).upper(), " | ".join(own), "### ".join(own)])
        out.append((text, good))
    return out


def test_held_out_accuracy(spark):
    texts = corpus(600)
    docs = documents(spark, [t for t, _ in texts], **CLASHES)
    labels = spark.createDataFrame([(i, int(g), "x") for i, (_, g) in enumerate(texts[:200])], "doc_id long, quality int, score string")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 600
    right = sum(r.good == int(texts[r.doc_id][1]) for r in rows if r.doc_id >= 200)
    assert right >= 0.97 * 400
    again = {r.doc_id: r.score for r in quality.classify(docs.repartition(5), labels).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-6 for r in rows)


def test_accuracy_on_the_tables(spark):
    """Fitted on half of the labels, measured on the others."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (table(spark, folder, n) for n in ("documents", "labels"))
    found = {r.doc_id: r.good for r in quality.classify(docs, labels.filter("doc_id % 2 = 0")).collect()}
    held = labels.filter("doc_id % 2 = 1").collect()
    good = [found[r.doc_id] for r in held if r.quality == 1]
    bad = [found[r.doc_id] for r in held if r.quality == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.05


def test_rows_and_nulls(spark):
    texts = [(t, g) for t, g in corpus(80)]
    docs = documents(spark, [t for t, _ in texts], **CLASHES)
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (900, "", "", "", -5), (901, "x " * 50_000, "zz", None, 10**12), (901, "x", "en", "s", 1)], SCHEMA
    )
    for c in CLASHES:
        odd = odd.selectExpr("*", f"'x' AS `{c}`")
    labels = [(i, int(g)) for i, (_, g) in enumerate(texts)] + [(None, 1), (3, None), (1, 0), (1, 1), (99999, 1), (900, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = quality.classify(docs.unionByName(odd), labels).collect()
    assert len(rows) == 84
    assert all(0 <= s <= 1 for r in rows for s in (r.text_score, r.meta_score, r.score))
    assert quality.classify(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("given", [[], [(0, 1), (1, 1), (2, 1)], [(0, 0)], [(0, 1), (1, 0)]])
def test_few_labels(spark, given):
    docs = documents(spark, [t for t, _ in corpus(30)])
    labels = spark.createDataFrame(given, "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 30 and all(0 <= r.score <= 1 for r in rows)
    if len({q for _, q in given}) < 2:
        assert len({r.score for r in rows}) == 1


def test_views_teach_each_other():
    """With few labels, what one view is sure of helps the other one."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 2000).astype(float)
    text = np.column_stack([y * 4 + rng.normal(0, 1, 2000), *rng.normal(0, 1, (12, 2000))])
    meta = np.column_stack([y * 4 + rng.normal(0, 1, 2000), *rng.normal(0, 1, (12, 2000))])
    fit = lambda rounds: quality.co_train(text[:40], meta[:40], y[:40], text[40:1000], meta[40:1000], rounds)
    right = [np.mean((fit(r).meta.raw(meta[1000:]) > 0) == y[1000:]) for r in (0, 4)]
    assert right[1] >= right[0] and right[1] > 0.95
