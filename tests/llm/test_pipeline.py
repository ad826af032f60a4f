import sys
from fractions import Fraction
from pathlib import Path

import pytest

import brute

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from mergelane.llm import quality, secret_scan  # noqa: E402
from mergelane.session import materialize  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        result = materialize(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        out.append((docs, result))
        docs = result
    return out


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_columns(spark, stages):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram Jaccard join", "secret scan", "best-fit packing"]
    for _, result in stages[:-1]:
        assert result.dtypes == documents.dtypes


def test_quality(spark, stages):
    docs, kept = stages[0]
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    expected = []
    for d in docs.collect():
        import numpy as np

        text = np.array([quality.text_features(d.text or "")])
        meta = np.array([quality.meta_features(d.lang, d.source, d.n_chars)])
        if model.scores(text, meta)[0, 2] >= 0.5:
            expected.append(tuple(d))
    assert rows(kept) == sorted(expected, key=repr)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = {r.doc_id for r in kept.collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in left for i in good) >= 0.97 * len(good) and sum(i in left for i in bad) <= 0.1 * len(bad)


def test_near_duplicates(stages):
    docs, kept = stages[1]
    all_rows = docs.collect()
    parts = brute.components([(r.doc_id, r.text) for r in all_rows], 5, Fraction(4, 5))
    first = {i for i, _, part in parts if i == part}
    assert rows(kept) == sorted((tuple(r) for r in all_rows if r.doc_id in first), key=repr)
    assert len(first) < len(all_rows)


def test_secrets(stages):
    import re

    docs, clean = stages[2]
    before, after = {r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in clean.collect()}
    assert before.keys() == after.keys()
    planted = re.compile(r"AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{18}|(?<=token = \")[0-9a-f]{40}")
    for i, r in before.items():
        assert not planted.search(after[i].text)
        assert after[i].n_chars == len(after[i].text)
        if not planted.search(r.text):
            assert after[i].text == r.text
        else:
            assert after[i].text == planted.sub("[SECRET]", r.text)


def test_packing(stages):
    docs, packed = stages[3]
    words = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    found = {}
    for r in packed.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.size
    assert found.keys() == words.keys()
    assert all(abs(found[i] - n) <= 0 or any(c in docs.filter(f"doc_id = {i}").first().text for c in "\x85\xa0") for i, n in words.items())


def test_run(spark, stages):
    result = corpus_pipeline.run(spark, FOLDER)
    assert sorted((r.doc_id, r.piece, r.size) for r in result.collect()) == sorted((r.doc_id, r.piece, r.size) for r in stages[3][1].collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_and_odd_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "", "", 0), (10**9, "", "", "", 0)], docs.schema)
    for name, frame in (("none", docs.limit(0)), ("odd", docs.limit(40).unionByName(odd))):
        folder = str(tmp_path / name)
        frame.write.parquet(f"{folder}/documents.parquet")
        spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
        result = corpus_pipeline.run(spark, folder)
        assert result.count() >= 0 and "bin" in result.columns
