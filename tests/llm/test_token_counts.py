import uuid

import pytest
from pyspark.sql import functions as F

from frames import CLASHES, documents
from mergelane.llm import token_counts as tc

def tokenizers():
    return {"w1": F.size(F.split("text", " ")), "c1": F.length("text")}


def rows(frame):
    return sorted(((r.source, r.lang, r.tokenizer, r.docs, r.tokens) for r in frame.collect()), key=repr)


@pytest.fixture
def store(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def test_signed_batches(spark, store):
    docs = documents(spark, ["a b", "c", None, "d e f", "a b"], [1, 2, 3, 4, 1], **CLASHES)
    counts = tc.counted(docs, tokenizers())
    tc.commit(store, "b1", tc.inserts(counts))
    once = rows(tc.totals(spark, store))
    assert ("src1", "en", "w1", 3, 7) in once and ("src0", "en", "c1", 1, 0) in once
    tc.commit(store, "b1", tc.inserts(counts))
    assert rows(tc.totals(spark, store)) == once
    four = tc.counted(docs.filter("doc_id = 4"), tokenizers())
    tc.commit(store, "b2", tc.deletes(four))
    revised = spark.createDataFrame([("src1", "en", "w1", 2, 5)], "source string, lang string, tokenizer string, old_tokens long, tokens long")
    tc.commit(store, "b3", tc.revisions(revised))
    assert ("src1", "en", "w1", 2, 7) in rows(tc.totals(spark, store))
    for batch, changes in (("b2", tc.deletes(four)), ("b3", tc.revisions(revised)), ("b1", tc.inserts(counts))):
        tc.commit(store, batch, changes)
    assert ("src1", "en", "w1", 2, 7) in rows(tc.totals(spark, store))
    assert {r.batch for r in tc.batches(spark, store).collect()} == {"b1", "b2", "b3"}
    other = store + "-compact"
    tc.compact(spark, store, other, "upto-b3")
    assert rows(tc.totals(spark, other)) == rows(tc.totals(spark, store))


def test_all_deleted_and_empty(spark, store):
    counts = tc.counted(documents(spark, ["a"], [1]), tokenizers())
    tc.commit(store, "none", tc.inserts(counts.limit(0)))
    assert rows(tc.totals(spark, store)) == []
    tc.commit(store, "in", tc.inserts(counts))
    tc.commit(store, "out", tc.deletes(counts))
    assert rows(tc.totals(spark, store)) == []
    # A batch that is committed again without rows takes its old ones back.
    tc.commit(store, "out", tc.deletes(counts.limit(0)))
    assert len(rows(tc.totals(spark, store))) == 2


def test_null_keys_and_names(spark, store):
    docs = spark.createDataFrame([(None, None, "x y"), (None, None, None)], "source string, lang string, text string")
    tc.commit(store, "b", tc.inserts(tc.counted(docs, {"w1": F.size(F.split("text", " "))})))
    assert [r[:2] + r[3:] for r in rows(tc.totals(spark, store))][0][:2] == (None, None)
    with pytest.raises(ValueError):
        tc.commit(store, "a/b", tc.inserts(tc.counted(docs, {"c1": F.length("text")})))
