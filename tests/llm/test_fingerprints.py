import hashlib

import pytest
from pyspark.sql import functions as F

from frames import CLASHES, documents
from mergelane.llm import fingerprints as fp
from mergelane.llm.queries import QUERIES, table


def brute(rows):
    """rows: (id, text); every row's edited text and that of the next one by descending id."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        out.append((i, len(text), hashlib.sha256(fp.edited(text, following).encode()).hexdigest(),
                    fp.digest(text.encode()).hex(), fp.digest(following.encode()).hex()))
    return sorted(out, key=repr)


def found(frame):
    return sorted(
        ((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint) for r in frame.collect()), key=repr
    )


ROWS = [(5, "five"), (9, "nine é" * 50), (1, ""), (7, None), (7, "seven"), (3, "x" * 200_000), (2, "ab"), (4, "five"), (None, "none"), (None, "None")]


@pytest.mark.parametrize("slice_bytes", [1 << 30, 20_000, 1])
def test_next_document(spark, slice_bytes):
    docs = documents(spark, [t for _, t in ROWS], [i for i, _ in ROWS], **CLASHES)
    out = fp.edit_fingerprints(docs, size_col="n_chars", slice_bytes=slice_bytes)
    assert found(out) == sorted([r[:4] for r in brute(ROWS)], key=repr)


@pytest.mark.parametrize("rows", [[], [(1, "alone")], [(1, "same"), (1, "same")], [(None, "x")]])
def test_few_rows(spark, rows):
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    out = fp.edit_fingerprints(docs)
    assert found(out) == sorted([r[:4] for r in brute(rows)], key=repr)


def test_digest():
    assert fp.digest(b"") == bytes(65) and fp.digest(b"a") != fp.digest(b"b")
    text = "The quick brown fox jumps over the lazy dog. " * 30
    a, b, c = text.encode(), text.replace("lazy", "idle").encode(), bytes(range(256)) * 6
    assert fp.likeness(fp.digest(a), fp.digest(a)) == 1
    assert fp.likeness(fp.digest(a), fp.digest(b)) > fp.likeness(fp.digest(a), fp.digest(c)) >= 0
    assert fp.difference(fp.digest(a), fp.digest(c)) == fp.difference(fp.digest(c), fp.digest(a))


def test_difference_against_codes():
    def plain(x, y):
        codes = [[byte >> s & 3 for byte in d[1:] for s in (6, 4, 2, 0)] for d in (x, y)]
        apart = sum({0: 0, 1: 1, 2: 2, 3: 6}[abs(p - q)] for p, q in zip(*codes))
        return apart + max(0, abs(x[0] - y[0]) - 1)

    for a, b in ((b"abc" * 9, b"xyz" * 99), (b"", b"q" * 500), (bytes(range(256)), bytes(range(255, -1, -1)))):
        assert fp.difference(fp.digest(a), fp.digest(b)) == plain(fp.digest(a), fp.digest(b))


def test_plain_fingerprints(spark):
    docs = documents(spark, [None, "", "abc", "abc"], [None, 1, 2, 3], **CLASHES)
    rows = {(r.doc_id, r.fingerprint) for r in fp.fingerprint(docs).collect()}
    empty = bytes(65).hex()
    assert rows == {(None, empty), (1, empty), (2, fp.digest(b"abc").hex()), (3, fp.digest(b"abc").hex())}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(d.doc_id, d.text) for d in table(spark, folder, "documents").collect()]
    out = QUERIES["op8_quartile_fingerprint"](spark, folder)
    assert found(out) == sorted([r[:4] for r in brute(rows)], key=repr)
    got = out.collect()
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in got)
    long = [r for r in got if r.n_chars >= 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_slices_come_from_the_texts(spark):
    """Without any n_chars the corpus is cut all the same."""
    docs = documents(spark, [f"text {i} " * 50 for i in range(60)]).withColumn("n_chars", F.lit(None).cast("long"))
    sized = docs.select(docs["doc_id"].alias("id"), F.octet_length("text").cast("long").alias("size"))
    assert len(fp._slices(sized, 2_000)) > 5
    found = fp.edit_fingerprints(docs, slice_bytes=2_000).collect()
    whole = fp.edit_fingerprints(docs).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, whole)) and len(found) == 60
