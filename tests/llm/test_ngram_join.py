import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

import brute
from frames import CLASHES, documents
from mergelane.llm import ngram_join, shingles
from mergelane.llm.queries import QUERIES, table


def agree(spark, rows, size, threshold, /, **more):
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], **more)
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.components(docs, size, threshold).collect()]
    assert sorted(found, key=repr) == sorted(brute.components(rows, size, threshold), key=repr)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words) or 1)
        words[i : i + rng.randrange(2)] = [rng.choice("pqrst")] * rng.randrange(3)
    return words


@pytest.mark.parametrize("short_list", [1, 16])
@pytest.mark.parametrize(("size", "threshold"), [(3, Fraction(9, 10)), (2, Fraction(4, 5)), (5, Fraction(1, 2))])
def test_random_texts(spark, monkeypatch, size, threshold, short_list):
    """With pairs from short lists, and with all lists by way of hubs."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    rng = random.Random(size)
    rows = []
    for family in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(6)) for _ in range(rng.choice([1, 3, 8, 40, 120, 400]))]
        for _ in range(rng.randrange(1, 9)):
            rows.append((rng.randrange(10_000), " ".join(edited(rng, base, rng.choice([0, 0, 1, 2, 5, 15])))))
    shared = " ".join(str(i) for i in range(60))
    rows += [(20_000 + i, shared + " " + " ".join(rng.choice("uvwxyz") * 3 for _ in range(30))) for i in range(25)]
    agree(spark, rows, size, threshold)


def test_chains_of_near_copies(spark):
    """Each is near the next one only; and a large group of near copies."""
    words = [f"w{i}" for i in range(200)]
    rows = [(100 - k, " ".join(words[2 * k : 2 * k + 100])) for k in range(40)]
    rows += [(1000 + k, " ".join([*words[:150], f"own{k}"])) for k in range(150)]
    agree(spark, rows, 3, Fraction(9, 10))


@pytest.mark.parametrize(("short_list", "threshold"), [(1, Fraction(9, 10)), (16, Fraction(9, 10)), (1, Fraction(4, 5))])
def test_copies_around_the_threshold(spark, monkeypatch, short_list, threshold):
    """Copies with few edits, some of them shared: links to the hub, past the hub, and between sets off the hub."""
    monkeypatch.setattr(ngram_join, "SHORT_LIST", short_list)
    rng = random.Random(5)
    rows = []
    for family in range(3):
        base = [f"f{family}w{rng.randrange(60)}" for _ in range(rng.choice([60, 120, 150]))]
        edits = [(rng.randrange(len(base)), f"e{family}x{k}") for k in range(12)]
        for k in range(50):
            words = list(base)
            for at, word in rng.sample(edits, rng.randrange(0, 8)):
                words[at] = word
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = f"own{family}y{k}z{rng.randrange(99)}"
            rows.append((family * 1000 + k, " ".join(words[: len(words) - rng.choice([0, 0, 0, 4])])))
    agree(spark, rows, 3, threshold)


def test_links_grow_with_the_members(spark, monkeypatch):
    """Near copies that mostly do not link to their hub: a link or so a member at any size, not one a pair."""
    made = []
    real = ngram_join._star_links
    monkeypatch.setattr(ngram_join, "_star_links", lambda *a: made.append(real(*a)) or made[-1])
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    spots = [(rng.randrange(120), f"e{k}") for k in range(30)]
    counts = []
    for n in (100, 300):
        rows = []
        for k in range(n):
            words = list(base)
            for at, word in rng.sample(spots, rng.randrange(1, 5)):
                words[at] = word
            words[rng.randrange(120)] = f"own{k}"
            rows.append((k, " ".join(words)))
        agree(spark, rows, 3, Fraction(9, 10))
        counts.append(made[-1].count() / n)
    assert max(counts) < 4, counts


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE  two"), (8, "one two three"),
        (9, "one\x0btwo\x1cthree"), (10, "É é"), (11, "é é"), (5, "one"), (None, "one two"), (None, "alone here now"),
        (12, "la " * 30_000), (13, "la la la la"), (14, "x" * 100_000),
    ]
    agree(spark, rows, 3, Fraction(9, 10), **CLASHES)
    docs = documents(spark, [], [])
    assert ngram_join.components(docs, 3).count() == 0


def test_first_of_each(spark):
    near = " ".join(f"w{i}" for i in range(100))
    rows = [(5, near), (3, near + " x"), (9, near), (9, near), (7, "other text here"), (7, "other text here"), (None, near), (8, "")]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], **CLASHES)
    kept = ngram_join.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 7, 8]


def test_hashes():
    texts = ["a b c", "A  B\tc", "a b", "b a", "", None, "a b c a b c a b c", "ab c", "a bc", "a" * 300, "a" * 301]
    sets = shingles.shingle_sets(pa.array(texts), 3)
    sizes = [len(brute.shingles(t, 3)) for t in texts]
    assert np.diff(sets.ends).tolist() == sizes
    digests = shingles.set_digests(sets)
    assert digests[0] == digests[1] and digests[4] == digests[5] == 0
    rest = [d for i, d in enumerate(digests.tolist()) if i not in (1, 5)]
    assert len(set(rest)) == len(rest)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(d.doc_id, d.text) for d in table(spark, folder, "documents").collect()]
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in QUERIES["op10_ngram_jaccard"](spark, folder).collect()]
    assert sorted(found) == sorted(brute.components(rows, 3, Fraction(9, 10)))


def test_long_lists_of_the_same_sets(spark, monkeypatch):
    """Edits of many tokens give many lists of the same sets, which are compared once: families off the hub, against brute force."""
    words = [f"w{i}" for i in range(400)]
    texts = []
    for family in range(3):
        base = list(words)
        base[100 * family : 100 * family + 25] = [f"f{family}x{i}" for i in range(25)]
        for copy in range(20):
            own = list(base)
            own[390 - copy] = f"c{family}y{copy}"
            texts.append(" ".join(own))
    tiles, rows = ngram_join._tile_links, []
    monkeypatch.setattr(ngram_join, "_tile_links", lambda p, *rest: rows.append(p.filter("length > 16").count()) or tiles(p, *rest))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.components(docs, 3, Fraction(9, 10)).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))
    for _ in range(3):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if 10 * len(a & b) >= 9 * len(a | b):
                    label[i] = min(label[i], label[j])
    assert rows[0] > 0 and found == dict(enumerate(label)) and len(set(label)) == 3
