import re

from hypothesis import given, settings
from hypothesis import strategies as st

from frames import CLASHES, documents
from mergelane.llm import license_scan
from mergelane.llm.queries import QUERIES, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for label, phrase in license_scan.PHRASES:
        own = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    return len(words), sorted(places)


def test_places_on_any_text(spark):
    automaton = license_scan.Automaton(license_scan.PHRASES, license_scan.TEMPLATES)
    pieces = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "licensed", "under", "the", "gnu", "X", "é", "nc"]

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.sampled_from(pieces), max_size=40))
    def check(words):
        import numpy as np

        own = license_scan.words(" ".join(words).encode())
        ids = np.array([automaton.vocabulary.get(w, -1) for w in own], dtype=np.int32)
        found, _ = automaton.scan(ids, license_scan.Limits())
        assert sorted((at, automaton.labels[p]) for p, at in found) == brute(" ".join(words))[1]

    check()


def test_matching_statistics():
    """The longest run of a template that ends at each word, against all runs of all templates."""
    import numpy as np

    templates = [("a", "x y z x y w"), ("b", "y z y z q")]
    automaton = license_scan.Automaton([], templates)
    runs = {tuple(t.split()[i:j]) for _, t in templates for i in range(7) for j in range(i + 1, 8)}
    for text in ("x y z y z q x y w", "z x y z x y w q", "q q y z y z q y z", "w x y z x y z"):
        words = text.split()
        state, length = 0, 0
        for i, w in enumerate(words):
            word = automaton.vocabulary[w.encode()]
            while state and word not in automaton.next[state]:
                state = automaton.link[state]
                length = automaton.length[state]
            if word in automaton.next[state]:
                state, length = automaton.next[state][word], length + 1
            assert length == max(n for n in range(i + 2) if n == 0 or tuple(words[i + 1 - n : i + 1]) in runs)


def test_spans(spark):
    mit = dict((k, v) for k, v in license_scan.TEMPLATES if k == "mit")["mit"]
    words = mit.split()
    changed = " ".join(words[:40] + ["really"] + words[41:])
    texts = [
        "Intro. " + mit.upper() + " outro", changed, " ".join(words[:20]), "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0. And all RIGHTS reserved", "nothing here", "by by cc cc by",
    ]
    found = {r.doc_id: r for r in license_scan.scan_licenses(documents(spark, texts)).collect()}
    assert [s.label for s in found[0].spans] == ["mit"] and found[0].spans[0].first_word == 1
    assert found[0].spans[0].cover == 1.0
    assert [s.label for s in found[1].spans] == ["mit"] and 0.9 < found[1].spans[0].cover < 1
    assert found[2].spans == []
    assert {s.label for s in found[3].spans} == {"mit"}
    assert {s.label for s in found[4].spans} == {"apache-2.0"} and [p.label for p in found[4].places] == ["reserved"]
    assert found[5].spans == [] and found[5].places == []
    assert [(p.first_word, p.last_word) for p in found[6].places] == [(3, 4)]


def test_rows(spark):
    texts = [None, "", "cc by", "cc by", "all rights reserved " * 5000]
    docs = documents(spark, texts, [None, 1, 2, 2, 4], **CLASHES)
    rows = sorted((r.doc_id or -1, r.n_words, len(r.places)) for r in license_scan.scan_licenses(docs).collect())
    assert rows == [(-1, 0, 0), (1, 0, 0), (2, 2, 1), (2, 2, 1), (4, 15000, 5000)]
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op2_license_scan"](spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert len(found) == len(docs)
    for d in docs:
        n, places = brute(d.text)
        r = found[d.doc_id]
        starts = [i for i, _ in places]
        assert (r.n_words, r.n_base) == (n, len(places))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
        assert ("Released under the MIT License." in d.text) <= ("mit" in r.labels.split(","))
