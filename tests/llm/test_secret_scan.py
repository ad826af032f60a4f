import random
import re

import pytest
from pyspark.sql import functions as F

from frames import CLASHES, documents
from mergelane.llm import secret_scan as ss
from mergelane.llm.queries import QUERIES, table


def plain_findings(text):
    """The rules of `findings` but for plain words, with Python's patterns."""
    out = []
    words = re.split(r"[ \t\n\x0b\f\r]+", text)
    for i, word in enumerate(words):
        found = re.search(ss._VALUE, word)
        value = found[1] if found else ""
        before = " ".join([words[i - 2] if i >= 2 else "", words[i - 1] if i >= 1 else ""])
        if re.search(ss._FORMATS, value):
            out.append((i, "format", value))
        elif value and re.search(ss._KEYED, f"{before} {word}"):
            out.append((i, "keyed", value))
        elif len(value) >= 12 and re.search("[0-9]", value):
            out.append((i, "mixed", value))
    return out


KEY = "AKIA" + "Q7ZX" * 4
TEXTS = [
    f"use {KEY} now", 'token = "0123456789abcdef0123456789abcdef01234567" and more', "password=0123456789abcdef01 end",
    "my password: swordfishes, see", "plain words only, extraordinarily long but harmless", "call 555-2752 or 12345678901234 today",
    f"({KEY}),", "api_key: 'abcdEFGH1234567890'\nsecret=>zzzzzzzzzzzz", "", None, "eyJhbGciOiJI.eyJzdWIiOiIx.c2ln x", "é" * 50 + " x=1",
    "a" * 50_000 + " password=" + "9f" * 20,
]


def test_candidates(spark):
    docs = documents(spark, TEXTS, **CLASHES)
    found = ss.findings(docs).filter("rule <> 'plain'").collect()
    expected = [(i, *f) for i, t in enumerate(TEXTS) if t for f in plain_findings(t)]
    assert sorted((r.doc_id, r.at, r.rule, r.value) for r in found) == sorted(expected)
    assert {r.doc_id for r in found} >= {0, 1, 2, 3, 5, 6, 7, 12}


def test_features(spark):
    docs = documents(spark, ["the token sesame1234 opens"] * 1 + ["sesame opens doors"] * 3, source2="x")
    words = ss.dictionary(docs, least=3)
    assert {r.word for r in words.collect()} == {"sesame", "opens", "doors"}
    found = docs.limit(1).select("doc_id", F.lit("a/tests/x.py").alias("path"), F.lit(2).alias("at"), F.lit("mixed").alias("rule"),
                                 F.lit("Sesame12aB==").alias("value"), F.lit('"Sesame12aB=="').alias("word"), F.lit("the token").alias("before"),
                                 F.lit("opens").alias("after"))
    row = ss.featured(found, words).first()
    assert row.dictionary == 6 / 12 and row.digits == 2 / 12 and row.upper == 2 / 12 and row.symbols == 2 / 12
    assert row.letter_digit == 1 / 11 and row.digit_letter == 1 / 11 and row.lower_upper == 1 / 11
    assert (row.path_depth, row.path_test, row.keyword_near, row.quoted, row.prose_after) == (2, 1, 1, 1, 1)


def labelled(spark, n, seed):
    """Findings with known truth: random keys, and assigned words, versions or samples."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        secret = i % 2
        if secret:
            value = "".join(rng.choice("0123456789abcdefABCDEF") for _ in range(rng.randrange(16, 40)))
            rows.append((i, "conf/app.yml", 5, "keyed", value, f'"{value}"', "password =", "", 1.0))
        else:
            value = rng.choice(["sesameopens", "doorsopens12", "example-key-1234", "release-2024-01-05", "swordfishes"])
            rows.append((i, rng.choice(["docs/a.md", "test/b.py"]), 5, "keyed", value, value, "the example token:", "opens", 0.0))
    schema = "doc_id long, path string, at long, rule string, value string, word string, before string, after string, label double"
    return spark.createDataFrame(rows, schema)


def test_forest_on_held_out_findings(spark):
    words = spark.createDataFrame([("sesame",), ("opens",), ("doors",), ("example",), ("release",)], "word string")
    forest = ss.train(ss.featured(labelled(spark, 200, 1), words))
    rows = ss.judged(ss.featured(labelled(spark, 120, 2), words), forest).collect()
    assert len(rows) == 120 and sum(r.secret == (r.label == 1) for r in rows) >= 118


def test_scan_and_redact(spark):
    texts = [t for t in TEXTS if t is not None] * 3 + ["the extraordinarily long but harmless words of prose 12345678 " * 30] * 5
    docs = documents(spark, texts, **CLASHES)
    found = ss.scan(docs)
    secrets = {(r.doc_id, r.value) for r in found.filter("secret").collect()}
    assert {v for _, v in secrets} >= {KEY, "0123456789abcdef0123456789abcdef01234567", "0123456789abcdef01"}
    clean = ss.redact(docs, found.filter("secret").select("doc_id", "value"))
    assert clean.columns == docs.columns
    after = {r.doc_id: r.text for r in clean.collect()}
    for i, text in enumerate(texts):
        own = [v for d, v in secrets if d == i]
        assert not any(v in after[i] for v in own)
        if not own:
            assert after[i] == text


@pytest.mark.parametrize("texts", [[], [None, ""], ["no candidate here"], [f"only {KEY}"]])
def test_few(spark, texts):
    docs = documents(spark, texts)
    found = ss.scan(docs).collect()
    assert [r.value for r in found if r.secret] == [KEY] * sum(KEY in (t or "") for t in texts)
    assert ss.redact(docs, ss.scan(docs).filter("secret").select("doc_id", "value")).count() == len(texts)


def test_null_and_repeated_ids(spark):
    docs = documents(spark, [f"x {KEY}", f"y {KEY}", f"z {KEY}", "clean"], [None, 7, 7, None])
    secrets = ss.scan(docs).filter("secret").select("doc_id", "value")
    assert sorted(r.text for r in ss.redact(docs, secrets).collect()) == ["clean", "x [SECRET]", "y [SECRET]", "z [SECRET]"]


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_secret_scan"](spark, folder).collect()
    docs = {d.doc_id: d.text for d in table(spark, folder, "documents").collect()}
    planted = re.compile(r"AKIA[A-Z0-9]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}\"")
    with_secret = {i for i, t in docs.items() if planted.search(t)}
    assert {r.doc_id for r in found if r.secret} == with_secret and with_secret
    expected = {(i, *f[:2]) for i, t in docs.items() for f in plain_findings(t)}
    assert {(r.doc_id, r.at, r.rule) for r in found} == expected


def test_plan_is_native(spark):
    found = QUERIES["op1_secret_scan"](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


GITHUB = "ghp_" + "x7Ab2" * 6
# Words with several runs, and the values (with their rules) that must be found in them; written by hand.
MANY = [
    (f'{{"aws_key":"{KEY}","n":5}}', {("format", KEY)}),
    (f"x?key={KEY}&region=us-east-1", {("format", KEY)}),
    (f"https://u:{GITHUB}@github.com/org/repo", {("format", GITHUB)}),
    ("1a2b3c4d5e6f,7,9f8e7d6c5b4a,end", {("mixed", "1a2b3c4d5e6f"), ("mixed", "9f8e7d6c5b4a")}),
    ('{"db_password":"Ab12Cd34Ef56","a":1,"auth_token":"zz99yy88xx77","ok":true}', {("keyed", "Ab12Cd34Ef56"), ("keyed", "zz99yy88xx77")}),
    ('secret = "q1w2e3r4t5y6";f(0)', {("keyed", "q1w2e3r4t5y6")}),
    ("".join(f'a{i}="{i:012x}";' for i in range(3000)), {("mixed", f"{i:012x}") for i in range(3000)}),
]


def test_all_runs_of_a_word(spark):
    docs = documents(spark, [t for t, _ in MANY], **CLASHES)
    found = ss.findings(docs).filter("rule <> 'plain'")
    rows = found.collect()
    for i, (_, expected) in enumerate(MANY):
        assert {(r.rule, r.value) for r in rows if r.doc_id == i} == expected
    assert len({(r.doc_id, r.at, r.part) for r in rows}) == len(rows) == sum(len(e) for _, e in MANY)
    after = {r.doc_id: r.text for r in ss.redact(docs, found.select("doc_id", "value")).collect()}
    assert after[0] == '{"aws_key":"[SECRET]","n":5}' and after[2] == "https://u:[SECRET]@github.com/org/repo"


JWT = "eyJhbGciOiJI.eyJzdWIiOiIx.c2ln"
# Values with characters of their own, or short ones; written by hand.
OWN = [
    (f"{JWT} x", {("format", JWT)}), (f"Bearer {JWT}.", {("format", JWT)}), ("password=Tr0ub4dor&3 end", {("keyed", "Tr0ub4dor&3")}),
    ("a pwd: hunter2, yes, a hunter2x", {("keyed", "hunter2")}), ("password = 'p@ss,w=rd!' x", {("keyed", "p@ss,w=rd!")}),
    ("u?password=a$b!c&user=me", {("keyed", "a$b!c")}), ('{"secret":"x.","n":[5]}', {("keyed", "x.")}), ("{token:a}", {("keyed", "a")}),
    ("password =é9é z", {("keyed", "é9é")}), ("password=" + "a&" * 50_000 + "z", {("keyed", "a&" * 50_000 + "z")}),
    (r"secret=\Ea\Q$", {("keyed", r"\Ea\Q$")}), ("token: ,) secret", set()), ("sk-" + "abcde" * 5, {("format", "sk-" + "abcde" * 5)}),
]


def test_formats_and_assigned_values_are_whole(spark):
    docs = documents(spark, [t for t, _ in OWN], **CLASHES)
    found = ss.findings(docs).filter("rule IN ('format', 'keyed')")
    rows = found.collect()
    for i, (_, expected) in enumerate(OWN):
        assert {(r.rule, r.value) for r in rows if r.doc_id == i} == expected
    after = {r.doc_id: r.text for r in ss.redact(docs, found.select("doc_id", "value"), "[$1]").collect()}
    assert [after[i] for i in (0, 1, 2, 3)] == ["[$1] x", "Bearer [$1].", "password=[$1] end", "a pwd: [$1], yes, a hunter2x"]
    assert [after[i] for i in (4, 5, 7, 8)] == ["password = '[$1]' x", "u?password=[$1]&user=me", "{token:[$1]}", "password =[$1] z"]
    assert after[9] == "password=[$1]" and after[10] == "secret=[$1]"


def decoys_and_keys(rng, n):
    """n texts of each kind: what is no secret, and secrets; both as (text, value)."""
    draw = lambda alphabet, k: "".join(rng.choice(alphabet) for _ in range(k))
    hexes, base62 = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    words = "how to bake good bread at home with little flour and salt in one long day".split()
    harmless, secret = {}, {}
    for kind, make in {
        "commit": lambda: ("fixed in commit {} by us", draw(hexes, 40)),
        "uuid": lambda: ("the row {} was seen", "-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12))),
        "checksum": lambda: ("its sha256 checksum is {} as before", draw(hexes, 64)),
        "order": lambda: ("your order {} has left", f"{draw('0123456789', 4)}-{draw('0123456789', 8)}-{draw('0123456789', 2)}"),
        "slug": lambda: ("see /{} for more", "-".join([f"20{rng.randrange(10, 25)}", *rng.sample(words, 4), str(rng.randrange(99))])),
        "version": lambda: ("since version {} only", f"release-20{rng.randrange(10, 25)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)}"),
    }.items():
        harmless[kind] = [(t.format(v), v) for t, v in (make() for _ in range(n))]
    for kind, make in {
        "aws": lambda: ("we use {} there", "AKIA" + draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16)),
        "assigned": lambda: ("password={} in the file", draw(base62, 20) + "7"),
        "bare": lambda: ("then came {} and went", draw(base62, 38) + "4x"),
        "url": lambda: ("open https://me:{}@host.org/db now", draw(base62, 15) + "1"),
    }.items():
        secret[kind] = [(t.format(v), v) for t, v in (make() for _ in range(n))]
    return harmless, secret


def test_decoys_are_rejected_and_keys_are_not(spark):
    """Of what is no secret at most 5 % is judged one; of secrets at least 95 % are found."""
    harmless, secret = decoys_and_keys(random.Random(8), 60)
    texts = [(k, t, v) for kinds in (harmless, secret) for k, rows in kinds.items() for t, v in rows]
    prose = ["an extraordinarily long but harmless story of doors that somebody opens 12345678901 times a day"] * 40
    docs = documents(spark, [t for _, t, _ in texts] + prose)
    judged = {(r.doc_id, r.value) for r in ss.scan(docs).filter("secret").collect()}
    share = {}
    for i, (kind, _, value) in enumerate(texts):
        hit = any(d == i and (value in v or v in value) for d, v in judged)
        share.setdefault(kind, []).append(hit)
    share = {k: sum(v) / len(v) for k, v in share.items()}
    assert sum(share[k] for k in harmless) / len(harmless) <= 0.05, share
    assert sum(share[k] for k in secret) / len(secret) >= 0.95, share
