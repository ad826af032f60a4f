import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mergelane.operators import candidates, clusters, matching
from mergelane.operators.matching import ExactRule, FuzzyRule, Ids, Pair


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def edit_distance(a, b):
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def similarity(a, b):
    return 1 - edit_distance(a, b) / max(len(a), len(b)) if a and b else 0.0


SELF = Ids("id", "id")
NAME = ExactRule("by_name", [Pair("name", "name")])
FUZZY = FuzzyRule(
    "near", fuzzy=[Pair("name", "name", weight=0.5), Pair("street", "street", weight=0.5)], block=[Pair("zip", "zip")],
    min_score=0.75, score="score", details="details",
)


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "Ann", "Main st 1", "10"), (2, " ann ", "Main st 1", "10"), (3, "Anne", "Main st 2", "10"),
         (4, "Bob", "Main st 1", "10"), (5, "ANN", "Elsewhere 9", "20"), (6, "", "Main st 1", "10"),
         (7, None, None, "10"), (8, "Ann", "Main st 1", None), (9, "Zoë", "x", "30")],
        "id int, name string, street string, zip string",
    )


def test_exact_best_and_multiple(people):
    best = {r.id: r.by_name for r in matching.match_exact(people, people, NAME, SELF).collect()}
    assert best == {1: 2, 2: 1, 3: None, 4: None, 5: 1, 6: None, 7: None, 8: 1, 9: None}
    every = matching.match_exact(people, people, NAME, SELF, "multiple").filter("by_name IS NOT NULL")
    same = (1, 2, 5, 8)
    assert {(r.id, r.by_name) for r in every.collect()} == {(a, b) for a in same for b in same if a != b}
    strict = ExactRule("by_name", [Pair("name", "name", ignore_case=False, trim=False)])
    assert {r.id: r.by_name for r in matching.match_exact(people, people, strict, SELF).collect()}[8] == 1
    assert {r.id: r.by_name for r in matching.match_exact(people, people, strict, SELF).collect()}[2] is None
    own = matching.match_exact(people, people, NAME, Ids("id", "id", same_allowed=True))
    assert {r.id: r.by_name for r in own.collect()}[1] == 1


def test_exact_excludes_equal_ids_across_tables(spark, people):
    other = spark.createDataFrame([("1", "ann"), ("77", "ANN"), ("77", "ann"), ("9", None)], "key string, label string")
    rule = ExactRule("hit", [Pair("name", "label")])
    found = {r.id: r.hit for r in matching.match_exact(people, other, rule, Ids("id", "key")).collect()}
    assert found[1] == "77" and found[2] == "1" and found[9] is None


def brute_force(records, rule):
    """All pairs (a, b, score) of a list of (id, name, street, zip)."""
    norm = lambda v: (v or "").strip().lower()
    out = []
    for a in records:
        for b in records:
            if a[0] == b[0] or not norm(a[3]) or norm(a[3]) != norm(b[3]):
                continue
            score = sum(p.weight * similarity(norm(x), norm(y)) for p, x, y in zip(rule.fuzzy, a[1:3], b[1:3]))
            if score >= rule.min_score:
                out.append((a[0], b[0], score))
    return out


def best_of(pairs):
    best = {}
    for a, b, score in pairs:
        if a not in best or (-score, b) < (-best[a][1], best[a][0]):
            best[a] = (b, score)
    return best


def check_fuzzy(df, records, rule, pairs_only=False):
    expected = brute_force(records, rule)
    assert rows(matching.fuzzy_pairs(df, df, rule, SELF).select("source_id", "target_id", "score")) == sorted(expected, key=str)
    if pairs_only:
        return
    best = {r.id: (r.near, r.score) for r in matching.match_fuzzy(df, df, rule, SELF).collect() if r.near is not None}
    assert best == best_of(expected)
    # The same as two tables: nothing is mirrored then.
    other = df.select("*")
    assert rows(matching.fuzzy_pairs(df, other, rule, SELF).select("source_id", "target_id", "score")) == sorted(expected, key=str)


def test_fuzzy(people):
    check_fuzzy(people, [tuple(r) for r in people.collect()], FUZZY)
    found = {r.id: r.details for r in matching.match_fuzzy(people, people, FUZZY, SELF).collect()}
    assert json.loads(found[1]) == {"name": 1.0, "street": 1.0} and found[9] is None


def random_records(seed, n, blocks):
    rng = random.Random(seed)
    names = ["bakkerij jan", "bakkery jan", "bar", "baar", "b", "snackbar de hoek", "snackbar hoek", "", None, "frituur"]
    streets = ["kerkstraat 1", "kerkstraat 12", "kerkstr 1", "dorp 5", "dorpsplein 5", "x", "yx", None, "lange weg 100"]

    def typo(s):
        if not s or rng.random() < 0.5:
            return s
        i = rng.randrange(len(s))
        return s[:i] + rng.choice(["", "q", s[i] * 2]) + s[i + 1 :]

    return [(i, typo(rng.choice(names)), typo(rng.choice(streets)), rng.choice(blocks)) for i in range(n)]


@pytest.mark.parametrize("weights,min_score", [((0.5, 0.5), 0.75), ((0.7, 0.3), 0.6)])
def test_fuzzy_splits_large_blocks_without_loss(spark, monkeypatch, weights, min_score):
    """With tiny strips every block is split; the pairs stay the same."""
    monkeypatch.setattr(candidates, "TILE", 4)
    rule = FuzzyRule("near", [Pair("name", "name", weight=weights[0]), Pair("street", "street", weight=weights[1])],
                     [Pair("zip", "zip")], min_score, score="score")
    records = random_records(7, 150, ["1", "1", "1", "2", "3 ", " 3", None])
    df = spark.createDataFrame(records, "id int, name string, street string, zip string")
    check_fuzzy(df, records, rule, pairs_only=min_score < 0.7)


def test_rows_of_a_large_block(spark):
    """Copies a row grow with the other side of its block alone, and every pair meets once."""
    a = spark.range(5_000).select(F.lit(1).alias("zip"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    b = a.limit(2_100)
    strips = spark.createDataFrame([(1, 3, 2)], "zip int, rows long, cols long")
    assert candidates.dealt(a, strips, ["zip"], "rows", "cols").count() == 2 * 5_000
    pairs = candidates.similar_pairs(a, b, ["zip"], F.col("a_text") == F.col("b_text"))
    assert pairs.columns == ["a_zip", "a_text", "b_zip", "b_text"] and pairs.count() == 2_100
    assert candidates.similar_pairs(a, b, ["zip"], F.lit(True)).count() == 5_000 * 2_100


def test_fuzzy_plan_has_no_cross_join(spark):
    part = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    rule = FuzzyRule("near", [Pair("p_name", "p_name"), Pair("p_type", "p_type")], [Pair("p_brand", "p_brand")], 1.5)
    plan = matching.fuzzy_pairs(part, part, rule, Ids("p_partkey", "p_partkey"))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    with pytest.raises(ValueError, match="block"):
        FuzzyRule("near", [Pair("p_name", "p_name")], [], 0.7)


def test_apply_matching_wide_and_long(people):
    config = {
        "match_type": "levenstein", "result_column": "near", "score_column": "score", "min_score": 0.75, "trim": True,
        "case_insensitive": True,
        "columns": [
            {"source_column": "name", "target_column": "name", "weight": 0.5, "match": "fuzzy"},
            {"source_column": "street", "target_column": "street", "weight": 0.5, "match": "fuzzy"},
            {"source_column": "zip", "target_column": "zip", "match": "exact"},
        ],
    }
    wide = matching.apply_matching(people, people, [NAME, config], SELF)
    assert wide.columns == [*people.columns, "by_name", "near", "score"]
    found = {r.id: (r.by_name, r.near) for r in wide.collect()}
    assert found == {1: (2, 2), 2: (1, 1), 3: (None, 1), 4: (None, None), 5: (1, None), 6: (None, None), 7: (None, None),
                     8: (1, None), 9: (None, None)}
    many = matching.apply_matching(people, people, [NAME, config], SELF, "multiple")
    assert many.filter("id = 1").count() == 3 * 2 and many.filter("id = 9").count() == 1
    pairs = matching.matched_pairs(people, people, [NAME, config], SELF)
    assert rows(pairs.filter("source_id = 1").select("priority", "rule", "target_id")) == [
        (0, "by_name", "2"), (0, "by_name", "5"), (0, "by_name", "8"), (1, "near", "2"), (1, "near", "3"),
    ]
    with pytest.raises(ValueError):
        matching.apply_matching(people, people, [NAME], SELF, "first")


def test_best_target_of_repeated_ids(spark):
    """An id on several rows is one candidate, and no record matches itself."""
    source = spark.createDataFrame([("A", "ann", "z")], "id string, name string, zip string")
    target = spark.createDataFrame([("A", "ann", "z"), ("A", "anm", "z"), ("B", "anp", "z")], "id string, name string, zip string")
    rule = FuzzyRule("near", [Pair("name", "name")], [Pair("zip", "zip")], 0.5)
    found = matching.fuzzy_best(source, target, rule, Ids("id", "id")).first()
    assert (found.near, round(found.levenstein_score, 2)) == ("B", 0.67)
    pairs = matching.fuzzy_pairs(source, target, rule, Ids("id", "id")).collect()
    assert [p.target_id for p in pairs] == ["B"]


# --- clusters --------------------------------------------------------------------------------------


def components(edges):
    label = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_chains_longer_than_six(spark):
    n = 200
    df = spark.createDataFrame([(i, i + 1 if i < n else None, str(i)) for i in range(1, n + 1)], "id int, next int, t string")
    out = clusters.unify_ids(df, ["next"], "id", "label")
    assert {r.label for r in out.collect()} == {1} and out.columns == ["id", "next", "t", "label"]
    with pytest.raises(RuntimeError, match="not complete after 1 rounds"):
        clusters.unify_ids(df, ["next"], "id", "label", max_iterations=1)


@given(links=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40), seed=st.integers(0, 9))
@settings(max_examples=4, deadline=None)
def test_unify_ids_equals_brute_force(spark, links, seed):
    records = [(i, None, None) for i in range(31)]
    for k, (a, b) in enumerate(links):
        one, two = records[a][1:]
        records.append((a, b, None) if k % 2 else (a, None, str(b)))
    random.Random(seed).shuffle(records)
    df = spark.createDataFrame(records, "id int, m1 int, m2 string")
    label = components([e for e in links if e[0] != e[1]])
    out = clusters.unify_ids(df, ["m1", "m2"], "id", "label").collect()
    assert len(out) == len(records)
    assert all(r.label == label.get(r.id, r.id) for r in out)


def test_cluster_values(spark):
    df = spark.createDataFrame(
        [("a", 3), ("a", None), ("a", 1), ("a", 3), ("b", None), ("c", 5), (None, 8), (None, None)], "c string, d int"
    )
    expected = [("a", 3, 1, 2), ("a", None, 1, 2), ("a", 1, 1, 2), ("a", 3, 1, 2), ("b", None, None, 0), ("c", 5, 5, 1),
                (None, 8, 8, None), (None, None, 8, None)]

    def result():
        filled = clusters.fill_in_cluster(df, "c", "d", "f")
        return rows(clusters.cluster_occurrence(filled, "c", "f", "d", "n"))

    assert result() == sorted(expected, key=str)


def test_rounds_leave_one_table(spark):
    """The folder holds rows of the last round only."""
    import glob

    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{folder}/edges-*"))
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)], "src int, dst int")
    labels = clusters.connected_components(edges).collect()
    full = [p for p in set(glob.glob(f"{folder}/edges-*")) - before if spark.read.parquet(p).count()]
    assert {r.label for r in labels} == {0} and len(labels) == 60 and len(full) == 1


def test_winning_pairs(spark):
    """The pairs of each record's first rule, as by forming all pairs of all rules; a hot key, repeated and null ids included."""
    rng = random.Random(3)
    pick = lambda *values: rng.choice([*values, None])
    people = [(rng.choice([*range(40), None]), pick("ann", "bob", "eve"), pick("long lane", "long lone", "oak"), pick("1", "2")) for _ in range(80)]
    people += [(100 + i, "hot", "x", "3") for i in range(30)]
    columns = "id long, name string, street string, zip string"
    left, right = spark.createDataFrame(people, columns), spark.createDataFrame(people[::2], columns)
    exact = [ExactRule("both", [Pair("name", "name"), Pair("zip", "zip")]), ExactRule("street", [Pair("street", "street")])]
    near = FuzzyRule("near", [Pair("street", "street")], [Pair("zip", "zip")], 0.5, score="score")
    for rules in ([*exact, near, NAME], [near, *exact]):
        every = matching.matched_pairs(left, right, rules, SELF).filter("source_id IS NOT NULL AND target_id IS NOT NULL")
        first = every.groupBy("source_id").agg(F.min("priority").alias("priority"))
        expected = rows(every.join(first, ["source_id", "priority"]).select("source_id", "rule", "target_id", "score").distinct())
        found = matching.winning_pairs(left, [(rule, right, SELF) for rule in rules])
        assert rows(found.select("source_id", "rule", "target_id", "score").distinct()) == expected
    assert matching.winning_pairs(left.limit(0), [(NAME, right, SELF)]).count() == 0
