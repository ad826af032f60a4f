"""Record matching: exact and fuzzy rules, best target or all targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergelane.operators.candidates import close_pairs
from mergelane.operators.lookups import join_all, lookup
from mergelane.operators.ranking import top_n
from mergelane.session import discard, materialize, settle


@dataclass(frozen=True)
class Pair:
    """A source column compared with a target column; `weight` matters to fuzzy columns only."""

    source: str
    target: str
    ignore_case: bool = True
    trim: bool = True
    weight: float = 1.0

    def normal(self, name: str) -> Column:
        """The compared form of a column; null when it is blank, and blank never matches."""
        text = F.col(name).cast("string")
        text = F.trim(text) if self.trim else text
        text = F.lower(text) if self.ignore_case else text
        return F.when(F.trim(text) != "", text)


@dataclass(frozen=True)
class ExactRule:
    """Records match when all pairs are equal."""

    result: str
    pairs: Sequence[Pair]


@dataclass(frozen=True)
class FuzzyRule:
    """Records match when the `block` pairs are equal and the weighted similarity reaches `min_score`.

    A field's similarity is 1 - edit distance / longer length, and 0 when either side is blank.
    """

    result: str
    fuzzy: Sequence[Pair]
    block: Sequence[Pair]
    min_score: float
    score: str = "levenstein_score"
    details: str | None = None

    def __post_init__(self) -> None:
        if not self.block:
            raise ValueError(f"{self.result}: a fuzzy rule needs at least one exact column to block on")


Rule = ExactRule | FuzzyRule


def rule_from_dict(config: Mapping) -> Rule:
    """A rule from its dictionary form.

    ``match_type`` is "exact" or "levenstein"; ``columns`` lists source_column, target_column and
    optionally make_case_insensitive, trim_spaces_before_and_after, weight, match ("fuzzy" or
    "exact"). ``trim`` and ``case_insensitive`` of the rule are the defaults of its columns.
    """

    def pair(c: Mapping) -> Pair:
        return Pair(
            c["source_column"],
            c["target_column"],
            c.get("make_case_insensitive", config.get("case_insensitive", False)),
            c.get("trim_spaces_before_and_after", config.get("trim", False)),
            c.get("weight", 1.0),
        )

    kind, columns = config["match_type"], config["columns"]
    if kind == "exact":
        return ExactRule(config["result_column"], [pair(c) for c in columns])
    if kind != "levenstein":
        raise ValueError(f"unknown match_type {kind!r}")
    return FuzzyRule(
        config["result_column"],
        fuzzy=[pair(c) for c in columns if c.get("match") == "fuzzy"],
        block=[pair(c) for c in columns if c.get("match") != "fuzzy"],
        min_score=config["min_score"],
        score=config.get("score_column", "levenstein_score"),
        details=config.get("comparison_details_column"),
    )


@dataclass(frozen=True)
class Ids:
    """The id columns of both tables, and whether a pair of equal ids may match."""

    source: str
    target: str
    same_allowed: bool = False

    def differ(self, source: Column, target: Column) -> Column:
        if self.same_allowed:
            return F.lit(True)
        return source.cast("string") != target.cast("string")


def _two_smallest(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Per key the smallest id (``__t1``) and the second smallest (``__t2``, maybe null).

    Two are enough: a source can exclude only itself. Ranks are pruned before the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(id_col)
    ranked = df.withColumn("__rank", F.dense_rank().over(window)).filter("__rank <= 2")
    at = lambda n: F.min(F.when(F.col("__rank") == n, F.col(id_col)))
    return ranked.groupBy(*keys).agg(at(1).alias("__t1"), at(2).alias("__t2"))


# --- exact -----------------------------------------------------------------------------------------


def _keyed(df: DataFrame, pairs: Sequence[Pair], side: str, prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}{i}": p.normal(getattr(p, side)) for i, p in enumerate(pairs)})


def exact_best(source: DataFrame, target: DataFrame, rule: ExactRule, ids: Ids) -> DataFrame:
    """`source` with the smallest matching target id in ``rule.result``.

    The targets shrink to two ids per key first, so the join never fans out, however many records
    share a key.
    """
    names = [f"__x{i}" for i in range(len(rule.pairs))]
    keys = _keyed(target, rule.pairs, "target", "__x").dropna(subset=names).select(
        *names, F.col(ids.target).alias("__id")
    )
    two = _two_smallest(keys, names, "__id")
    on = [(p.normal(p.source), n) for p, n in zip(rule.pairs, names)]
    out = lookup(source, two, on, ["__t1", "__t2"])
    other = lambda c: ids.differ(F.col(ids.source), F.col(c))
    pick = F.when(other("__t1"), F.col("__t1")).when(other("__t2"), F.col("__t2"))
    return out.withColumn(rule.result, pick).drop("__t1", "__t2")


def exact_pairs(source: DataFrame, target: DataFrame, rule: ExactRule, ids: Ids) -> DataFrame:
    """All matching (source_id, target_id) pairs.

    The result is as large as the key groups make it; AQE splits a hot key on both sides. Where only
    a link per record is needed, `exact_best` has it without any pairs.
    """
    names = [f"__x{i}" for i in range(len(rule.pairs))]
    a = _keyed(source, rule.pairs, "source", "__x").dropna(subset=names).select(
        *names, F.col(ids.source).alias("source_id")
    )
    b = _keyed(target, rule.pairs, "target", "__x").dropna(subset=names).select(
        *names, F.col(ids.target).alias("target_id")
    )
    return a.join(b, names).filter(ids.differ(F.col("source_id"), F.col("target_id"))).select("source_id", "target_id")


# --- fuzzy -----------------------------------------------------------------------------------------


def _similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    blank = (a == "") | (b == "")
    return F.when(blank, F.lit(0.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def _best_case(a: Column, b: Column) -> Column:
    """The similarity if the texts differ by no more than their lengths do; cheap to compute."""
    la, lb = F.length(a), F.length(b)
    return F.when((la == 0) | (lb == 0), F.lit(0.0)).otherwise(F.least(la, lb) / F.greatest(la, lb))


def _weighted(rule: FuzzyRule, compare, a: str = "a_", b: str = "b_") -> Column:
    parts = [
        F.lit(p.weight) * compare(F.col(f"{a}__f{i}"), F.col(f"{b}__f{i}")) for i, p in enumerate(rule.fuzzy)
    ]
    return reduce(lambda x, y: x + y, parts)


def _records(df: DataFrame, rule: FuzzyRule, side: str) -> DataFrame:
    """`df` with its block values ``__b*`` (blank ones go) and its compared texts ``__f*`` ('' if blank)."""
    keyed = _keyed(df, rule.block, side, "__b").dropna(subset=[f"__b{i}" for i in range(len(rule.block))])
    texts = {f"__f{i}": F.coalesce(p.normal(getattr(p, side)), F.lit("")) for i, p in enumerate(rule.fuzzy)}
    return keyed.withColumns(texts)


def _value_columns(rule: FuzzyRule) -> list[str]:
    return [f"__b{i}" for i in range(len(rule.block))] + [f"__f{i}" for i in range(len(rule.fuzzy))]


def _similar_values(a: DataFrame, b: DataFrame, rule: FuzzyRule, mirrored: bool) -> DataFrame:
    """Pairs of distinct value tuples that reach the score, with the score and the field similarities.

    With `mirrored`, `a` and `b` are the same table: each pair is compared once and then turned around.
    """
    values = _value_columns(rule)
    score = _weighted(rule, _similarity)
    # The cheap bound comes first and spares most of the edit distances.
    test = (_weighted(rule, _best_case) >= rule.min_score - 1e-9) & (score >= rule.min_score)
    texts = [v for v in values if v.startswith("__f")]
    if mirrored:
        left, right = (F.struct(*[F.col(s + t) for t in texts]) for s in ("a_", "b_"))
        test = (left <= right) & test
    block = [v for v in values if v.startswith("__b")]
    # If all fields are less similar than this, their weighted sum stays below the score.
    bound = rule.min_score / sum(p.weight for p in rule.fuzzy)
    pairs = close_pairs(a, b, block, test, texts, bound)
    similarities = F.array(*[_similarity(F.col("a_" + t), F.col("b_" + t)) for t in texts])
    pairs = pairs.withColumns({"__score": score, "__similarities": similarities})
    if not mirrored:
        return pairs
    sides = {s: [f"{s}_{c}" for c in a.columns] for s in "ab"}
    straight = F.struct(*[F.col(c) for c in sides["a"] + sides["b"]])
    turned = F.struct(
        *[F.col(y).alias(x) for x, y in zip(sides["a"] + sides["b"], sides["b"] + sides["a"])]
    )
    both = F.when(left == right, F.array(straight)).otherwise(F.array(straight, turned))
    return pairs.select(F.explode(both).alias("p"), "__score", "__similarities").select(
        "p.*", "__score", "__similarities"
    )


def _is_self_match(source: DataFrame, target: DataFrame, rule: FuzzyRule, ids: Ids) -> bool:
    same_columns = all(p.source == p.target for p in (*rule.fuzzy, *rule.block))
    return source is target and same_columns and ids.source == ids.target


def _details(rule: FuzzyRule, similarities: Column) -> Column:
    entries = [x for i, p in enumerate(rule.fuzzy) for x in (F.lit(p.source), F.round(similarities[i], 6))]
    return F.when(similarities.isNotNull(), F.to_json(F.create_map(*entries)))


def _fuzzy_columns(rule: FuzzyRule) -> list[str]:
    return [rule.result, rule.score, *([rule.details] if rule.details else [])]


def fuzzy_best(
    source: DataFrame, target: DataFrame, rule: FuzzyRule, ids: Ids, onto: DataFrame | None = None
) -> DataFrame:
    """`source` with the best target per record: highest score, then smallest id.

    Records with equal values are compared once, and their ids enter only as the two smallest.
    `onto` is `source` with further columns, if the result is to be added to those rows.
    """
    values = _value_columns(rule)

    def tuples(df: DataFrame, side: str, id_col: str) -> DataFrame:
        records = _records(df, rule, side).select(*values, F.col(id_col).alias("__id"))
        return materialize(_two_smallest(records, values, "__id"), "tuples")

    mirrored = _is_self_match(source, target, rule, ids)
    a = tuples(source, "source", ids.source)
    b = a if mirrored else tuples(target, "target", ids.target)
    pairs = _similar_values(a, b, rule, mirrored)

    # Two candidate ids per source tuple suffice, as a record can exclude only its own id. An id may stand on
    # several target tuples, so it first keeps its best one.
    key = [f"a_{v}" for v in values]
    options = pairs.withColumn("__id", F.explode(F.array_compact(F.array("b___t1", "b___t2"))))
    options = options.groupBy(*key, "__id").agg(F.max(F.struct("__score", "__similarities")).alias("__best"))
    options = top_n(options.select(*key, "__id", "__best.*"), key, [F.desc("__score"), F.asc("__id")], 2, "__rank")
    option = F.struct("__id", "__score", "__similarities")
    nth = lambda n: F.max(F.when(F.col("__rank") == n, option))
    best = materialize(options.groupBy(*key).agg(nth(1).alias("__o1"), nth(2).alias("__o2")), "best")

    on = [(p.normal(p.source), f"a___b{i}") for i, p in enumerate(rule.block)]
    on += [(F.coalesce(p.normal(p.source), F.lit("")), f"a___f{i}") for i, p in enumerate(rule.fuzzy)]
    out = lookup(source if onto is None else onto, best, on, ["__o1", "__o2"])
    other = lambda c: ids.differ(F.col(ids.source), F.col(f"{c}.__id"))
    pick = F.when(other("__o1"), F.col("__o1")).when(other("__o2"), F.col("__o2"))
    out = out.withColumn("__pick", pick).withColumns({
        rule.result: F.col("__pick.__id"),
        rule.score: F.col("__pick.__score"),
        **({rule.details: _details(rule, F.col("__pick.__similarities"))} if rule.details else {}),
    })
    return out.drop("__o1", "__o2", "__pick")


def fuzzy_pairs(source: DataFrame, target: DataFrame, rule: FuzzyRule, ids: Ids) -> DataFrame:
    """All (source_id, target_id) pairs that reach the score, with score and details."""
    values = _value_columns(rule)
    mirrored = _is_self_match(source, target, rule, ids)
    a_rows = _records(source, rule, "source").select(*values, F.col(ids.source).alias("source_id"))
    b_rows = a_rows.withColumnRenamed("source_id", "target_id") if mirrored else _records(
        target, rule, "target"
    ).select(*values, F.col(ids.target).alias("target_id"))
    a = materialize(a_rows.select(*values).distinct(), "tuples")
    b = a if mirrored else materialize(b_rows.select(*values).distinct(), "tuples")
    pairs = _similar_values(a, b, rule, mirrored)

    expanded = a_rows.toDF(*[f"a_{v}" for v in values], "source_id").join(pairs, [f"a_{v}" for v in values])
    expanded = expanded.join(b_rows.toDF(*[f"b_{v}" for v in values], "target_id"), [f"b_{v}" for v in values])
    out = expanded.filter(ids.differ(F.col("source_id"), F.col("target_id")))
    details = [_details(rule, F.col("__similarities")).alias(rule.details)] if rule.details else []
    return out.select("source_id", "target_id", F.col("__score").alias(rule.score), *details)


# --- rules together --------------------------------------------------------------------------------


def match_exact(source: DataFrame, target: DataFrame, rule: ExactRule, ids: Ids, handler: str = "best") -> DataFrame:
    """`source` plus the result column; ``handler="multiple"`` gives a row per matching target."""
    if handler == "best":
        return exact_best(source, target, rule, ids)
    return _attach(source, exact_pairs(source, target, rule, ids), ids, rule.result)


def match_fuzzy(source: DataFrame, target: DataFrame, rule: FuzzyRule, ids: Ids, handler: str = "best") -> DataFrame:
    """`source` plus result, score and details; ``handler="multiple"`` gives a row per matching target."""
    if handler == "best":
        return fuzzy_best(source, target, rule, ids)
    return _attach(source, fuzzy_pairs(source, target, rule, ids), ids, *_fuzzy_columns(rule))


def _attach(source: DataFrame, pairs: DataFrame, ids: Ids, result: str, *more: str) -> DataFrame:
    right = pairs.withColumnRenamed("target_id", result)
    return join_all(source, right, [(ids.source, "source_id")], [result, *more])


def apply_matching(
    source: DataFrame,
    target: DataFrame,
    rules: Sequence[Rule | Mapping],
    ids: Ids,
    handler: str = "best",
    staged: bool = False,
    onto: DataFrame | None = None,
) -> DataFrame:
    """All rows of `source` with a result column per rule, null where the rule finds nothing.

    Rules are evaluated independently. ``best`` keeps one row per source row. ``multiple`` keeps every
    target of every rule, so that a source with m and n targets under two rules gets m * n rows; where
    only the winning rule matters, `matched_pairs` has the same content in m + n rows.

    Each rule of ``best`` shuffles all rows; those of ``multiple`` are put together by source id, and the rows meet them once.
    `staged` writes what is found after each rule, or behind the last one of ``multiple``, so that the shuffle files and tables
    of a step go before the next one's come. `onto` is `source` with further columns or rows, if the results are to be added there.
    """
    if handler not in ("best", "multiple"):
        raise ValueError(f"handler is 'best' or 'multiple', not {handler!r}")
    rules = [_as_rule(rule) for rule in rules]
    if handler == "multiple":
        build = lambda: _combinations(source, target, rules, ids)
        found = settle(build, "combinations") if staged else build()
        return join_all(source if onto is None else onto, found, [(ids.source, "source_id")], [c for c in found.columns if c != "source_id"])
    out = source if onto is None else onto
    for rule in rules:
        if not staged:
            out = _with_best(out, source, target, rule, ids)
            continue
        before, out = out, settle(lambda: _with_best(out, source, target, rule, ids), "matched")
        if before is not source and before is not onto:
            discard(before)
    return out


def _with_best(out: DataFrame, source: DataFrame, target: DataFrame, rule: Rule, ids: Ids) -> DataFrame:
    if isinstance(rule, ExactRule):
        return exact_best(out, target, rule, ids)
    return fuzzy_best(source, target, rule, ids, onto=out)


def _combinations(source: DataFrame, target: DataFrame, rules: Sequence[Rule], ids: Ids) -> DataFrame:
    """source_id once for every combination of a match of each rule, with the rules' columns; null where a rule finds nothing."""
    found = source.select(F.col(ids.source).alias("source_id")).distinct()
    for rule in rules:
        if isinstance(rule, ExactRule):
            pairs, more = exact_pairs(source, target, rule, ids), []
        else:
            pairs, more = materialize(fuzzy_pairs(source, target, rule, ids), "pairs"), _fuzzy_columns(rule)[1:]
        found = _attach(found, pairs, replace(ids, source="source_id"), rule.result, *more)
    return found


def _as_rule(rule: Rule | Mapping) -> Rule:
    return rule_from_dict(rule) if isinstance(rule, Mapping) else rule


def matched_pairs(
    source: DataFrame, target: DataFrame, rules: Sequence[Rule | Mapping], ids: Ids
) -> DataFrame:
    """Long form of all matches: source_id, priority (from 0, in rule order), rule, target_id, score."""
    parts = []
    for i, rule in enumerate(map(_as_rule, rules)):
        if isinstance(rule, ExactRule):
            pairs = exact_pairs(source, target, rule, ids).withColumn("score", F.lit(None).cast("double"))
        else:
            pairs = fuzzy_pairs(source, target, rule, ids).withColumnRenamed(rule.score, "score")
        parts.append(_in_long_form(pairs, i, rule))
    return reduce(DataFrame.unionByName, parts)


def winning_pairs(source: DataFrame, steps: Sequence[tuple[Rule | Mapping, DataFrame, Ids]]) -> DataFrame:
    """source_id, priority (from 0, in the order of `steps`), rule, target_id, score: the targets of each source id's first rule
    that finds any.

    A step is a rule with its target table and ids. Exact rules first tell by two ids a key which rule a record wins, and
    only that rule's pairs are formed; a fuzzy rule is given the records that no rule before it matches. So pairs of later
    rules cost nothing, however many records share their keys. Rows that repeat an id are one record, whose first rule
    counts. Targets with a null id, and sources with one, match nothing. Jobs run while it is planned.
    """
    # What the rules look at, so that the other columns are not shuffled with them.
    columns = dict.fromkeys(c for rule, _, ids in steps for c in (ids.source, *[p.source for p in _pairs_of(_as_rule(rule))]))
    parts, open_ = [], source.filter(F.col(steps[0][2].source).isNotNull()).select(*columns)
    numbered = [(i, _as_rule(rule), target.filter(F.col(ids.target).isNotNull()), ids) for i, (rule, target, ids) in enumerate(steps)]
    for exact, group in groupby(numbered, key=lambda step: isinstance(step[1], ExactRule)):
        if exact:
            group = list(group)
            found = open_
            for i, rule, target, ids in group:
                found = exact_best(found, target, replace(rule, result=f"__won{i}"), ids)
            first = F.coalesce(*[F.when(F.col(f"__won{i}").isNotNull(), F.lit(i)) for i, *_ in group])
            found = materialize(found.select(*open_.columns, first.alias("__won")), "winners")
            for i, rule, target, ids in group:
                pairs = exact_pairs(found.filter(F.col("__won") == i), target, rule, ids)
                parts.append(_in_long_form(pairs.withColumn("score", F.lit(None).cast("double")), i, rule))
            open_ = found.filter("__won IS NULL").drop("__won")
        else:
            for i, rule, target, ids in group:
                pairs = fuzzy_pairs(open_, target, rule, ids).withColumnRenamed(rule.score, "score")
                parts.append(materialize(_in_long_form(pairs, i, rule), "fuzzy"))
                matched = parts[-1].select(F.col("source_id").alias("__matched")).distinct()
                open_ = open_.join(matched, F.col(ids.source) == F.col("__matched"), "left_anti")
    every = reduce(DataFrame.unionByName, parts)
    # Two rows of one id may have won by different rules.
    first = every.groupBy("source_id").agg(F.min("priority").alias("__first"))
    return lookup(every, first, ["source_id"], ["__first"]).filter(F.col("priority") == F.col("__first")).drop("__first")


def _pairs_of(rule: Rule) -> Sequence[Pair]:
    return rule.pairs if isinstance(rule, ExactRule) else (*rule.fuzzy, *rule.block)


def _in_long_form(pairs: DataFrame, priority: int, rule: Rule) -> DataFrame:
    return pairs.select(
        "source_id", F.lit(priority).alias("priority"), F.lit(rule.result).alias("rule"),
        F.col("target_id").cast("string").alias("target_id"), "score",
    )
