"""Matching, clusters, cache, upsert, and the customer identity flow."""

from __future__ import annotations

import hashlib
import uuid
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergelane.checks.registry import Tables, query
from mergelane.operators import (
    candidates, clusters, enrichment, kept_clusters, key_registry, lookups, matching, ranking, requests, upsert,
)
from mergelane.operators.matching import ExactRule, FuzzyRule, Ids, Pair
from mergelane.plans import customers as identity
from mergelane.plans import views
from mergelane.session import materialize, shared_folder
from mergelane.sources import buckets

# --- exact -----------------------------------------------------------------------------------------

_NATION = ExactRule(
    "same_nation_and_band",
    [Pair("nation", "nation"), Pair("band", "band", ignore_case=False, trim=False)],
)


def _buyers(t: Tables, width: int) -> DataFrame:
    nation = F.concat(F.lit(" Nation "), F.col("c_nationkey").cast("string"))
    band = F.floor(F.col("c_acctbal") / width).cast("string")
    return t.customer.select(
        "c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", nation).otherwise(" ").alias("nation"), band.alias("band")
    )


def _sellers(t: Tables, width: int) -> DataFrame:
    nation = F.concat(F.lit("NATION "), F.col("s_nationkey").cast("string"), F.lit(" "))
    return t.supplier.select("s_suppkey", nation.alias("nation"), F.floor(F.col("s_acctbal") / width).cast("string").alias("band"))


_ACROSS = Ids("c_custkey", "s_suppkey")


@query("""
SELECT c_custkey, min(s_suppkey) AS same_nation_and_band
FROM customer LEFT JOIN supplier ON c_mktsegment <> 'MACHINERY' AND c_nationkey = s_nationkey
     AND floor(c_acctbal / 1000) = floor(s_acctbal / 1000) AND c_custkey <> s_suppkey
GROUP BY c_custkey
""")
def match_exact(t: Tables) -> DataFrame:
    found = matching.match_exact(_buyers(t, 1000), _sellers(t, 1000), _NATION, _ACROSS)
    return found.select("c_custkey", "same_nation_and_band")


@query("""
SELECT c_custkey, o_orderkey AS placed FROM customer LEFT JOIN orders
ON c_custkey = o_custkey AND c_mktsegment <> 'MACHINERY' AND c_custkey <> o_orderkey
""")
def match_exact_all(t: Tables) -> DataFrame:
    """All orders that carry a customer's number."""
    number = F.concat(F.lit(" NR "), F.col("c_custkey").cast("string"))
    buyers = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", number).alias("number"))
    placed = t.orders.select("o_orderkey", F.concat(F.lit("nr "), "o_custkey", F.lit(" ")).alias("number"))
    rule = ExactRule("placed", [Pair("number", "number")])
    found = matching.match_exact(buyers, placed, rule, Ids("c_custkey", "o_orderkey"), handler="multiple")
    return found.select("c_custkey", "placed")


# --- fuzzy -----------------------------------------------------------------------------------------


@query("""
WITH source AS (SELECT p_partkey // 3 AS id, p_name, p_brand FROM part WHERE p_partkey % 3 = 0),
scored AS (
  SELECT s.id, t.p_partkey // 3 AS m,
    1 - levenshtein(lower(s.p_name), lower(t.p_name))::DOUBLE / greatest(length(s.p_name), length(t.p_name)) AS score
  FROM source s JOIN part t ON s.p_brand = t.p_brand AND s.id <> t.p_partkey // 3),
best AS (SELECT id, m, score FROM scored WHERE score >= 0.5
         QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, m) = 1)
SELECT source.id, m AS near, score FROM source LEFT JOIN best USING (id)
""")
def match_fuzzy_repeated_ids(t: Tables) -> DataFrame:
    """Targets whose ids stand on three rows each; a record is never its own match."""
    parts = t.part.select(F.floor(F.col("p_partkey") / 3).alias("id"), "p_name", "p_brand", "p_partkey")
    rule = FuzzyRule("near", [Pair("p_name", "p_name")], [Pair("p_brand", "p_brand")], 0.5, score="score")
    source = parts.filter(F.col("p_partkey") % 3 == 0).drop("p_partkey")
    return matching.fuzzy_best(source, parts, rule, Ids("id", "id")).select("id", "near", "score")


_FUZZY = [Pair("p_name", "p_name", weight=0.5), Pair("p_type", "p_type", weight=0.5)]
_SIMILAR = FuzzyRule(
    "similar_part", _FUZZY, [Pair("p_brand", "p_brand"), Pair("p_size", "p_size")], 0.75, score="score", details="details"
)
# For lists of all pairs: a line of fifty parts, so that the pairs grow with the parts, not their square.
_SIMILAR_IN_LINE = FuzzyRule("similar_part", _FUZZY, [Pair("line", "line")], 0.75, score="score", details="details")
_SELF = Ids("p_partkey", "p_partkey")


def _similar_sql(block: str) -> str:
    return f"""
scored AS (
  SELECT a.p_partkey AS source_id, b.p_partkey AS target_id,
    0.5::DOUBLE * (1 - levenshtein(lower(a.p_name), lower(b.p_name))::DOUBLE / greatest(length(a.p_name), length(b.p_name)))
    + 0.5::DOUBLE * (1 - levenshtein(lower(a.p_type), lower(b.p_type))::DOUBLE / greatest(length(a.p_type), length(b.p_type))) AS score
  FROM part a JOIN part b ON {block} AND a.p_partkey <> b.p_partkey),
similar_pairs AS (SELECT * FROM scored WHERE score >= 0.75)
"""


_IN_LINE_SQL = _similar_sql("a.p_partkey // 50 = b.p_partkey // 50")
_SIMILAR_SQL = _similar_sql("a.p_brand = b.p_brand AND a.p_size = b.p_size") + """,
best AS (SELECT source_id, target_id AS similar_part, score FROM similar_pairs
         QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY score DESC, target_id) = 1)
"""


def _parts(t: Tables) -> DataFrame:
    line = F.floor(F.col("p_partkey") / 50).alias("line")
    return t.part.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice", line)


@query(f"WITH {_IN_LINE_SQL} SELECT source_id, target_id, score FROM similar_pairs")
def match_fuzzy(t: Tables) -> DataFrame:
    parts = _parts(t)
    return matching.fuzzy_pairs(parts, parts, _SIMILAR_IN_LINE, _SELF).select("source_id", "target_id", "score")


@query("""
WITH names AS (SELECT o_orderkey, 'Supplier#' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS name FROM orders)
SELECT count(*) AS pairs, CAST(sum(o_orderkey * 31 + s_suppkey) AS BIGINT) AS keys
FROM names JOIN supplier ON 1 - levenshtein(lower(name), lower(s_name))::DOUBLE / greatest(length(name), length(s_name)) >= 0.9
""")
def match_fuzzy_one_block(t: Tables) -> DataFrame:
    """All orders and suppliers in one block, which is split into strips."""
    name = F.concat(F.lit("Supplier#"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    orders = t.orders.select("o_orderkey", name.alias("name"), F.lit("all").alias("block"))
    rule = FuzzyRule("near", [Pair("name", "s_name")], [Pair("block", "block")], 0.9)
    suppliers = t.supplier.select("s_suppkey", "s_name", F.lit("all").alias("block"))
    pairs = matching.fuzzy_pairs(orders, suppliers, rule, Ids("o_orderkey", "s_suppkey", same_allowed=True))
    keys = (F.col("source_id") * 31 + F.col("target_id")).cast("long")
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), F.sum(keys).alias("keys"))


@query("""
SELECT a.p_partkey AS part, b.p_partkey AS other, levenshtein(a.p_name, b.p_name) AS edits
FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey
     AND levenshtein(a.p_name, b.p_name) <= 0.3 * greatest(length(a.p_name), length(b.p_name))
""")
def fuzzy_candidates(t: Tables) -> DataFrame:
    """Parts of a brand with names alike, found over the rare grams that they share."""
    parts = t.part.select("p_partkey", "p_brand", "p_name")
    edits = F.levenshtein("a_p_name", "b_p_name")
    alike = edits <= F.lit(0.3) * F.greatest(F.length("a_p_name"), F.length("b_p_name"))
    test = (F.col("a_p_partkey") < F.col("b_p_partkey")) & alike
    found = candidates.close_pairs(parts, parts, ["p_brand"], test, ["p_name"], bound=0.7, tile=1)
    return found.select(F.col("a_p_partkey").alias("part"), F.col("b_p_partkey").alias("other"), edits.cast("long").alias("edits"))


@query(f"WITH {_SIMILAR_SQL} SELECT p_partkey, similar_part, score FROM part LEFT JOIN best ON p_partkey = source_id")
def match_fuzzy_best(t: Tables) -> DataFrame:
    parts = _parts(t)
    return matching.match_fuzzy(parts, parts, _SIMILAR, _SELF).select("p_partkey", "similar_part", "score")


@query(f"""
WITH {_IN_LINE_SQL}
SELECT source_id, target_id, count(*) OVER (PARTITION BY source_id) AS match_count FROM similar_pairs
""")
def match_count(t: Tables) -> DataFrame:
    parts = _parts(t)
    pairs = matching.fuzzy_pairs(parts, parts, _SIMILAR_IN_LINE, _SELF).select("source_id", "target_id")
    return ranking.with_count(pairs, ["source_id"])


_RULES = [
    {
        "match_type": "exact", "result_column": "same_label", "case_insensitive": True, "trim": True,
        "columns": [{"source_column": c, "target_column": c} for c in ("p_name", "p_brand", "p_type")],
    },
    {
        "match_type": "exact", "result_column": "same_price",
        "columns": [{"source_column": c, "target_column": c} for c in ("p_retailprice", "p_brand")],
    },
    {
        "match_type": "levenstein", "result_column": "similar_part", "score_column": "score",
        "comparison_details_column": "details", "min_score": 0.75, "trim": True, "case_insensitive": True,
        "columns": [
            {"source_column": "p_name", "target_column": "p_name", "weight": 0.5, "match": "fuzzy"},
            {"source_column": "p_type", "target_column": "p_type", "weight": 0.5, "match": "fuzzy"},
            {"source_column": "p_brand", "target_column": "p_brand", "match": "exact"},
            {"source_column": "p_size", "target_column": "p_size", "match": "exact"},
        ],
    },
]

_RULES_SQL = f"""
{_SIMILAR_SQL},
labels_matched AS (SELECT a.p_partkey AS k, min(b.p_partkey) AS same_label FROM part a JOIN part b
  ON a.p_name = b.p_name AND a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey GROUP BY 1),
prices_matched AS (SELECT a.p_partkey AS k, min(b.p_partkey) AS same_price FROM part a JOIN part b
  ON a.p_retailprice = b.p_retailprice AND a.p_brand = b.p_brand AND a.p_partkey <> b.p_partkey GROUP BY 1),
matched AS (
  SELECT p_partkey, same_label, same_price, similar_part, score FROM part LEFT JOIN labels_matched l ON p_partkey = l.k
  LEFT JOIN prices_matched p ON p_partkey = p.k LEFT JOIN best ON p_partkey = best.source_id)
"""
_RESULTS = ["same_label", "same_price", "similar_part"]


def _matched(t: Tables) -> DataFrame:
    parts = _parts(t)
    return matching.apply_matching(parts, parts, _RULES, _SELF)


@query(f"WITH {_RULES_SQL} SELECT * FROM matched")
def apply_matching(t: Tables) -> DataFrame:
    return _matched(t).select("p_partkey", *_RESULTS, "score")


@query(f"WITH {_RULES_SQL} SELECT p_partkey, coalesce(same_price, similar_part, same_label) AS winner FROM matched")
def rule_priority(t: Tables) -> DataFrame:
    winner = clusters.first_rule_wins(["same_price", "similar_part", "same_label"])
    return _matched(t).select("p_partkey", winner.alias("winner"))


@query(f"""
WITH RECURSIVE {_SIMILAR_SQL},
nodes AS (SELECT source_id AS n FROM similar_pairs UNION SELECT similar_part FROM best),
links AS (SELECT source_id AS a, similar_part AS b FROM best UNION SELECT similar_part, source_id FROM best),
reach(n, r) AS (SELECT n, n FROM nodes UNION SELECT reach.n, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT p_partkey, coalesce(min(r), p_partkey) AS cluster_id FROM part LEFT JOIN reach ON p_partkey = n GROUP BY p_partkey
""")
def unify_ids(t: Tables) -> DataFrame:
    parts = _parts(t)
    matched = matching.match_fuzzy(parts, parts, _SIMILAR, _SELF)
    return clusters.unify_ids(matched, ["similar_part"], "p_partkey", "cluster_id").select("p_partkey", "cluster_id")


@query("""
WITH RECURSIVE links AS (
  SELECT o_orderkey AS a, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority) AS b FROM orders
  UNION
  SELECT o_orderkey, min(o_orderkey) OVER (PARTITION BY o_totalprice) FROM orders),
edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach(n, r) AS (SELECT a, a FROM edges UNION SELECT reach.n, edges.b FROM reach JOIN edges ON reach.r = edges.a)
SELECT o_orderkey, coalesce(min(r), o_orderkey) AS cluster_id FROM orders LEFT JOIN reach ON o_orderkey = n GROUP BY o_orderkey
""")
def unify_orders(t: Tables) -> DataFrame:
    """Orders linked by customer and priority, or by an equal total: chains across both rules."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    rules = [
        ExactRule("same_kind", [Pair("o_custkey", "o_custkey"), Pair("o_orderpriority", "o_orderpriority")]),
        ExactRule("same_total", [Pair("o_totalprice", "o_totalprice")]),
    ]
    matched = matching.apply_matching(orders, orders, rules, Ids("o_orderkey", "o_orderkey"))
    unified = clusters.unify_ids(matched, ["same_kind", "same_total"], "o_orderkey", "cluster_id")
    return unified.select("o_orderkey", "cluster_id")


# --- clusters --------------------------------------------------------------------------------------


def _event_values(t: Tables) -> DataFrame:
    direct = F.when(F.col("event_type").isin("purchase", "signup"), F.floor(F.col("value") / 10).cast("bigint"))
    return t.events.select("event_id", "user_id", direct.alias("direct"))


_EVENT_VALUES_SQL = """
v AS (SELECT event_id, user_id, CASE WHEN event_type IN ('purchase', 'signup') THEN CAST(floor(value / 10) AS BIGINT) END AS direct
      FROM events)
"""


@query(f"WITH {_EVENT_VALUES_SQL} SELECT event_id, user_id, direct, min(direct) OVER (PARTITION BY user_id) AS filled FROM v")
def cluster_fill(t: Tables) -> DataFrame:
    return clusters.fill_in_cluster(_event_values(t), "user_id", "direct", "filled")


@query(f"""
WITH {_EVENT_VALUES_SQL}, c AS (SELECT user_id AS u, CAST(count(DISTINCT direct) AS INTEGER) AS occurrence FROM v GROUP BY 1)
SELECT event_id, user_id, occurrence FROM v LEFT JOIN c ON user_id = u
""")
def cluster_occurrence(t: Tables) -> DataFrame:
    filled = clusters.fill_in_cluster(_event_values(t), "user_id", "direct", "filled")
    counted = clusters.cluster_occurrence(filled, "user_id", "filled", "direct", "occurrence")
    return counted.select("event_id", "user_id", "occurrence")


# --- payload, cache, budget, upsert ----------------------------------------------------------------


def _payloads(t: Tables) -> DataFrame:
    region = F.when(F.col("c_nationkey") != 3, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
    street = F.when(F.col("c_mktsegment") != "BUILDING", F.lower("c_mktsegment"))
    return enrichment.address_payload(
        t.customer, region, ["c_name", street], F.concat(F.lit("City "), F.col("c_nationkey").cast("string")),
        F.lit(None).cast("string"), "addressvalidation", F.concat(F.lit("https://x.example/v1?key=S3CRET&id="), "c_custkey"),
    )


_PAYLOADS_SQL = """
payloads AS (SELECT *, '{"address":{' || CASE WHEN c_nationkey <> 3 THEN '"regionCode":"N' || c_nationkey || '",' ELSE '' END
  || '"addressLines":["' || c_name || '"' || CASE WHEN c_mktsegment <> 'BUILDING' THEN ',"' || lower(c_mktsegment) || '"' ELSE '' END
  || '],"locality":"City ' || c_nationkey || '"}}' AS payload_string FROM customer)
"""


@query(f"WITH {_PAYLOADS_SQL} SELECT c_custkey, payload_string, 'addressvalidation' AS api_name FROM payloads")
def payload_json(t: Tables) -> DataFrame:
    return _payloads(t).select("c_custkey", "payload_string", "api_name")


_NOW = datetime(2024, 5, 17, 12, 0)


def _cache(t: Tables) -> DataFrame:
    """Answers for two segments, one of them without a place; the furniture ones are of this month."""
    known = _payloads(t).filter(F.col("c_mktsegment").isin("FURNITURE", "MACHINERY"))
    furniture = F.col("c_mktsegment") == "FURNITURE"
    stamp = F.when(furniture, F.lit(datetime(2024, 5, 1))).otherwise(F.lit(datetime(2024, 4, 30, 23, 59)))
    return known.select(
        F.col("payload_string").alias("payload"), "api_name", F.col("c_name").alias("browser_url"),
        F.when(furniture, F.concat(F.lit("place-"), "c_custkey")).alias("place_id"), stamp.alias("api_execution_timestamp"),
    )


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN c_name END AS browser_url,
       CASE WHEN c_mktsegment = 'FURNITURE' THEN 'place-' || c_custkey END AS place_id FROM customer
""")
def cache_join(t: Tables) -> DataFrame:
    return enrichment.attach_cached(_payloads(t), _cache(t)).select("c_custkey", "browser_url", "place_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment <> 'FURNITURE' ORDER BY c_custkey LIMIT 100")
def budget_select(t: Tables) -> DataFrame:
    """The next hundred customers to ask for: the budget is what was used this month plus a hundred."""
    cache = _cache(t)
    budget = enrichment.calls_this_month(cache, _NOW).first().used + 100
    chosen = enrichment.select_for_enrichment(_payloads(t), cache, budget, _NOW, ["c_custkey"])
    return chosen.select("c_custkey", "c_name")


def _digest_provider(questions: pd.DataFrame) -> pd.DataFrame:
    """An offline provider: the place of an address is the digest of its payload."""
    digests = [hashlib.md5(p.encode()).hexdigest() for p in questions["payload_string"]]
    return questions.assign(
        place_id=digests, browser_url=["https://maps.example/" + d for d in digests], google_api_raw_json="{}"
    )


_ANSWER = "browser_url string, place_id string, google_api_raw_json string"


@query(f"""
WITH {_PAYLOADS_SQL}
SELECT c_custkey, md5(payload_string) AS place_id, 'https://maps.example/' || md5(payload_string) AS browser_url FROM payloads
""")
def enrich(t: Tables) -> DataFrame:
    return enrichment.enrich(_payloads(t), _digest_provider, _ANSWER, _NOW).select("c_custkey", "place_id", "browser_url")


def _digit(payload: str) -> str:
    return hashlib.md5(payload.encode()).hexdigest()[0]


def _failing_provider(questions: pd.DataFrame) -> pd.DataFrame:
    """Fails as soon as it is asked for a payload whose digest begins with 0."""
    if any(_digit(p) == "0" for p in questions["payload_string"]):
        raise ConnectionError("timed out")
    return _digest_provider(questions)


_LATER = datetime(2024, 5, 18, 9, 0)


@query(f"""
WITH {_PAYLOADS_SQL}, p AS (SELECT DISTINCT payload_string, md5(payload_string) AS digest FROM payloads)
SELECT payload_string, CAST(1 AS INTEGER) AS attempt, CASE WHEN digest[1] = '0' THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN digest[1] = '0' THEN 'ConnectionError: timed out' END AS error, DATE '2024-05-17' AS day,
       CASE WHEN digest[1] <> '0' THEN digest END AS place_id
FROM p
UNION ALL SELECT payload_string, 2, 'ok', NULL, DATE '2024-05-18', digest FROM p WHERE digest[1] = '0'
""")
def request_log(t: Tables) -> DataFrame:
    """A provider that fails for some payloads, in three portions; the next run asks those and no others."""
    path, answer = f"{shared_folder(t.spark)}/requests-{uuid.uuid4().hex}", T.StructType.fromDDL(_ANSWER)
    asked = _payloads(t)
    third = -(-asked.count() // 3)
    requests.ask_open(asked, _failing_provider, answer, path, _NOW, portion=third)
    requests.ask_open(asked, _digest_provider, answer, path, _LATER)
    log = requests.read_log(t.spark, path, answer)
    return log.select("payload_string", "attempt", "status", "error", F.to_date("asked_at").alias("day"), "place_id")


@query(f"""
WITH {_PAYLOADS_SQL}
SELECT c_custkey, CASE WHEN md5(payload_string)[1] <> '0' THEN md5(payload_string) END AS place_id FROM payloads
""")
def enrich_with_failures(t: Tables) -> DataFrame:
    """What a provider answers is kept although it fails for other payloads."""
    return enrichment.enrich(_payloads(t), _failing_provider, _ANSWER, _NOW).select("c_custkey", "place_id")


@query(f"""
WITH {_PAYLOADS_SQL}
SELECT c_name AS business_partner_name, payload_string AS payload, 'addressvalidation' AS api_name,
       'https://x.example/v1?key=***&id=' || c_custkey AS api_url_masked, md5(payload_string) AS place_id,
       DATE '2024-05-17' AS day
FROM payloads WHERE c_mktsegment <> 'FURNITURE'
UNION ALL
SELECT 'old', payload_string, 'addressvalidation', NULL, 'place-' || c_custkey, DATE '2024-05-01'
FROM payloads WHERE c_mktsegment = 'FURNITURE'
""")
def update_cache(t: Tables) -> DataFrame:
    """One round of the loop: attach the cache, ask for what is missing, merge the answers."""
    furniture = _cache(t).filter(F.col("place_id").isNotNull()).withColumns({
        "business_partner_name": F.lit("old"), "api_url_masked": F.lit(None).cast("string"),
        "google_api_raw_json": F.lit("{}"),
    })
    customers = _payloads(t).selectExpr("*", "c_name AS customer_name").withColumns({
        c: F.lit(None).cast("string") for c in enrichment.PARTNER_COLUMNS if c != "customer_name"
    })
    missing = enrichment.attach_cached(customers, furniture).filter(F.col("place_id").isNull())
    answered = enrichment.enrich(missing, _digest_provider, _ANSWER, _NOW)
    cache = enrichment.update_cache(furniture, answered)
    return cache.select(
        "business_partner_name", "payload", "api_name", "api_url_masked", "place_id",
        F.to_date("api_execution_timestamp").alias("day"),
    )


@query("""
WITH target AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
source AS (SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW')
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
FROM target t FULL JOIN source s ON t.o_orderkey = s.o_orderkey
""")
def merge_upsert(t: Tables) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    target = t.orders.filter(F.col("o_orderstatus") != "P").select(*cols)
    changed = t.orders.filter(F.col("o_orderpriority") != "5-LOW").select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), "o_orderpriority"
    )
    return upsert.merge_upsert(target, changed, ["o_orderkey"], ["o_totalprice"])


@query("""
WITH one AS (
  SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
  FROM orders WHERE o_custkey % 5 <> 0 OR o_custkey % 7 = 1
)
SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders WHERE o_custkey % 5 <> 0) THEN 0 ELSE o_totalprice END AS o_totalprice
FROM one
""")
def bucketed_upsert(t: Tables) -> DataFrame:
    """Two rounds into a table in buckets: many orders, some of them new, then a single one."""
    path = f"{shared_folder(t.spark)}/buckets-{uuid.uuid4().hex}"
    first = t.orders.filter("o_custkey % 5 <> 0").select("o_orderkey", "o_custkey", "o_totalprice")
    buckets.create_buckets(first, path, ["o_orderkey"], buckets=8)
    changed = t.orders.filter("o_custkey % 7 = 1").select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    buckets.upsert_buckets(path, materialize(changed, "changed"), ["o_totalprice"])
    least = first.agg(F.min("o_orderkey").alias("o_orderkey"), F.lit(0.0).alias("o_totalprice"))
    rewritten = buckets.upsert_buckets(path, materialize(least, "least"), ["o_totalprice"])
    if len(rewritten) != 1:
        raise AssertionError(f"one key lies in one bucket, not in {rewritten}")
    return buckets.read_buckets(t.spark, path)


@query("""
WITH keys AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders),
n AS (SELECT count(*) AS n_keys FROM keys)
SELECT o_custkey, o_orderpriority, o_custkey % 3 = 0 AS early, true AS kept,
       n_keys, CAST(1 AS BIGINT) AS lowest, n_keys AS highest, n_keys AS n_ids
FROM keys, n
""")
def key_registry_loads(t: Tables) -> DataFrame:
    """Keys of customers and priorities in two loads and a repeated one: dense, unique, the early ones as they were."""
    path, columns = f"{shared_folder(t.spark)}/keys-{uuid.uuid4().hex}", ["o_custkey", "o_orderpriority"]
    first = t.orders.filter("o_custkey % 3 = 0")
    n_first = key_registry.register_keys(first, columns, path)
    before = materialize(key_registry.read_keys(t.spark, path, t.orders, columns, "entity_id"), "keys-before")
    key_registry.register_keys(t.orders, columns, path)
    if key_registry.register_keys(t.orders, columns, path):
        raise AssertionError("a repeated load has new keys")
    keyed = key_registry.with_keys(t.orders.select(*columns).distinct(), columns, path)
    keyed = lookups.lookup(keyed, before.withColumnRenamed("entity_id", "was"), columns, ["was"], null_safe=True)
    totals = keyed.agg(
        F.count("*").alias("n_keys"), F.min("entity_id").alias("lowest"), F.max("entity_id").alias("highest"),
        F.count_distinct("entity_id").alias("n_ids"),
    ).first()
    return keyed.select(
        *columns, (F.col("entity_id") <= n_first).alias("early"),
        F.coalesce(F.col("was") == F.col("entity_id"), F.col("entity_id") > n_first).alias("kept"),
        *[F.lit(v).cast("long").alias(n) for n, v in totals.asDict().items()],
    )


@query("""
WITH RECURSIVE walk(node, reached) AS (
  SELECT c_custkey, c_custkey FROM customer
  UNION ALL SELECT node, reached - 7 FROM walk WHERE reached > 7 AND reached % 5 <> 0
)
SELECT node, min(reached) AS label FROM walk GROUP BY node
""")
def kept_cluster_batches(t: Tables) -> DataFrame:
    """Chains of customers whose links come in three batches, so that clusters meet later on."""
    path = f"{shared_folder(t.spark)}/labels-{uuid.uuid4().hex}"
    kept_clusters.create_labels(t.spark, path, parts=8)
    key = F.col("c_custkey")
    links = t.customer.select(key.alias("src"), F.when((key > 7) & (key % 5 != 0), key - 7).otherwise(key).alias("dst"))
    for batch in (1, 0, 2):
        kept_clusters.add_links(path, links.filter(F.col("src") % 3 == batch))
    return kept_clusters.read_labels(t.spark, path)


# --- the customer identity flow --------------------------------------------------------------------


def _postal_code(letters: str) -> Column:
    """A few neighbours per code, at any number of customers; letters of either case."""
    return F.concat((F.lit(1000) + F.floor(F.col("c_custkey") / 5)).cast("string"), F.lit(f" {letters}"))


def _place(number: Column, prefix: Column) -> Column:
    """Every seventh customer has a place, which up to three of them share."""
    return F.when(number % 7 == 0, F.concat(prefix, F.floor(number / 21).cast("string")))


def _sellout_customers(t: Tables) -> DataFrame:
    """Orders seen as sales to customers that each wholesaler numbers and spells in its own way."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    key = F.col("c_custkey").cast("string")
    shop = F.concat(F.lit("Shop "), F.when(status == "F", F.upper(F.col("c_name"))).otherwise(F.col("c_name")))
    return rows.select(
        F.when(status == "P", F.concat(key, F.lit("-p"))).otherwise(key).alias("customer_number"),
        F.concat(F.lit("Street "), F.col("c_nationkey").cast("string")).alias("customer_address"),
        F.lit("City").alias("customer_city"),
        _postal_code("ab").alias("customer_postal_code"),
        F.lit("BE").alias("customer_country"),
        F.when(status != "O", shop).alias("customer_name"),
        shop.alias("owner_name"),
        F.concat(F.lit("W"), status).alias("wholesaler_name"),
        F.when(
            F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), F.concat(F.lit("BE"), F.lpad(key, 10, "0"))
        ).alias("vat_number"),
        status.alias("wholesaler_id"),
    )


def _crm_accounts(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    vat = F.concat(F.lit("be"), F.lpad(key, 10, "0"))
    by_tax = F.col("c_mktsegment") == "AUTOMOBILE"
    raw = t.customer.select(
        F.concat(F.lit("A"), F.lpad(key, 9, "0")).alias("c4cu_account_id"),
        F.concat(F.lit(" Shop "), "c_name").alias("c4cu_account_desc"),
        F.lit("BE").alias("c4cu_country_id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", "Belgium").otherwise("France").alias("c4cu_country_desc"),
        F.lit("Street").alias("c4cu_streetaddress_id"),
        F.col("c_nationkey").cast("string").alias("c4cu_housenumber_id"),
        F.lit(" ").alias("c4cu_city_id"),
        _postal_code("AB").alias("c4cu_postalcode_id"),
        F.when(by_tax, "").otherwise(vat).alias("c4cu_vatregistration_id"),
        F.when(by_tax, vat).otherwise("").alias("c4cu_taxnumber4_id"),
    )
    number = F.substring("c4cu_account_id", 2, 9).cast("long")
    # Place ids are compared as they are: a lower-case one is another place.
    prefix = F.when(number % 2 == 0, "Pl").otherwise("pl")
    return identity.prepare_accounts(raw, "Belgium").withColumn("place_id", _place(number, prefix))


def _relationships(t: Tables) -> DataFrame:
    """Furniture shops are known to wholesaler F under their number."""
    key = F.col("c_custkey").cast("string")
    rows = t.customer.filter(F.col("c_mktsegment") == "FURNITURE").select(
        F.concat(F.lit("00B"), key).alias("c4cu_businesspartner_id"), F.lit("00F").alias("c4cu_businesspartner2_id"),
        F.concat(F.lit("0"), F.when(F.col("c_custkey") == 0, "").otherwise(key)).alias("c4cu_numberatwholesaler_id"),
    )
    return identity.clean_relationships(rows)


def _identities(t: Tables) -> DataFrame:
    number = F.regexp_extract("customer_number", "^[0-9]+", 0).cast("long")
    place = F.when(F.col("vat_number").isNull(), _place(number, F.lit("Pl")))
    entities = identity.customer_entities(_sellout_customers(t)).withColumn("place_id", place)
    return identity.match_internal(entities)


_IDENTITY_SQL = """
raw AS (
  SELECT DISTINCT CASE WHEN o_orderstatus = 'P' THEN c_custkey || '-p' ELSE CAST(c_custkey AS VARCHAR) END AS customer_number,
    'Street ' || c_nationkey AS customer_address, CAST(1000 + c_custkey // 5 AS VARCHAR) || ' ab' AS zip,
    CASE WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') AND c_custkey % 7 = 0 THEN 'Pl' || c_custkey // 21 END AS place,
    'Shop ' || CASE WHEN o_orderstatus = 'F' THEN upper(c_name) ELSE c_name END AS shop,
    CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'BE' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS vat,
    o_orderstatus AS w
  FROM orders JOIN customer ON o_custkey = c_custkey),
people AS (
  SELECT *, sha256('{"c0":"' || customer_number || '","c1":"' || customer_address || '","c2":"City","c3":"' || zip
    || '","c4":"BE","c5":"' || shop || '","c6":"' || shop || '","c7":"W' || w || '","c8":'
    || coalesce('"' || vat || '"', 'null') || ',"c9":"' || w || '"}') AS id FROM raw),
by_number AS (SELECT a.id, min(b.id) AS m FROM people a JOIN people b ON a.customer_number = b.customer_number AND a.id <> b.id GROUP BY 1),
by_vat AS (SELECT a.id, min(b.id) AS m FROM people a JOIN people b ON a.vat = b.vat AND a.id <> b.id GROUP BY 1),
by_place AS (SELECT a.id, min(b.id) AS m FROM people a JOIN people b ON a.place = b.place AND a.id <> b.id GROUP BY 1),
scored AS (
  SELECT a.id, b.id AS m,
    0.5::DOUBLE * (1 - levenshtein(lower(a.shop), lower(b.shop))::DOUBLE / greatest(length(a.shop), length(b.shop)))
    + 0.5::DOUBLE * (1 - levenshtein(lower(a.customer_address), lower(b.customer_address))::DOUBLE
                         / greatest(length(a.customer_address), length(b.customer_address))) AS score
  FROM people a JOIN people b ON a.zip = b.zip AND a.id <> b.id),
by_name AS (SELECT * FROM scored WHERE score >= 0.75 QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, m) = 1),
links AS (
  SELECT id AS a, m AS b FROM by_number UNION SELECT id, m FROM by_vat UNION SELECT id, m FROM by_name
  UNION SELECT id, m FROM by_place UNION SELECT m, id FROM by_place
  UNION SELECT m, id FROM by_number UNION SELECT m, id FROM by_vat UNION SELECT m, id FROM by_name),
reach(n, r) AS (SELECT id, id FROM people UNION SELECT reach.n, links.b FROM reach JOIN links ON reach.r = links.a),
clustered AS (
  SELECT people.*, c.cluster, by_number.m AS number_match, by_vat.m AS vat_match, by_name.m AS name_match, by_place.m AS place_match, score
  FROM people JOIN (SELECT n, min(r) AS cluster FROM reach GROUP BY 1) c ON id = n
  LEFT JOIN by_number USING (id) LEFT JOIN by_vat USING (id) LEFT JOIN by_name USING (id) LEFT JOIN by_place USING (id))
"""


@query(f"""
WITH RECURSIVE {_IDENTITY_SQL}
SELECT id AS unique_id, customer_number, shop AS customer_name, 'W' || w AS wholesaler_name,
       number_match AS int_customer_number_match, vat_match AS int_vat_number_match,
       place_match AS int_place_id_match, name_match AS int_levenstein_name_address, score AS levenstein_score, cluster AS dim_sellout_cust_id
FROM clustered
""")
def customer_clusters(t: Tables) -> DataFrame:
    """Entities of the sales rows, matched by four rules and clustered."""
    return identity.internal_table(_identities(t)).select(
        "unique_id", "customer_number", "customer_name", "wholesaler_name", "int_customer_number_match",
        "int_vat_number_match", "int_place_id_match", "int_levenstein_name_address", "levenstein_score", "dim_sellout_cust_id",
    )


def _linked(t: Tables) -> DataFrame:
    return identity.link_accounts(_identities(t), _crm_accounts(t), _relationships(t))


_LINKED_SQL = f"""
{_IDENTITY_SQL},
accounts AS (
  SELECT 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS account, 'shop ' || lower(c_name) AS shop, 'Street ' || c_nationkey AS street,
         CAST(1000 + c_custkey // 5 AS VARCHAR) || ' ab' AS zip,
         CASE WHEN c_custkey % 7 = 0 AND c_custkey % 2 = 0 THEN 'Pl' || c_custkey // 21 END AS place,
         CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN 'BE' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS vat,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'BE' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS tax
  FROM customer WHERE c_mktsegment <> 'MACHINERY'),
partners AS (SELECT 'B' || c_custkey AS account, CASE WHEN c_custkey = 0 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS number
             FROM customer WHERE c_mktsegment = 'FURNITURE'),
hits AS (
  SELECT id, account, 0 AS priority, NULL::DOUBLE AS score FROM clustered JOIN partners ON customer_number = number AND w = 'F' AND number <> ''
  UNION ALL SELECT id, account, 1, NULL FROM clustered c JOIN accounts a ON c.vat = a.vat
  UNION ALL SELECT id, account, 2, NULL FROM clustered c JOIN accounts a ON c.vat = a.tax
  UNION ALL SELECT id, account, 3, NULL FROM clustered c JOIN accounts a ON c.place = a.place
  UNION ALL SELECT id, account, 4, alike FROM (
    SELECT id, account,
      0.5::DOUBLE * (1 - levenshtein(lower(c.shop), a.shop)::DOUBLE / greatest(length(c.shop), length(a.shop)))
      + 0.5::DOUBLE * (1 - levenshtein(lower(c.customer_address), lower(a.street))::DOUBLE
                           / greatest(length(c.customer_address), length(a.street))) AS alike
    FROM clustered c JOIN accounts a ON c.zip = a.zip) WHERE alike >= 0.7),
won AS (SELECT DISTINCT id, account FROM hits QUALIFY priority = min(priority) OVER (PARTITION BY id)),
linked AS (
  SELECT clustered.*, account AS direct, min(account) OVER (PARTITION BY cluster) AS filled
  FROM clustered LEFT JOIN won USING (id)),
occurrences AS (SELECT cluster, CAST(count(DISTINCT direct) AS INTEGER) AS n FROM linked GROUP BY 1),
shown AS (
  SELECT id, cluster, direct, filled, w, customer_number AS "Id at Wholesaler", customer_address AS "Customer Address",
    'City' AS "Customer City", zip AS "Customer Postal Code", 'BE' AS "Customer Country", shop AS "Customer Name",
    'W' || w AS "Wholesaler Name", vat AS "Vat Number", w AS "Wholesaler Id", place AS "Place Id",
    n AS "Occurrence", customer_number || w AS "Id at Wholesaler + Wholesaler Id"
  FROM linked JOIN occurrences USING (cluster))
"""


@query(f"""
WITH RECURSIVE {_LINKED_SQL}
SELECT * EXCLUDE (id, cluster, direct, filled, w), lpad(filled, 10, '0') AS "C4s Account Id", CAST(1 AS INTEGER) AS rn FROM shown
QUALIFY row_number() OVER (PARTITION BY "Id at Wholesaler" ORDER BY filled DESC NULLS LAST, w, id) = 1
""")
def v_customers(t: Tables) -> DataFrame:
    """The report of customers, one row per number, after the whole identity flow."""
    return views.customers_view(_linked(t))


@query(f"""
WITH RECURSIVE {_LINKED_SQL}
SELECT * EXCLUDE (id, cluster, direct, filled, w), lpad(direct, 10, '0') AS "C4s Account Id", cluster AS dim_sellout_cust_id FROM shown
QUALIFY row_number() OVER (PARTITION BY cluster, lpad(direct, 10, '0') ORDER BY "Id at Wholesaler" DESC, w, id) = 1
""")
def v_customers_with_duplicates(t: Tables) -> DataFrame:
    return views.customers_with_duplicates_view(_linked(t))


@query(f"""
WITH RECURSIVE {_LINKED_SQL},
wide AS (
  SELECT c.id AS unique_id, c.cluster AS dim_sellout_cust_id, p.account AS ext_BPR_match, v.account AS ext_Tax_Number_4_match,
    x.account AS ext_vat_number_match, g.account AS ext_place_id_match, n.account AS ext_levenstein_name_address,
    n.score AS ext_levenstein_score, coalesce(p.account, v.account, x.account, g.account, n.account) AS direct_c4S_account_id
  FROM clustered c
  LEFT JOIN hits p ON c.id = p.id AND p.priority = 0 LEFT JOIN hits v ON c.id = v.id AND v.priority = 1
  LEFT JOIN hits x ON c.id = x.id AND x.priority = 2 LEFT JOIN hits g ON c.id = g.id AND g.priority = 3
  LEFT JOIN hits n ON c.id = n.id AND n.priority = 4)
SELECT *, min(direct_c4S_account_id) OVER (PARTITION BY dim_sellout_cust_id) AS C4S_account_id,
  CAST(count(DISTINCT direct_c4S_account_id) OVER (PARTITION BY dim_sellout_cust_id) AS INTEGER) AS customer_number_Occurrence
FROM wide
""")
def match_external(t: Tables) -> DataFrame:
    """All external rules side by side, in the columns of the table of matched customers."""
    wide = identity.match_external(_identities(t), _crm_accounts(t), _relationships(t))
    return identity.external_table(wide).select(
        "unique_id", "dim_sellout_cust_id", *identity.ACCOUNT_PRIORITY, "ext_levenstein_score", "direct_c4S_account_id",
        "C4S_account_id", "customer_number_Occurrence",
    )
