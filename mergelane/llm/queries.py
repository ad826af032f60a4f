"""The registered queries: one per operator, over the whole of its table."""

from __future__ import annotations

import uuid
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergelane.llm import (
    bpe,
    fingerprints,
    license_scan,
    merkle,
    multi_index,
    ngram_join,
    packing,
    quality,
    secret_scan,
    token_counts,
    topk_bitslice,
    url_filter,
    whitening,
)
from mergelane.llm.registry import QUERIES, SQL, query  # noqa: F401
from mergelane.session import materialize, shared_folder


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_secret_scan")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """One row per candidate; the secret itself is given as a digest."""
    found = secret_scan.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "at", "rule", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score",
        F.col("secret").cast("int").alias("secret"),
    )


@query("op2_license_scan")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, folder, "documents"))
    base = F.array_sort(F.array_distinct("places.label"))
    covers = F.concat(
        F.transform("spans", lambda s: s["cover"]), F.transform("places", lambda p: F.lit(1.0))
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.first_word").alias("first_word"),
        F.array_max("places.first_word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("places.label", "spans.label")), ",").alias("labels"),
        F.coalesce(F.array_max(covers), F.lit(0.0)).alias("score"),
    )


# Words between ASCII white space; words of letters, digits and non-ASCII characters.
BLANK_WORDS = r"[^\x20\x09-\x0D]+"
LETTER_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP3_SQL = rf"""
WITH kept AS (
  SELECT source, lang, coalesce(text, '') AS text FROM documents
  WHERE doc_id IS NULL OR doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0 AND doc_id IS NOT NULL)
),
counts AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(text, '{LETTER_WORDS}')) AS n FROM kept
  UNION ALL
  SELECT source, lang, 'utf8-bytes-1', strlen(text) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS docs, CAST(sum(n) AS BIGINT) AS tokens FROM counts GROUP BY ALL
"""


@query("op3_token_counts", OP3_SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Three batches: all documents come in, those labelled bad go, and the words of the others are recounted."""
    docs, labels = (table(spark, folder, name) for name in ("documents", "labels"))
    text = F.coalesce("text", F.lit(""))
    counts = materialize(
        docs.select(
            "doc_id", "source", "lang", F.regexp_count(text, F.lit(BLANK_WORDS)).alias("words"),
            F.regexp_count(text, F.lit(LETTER_WORDS)).alias("recounted"), F.octet_length(text).alias("bytes"),
        ),
        "token-counts",
    )
    first = {"words-1": F.col("words"), "utf8-bytes-1": F.col("bytes")}
    bad = labels.filter("quality = 0").select("doc_id").distinct()
    gone, kept = counts.join(bad, "doc_id", "left_semi"), counts.join(bad, "doc_id", "left_anti")
    recounted = kept.select(
        "source", "lang", F.lit("words-1").alias("tokenizer"), F.col("words").alias("old_tokens"),
        F.col("recounted").alias("tokens"),
    )
    store = f"{shared_folder(spark)}/rollup-{uuid.uuid4().hex}"
    arrived = token_counts.inserts(token_counts.counted(counts, first))
    token_counts.commit(store, "arrivals", arrived)
    token_counts.commit(store, "bad", token_counts.deletes(token_counts.counted(gone, first)))
    token_counts.commit(store, "recount", token_counts.revisions(recounted))
    token_counts.commit(store, "arrivals", arrived)  # as after a restart: counts once
    return token_counts.totals(spark, store)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""


@query("op4_bit_sliced_topk", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return topk_bitslice.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


# The rules to judge the pages by.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)

OP5_SQL = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
),
cut AS (SELECT page_id, regexp_extract(r, '^[^?#]*') AS r FROM rest),
split AS (
  SELECT page_id, regexp_extract(r, '^[^/]*') AS h, substr(r, length(regexp_extract(r, '^[^/]*')) + 1) AS path FROM cut
),
parts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split
),
rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
fits AS (
  SELECT host, path, h || p AS rule, verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, h || p) AS n
  FROM (SELECT DISTINCT host, path FROM parts), rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (host, path)
"""


@query("op5_url_filter", OP5_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, folder, "pages"), URL_RULES)


@query("op6_byte_bpe")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    coded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op7_quality_classifier")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op8_quartile_fingerprint")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_fingerprints(table(spark, folder, "documents"))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Documents packed by their number of words."""
    docs = table(spark, folder, "documents")
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(BLANK_WORDS))
    return packing.pack(docs.select("doc_id", words.alias("words")), "words")


@query("op10_ngram_jaccard")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.components(table(spark, folder, "documents"), size=3, threshold=Fraction(9, 10))


# The exact result, which the index reaches where it sees every link.
OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9
),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query("op11_multi_index_dedup", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, folder, "embeddings"), threshold=0.9)


# Levels are lists per source; crc32 goes through the bits of each byte of the decimal id.
OP12_SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source,
    list_reduce(list_prepend(4294967295, list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) AS BIGINT))),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [CAST(k AS BIGINT) for k in range(8)]),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
    text
  FROM documents
),
leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(t) || ':' || t, '-')) AS changed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS r
  FROM (SELECT *, CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM hashed)
),
trees AS (
  SELECT source, 0 AS lvl, list(leaf ORDER BY r) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, lvl + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))
  FROM trees WHERE len(nodes) > 1
),
subroots AS (
  SELECT source, nodes[1] AS subroot, lvl AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r FROM trees WHERE len(nodes) = 1
),
roots AS (
  SELECT 0 AS lvl, list(subroot ORDER BY r) AS nodes FROM subroots
  UNION ALL
  SELECT lvl + 1, list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))
  FROM roots WHERE len(nodes) > 1
),
steps AS (
  SELECT l.doc_id, t.lvl, l.r // CAST(pow(3, t.lvl) AS BIGINT) AS pos, t.nodes
  FROM leaves l JOIN trees t ON l.source IS NOT DISTINCT FROM t.source AND len(t.nodes) > 1
  UNION ALL
  SELECT l.doc_id, s.top + r.lvl, s.r // CAST(pow(3, r.lvl) AS BIGINT), r.nodes
  FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source, roots r WHERE len(r.nodes) > 1
),
sides AS (
  SELECT doc_id, lvl, array_to_string(nodes[pos // 3 * 3 + 1:pos], '') AS l, array_to_string(nodes[pos + 2:pos // 3 * 3 + 3], '') AS r
  FROM steps
),
proofs AS (SELECT doc_id, list(l ORDER BY lvl) AS ls, list(r ORDER BY lvl) AS rs FROM sides GROUP BY doc_id),
folds AS (
  SELECT doc_id, 0 AS k, changed AS node, ls, rs FROM leaves LEFT JOIN proofs USING (doc_id)
  UNION ALL
  SELECT doc_id, k + 1, sha256(ls[k + 1] || node || rs[k + 1]), ls, rs FROM folds WHERE k < coalesce(len(ls), 0)
),
folded AS (
  SELECT doc_id, node AS folded_root,
    sha256(coalesce(array_to_string([ls[i] || rs[i] for i in range(1, len(ls) + 1)], ''), '')) AS proof_sha256
  FROM folds WHERE k = coalesce(len(ls), 0)
)
SELECT l.doc_id, l.leaf, s.subroot, r.nodes[1] AS root, f.proof_sha256, f.folded_root, f.folded_root = r.nodes[1] AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN folded f USING (doc_id),
  (SELECT nodes FROM roots WHERE len(nodes) = 1) r
"""


@query("op12_merkle_manifest", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every row proved, those with an even checksum of their id from a text that has lost its line breaks."""
    docs = table(spark, folder, "documents")
    even = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    text = F.when(even, F.replace(docs["text"], F.lit("\n"), F.lit(""))).otherwise(docs["text"])
    return merkle.manifest(docs, tampered={"text": text})


@query("op13_block_whitening")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))
