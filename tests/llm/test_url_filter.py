import re

import numpy as np
import pytest

from frames import CLASHES
from mergelane.llm import url_filter as uf
from mergelane.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "http://a.example.org/es/x", "HTTP://WWW.EXAMPLE.ORG/EN/1", "http://example.org/en/1?x=/fr/",
    "http://example.org/en/2", "http://x.com/fr/1", "http://com/de/", "http://xcom/de/1", "https://a.b.example.org/en/12#f",
    "http://org", "http://org?q=/x", "http://example.org/es", "http://é.com/de/é", "http://u://x.com/de/", "http://.org/", "x://a..com/fr/",
]


def pages(spark, urls):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for name, value in CLASHES.items():
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(value))
    return frame


def brute(url, rules, default="allow"):
    host, path = uf.host_and_path(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = min(fits, key=lambda r: (-len(r.text), r.text), default=None)
    return host, path, best and best.text, best.verdict if best else default


RULES = [*URL_RULES, uf.Rule("block", "a.b.example.org", "/en/"), uf.Rule("allow", "é.com", "/de/é")]


@pytest.mark.parametrize("rules", [list(URL_RULES), RULES, []])
def test_against_brute_force(spark, rules):
    out = uf.filter_urls(pages(spark, URLS), rules)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
    assert found == {i: brute(u, rules) for i, u in enumerate(URLS)}


def test_large_lists_agree(spark):
    urls = URLS * 3
    rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in RULES] + [(None, "org", "/")], "verdict string, host string, path string")
    for shards in (2, 100):
        out = uf.filter_urls_by_table(pages(spark, urls), rules, shard_rules=shards)
        found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()}
        assert found == {i: brute(u, RULES) for i, u in enumerate(urls)}
    assert uf.filter_urls_by_table(pages(spark, urls).limit(0), rules).count() == 0


def test_collisions(tmp_path, monkeypatch):
    monkeypatch.setattr(uf, "digests", lambda keys: np.array([len(k) % 2 for k in keys], dtype=np.uint64))
    keys = [b"a", b"bb", b"ccc", b"dd", b"e"]
    packed, order = uf.DigestArray.pack(keys)
    (tmp_path / "x").write_bytes(packed)
    array = uf.DigestArray(str(tmp_path / "x"))
    places = array.probe([*keys, b"f", b"gg", b""])
    assert [keys[order[p]] if p >= 0 else None for p in places] == [*keys, None, None, None]


def test_empty_array(tmp_path):
    packed, _ = uf.DigestArray.pack([])
    (tmp_path / "x").write_bytes(packed)
    assert uf.DigestArray(str(tmp_path / "x")).probe([b"a"]).tolist() == [-1]


def test_edges(spark):
    assert uf.filter_urls(pages(spark, URLS).limit(0), URL_RULES).count() == 0
    with pytest.raises(ValueError):
        uf.filter_urls(pages(spark, URLS), [uf.Rule("allow", "a", "/"), uf.Rule("block", "a", "/")])


def test_large_lists_of_many_path_lengths(spark):
    rules = spark.range(6_000).selectExpr("'block' AS verdict", "'h' AS host", "concat('/', repeat('x', int(5999 - id))) AS path")
    urls = ["http://h/" + "x" * n for n in range(40)]
    found = {r.page_id: (r.rule, r.verdict) for r in uf.filter_urls_by_table(pages(spark, urls), rules).collect()}
    assert found == {i: (u.removeprefix("http://"), "block") for i, u in enumerate(urls)}


@pytest.mark.parametrize("n_urls, n_rules, least", [(500, 1, 50), (1, 500, 50), (1, 1, 1)])
def test_shards_follow_keys_and_rules(spark, n_urls, n_rules, least):
    rules = spark.range(n_rules).selectExpr("'block' AS verdict", "concat('h', id, '.com') AS host", "'/a' AS path")
    urls = [f"http://h{i}.com/a" for i in range(n_urls)]
    out = uf.filter_urls_by_table(pages(spark, urls), rules, shard_rules=10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    shards = [int(n) for n in re.findall(r"pmod\(xxhash64\(text#\d+, 42\), (\d+)\)", plan)]
    assert shards and min(shards) >= least
    assert sum(r.verdict == "block" for r in out.collect()) == min(n_urls, n_rules)
