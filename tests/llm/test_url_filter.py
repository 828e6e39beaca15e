import random

import pytest
from pyspark.sql import functions as F

from gleanery.llm import url_filter

from .helpers import clashing

RULES = "host string, path string, verdict string"


def plain(url, rules):
    """host, path, rule, verdict, the plain way."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h) + len(p), len(h), v == "block", h + p)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    _, _, block, rule = max(fits)
    return host, path, rule, "block" if block else "allow"


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    out = url_filter.judge_urls(clashing(pages), clashing(spark.createDataFrame(rules, RULES)))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r[0]: tuple(r[1:]) for r in out.collect()}


def some_rules(r, n):
    hosts = ["com", "net", "a.com", "b.a.com", "ba.com", "xa.net", "a", "", "b..com"]
    paths = ["", "/", "/en/", "/en", "/e", "/en/x", "/ü/"]
    return list({(r.choice(hosts), r.choice(paths), r.choice(["allow", "block"])) for _ in range(n)})


@pytest.mark.parametrize("seed, shard_keys", [(0, 20_000), (1, 20_000), (2, 3)])
def test_against_plain_rules(spark, monkeypatch, seed, shard_keys):
    monkeypatch.setattr(url_filter, "SHARD_KEYS", shard_keys)
    r = random.Random(seed)
    rules = some_rules(r, r.choice([2, 8, 20]))
    hosts = ["com", "A.com", "b.a.com", "c.b.A.COM", "xa.com", "ba.com", "net", "xa.net", "y.xa.net", "", ".", "b..com", "a.com:80", "Éa.com"]
    ends = ["", "/", "/en", "/en/", "/en/x?q=/en/", "/e#/en", "?x=/", "#/", "/EN/", "/ü/ü", "//"]
    urls = [f"http://{h}{e}" for h in hosts for e in ends]
    urls += [None, "", "://", "no scheme/en/", "x://y://a.com/", "http://" + "a." * 5000 + "com/en/" + "z" * 5000, *urls[:5]]
    assert judged(spark, urls, rules) == {i: plain(u, rules) for i, u in enumerate(urls)}


def test_odd_rules_and_empty_tables(spark):
    rules = [("com", "/", "allow"), ("COM", "/", "block"), (None, "/", "block"), ("net", None, "block"), ("org", "/", None)]
    out = judged(spark, ["http://a.com/", "http://a.net/", "http://a.org/"], rules)
    assert [out[i][2:] for i in range(3)] == [("com/", "block"), (None, "allow"), (None, "allow")]
    assert judged(spark, ["http://a.com/"], [])[0] == ("a.com", "/", None, "allow")
    assert judged(spark, [], rules) == {}


def test_cascade_is_exact_over_its_universe(spark):
    key = F.struct(F.concat(F.lit("h"), F.col("id")).alias("host"), F.lit("/").alias("path")).alias("key")
    universe = spark.range(20_000).select(key)
    listed = spark.range(0, 20_000, 7).select(key)
    filters = url_filter.cascade(listed, universe)
    assert len(filters) > 2 and sum(f.bits for f in filters) < 40_000
    found = universe.where(url_filter.contains(filters, F.col("key")))
    assert sorted(int(r.key.host[1:]) for r in found.collect()) == list(range(0, 20_000, 7))


def test_judging_has_no_join_and_stays_in_the_jvm(spark):
    pages = spark.range(10).select(F.col("id").alias("page_id"), F.lit("http://a.com/").alias("url"))
    rules = spark.sql(f"select * from values ('com', '/', 'block') as r(host, path, verdict)")
    text = url_filter.judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("Join", "Exchange", "Python", "ExistingRDD"))
