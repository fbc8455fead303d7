import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkfolio.llm import url_filter as U
from sparkfolio.llm.queries import URL_RULES

URLS = ["http://a.com/x", "https://Example.COM/en/1?x#y", "http://www.example.com/en/2", "http://m.www.example.com/en/", "http://example.com/en", "http://b.net/es/", "x.net/es/",
        "http://net/fr/a", "http://anet/fr/a", "http://a.net/fr?/fr/", "ftp://a.net", "://", "http://", "http:///es/", "http://a.net#/es/", "http://a..com/", None, "", "no scheme",
        "http://user@a.com:80/p", "http://é.com/ü", "http://a.com/x", "http://a.net/es/://b.com/", "http://a.com\n/x"]


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min((path.find(c) for c in "?#" if c in path), default=len(path))]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else default


@pytest.mark.parametrize("rules", [URL_RULES, [], [("block", "com", ""), ("allow", "a.com", "/x"), ("block", "a.com", "/x/y")], [("block", f"h{i}.com", "/") for i in range(3000)]])
def test_equal_brute_force(spark, rules):
    urls = URLS + [f"http://w.h{i}.com/{i}" for i in range(0, 6000, 7)]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").select("*", F.lit(1).alias("host"), F.lit(2).alias("keys"), F.lit(3).alias("record"))
    got = {r["record"]["page_id"]: tuple(r[c] for c in ("host", "path", "rule", "verdict")) for r in U.judge_urls(pages, rules).collect()}
    for i, u in enumerate(urls):
        assert got[i] == brute(u, rules), u
    assert U.judge_urls(pages.limit(0), rules).collect() == []


def test_list_in_parts(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_KEYS", 2)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in U.judge_urls(pages, URL_RULES).collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["record"]["url"], URL_RULES)


@pytest.mark.parametrize("n_listed,n_all,levels", [(500, 20_000, 24), (500, 20_000, 2), (1, 50, 24), (0, 50, 24), (300, 300, 24)])
def test_cascade_is_exact_on_the_universe(spark, monkeypatch, n_listed, n_all, levels):
    monkeypatch.setattr(U, "MAX_LEVELS", levels)
    monkeypatch.setattr(U, "BITS_PER_KEY", (2, 2))                # many wrong answers at each level
    keys = spark.range(n_all).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), "id")
    cascade = U.build_cascade(keys.where(F.col("id") < n_listed), keys)
    pdf = keys.toPandas()
    assert (cascade.member(pdf["h1"].to_numpy(), pdf["h2"].to_numpy()) == (pdf["id"] < n_listed).to_numpy()).all()
    assert len(cascade.levels) <= levels


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(-2 ** 63, 2 ** 63 - 1), max_size=50), st.integers(1, 20))
def test_bloom_never_rejects_its_keys(keys, bits):
    k = np.array(keys, np.int64)
    assert U.Bloom(k, k[::-1].copy(), bits, 3)(k, k[::-1].copy()).all()


def test_hosts_of_many_labels(spark):
    """50,000 labels give as many keys as the longest rule has labels."""
    host = "a." * 50_000
    pages = spark.createDataFrame([(1, f"http://{host}com/"), (2, f"http://{host}net/fr/x"), (3, f"http://{host}www.example.com/en/"), (4, "http://" + "." * 100_000)], "page_id long, url string")
    got = {r["id"]: (r["n"], r["rule"], r["verdict"]) for r in U.judge_urls(pages, URL_RULES).selectExpr("record.page_id id", "length(host) n", "rule", "verdict").collect()}
    assert got == {1: (100_003, "com/", "allow"), 2: (100_003, "net/fr/", "block"), 3: (100_015, "www.example.com/en/", "allow"), 4: (100_000, None, "allow")}
