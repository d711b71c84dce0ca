import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattloom.llm import url_filter as module
from wattloom.llm.queries import URL_RULES
from wattloom.llm.url_filter import Cascade, build_levels, judge_urls
from wattloom.llm.url_filter import test_levels as levels_say


def brute(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    verdict = best.verdict if best else ("block" if host in listed else "allow")
    return host, path, best.name if best else None, verdict


URLS = [
    None, "", "no scheme/x", "://", "http://", "http://a.ORG", "http://a.org/", "HTTP://Example.ORG/es/1?q#f", "https://www.example.org/en/12",
    "https://example.org/en/2", "http://notexample.org/es/", "http://com/de/", "http://x.com/fr/a", "http://x.com?/de/", "http://x.com#/de/",
    "http://a.net/://b.com/fr/", "http://ÉA.net/x\ny?z", "ftp://u@h:80/p", "http://a.net/x", "http://a.net/x", "http://bad.net/",
]


def test_hosts_paths_rules_and_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(URLS)], "page_id bigint, url string, host string, verdict string")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, URL_RULES, F.col("host") == "bad.net").collect()}
    assert found == {i: brute(u, {"bad.net"}) for i, u in enumerate(URLS)}


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES, F.lit(True)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.floats(0, 1), st.integers(0, 1 << 30))
def test_levels_are_exact_over_the_universe(n, share, seed):
    draw = np.random.default_rng(seed)
    one, two = (draw.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    listed = draw.random(n) < share
    assert (levels_say(build_levels(one, two, listed), one, two) == listed).all()


def test_the_same_hashes_are_an_error():
    one = np.array([5, 5], np.uint64)
    with pytest.raises(ValueError):
        build_levels(one, one, np.array([True, False]))


@pytest.mark.parametrize("limit", [1, 1 << 30])
def test_many_shards_in_one_or_many_branches(spark, limit):
    keys = spark.range(2000).select(F.when(F.col("id") > 0, F.concat(F.lit("k"), F.col("id"))).alias("k"), (F.col("id") % 7 == 0).alias("in_list"))
    cascade = Cascade.build(keys.unionByName(keys), "k", F.col("in_list"), shard_keys=150)
    marked = cascade.mark(keys, "k", limit=limit)
    assert cascade.n_shards == 14 and marked.count() == 2000
    assert marked.where(F.col("is_listed") != (F.col("in_list") & F.col("k").isNotNull())).count() == 0
    assert module.BROADCAST_BYTES > 0


def test_long_urls_null_ids_and_repeated_rows(spark):
    urls = ["http://bad.net/" + "x" * 500_000, "http://" + "sub." * 20_000 + "example.org/es/", "http://bad.net/" + "x" * 500_000, None]
    pages = spark.createDataFrame([(None, u) for u in urls], "page_id bigint, url string")
    found = sorted((r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, URL_RULES, F.col("host") == "bad.net").collect())
    assert found == sorted(brute(u, {"bad.net"}) for u in urls)
