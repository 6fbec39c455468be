"""URL rules and host reputation."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter as U
from tessera.llm.queries import RULES


def _judge(spark, pages, labels, **how):
    p = spark.createDataFrame([(*r, "h") for r in pages], "page_id long, url string, host string")
    q = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return U.judge(p, q, RULES, **how)


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("no scheme/x", "", "", None, "allow"),
    ("http://EXAMPLE.org/es/1?q#f", "example.org", "/es/1", "example.org/es/", "block"),
    ("http://a.example.org/en/17", "a.example.org", "/en/17", "example.org/en/1", "block"),
    ("http://a.example.org/en/27", "a.example.org", "/en/27", "org/", "allow"),
    ("http://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    ("http://x.com/de/a", "x.com", "/de/a", "com/de/", "block"), ("http://com/fr/", "com", "/fr/", "com/fr/", "allow"),
    ("http://x.com?/de/", "x.com", "", None, "allow"), ("http://x.org#/", "x.org", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://ÄX.com/fr/", "Äx.com", "/fr/", "com/fr/", "allow"),
])
def test_rules(spark, url, host, path, rule, verdict):
    r = _judge(spark, [(1, url)], []).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_reputation_shrinks_and_blocks(spark):
    pages, labels, n = [], [], 0
    def add(host, many, bad):
        nonlocal n
        for i in range(many):
            pages.append((n, f"http://{host}/p{i}"))
            labels.append((n, 0 if i < bad else 1, 0))
            n += 1
    add("bad.one.net", 60, 58)
    add("few.two.net", 2, 2)
    for k in range(12):
        add(f"h{k}.good{k}.net", 30, 1)
    pages += [(n, "http://new.one.net/"), (n + 1, None), (None, "http://bad.one.net/z"), (n, "http://new.one.net/")]
    labels += [(None, 0, 1), (5, None, None), (n, 1, None)]
    got = {(r.id, r.host): r for r in _judge(spark, pages, labels).collect()}
    by_host = {h: r for (_, h), r in got.items()}
    assert by_host["bad.one.net"].verdict == "block" and by_host["few.two.net"].verdict == "allow"
    assert by_host["h3.good3.net"].rate < by_host["few.two.net"].rate < by_host["bad.one.net"].rate < 58 / 60 + 1e-9
    assert _judge(spark, pages, labels).count() == len(pages)


def test_no_labels_and_empty_tables(spark):
    assert [r.verdict for r in _judge(spark, [(1, "http://a.net/x")], []).collect()] == ["allow"]
    assert _judge(spark, [], []).collect() == []


@pytest.mark.parametrize("host,domain,suffix", [("a.b.example.co.uk", "example.co.uk", "co.uk"), ("a.example.net:80", "example.net", "net"),
                                                ("10.0.0.1", "10.0.0.1", ""), ("localhost", "localhost", "localhost"),
                                                ("u:p@x.y.org", "y.org", "org")])
def test_domains(spark, host, domain, suffix):
    r = spark.createDataFrame([(host,)], "host string").select(U.domain_of(F.col("host")).alias("d")).withColumn(
        "s", U.suffix_of(F.col("d"))).first()
    assert (r.d, r.s) == (domain, suffix)


def _rates(spark, counts):
    outcomes = spark.createDataFrame(counts, "host string, n long, k long")
    return {r.host: r for r in U.reputation(outcomes.select("host"), outcomes).collect()}


@pytest.mark.parametrize("hot", [30, 30_000])
def test_bad_hosts_beside_a_hot_clean_one(spark, hot):
    """The verdict of a fully bad host does not hang on the size of a clean host elsewhere."""
    rng = random.Random(8)
    counts = [(f"www.h{i}.net", 30, sum(rng.random() < 0.24 for _ in range(30))) for i in range(2000)]
    counts += [(f"www.bad{n}.net", n, n) for n in (20, 50, 100, 200)] + [("www.hot.net", hot, 0)]
    got = _rates(spark, counts)
    assert all(got[f"www.bad{n}.net"].bound > U.BLOCK_ABOVE for n in (20, 50, 100, 200))
    assert not any(r.bound > U.BLOCK_ABOVE for h, r in got.items() if "bad" not in h)


def test_lgamma(spark):
    xs = [1e-6, 0.3, 1.0, 7.5, 480.25, 3e4, 1e9]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select(U._lgamma(F.col("x"))).collect()
    assert [r[0] for r in got] == pytest.approx([math.lgamma(x) for x in xs], rel=1e-9, abs=1e-8)
