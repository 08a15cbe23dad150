import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lapsewise.llm.queries import URL_RULES
from lapsewise.llm.url_filter import CODE_POINTS, END, START, calibrate, host_and_path, judge_urls, rule_of

SCHEMA = "page_id long, url string, host string, bucket string, window string, verdict int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = next((rest[:k] for k, c in enumerate(rest) if c in "/?#"), rest)
    path = rest[len(host) :]
    path = next((path[:k] for k, c in enumerate(path) if c in "?#"), path)
    return "".join(c.lower() if c.isascii() else c for c in host), path


def decided(host, path):
    fits = []
    for verdict, rule in URL_RULES:
        of, start = rule.split("/", 1)
        if (host == of or host.endswith("." + of)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = ["http://A.Example.ORG/en/1x?q", "https://example.org/es/", "http://badexample.org/es/", "http://org/", "http://org", "x.org/", None, "", "://", "a://b://c/d",
        "http://x.com/fr/#a/b", "http://x.com/FR/", "http://COM/de/y", "http://org.com/en/", "http://é.org/ü", "http://a.b?c://d.org/", "http://x\ny.com/fr/\n"]


def random_urls(n, seed):
    rng = random.Random(seed)
    return [f"http{rng.choice(['', 's'])}://{rng.choice(['', 'm.', 'www.'])}{rng.choice('abc')}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randint(1, 40)}" for _ in range(n)]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), URL_RULES)
    rows = df.select("url", host.alias("host"), path.alias("path")).select("*", rule.alias("rule"), verdict.alias("verdict")).collect()
    for r in rows:
        assert (r.host, r.path) == split(r.url), r.url
        assert (r.rule, r.verdict) == decided(r.host, r.path), r.url


def log_probability(counts, window):
    """Witten-Bell by definition, from the counts of windows."""
    p = 1 / CODE_POINTS
    for k in range(len(window)):
        context = window[len(window) - 1 - k : -1]
        followers = collections.Counter()
        for w, n in counts.items():
            if w[len(w) - 1 - k : -1] == context:
                followers[w[-1]] += n
        followers = {c: n for c, n in followers.items() if n}
        if followers:
            n, t = sum(followers.values()), len(followers)
            p = (followers.get(window[-1], 0) + t * p) / (n + t)
    return math.log(p)


def test_scores_are_those_of_brute_force(spark):
    order = 2
    urls = URLS + random_urls(60, 5) * 2
    rows = [(k, u, "clash", "clash", None, 1) for k, u in enumerate(urls)] + [(None, urls[-1], "", "", "", 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = judge_urls(df, URL_RULES, order=order, bucket_chars=300).toPandas()
    assert len(got) == len(rows)
    halves = spark.createDataFrame([(*split(u),) for u in urls], "h string, p string").select("h", "p", F.pmod(F.xxhash64("h", "p"), F.lit(2)).alias("half"))
    half = {(r.h, r.p): r.half for r in halves.collect()}

    def cut(url):
        padded = START * order + (url or "") + END
        return [padded[k : k + order + 1] for k in range(len(padded) - order)]

    counts = {(v, skip): collections.Counter() for v in ("allow", "block") for skip in (None, 0, 1)}
    for _, url, *_ in rows:
        verdict = decided(*split(url))[1]
        for skip in (None, 0, 1):
            if verdict and half[split(url)] != skip:
                counts[verdict, skip].update(cut(url))
    known = {}
    for _, url, *_ in rows:
        skip = half[split(url)] if decided(*split(url))[1] else None
        if url not in known:
            known[url] = np.mean([log_probability(counts["allow", skip], w) - log_probability(counts["block", skip], w) for w in cut(url)])
    by_id = dict(enumerate(urls)) | {None: urls[-1]}
    for r in got.itertuples():
        url = by_id[None if r.page_id != r.page_id else int(r.page_id)]
        assert (r.host, r.path) == split(url)
        assert r.score == pytest.approx(known[url], abs=1e-9)
        rule, verdict = decided(r.host, r.path)
        assert (r.rule if isinstance(r.rule, str) else None) == rule
        assert r.verdict == (verdict or ("allow" if r.allow_probability >= 0.5 else "block"))


def test_calibration_finds_the_logistic_curve():
    score = np.linspace(-2, 2, 401)
    n = np.full(401, 1000.0)
    p = 1 / (1 + np.exp(-(3 * score - 1)))
    assert calibrate(score, n * p, n * (1 - p)) == pytest.approx((3, -1), abs=1e-3)


def test_urls_of_the_rules_are_told_apart_when_held_out(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = judge_urls(pages, URL_RULES).toPandas()
    assert len(got) == pages.count()
    ruled = got[got.rule.notna()]
    assert ((ruled.allow_probability >= 0.5) == (ruled.verdict == "allow")).mean() > 0.97
    assert got[got.rule.isna()].verdict.nunique() == 2


def test_nothing_to_learn_from_and_empty_tables(spark):
    rows = [(1, "http://x.net/a", "", "", "", 0), (1, "http://x.net/a", "", "", "", 0), (2, "http://y.org/a", "", "", "", 0), (None, None, None, None, None, None)]
    got = judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).select("page_id", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, None, "allow"), (1, None, "allow"), (2, "org/", "allow"), (None, None, "allow")], key=repr)
    assert judge_urls(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
    long = [(k, f"http://x.{tld}/{'ab' * 100_000}", "", "", "", 0) for k, tld in enumerate(["org", "net"])]
    assert [r.verdict for r in judge_urls(spark.createDataFrame(long, SCHEMA), URL_RULES).collect()] == ["allow", "allow"]
