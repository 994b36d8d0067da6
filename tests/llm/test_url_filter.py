"""Rules against plain Python, features against their definitions, verdicts on held-out labels."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from botpulse.llm import url_filter
from botpulse.llm.queries import URL_RULES, op13_urls

DATA = "/root/testdata/sf0.1"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return re.sub("[A-Z]", lambda m: m.group().lower(), host), path


def ruled(url):
    host, path = split(url)
    fits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


ODD = [None, "", "x", "://", "http://", "http://ORG/", "http://É.Example.ORG/es/x", "a://b://c.org/", "http://org?x=/", "http://com/de",
       "http://com/de/", "http://xcom/de/1", "http://a.com:80/de/", "http://a.com/DE/", "http://example.org/en/1", "http://example.org/en/2",
       "http://notexample.org/es/", "http://u@a.org/#/es/", "http://a.org#f?x", "http://a.b.net/p/q.html?x=1&&y=2#z?w=1",
       "http://a.org/\nb", "http://com/fr/" + "x" * 100_000]


def test_hosts_paths_and_rules(spark):
    rows = list(enumerate(ODD)) + [(0, ODD[0]), (None, "http://a.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("x") for c in ("id", "host", "rule", "fold", "row", "decided", "length", "features", "label", "score", "html")})
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in
                  url_filter.url_verdicts(pages, URL_RULES).collect())
    assert got == Counter((i, *split(u), *ruled(u)) for i, u in rows)


def test_rules_alike_and_longest(spark):
    rules = [("block", "a", "/"), ("allow", "a", "/"), ("allow", "a", "/x"), ("block", "b.a", "/x")]
    df = spark.createDataFrame([("a", "/"), ("b.a", "/xy"), ("c.a", "/x"), ("d", "/")], "host string, path string")
    rule, verdict = url_filter.deciding_rule(F.col("host"), F.col("path"), rules)
    assert [tuple(r) for r in df.select(rule, verdict).collect()] == [
        ("a/", "block"), ("b.a/x", "block"), ("a/x", "allow"), (None, None)]


def test_lexical_features(spark):
    rows = [(u or "",) for u in ODD]
    df = spark.createDataFrame(rows, "url string").withColumns(
        {"host": url_filter.host_of(F.col("url")), "path": url_filter.path_of(F.col("url"))})
    for r in df.withColumns(url_filter.lexical_columns(F.col("url"), F.col("host"), F.col("path"))).collect():
        segments, labels = [s for s in r.path.split("/") if s], [s for s in r.host.split(".") if s]
        counts = Counter(r.url)
        bits = -sum(n / len(r.url) * math.log2(n / len(r.url)) for n in counts.values())
        assert math.isclose(r.entropy, bits, abs_tol=1e-9)
        assert (r.length, r.depth, r.labels) == (len(r.url), len(segments), len(labels))
        assert math.isclose(r.digits, sum(c in "0123456789" for c in r.url) / max(1, len(r.url)))
        query = re.match(r"[^?#]*\?([^#]*)", r.url)
        assert r.params == (len([p for p in query.group(1).split("&") if p]) if query else 0)
        assert r.section == (segments[0] if segments else "")
        assert r.last_label == (labels[-1] if labels else "")
        assert r.two_labels == ".".join(["", "", *labels][-2:])


def test_suffix_statistics_leave_out_the_own_fold(spark):
    rnd = random.Random(4)
    urls = [(f"http://h{rnd.randrange(4)}.example.{rnd.choice(['com', 'org', 'net'])}/{rnd.choice(['de', 'fr', 'es'])}/{i}") for i in range(300)]
    df = spark.createDataFrame([(u,) for u in urls], "url string").select(
        "url", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    _, verdict = url_filter.deciding_rule(F.col("host"), F.col("path"), URL_RULES)
    df = df.withColumns({"decided": verdict, "fold": F.pmod(F.xxhash64("url"), F.lit(url_filter.FOLDS)), "row": F.monotonically_increasing_id(),
                         **url_filter.lexical_columns(F.col("url"), F.col("host"), F.col("path"))}).cache()
    rows = df.collect()
    known = [r for r in rows if r.decided]
    overall = (sum(r.decided == "block" for r in known) + 0.5) / (len(known) + 1)
    for r in url_filter.with_suffix_statistics(df).collect():
        for suffix in url_filter.SUFFIXES:
            alike = [x for x in known if x[suffix] == r[suffix] and not (r.decided and x.fold == r.fold)]
            share = (sum(x.decided == "block" for x in alike) + url_filter.PRIOR * overall) / (len(alike) + url_filter.PRIOR)
            assert math.isclose(r[f"{suffix}_blocked"], share)
            assert math.isclose(r[f"{suffix}_pages"], math.log1p(sum(x[suffix] == r[suffix] for x in rows)))


@pytest.mark.parametrize("rules", [[], [("block", "org", "/")]])
def test_without_both_verdicts(spark, rules):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://a.com/"), (3, None)], "page_id long, url string")
    verdicts = {r.verdict for r in url_filter.url_verdicts(pages, rules).collect()}
    assert verdicts == ({"block"} if rules else {"allow"})
    assert url_filter.url_verdicts(pages.limit(0), rules).count() == 0


def test_held_out_labels(spark):
    """Hide a third of the labelled URLs' rules from the training and compare the trees' verdicts with them."""
    pages = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url")
    hidden = (F.pmod(F.xxhash64("url"), F.lit(3)) == 0) & F.col("host").rlike(r"(org|com)$")
    truth = {r.page_id: r.verdict for r in op13_urls(spark, DATA).where("rule IS NOT NULL").collect()}
    url = F.col("url")
    base = pages.select(F.col("page_id").alias("id"), "url", url_filter.host_of(url).alias("host"), url_filter.path_of(url).alias("path"))
    _, verdict = url_filter.deciding_rule(F.col("host"), F.col("path"), URL_RULES)
    base = base.withColumns({"decided": F.when(~hidden, verdict), "fold": F.pmod(F.xxhash64(F.lit(7), "url"), F.lit(url_filter.FOLDS)),
                             "row": F.monotonically_increasing_id(), **url_filter.lexical_columns(url, F.col("host"), F.col("path"))}).cache()
    featured = url_filter.with_suffix_statistics(base).cache()
    trees = url_filter.fitted(url_filter.sampled(featured, 100_000))
    from pyspark.ml.feature import VectorAssembler

    judged = trees.transform(VectorAssembler(inputCols=url_filter.FEATURES, outputCol="features").transform(featured.where("decided IS NULL")))
    pairs = [(truth[r.id], "block" if r.prediction == 1.0 else "allow") for r in judged.select("id", "prediction").collect() if r.id in truth]
    right = sum(a == b for a, b in pairs) / len(pairs)
    common = max(Counter(a for a, _ in pairs).values()) / len(pairs)
    assert len(pairs) > 250 and right >= 0.95 and right > common + 0.1


def test_bounded_sample(spark):
    df = spark.createDataFrame([(f"u{i % 900}", "allow") for i in range(1800)], "url string, decided string")
    assert url_filter.sampled(df, 10_000).count() == 900
    assert 150 < url_filter.sampled(df, 225).count() < 300
