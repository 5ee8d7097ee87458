import re

from pyspark.sql import functions as F

from roadflux.llm import urls


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = max((r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])),
               key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


URLS = ["http://a.ORG/x?y#z", "https://example.org/es/1", "http://x.example.org/en/12", "http://x.example.org/en/2", "http://notexample.org/es/", "ftp://q.com/fr/",
        "http://q.com/de/1?/fr/", "http://q.com#/de/", "http://com/de/", "http://org", "http://org/", "http://.org/", None, "", "no scheme", "http://", "http:///path",
        "http://Ä.net/é\n/x", "a://b://c/d", "http://xcom/de/", "http://q.net/de/3", "http://h?x.org/", "http://x.example.org/es"] + [f"http://w{i}.com/de/{i}" for i in range(40)]


def test_rules_against_brute_force(spark):
    frame = spark.createDataFrame([(u, i, 1) for i, u in enumerate(URLS)], "url string, page_id long, host int").repartition(3)
    labelled = urls.decided_by_rules(frame)
    got = {r.page_id: r for r in urls.judge(frame, labelled).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute(u)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), u
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def test_classifier(spark):
    table = [(f"http://{'casino' if i % 2 else 'school'}{i}.net/p", "block" if i % 2 else "allow") for i in range(200)]
    new = [(i, f"http://my{'casino' if i % 2 else 'school'}-{i}.info/q") for i in range(40)]
    done = urls.judge(spark.createDataFrame(new, "page_id long, url string"), spark.createDataFrame(table, "url string, verdict string"))
    assert sum(r.verdict == ("block" if r.page_id % 2 else "allow") for r in done.collect()) >= 38


def test_few_labels(spark):
    pages = spark.createDataFrame([(1, "http://x.net/"), (2, None), (2, None)], "page_id long, url string")
    none = spark.createDataFrame([], "url string, verdict string")
    assert [r.verdict for r in urls.judge(pages, none).collect()] == ["allow"] * 3
    one = spark.createDataFrame([("http://y", "block"), (None, "allow")], "url string, verdict string")
    assert [r.verdict for r in urls.judge(pages, one).collect()] == ["block"] * 3
    assert urls.judge(pages.limit(0), one).count() == 0


def test_ties_between_rules(spark):
    rules = [("org", "/xyz", "block"), ("a.org", "/x", "allow"), ("b.net", "/", "block"), ("b.net", "/", "allow")]
    frame = spark.createDataFrame([(1, "http://a.org/xyz"), (2, "http://q.b.net/1")], "page_id long, url string")
    for given in (rules, rules[1::-1] + rules[2:]):
        done = {r.page_id: (r.rule, r.verdict) for r in urls.judge(frame, urls.decided_by_rules(frame, given), given).collect()}
        assert done == {1: ("a.org/x", "allow"), 2: ("b.net/", "block")}


def test_columns_of_the_caller_stay(spark):
    own = ["__host", "__url", "grams", "features", "c0", "guess", "block"]
    frame = spark.createDataFrame([(u, *own) for u in URLS], ["url", *own])
    done = urls.judge(frame, urls.decided_by_rules(frame))
    assert done.columns == ["url", *own, "host", "path", "rule", "verdict"]
    assert {tuple(r)[1:8] for r in done.collect()} == {tuple(own)}


def test_held_out_accuracy(spark, sf_dir):
    """The method alone on URLs whose verdict is known but was not learned."""
    pages = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/pages.parquet")
    known = urls.decided_by_rules(pages).distinct()
    held_out = F.pmod(F.xxhash64("url", F.lit(1)), F.lit(2)) == 0
    done = urls.judge(known.where(held_out).withColumnRenamed("verdict", "truth"), known.where(~held_out), rules=())
    right, n = done.agg(F.avg((F.col("truth") == F.col("verdict")).cast("int")), F.count("*")).first()
    assert n > 100 and right >= 0.95
