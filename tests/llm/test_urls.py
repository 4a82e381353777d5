import math
import re

import pytest
from pyspark.sql import functions as F

from lociweave.llm import urls
from lociweave.llm.urls import RULES

URLS = [
    "http://ththre.example.com/fr/825?page=2", "https://m.x.example.net/en/25#top", "http://EXAMPLE.net/en/", "http://example.net/de/1", "http://a.example.com/de/", "http://notexample.com/de/",
    "http://x.org/fr/1", "http://x.org/en/1", "http://x.net", "http://x.net?q=1", "http://x.net/", "http://.net/", "http://net/a", "http://subnet/", "no scheme", "", None, "://", "a://b://c/d?e#f",
    "http://Ünï.org/fr/é?x", "http://h#frag/with/slash", "http://h?q=/x://y/z", "http://" + "long" * 4000 + ".com/" + "p" * 9000, "https://spam-farm.example.org/de/7", "https://cheap-pills.example.com/en/3",
    "http://example.net/en", "http://example.net/EN/", "http://user@host.net:80/x",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    return raw.translate({c: c + 32 for c in range(65, 91)}), path


def rule(host, path):
    fits = [(len(h + p), h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@pytest.fixture(scope="module")
def judged(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[1])]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("mine")).withColumn("rule", F.lit(1))
    return pages, urls.judged(df, urls.example_table(spark)).collect()


def test_parts_and_rules(judged):
    pages, rows = judged
    got = sorted(((r.page_id, r.host, r.path, r.rule) for r in rows), key=str)
    want = []
    for i, u in pages:
        h, p = parts(u)
        want.append((i, h, p, rule(h, p)[0]))
    assert got == sorted(want, key=str)
    for r in rows:
        name, action = rule(r.host, r.path)
        assert r.verdict == (action or ("block" if r.score >= urls.THRESHOLD else "allow"))


def test_model_equals_plain_descent(spark, judged):
    ex = urls.example_table(spark).distinct().withColumn("x", urls.buckets()).orderBy("host", "path", "y").collect()
    w, b = [0.0] * urls.BUCKETS, 0.0
    for _ in range(urls.STEPS):
        e = [(r.y - 1 / (1 + math.exp(-(b + sum(w[i] for i in r.x))))) / len(ex) for r in ex]
        w = [v * (1 - urls.RATE * urls.DECAY) for v in w]
        for r, v in zip(ex, e):
            for i in r.x:
                w[i] += urls.RATE * v
        b += urls.RATE * sum(e)
    pages = spark.createDataFrame([(r.page_id, r.host, r.path) for r in judged[1]], "page_id long, host string, path string").withColumn("x", urls.buckets()).collect()
    score = {(r.page_id, r.host): 1 / (1 + math.exp(-(b + sum(w[i] for i in r.x)))) for r in pages}
    assert all(r.score == pytest.approx(score[(r.page_id, r.host)], abs=1e-9) for r in judged[1])


def test_separates_its_examples_and_unseen_hosts(spark):
    seen = [(i, f"http://{h}{p}", y) for i, (y, h, p) in enumerate(urls.EXAMPLES)]
    new = [(500, "http://best-casino-pills.test/x", 1), (501, "http://anthere.example.org/en/9", 0), (502, "http://blog.gardens.test/fr/1", 0), (503, "http://free-win-casino.test/en/4", 1)]
    df = spark.createDataFrame(seen + new, "page_id long, url string, y int")
    rows = {r.page_id: r.score for r in urls.judged(df, urls.example_table(spark)).collect()}
    wrong = [i for i, _, y in seen + new if (rows[i] >= urls.THRESHOLD) != bool(y)]
    assert not wrong


def test_no_pages_and_no_examples(spark):
    df = spark.createDataFrame([(1, "http://x.com/a")], "page_id long, url string")
    none = urls.example_table(spark).limit(0)
    assert urls.judged(df.limit(0), urls.example_table(spark)).count() == 0
    assert [r.score for r in urls.judged(df, none).collect()] == [0.5]
