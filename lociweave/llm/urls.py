"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

DataFrame operations only. The labelled table is small (a documented bound);
its n-grams fit one row, so the descent runs inside one expression there: rows
hold their buckets, buckets their rows, and every step updates all weights.
The fitted weights are one array of fixed length, read by all pages as a scalar
subquery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.llm.common import col, table
from lociweave.session import materialize

#: (action, host, path); a rule's name is host and path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Labelled examples: 1 is to be blocked. Hosts that sell, bet or track against ordinary ones.
EXAMPLES = tuple(
    (1, h, p)
    for h in ("spam-farm.example.org", "casino-win.example.net", "cheap-pills.example.net", "free-bets.example.net", "ads-track.example.com", "adult-x.example.com",
              "best-casino.test", "online-casino-bonus.test", "pills4u.test", "cheap-viagra.test", "bet365-free.test", "free-spins-win.test", "xxx-adult-cams.test",
              "track.adserver.test", "ads.clicktrack.test", "spam-links.test", "link-farm-seo.test", "win-big-cash.test")
    for p in ("/en/1", "/de/27/", "/promo?x=1")
) + tuple(
    (0, h, p)
    for h in ("thher.example.org", "m.thretion.example.com", "blog.anthat.example.com", "www.theron.example.org", "blog.thered.example.com", "thenin.example.com",
              "m.there.example.org", "ththing.example.com", "news.stonebridge.test", "library.westfield.test", "www.gardenclub.test", "docs.engine.test",
              "blog.wanderer.test", "history.museum.test", "weather.station.test", "recipes.kitchen.test", "school.northside.test", "forum.cyclists.test")
    for p in ("/en/12", "/fr/825/", "/de/3.html")
)
#: Labelled rows that are used at most, those with the smallest hash.
MAX_EXAMPLES = 2000
BUCKETS = 4096
GRAMS = (3, 4)
STEPS = 120
RATE = 4.0
DECAY = 1e-4
THRESHOLD = 0.5


def parsed(pages: DataFrame, url: str) -> DataFrame:
    """Adds ``host`` and ``path`` (both empty for a null url or one without ``://``)."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(u, "://")
    rest = F.when(at > 0, F.substr(u, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract("_lw_rest", r"^([^/?#]*)", 1)
    staged = pages.withColumn("_lw_rest", rest).withColumn("_lw_host", raw)
    path = F.regexp_extract(F.substr(F.col("_lw_rest"), F.length("_lw_host") + 1), r"^([^?#]*)", 1)
    lower = F.translate("_lw_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return staged.withColumn("host", lower).withColumn("path", path).drop("_lw_rest", "_lw_host")


def rule_of(rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits ``host`` and ``path``, or nulls."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, host, path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, action = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(what)).otherwise(action)
    return name, action


def _hashed(text: Column, tag: str, n: int, width: int) -> Column:
    last = F.length(text) - n + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substr(text, i, F.lit(n))), F.lit(width)).cast("int"))


def buckets(width: int = BUCKETS) -> Column:
    """Hashed n-grams of ``host`` and ``path``, each bucket once; the two are told apart."""
    framed = (("h", F.concat(F.lit("^"), F.col("host"), F.lit("$"))), ("p", F.concat(F.lit("^"), F.col("path"), F.lit("$"))))
    return F.array_distinct(F.concat(*[_hashed(text, tag, n, width) for tag, text in framed for n in GRAMS]))


def fit(examples: DataFrame, width: int = BUCKETS, limit: int = MAX_EXAMPLES) -> DataFrame:
    """One row with ``w``: an array of ``width`` weights and the bias at its end.

    ``examples`` has host, path and y; at most ``limit`` of its distinct rows are used.
    """
    some = examples.select("host", "path", F.col("y").cast("double").alias("y")).distinct().orderBy(F.xxhash64("host", "path", "y"), "host", "path", "y").limit(limit)
    rows = some.withColumn("x", buckets(width)).agg(F.array_sort(F.collect_list(F.struct("host", "path", "y", "x"))).alias("rows"))
    numbered = rows.select("rows", F.transform("rows", lambda r: r["x"]).alias("xs"), F.transform("rows", lambda r: r["y"]).alias("ys"))
    # For every bucket the rows that have it, so that a step is two gathers.
    pairs = numbered.select("xs", "ys", F.posexplode("xs").alias("r", "b")).select("r", F.explode("b").alias("b"))
    holders = pairs.groupBy("b").agg(F.array_sort(F.collect_list("r")).alias("rs")).agg(F.map_from_entries(F.collect_list(F.struct("b", "rs"))).alias("m"))
    full = holders.select(F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda b: F.coalesce(F.element_at("m", b), F.array().cast("array<int>"))).alias("rows_of"))
    one = materialize(numbered.withColumn("rows_of", full.scalar()).select("xs", "ys", "rows_of"))
    n = F.greatest(F.size("ys"), F.lit(1)).cast("double")

    def step(w: Column, _: Column) -> Column:
        margin = lambda x: F.aggregate(x, F.get(w, F.lit(width)), lambda s, b: s + F.get(w, b))
        return F.transform(F.arrays_zip("xs", "ys"), lambda r: (r["ys"] - F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(r["xs"])))) / n)

    def update(w: Column, t: Column) -> Column:
        # The errors are bound once by a one-element array, not computed again for each weight.
        return F.element_at(F.transform(F.array(step(w, t)), lambda e: F.concat(
            F.transform("rows_of", lambda rs, b: F.get(w, b) * (1 - RATE * DECAY) + RATE * F.aggregate(rs, F.lit(0.0), lambda s, r: s + F.get(e, r))),
            F.array(F.get(w, F.lit(width)) + RATE * F.aggregate(e, F.lit(0.0), lambda s, v: s + v)),
        )), 1)

    start = F.array_repeat(F.lit(0.0), width + 1)
    return materialize(one.select(F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, update).alias("w")))


def judged(pages: DataFrame, examples: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, score: a rule's verdict, else the model's.

    Null, empty and odd urls have empty host and path and get the model's
    verdict on those. Repeated rows are judged alike.
    """
    weights = fit(examples)
    rule, action = rule_of(rules)
    rows = parsed(pages.select(col(page_id).alias("page_id"), col(url).alias("_lw_url")), "_lw_url").drop("_lw_url")
    scored = rows.withColumn("_lw_w", weights.scalar())
    margin = F.aggregate(buckets(), F.get("_lw_w", F.lit(BUCKETS)), lambda s, b: s + F.get(F.col("_lw_w"), b))
    out = scored.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).withColumn("rule", rule).withColumn("action", action)
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")


def example_table(spark: SparkSession) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(y).alias("y")) for y, h, p in EXAMPLES])
    return spark.range(1).select(F.inline(rows))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), example_table(spark))


QUERIES = {"op6_url_filter": (op6_url_filter, None)}
