"""Sliced ordered operators against plain Python, on groups that span several slices."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lociweave.operators import selection as SEL
from lociweave.operators import sliced
from lociweave.operators import statistics as ST


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; values repeat."""
    rng = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", i, float(rng.randrange(40))) for i in range(600)]
    return rows, spark.createDataFrame(rows, "k string, id long, v double").repartition(6)


def by_key(rows):
    out = {}
    for k, i, v in rows:
        out.setdefault(k, []).append((i, v))
    return out


def order():
    return [F.col("v").desc(), F.col("id").asc()]


def test_rank_count(skewed):
    rows, df = skewed
    got = {(r["k"], r["id"]): (r["rank"], r["n"]) for r in sliced.ranked(df, ["k"], order(), count="n").collect()}
    for k, items in by_key(rows).items():
        for n, (i, _) in enumerate(sorted(items, key=lambda x: (-x[1], x[0])), start=1):
            assert got[(k, i)] == (n, len(items))


def test_rank_without_keys(skewed):
    rows, df = skewed
    got = [r["id"] for r in sliced.ranked(df, [], order()).orderBy("rank").collect()]
    assert got == [i for _, i, _ in sorted(rows, key=lambda r: (-r[2], r[1]))]


def test_cumulative(skewed):
    rows, df = skewed
    got = {(r["k"], r["id"]): (r["run"], r["total"]) for r in sliced.cumulative(df, ["k"], order(), "v", "run", "total").collect()}
    for k, items in by_key(rows).items():
        run = 0.0
        for i, v in sorted(items, key=lambda x: (-x[1], x[0])):
            run += v
            assert got[(k, i)] == pytest.approx((run, sum(x for _, x in items)))


def test_previous(skewed):
    rows, df = skewed
    got = {(r["k"], r["id"]): r["prev_id"] for r in sliced.with_previous(df, ["k"], order(), ["id"]).collect()}
    for k, items in by_key(rows).items():
        prev = None
        for i, _ in sorted(items, key=lambda x: (-x[1], x[0])):
            assert got[(k, i)] == prev
            prev = i


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_quantile(skewed, q):
    import numpy as np

    rows, df = skewed
    got = {r["k"]: r["x"] for r in sliced.exact_quantile(df, ["k"], "v", q, "x").collect()}
    for k, items in by_key(rows).items():
        assert got[k] == pytest.approx(float(np.quantile([v for _, v in items], q)))


def test_bh(spark):
    df = spark.createDataFrame([("c", i, p) for i, p in enumerate([0.01, 0.02, 0.20, None])], "k string, id long, pvalue double")
    got = [r["padj"] for r in ST.bh_adjust(df, ["k"]).orderBy("id").collect()]
    assert got[:3] == pytest.approx([0.03, 0.03, 0.20]) and got[3] is None


def test_bh_zero_stays_zero(spark):
    df = spark.createDataFrame([("c", 0, 0.0), ("c", 1, 0.5)], "k string, id long, pvalue double")
    assert [r["padj"] for r in ST.bh_adjust(df, ["k"]).orderBy("id").collect()] == [0.0, 0.5]


def test_robust_z(spark):
    df = spark.createDataFrame([("D1", s, v) for s, v in (("S1", 2.0), ("S2", 1.8), ("S3", 0.2), ("S4", 0.1))], "drug string, s string, value double")
    got = {r["s"]: r["z"] for r in ST.robust_z(df, ["drug"]).collect()}
    assert got["S1"] == pytest.approx(1 / (0.85 + 1e-6))


def test_rank_normal_is_symmetric(spark):
    df = spark.createDataFrame([("g", i, float(i)) for i in range(5)], "k string, id long, v double")
    z = [r["z"] for r in ST.rank_normal(df, ["k"], "v", "id").orderBy("id").collect()]
    assert z[2] == pytest.approx(0.0) and z[0] == pytest.approx(-z[4])
    assert z[4] == pytest.approx(statistics.NormalDist().inv_cdf(0.9))


def test_selection_rules(spark):
    df = spark.createDataFrame([("a", f"g{i}", float(i)) for i in range(10)], "p string, gene_id string, score double")
    assert [r["gene_id"] for r in SEL.select_rows(df, ["p"], "top_k", k=2).orderBy("rank").collect()] == ["g9", "g8"]
    assert SEL.select_rows(df, ["p"], "quantile", q=0.11).count() == 2
    assert SEL.select_rows(df, ["p"], "threshold", min_score=7).count() == 3
    assert SEL.select_rows(df, ["p"], "top_k", k=0).count() == 0
    # Above the map-side limit the sliced ranking takes over; the result is the same.
    assert SEL.top_k(df, ["p"], 5000).count() == 10


def test_top_k_is_nested_and_weights_sum(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([("p", f"g{i:03d}", rng.random() - 0.3) for i in range(300)], "p string, gene_id string, score double")
    sets = {}
    for k in (10, 50, 120):
        w = SEL.select_and_weight(df, ["p"], how="top_k", k=k).collect()
        assert sum(r["weight"] for r in w) == pytest.approx(1.0, abs=1e-9)
        assert sorted(r["rank"] for r in w) == list(range(1, k + 1))
        sets[k] = {r["gene_id"] for r in w}
    assert sets[10] < sets[50] < sets[120]


def test_uniform_weights_when_total_is_zero(spark):
    df = spark.createDataFrame([("p", "a", 0.0), ("p", "b", 0.0)], "p string, gene_id string, score double")
    assert [r["weight"] for r in SEL.within_set_l1(df, ["p"]).collect()] == [0.5, 0.5]


def test_effective_temperature(spark):
    df = spark.createDataFrame([("p", f"g{i}", float(i)) for i in range(20)], "p string, gene_id string, score double")
    t = SEL.temperature_for_effective_n(df, ["p"], 5.0).first()["temperature"]
    w = [r["weight"] for r in SEL.softmax(df, ["p"], t).collect()]
    assert 1 / sum(x * x for x in w) == pytest.approx(5.0, abs=2e-3)


def test_gene_sets(spark):
    rows = [("p", f"g{i}", "SYM" if i < 2 else f"S{i}", float(5 - i)) for i in range(8)]
    df = spark.createDataFrame(rows, "p string, gene_id string, gene_symbol string, score double")
    m = SEL.gene_sets_top_k(df, ["p"], [3], low=2, high=500)
    got = {(r["variant"], r["token"]) for r in m.collect()}
    # Dedupe follows the cut: two rows share SYM. Negative scores form their own set.
    assert got == {("__pos", "SYM"), ("__pos", "S2"), ("__neg", "S7"), ("__neg", "S6")}
    lists = {r["set_name"]: list(r["genes"]) for r in SEL.gene_set_lists(m, ["p", "variant", "k"], F.concat("p", "variant", F.lit("__topk="), "k")).collect()}
    assert lists["p__pos__topk=3"] == ["SYM", "S2"]


def test_mass_cut(spark):
    df = spark.createDataFrame([("p", f"g{i}", v) for i, v in enumerate([5.0, 3.0, 1.0, 1.0])], "p string, gene_id string, score double")
    assert [r["k"] for r in SEL.mass_cut(df, ["p"], 0.8, low=1, high=10).select("k").distinct().collect()] == [2]
