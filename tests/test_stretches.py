"""Links found where spans and genes of a stretch of positions stand together."""

import random

import pytest
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.plans import accessibility as AX
from lociweave.plans import methylation as ME

SETTINGS = {"upstream": 3, "downstream": 1, "nearest_max": 9, "decay_max": 14, "decay_length": 5.0, "max_genes": 3}


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(4)
    spans = [(r.choice(["1", "chr1", "2", "chr3", None]), at, at + r.choice([0, 1, 2, 7, 30, 90]), r.choice([-2.0, 0.0, 1.0, 3.5, None]))
             for at in (r.randrange(-60, 900) for _ in range(700))] + [("2", 10, 10, 1.0)] * 5 + [("2", None, 20, 1.0)]
    features = spark.createDataFrame(spans, "chrom string, start long, end long, weight double")
    genes = [(r.choice(["1", "2", "chr3", "chr4", None]), r.choice([5, 100, r.randrange(-40, 900)]), r.choice("+-"), f"g{i}", i) for i in range(260)]
    return features, spark.createDataFrame(genes + [("2", 10, "+", "g3", 500)], "chrom string, tss long, strand string, gene_id string, gene_ordinal long")


def scores(df, digits=9):
    # The logarithm of a negative ratio is null.
    found = [(r.program, r.link_method, r.gene_id, r.score if r.score is None else round(r.score, digits) + 0.0) for r in df.collect()]
    assert len(found) == len(set(found)) > 30
    return set(found)


def test_scores_are_those_of_separate_links(tables, monkeypatch):
    features, genes = tables
    grid = [(p, m) for p in ("linked_activity", "promoter_activity", "distal_activity") for m in AX.ALL_LINKS] + [("enhancer_bias", "distance_decay")]
    for some in (grid, [("linked_activity", "nearest_tss")], [("distal_activity", "promoter_overlap"), ("linked_activity", "promoter_overlap")], [("enhancer_bias", "nearest_tss")]):
        got = scores(AX.program_scores(features, genes, grid=some, transform="signed", **SETTINGS))
        with monkeypatch.context() as m:
            m.setattr(AX, "LONG_SPAN", -1)
            want = scores(AX.program_scores(features, genes, grid=some, transform="signed", **SETTINGS))
        assert got == want


def test_spans_and_genes_are_shuffled_once(spark, tables, monkeypatch):
    features, genes = tables

    def written(_):
        raise AssertionError("a table was written")

    monkeypatch.setattr(AX, "materialize", written)
    monkeypatch.setattr(ME, "materialize", written)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = AX.program_scores(features, genes, grid=AX.program_grid(), **SETTINGS)
        plan = s._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Spans, genes, and sums per gene.
    assert plan.count("Exchange hashpartitioning") == 3


def test_a_long_span_is_linked_all_the_same(spark, tables):
    _, genes = tables
    one = spark.createDataFrame([("2", 0, 100_000, 2.0)], "chrom string, start long, end long, weight double")
    got = {r.gene_id: r.score for r in AX.program_scores(one, genes, grid=[("linked_activity", "promoter_overlap")], **SETTINGS).collect()}
    assert got and set(got) <= {r.gene_id for r in genes.filter("chrom = '2'").collect()}
    assert len(got) == genes.filter("chrom = '2' and tss > 0").select("gene_id").distinct().count()


@pytest.mark.parametrize("aggregation", ["weighted_mean", "sum"])
def test_methylation_sums_per_span(tables, monkeypatch, aggregation):
    features, genes = tables
    f = features.withColumn("value", F.coalesce("weight", F.lit(0.5)))
    grid = [*ME.CONNECTABLE, ("linked_activity", "nearest_tss")]
    run = lambda: scores(ME.methylation_programs(f, genes, grid, aggregation=aggregation, transform="abs", select={"how": "none"}, **SETTINGS))
    got = run()
    monkeypatch.setattr(AX, "LONG_SPAN", -1)
    assert got == run()


def test_sums_in_another_order_tie(spark):
    x = [0.1, 0.7, 1e-3, 1 / 3, 11.9]
    a, b = sum(x), sum(reversed(x))
    got = spark.createDataFrame([(a,), (b,), (0.0,), (-1234567.0,), (1e-30,)], "x double").coalesce(1).select(S.significant("x").alias("y")).collect()
    assert got[0].y == got[1].y == pytest.approx(a, rel=1e-11) and got[2].y == 0.0
    assert got[3].y == -1234567.0 and got[4].y == pytest.approx(1e-30, rel=1e-11)
