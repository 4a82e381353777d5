"""Interval, nearest, decay and linked-score operators on small fixtures and against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lociweave.operators import intervals as I
from lociweave.operators import scoring as SC
from lociweave.plans import accessibility as AX


@pytest.fixture(scope="module")
def genes(spark):
    rows = [("GENE1", "G1", "chr1", 1000, "+", 1000, 2000, 0), ("GENE2", "G2", "chr1", 6199, "-", 5000, 6200, 1)]
    return spark.createDataFrame(rows, "gene_id string, gene_symbol string, chrom string, tss long, strand string, gene_start long, gene_end long, gene_ordinal long")


@pytest.fixture(scope="module")
def peaks(spark):
    rows = [("p1", "chr1", 900, 1100, 2.0), ("p2", "chr1", 1800, 1900, -1.5), ("p3", "chr1", 6000, 6100, 3.0)]
    return spark.createDataFrame(rows, "name string, chrom string, start long, end long, weight double").withColumn(
        "centre", F.floor((F.col("start") + F.col("end")) / 2).cast("long")
    )


def test_nearest_links(peaks, genes):
    links = peaks.join(I.nearest_links(peaks, genes, 10_000), ["chrom", "centre"])
    got = {r["name"]: (r["gene_id"], r["distance"]) for r in links.collect()}
    assert got == {"p1": ("GENE1", 0), "p2": ("GENE1", 850), "p3": ("GENE2", 149)}


def test_promoter_links(peaks, genes):
    p = {r["gene_id"]: (r["r_start"], r["r_end"]) for r in I.promoters(genes, 300, 100).collect()}
    assert p == {"GENE1": (700, 1100), "GENE2": (6099, 6499)}
    links = peaks.join(I.promoter_links(peaks, genes, 300, 100), ["chrom", "start", "end"])
    assert {(r["name"], r["gene_id"]) for r in links.collect()} == {("p1", "GENE1"), ("p3", "GENE2")}


@pytest.mark.parametrize("mode,want", [("positive", {"GENE1": 2.0, "GENE2": 3.0}), ("signed", {"GENE1": 0.5, "GENE2": 3.0})])
def test_linked_score(peaks, genes, mode, want):
    links = I.nearest_links(peaks, genes, 10_000)
    got = {r["gene_id"]: r["score"] for r in SC.linked_score(peaks, links, ["chrom", "centre"], transform=mode).collect()}
    assert got == pytest.approx(want)


def test_reference_idf(spark, peaks):
    refs = spark.createDataFrame([("chr1", 850, 1150, 2.0), ("chr1", 1700, 2000, 0.5), ("chr1", 5900, 6200, 3.0)], "chrom string, start long, end long, idf_ref double")
    got = {r["name"]: r["idf"] for r in I.overlap_max(peaks, refs, "idf_ref", "idf").collect()}
    assert got == {"p1": 2.0, "p2": 1.0, "p3": 3.0}


def test_external_links(spark, peaks):
    t = spark.createDataFrame(
        [("chr1", 850, 1200, "GENE1", 1.0), ("chr1", 1700, 2000, "GENE1", 0.5), ("chr1", 1700, 2000, "GENE2", 0.25), ("chr1", 5900, 6200, "GENE2", 1.0)],
        "chrom string, start long, end long, gene_id string, link_weight double",
    )
    got = {(r["name"], r["gene_id"], r["link_weight"]) for r in peaks.join(I.external_links(peaks, t), ["chrom", "start", "end"]).collect()}
    assert got == {("p1", "GENE1", 1.0), ("p2", "GENE1", 0.5), ("p2", "GENE2", 0.25), ("p3", "GENE2", 1.0)}


def _random_intervals(rng, n, chroms=2, span=20_000):
    out = []
    for i in range(n):
        length = rng.choice([0, 1, 3, 100, 128, 129, 1024, 5000, 18_000])
        s = rng.randrange(span)
        out.append((f"c{rng.randrange(chroms)}", s, s + length, i))
    return out


def test_overlap_pairs_match_brute_force(spark):
    rng = random.Random(3)
    a, b = _random_intervals(rng, 150), _random_intervals(rng, 150)
    left = spark.createDataFrame(a, "chrom string, l_start long, l_end long, a long")
    right = spark.createDataFrame(b, "chrom string, r_start long, r_end long, b long")
    got = sorted((r["a"], r["b"]) for r in I.overlap_pairs(left, right, ["chrom"]).collect())
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    assert got == want


def _nearest(c, anchors):
    after = [g for g in anchors if g[1] >= c]
    before = [g for g in anchors if g[1] < c]
    best = None
    if after:
        t = min(g[1] for g in after)
        best = (t - c, 0, min(g[2] for g in after if g[1] == t))
    if before:
        t = max(g[1] for g in before)
        cand = (c - t, 1, max(g[2] for g in before if g[1] == t))
        best = cand if best is None else min(best, cand, key=lambda x: (x[0], x[1]))
    return best


@pytest.mark.parametrize("bits", [3, 16])
def test_nearest_matches_brute_force(spark, bits):
    rng = random.Random(5)
    anchors = [("c0", rng.randrange(0, 400) * 2, i) for i in range(60)]
    centres = sorted({rng.randrange(-20, 900) for _ in range(200)})
    ga = spark.createDataFrame([(c, p, f"g{i}", i) for c, p, i in anchors], "chrom string, tss long, gene_id string, gene_ordinal long")
    gc = spark.createDataFrame([("c0", x) for x in centres], "chrom string, centre long")
    got = {r["centre"]: (r["distance"], r["gene_id"]) for r in I.nearest_links(gc, ga, None, cell_bits=bits).collect()}
    want = {c: (_nearest(c, anchors)[0], f"g{_nearest(c, anchors)[2]}") for c in centres}
    assert got == want


def test_decay_limits_and_weights(spark):
    anchors = spark.createDataFrame([("c", 100 + i, f"g{i:02d}", i) for i in range(12)], "chrom string, tss long, gene_id string, gene_ordinal long")
    centre = spark.createDataFrame([("c", 100)], "chrom string, centre long")
    rows = I.decay_links(centre, anchors, 8, 4.0, 3).orderBy("distance").collect()
    assert [r["gene_id"] for r in rows] == ["g00", "g01", "g02"]
    assert [r["link_weight"] for r in rows] == pytest.approx([1.0, math.exp(-0.25), math.exp(-0.5)])
    flat = I.decay_links(centre, anchors, 8, 0.0, 3).collect()
    assert sorted(r["gene_id"] for r in flat) == ["g00", "g01", "g02"] and all(r["link_weight"] == 0.0 for r in flat)


def test_segment_overlap_fraction(spark, genes):
    seg = spark.createDataFrame([("chr1", 1500, 5600)], "chrom string, start long, end long")
    got = {r["gene_id"]: (r["overlap_fraction"], r["n_genes"]) for r in I.segment_gene_overlaps(seg, genes).collect()}
    assert got == {"GENE1": (0.5, 2), "GENE2": (0.5, 2)}


def test_program_grid_and_masks(peaks, genes):
    assert AX.program_grid() == [("linked_activity", "nearest_tss"), ("distal_activity", "distance_decay")]
    assert AX.program_grid("qc") == [("promoter_activity", "promoter_overlap")]
    s = AX.program_scores(peaks, genes, grid=[("promoter_activity", "nearest_tss"), ("distal_activity", "nearest_tss"), ("linked_activity", "nearest_tss")],
                          transform="abs", upstream=300, downstream=100, nearest_max=10_000)
    got = {(r["program"], r["gene_id"]): r["score"] for r in s.collect()}
    assert got == {
        ("promoter_activity", "GENE1"): 2.0, ("promoter_activity", "GENE2"): 3.0, ("distal_activity", "GENE1"): 1.5,
        ("linked_activity", "GENE1"): 3.5, ("linked_activity", "GENE2"): 3.0,
    }
