"""Choices that are made per key, and inputs that must not be cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import contrasts as C
from lociweave.operators import screens as SC
from lociweave.operators import similarity as SIM
from lociweave.operators import sliced
from lociweave.operators import statistics as ST
from lociweave.operators.joins import attach_total
from lociweave.plans import expression as EX
from lociweave.plans import morphology as MO
from lociweave.plans import screens as SX
from lociweave.sources import assays, genomic


def test_null_keys_stay_in_ranks_totals_and_adjustment(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 0.5)], "k string, p double")
    assert sorted((r.k or "", r.r) for r in sliced.ranked(df, ["k"], [F.col("p").asc()], "r").collect()) == [("", 1), ("", 2), ("a", 1)]
    assert sorted((r.k or "", r.t) for r in attach_total(df, ["k"], "p", "t").collect()) == [("", 2.5), ("", 2.5), ("a", 1.0)]
    assert ST.bh_adjust(df.withColumn("p", F.col("p") / 10), ["k"], "p").count() == 3


def test_score_mode_per_comparison(spark):
    rows = [("x", "g1", 2.0, None, None, None), ("x", "g2", None, 1.0, 0.01, None), ("y", "g1", None, 1.0, 0.01, 0.5), ("z", "g1", None, -2.0, None, 0.1), ("w", "g1", None, None, 0.1, None)]
    de = spark.createDataFrame(rows, "c string, gene_id string, stat double, logfc double, padj double, pvalue double")
    got = {(r.c, r.gene_id): round(r.score, 9) for r in EX.comparison_score(de, ["c"]).collect()}
    assert got == {("x", "g1"): 2.0, ("y", "g1"): 2.0, ("z", "g1"): -2.0}


def test_fallback_per_program(spark):
    y = [("s1", "d1", -2.0), ("s1", "d2", -1.0), ("s2", "d1", 1.0), ("s2", "d3", -0.001), ("s3", "d2", -0.5)]
    response = spark.createDataFrame(y, "sample_id string, drug_id string, response double")
    edges = spark.createDataFrame([("d1", "g1", 1.0), ("d2", "g2", 1.0), ("d3", "g3", 1.0)], "drug_id string, gene_id string, weight double")
    got = SX.drug_response_screen(response, edges, kind="per_sample", transform="none", model="sparse_deconvolution", alpha=0.05)
    assert {r.program for r in got.select("program").distinct().collect()} == {"s1", "s2", "s3"}


@pytest.mark.parametrize("local", [True, False])
def test_sparse_fit_meets_its_optimality_conditions(spark, monkeypatch, local):
    r = np.random.default_rng(3)
    x = np.where(r.random((14, 5)) < 0.6, r.random((14, 5)), 0)
    y = r.normal(size=(2, 14))
    edges = spark.createDataFrame([(f"d{i}", f"g{j}", float(x[i, j])) for i in range(14) for j in range(5) if x[i, j]], "drug_id string, gene_id string, x double")
    scores = spark.createDataFrame([(f"p{p}", f"d{i}", float(y[p, i])) for p in range(2) for i in range(14) if (p, i) != (1, 3)], "program string, drug_id string, score double")
    if not local:
        monkeypatch.setattr(SC, "GRAM_GENES", 0)
    got = {(a.program, a.gene_id): a.score for a in SC.sparse_deconvolution(scores, edges, alpha=0.02, tol=1e-9 if local else 1e-3).collect()}
    for p in range(2):
        rows = [i for i in range(14) if (p, i) != (1, 3)]
        b = np.array([got.get((f"p{p}", f"g{j}"), 0.0) for j in range(5)])
        gap = x[rows].T @ (np.maximum(y[p, rows], 0) - x[rows] @ b) - 0.02 * len(rows)
        slack = 1e-6 if local else 5e-2
        assert (np.abs(gap[b > 0]) < slack).all() and (gap[b == 0] < slack).all()


def test_fit_that_does_not_settle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(SC, "GRAM_GENES", 0)
    scores = spark.createDataFrame([("p", "d1", 1.0), ("p", "d2", 2.0)], "program string, drug_id string, score double")
    edges = spark.createDataFrame([("d1", "g1", 1.0), ("d1", "g2", 0.9), ("d2", "g2", 1.0)], "drug_id string, gene_id string, x double")
    with pytest.raises(RuntimeError):
        SC.sparse_deconvolution(scores, edges, iterations=2, tol=1e-12)


def test_moments_of_large_values(spark):
    v = [(f"s{i}", "f", 1e9 + i) for i in range(6)]
    values = spark.createDataFrame(v, "sample_id string, feature_id string, value double")
    samples = spark.createDataFrame([(f"s{i}", f"l{i % 3}") for i in range(6)], "sample_id string, level string")
    contrasts = spark.createDataFrame([("c", "a", "l0"), ("c", "a", "l1"), ("c", "b", "l2")], "contrast_id string, arm string, level string")
    got = {r.arm: (r.n, r.mean, r.m2) for r in C.arm_moments(values, samples, contrasts).collect()}
    assert got["a"] == (4, 1e9 + 2, pytest.approx(10.0)) and got["b"] == (2, 1e9 + 3.5, pytest.approx(4.5))


def test_whole_tables_are_read(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("sample_id\ta.b\ta_b\n" + "".join(f"s{i}\t{'x' if i < 70 else i}\t{'' if i % 2 else 1}\n" for i in range(90)))
    rows = assays.read_profiles(spark, f"{tmp_path}/p.tsv").collect()
    assert sum(r.feature == "a.b" for r in rows) == 20 and sum(r.feature == "a_b" for r in rows) == 45
    (tmp_path / "x.bed").write_text("\t".join(["chr1", "1", "5", *[f"c{i}" for i in range(80)]]) + "\n")
    assert len(genomic.read_bed(spark, f"{tmp_path}/x.bed").first()["columns"]) == 80
    n = 120
    lines = ["id," + "group_names," + ",".join(f"group{i}" for i in range(1, n + 1))]
    lines += [f"m{i}," + f"name{i}," + ",".join(f"m{i}" if j == i else "" for j in range(1, n + 1)) for i in range(1, n + 1)]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    got = {r.subject_id: r.group for r in assays.read_session(spark, f"{tmp_path}/s.csv").collect()}
    assert got == {f"m{i}": f"name{i}" for i in range(1, n + 1)}


def test_calibration_without_and_with_few_controls(spark):
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 5.0])], "id string, vec array<double>")
    assert sorted(map(tuple, SIM.remove_nuisance_axes(v, v.limit(0)).collect())) == sorted(map(tuple, v.collect()))
    few = {r.id: r.vec for r in SIM.remove_nuisance_axes(v, v).collect()}
    assert few == {"a": [-1.0, -1.5], "b": [1.0, 1.5]}


def test_projection_leaves_nothing_on_the_axis(spark):
    r = np.random.default_rng(1)
    controls = r.normal(size=(40, 3)) * np.array([5.0, 1.0, 0.1])
    c = spark.createDataFrame([(f"c{i}", [float(x) for x in row]) for i, row in enumerate(controls)], "id string, vec array<double>")
    out = np.array([x.vec for x in SIM.remove_nuisance_axes(c, c, n_axes=1).collect()])
    assert out.std(0)[0] < 0.5 and out.std(0)[1] > 0.5


def test_weak_similarity_with_strong_evidence_is_found(spark):
    r = np.random.default_rng(2)
    base = r.normal(size=20)
    vec = lambda x: [float(v) for v in x]
    refs = [(f"r{i:03d}", vec(base + r.normal(size=20) * 0.3), 0.001) for i in range(300)] + [("far", vec(base + r.normal(size=20) * 2), 1.0)]
    references = spark.createDataFrame(refs, "id string, vec array<double>, factor double")
    query = spark.createDataFrame([("q", vec(base))], "id string, vec array<double>")
    got = SIM.candidates_by_evidence(query, references, 5, counts=True)
    assert "far" in [x.ref_id for x in got.filter("ref_id is not null").collect()]
    count = got.filter("ref_id is null").agg(F.sum("n_all"), F.sum("n_positive")).first()
    assert tuple(count) == (301, 301)
    opposite = SIM.candidates_by_evidence(query, references.withColumn("vec", F.transform("vec", lambda x: -x)), 5, polarity="opposite")
    assert opposite.count() >= 5


def test_modality_spellings(spark):
    names = ["cmpd", " Compound ", "small_molecule", "overexpression", "crispra", "CRISPRi", "knockout", "genetic", "trt_x", None]
    rows = spark.createDataFrame([(n,) for n in names], "m string").select(MO.modality("m").alias("x")).collect()
    assert [r.x for r in rows] == ["compound"] * 3 + ["orf"] + ["crispr"] * 3 + ["genetic", "trt_x", None]


def test_normal_tail_and_quantile_as_expressions(spark):
    import math
    from statistics import NormalDist

    t = [0.0, 1e-9, 0.3, 0.66, 0.663, 1.0, 1.96, 3.0, 5.6, 5.7, 10.0, 20.0, 37.0, 38.4, 60.0, -2.5, float("inf")]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in t], "t double").coalesce(1).select(ST.normal_p("t")).collect()]
    assert all(g == pytest.approx(math.erfc(abs(x) / math.sqrt(2)), rel=1e-13, abs=1e-300) for g, x in zip(got, t))
    p = [1e-300, 1e-20, 1e-12, 1e-6, 0.01, 0.0749, 0.0751, 0.2, 0.5, 0.7, 0.925, 0.9251, 0.999999]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in p], "p double").coalesce(1).select(ST.normal_quantile("p")).collect()]
    assert all(g == pytest.approx(NormalDist().inv_cdf(x), rel=1e-12, abs=1e-14) for g, x in zip(got, p))
    nulls = spark.createDataFrame([(None,), (float("nan"),)], "t double").select(ST.normal_p("t"), ST.normal_quantile("t")).collect()
    assert all(v is None for r in nulls for v in r)


def test_factors_settle_or_say_so(spark):
    from lociweave.operators import factorization as NMF

    r = np.random.default_rng(4)
    v = r.random((12, 6))
    rows = [(f"c{i}", f"g{j}", float(v[i, j])) for i in range(12) for j in range(6)]
    df = spark.createDataFrame(rows, "cell_id string, gene_id string, value double")
    w, h = NMF.nmf_programs(df, 2, tol=5e-2, check_every=2)
    a = np.array([list(x)[1:] for x in w.orderBy("cell_id").collect()])
    b = np.array([list(x)[1:] for x in h.orderBy("gene_id").collect()])
    order = sorted(range(12), key=lambda i: f"c{i}")
    assert np.linalg.norm(v[order] - a @ b.T) < 1.1 * np.linalg.norm(v - v.mean())
    with pytest.raises(RuntimeError):
        NMF.nmf_programs(df, 2, iterations=2, tol=1e-9, check_every=1)


def test_own_dataset_is_left_out_of_splice_priors(spark):
    from lociweave.plans import splicing as SP

    e = spark.createDataFrame([("e1", "G1", 0.4, 0.001, 1), ("e2", "G2", 0.4, 0.001, 2)], "event_id string, gene_symbol string, delta_psi double, pvalue double, row_ordinal long")
    e = e.withColumns({"gene_id": F.col("gene_symbol"), "event_type": F.lit("SE"), "chrom": F.lit("chr1"), "start": F.col("row_ordinal") * 100, "end": F.col("row_ordinal") * 100 + 50, "strand": F.lit("+")})
    key = SP.canonical_key(e.withColumn("event_group", F.lit(None).cast("string")).withColumn("tool_family", F.lit("generic")).withColumn("event_type", SP.event_type("event_type"))).select("gene_symbol", "record_key")
    prior = key.crossJoin(spark.createDataFrame([("own", 9), ("b", 2), ("c", 2)], "source_dataset string, df_ref int")).filter("gene_symbol = 'G1' or source_dataset = 'own'")
    by = prior.select(F.col("record_key").alias("canonical_event_key"), "source_dataset", F.col("df_ref").cast("long").alias("df_ref"), F.lit(10).cast("long").alias("n_samples_ref"))
    run = lambda **how: {r.gene_id: r.score for r in SP.splice_event_diff(e, select={"how": "none"}, ubiquity_by_dataset=by, **how).collect()}
    without, used = run(dataset="own"), run(dataset="own", own_dataset="ignore")
    assert without["G2"] != used["G2"] or without["G1"] != used["G1"]
    with pytest.raises(ValueError):
        run(dataset="own", own_dataset="fail")
    with pytest.raises(ValueError):
        run(own_dataset="maybe")
