"""Assay operators and plans on small fixtures with hand-derived values."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import contrasts as C
from lociweave.operators import identifiers as ID
from lociweave.operators import priors as P
from lociweave.operators import quality as Q
from lociweave.operators import sampling as SA
from lociweave.operators import scoring as SC
from lociweave.operators import screens as D
from lociweave.operators import segments as SEG
from lociweave.operators import similarity as SIM
from lociweave.operators import statistics as ST
from lociweave.operators import timeseries as TS
from lociweave.plans import calorimetry as CAL
from lociweave.plans import copy_number as CN
from lociweave.plans import expression as EX
from lociweave.plans import morphology as MO
from lociweave.plans import screens as SX
from lociweave.plans import splicing as SP


@pytest.fixture(scope="module")
def deg(spark):
    rows = [
        ("g1", "GENE_POS", 5.5, 0), ("g2", "GENE_NEG", -9.0, 1), ("g2", "GENE_NEG", -1.0, 2), ("g3", "GENE_MID", 3.0, 3),
        ("g4", "MT-CO1", 8.0, 4), ("g5", "RPLP0", 7.0, 5), ("g6", "GENE_WEAK", 0.2, 6),
    ]
    return spark.createDataFrame(rows, "gene_id string, gene_symbol string, stat double, row_ordinal long")


@pytest.mark.parametrize("policy,value", [("sum", -10.0), ("max_abs", -9.0), ("mean", -5.0), ("last", -1.0)])
def test_de_auto_mode_and_duplicates(deg, policy, value):
    got = {r["gene_symbol"]: r["score"] for r in EX.gene_scores(deg, duplicates=policy).collect()}
    assert got == pytest.approx({"GENE_POS": 5.5, "GENE_NEG": value, "GENE_MID": 3.0, "GENE_WEAK": 0.2})


def test_de_score_formulas(spark):
    df = spark.createDataFrame([("a", 2.0, 0.01), ("b", -1.0, 0.0), ("c", 0.0, 0.5)], "gene_id string, logfc double, padj double")
    x = {r["gene_id"]: r["score"] for r in EX.de_score(df, "logfc_times_neglog10p", "padj").collect()}
    assert x == pytest.approx({"a": 4.0, "b": -50.0, "c": 0.0})
    s = {r["gene_id"]: r["score"] for r in EX.de_score(df, "signed_neglog10padj", "padj").collect()}
    assert s == pytest.approx({"a": 2.0, "b": -50.0})  # a zero sign source is unscorable


def test_symbol_promotion(spark):
    df = spark.createDataFrame([("TP53", None), ("MYC", ""), ("KRAS", None), ("EGFR", "EGFR1")], "gene_id string, gene_symbol string")
    assert {r["gene_symbol"] for r in ID.promote_ids_to_symbols(df).collect()} == {"TP53", "MYC", "KRAS", "EGFR1"}
    ens = spark.createDataFrame([(f"ENSG0000000000{i}", None) for i in range(4)], "gene_id string, gene_symbol string")
    assert {r["gene_symbol"] for r in ID.promote_ids_to_symbols(ens).collect()} == {None}


def test_annotation_skips_ambiguous_short_ids(spark):
    genes = spark.createDataFrame([("E1.1", "A", "x"), ("E1.2", "B", "x"), ("E2.1", "C", "y")], "gene_id string, gene_symbol string, gene_biotype string")
    rows = spark.createDataFrame([("E1.1", None), ("E1.9", None), ("E2.7", None), ("E2.1", "own")], "gene_id string, gene_symbol string")
    got = {r["gene_id"]: r["gene_symbol"] for r in ID.annotate_genes(rows, genes).collect()}
    assert got == {"E1.1": "A", "E1.9": None, "E2.7": "C", "E2.1": "own"}


def test_assign_genes(spark):
    df = spark.createDataFrame([(1, "A;B10", "SA"), (2, "C20", None), (3, "", "D"), (4, None, None)], "id long, gene_id string, gene_symbol string")
    rows = {(r["id"], r["gene_id"], r["gene_symbol"], r["gene_fraction"]) for r in ID.assign_genes(df, policy="split_equal").collect()}
    assert rows == {(1, "A", "SA", 0.5), (1, "B10", "B10", 0.5), (2, "C20", "C20", 1.0), (3, "D", "D", 1.0)}
    assert {r["id"] for r in ID.assign_genes(df, policy="drop").collect()} == {2, 3}
    assert {(r["id"], r["gene_id"]) for r in ID.assign_genes(df, policy="first").collect()} == {(1, "A"), (2, "C20"), (3, "D")}


def test_packed_edges_sum_to_one(spark):
    df = spark.createDataFrame([("d1", "A;B, C"), ("d2", "A|A"), ("d3", "bad token!")], "drug_id string, t string")
    got = {(r["drug_id"], r["gene_id"]): r["weight"] for r in ID.packed_edges(df, "drug_id", "t").collect()}
    assert got == pytest.approx({("d1", "A"): 1 / 3, ("d1", "B"): 1 / 3, ("d1", "C"): 1 / 3, ("d2", "A"): 1.0})


def test_harmonize_chrom(spark):
    rows = spark.createDataFrame([("1",), ("chr2",), ("weird",)], "chrom string")
    chroms = spark.createDataFrame([("chr1",), ("2",), ("chr2",)], "chrom string")
    assert sorted(r[0] for r in ID.harmonize_chrom(rows, chroms).collect()) == ["chr1", "chr2"]


def test_group_vs_rest_counts_unassigned_cells(spark):
    e = spark.createDataFrame([("f", "c1", 4.0), ("f", "c2", 2.0), ("f", "c3", 6.0)], "feature_id string, cell_id string, value double")
    cells = spark.createDataFrame([("c1", "A"), ("c2", "B"), ("c3", None), ("c4", "B")], "cell_id string, group string")
    got = {r["group"]: (r["group_score"], r["rest_score"]) for r in C.group_vs_rest(e, cells).collect()}
    assert got == {"A": (4.0, 8.0 / 3), "B": (1.0, 5.0)}


def test_welch_against_direct_formula(spark):
    vals = {"a": [1.0, 2.0, 4.0], "b": [0.0, 1.0], "c": [5.0, 7.0, 6.0]}
    rows = [(f"{g}{i}", "f", v) for g, xs in vals.items() for i, v in enumerate(xs)]
    s = spark.createDataFrame([(f"{g}{i}", g) for g, xs in vals.items() for i in range(len(xs))], "sample_id string, condition string")
    v = spark.createDataFrame(rows, "sample_id string, feature_id string, value double")
    out = C.two_arm_statistic(C.arm_moments(v, s, C.level_contrasts(s, "group_vs_rest", "condition")))
    got = {r["contrast_id"]: r["stat"] for r in out.collect()}
    for g in vals:
        x, y = vals[g], [z for k, zs in vals.items() if k != g for z in zs]
        mean = lambda t: sum(t) / len(t)
        var = lambda t: sum((z - mean(t)) ** 2 for z in t) / (len(t) - 1)
        assert got[f"{g}_vs_rest"] == pytest.approx((mean(x) - mean(y)) / math.sqrt(var(x) / len(x) + var(y) / len(y)))


def test_ols_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    n = 12
    arm = ["a" if i % 2 else "b" for i in range(n)]
    age, batch = rng.normal(size=n), [f"b{i % 3}" for i in range(n)]
    y = rng.normal(size=(n, 2)) + 1.0
    m = spark.createDataFrame([("c", arm[i], f"s{i}") for i in range(n)], "comparison_id string, arm string, sample_id string")
    s = spark.createDataFrame([(f"s{i}", float(age[i]), batch[i]) for i in range(n)], "sample_id string, age double, batch string")
    v = spark.createDataFrame([(f"s{i}", f"g{j}", float(y[i, j])) for i in range(n) for j in range(2)], "sample_id string, gene_id string, log_cpm double")
    got = {r["gene_id"]: (r["effect"], r["stat"]) for r in ST.ols_group_effect(v, ST.design_table(m, s, ["age"], ["batch"])).collect()}
    x = np.column_stack([np.ones(n), [a == "a" for a in arm], age, [b == "b1" for b in batch], [b == "b2" for b in batch]]).astype(float)
    for j in range(2):
        beta, *_ = np.linalg.lstsq(x, y[:, j], rcond=None)
        rss = ((y[:, j] - x @ beta) ** 2).sum()
        se = math.sqrt(np.linalg.pinv(x.T @ x)[1, 1] * rss / (n - 5))
        assert got[f"g{j}"] == pytest.approx((beta[1], beta[1] / se))


def test_covariate_effect_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    n = 16
    g = np.array([1.0 if i % 2 else 0.0 for i in range(n)])
    c = rng.normal(size=n)
    y = 0.5 * g + 2 * c + rng.normal(size=n)
    df = spark.createDataFrame([("f", "a" if g[i] else "b", float(y[i]), float(c[i])) for i in range(n)], "feature string, grp string, value double, mass double")
    row = {r["grp"]: r for r in ST.group_covariate_effect(df, ["feature"], "grp", "value", "mass").collect()}["a"]
    assert row["model"] == "ancova"
    x = np.column_stack([np.ones(n), g, c - c.mean()])
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    s2 = ((y - x @ beta) ** 2).sum() / (n - 3)
    assert row["effect"] == pytest.approx(beta[1] / math.sqrt(s2 * np.linalg.pinv(x.T @ x)[1, 1]))


def test_segment_scores_and_purity(spark):
    genes = spark.createDataFrame([("G1", "chr1", 100, 200), ("G2", "chr1", 150, 350)], "gene_id string, chrom string, gene_start long, gene_end long")
    seg = spark.createDataFrame([("s1", "chr1", 100, 200, 0.5), ("s1", "chr1", 300, 400, -0.05)], "sample_id string, chrom string, start long, end long, amplitude double")
    cfg = SEG.SegmentSettings(length_scale=100.0, aggregation="sum", count_penalty="inv")
    plain = {r["gene_id"]: r["score"] for r in SEG.gene_scores(SEG.segment_links(SEG.correct_segments(seg, cfg), genes, cfg), cfg).collect()}
    assert plain == pytest.approx({"G1": 0.5 * 0.5 * 0.5, "G2": 0.5 * 0.5 * 0.5 * 0.25})
    purity = spark.createDataFrame([("s1", 0.5)], "sample_id string, purity double")
    pure = {r["gene_id"]: r["score"] for r in SEG.gene_scores(SEG.segment_links(SEG.correct_segments(seg, cfg, purity), genes, cfg), cfg).collect()}
    assert pure["G1"] > plain["G1"]
    out = CN.cnv_gene_programs(seg, genes, settings=cfg, select={"how": "none"})
    assert {r["program"] for r in out["programs"].collect()} == {"amp", "abs"}
    assert out["recurrence"].count() == 0  # fewer than five samples


def test_focal_preset_replaces_defaults_only():
    assert SEG.SegmentSettings().preset("focal").length_scale == 2.5e6
    assert SEG.SegmentSettings(length_scale=7.0).preset("focal").length_scale == 7.0


def test_promiscuity_policies(spark):
    e = spark.createDataFrame([("d1", f"g{i}", w) for i, w in enumerate([0.5, 0.3, 0.2])] + [("d2", "g0", 1.0)], "drug_id string, gene_id string, weight double")
    assert D.promiscuity_cap(e, 2, "warn").count() == 4 and D.promiscuity_cap(e, 2, "drop").count() == 1
    capped = {(r["drug_id"], r["gene_id"]): r["weight"] for r in D.promiscuity_cap(e, 2, "cap").collect()}
    assert capped == pytest.approx({("d1", "g0"): 0.625, ("d1", "g1"): 0.375, ("d2", "g0"): 1.0})


def test_sparse_deconvolution_orthogonal(spark):
    """With one drug per gene the solution is a soft threshold of y / x."""
    y = spark.createDataFrame([("p", "d1", 2.0), ("p", "d2", 0.001), ("p", "d3", 1.0)], "program string, drug_id string, score double")
    x = spark.createDataFrame([("d1", "g1", 1.0), ("d2", "g2", 1.0), ("d3", "g3", 1.0)], "drug_id string, gene_id string, x double")
    got = {r["gene_id"]: r["score"] for r in D.sparse_deconvolution(y, x, alpha=0.1, iterations=6).collect()}
    assert got == pytest.approx({"g1": 2.0 - 0.3, "g3": 1.0 - 0.3})


def test_screen_plan_runs_all_programs(spark):
    r = spark.createDataFrame([(f"s{i}", f"d{j}", float(i * j % 5)) for i in range(12) for j in range(6)], "sample_id string, drug_id string, response double")
    g = spark.createDataFrame([(f"s{i}", "A" if i < 6 else "B") for i in range(12)], "sample_id string, group string")
    e = spark.createDataFrame([(f"d{j}", f"g{j % 3}", 1.0) for j in range(6)], "drug_id string, gene_id string, weight double")
    out = SX.drug_response_screen(r, e, g, select={"how": "top_k", "k": 3}).collect()
    assert {x["program"] for x in out} <= {"A_vs_rest", "B_vs_rest"} and out
    for p in {x["program"] for x in out}:
        assert sum(x["weight"] for x in out if x["program"] == p) == pytest.approx(1.0)


def test_collapse_mean_and_sum(spark):
    df = spark.createDataFrame([("k", "g", 1.0, 0.5, 0.2, 0), ("k", "g", 3.0, 0.9, 0.4, 1)], "record_key string, gene_id string, final_score double, quality double, confidence_weight double, row_ordinal long")
    one = lambda p: SC.collapse_best(df, ["record_key", "gene_id"], p, "final_score", "quality", "row_ordinal").first()
    assert one("mean")["final_score"] == 2.0 and one("sum")["final_score"] == 4.0
    assert one("sum")["confidence_weight"] == pytest.approx(0.3) and one("mean")["quality"] == 0.9
    assert one("highest_confidence")["final_score"] == 3.0


def test_diversity_auto_triggers_on_artifact(spark):
    rows = [(f"g{i}", 10.0 - i, "chr1" if i < 9 else "chr2", "chr1:0" if i < 9 else "chr2:0", None) for i in range(10)]
    df = spark.createDataFrame(rows, "gene_id string, score double, chrom string, locus_key string, chromosome_arm string")
    got = {r["gene_id"]: r["diversity_penalty"] for r in P.diversity_penalty(df, [], "auto").collect()}
    assert got["g0"] == 1.0 and got["g1"] == pytest.approx(1 / math.sqrt(2)) and got["g9"] == 1.0
    spread = df.withColumn("locus_key", F.col("gene_id")).withColumn("chrom", F.col("gene_id"))
    assert {r["diversity_penalty"] for r in P.diversity_penalty(spread, [], "auto").collect()} == {1.0}


def test_event_plan_prefers_coherent_support(spark):
    rows = [("c", "e1", "x1", "SE", "A", 0.3, 0.001, 0), ("c", "e2", "x2", "SE", "A", 0.3, 0.001, 1), ("c", "e3", "x3", "SE", "B", 0.3, 0.001, 2), ("c", "e4", "x4", "SE", "B", -0.3, 0.001, 3)]
    df = spark.createDataFrame(rows, "contrast_id string, event_id string, event_group string, event_type string, gene_id string, delta_psi double, pvalue double, row_ordinal long")
    got = {r["gene_id"]: r["score"] for r in SP.splice_event_diff(df, ["contrast_id"], select={"how": "none"}).collect()}
    assert got["A"] > 0 and abs(got["B"]) < 1e-12


def test_event_bundle_and_leave_one_out(spark):
    rows = [("k1", "k1", "high", "ds1", "s1", "G", "e1", 0.5, 20.0, 0), ("k1", "k1", "high", "ds2", "s2", "G", "e1", 0.5, 20.0, 1), ("k2", "k2", "low", "ds1", "s1", "G", "e2", 0.5, 20.0, 2)]
    df = spark.createDataFrame(rows, "input_event_key string, canonical_event_key string, canonicalization_confidence string, source_dataset string, sample_id string, gene_symbol string, event_group string, psi double, read_support double, row_ordinal long")
    by = P.event_ubiquity_by_dataset(df)
    pooled = {r["canonical_event_key"]: r["idf_ref"] for r in P.pool_event_ubiquity(by).collect()}
    assert pooled == pytest.approx({"k1": math.log(1 + 3 / 3), "lowconf::ds1::k2": math.log(1 + 3 / 2)})
    left = {r["canonical_event_key"]: (r["idf_ref"], r["n_datasets_ref"]) for r in P.leave_dataset_out(P.pool_event_ubiquity(by), by, "ds1").collect()}
    assert left["k1"] == pytest.approx((math.log(2.0), 1)) and left["lowconf::ds1::k2"] == (1.0, 0)
    burden = P.gene_burden(P.gene_burden_by_dataset(df)).first()
    assert (burden["n_canonical_events_ref"], burden["n_studies_ref"]) == (3, 2)


def test_time_features_and_auc(spark):
    t = spark.createDataFrame([("s", "feed", h, v) for h, v in ((0.0, 1.0), (8.0, 3.0), (20.0, 5.0))], "subject_id string, variable string, t_hours double, value double")
    f = TS.subject_features(t).first()
    assert (f["mean_light"], f["mean_dark"], f["dark_minus_light"]) == (3.0, 3.0, 0.0)
    a = 2 / 3 * sum(v * math.cos(2 * math.pi * h / 24) for h, v in ((0, 1), (8, 3), (20, 5)))
    b = 2 / 3 * sum(v * math.sin(2 * math.pi * h / 24) for h, v in ((0, 1), (8, 3), (20, 5)))
    assert f["amp1"] == pytest.approx(math.hypot(a, b))
    assert TS.trapezoid_auc(t, ["subject_id", "variable"]).first()["auc"] == pytest.approx(16.0 + 48.0)


def test_exclusions(spark):
    t = spark.createDataFrame([("a", "v", float(h), 1.0) for h in range(5)] + [("b", "v", 1.0, 1.0), ("c", "v", 3.0, 1.0)], "subject_id string, variable string, t_hours double, value double")
    session = spark.createDataFrame([("a", 3.0)], "subject_id string, exc_hour double")
    manual = spark.createDataFrame([("b", None), ("c", 4.0)], "subject_id string, start_hour double")
    got = TS.drop_excluded(t, session, manual)
    assert sorted((r["subject_id"], r["t_hours"]) for r in got.collect()) == [("a", 0.0), ("a", 1.0), ("a", 2.0), ("a", 3.0), ("c", 3.0)]


def test_calorimetry_plans(spark):
    trace = [(f"m{i}", v, float(h), float(h % 5 + i * (2 if i < 3 else 1))) for i in range(6) for v in ("vo2", "rer", "feed") for h in range(24)]
    t = spark.createDataFrame(trace, "subject_id string, variable string, t_hours double, value double")
    session = spark.createDataFrame([(f"m{i}", "ko" if i < 3 else "wt", 20.0 + i) for i in range(6)], "subject_id string, group string, lean_mass double")
    sig = CAL.group_signatures(CAL.subject_table(t, session), session)
    assert {r["contrast_id"] for r in sig.collect()} == {"ko", "wt"}
    templates = spark.createDataFrame([("T1", "global", "rer_mean_selected", 1.0), ("T2", "global", "rer_mean_selected", -1.0)], "term_id string, program string, feature string, weight double")
    edges = spark.createDataFrame([("T1", "A", 1.0), ("T2", "B", 1.0), ("T2", "C", 1.0)], "term_id string, gene_id string, weight double")
    genes = CAL.calr_ontology_mapper(sig, templates, edges, select={"how": "none"})
    by = {(r["contrast_id"], r["gene_id"]) for r in genes.filter("program = 'global'").collect()}
    assert by in ({("ko", "A"), ("wt", "B"), ("wt", "C")}, {("wt", "A"), ("ko", "B"), ("ko", "C")})
    refs = sig.select(F.concat(F.lit("r_"), "contrast_id").alias("id"), "feature", "value")
    meta = spark.createDataFrame([("r_ko", "KO_GENE", 1.0, 0.0), ("r_wt", "WT_GENE", 1.0, 0.0)], "id string, gene_id string, qc_weight double, hub_score double")
    out = CAL.calr_profile_query(sig, refs, meta, select={"how": "none"})
    top = {(r["contrast_id"], r["gene_id"]) for r in out["genes"].filter("rank = 1").collect()}
    assert top == {("ko", "KO_GENE"), ("wt", "WT_GENE")}


def test_similarity_blocks_match_direct(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.normal(size=(40, 5))
    v[3] = 0.0
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(40)], "id long, vec array<double>")
    got = {(r["query_id"], r["ref_id"]): r["similarity"] for r in SIM.similar(df, df, k=3, exclude_self=True).collect()}
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    u = v / np.where(norm > 0, norm, 1)
    s = u @ u.T
    for i in range(40):
        want = sorted((j for j in range(40) if j != i), key=lambda j: (-s[i, j], j))[:3]
        assert [got[(i, j)] for j in want] == pytest.approx([s[i, j] for j in want], abs=1e-9)


def test_blocks_split_when_small(spark, monkeypatch):
    monkeypatch.setattr(SIM, "BLOCK_ROWS", 7)
    df = spark.createDataFrame([(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)], "id long, vec array<double>")
    few = {(r["query_id"], r["ref_id"]) for r in SIM.similar(df, df, min_similarity=0.95).collect()}
    monkeypatch.setattr(SIM, "BLOCK_ROWS", 1000)
    assert few == {(r["query_id"], r["ref_id"]) for r in SIM.similar(df, df, min_similarity=0.95).collect()}


def test_morphology_query_finds_its_target(spark):
    prof = {"ref_a": (1, 0, 0), "ref_b": (0, 1, 0), "ref_c": (0, 0.2, 1), "ctrl": (0.01, 0, 0)}
    long = lambda d: spark.createDataFrame([(k, f"f{i}", float(x)) for k, v in d.items() for i, x in enumerate(v)], "id string, feature string, value double")
    meta = spark.createDataFrame(
        [("ref_a", "compound", None, "cpdA", False, 1.0, 0.1), ("ref_b", "crispr", "GB", None, False, 1.0, 0.2), ("ref_c", "orf", "GC", None, False, 1.0, 0.3), ("ctrl", "compound", None, "dmso", True, 1.0, None)],
        "id string, modality string, gene_symbol string, compound_id string, is_control boolean, qc_weight double, hub_score double",
    )
    targets = spark.createDataFrame([("cpdA", "GA", 1.0)], "compound_id string, gene_id string, weight double")
    for mode in ("direct_target", "mechanism", "hybrid"):
        out = MO.morphology_profile_query(long({"q1": (0.9, 0.1, 0), "q2": (0, 1, 0.1)}), long(prof), meta, targets, mode=mode, select={"how": "none"})
        top = {r["query_id"]: r["gene_id"] for r in out["genes"].filter("rank = 1").collect()}
        assert top == {"q1": "GA", "q2": "GB"}
    assert {r["query_id"] for r in out["confidence"].collect()} == {"q1", "q2"}


def test_fixpoint_needs_a_second_round(spark):
    rows = [("c1", "g1", 5.0), ("c1", "g2", 5.0), ("c2", "g2", 3.0), ("c2", "g3", 3.0), ("c3", "g1", 9.0)]
    df = spark.createDataFrame(rows, "cell_id string, gene_id string, value double")
    got = {(r["cell_id"], r["gene_id"]) for r in SA.fixpoint_filter(df, 6.0, 7.0).collect()}
    # g3 falls first, then c2, then g2 loses its support and c1 keeps only g1, under the cell minimum.
    assert got == {("c3", "g1")}


def test_fixpoint_agrees_with_whole_rounds(spark):
    r = np.random.default_rng(5)
    rows = [(int(c) if c else None, int(g) if g else None, float(v)) for c, g, v in zip(r.integers(0, 60, 400), r.integers(0, 40, 400), r.integers(-1, 9, 400))]
    df = spark.createDataFrame(rows, "cell_id int, gene_id int, value double")

    def whole(left, rounds):
        left = [x for x in left if x[2]]
        for _ in range(rounds):
            for place, least in ((0, 20.0), (1, 35.0)):
                total = {}
                for x in left:
                    total[x[place]] = total.get(x[place], 0.0) + x[2]
                left = [x for x in left if x[place] is not None and total[x[place]] >= least and (place == 0 or total[x[place]] > 0)]
        return sorted(left)

    sizes = set()
    for rounds in (1, 2, 3, 10):
        got = sorted(tuple(x) for x in SA.fixpoint_filter(df, 20.0, 35.0, rounds).collect())
        assert got == whole(rows, rounds)
        sizes.add(len(got))
    assert len(sizes) > 2


def _shuffled(spark):
    """Records written by the shuffles of each stage so far."""
    sc = spark.sparkContext
    none = sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, sc._gateway.new_array(sc._jvm.double, 0), none)
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


def test_fixpoint_adds_up_only_what_may_have_changed(spark):
    chain = [("c", 7, 6.0), ("c", 10, 6.0), ("d", 10, 7.0), ("d", 11, 7.0), ("e", 11, 6.0), ("e", 12, 5.0)]
    df = spark.createDataFrame([(str(c), c % 5, 50.0) for c in range(20_000)] + chain, "cell_id string, gene_id int, value double")

    before = _shuffled(spark)
    assert SA.fixpoint_filter(df, 10.0, 12.0).count() == 20_000
    time.sleep(1)
    # One round adds up all cells; the three that follow touch one cell and one gene each.
    assert 20_000 < sum(n for i, n in _shuffled(spark).items() if i not in before) < 30_000


def test_links_are_not_repeated_for_each_span(spark):
    from lociweave.plans import accessibility as AX

    peaks = spark.createDataFrame([("1", 5000 - i, 5000 + i, 1.0) for i in range(1, 2001)], "chrom string, start long, end long, weight double")
    genes = spark.createDataFrame([("1", 4998 + i, "+", f"g{i}", i) for i in range(5)], "chrom string, tss long, strand string, gene_id string, gene_ordinal long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = _shuffled(spark)
        got = {r.gene_id: r.score for r in AX.program_scores(peaks, genes, grid=[("linked_activity", "distance_decay")], decay_length=1.0).collect()}
        time.sleep(1)
        records = sum(n for i, n in _shuffled(spark).items() if i not in before)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert got == pytest.approx({f"g{i}": 2000 * math.exp(-abs(i - 2)) for i in range(5)})
    assert records < 18_000


def test_hash_sample_is_stable_and_capped(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(100)], "id long, bucket string")
    one = {r["id"] for r in SA.cap_per_bucket(df, ["bucket"], ["id"], 10, seed=1).collect()}
    assert one == {r["id"] for r in SA.cap_per_bucket(df.repartition(5), ["bucket"], ["id"], 10, seed=1).collect()} and len(one) == 20


def test_select_k(spark):
    c = spark.createDataFrame([("r", k, s) for k, s in ((5, 0.9), (6, 1.0), (7, 0.97), (8, 0.98), (9, 0.5))], "run_id string, k long, stability double")
    assert SA.select_k(c).first()["k"] == 8
    assert SA.select_k(c, min_stability=2.0).first()["k"] == 6


def test_validation_tables(spark):
    bad = spark.createDataFrame([("p", "a", 1.0, 1), ("p", "a", None, 2), ("ok", "a", 1.0, 1)], "p string, gene_id string, score double, rank int")
    rows = Q.validate_rows(bad, ["p"]).collect()
    assert [(r["p"], r["repeated_genes"], r["bad_score"]) for r in rows] == [("p", 1, 1)]
    with pytest.raises(ValueError):
        Q.assert_counts(spark.createDataFrame([(1.5,)], "value double"))
