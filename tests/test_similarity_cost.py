"""What similarity queries compute only once."""

import time

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lociweave.catalog import profiles
from lociweave.operators import similarity as SIM


def test_norm_is_computed_once_per_vector(spark):
    d, n = 400, 40
    df = spark.range(n).select("id", F.transform(F.sequence(F.lit(1), F.lit(d)), lambda i: F.sin(i * (F.col("id") + 1.0))).alias("vec"))
    at = time.time()
    got = {r.id: (r.vec, r.u) for r in df.select("id", "vec", SIM.unit("vec", True).alias("u")).collect()}
    assert time.time() - at < 15
    for vec, u in got.values():
        v = np.array(vec) - np.mean(vec)
        assert np.allclose(u, v / np.linalg.norm(v), atol=1e-12)


def test_evidence_and_hubs_are_written(spark):
    found, _, hub = profiles._evidence(spark, "/root/testdata/sf0.001")
    assert not any("embeddings.parquet" in f for f in found.inputFiles() + hub.inputFiles())


def test_bound_loses_no_value():
    r = np.random.default_rng(1)
    for n in (3, 50, 700, 1000):
        x = r.normal(size=(7, n)).round(1)
        x[0, : n // 2] = -np.inf
        x[1] = 1.0
        for k in (1, 5, 20):
            assert (SIM._floor(x, k) <= SIM._kth(x, k)).all()


def test_pairs_are_computed_once_for_a_cut(spark):
    v = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i)]) for i in range(20)], "id long, vec array<double>")
    refs = v.select("id", F.lit(1.0).alias("qc_weight"), F.lit(1.0).alias("hub_score"))
    found = SIM.candidates_by_evidence(v, v.withColumn("factor", F.lit(1.0)), 4, 2.0, exclude_self=True)
    cut = SIM.neighbour_cut(SIM.neighbour_evidence(SIM.polarity_candidates(found), refs, 2.0), 4, 2)
    assert cut._jdf.queryExecution().optimizedPlan().toString().count("CoGroup") == 1


def test_leading_pairs_are_those_of_all_products(monkeypatch):
    monkeypatch.setattr(SIM, "TILE_ROWS", 100)
    r = np.random.default_rng(2)
    q, x = (np.linalg.qr(r.normal(size=(n, n)))[0][:, :16] for n in (150, 700))
    q, x = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (q, x))
    x[:30], x[40], x[41] = q[:30], 0.0, x[42]
    factor = r.permutation(700.0 / (1 + np.arange(700)))
    factor[3], factor[4] = 0.0, np.nan
    ids = np.arange(150), np.arange(700)
    left = pd.DataFrame({"query_id": ids[0], "query_vec": list(q)})
    right = pd.DataFrame({"ref_id": ids[1], "ref_vec": list(x), "factor": factor})
    for k, low, positive, sign, power, least in ((5, -np.inf, False, 1, 1.0, 1.0), (5, 0.4, False, 1, 1.0, 1.0), (900, 0.1, True, 1, 2.0, 1.0), (10, 0.1, True, 1, 2.0, 0.5), (10, 0.2, True, -1, 3.0, 1.0)):
        f = factor if positive else np.ones(700)
        got = SIM._leading_product("query_id long, ref_id long, similarity double", k, True, low, positive, sign, power, least)(left, right.assign(factor=f))
        sim = q @ x.T
        ok = (ids[0][:, None] != ids[1]) & (sign * sim >= low) & ((sign * sim > 0) | (not positive)) & ~np.isnan(f)
        score = np.where(ok, np.sign(sim * sign) * np.abs(sim) ** power * np.nan_to_num(f), -np.inf)
        kth = -np.sort(-score, axis=1)[:, min(k, 700) - 1 : k] * least
        have = np.zeros(sim.shape, bool)
        have[got.query_id, got.ref_id] = True
        assert (have <= ok).all() and (ok & (score >= kth) <= have).all() and not (have & (score < kth - 1e-9)).any()
        assert np.allclose(got.similarity, sim[got.query_id, got.ref_id], atol=1e-14)


def test_a_query_meets_all_blocks_in_one_task(spark, monkeypatch):
    """Rows are k of a query, ties included, not k for each block of references."""
    for name, rows in (("BLOCK_ROWS", 8), ("QUERY_ROWS", 8), ("LEAST_TASKS", 1)):
        monkeypatch.setattr(SIM, name, rows, raising=False)
    v = spark.range(160).select("id", F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.sin(i * (F.col("id") % 10 + 1.0))).alias("vec")).repartition(4)
    found = []
    monkeypatch.setattr(SIM, "top_k", lambda pairs, *a: found.append(pairs.collect()))
    SIM.similar(v, v, k=3, exclude_self=True)
    assert {(p.query_id, p.ref_id) for p in found[0]} == {(i, j) for i in range(160) for j in [j for j in range(160) if j % 10 == i % 10 and j != i][:3]}
    assert len(found[0]) == 160 * 3


def test_text_ids_without_any_pair(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "id string, vec array<double>")
    assert SIM.similar(v, v, k=1, min_similarity=0.5, exclude_self=True).count() == 0
