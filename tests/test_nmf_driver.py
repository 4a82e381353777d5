"""What a factorisation sends to the driver, and that both ways of fitting give the same factors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.operators import factorization as NMF


def sent(spark, run):
    """Bytes of task results while ``run`` ran."""
    sc = spark.sparkContext
    empty = sc._jvm.java.util.ArrayList
    stages = lambda: sc._jsc.sc().statusStore().stageList(empty(), False, False, sc._gateway.new_array(sc._jvm.double, 0), empty())
    before = stages()
    last = max((before.apply(i).stageId() for i in range(before.size())), default=-1)
    run()
    after = stages()
    return sum(s.resultSize() for s in (after.apply(i) for i in range(after.size())) if s.stageId() > last)


def table(spark, cells):
    rows = spark.range(cells).select(F.col("id").alias("cell_id"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("g"))
    return rows.select("cell_id", F.concat(F.lit("g"), "g").alias("gene_id"), (F.pmod(F.xxhash64("cell_id", "g"), F.lit(9)) + 1.0).alias("value"))


@pytest.mark.parametrize("most", [NMF.LOADINGS if hasattr(NMF, "LOADINGS") else 0, 0])
def test_driver_gets_no_factor_of_the_cells(spark, monkeypatch, most):
    monkeypatch.setattr(NMF, "LOADINGS", most, raising=False)

    def run(cells):
        df = table(spark, cells)
        with pytest.raises(RuntimeError):
            NMF.nmf_programs(df, 2, iterations=2, tol=1e-12, check_every=5)

    few, many = (sent(spark, lambda n=n: run(n)) for n in (200, 40_000))
    assert many < few + 200_000


def plain(v, w, h, tol, every):
    before = None
    while True:
        for _ in range(every):
            h = h * (v.T @ w) / (h @ (w.T @ w) + 1e-10)
            w = w * (v @ h) / (w @ (h.T @ h) + 1e-10)
        now = ((v - w @ h.T) ** 2).sum()
        if before is not None and before - now <= tol * every * now:
            return w, h
        before = now


@pytest.mark.parametrize("most", [1 << 15, 0])
def test_factors_are_those_of_plain_updates(spark, monkeypatch, most):
    monkeypatch.setattr(NMF, "LOADINGS", most)
    r = np.random.default_rng(5)
    v = r.integers(0, 6, (30, 7)).astype(float)
    v[3], v[4, 1:], v[4, 0] = 0.0, 0.0, 2.0
    rows = [(f"c{i}", j * 10, int(v[i, j])) for i in range(30) for j in range(7)] + [("c1", 20, -5)]
    df = spark.createDataFrame(rows, "cell_id string, gene_id int, value int")
    w, h = NMF.nmf_programs(df, 2, tol=1e-2)
    starts = [NMF._start(df.filter("value > 0"), key, prefix, 2, seed).collect() for key, prefix, seed in (("cell_id", "w", 0), ("gene_id", "h", 1))]
    cells, genes = ({x[0]: x[1:] for x in s} for s in starts)
    names = [f"c{i}" for i in range(30) if i != 3]
    a, b = plain(np.delete(v, 3, 0), np.array([cells[n] for n in names]), np.array([genes[j * 10] for j in range(7)]), 1e-2, 5)
    assert w.columns == ["cell_id", "w0", "w1"] and h.columns == ["gene_id", "h0", "h1"]
    assert h.schema["gene_id"].dataType == df.schema["gene_id"].dataType
    got = {x[0]: x[1:] for x in w.collect()}
    assert sorted(got) == sorted(names) and np.allclose([got[n] for n in names], a, rtol=1e-6, atol=1e-12)
    assert np.allclose([x[1:] for x in h.orderBy("gene_id").collect()], b, rtol=1e-6, atol=1e-12)


@pytest.mark.parametrize("most", [1 << 15, 0])
def test_null_keys_have_no_factor(spark, monkeypatch, most):
    monkeypatch.setattr(NMF, "LOADINGS", most)
    rows = [(c, g, 1.0 + c * g) for c in range(6) for g in range(4)] + [(None, 1, 3.0), (2, None, 4.0), (9, None, 1.0)]
    w, h = NMF.nmf_programs(spark.createDataFrame(rows, "cell_id long, gene_id long, value double"), 2, tol=1e-2)
    assert sorted(x[0] for x in w.collect()) == list(range(6)) and sorted(x[0] for x in h.collect()) == list(range(4))


def test_tables_of_earlier_steps_are_removed(spark, monkeypatch):
    written, removed = [], []
    keep, drop = NMF.materialize, NMF.discard
    monkeypatch.setattr(NMF, "materialize", lambda t: written.append(1) or keep(t))
    monkeypatch.setattr(NMF, "discard", lambda t: removed.append(1) or drop(t))
    NMF.nmf_programs(table(spark, 50), 2, tol=1e-2)
    assert len(written) - len(removed) <= 4


def test_no_entries_give_no_factors(spark):
    w, h = NMF.nmf_programs(table(spark, 5).filter("value < 0"), 2)
    assert w.columns == ["cell_id", "w0", "w1"] and w.count() == h.count() == 0
