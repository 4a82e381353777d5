"""The factorisation query keeps the operator's own stopping rule."""

import inspect

from lociweave.catalog import assays


def test_query_runs_to_the_default_tolerance(spark, monkeypatch):
    run, rule, seen = assays.NMF.nmf_programs, inspect.signature(assays.NMF.nmf_programs), {}

    def spy(*args, **kwargs):
        bound = rule.bind(*args, **kwargs)
        bound.apply_defaults()
        seen.update(bound.arguments)
        return None, spark.createDataFrame([("g", 1.0, 2.0, 3.0)], "gene_id string, h0 double, h1 double, h2 double")

    monkeypatch.setattr(assays.NMF, "nmf_programs", spy)
    assert assays.nmf_programs(spark, "/root/testdata/sf0.001").count() == 3
    for name in ("iterations", "tol", "check_every"):
        assert seen[name] == inspect.signature(run).parameters[name].default
