"""Stratified and written comparisons, their estimability, and case/control programs within groups."""

import pytest

from lociweave.operators import contrasts as C
from lociweave.operators import screens as SC
from lociweave.operators import statistics as ST

SAMPLES = [
    ("s1", "case", "liver", "x"), ("s2", "ctrl ", "liver", "y"), ("s3", " case", "liver", "x"), ("s4", "ctrl", "liver", "x"),
    ("s5", "case", "skin", "x"), ("s6", "ctrl", "skin", "y"), ("s7", "case", "skin", "x"), ("s8", "ctrl", "skin", "y"),
    ("s9", "case", "bone", "x"), ("s10", None, "bone", "x"), ("s11", "other", "skin", "y"), ("s12", "case", None, "x"), ("s13", "ctrl", "", "y"),
]


@pytest.fixture(scope="module")
def samples(spark):
    return spark.createDataFrame(SAMPLES, "sample_id string, state string, tissue string, batch string")


def arms(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.comparison_id, ([], []))["ab".index(r.arm)].append(r.sample_id)
    return {k: (sorted(a), sorted(b)) for k, (a, b) in out.items()}


def test_two_conditions_in_each_stratum(samples):
    got = arms(C.stratified_contrasts(samples, "condition_a_vs_b", "state", ["tissue"], a="case", b="ctrl"))
    assert got == {
        "state=case_vs_ctrl__tissue=liver": (["s1", "s3"], ["s2", "s4"]), "state=case_vs_ctrl__tissue=skin": (["s5", "s7"], ["s6", "s8"]),
        "state=case_vs_ctrl__tissue=": (["s12"], ["s13"]),
    }


def test_rest_and_reference_levels(samples):
    rest = arms(C.stratified_contrasts(samples, "group_vs_rest", "state", ["tissue"], a="case"))
    assert rest["state=case_vs_rest__tissue=skin"] == (["s5", "s7"], ["s11", "s6", "s8"]) and "state=case_vs_rest__tissue=bone" not in rest
    ref = arms(C.stratified_contrasts(samples, "reference_level", "state", ["tissue"], reference="ctrl"))
    assert set(ref) == {f"state={x}_vs_ctrl__tissue={t}" for x, t in (("case", "liver"), ("case", "skin"), ("other", "skin"), ("case", ""))}
    whole = arms(C.stratified_contrasts(samples, "reference_level", "state", reference="ctrl"))
    assert whole["state=other_vs_ctrl"] == (["s11"], ["s13", "s2", "s4", "s6", "s8"])
    two = arms(C.stratified_contrasts(samples, "condition_a_vs_b", "state", ["tissue", "batch"], a="case", b="ctrl"))
    assert two == {"state=case_vs_ctrl__batch=x__tissue=liver": (["s1", "s3"], ["s4"])}
    with pytest.raises(ValueError):
        C.stratified_contrasts(samples, "sideways", "state")


def test_written_comparisons(spark, samples):
    rows = [("c1", None, "case", "ctrl", "skin"), ("c2", "tissue", "skin", "", ""), ("", "state", "case", "ctrl", ""), ("c3", "batch", "x", "y", "liver"), ("c4", "nowhere", "x", "y", "")]
    table = spark.createDataFrame(rows, "comparison_id string, group_column string, group_a string, group_b string, tissue string")
    got = arms(C.comparison_table(table, samples, "state", ["tissue"]))
    assert set(got) == {"c1", "c2", "c3"}
    assert got["c1"] == (["s5", "s7"], ["s6", "s8"]) and got["c3"] == (["s1", "s3", "s4"], ["s2"])
    assert got["c2"] == (["s11", "s5", "s6", "s7", "s8"], ["s1", "s10", "s2", "s3", "s4", "s9"])
    with pytest.raises(ValueError):
        C.comparison_table(table.drop("group_a"), samples)


def test_estimability(spark, samples):
    members = C.stratified_contrasts(samples, "condition_a_vs_b", "state", ["tissue"], a="case", b="ctrl")
    one_arm = members.filter("comparison_id = 'state=case_vs_ctrl__tissue=liver' and arm = 'a'").selectExpr("'alone' as comparison_id", "arm", "sample_id")
    design = ST.design_table(members.unionByName(one_arm), samples, categorical=["batch"])
    got = {r.comparison_id: (r.n_a, r.n_b, r.coefficients, r["rank"], r.estimable) for r in ST.estimability(design).collect()}
    # In skin and in the stratum without a name the batch follows the state.
    assert got["state=case_vs_ctrl__tissue=liver"] == (2, 2, 3, 3, True)
    assert got["state=case_vs_ctrl__tissue=skin"] == (2, 2, 3, 2, False) and not got["state=case_vs_ctrl__tissue="][4]
    assert not got["alone"][4]


def test_estimability_does_not_depend_on_units(spark):
    rows = [("s%d" % i, 1e9 + i * 1e-3, float(i % 2)) for i in range(12)]
    samples = spark.createDataFrame([(s, x, y) for s, x, y in rows], "sample_id string, far double, parity double")
    members = spark.createDataFrame([("c", "a" if i % 3 else "b", f"s{i}") for i in range(12)], "comparison_id string, arm string, sample_id string")
    assert ST.estimability(ST.design_table(members, samples, numeric=["parity"])).first().estimable
    same = spark.createDataFrame([("c", "a" if i % 2 else "b", f"s{i}") for i in range(12)], "comparison_id string, arm string, sample_id string")
    assert not ST.estimability(ST.design_table(same, samples, numeric=["parity"])).first().estimable


def test_case_control_within_groups(spark):
    z = [(f"{g}{i}", d, float(k * i + len(d))) for g, k in (("a", 1), ("b", 3), ("c", 5)) for i in range(6) for d in ("d1", "d22") if (g, i, d) not in {("a", 0, "d22"), ("a", 1, "d22")}]
    groups = [(f"{g}{i}", g) for g in "abc" for i in range(6)] + [("tiny1", "t"), ("tiny2", "t")]
    case = [(f"a{i}", i < 2) for i in range(6)] + [(f"b{i}", i % 2 == 0) for i in range(5)] + [(f"c{i}", True) for i in range(6)] + [("tiny1", True), ("tiny2", False)]
    frames = spark.createDataFrame(z, "sample_id string, drug_id string, z double"), spark.createDataFrame(groups, "sample_id string, group string"), spark.createDataFrame(case, "sample_id string, is_case boolean")
    got = {(r.program, r.drug_id): r.score for r in SC.group_programs(frames[0], frames[1], "case_control_within_group", 5, frames[2]).collect()}
    # d22 has no case in group a; sample b5 has no flag; c has no control.
    assert got == pytest.approx({("a_case_vs_control", "d1"): 0.5 - 3.5, ("b_case_vs_control", "d1"): 0.0, ("b_case_vs_control", "d22"): 0.0})
    audit = {r.group: (r.n_group, r.n_rest, r.n_case, r.n_control, r.reason) for r in SC.program_audit(frames[0], frames[1], 5, frames[2]).collect()}
    assert audit == {"a": (6, 12, 2, 4, ""), "b": (6, 12, 3, 2, ""), "c": (6, 12, 6, 0, "missing_case_or_control")}
    small = {r.group: r.reason for r in SC.program_audit(frames[0], frames[1], 7).collect()}
    assert set(small.values()) == {"min_group_size"}
