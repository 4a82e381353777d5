"""Stratified comparisons with their estimability, and case/control programs within groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.screening import G, Z, _groups, _z
from lociweave.catalog.tables import r6, table
from lociweave.operators import contrasts as C
from lociweave.operators import screens as SC
from lociweave.operators import statistics as ST


def stratified_contrasts(spark, d):
    """Market segments against one of them in every nation; in a third of the nations the batch is the segment itself."""
    batch = F.when(F.col("c_nationkey") % 3 == 0, F.col("c_mktsegment")).otherwise(F.concat(F.lit("b"), F.col("c_custkey") % 2))
    samples = table(spark, d, "customer").select(
        F.col("c_custkey").alias("sample_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"), batch.alias("batch"))
    members = C.stratified_contrasts(samples, "reference_level", "segment", ["nation"], reference="BUILDING")
    return ST.estimability(ST.design_table(members, samples, categorical=["batch"])).select("comparison_id", "n_a", "n_b", "estimable")


SQL_STRATIFIED = """WITH s AS (SELECT c_mktsegment AS seg, c_nationkey AS nation, CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment ELSE 'b' || (c_custkey % 2) END AS batch FROM customer),
c AS (SELECT DISTINCT x.nation, x.seg FROM s x SEMI JOIN (SELECT nation FROM s WHERE seg = 'BUILDING') USING (nation) WHERE x.seg <> 'BUILDING'),
m AS (SELECT c.nation, c.seg, s.batch, s.seg <> 'BUILDING' AS a FROM c JOIN s ON s.nation = c.nation AND s.seg IN (c.seg, 'BUILDING')),
b AS (SELECT nation, seg, batch, count(*) FILTER (a) AS na, count(*) FILTER (NOT a) AS nb FROM m GROUP BY ALL)
SELECT 'segment=' || seg || '_vs_BUILDING__nation=' || nation AS comparison_id, CAST(sum(na) AS BIGINT) AS n_a, CAST(sum(nb) AS BIGINT) AS n_b, bool_or(na > 0 AND nb > 0) AS estimable FROM b GROUP BY nation, seg"""


def _case(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample_id"))
    return s.filter("sample_id % 3 < 2").select("sample_id", (F.col("sample_id") % 3 == 0).alias("is_case"))


def case_control_within_group(spark, d):
    out = SC.group_programs(_z(spark, d), _groups(spark, d), "case_control_within_group", 5, _case(spark, d))
    return out.select("program", "drug_id", r6("score").alias("score"))


SQL_WITHIN = f"""WITH {Z}, {G},
big AS (SELECT grp FROM groups SEMI JOIN z USING (sample_id) GROUP BY 1 HAVING count(*) >= 5 AND bool_or(sample_id % 3 = 0) AND bool_or(sample_id % 3 = 1)),
m AS (SELECT grp, drug_id, avg(z) FILTER (sample_id % 3 = 0) AS a, avg(z) FILTER (sample_id % 3 = 1) AS b FROM z JOIN groups USING (sample_id) SEMI JOIN big USING (grp) GROUP BY ALL)
SELECT grp || '_case_vs_control' AS program, drug_id, round(a - b, 6) AS score FROM m WHERE a IS NOT NULL AND b IS NOT NULL"""


def program_audit(spark, d):
    return SC.program_audit(_z(spark, d), _groups(spark, d), 5, _case(spark, d))


SQL_AUDIT = f"""WITH {Z}, {G}, s AS (SELECT DISTINCT sample_id FROM z), p AS (SELECT grp, count(*) AS n_group, count(*) FILTER (sample_id % 3 = 0) AS n_case, count(*) FILTER (sample_id % 3 = 1) AS n_control
  FROM groups JOIN s USING (sample_id) GROUP BY 1)
SELECT grp AS "group", n_group, (SELECT count(*) FROM s) - n_group AS n_rest, n_case, n_control,
  CASE WHEN n_group < 5 THEN 'min_group_size' WHEN least(n_case, n_control) < 1 THEN 'missing_case_or_control' ELSE '' END AS reason FROM p"""


QUERIES = {
    "stratified_contrasts": (stratified_contrasts, SQL_STRATIFIED),
    "case_control_within_group": (case_control_within_group, SQL_WITHIN),
    "program_audit": (program_audit, SQL_AUDIT),
}
