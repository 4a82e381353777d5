"""Group, condition and expression contrasts, and time-series features."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from lociweave.catalog.tables import part_features, r6, table
from lociweave.operators import contrasts as C
from lociweave.operators import statistics as ST
from lociweave.operators import timeseries as TS


def _cells(spark, d):
    o = table(spark, d, "orders")
    group = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return o.select(F.col("o_orderkey").alias("cell_id"), group.alias("group"), F.col("o_orderstatus").alias("condition"),
                    (F.col("o_custkey") % 50).alias("donor"))


def _entries(spark, d):
    return part_features(spark, d).select(
        F.col("l_orderkey").alias("cell_id"), F.col("p_brand").alias("feature_id"),
        (F.col("l_quantity") - F.when(F.col("l_quantity") < 5, F.col("l_quantity")).otherwise(0.0)).alias("value"),
    )


CE = """cells AS (SELECT o_orderkey AS cell_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS "group",
   o_orderstatus AS condition, o_custkey % 50 AS donor FROM orders),
entries AS (SELECT l_orderkey AS cell_id, p_brand AS feature_id, CASE WHEN l_quantity < 5 THEN 0 ELSE l_quantity END AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def group_summary(spark, d):
    out = None
    for mode in ("sum", "mean", "frac_nonzero"):
        s = C.group_summary(_entries(spark, d), _cells(spark, d), mode)
        s = s.select("group", "feature_id", F.lit(mode).alias("mode"), r6("score").alias("score"))
        out = s if out is None else out.unionByName(s)
    return out


SQL_SUMMARY = f"""WITH {CE}, n AS (SELECT "group", count(*) AS n FROM cells WHERE "group" IS NOT NULL GROUP BY 1),
a AS (SELECT c."group", feature_id, sum(value) AS s, count(*) FILTER (value <> 0) AS z FROM entries JOIN cells c USING (cell_id)
  WHERE c."group" IS NOT NULL GROUP BY ALL),
j AS (SELECT a.*, n FROM a JOIN n USING ("group"))
SELECT "group", feature_id, 'sum' AS mode, round(s, 6) AS score FROM j
UNION ALL SELECT "group", feature_id, 'mean', round(s / n, 6) FROM j
UNION ALL SELECT "group", feature_id, 'frac_nonzero', round(z / CAST(n AS DOUBLE), 6) FROM j"""


def group_vs_rest(spark, d):
    out = C.group_vs_rest(_entries(spark, d), _cells(spark, d), "mean")
    return out.select("group", "feature_id", r6("group_score").alias("group_score"), r6("rest_score").alias("rest_score"),
                      r6(C.contrast_value("group_score", "rest_score", "log2fc", 1.0)).alias("log2fc"))


SQL_VS_REST = f"""WITH {CE}, n AS (SELECT "group", count(*) AS n FROM cells WHERE "group" IS NOT NULL GROUP BY 1),
t AS (SELECT feature_id, sum(value) AS ts FROM entries GROUP BY 1),
a AS (SELECT c."group", feature_id, sum(value) AS s FROM entries JOIN cells c USING (cell_id) WHERE c."group" IS NOT NULL GROUP BY ALL),
x AS (SELECT n."group", t.feature_id, coalesce(s, 0) / n AS g, (ts - coalesce(s, 0)) / ((SELECT count(*) FROM cells) - n) AS r
  FROM t CROSS JOIN n LEFT JOIN a ON a."group" = n."group" AND a.feature_id = t.feature_id)
SELECT "group", feature_id, round(g, 6) AS group_score, round(r, 6) AS rest_score, round(log2((g + 1) / (r + 1)), 6) AS log2fc FROM x"""


def condition_within_group(spark, d):
    out = C.condition_within_group(_entries(spark, d), _cells(spark, d), "O", "F", "frac_nonzero", donor="donor")
    lfc = C.contrast_value("score_a", "score_b", "log2fc", C.default_pseudocount("frac_nonzero"))
    return out.select("group", "feature_id", r6("score_a").alias("score_a"), r6("score_b").alias("score_b"), r6(lfc).alias("log2fc"))


SQL_WITHIN = f"""WITH {CE}, two AS (SELECT * FROM cells WHERE condition IN ('O', 'F') AND "group" IS NOT NULL),
n AS (SELECT "group", count(*) FILTER (condition = 'O') AS na, count(*) FILTER (condition = 'F') AS nb,
  count(DISTINCT CASE WHEN condition = 'O' THEN donor END) AS da, count(DISTINCT CASE WHEN condition = 'F' THEN donor END) AS db,
  count(DISTINCT donor) AS dt FROM two GROUP BY 1 HAVING na + nb >= 100 AND least(na, nb) >= 50 AND least(da, db) >= 3 AND dt >= 3),
a AS (SELECT c."group", feature_id, count(*) FILTER (condition = 'O' AND value <> 0) AS za,
  count(*) FILTER (condition = 'F' AND value <> 0) AS zb FROM entries JOIN two c USING (cell_id) GROUP BY ALL),
x AS (SELECT "group", feature_id, za / CAST(na AS DOUBLE) AS a, zb / CAST(nb AS DOUBLE) AS b FROM a JOIN n USING ("group"))
SELECT "group", feature_id, round(a, 6) AS score_a, round(b, 6) AS score_b, round(log2((a + 1e-3) / (b + 1e-3)), 6) AS log2fc FROM x"""


def open_close_split(spark, d):
    r = C.group_vs_rest(_entries(spark, d), _cells(spark, d), "mean")
    x = r.select("group", "feature_id", C.contrast_value("group_score", "rest_score", "diff").alias("score"))
    return C.open_close(x).select("group", "feature_id", "direction", r6("score").alias("score"))


SQL_OPEN = f"""WITH {CE}, n AS (SELECT "group", count(*) AS n FROM cells WHERE "group" IS NOT NULL GROUP BY 1),
t AS (SELECT feature_id, sum(value) AS ts FROM entries GROUP BY 1),
a AS (SELECT c."group", feature_id, sum(value) AS s FROM entries JOIN cells c USING (cell_id) WHERE c."group" IS NOT NULL GROUP BY ALL),
x AS (SELECT n."group", t.feature_id, coalesce(s, 0) / n - (ts - coalesce(s, 0)) / ((SELECT count(*) FROM cells) - n) AS v
  FROM t CROSS JOIN n LEFT JOIN a ON a."group" = n."group" AND a.feature_id = t.feature_id)
SELECT "group", feature_id, CASE WHEN v > 0 THEN 'OPEN' ELSE 'CLOSE' END AS direction, round(abs(v), 6) AS score FROM x WHERE v <> 0"""


def _samples(spark, d):
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("sample_id"), F.when(F.col("s_nationkey") % 3 == 0, "case").when(
        F.col("s_nationkey") % 3 == 1, "control").otherwise("other").alias("condition"))


def _measures(spark, d):
    return part_features(spark, d).groupBy(F.col("l_suppkey").alias("sample_id"), F.col("p_brand").alias("feature_id")).agg(
        F.avg("l_extendedprice").alias("value"))


SM = """samples AS (SELECT s_suppkey AS sample_id, CASE s_nationkey % 3 WHEN 0 THEN 'case' WHEN 1 THEN 'control' ELSE 'other' END AS condition FROM supplier),
measures AS (SELECT l_suppkey AS sample_id, p_brand AS feature_id, avg(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def _welch_out(spark, d, contrasts):
    m = C.arm_moments(_measures(spark, d), _samples(spark, d), contrasts)
    s = C.two_arm_statistic(m)
    return s.select("contrast_id", "feature_id", "n_a", "n_b", r6("effect", 4).alias("effect"), r6("stat").alias("stat"))


def welch_contrast(spark, d):
    return _welch_out(spark, d, C.level_contrasts(_samples(spark, d), "condition_a_vs_b", "condition", "case", "control"))


SQL_WELCH = f"""WITH {SM}, j AS (SELECT feature_id, condition, value FROM measures JOIN samples USING (sample_id)),
a AS (SELECT feature_id, count(*) FILTER (condition = 'case') AS n_a, count(*) FILTER (condition = 'control') AS n_b,
  avg(value) FILTER (condition = 'case') AS ma, avg(value) FILTER (condition = 'control') AS mb,
  var_samp(value) FILTER (condition = 'case') AS va, var_samp(value) FILTER (condition = 'control') AS vb FROM j GROUP BY 1)
SELECT 'case_vs_control' AS contrast_id, feature_id, n_a, n_b, round(ma - mb, 4) AS effect,
  round((ma - mb) / sqrt(va / n_a + vb / n_b), 6) AS stat FROM a"""


def welch_group_vs_rest(spark, d):
    return _welch_out(spark, d, C.level_contrasts(_samples(spark, d), "group_vs_rest", "condition"))


SQL_WELCH_REST = f"""WITH {SM}, j AS (SELECT t.condition || '_vs_rest' AS contrast_id, feature_id, s.condition = t.condition AS is_a, value
  FROM measures JOIN samples s USING (sample_id), (SELECT DISTINCT condition FROM samples) t),
a AS (SELECT contrast_id, feature_id, count(*) FILTER (is_a) AS n_a, count(*) FILTER (NOT is_a) AS n_b,
  avg(value) FILTER (is_a) AS ma, avg(value) FILTER (NOT is_a) AS mb,
  var_samp(value) FILTER (is_a) AS va, var_samp(value) FILTER (NOT is_a) AS vb FROM j GROUP BY ALL)
SELECT contrast_id, feature_id, n_a, n_b, round(ma - mb, 4) AS effect,
  round((ma - mb) / sqrt(va / n_a + vb / n_b), 6) AS stat FROM a"""


def comparison_audit(spark, d):
    c = C.level_contrasts(_samples(spark, d), "group_vs_rest", "condition")
    s = _samples(spark, d).withColumn("unit", F.col("sample_id") % 7)
    return C.comparison_audit(s, c, "unit").select("contrast_id", "n_a", "n_b", "units_a", "units_b", r6("imbalance").alias("imbalance"))


SQL_AUDIT = f"""WITH {SM}, j AS (SELECT t.condition || '_vs_rest' AS contrast_id, s.condition = t.condition AS is_a, sample_id, sample_id % 7 AS u
  FROM samples s, (SELECT DISTINCT condition FROM samples) t),
a AS (SELECT contrast_id, count(*) FILTER (is_a) AS n_a, count(*) FILTER (NOT is_a) AS n_b,
 count(DISTINCT CASE WHEN is_a THEN u END) AS units_a, count(DISTINCT CASE WHEN NOT is_a THEN u END) AS units_b FROM j GROUP BY 1)
SELECT *, round(greatest(n_a, n_b) / CAST(least(n_a, n_b) AS DOUBLE), 6) AS imbalance FROM a"""


def _counts(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    p = part_features(spark, d)
    return p.join(o, p["l_orderkey"] == o["o_orderkey"]).groupBy(
        F.col("o_custkey").alias("sample_id"), F.col("p_brand").alias("gene_id")
    ).agg(F.sum("l_quantity").alias("value"))


CNT = """counts AS (SELECT o_custkey AS sample_id, p_brand AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
logs AS (SELECT *, value / sum(value) OVER (PARTITION BY sample_id) * 1e6 AS cpm FROM counts)"""


def pseudobulk(spark, d):
    c = _cells(spark, d).filter("group is not null")
    e = _entries(spark, d).withColumnRenamed("feature_id", "gene_id")
    out = ST.pseudobulk(e, c, "donor", ["group"], min_cells=20)
    return out.select("sample_id", "gene_id", "value", "n_cells")


SQL_PSEUDO = f"""WITH {CE}, c AS (SELECT cell_id, 'donor=' || donor || '__group=' || "group" AS sample_id FROM cells WHERE "group" IS NOT NULL),
n AS (SELECT sample_id, count(*) AS n_cells FROM c GROUP BY 1 HAVING count(*) >= 20)
SELECT sample_id, feature_id AS gene_id, CAST(sum(value) AS DOUBLE) AS value, n_cells
FROM entries JOIN c USING (cell_id) JOIN n USING (sample_id) GROUP BY ALL"""


def log_cpm(spark, d):
    return ST.cpm(_counts(spark, d)).select("sample_id", "gene_id", r6("cpm", 4).alias("cpm"), r6("log_cpm").alias("log_cpm"))


SQL_CPM = f"""WITH {CNT} SELECT sample_id, gene_id, round(cpm, 4) AS cpm, round(log2(cpm + 0.5), 6) AS log_cpm FROM logs"""


def _members(spark, d):
    c = table(spark, d, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return c.select(F.lit("building_vs_machinery").alias("comparison_id"), F.when(F.col("c_mktsegment") == "BUILDING", "a").otherwise("b").alias("arm"),
                    F.col("c_custkey").alias("sample_id"))


def expressed_genes(spark, d):
    counts = part_features(spark, d).groupBy(F.col("l_suppkey").alias("sample_id"), F.col("p_brand").alias("gene_id")).agg(
        F.sum("l_quantity").alias("value")
    )
    s = _samples(spark, d).filter("condition <> 'other'")
    m = s.select(F.lit("case_vs_control").alias("comparison_id"), F.when(F.col("condition") == "case", "a").otherwise("b").alias("arm"), "sample_id")
    return ST.expressed_genes(counts, m)


SQL_EXPRESSED = f"""WITH {SM}, counts AS (SELECT l_suppkey AS sample_id, p_brand AS gene_id, sum(l_quantity) AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
logs AS (SELECT *, value / sum(value) OVER (PARTITION BY sample_id) * 1e6 AS cpm FROM counts),
m AS (SELECT CASE condition WHEN 'case' THEN 'a' ELSE 'b' END AS arm, sample_id FROM samples WHERE condition <> 'other'),
need AS (SELECT greatest(2, least(count(*) FILTER (arm = 'a'), count(*) FILTER (arm = 'b'))) AS n FROM m),
h AS (SELECT gene_id, count(*) FILTER (arm = 'a') AS a, count(*) FILTER (arm = 'b') AS b FROM logs JOIN m USING (sample_id) WHERE cpm >= 1 GROUP BY 1)
SELECT 'case_vs_control' AS comparison_id, gene_id FROM h, need WHERE greatest(a, b) >= n"""


def ols_group_effect(spark, d):
    """Two-arm regression of log CPM per brand, no covariates; absent counts are zeros."""
    logs = ST.cpm(_counts(spark, d))
    m = _members(spark, d)
    design = ST.design_table(m, m.select("sample_id"))
    out = ST.ols_group_effect(logs, design)
    return out.select("comparison_id", "gene_id", r6("effect").alias("effect"), r6("stat", 5).alias("stat"), r6("mean_expr").alias("mean_expr"))


SQL_OLS = f"""WITH {CNT}, m AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 1 ELSE 0 END AS g, c_custkey AS sample_id
   FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')),
genes AS (SELECT DISTINCT gene_id FROM logs),
y AS (SELECT genes.gene_id, g, log2(coalesce(cpm, 0) + 0.5) AS y FROM m CROSS JOIN genes LEFT JOIN logs l ON l.sample_id = m.sample_id AND l.gene_id = genes.gene_id),
a AS (SELECT gene_id, count(*) AS n, count(*) FILTER (g = 1) AS n1, count(*) FILTER (g = 0) AS n0,
  avg(y) FILTER (g = 1) AS m1, avg(y) FILTER (g = 0) AS m0, var_pop(y) FILTER (g = 1) AS v1, var_pop(y) FILTER (g = 0) AS v0, avg(y) AS me FROM y GROUP BY 1)
SELECT 'building_vs_machinery' AS comparison_id, gene_id, round(m1 - m0, 6) AS effect,
  round((m1 - m0) / sqrt((1.0 / n1 + 1.0 / n0) * (n1 * v1 + n0 * v0) / (n - 2)), 5) AS stat, round(me, 6) AS mean_expr FROM a"""


def ols_with_covariates(spark, d):
    """The same regression with account balance and nation dummies."""
    logs = ST.cpm(_counts(spark, d))
    m = _members(spark, d)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("sample_id"), (F.col("c_acctbal") / 1000).alias("balance"),
                                           F.col("c_nationkey").alias("nation"))
    out = ST.ols_group_effect(logs, ST.design_table(m, c, ["balance"], ["nation"]))
    return out.withColumn("pvalue", ST.normal_p("stat")).select("comparison_id", "gene_id", r6("effect").alias("effect"), r6("pvalue").alias("pvalue"))


def _trace(spark, d):
    e = table(spark, d, "events")
    ts = F.col("ts").cast("timestamp_ntz")
    t = (F.hour(ts) + F.minute(ts) / 60.0 + (F.dayofmonth(ts) - 1) * 24.0)
    return e.select(F.col("user_id").alias("subject_id"), F.col("event_type").alias("variable"), t.alias("t_hours"),
                    F.col("value"), F.col("event_id"))


TR = """trace AS (SELECT user_id AS subject_id, event_type AS variable,
   hour(ts) + minute(ts) / 60.0 + (day(ts) - 1) * 24.0 AS t_hours, value, event_id FROM events)"""


def subject_features(spark, d):
    f = TS.subject_features(_trace(spark, d))
    cols = ["mean_selected", "sd_selected", "mean_light", "mean_dark", "dark_minus_light"]
    return f.select("subject_id", "variable", "n", *[r6(c).alias(c) for c in cols])


_LIGHT = "((t_hours - 7 + 24) % 24) < 12"
SQL_FEATURES = f"""WITH {TR} SELECT subject_id, variable, count(*) AS n, round(avg(value), 6) AS mean_selected,
  round(stddev_samp(value), 6) AS sd_selected, round(avg(value) FILTER ({_LIGHT}), 6) AS mean_light,
  round(avg(value) FILTER (NOT {_LIGHT}), 6) AS mean_dark,
  round(avg(value) FILTER (NOT {_LIGHT}) - avg(value) FILTER ({_LIGHT}), 6) AS dark_minus_light FROM trace GROUP BY ALL"""


def light_dark(spark, d):
    from lociweave.functions.scalars import in_light

    t = _trace(spark, d).withColumn("light", in_light("t_hours"))
    return t.groupBy("variable", "light").agg(F.count("*").alias("n"), r6(F.avg("value")).alias("mean"))


SQL_LIGHT = f"""WITH {TR} SELECT variable, {_LIGHT} AS light, count(*) AS n, round(avg(value), 6) AS mean FROM trace GROUP BY ALL"""


def trapezoid_auc(spark, d):
    out = TS.trapezoid_auc(_trace(spark, d), ["subject_id", "variable"], tie=["event_id"])
    return out.select("subject_id", "variable", r6("auc").alias("auc"))


SQL_AUC = f"""WITH {TR}, p AS (SELECT *, lag(t_hours) OVER w AS pt, lag(value) OVER w AS pv FROM trace
   WINDOW w AS (PARTITION BY subject_id, variable ORDER BY t_hours, event_id))
SELECT subject_id, variable, round(sum(greatest(0, t_hours - pt) * (value + pv) / 2), 6) AS auc FROM p GROUP BY ALL"""


def harmonic24(spark, d):
    f = TS.subject_features(_trace(spark, d))
    return f.select("subject_id", "variable", r6("amp1").alias("amp1"), r6("phase1_cos").alias("phase1_cos"), r6("phase1_sin").alias("phase1_sin"))


SQL_HARMONIC = f"""WITH {TR}, a AS (SELECT subject_id, variable, count(*) AS n,
  sum(value * cos({math.pi} * 2 / 24 * (t_hours % 24))) * 2 / count(*) AS a, sum(value * sin({math.pi} * 2 / 24 * (t_hours % 24))) * 2 / count(*) AS b FROM trace GROUP BY ALL)
SELECT subject_id, variable, CASE WHEN n >= 3 THEN round(sqrt(a * a + b * b), 6) END AS amp1,
  CASE WHEN n >= 3 THEN round(cos(atan2(b, a)), 6) END AS phase1_cos, CASE WHEN n >= 3 THEN round(sin(atan2(b, a)), 6) END AS phase1_sin FROM a"""


def _subjects(spark, d):
    t = _trace(spark, d)
    s = t.groupBy("subject_id", "variable").agg(F.avg("value").alias("value"))
    cov = t.groupBy("subject_id").agg(F.avg(F.col("t_hours")).alias("mass"))
    return s.join(cov, "subject_id").withColumn("arm", F.when(F.col("subject_id") % 3 == 0, "a").otherwise("b"))


SJ = f"""{TR}, v AS (SELECT subject_id, variable, avg(value) AS value FROM trace GROUP BY ALL),
cv AS (SELECT subject_id, avg(t_hours) AS mass FROM trace GROUP BY 1),
subj AS (SELECT v.*, mass, CASE WHEN subject_id % 3 = 0 THEN 'a' ELSE 'b' END AS arm FROM v JOIN cv USING (subject_id))"""


def std_difference(spark, d):
    return ST.standardized_difference(_subjects(spark, d), ["variable"], "arm", "value").select("variable", "n_a", "n_b", r6("effect").alias("effect"))


SQL_STDDIFF = f"""WITH {SJ}, a AS (SELECT variable, count(*) FILTER (arm = 'a') AS n_a, count(*) FILTER (arm = 'b') AS n_b,
  avg(value) FILTER (arm = 'a') AS ma, avg(value) FILTER (arm = 'b') AS mb, var_pop(value) FILTER (arm = 'a') AS va, var_pop(value) FILTER (arm = 'b') AS vb FROM subj GROUP BY 1)
SELECT variable, n_a, n_b, round((ma - mb) / sqrt((n_a * va + n_b * vb) / (n_a + n_b - 2)), 6) AS effect FROM a"""


def ancova_effect(spark, d):
    out = ST.group_covariate_effect(_subjects(spark, d), ["variable"], "arm", "value", "mass")
    return out.select("variable", "arm", "n_group", "n_rest", "model", r6("effect", 5).alias("effect"))


SQL_ANCOVA = f"""WITH {SJ}, c AS (SELECT *, mass - avg(mass) OVER (PARTITION BY variable) AS x FROM subj),
k AS (SELECT variable, arm, count(*) AS n, avg(x) AS mx, avg(value) AS my, var_pop(x) * count(*) AS sxx,
   covar_pop(x, value) * count(*) AS sxy, var_pop(value) * count(*) AS syy FROM c GROUP BY ALL),
p AS (SELECT g.variable, g.arm, g.n AS n1, r.n AS n0, g.mx AS mx1, r.mx AS mx0, g.my AS my1, r.my AS my0, g.sxx AS sxx1, r.sxx AS sxx0,
   g.sxy AS sxy1, r.sxy AS sxy0, g.syy AS syy1, r.syy AS syy0 FROM k g JOIN k r ON g.variable = r.variable AND g.arm <> r.arm),
q AS (SELECT *, (sxy1 / sxx1 - sxy0 / sxx0) / sqrt((syy1 - sxy1 * sxy1 / sxx1 + syy0 - sxy0 * sxy0 / sxx0) / (n1 + n0 - 4) * (1 / sxx1 + 1 / sxx0)) AS ti,
   (my1 - sxy1 / sxx1 * mx1) - (my0 - sxy0 / sxx0 * mx0) AS at0, (sxy1 + sxy0) / (sxx1 + sxx0) AS b FROM p),
z AS (SELECT *, ((my1 - my0) - b * (mx1 - mx0)) / sqrt((syy1 + syy0 - b * (sxy1 + sxy0)) / (n1 + n0 - 3) * (1.0 / n1 + 1.0 / n0 + (mx1 - mx0) * (mx1 - mx0) / (sxx1 + sxx0))) AS tg FROM q)
SELECT variable, arm, n1 AS n_group, n0 AS n_rest, CASE WHEN abs(ti) > 1.959963984540054 THEN 'interaction' ELSE 'ancova' END AS model,
  round(CASE WHEN abs(ti) > 1.959963984540054 THEN at0 ELSE tg END, 5) AS effect FROM z"""


def protein_residual(spark, d):
    """Residual of line price on quantity without intercept, summed per brand."""
    p = part_features(spark, d).select("p_brand", F.col("l_extendedprice").alias("y"), F.col("l_quantity").alias("x"))
    out = ST.residualize(p, ["p_brand"], "y", "x", "residual")
    return out.groupBy("p_brand").agg(r6(F.sum(F.abs("adjusted")), 2).alias("spread"))


SQL_PROTEIN = """WITH p AS (SELECT p_brand, l_extendedprice AS y, l_quantity AS x FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT p_brand, sum(x * y) / sum(x * x) AS b FROM p GROUP BY 1)
SELECT p_brand, round(sum(abs(y - b * x)), 2) AS spread FROM p JOIN b USING (p_brand) GROUP BY p_brand"""


QUERIES = {
    "group_summary": (group_summary, SQL_SUMMARY),
    "group_vs_rest": (group_vs_rest, SQL_VS_REST),
    "condition_within_group": (condition_within_group, SQL_WITHIN),
    "open_close_split": (open_close_split, SQL_OPEN),
    "welch_contrast": (welch_contrast, SQL_WELCH),
    "welch_group_vs_rest": (welch_group_vs_rest, SQL_WELCH_REST),
    "comparison_audit": (comparison_audit, SQL_AUDIT),
    "pseudobulk": (pseudobulk, SQL_PSEUDO),
    "log_cpm": (log_cpm, SQL_CPM),
    "expressed_genes": (expressed_genes, SQL_EXPRESSED),
    "ols_group_effect": (ols_group_effect, SQL_OLS),
    "ols_with_covariates": (ols_with_covariates, None),
    "subject_features": (subject_features, SQL_FEATURES),
    "light_dark": (light_dark, SQL_LIGHT),
    "trapezoid_auc": (trapezoid_auc, SQL_AUC),
    "harmonic24": (harmonic24, SQL_HARMONIC),
    "std_difference": (std_difference, SQL_STDDIFF),
    "ancova_effect": (ancova_effect, SQL_ANCOVA),
    "protein_residual": (protein_residual, SQL_PROTEIN),
}
