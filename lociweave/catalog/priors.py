"""Site and event bindings: confidence, collapse, penalties and reference priors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import part_features, r6, table
from lociweave.operators import priors as P
from lociweave.operators import scoring as SC


def _events(spark, d):
    """Event = (order, part), gene = brand, locus = supplier nation, score from price and quantity."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    p = part_features(spark, d)
    return p.join(s, p["l_suppkey"] == s["s_suppkey"]).select(
        F.concat_ws(":", "l_orderkey", "l_partkey").alias("record_key"), F.col("p_brand").alias("gene_id"),
        F.concat_ws(":", "p_type", "l_linenumber").alias("event_group"),
        ((F.col("l_extendedprice") - 30000.0) / 1000.0).alias("final_score"), F.col("l_quantity").alias("quality"),
        (F.col("l_orderkey") * 1000003 + F.col("l_suppkey") * 101 + F.col("l_linenumber")).alias("row_ordinal"),
        F.col("l_discount").alias("delta"), (F.col("l_tax") / 2 + 0.01).alias("pvalue"), F.col("s_nationkey").alias("nation"),
        F.col("l_returnflag").alias("program"), F.col("l_suppkey"),
    )


EV = """ev AS (SELECT l_orderkey || ':' || l_partkey AS record_key, p_brand AS gene_id, p_type || ':' || l_linenumber AS event_group,
  (l_extendedprice - 30000.0) / 1000.0 AS final_score, l_quantity AS quality, l_orderkey * 1000003 + l_suppkey * 101 + l_linenumber AS row_ordinal,
  l_discount AS delta, l_tax / 2 + 0.01 AS pvalue, s_nationkey AS nation, l_returnflag AS program, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


def _collapse(policy):
    def run(spark, d):
        e = _events(spark, d).select("record_key", "gene_id", "final_score", "quality", "row_ordinal")
        out = SC.collapse_best(e, ["record_key", "gene_id"], policy, "final_score", "quality", "row_ordinal")
        # Averages of several rows are rounded by policy, single rows keep their value.
        return out.select("record_key", "gene_id", r6("final_score", 7).alias("final_score"), "quality")

    return run


def _collapse_sql(policy):
    if policy == "sum":
        return f"WITH {EV} SELECT record_key, gene_id, round(sum(final_score), 7) AS final_score, max(quality) AS quality FROM ev GROUP BY ALL"
    order = "quality DESC, abs(final_score) DESC" if policy == "highest_confidence" else "abs(final_score) DESC, quality DESC"
    return f"""WITH {EV} SELECT record_key, gene_id, round(final_score, 7) AS final_score, quality FROM ev
QUALIFY row_number() OVER (PARTITION BY record_key, gene_id ORDER BY {order}, row_ordinal) = 1"""


def topk_mean(spark, d):
    out = SC.records_to_gene(_events(spark, d), ["program"], "signed_topk_mean", 3)
    return out.select("program", "gene_id", r6("score").alias("score"))


SQL_TOPK = f"""WITH {EV}, r AS (SELECT *, row_number() OVER (PARTITION BY program, gene_id ORDER BY abs(final_score) DESC, record_key) AS rk FROM ev)
SELECT program, gene_id, round(avg(final_score), 6) AS score FROM r WHERE rk <= 3 GROUP BY ALL"""


def event_group_collapse(spark, d):
    out = P.collapse_event_groups(_events(spark, d), ["program"])
    return out.select("program", "gene_id", "event_group", r6("final_score", 7).alias("final_score"))


SQL_GROUPS = f"""WITH {EV} SELECT program, gene_id, event_group, round(final_score, 7) AS final_score FROM ev
QUALIFY row_number() OVER (PARTITION BY program, gene_id, event_group ORDER BY abs(final_score) DESC, quality DESC, row_ordinal) = 1"""


def _gene_scores(spark, d):
    e = _events(spark, d)
    return e, SC.records_to_gene(e, ["l_suppkey"], "signed_topk_mean", 3)


GS = f"""{EV}, r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, gene_id ORDER BY abs(final_score) DESC, record_key, row_ordinal) AS rk FROM ev),
top AS (SELECT * FROM r WHERE rk <= 3),
gs AS (SELECT l_suppkey, gene_id, avg(final_score) AS score FROM top GROUP BY ALL)"""


def support_penalty(spark, d):
    e, g = _gene_scores(spark, d)
    out = P.support_penalty(e, g, ["l_suppkey"])
    return out.select("l_suppkey", "gene_id", "n_groups", r6("support_penalty").alias("support_penalty"), r6("score").alias("score"))


SQL_SUPPORT = f"""WITH {GS}, s AS (SELECT l_suppkey, gene_id, count(DISTINCT event_group) AS n_groups, abs(sum(final_score)) / sum(abs(final_score)) AS c FROM top GROUP BY ALL),
p AS (SELECT *, greatest(0.55, least(1.0, CASE WHEN n_groups >= 2 THEN 1.0 ELSE 0.85 END * (0.75 + 0.25 * c))) AS pen FROM s)
SELECT l_suppkey, gene_id, n_groups, round(pen, 6) AS support_penalty, round(score * pen, 6) AS score FROM gs JOIN p USING (l_suppkey, gene_id)"""


def burden_penalty(spark, d):
    """Burden of a brand taken from the reference counts of the other return flags."""
    e = _events(spark, d)
    s = SC.records_to_gene(e, ["program"], "sum")
    cur = e.groupBy("program", "gene_id").agg(F.countDistinct("event_group").alias("n_groups_input"))
    ref = e.groupBy("gene_id").agg(F.countDistinct("event_group").alias("g"), F.countDistinct("program").alias("n"))
    bundle = ref.filter("gene_id <> 'Brand#1'").select(
        F.col("gene_id").alias("gene_symbol"), F.col("g").alias("n_unique_event_groups_ref"), F.col("g").alias("n_canonical_events_ref"),
        F.col("n").alias("n_studies_ref"), F.col("n").alias("n_studies_high_confidence_ref"), (F.col("g") / 2).alias("median_unique_groups_per_study"),
    )
    out = P.burden_penalty(s.withColumn("gene_symbol", F.col("gene_id")), cur, ["program"], bundle)
    return out.select("program", "gene_id", r6("burden_penalty").alias("burden_penalty"), r6("score", 4).alias("score"))


SQL_BURDEN = f"""WITH {EV}, s AS (SELECT program, gene_id, sum(final_score) AS score, count(DISTINCT event_group) AS own FROM ev GROUP BY ALL),
ref AS (SELECT gene_id, count(DISTINCT event_group) AS g, count(DISTINCT program) AS n FROM ev WHERE gene_id <> 'Brand#1' GROUP BY 1),
b AS (SELECT s.*, CASE WHEN g IS NULL THEN own ELSE greatest(1, round_even(greatest(g, g / 2 * sqrt(greatest(1, n))), 0)) END AS b FROM s LEFT JOIN ref USING (gene_id)),
p AS (SELECT *, greatest(0.35, least(1.0, CASE WHEN b > 0 THEN sqrt(3.0 / greatest(3.0, b)) ELSE 1 END)) AS pen FROM b)
SELECT program, gene_id, round(pen, 6) AS burden_penalty, round(score * pen, 4) AS score FROM p"""


def _located(spark, d):
    s = table(spark, d, "supplier")
    p = part_features(spark, d).groupBy("l_suppkey", "p_type").agg((F.sum("l_extendedprice") / 1000).alias("score"))
    return p.join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("p_type").alias("program"), F.col("s_name").alias("gene_id"), "score", F.concat(F.lit("chr"), F.col("s_nationkey") % 3).alias("chrom"),
        F.concat(F.lit("chr"), F.col("s_nationkey") % 3, F.lit("q")).alias("chromosome_arm"),
        F.when(F.col("s_nationkey") != 4, F.concat(F.lit("w"), F.col("s_nationkey"))).alias("locus_key"),
    )


LOC = """loc AS (SELECT p_type AS program, s_name AS gene_id, sum(l_extendedprice) / 1000 AS score, 'chr' || (s_nationkey % 3) AS chrom,
   CASE WHEN s_nationkey <> 4 THEN 'w' || s_nationkey END AS locus_key
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY p_type, s_name, s_nationkey)"""


def diversity_penalty(spark, d):
    out = P.diversity_penalty(_located(spark, d), ["program"], "window_diversity")
    return out.select("program", "gene_id", r6("diversity_penalty").alias("diversity_penalty"), r6("score", 4).alias("score"))


SQL_DIVERSITY = f"""WITH {LOC}, r AS (SELECT *, CASE WHEN locus_key IS NULL THEN 0 ELSE
   row_number() OVER (PARTITION BY program, locus_key ORDER BY abs(score) DESC, gene_id) - 1 END AS k FROM loc)
SELECT program, gene_id, round(1 / sqrt(k + 1), 6) AS diversity_penalty, round(score / sqrt(k + 1), 4) AS score FROM r"""


def locus_snapshot(spark, d):
    out = P.locus_snapshot(_located(spark, d), ["program"], 20)
    return out.select("program", "n_top", "dominant_chromosome", r6("window_fraction").alias("window_fraction"),
                      r6("chromosome_fraction").alias("chromosome_fraction"), r6("herfindahl").alias("herfindahl"), "likely_artifact")


SQL_SNAPSHOT = f"""WITH {LOC}, t AS (SELECT * FROM loc QUALIFY row_number() OVER (PARTITION BY program ORDER BY abs(score) DESC, gene_id) <= 20),
n AS (SELECT program, count(*) AS n_top FROM t GROUP BY 1),
c AS (SELECT program, chrom, count(*) AS k FROM t GROUP BY ALL),
cc AS (SELECT program, max(k) AS m, arg_max(chrom, {{'k': k, 'c': chrom}}) AS dominant_chromosome, sum(k * k) AS sq FROM c GROUP BY 1),
w AS (SELECT program, max(k) AS m FROM (SELECT program, locus_key, count(*) AS k FROM t WHERE locus_key IS NOT NULL GROUP BY ALL) GROUP BY 1)
SELECT n.program, n_top, dominant_chromosome, round(coalesce(w.m, 0) / CAST(n_top AS DOUBLE), 6) AS window_fraction, round(cc.m / CAST(n_top AS DOUBLE), 6) AS chromosome_fraction,
  round(sq / CAST(n_top * n_top AS DOUBLE), 6) AS herfindahl,
  n_top >= 5 AND (coalesce(w.m, 0) / CAST(n_top AS DOUBLE) >= 0.5 OR cc.m / CAST(n_top AS DOUBLE) >= 0.6) AS likely_artifact
FROM n JOIN cc USING (program) LEFT JOIN w USING (program)"""


def confidence_weights(spark, d):
    e = _events(spark, d)
    out = P.event_confidence(e, "combined", "pvalue", None, "quality", min_reads=5.0)
    out = out.withColumn("w", F.col("confidence_weight") * P.soft_floor("delta"))
    return out.groupBy("program", "gene_id").agg(r6(F.sum("w")).alias("weight"), F.count_if(F.col("w") == 0).alias("n_zero"))


SQL_CONF = f"""WITH {EV}, m AS (SELECT max(quality) AS m FROM ev),
w AS (SELECT program, gene_id, least(-log10(pvalue), 50) / 50 * CASE WHEN quality < 5 THEN 0 ELSE least(1, ln(1 + quality) / ln(1 + m)) END * least(1, abs(delta) / 0.05) AS w FROM ev, m)
SELECT program, gene_id, round(sum(w), 6) AS weight, count(*) FILTER (w = 0) AS n_zero FROM w GROUP BY ALL"""


def impact_weights(spark, d):
    e = _events(spark, d).withColumn("conf", F.when(F.col("quality") > 30, "high").when(F.col("quality") > 10, "medium").otherwise("low"))
    raw, ev = P.default_impact(F.when(F.col("program") == "A", "exon_skip").when(F.col("program") == "R", "retained_intron").otherwise("other"),
                               F.when(F.col("delta") > 0.05, "Coding").otherwise(""), F.col("delta") > 0.08)
    out = e.withColumn("w", P.impact_weight(raw, ev, "conf", F.lit(3.0)))
    return out.groupBy("program", "conf").agg(r6(F.sum("w"), 4).alias("w"), F.count("*").alias("n"))


SQL_IMPACT = f"""WITH {EV}, a AS (SELECT *, CASE WHEN quality > 30 THEN 'high' WHEN quality > 10 THEN 'medium' ELSE 'low' END AS conf,
  CASE program WHEN 'A' THEN 1.1 WHEN 'R' THEN 0.92 ELSE 1.0 END AS r0, CASE WHEN program IN ('A', 'R') THEN 0.4 ELSE 0.2 END AS e0 FROM ev),
b AS (SELECT *, CASE WHEN delta > 0.05 THEN greatest(r0, 1.12) ELSE r0 END AS r1, CASE WHEN delta > 0.05 THEN greatest(e0, 0.5) ELSE e0 END AS e1 FROM a),
c AS (SELECT *, CASE WHEN delta > 0.08 THEN least(r1, 0.95) ELSE r1 END AS r2, CASE WHEN delta > 0.08 THEN greatest(e1, 0.3) ELSE e1 END AS e2 FROM b),
w AS (SELECT program, conf, CASE WHEN FALSE THEN 1 ELSE greatest(0.75, least(1.35, 1 + CASE conf WHEN 'high' THEN 1.0 WHEN 'medium' THEN 0.6 ELSE 0.25 END * e2 * (r2 - 1))) END AS w FROM c)
SELECT program, conf, round(sum(w), 4) AS w, count(*) AS n FROM w GROUP BY ALL"""


def _bundle_rows(spark, d):
    """Reference rows: dataset = nation of the supplier, sample = supplier, event = brand and size."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    p = part_features(spark, d)
    conf = F.when(F.col("p_size") < 20, "high").when(F.col("p_size") < 40, "medium").otherwise("low")
    key = F.concat_ws("/", "p_brand", "p_size")
    return p.join(s, p["l_suppkey"] == s["s_suppkey"]).select(
        key.alias("input_event_key"), key.alias("canonical_event_key"), conf.alias("canonicalization_confidence"),
        F.concat(F.lit("ds"), "s_nationkey").alias("source_dataset"), F.col("l_suppkey").alias("sample_id"), F.col("p_brand").alias("gene_symbol"),
        F.col("p_type").alias("event_group"), F.when(F.col("l_discount") > 0.01, F.col("l_discount")).alias("psi"),
        F.col("l_quantity").alias("read_support"), (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("row_ordinal"),
    )


BR = """br AS (SELECT CASE WHEN p_size >= 40 THEN 'lowconf::ds' || s_nationkey || '::' || p_brand || '/' || p_size ELSE p_brand || '/' || p_size END AS k,
   CASE WHEN p_size < 20 THEN 'high' WHEN p_size < 40 THEN 'medium' ELSE 'low' END AS conf, 'ds' || s_nationkey AS ds, l_suppkey AS sample, p_brand AS g, p_type AS grp,
   CASE WHEN l_discount > 0.01 THEN l_discount END AS psi, l_quantity AS reads
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
bd AS (SELECT k, ds, count(DISTINCT CASE WHEN psi IS NOT NULL AND reads >= 10 THEN sample END) AS df, count(DISTINCT sample) AS ns FROM br GROUP BY ALL)"""


def event_ubiquity_prior(spark, d):
    out = P.pool_event_ubiquity(P.event_ubiquity_by_dataset(_bundle_rows(spark, d)))
    return out.select("canonical_event_key", "df_ref", "n_samples_ref", "n_datasets_ref", r6("max_dataset_fraction_ref").alias("share"), r6("idf_ref", 9).alias("idf_ref"))


SQL_EVUBIQ = f"""WITH {BR} SELECT k AS canonical_event_key, CAST(sum(df) AS BIGINT) AS df_ref, CAST(sum(ns) AS BIGINT) AS n_samples_ref, count(DISTINCT ds) AS n_datasets_ref,
  round(CASE WHEN sum(df) > 0 THEN max(df) / CAST(sum(df) AS DOUBLE) ELSE 0 END, 6) AS share,
  round(ln(1 + ((SELECT count(DISTINCT ds) FROM bd) + 1.0) / (count(DISTINCT ds) + 1.0)), 9) AS idf_ref FROM bd GROUP BY k"""


def leave_one_source_out_prior(spark, d):
    by = P.event_ubiquity_by_dataset(_bundle_rows(spark, d))
    out = P.leave_dataset_out(P.pool_event_ubiquity(by), by, "ds7")
    return out.select("canonical_event_key", "n_datasets_ref", r6("idf_ref", 9).alias("idf_ref"))


SQL_LOO = f"""WITH {BR}, t AS (SELECT DISTINCT k FROM bd WHERE ds = 'ds7'),
a AS (SELECT k, count(DISTINCT ds) AS n, ln(1 + ((SELECT count(DISTINCT ds) FROM bd) + 1.0) / (count(DISTINCT ds) + 1.0)) AS i FROM bd GROUP BY k),
b AS (SELECT k, count(DISTINCT ds) AS n, ln(1 + ((SELECT count(DISTINCT ds) FROM bd WHERE ds <> 'ds7') + 1.0) / (count(DISTINCT ds) + 1.0)) AS i FROM bd WHERE ds <> 'ds7' GROUP BY k)
SELECT a.k AS canonical_event_key, CASE WHEN t.k IS NULL THEN a.n ELSE coalesce(b.n, 0) END AS n_datasets_ref,
  round(CASE WHEN t.k IS NULL THEN a.i ELSE coalesce(b.i, 1.0) END, 9) AS idf_ref FROM a LEFT JOIN t ON a.k = t.k LEFT JOIN b ON a.k = b.k"""


def gene_burden_prior(spark, d):
    out = P.gene_burden(P.gene_burden_by_dataset(_bundle_rows(spark, d)))
    return out.select("gene_symbol", "n_canonical_events_ref", "n_low_confidence_events_ref", "n_unique_event_groups_ref", "n_studies_ref",
                      r6("median_unique_groups_per_study").alias("median_groups"), r6("fraction_low_confidence_events_ref").alias("fraction_low"))


SQL_BURDENPRIOR = f"""WITH {BR}, b AS (SELECT g, ds, count(DISTINCT k) AS n, count(DISTINCT CASE WHEN conf = 'low' THEN k END) AS low, count(DISTINCT grp) AS grps FROM br GROUP BY ALL)
SELECT g AS gene_symbol, CAST(sum(n) AS BIGINT) AS n_canonical_events_ref, CAST(sum(low) AS BIGINT) AS n_low_confidence_events_ref, CAST(sum(grps) AS BIGINT) AS n_unique_event_groups_ref,
  count(DISTINCT ds) AS n_studies_ref, round(median(grps), 6) AS median_groups, round(sum(low) / CAST(sum(n) AS DOUBLE), 6) AS fraction_low FROM b GROUP BY g"""


def event_alias_conflicts(spark, d):
    """Word keys mapping to several brands: kept only where unambiguous (or high confidence: first)."""
    rows = _bundle_rows(spark, d).withColumn("input_event_key", F.concat_ws("/", "gene_symbol", "event_group"))
    out = P.event_aliases(rows.withColumn("canonical_event_key", F.concat_ws("/", "gene_symbol", F.floor(F.col("read_support") / 26))))
    return out.groupBy("canonicalization_confidence").agg(F.count("*").alias("n"))


SQL_ALIASCONF = f"""WITH {BR}, m AS (SELECT g || '/' || grp AS i, conf, CASE WHEN conf = 'low' THEN 'lowconf::' || ds || '::' ELSE '' END || g || '/' || CAST(floor(reads / 26) AS INTEGER) AS c FROM br),
x AS (SELECT i, conf, count(DISTINCT c) AS n FROM m GROUP BY ALL)
SELECT conf AS canonicalization_confidence, count(*) AS n FROM x WHERE conf = 'high' OR n = 1 GROUP BY 1"""


def site_ubiquity_prior(spark, d):
    rows = _bundle_rows(spark, d).select(
        F.col("source_dataset").alias("source_path"), F.col("source_dataset"), F.col("input_event_key").alias("input_key"),
        F.col("canonical_event_key").alias("canonical_site_key"), F.col("gene_symbol").alias("gene_id"), "gene_symbol", F.lit("generic").alias("ptm_type"), "row_ordinal",
    )
    _, u = P.site_bundle(rows)
    return u.select("canonical_site_key", "gene_id", "df_ref", r6("fraction_ref").alias("fraction_ref"), r6("idf_ref", 9).alias("idf_ref"))


SQL_SITE = """WITH s AS (SELECT p_brand || '/' || p_size AS k, p_brand AS g, s_nationkey AS src FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
n AS (SELECT count(DISTINCT src) AS n FROM s)
SELECT k AS canonical_site_key, min(g) AS gene_id, count(DISTINCT src) AS df_ref, round(count(DISTINCT src) / CAST(any_value(n) AS DOUBLE), 6) AS fraction_ref,
  round(ln((any_value(n) + 1.0) / (count(DISTINCT src) + 1.0)), 9) AS idf_ref FROM s, n GROUP BY k"""


QUERIES = {
    **{f"duplicate_collapse_{p}": (_collapse(p), _collapse_sql(p)) for p in ("highest_confidence", "max_abs", "sum")},
    "topk_mean": (topk_mean, SQL_TOPK),
    "event_group_collapse": (event_group_collapse, SQL_GROUPS),
    "support_penalty": (support_penalty, SQL_SUPPORT),
    "burden_penalty": (burden_penalty, SQL_BURDEN),
    "diversity_penalty": (diversity_penalty, SQL_DIVERSITY),
    "locus_snapshot": (locus_snapshot, SQL_SNAPSHOT),
    "confidence_weights": (confidence_weights, SQL_CONF),
    "impact_weights": (impact_weights, SQL_IMPACT),
    "event_ubiquity_prior": (event_ubiquity_prior, SQL_EVUBIQ),
    "leave_one_source_out_prior": (leave_one_source_out_prior, SQL_LOO),
    "gene_burden_prior": (gene_burden_prior, SQL_BURDENPRIOR),
    "event_alias_conflicts": (event_alias_conflicts, SQL_ALIASCONF),
    "site_ubiquity_prior": (site_ubiquity_prior, SQL_SITE),
}
