"""Similarity, neighbour, label and calibration bindings on the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import r6, table
from lociweave.operators import similarity as SIM
from lociweave.operators import statistics as ST
from lociweave.session import materialize


def _vectors(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


VEC = """v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec, label FROM embeddings),
pairs AS (SELECT a.id AS query_id, b.id AS ref_id, list_cosine_similarity(a.vec, b.vec) AS similarity, a.label AS ql, b.label AS rl
  FROM v a JOIN v b ON a.id <> b.id)"""


def _long(spark, d):
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), "label", F.posexplode("embedding").alias("feature", "x")).select(
        "id", "label", "feature", F.col("x").cast("double").alias("value"))


LONG = "l AS (SELECT vec_id AS id, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS feature, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings)"


def cosine_pairs(spark, d):
    v = _vectors(spark, d).select("id", "vec")
    p = SIM.similar(v, v, min_similarity=0.35, exclude_self=True)
    return p.groupBy("query_id").agg(F.count("*").alias("n"), r6(F.sum("similarity")).alias("total"))


SQL_COSINE = f"""WITH {VEC} SELECT query_id, count(*) AS n, round(sum(similarity), 6) AS total FROM pairs WHERE similarity >= 0.35 GROUP BY 1"""


def pearson_knn(spark, d):
    v = _vectors(spark, d).select("id", "vec")
    p = SIM.similar(v, v, k=5, pearson=True, exclude_self=True)
    return p.select("query_id", "ref_id", r6("similarity").alias("similarity"))


SQL_PEARSON = """WITH v AS (SELECT vec_id AS id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: x - list_avg(CAST(embedding AS DOUBLE[]))) AS vec FROM embeddings),
p AS (SELECT a.id AS query_id, b.id AS ref_id, list_cosine_similarity(a.vec, b.vec) AS s FROM v a JOIN v b ON a.id <> b.id)
SELECT query_id, ref_id, round(s, 6) AS similarity FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY s DESC, ref_id) <= 5"""


def hub_score(spark, d):
    return SIM.hub_scores(_vectors(spark, d).select("id", "vec"), 10).select("id", r6("hub_score").alias("hub_score"))


HUB = """hub AS (SELECT query_id AS id, avg(similarity) AS hub_score FROM
  (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, ref_id) <= 10) WHERE similarity > 0 GROUP BY 1)"""
SQL_HUB = f"WITH {VEC}, {HUB} SELECT v.id, round(coalesce(hub_score, 0), 6) AS hub_score FROM v LEFT JOIN hub USING (id)"


def _evidence(spark, d, polarity="similar"):
    """The 20 references of most evidence among all that reach the minimum similarity.

    Hub scores and evidence are written: each costs a product of all pairs and is read more than once.
    """
    v = _vectors(spark, d)
    hub = materialize(SIM.hub_scores(v.select("id", "vec"), 10))
    refs = v.select("id", "label").join(hub, "id").withColumn("qc_weight", (F.col("label") + 1) / 10.0)
    factors = SIM.reference_factors(refs, "inverse_rank")
    rated = v.join(factors.select(F.col("ref_id").alias("id"), (F.col("qc") * F.col("hub_factor")).alias("factor")), "id").select("id", "vec", "factor")
    found = SIM.candidates_by_evidence(v.select("id", "vec"), rated, 20, 2.0, min_similarity=0.1, polarity=polarity, exclude_self=True)
    e = SIM.neighbour_evidence(SIM.polarity_candidates(found, polarity, 0.1), refs, 2.0, factors=factors)
    return materialize(SIM.neighbour_cut(e, 20, 20).drop("neighbour_rank")), v, hub


def knn_evidence(spark, d):
    e, _, _ = _evidence(spark, d)
    cut = SIM.neighbour_cut(e, 10, 3, 0.25)
    return cut.select("query_id", "ref_id", "neighbour_rank", r6("evidence", 9).alias("evidence"))


EVID = f"""{HUB}, hr AS (SELECT v.id, (label + 1) / 10.0 AS qc, count(*) OVER () / CAST(row_number() OVER (ORDER BY coalesce(hub_score, 0), v.id) AS DOUBLE) AS hf
   FROM v LEFT JOIN hub USING (id)),
ev0 AS (SELECT query_id, ref_id, ql, rl, similarity, similarity * similarity * qc * hf AS evidence FROM pairs JOIN hr ON ref_id = hr.id WHERE similarity >= 0.1),
evd AS (SELECT * FROM ev0 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY evidence DESC, ref_id) <= 20)"""
SQL_KNN = f"""WITH {VEC}, {EVID}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY evidence DESC, ref_id) AS rk, max(evidence) OVER (PARTITION BY query_id) AS top FROM evd)
SELECT query_id, ref_id, rk AS neighbour_rank, round(evidence, 9) AS evidence FROM r WHERE rk <= 10 AND (rk <= 3 OR evidence >= 0.25 * top)"""


def opposite_evidence(spark, d):
    e, _, _ = _evidence(spark, d, "opposite")
    return SIM.neighbour_cut(e, 10, 3, 0.25).select("query_id", "ref_id", "neighbour_rank", r6("evidence", 9).alias("evidence"))


SQL_OPPOSITE = SQL_KNN.replace("WHERE similarity >= 0.1", "WHERE -similarity >= 0.1")


def high_hub_mass(spark, d):
    e, _, hub = _evidence(spark, d)
    out = SIM.high_hub_mass(e, hub)
    return out.select("query_id", r6("high_hub_mass").alias("high_hub_mass"))


SQL_HIGH = f"""WITH {VEC}, {EVID}, r AS (SELECT query_id, evidence, row_number() OVER (PARTITION BY query_id ORDER BY coalesce(hub_score, 0), ref_id) AS rk, count(*) OVER (PARTITION BY query_id) AS n
  FROM evd LEFT JOIN hub ON hub.id = ref_id)
SELECT query_id, round(sum(CASE WHEN n >= 4 AND rk > floor(0.75 * n) THEN evidence ELSE 0 END) / sum(evidence), 6) AS high_hub_mass FROM r GROUP BY 1"""


def target_agreement(spark, d):
    e, v, _ = _evidence(spark, d)
    genes = v.select(F.col("id").alias("ref_id"), F.explode(F.array(F.struct(F.concat(F.lit("G"), "label").alias("gene_id"), F.lit(0.5).alias("weight")),
        F.struct(F.concat(F.lit("H"), F.col("label") % 4).alias("gene_id"), F.when(F.col("label") % 2 == 0, 0.5).otherwise(0.3).alias("weight"))))).select("ref_id", "col.*")
    out = SIM.target_agreement(e, genes, 1)
    return out.select("query_id", r6("primary_agreement").alias("primary_agreement"), r6("top_agreement").alias("top_agreement"))


SQL_AGREE = f"""WITH {VEC}, {EVID}, g AS (SELECT id, 'G' || label AS gene, 0.5 AS w FROM v UNION ALL SELECT id, 'H' || (label % 4), CASE WHEN label % 2 = 0 THEN 0.5 ELSE 0.3 END FROM v),
f AS (SELECT id, gene, count(*) OVER (PARTITION BY id) AS c FROM (SELECT *, max(w) OVER (PARTITION BY id) AS b FROM g) WHERE w = b),
o AS (SELECT id, gene FROM g QUALIFY row_number() OVER (PARTITION BY id ORDER BY w DESC, gene) = 1),
t AS (SELECT query_id, sum(evidence) AS t FROM evd GROUP BY 1),
p AS (SELECT query_id, max(m) AS p FROM (SELECT query_id, gene, sum(evidence / c) AS m FROM evd JOIN f ON f.id = ref_id GROUP BY ALL) GROUP BY 1),
k AS (SELECT query_id, max(m) AS k FROM (SELECT query_id, gene, sum(evidence) AS m FROM evd JOIN o ON o.id = ref_id GROUP BY ALL) GROUP BY 1)
SELECT query_id, round(p / t, 6) AS primary_agreement, round(k / t, 6) AS top_agreement FROM t JOIN p USING (query_id) JOIN k USING (query_id)"""


def label_vote(spark, d):
    e, v, _ = _evidence(spark, d)
    lab = v.select(F.col("id").alias("ref_id"), F.lit("class").alias("level"), F.col("label"), F.lit(0.7).alias("weight"))
    lab = lab.unionByName(v.select(F.col("id").alias("ref_id"), F.lit("family").alias("level"), (F.col("label") % 3).cast("int").alias("label"), F.lit(1.4).alias("weight")))
    top = SIM.top_label(SIM.label_vote(e, lab).withColumn("mass", F.round("mass", 12)))
    return top.select("query_id", "level", "label", "support", r6("share").alias("share"))


SQL_VOTE = f"""WITH {VEC}, {EVID}, lab AS (SELECT id, 'class' AS level, label, 0.7 AS w FROM v UNION ALL SELECT id, 'family', label % 3, 1.0 FROM v),
m AS (SELECT query_id, level, label, sum(evidence * w) AS mass, count(DISTINCT ref_id) AS support FROM evd JOIN lab ON ref_id = lab.id GROUP BY ALL),
s AS (SELECT *, mass / sum(mass) OVER (PARTITION BY query_id, level) AS share FROM m)
SELECT query_id, level, label, support, round(share, 6) AS share FROM s
QUALIFY row_number() OVER (PARTITION BY query_id, level ORDER BY round(mass, 12) DESC, label) = 1"""


def target_support(spark, d):
    e, v, _ = _evidence(spark, d)
    genes = v.select(F.col("id").alias("ref_id"), F.explode(F.array(F.concat(F.lit("G"), "label"), F.concat(F.lit("H"), F.col("label") % 4))).alias("gene_id"), F.lit(0.8).alias("weight"))
    s = SIM.nominate_core(SIM.target_support(e, genes), min_refs=4)
    return s.select("query_id", "gene_id", r6("score").alias("score"), "n_refs", "core")


SQL_SUPPORT = f"""WITH {VEC}, {EVID}, g AS (SELECT id, 'G' || label AS gene_id FROM v UNION ALL SELECT id, 'H' || (label % 4) FROM v),
s AS (SELECT query_id, gene_id, sum(evidence * 0.5) AS score, count(DISTINCT ref_id) AS n, max(similarity) AS b FROM evd JOIN g ON ref_id = g.id GROUP BY ALL)
SELECT query_id, gene_id, round(score, 6) AS score, n AS n_refs, (score >= 0.8 * max(score) OVER w - 1e-12 OR n >= 4 OR b >= 0.95 * max(b) OVER w - 1e-12) AS core FROM s WINDOW w AS (PARTITION BY query_id)"""


def consensus_profile(spark, d):
    return SIM.consensus(_long(spark, d), ["label"]).select("label", "feature", r6("value", 7).alias("value"))


SQL_CONSENSUS = f"WITH {LONG} SELECT label, feature, round(median(value), 7) AS value FROM l GROUP BY ALL"


def control_center(spark, d):
    lg = _long(spark, d)
    out = SIM.mean_centre(lg, lg.filter("label = 0"))
    return out.groupBy("label", "feature").agg(r6(F.avg("value"), 8).alias("value"))


SQL_CENTER = f"""WITH {LONG}, m AS (SELECT feature, avg(value) AS m FROM l WHERE label = 0 GROUP BY 1)
SELECT label, feature, round(avg(value - m), 8) + 0.0 AS value FROM l JOIN m USING (feature) GROUP BY ALL"""


def nuisance_projection(spark, d):
    v = _vectors(spark, d)
    out = SIM.remove_nuisance_axes(v.select("id", "vec"), v.filter("label = 0").select("id", "vec"))
    norm = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    return out.select("id", r6(norm).alias("squared_norm"))


def standardize_features(spark, d):
    lg = _long(spark, d)
    out = ST.standardize(lg, ST.center_scale(lg))
    return out.groupBy("label", "feature").agg(r6(F.sum("value")).alias("value"))


SQL_STD = f"""WITH {LONG}, s AS (SELECT feature, avg(value) AS c, greatest(stddev_pop(value), 1e-8) AS s FROM l GROUP BY 1)
SELECT label, feature, round(sum((value - c) / s), 6) + 0.0 AS value FROM l JOIN s USING (feature) GROUP BY ALL"""


def mutual_neighbours(spark, d):
    e, v, _ = _evidence(spark, d)
    out = SIM.mutual_filter(e, v.select("id", "vec"), anchors=5, floor=0.1)
    return out.groupBy("query_id").agg(r6(F.sum("mutual_similarity")).alias("mutual"), r6(F.sum("evidence")).alias("evidence"))


SQL_MUTUAL = f"""WITH {VEC}, {EVID}, a AS (SELECT query_id, ref_id AS anchor FROM evd QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY evidence DESC, similarity DESC, ref_id) <= 5),
m AS (SELECT e.query_id, e.ref_id, avg(greatest(0, coalesce(p.similarity, 1))) AS mu, max(e.ref_id = anchor) AS anc FROM evd e JOIN a ON e.query_id = a.query_id
  LEFT JOIN pairs p ON p.query_id = e.ref_id AND p.ref_id = anchor GROUP BY ALL),
x AS (SELECT evd.query_id, mu, CASE WHEN NOT anc AND mu < 0.1 THEN evidence * 0.5 ELSE evidence END AS evidence FROM evd LEFT JOIN m USING (query_id, ref_id))
SELECT query_id, round(sum(mu), 6) AS mutual, round(sum(evidence), 6) AS evidence FROM x GROUP BY 1"""


def cross_modality(spark, d):
    """Modality = parity of the label; cross-modality evidence damped unless a target or family is shared with the anchors."""
    e, v, _ = _evidence(spark, d)
    m = v.select(F.col("id"), (F.col("label") % 2).alias("m"))
    n = e.join(m.select(F.col("id").alias("ref_id"), F.col("m").alias("modality")), "ref_id").join(
        m.select(F.col("id").alias("query_id"), F.col("m").alias("query_modality")), "query_id")
    genes = v.select(F.col("id").alias("ref_id"), F.concat(F.lit("G"), "label").alias("gene_id"), F.lit(1.0).alias("weight"))
    fam = v.select(F.concat(F.lit("G"), "label").alias("gene_id"), F.lit("family").alias("level"), F.concat(F.lit("f"), F.col("label") % 5).alias("label")).distinct()
    out = SIM.modality_penalty(n, 0.35, SIM.shared_label_recovery(n, genes, fam))
    return out.groupBy("query_id").agg(r6(F.sum("evidence"), 8).alias("evidence"))


SQL_CROSS = f"""WITH {VEC}, {EVID}, a AS (SELECT query_id, rl % 5 AS fam FROM evd WHERE ql % 2 = rl % 2
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, ref_id) <= 5),
x AS (SELECT query_id, evidence * CASE WHEN ql % 2 = rl % 2 THEN 1 WHEN EXISTS (SELECT 1 FROM a WHERE a.query_id = evd.query_id AND a.fam = rl % 5) THEN 0.5 ELSE 0.35 END AS ev FROM evd)
SELECT query_id, round(sum(ev), 8) AS evidence FROM x GROUP BY 1"""


def term_scores(spark, d):
    """Templates weigh the first features by sign; scores per vector, routed to genes by term degree."""
    lg = _long(spark, d).select(F.col("id").alias("query_id"), "feature", "value")
    feats = lg.select("feature").distinct()
    t = feats.select(F.concat(F.lit("T"), F.col("feature") % 6).alias("term_id"), "feature", F.when(F.col("feature") % 4 == 0, -1.0).otherwise(2.0).alias("weight"))
    terms = SIM.term_scores(lg, t)
    edges = feats.select(F.concat(F.lit("T"), F.col("feature") % 6).alias("term_id"), F.concat(F.lit("G"), F.col("feature") % 9).alias("gene_id"), F.lit(1.0).alias("weight")).distinct()
    hop = feats.filter("feature % 6 <> 5").select(F.concat(F.lit("T"), F.col("feature") % 6).alias("term_id"), F.concat(F.lit("T"), F.col("feature") % 6 + 1).alias("neighbour_id")).distinct()
    out = SIM.route_terms(terms, edges, hop)
    return out.groupBy("gene_id").agg(r6(F.sum("score")).alias("score"), F.count("*").alias("n"))


SQL_TERMS = f"""WITH {LONG}, tp AS (SELECT DISTINCT 'T' || (feature % 6) AS term_id, feature, CASE WHEN feature % 4 = 0 THEN -1.0 ELSE 2.0 END AS w FROM l),
den AS (SELECT term_id, sum(abs(w)) AS d FROM tp GROUP BY 1),
ts AS (SELECT id, term_id, greatest(0, sum(w * value) / any_value(d)) AS score FROM l JOIN tp USING (feature) JOIN den USING (term_id) GROUP BY ALL),
hop AS (SELECT DISTINCT 'T' || (feature % 6) AS term_id, 'T' || (feature % 6 + 1) AS n FROM l WHERE feature % 6 <> 5),
ed AS (SELECT DISTINCT 'T' || (feature % 6) AS term_id, 'G' || (feature % 9) AS gene_id FROM l),
dg AS (SELECT term_id, count(*) AS deg FROM ed GROUP BY 1),
tz AS (SELECT id, term_id, score / deg AS score FROM ts JOIN dg USING (term_id) WHERE score > 0),
al AS (SELECT id, term_id, score FROM tz UNION ALL SELECT id, n, score * 0.5 FROM tz JOIN hop USING (term_id)),
g AS (SELECT id, gene_id, sum(score) AS score FROM al JOIN ed USING (term_id) GROUP BY ALL)
SELECT gene_id, round(sum(score), 6) AS score, count(*) AS n FROM g GROUP BY 1"""


def mechanism_scores(spark, d):
    """Modality from the label: 0-3 compound, others crispr; two genes per reference."""
    e, v, _ = _evidence(spark, d)
    m = v.select(F.col("id"), F.when(F.col("label") < 4, "compound").otherwise("crispr").alias("m"))
    n = e.join(m.select(F.col("id").alias("ref_id"), F.col("m").alias("modality")), "ref_id").join(
        m.select(F.col("id").alias("query_id"), F.col("m").alias("query_modality")), "query_id")
    genes = v.select(F.col("id").alias("ref_id"), F.concat(F.lit("G"), "label").alias("gene_id"), F.lit(0.6).alias("weight")).unionByName(
        v.select(F.col("id").alias("ref_id"), F.lit("H").alias("gene_id"), F.lit(0.4).alias("weight")))
    out = SIM.mechanism_scores(n, genes, idf=SIM.gene_recurrence(genes))
    return out.groupBy("gene_id").agg(r6(F.sum("score")).alias("score"), F.count("*").alias("n"))


SQL_MECH = f"""WITH {VEC}, {EVID}, g AS (SELECT id, 'G' || label AS gene_id, 0.6 AS w FROM v UNION ALL SELECT id, 'H', 0.4 FROM v),
c AS (SELECT gene_id, ln((500.0 + (SELECT count(*) FROM v) - 500 + 1) / (count(DISTINCT id) + 1.0)) / ln((SELECT count(*) FROM v) + 1.0) AS idf FROM g GROUP BY 1),
n AS (SELECT *, rl < 4 AS c, ql < 4 AS qc FROM evd WHERE evidence > 0),
s AS (SELECT query_id, c, gene_id, sum(evidence * w) AS s FROM n JOIN g ON ref_id = g.id GROUP BY ALL),
p AS (SELECT *, s / sum(s) OVER (PARTITION BY query_id, c) AS z FROM s),
k AS (SELECT query_id, any_value(qc) AS qc, count(*) FILTER (c) AS nc, count(*) FILTER (NOT c) AS ng FROM n GROUP BY 1),
w0 AS (SELECT *, 0.5 * CASE WHEN qc THEN 1.2 ELSE 0.5 END * CASE WHEN nc < 5 AND ng >= 5 THEN 0.25 ELSE 1 END AS cw,
  0.5 * CASE WHEN qc THEN 0.8 ELSE 1.5 END * CASE WHEN ng < 5 AND nc >= 5 THEN 0.25 ELSE 1 END AS gw FROM k),
m AS (SELECT p.query_id, p.gene_id, sum(z * CASE WHEN nc > 0 AND ng > 0 THEN CASE WHEN c THEN cw ELSE gw END / (cw + gw) ELSE 1 END) AS score FROM p JOIN w0 USING (query_id) GROUP BY ALL)
SELECT gene_id, round(sum(score * idf), 6) AS score, count(*) AS n FROM m JOIN c USING (gene_id) WHERE score * idf > 0 GROUP BY 1"""


QUERIES = {
    "mechanism_scores": (mechanism_scores, SQL_MECH),
    "cosine_pairs": (cosine_pairs, SQL_COSINE),
    "pearson_knn": (pearson_knn, SQL_PEARSON),
    "hub_score": (hub_score, SQL_HUB),
    "knn_evidence": (knn_evidence, SQL_KNN),
    "opposite_evidence": (opposite_evidence, SQL_OPPOSITE),
    "high_hub_mass": (high_hub_mass, SQL_HIGH),
    "target_agreement": (target_agreement, SQL_AGREE),
    "label_vote": (label_vote, SQL_VOTE),
    "target_support": (target_support, SQL_SUPPORT),
    "consensus_profile": (consensus_profile, SQL_CONSENSUS),
    "control_center": (control_center, SQL_CENTER),
    "nuisance_projection": (nuisance_projection, None),
    "standardize_features": (standardize_features, SQL_STD),
    "mutual_neighbours": (mutual_neighbours, SQL_MUTUAL),
    "cross_modality": (cross_modality, SQL_CROSS),
    "term_scores": (term_scores, SQL_TERMS),
}
