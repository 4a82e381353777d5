"""Interval, nearest, distance and linked-score bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import (
    ANCHORS_SQL, FEATURES_SQL, anchors, features, part_features, r6, table,
)
from lociweave.operators import intervals as I
from lociweave.operators import scoring as SC
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST

UP, DOWN = 3, 1


def _promoters(spark, d):
    return I.promoters(anchors(spark, d), UP, DOWN)


_PROM = f"""prom AS (
  SELECT chrom, gene_id, program, price,
         greatest(0, tss - CASE WHEN strand = '+' THEN {UP} ELSE {DOWN} END) AS ps,
         tss + CASE WHEN strand = '+' THEN {DOWN} ELSE {UP} END AS pe
  FROM anchors)"""


def interval_overlap_join(spark, d):
    """Feature spans per gene promoter: number of links and furthest end."""
    spans = features(spark, d)
    links = I.promoter_links(spans, anchors(spark, d), UP, DOWN)
    return links.groupBy("gene_id").agg(
        F.count("*").alias("n_spans"), F.max("end").alias("last_end"), r6(F.sum("link_weight")).alias("link_weight")
    )


SQL_OVERLAP = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
spans AS (SELECT DISTINCT chrom, "start", "end" FROM features)
SELECT gene_id, count(*) AS n_spans, max("end") AS last_end, round(CAST(count(*) AS DOUBLE), 6) AS link_weight
FROM spans f JOIN prom p ON f.chrom = p.chrom AND f."start" < p.pe AND p.ps < f."end"
GROUP BY gene_id"""


def external_link_overlap(spark, d):
    """Region links weighted by price rank bucket, summed per (span, program)."""
    regions = _promoters(spark, d).select(
        "chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"), F.col("program").alias("gene_id"),
        F.floor(F.col("price") / 100000).cast("double").alias("link_weight"),
    )
    links = I.external_links(features(spark, d), regions)
    return links.groupBy("gene_id").agg(F.count("*").alias("n_spans"), r6(F.sum("link_weight"), 3).alias("total"))


SQL_EXTERNAL = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
spans AS (SELECT DISTINCT chrom, "start", "end" FROM features),
agg AS (SELECT f.chrom, f."start", f."end", p.program AS gene_id, sum(floor(price / 100000)) AS w
  FROM spans f JOIN prom p ON f.chrom = p.chrom AND f."start" < p.pe AND p.ps < f."end" GROUP BY ALL)
SELECT gene_id, count(*) AS n_spans, round(sum(w), 3) AS total FROM agg GROUP BY gene_id"""


def overlap_max_prior(spark, d):
    refs = _promoters(spark, d).select(
        "chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"), (F.col("price") / 97531).alias("idf")
    )
    out = I.overlap_max(features(spark, d), refs, "idf", "idf_ref")
    return out.groupBy("chrom").agg(
        F.count("*").alias("n"), r6(F.sum("idf_ref")).alias("idf_sum"), r6(F.max("idf_ref")).alias("idf_max")
    )


SQL_MAX_PRIOR = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
spans AS (SELECT DISTINCT chrom, "start", "end" FROM features),
best AS (SELECT f.chrom, f."start", f."end", max(price / 97531.0) AS v
  FROM spans f JOIN prom p ON f.chrom = p.chrom AND f."start" < p.pe AND p.ps < f."end" GROUP BY ALL)
SELECT f.chrom, count(*) AS n, round(sum(greatest(1.0, coalesce(v, 1.0))), 6) AS idf_sum,
       round(max(greatest(1.0, coalesce(v, 1.0))), 6) AS idf_max
FROM features f LEFT JOIN best b ON f.chrom = b.chrom AND f."start" = b."start" AND f."end" = b."end" GROUP BY f.chrom"""


def overlap_mask(spark, d):
    regions = _promoters(spark, d).filter("program = '1-URGENT'").select(
        "chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end")
    )
    out = I.overlap_flag(features(spark, d), regions, "masked")
    return out.groupBy("chrom", "masked").agg(F.count("*").alias("n"), r6(F.sum("weight"), 2).alias("weight"))


SQL_MASK = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
m AS (SELECT f.*, EXISTS (SELECT 1 FROM prom p WHERE p.program = '1-URGENT' AND f.chrom = p.chrom
        AND f."start" < p.pe AND p.ps < f."end") AS masked FROM features f)
SELECT chrom, masked, count(*) AS n, round(sum(weight), 2) AS weight FROM m GROUP BY chrom, masked"""


def nearest_asof(spark, d):
    f = features(spark, d).withColumn("centre", F.floor((F.col("start") + F.col("end")) / 2).cast("long"))
    links = I.nearest_links(f, anchors(spark, d), max_distance=20)
    return f.join(links, ["chrom", "centre"]).groupBy("gene_id").agg(
        F.count("*").alias("n_features"), F.sum("distance").alias("distance"), F.min("centre").alias("first_centre")
    )


SQL_NEAREST = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL},
c AS (SELECT DISTINCT chrom, ("start" + "end") // 2 AS centre FROM features),
cand AS (SELECT c.chrom, c.centre, a.gene_id, abs(c.centre - a.tss) AS dist,
   CASE WHEN a.tss >= c.centre THEN 0 ELSE 1 END AS side,
   CASE WHEN a.tss >= c.centre THEN a.gene_ordinal ELSE -a.gene_ordinal END AS ord
  FROM c JOIN anchors a ON c.chrom = a.chrom AND abs(c.centre - a.tss) <= 20),
best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY chrom, centre ORDER BY dist, side, ord) = 1)
SELECT gene_id, count(*) AS n_features, CAST(sum(dist) AS BIGINT) AS distance, min(b.centre) AS first_centre
FROM features f JOIN best b ON f.chrom = b.chrom AND (f."start" + f."end") // 2 = b.centre GROUP BY gene_id"""


def distance_decay_topk(spark, d):
    f = features(spark, d).withColumn("centre", F.floor((F.col("start") + F.col("end")) / 2).cast("long"))
    links = I.decay_links(f, anchors(spark, d), max_distance=30, decay_length=10.0, max_genes=5)
    return links.select("chrom", "centre", "gene_id", "distance", r6("link_weight").alias("link_weight"))


SQL_DECAY = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL},
c AS (SELECT DISTINCT chrom, ("start" + "end") // 2 AS centre FROM features),
cand AS (SELECT c.chrom, c.centre, a.gene_id, abs(c.centre - a.tss) AS distance, exp(-abs(c.centre - a.tss) / 10.0) AS w
  FROM c JOIN anchors a ON c.chrom = a.chrom AND abs(c.centre - a.tss) <= 30)
SELECT chrom, centre, gene_id, distance, round(w, 6) AS link_weight FROM cand
QUALIFY row_number() OVER (PARTITION BY chrom, centre ORDER BY w DESC, gene_id) <= 5"""


def segment_gene_overlap(spark, d):
    genes = _promoters(spark, d).select("chrom", F.col("r_start").alias("gene_start"), F.col("r_end").alias("gene_end"), "gene_id")
    links = I.segment_gene_overlaps(features(spark, d), genes)
    return links.groupBy("chrom").agg(
        F.count("*").alias("n_links"), r6(F.sum("overlap_fraction")).alias("fraction"), F.max("n_genes").alias("most_genes")
    )


SQL_SEGMENT_GENE = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
spans AS (SELECT DISTINCT chrom, "start", "end" FROM features),
l AS (SELECT f.*, (least(f."end", p.pe) - greatest(f."start", p.ps)) / CAST(p.pe - p.ps AS DOUBLE) AS fr,
        count(*) OVER (PARTITION BY f.chrom, f."start", f."end") AS ng
  FROM spans f JOIN prom p ON f.chrom = p.chrom AND f."start" < p.pe AND p.ps < f."end")
SELECT chrom, count(*) AS n_links, round(sum(fr), 6) AS fraction, max(ng) AS most_genes FROM l GROUP BY chrom"""


def chipseq_peak(spark, d):
    """Flagship: features over promoters -> program score -> rank and L1 weight per supplier group."""
    f = features(spark, d)
    regions = _promoters(spark, d).select("chrom", "r_start", "r_end", F.col("program").alias("gene_id"), F.lit(1.0).alias("link_weight"))
    scores = I.overlap_score(f, regions, ["chrom"])
    picked = SEL.select_and_weight(scores, ["chrom"], "within_set_l1", how="top_k", k=3)
    return picked.select("chrom", "gene_id", r6("score", 2).alias("score"), r6("weight").alias("weight"), "rank")


SQL_CHIPSEQ = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM},
s AS (SELECT f.chrom, p.program AS gene_id, sum(f.weight) AS score
  FROM features f JOIN prom p ON f.chrom = p.chrom AND f."start" < p.pe AND p.ps < f."end" GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY score DESC, gene_id) AS rank FROM s),
t AS (SELECT *, sum(score) OVER (PARTITION BY chrom) AS total FROM r WHERE rank <= 3)
SELECT chrom, gene_id, round(score, 2) AS score, round(score / total, 6) AS weight, rank FROM t"""


def linked_gene_score(spark, d):
    li = table(spark, d, "lineitem").withColumn("signed", F.col("l_quantity") - F.lit(25.0))
    links = table(spark, d, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("gene_id"), (F.col("p_size") / 10.0).alias("link_weight")
    )
    parts = []
    for mode in ("signed", "abs", "positive", "negative"):
        s = SC.linked_score(li, links, ["l_partkey"], ["l_returnflag"], "signed", mode)
        parts.append(s.select("l_returnflag", "gene_id", F.lit(mode).alias("transform"), r6("score", 4).alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


SQL_LINKED = """WITH b AS (SELECT l_returnflag, p_brand AS gene_id, l_quantity - 25.0 AS x, p_size / 10.0 AS lw
  FROM lineitem JOIN part ON l_partkey = p_partkey),
t AS (SELECT l_returnflag, gene_id, 'signed' AS transform, sum(x * lw) AS score FROM b GROUP BY ALL
 UNION ALL SELECT l_returnflag, gene_id, 'abs', sum(abs(x) * lw) FROM b GROUP BY ALL
 UNION ALL SELECT l_returnflag, gene_id, 'positive', sum(greatest(x, 0) * lw) FROM b GROUP BY ALL
 UNION ALL SELECT l_returnflag, gene_id, 'negative', sum(greatest(-x, 0) * lw) FROM b GROUP BY ALL)
SELECT l_returnflag, gene_id, transform, round(score, 4) AS score FROM t WHERE score <> 0"""


def _aggregate(mode):
    def run(spark, d):
        rows = part_features(spark, d).select(
            F.col("l_suppkey"), F.col("p_brand").alias("gene_id"), (F.col("l_extendedprice") - 30000.0).alias("value"),
            (F.col("l_quantity") / 53.0).alias("link_weight"), "l_orderkey", "l_partkey", "l_linenumber",
        )
        ties = [F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")]
        out = SC.aggregate_to_gene(rows, ["l_suppkey"], mode, tiebreak=ties)
        return out.select("l_suppkey", "gene_id", r6("score", 4).alias("score"))

    return run


def _aggregate_sql(expr):
    return f"""WITH b AS (SELECT l_suppkey, p_brand AS gene_id, l_extendedprice - 30000.0 AS v, l_quantity / 53.0 AS lw,
    l_orderkey, l_partkey, l_linenumber FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT l_suppkey, gene_id, round({expr}, 4) AS score FROM b GROUP BY l_suppkey, gene_id"""


def promoter_distal_bias(spark, d):
    """Included features keep their weight, masked ones count as 0; bias of the two masks per brand."""
    f = part_features(spark, d).select(
        "l_suppkey", F.col("p_brand").alias("gene_id"), "l_extendedprice",
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).otherwise(0.0).alias("w_in"),
        F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice")).otherwise(0.0).alias("w_out"),
    )
    agg = lambda c: f.groupBy("l_suppkey", "gene_id").agg(F.sum(c).alias("score")).filter("score <> 0")
    out = SC.combine_ratio(agg("w_out"), agg("w_in"), ["l_suppkey"])
    return out.select("l_suppkey", "gene_id", r6("score").alias("score"))


SQL_BIAS = """WITH b AS (SELECT l_suppkey, p_brand AS gene_id,
    sum(CASE WHEN l_returnflag <> 'R' THEN l_extendedprice ELSE 0 END) AS dist,
    sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END) AS prom
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT l_suppkey, gene_id, round(log2((dist + 1e-6) / (prom + 1e-6)), 6) AS score FROM b"""


def baseline_residual(spark, d):
    """Supplier x brand scores against the brand's median and MAD over suppliers."""
    s = part_features(spark, d).groupBy("l_suppkey", F.col("p_brand").alias("gene_id")).agg(F.sum("l_quantity").alias("score"))
    base = ST.median_mad(s, ["gene_id"])
    out = ST.baseline_residual(s, base, ["l_suppkey"], floor_q=0.5)
    return out.select("l_suppkey", "gene_id", r6("score", 4).alias("score"))


SQL_RESIDUAL = """WITH s AS (SELECT l_suppkey, p_brand AS gene_id, sum(l_quantity) AS score
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
b AS (SELECT gene_id, median(score) AS med FROM s GROUP BY gene_id),
m AS (SELECT s.gene_id, any_value(med) AS med, median(abs(score - med)) AS mad FROM s JOIN b USING (gene_id) GROUP BY s.gene_id),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score) AS rn, count(*) OVER (PARTITION BY l_suppkey) AS n FROM s),
f AS (SELECT l_suppkey, max(score) AS fl FROM r WHERE rn = floor(0.5 * (n - 1)) + 1 GROUP BY l_suppkey)
SELECT s.l_suppkey, s.gene_id, round((ln(1 + score) - ln(1 + med)) / (abs(ln(1 + med + mad) - ln(1 + med)) + 1e-6), 4) AS score
FROM s JOIN f ON s.l_suppkey = f.l_suppkey AND score >= fl JOIN m ON s.gene_id = m.gene_id"""


QUERIES = {
    "interval_overlap_join": (interval_overlap_join, SQL_OVERLAP),
    "external_link_overlap": (external_link_overlap, SQL_EXTERNAL),
    "overlap_max_prior": (overlap_max_prior, SQL_MAX_PRIOR),
    "overlap_mask": (overlap_mask, SQL_MASK),
    "nearest_asof": (nearest_asof, SQL_NEAREST),
    "distance_decay_topk": (distance_decay_topk, SQL_DECAY),
    "segment_gene_overlap": (segment_gene_overlap, SQL_SEGMENT_GENE),
    "chipseq_peak": (chipseq_peak, SQL_CHIPSEQ),
    "linked_gene_score": (linked_gene_score, SQL_LINKED),
    "gene_aggregate_sum": (_aggregate("sum"), _aggregate_sql("sum(v * lw)")),
    "gene_aggregate_mean": (_aggregate("mean"), _aggregate_sql("avg(v * lw)")),
    "gene_aggregate_weighted_mean": (_aggregate("weighted_mean"), _aggregate_sql("sum(v * lw) / sum(abs(lw))")),
    "gene_aggregate_max_abs": (
        _aggregate("max_abs"),
        _aggregate_sql("arg_max(v * lw, {'m': abs(v * lw), 'a': -l_orderkey, 'b': -l_partkey, 'c': -l_linenumber})"),
    ),
    "promoter_distal_bias": (promoter_distal_bias, SQL_BIAS),
    "baseline_residual": (baseline_residual, SQL_RESIDUAL),
}
