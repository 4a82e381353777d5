"""Assay plans bound end to end to the star-schema tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.linking import DOWN, UP, _PROM
from lociweave.catalog.tables import ANCHORS_SQL, FEATURES_SQL, anchors, features, part_features, r6, table
from lociweave.operators import contrasts as C
from lociweave.operators import factorization as NMF
from lociweave.operators import quality as Q
from lociweave.operators import selection as SEL
from lociweave.plans import accessibility as AX
from lociweave.plans import expression as EX
from lociweave.plans import methylation as ME
from lociweave.plans import proteomics as PR
from lociweave.plans import screens as SX
from lociweave.plans import splicing as SP

LINKS = {"upstream": UP, "downstream": DOWN, "nearest_max": 20, "decay_max": 30, "decay_length": 10.0, "max_genes": 5}

_LINKED = f"""spans AS (SELECT DISTINCT chrom, "start", "end", ("start" + "end") // 2 AS centre FROM features),
fl AS (SELECT s.*, EXISTS (SELECT 1 FROM prom p WHERE s.chrom = p.chrom AND s."start" < p.pe AND p.ps < s."end") AS inp FROM spans s),
nr AS (SELECT c.chrom, c.centre, a.gene_id, 1.0 AS lw FROM (SELECT DISTINCT chrom, centre FROM spans) c JOIN anchors a ON c.chrom = a.chrom AND abs(c.centre - a.tss) <= 20
  QUALIFY row_number() OVER (PARTITION BY c.chrom, c.centre ORDER BY abs(c.centre - a.tss), CASE WHEN a.tss >= c.centre THEN 0 ELSE 1 END,
    CASE WHEN a.tss >= c.centre THEN a.gene_ordinal ELSE -a.gene_ordinal END) = 1),
dc AS (SELECT c.chrom, c.centre, a.gene_id, exp(-abs(c.centre - a.tss) / 10.0) AS lw FROM (SELECT DISTINCT chrom, centre FROM spans) c JOIN anchors a ON c.chrom = a.chrom AND abs(c.centre - a.tss) <= 30
  QUALIFY row_number() OVER (PARTITION BY c.chrom, c.centre ORDER BY exp(-abs(c.centre - a.tss) / 10.0) DESC, a.gene_id) <= 5),
ln AS (SELECT 'nearest_tss' AS link_method, s.chrom, s."start", s."end", gene_id, lw FROM spans s JOIN nr USING (chrom, centre)
  UNION ALL SELECT 'distance_decay', s.chrom, s."start", s."end", gene_id, lw FROM spans s JOIN dc USING (chrom, centre))"""


def atac_bulk(spark, d):
    """Connectable grid with positive weights above 50k, top 40 genes per program and link."""
    f = features(spark, d).withColumn("weight", F.col("weight") - 50000.0)
    out = AX.atac_bulk(f, anchors(spark, d), select={"how": "top_k", "k": 40}, **LINKS)
    return out.select("program", "link_method", "gene_id", "rank", r6("score", 3).alias("score"), r6("weight", 8).alias("weight"))


SQL_ATAC = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM}, {_LINKED},
w AS (SELECT chrom, "start", "end", sum(greatest(weight - 50000.0, 0)) AS w FROM features GROUP BY ALL),
sc AS (SELECT CASE link_method WHEN 'nearest_tss' THEN 'linked_activity' ELSE 'distal_activity' END AS program, link_method, gene_id,
   sum(CASE WHEN link_method = 'nearest_tss' OR NOT inp THEN w ELSE 0 END * lw) AS score
  FROM w JOIN fl USING (chrom, "start", "end") JOIN ln USING (chrom, "start", "end") GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM sc WHERE score <> 0),
t AS (SELECT * FROM r WHERE rank <= 40)
SELECT program, link_method, gene_id, rank, round(score, 3) AS score, round(score / sum(score) OVER (PARTITION BY program), 8) AS weight FROM t"""


def atac_enhancer_bias(spark, d):
    f = features(spark, d)
    s = AX.program_scores(f, anchors(spark, d), grid=[("enhancer_bias", "distance_decay")], **LINKS)
    return s.select("gene_id", r6("score", 5).alias("score"))


SQL_ENH = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM}, {_LINKED},
w AS (SELECT chrom, "start", "end", sum(weight) AS w FROM features GROUP BY ALL),
sc AS (SELECT gene_id, sum(CASE WHEN inp THEN 0 ELSE w END * lw) AS ds, sum(CASE WHEN inp THEN w ELSE 0 END * lw) AS pr
  FROM w JOIN fl USING (chrom, "start", "end") JOIN ln USING (chrom, "start", "end") WHERE link_method = 'distance_decay' GROUP BY ALL)
SELECT gene_id, round(log2((ds + 1e-6) / (pr + 1e-6)), 5) AS score FROM sc WHERE ds <> 0 OR pr <> 0"""


def atac_group_vs_rest(spark, d):
    """Cells = orders, peaks = suppliers' order-day spans; OPEN part of group vs rest, nearest genes."""
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderpriority").alias("group"))
    e = li.select(F.col("l_orderkey").alias("cell_id"), F.col("l_suppkey").alias("feature_id"), F.col("l_quantity").alias("value"))
    s = table(spark, d, "supplier")
    start = (F.lit(8900) + F.col("s_suppkey") * 17 % 2000).cast("long")
    feats = s.select(F.col("s_suppkey").alias("feature_id"), F.col("s_suppkey").alias("chrom"), start.alias("start"), (start + 40).alias("end"))
    x = C.group_vs_rest(e, o, "mean").withColumn("weight", C.contrast_value("group_score", "rest_score"))
    out = AX.program_scores(x.join(feats, "feature_id"), anchors(spark, d), ["group"], [("linked_activity", "nearest_tss")], **LINKS)
    return out.select("group", "gene_id", r6("score", 7).alias("score"))


SQL_GVR = f"""WITH {ANCHORS_SQL}, n AS (SELECT o_orderpriority AS grp, count(*) AS n FROM orders GROUP BY 1), al AS (SELECT count(*) AS n FROM orders),
p AS (SELECT o_orderpriority AS grp, l_suppkey AS f, sum(l_quantity) AS s FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
t AS (SELECT f, sum(s) AS ts FROM p GROUP BY 1),
x AS (SELECT n.grp, t.f, log2((coalesce(s, 0) / n.n + 1) / ((ts - coalesce(s, 0)) / (al.n - n.n) + 1)) AS w FROM t CROSS JOIN n CROSS JOIN al LEFT JOIN p ON p.grp = n.grp AND p.f = t.f),
c AS (SELECT s_suppkey AS f, s_suppkey AS chrom, 8900 + s_suppkey * 17 % 2000 + 20 AS centre FROM supplier),
nr AS (SELECT f, a.gene_id FROM c JOIN anchors a ON c.chrom = a.chrom AND abs(c.centre - a.tss) <= 20
  QUALIFY row_number() OVER (PARTITION BY f ORDER BY abs(c.centre - a.tss), CASE WHEN a.tss >= c.centre THEN 0 ELSE 1 END, CASE WHEN a.tss >= c.centre THEN a.gene_ordinal ELSE -a.gene_ordinal END) = 1)
SELECT grp AS "group", gene_id, round(sum(w), 7) AS score FROM x JOIN nr USING (f) WHERE w > 0 GROUP BY ALL"""


def _de(spark, d):
    p = part_features(spark, d)
    return p.select(
        F.col("l_returnflag").alias("comparison_id"), F.concat_ws(".", "p_brand", "p_size").alias("gene_id"),
        F.when(F.col("p_size") % 2 == 0, F.concat("p_brand", F.lit("s"), "p_size")).alias("gene_symbol"),
        ((F.col("l_extendedprice") - 30000.0) / 10000.0).alias("logfc"), (F.col("l_discount") / 2 + F.col("l_quantity") / 1000).alias("padj"),
        (F.col("l_orderkey") * 1000003 + F.col("l_suppkey") * 101 + F.col("l_linenumber")).alias("row_ordinal"),
    )


DE = """de AS (SELECT l_returnflag AS comparison_id, p_brand || '.' || p_size AS gene_id, (l_extendedprice - 30000.0) / 10000.0 AS logfc, l_discount / 2 + l_quantity / 1000 AS padj,
  l_orderkey * 1000003 + l_suppkey * 101 + l_linenumber AS ord FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def rna_deg_multi(spark, d):
    """All comparisons in one job: padj filter, logFC x -log10 p, duplicates by largest magnitude, top 50."""
    out = EX.rna_deg(_de(spark, d), ["comparison_id"], duplicates="max_abs", padj_max=0.05, min_abs_logfc=0.5, exclude=["^Brand#2[0-9]"], select={"how": "top_k", "k": 50})
    return out.select("comparison_id", "gene_id", "n_rows", "rank", r6("score").alias("score"), r6("weight", 9).alias("weight"))


SQL_DEG = f"""WITH {DE}, s AS (SELECT *, logfc * least(-log10(least(1, greatest(1e-300, padj)) + 1e-300), 50) AS sc FROM de WHERE padj <= 0.05 AND abs(logfc) >= 0.5),
m AS (SELECT comparison_id, gene_id, count(*) AS n_rows, arg_min(sc, {{'m': -abs(sc), 'o': ord}}) AS score FROM s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY comparison_id ORDER BY abs(score) DESC, gene_id) AS rank FROM m WHERE NOT regexp_matches(gene_id, '^Brand#2[0-9]'))
SELECT comparison_id, gene_id, n_rows, rank, round(score, 6) AS score, round(abs(score) / sum(abs(score)) OVER (PARTITION BY comparison_id), 9) AS weight FROM r WHERE rank <= 50"""


def harmonizome_signatures(spark, d):
    out = EX.harmonizome_signatures(_de(spark, d), duplicates="mean", exclude=())
    return out.select("comparison_id", "gene_id", "rank", r6("score").alias("score"))


SQL_HARM = f"""WITH {DE}, s AS (SELECT *, CASE WHEN logfc > 0 THEN 1 WHEN logfc < 0 THEN -1 END * least(-log10(least(1, greatest(1e-300, padj)) + 1e-300), 50) AS sc FROM de WHERE padj <= 0.05),
m AS (SELECT comparison_id, gene_id, avg(sc) AS score FROM s WHERE sc IS NOT NULL GROUP BY ALL HAVING abs(avg(sc)) >= 1.30103),
r AS (SELECT *, row_number() OVER (PARTITION BY comparison_id ORDER BY abs(score) DESC, gene_id) AS rank FROM m)
SELECT comparison_id, gene_id, rank, round(score, 6) AS score FROM r WHERE rank <= 250"""


def rna_sc_programs(spark, d):
    p = part_features(spark, d).groupBy(F.col("l_suppkey").cast("string").alias("program"), F.col("p_brand").alias("gene_id")).agg(F.avg(F.col("l_quantity") - 25.0).alias("score"))
    out = EX.rna_sc_programs(p, "positive", exclude=["^brand#1$"], select={"how": "quantile", "q": 0.2})
    return out.select("program", "gene_id", "gene_symbol", "rank", r6("weight", 8).alias("weight"))


SQL_PROGRAMS = """WITH p AS (SELECT CAST(l_suppkey AS VARCHAR) AS program, p_brand AS gene_id, greatest(avg(l_quantity - 25.0), 0) AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank, count(*) OVER (PARTITION BY program) AS n FROM p WHERE score <> 0 AND gene_id <> 'Brand#1'),
t AS (SELECT * FROM r WHERE rank <= greatest(1, ceil(n * 0.2)))
SELECT program, gene_id, gene_id AS gene_symbol, rank, round(score / sum(score) OVER (PARTITION BY program), 8) AS weight FROM t"""


def sc_rna_marker(spark, d):
    p = part_features(spark, d).select(F.col("p_brand").alias("gene_id"), F.col("l_orderkey").alias("cell_id"), F.col("l_quantity").alias("value"))
    g = table(spark, d, "orders").select(F.col("o_orderkey").alias("cell_id"), F.col("o_orderstatus").alias("group"))
    return EX.sc_rna_marker(p, g, "mean").select("group", "gene_id", "rank", r6("score").alias("score"), r6("weight", 9).alias("weight"))


SQL_MARKER = """WITH n AS (SELECT o_orderstatus AS grp, count(*) AS n FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1),
s AS (SELECT o_orderstatus AS grp, p_brand AS gene_id, sum(l_quantity) / any_value(n) AS score FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN n ON n.grp = o_orderstatus GROUP BY ALL)
SELECT grp AS "group", gene_id, row_number() OVER (PARTITION BY grp ORDER BY score DESC, gene_id) AS rank, round(score, 6) AS score, round(score / sum(score) OVER (PARTITION BY grp), 9) AS weight FROM s"""


def rna_de_prepare(spark, d):
    """Counts = quantity per (supplier, brand), groups by supplier nation; every group against the rest, BH per contrast."""
    counts = part_features(spark, d).groupBy(F.col("l_suppkey").alias("sample_id"), F.col("p_brand").alias("gene_id")).agg(F.sum("l_quantity").alias("value"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("sample_id"), F.concat(F.lit("g"), F.col("s_nationkey") % 3).alias("condition"), (F.col("s_acctbal") / 1000).alias("age"))
    de, _ = EX.rna_de_prepare(counts, s, C.level_contrasts(s, "group_vs_rest", "condition"), ["age"])
    return de.select("comparison_id", "gene_id", r6("logfc", 7).alias("logfc"), r6("stat", 5).alias("stat"))


# Frisch-Waugh: residuals of y and of the group indicator on (1, age) give the group coefficient.
SQL_DEPREP = """WITH counts AS (SELECT l_suppkey AS sample_id, p_brand AS gene_id, sum(l_quantity) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
s AS (SELECT s_suppkey AS sample_id, 'g' || (s_nationkey % 3) AS grp, s_acctbal / 1000 AS age FROM supplier),
g AS (SELECT DISTINCT grp FROM s),
cp AS (SELECT c.*, grp, value / sum(value) OVER (PARTITION BY sample_id) * 1e6 AS cpm FROM counts c JOIN s USING (sample_id)),
need AS (SELECT g.grp, greatest(2, least(count(*) FILTER (s.grp = g.grp), count(*) FILTER (s.grp <> g.grp))) AS need FROM s, g GROUP BY 1),
expr AS (SELECT g.grp, gene_id FROM cp, g, need WHERE need.grp = g.grp AND cpm >= 1 GROUP BY g.grp, gene_id
  HAVING greatest(count(*) FILTER (cp.grp = g.grp), count(*) FILTER (cp.grp <> g.grp)) >= any_value(need)),
yk AS (SELECT expr.grp, sample_id, gene_id, log2(value / sum(value) OVER (PARTITION BY expr.grp, sample_id) * 1e6 + 0.5) AS y FROM counts JOIN expr USING (gene_id)),
d AS (SELECT g.grp, s.sample_id, CASE WHEN s.grp = g.grp THEN 1.0 ELSE 0.0 END AS x, age FROM s, g),
dx AS (SELECT *, x - avg(x) OVER w - (covar_pop(x, age) OVER w / var_pop(age) OVER w) * (age - avg(age) OVER w) AS xr, count(*) OVER w AS n FROM d WINDOW w AS (PARTITION BY grp)),
j AS (SELECT dx.grp, gene_id, dx.sample_id, xr, age, y, n FROM dx JOIN yk ON yk.grp = dx.grp AND yk.sample_id = dx.sample_id),
k AS (SELECT grp, gene_id, any_value(n) AS n, sum(xr * y) / sum(xr * xr) AS b, sum(xr * xr) AS sxx, var_pop(y) * count(*) - (covar_pop(y, age) * count(*)) * (covar_pop(y, age) * count(*)) / (var_pop(age) * count(*)) AS ryy FROM j GROUP BY ALL)
SELECT grp || '_vs_rest' AS comparison_id, gene_id, round(b, 7) AS logfc, round(b / sqrt((ryy - b * b * sxx) / (n - 3) / sxx), 5) AS stat FROM k"""


def methylation_programs(spark, d):
    f = features(spark, d).select("chrom", "start", "end", ((F.col("weight") - 50000.0) / 10000.0).alias("delta"), (F.col("line_no") / 100.0).alias("padj"))
    f = ME.score_features(f.withColumn("chrom", F.col("chrom").cast("string")))
    g = anchors(spark, d).withColumn("chrom", F.concat(F.lit("chr"), F.col("chrom")))
    out = ME.methylation_programs(f, g, select={"how": "top_k", "k": 30}, **LINKS)
    return out.select("program", "link_method", "gene_id", "rank", r6("score").alias("score"))


SQL_METH = f"""WITH {FEATURES_SQL}, {ANCHORS_SQL}, {_PROM}, {_LINKED},
v AS (SELECT f.chrom, f."start", f."end", inp, -(weight - 50000.0) / 10000.0 * least(-log10(line_no / 100.0 + 1e-300), 50) AS v FROM features f JOIN fl USING (chrom, "start", "end")),
pl AS (SELECT DISTINCT s.chrom, s."start", s."end", p.gene_id FROM spans s JOIN prom p ON s.chrom = p.chrom AND s."start" < p.pe AND p.ps < s."end"),
sc AS (SELECT 'promoter_activity' AS program, 'promoter_overlap' AS link_method, gene_id, avg(CASE WHEN inp THEN v ELSE 0 END) AS score FROM v JOIN pl USING (chrom, "start", "end") GROUP BY gene_id
  UNION ALL SELECT 'distal_activity', 'distance_decay', gene_id, sum(CASE WHEN inp THEN 0 ELSE v END * lw) / sum(lw) FROM v JOIN ln USING (chrom, "start", "end") WHERE link_method = 'distance_decay' GROUP BY gene_id),
r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY abs(score) DESC, gene_id) AS rank FROM sc WHERE score <> 0)
SELECT program, link_method, gene_id, rank, round(score, 6) AS score FROM r WHERE rank <= 30"""


def drug_response_screen(spark, d):
    from lociweave.catalog.screening import _edges, _groups

    p = part_features(spark, d).select(F.col("l_suppkey").alias("sample_id"), F.concat_ws("/", "p_brand", F.col("p_size") % 10).alias("drug_id"), F.col("l_quantity").alias("response"))
    out = SX.drug_response_screen(p, _edges(spark, d), _groups(spark, d), select={"how": "top_k", "k": 10})
    return out.select("program", "gene_id", "rank", r6("score", 5).alias("score"))


def _drug_sql():
    from lociweave.catalog.screening import E_, G

    return f"""WITH r AS (SELECT l_suppkey AS sample_id, p_brand || '/' || (p_size % 10) AS drug_id, -avg(l_quantity) AS r FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
m AS (SELECT drug_id, median(r) AS med FROM r GROUP BY 1), a AS (SELECT r.drug_id, any_value(med) AS med, median(abs(r - med)) AS mad FROM r JOIN m USING (drug_id) GROUP BY 1),
z AS (SELECT sample_id, drug_id, (r - med) / (mad + 1e-6) AS z FROM r JOIN a USING (drug_id)), {G}, {E_},
t AS (SELECT drug_id, sum(z) AS ts, count(*) AS tn FROM z GROUP BY 1),
g AS (SELECT grp, drug_id, sum(z) AS s, count(*) AS n FROM z JOIN groups USING (sample_id) GROUP BY ALL),
prog AS (SELECT grp || '_vs_rest' AS program, drug_id, s / n - (ts - s) / (tn - n) AS score FROM g JOIN t USING (drug_id) WHERE tn > n),
u AS (SELECT drug_id, 1 / (0.05 + count(DISTINCT CASE WHEN z > 1 THEN sample_id END) / CAST((SELECT count(DISTINCT sample_id) FROM z) AS DOUBLE)) AS w FROM z GROUP BY 1),
po AS (SELECT drug_id, 1 / (1 + ln(1 + count(DISTINCT gene_id) / 5.0)) AS w FROM edges GROUP BY 1),
gw AS (SELECT gene_id, ln(((SELECT count(DISTINCT drug_id) FROM edges) + 1.0) / (count(DISTINCT drug_id) + 1.0)) AS w FROM edges GROUP BY 1),
s AS (SELECT program, e.gene_id, sum(score * u.w * po.w * gw.w * e.weight) AS score FROM prog JOIN edges e USING (drug_id) JOIN u USING (drug_id) JOIN po USING (drug_id) JOIN gw ON gw.gene_id = e.gene_id WHERE score > 0 GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM s WHERE score <> 0)
SELECT program, gene_id, rank, round(score, 5) AS score FROM k WHERE rank <= 10"""


def proteomics_diff(spark, d):
    p = part_features(spark, d).select(F.col("l_returnflag").alias("program"), F.col("p_brand").alias("gene_id"), (F.col("l_quantity") - 25.0).alias("logfc"))
    return PR.proteomics_diff(p, ["program"]).select("program", "gene_id", "rank", "score", r6("weight", 9).alias("weight"))


SQL_PROT = """WITH s AS (SELECT l_returnflag AS program, p_brand AS gene_id, abs(sum(l_quantity - 25.0)) AS score FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)
SELECT program, gene_id, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank, score, round(score / sum(score) OVER (PARTITION BY program), 9) AS weight FROM s"""


def ptm_site_diff(spark, d):
    p = part_features(spark, d).select(
        F.col("l_returnflag").alias("contrast_id"), F.concat_ws("-", "p_brand", "p_type", "p_size").alias("protein_accession"), F.lit("S").alias("residue"), F.col("p_size").alias("position"),
        F.col("p_brand").alias("gene_id"), F.col("p_brand").alias("gene_symbol"), ((F.col("l_extendedprice") - 30000) / 10000).alias("logfc"), (F.col("l_tax") + 0.001).alias("pvalue"),
        (0.5 + F.col("l_discount") * 5).alias("localization_prob"), F.col("l_quantity").alias("peptide_count"), (F.col("l_linenumber") / 10.0).alias("protein_logfc"),
        (F.col("l_orderkey") * 1000003 + F.col("l_suppkey") * 101 + F.col("l_linenumber")).alias("row_ordinal"),
    )
    out = PR.ptm_site_diff(p, ["contrast_id"], select={"how": "none", "normalize": "l1"})
    return out.select("contrast_id", "gene_id", "rank", r6("score").alias("score"), r6("weight", 8).alias("weight"))


SQL_PTM = """WITH r AS (SELECT l_returnflag AS c, p_brand || '-' || p_type || '-' || p_size AS k, p_brand AS gene_id, (l_extendedprice - 30000) / 10000 AS lf, l_tax + 0.001 AS p, 0.5 + l_discount * 5 AS loc,
   l_quantity AS pep, l_linenumber / 10.0 AS pr, l_orderkey * 1000003 + l_suppkey * 101 + l_linenumber AS ord, max(l_quantity) OVER (PARTITION BY l_returnflag) AS mp FROM lineitem JOIN part ON l_partkey = p_partkey),
w AS (SELECT *, lf * least(-log10(p), 50) - pr AS adj, least(-log10(p), 50) / 50 * CASE WHEN loc < 0.75 THEN 0 ELSE greatest(0, least(1, (loc - 0.75) / 0.25)) END * least(1, ln(1 + pep) / ln(1 + mp)) AS cw FROM r),
o AS (SELECT c, k, gene_id, adj * cw AS f FROM w QUALIFY row_number() OVER (PARTITION BY c, k, gene_id ORDER BY cw * greatest(1e-6, abs(adj)) DESC, abs(adj * cw) DESC, ord) = 1),
t AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY c, gene_id ORDER BY abs(f) DESC, k || '|S|' || split_part(k, '-', 3) || '|generic') <= 3),
s AS (SELECT c, gene_id, avg(f) AS score FROM t GROUP BY ALL)
SELECT c AS contrast_id, gene_id, row_number() OVER (PARTITION BY c ORDER BY abs(score) DESC, gene_id) AS rank, round(score, 6) AS score, round(abs(score) / sum(abs(score)) OVER (PARTITION BY c), 8) AS weight FROM s"""


def splice_event_diff(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    p = part_features(spark, d).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    e = p.select(
        F.col("l_returnflag").alias("contrast_id"), F.concat_ws("-", "p_brand", "p_size").alias("event_id"), F.col("p_type").alias("event_group"),
        F.when(F.col("p_size") % 3 == 0, "SE").when(F.col("p_size") % 3 == 1, "RI").otherwise("MXE").alias("event_type"), F.col("p_brand").alias("gene_id"), F.col("p_brand").alias("gene_symbol"),
        F.concat(F.lit("chr"), "s_nationkey").alias("chrom"), (F.col("p_size") * 1000000).alias("start"), (F.col("p_size") * 1000000 + 100).alias("end"),
        ((F.col("l_extendedprice") - 30000) / 100000).alias("delta_psi"), (F.col("l_tax") + 0.001).alias("pvalue"), F.col("l_quantity").alias("read_support"),
        (F.col("l_orderkey") * 1000003 + F.col("l_suppkey") * 101 + F.col("l_linenumber")).alias("row_ordinal"),
    )
    out = SP.splice_event_diff(e, ["contrast_id"], diversity="window_diversity", select={"how": "none", "normalize": "l1"})
    return out.select("contrast_id", "gene_id", "rank", "n_groups", r6("burden_penalty").alias("burden_penalty"), r6("diversity_penalty").alias("diversity_penalty"), r6("score", 7).alias("score"))


SQL_SPLICE = """WITH r AS (SELECT l_returnflag AS c, p_type AS grp, p_brand AS gene_id, 'chr' || s_nationkey AS chrom, p_size, l_quantity AS reads, (l_extendedprice - 30000) / 100000 AS dp, l_tax + 0.001 AS p,
   'chr' || s_nationkey || ':' || (p_size * 1000000) || '-' || (p_size * 1000000 + 100) || ':.:' || CASE p_size % 3 WHEN 0 THEN 'exon_skip' WHEN 1 THEN 'retained_intron' ELSE 'mutually_exclusive_exon' END || ':' || p_type AS k,
   l_orderkey * 1000003 + l_suppkey * 101 + l_linenumber AS ord, max(l_quantity) OVER (PARTITION BY l_returnflag) AS mr FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
w AS (SELECT *, dp * least(-log10(p), 50) AS x, least(-log10(p), 50) / 50 AS pw, CASE WHEN reads < 10 THEN 0 ELSE least(1, ln(1 + reads) / ln(1 + mr)) END AS rw FROM r),
f AS (SELECT *, x * least(1, abs(dp) / 0.05) * (pw * rw) * CASE WHEN p_size % 3 = 1 THEN 1 + 0.4 * (0.92 - 1) ELSE 1 + 0.4 * (1.1 - 1) END AS fs, pw * greatest(1e-6, abs(x)) AS q FROM w),
o AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY c, k, gene_id ORDER BY q DESC, abs(fs) DESC, ord) = 1),
e AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY c, gene_id, grp ORDER BY abs(fs) DESC, q DESC, ord) = 1),
t AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY c, gene_id ORDER BY abs(fs) DESC, k) <= 3),
g AS (SELECT c, gene_id, avg(fs) AS s0, count(DISTINCT grp) AS n_groups, CASE WHEN sum(abs(fs)) > 0 THEN abs(sum(fs)) / sum(abs(fs)) ELSE 0 END AS coh FROM t GROUP BY ALL),
b AS (SELECT c, gene_id, count(DISTINCT grp) AS ng, arg_min(chrom || ':' || (p_size * 1000000 + 50) // 20000000, {'a': -abs(fs), 'q': -q, 'o': ord}) AS locus FROM e GROUP BY ALL),
x AS (SELECT g.*, locus, greatest(0.35, least(1, sqrt(3.0 / greatest(3, ng)))) AS bp, s0 * greatest(0.55, least(1.0, CASE WHEN n_groups >= 2 THEN 1.0 ELSE 0.85 END * (0.75 + 0.25 * coh))) * greatest(0.35, least(1, sqrt(3.0 / greatest(3, ng)))) AS s1 FROM g JOIN b USING (c, gene_id)),
y AS (SELECT *, 1 / sqrt(row_number() OVER (PARTITION BY c, locus ORDER BY abs(s1) DESC, gene_id)) AS dv FROM x)
SELECT c AS contrast_id, gene_id, row_number() OVER (PARTITION BY c ORDER BY abs(s1 * dv) DESC, gene_id) AS rank, n_groups, round(bp, 6) AS burden_penalty, round(dv, 6) AS diversity_penalty, round(s1 * dv, 7) AS score FROM y"""


def nmf_programs(spark, d):
    p = part_features(spark, d).select(F.col("l_suppkey").alias("cell_id"), F.col("p_brand").alias("gene_id"), F.col("l_quantity").alias("value"))
    _, h = NMF.nmf_programs(p, 3)
    return NMF.loadings_long(h, 3).select("program", "gene_id", r6("score", 4).alias("score"))


def marker_panel(spark, d):
    from lociweave.catalog.ranking import _scores

    s = _scores(spark, d).filter("score > 0").withColumn("gene_symbol", F.lit(None).cast("string"))
    sel = SEL.select_and_weight(s, ["program"], how="top_k", k=50)
    panels = table(spark, d, "part").select(F.col("p_type").alias("panel"), F.col("p_partkey").cast("string").alias("token"))
    out = Q.marker_panel(s, sel, panels, ["program"])
    return out.select("program", "panel", "top_hits", "selected_hits", r6("weight_fraction").alias("weight_fraction"), "confidence")


SQL_PANEL = """WITH s AS (SELECT l_returnflag AS program, CAST(l_partkey AS VARCHAR) AS gene_id, sum(l_quantity - 25.0) AS score FROM lineitem GROUP BY ALL HAVING sum(l_quantity - 25.0) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rk FROM s),
w AS (SELECT *, score / sum(score) OVER (PARTITION BY program) AS w FROM r WHERE rk <= 50),
j AS (SELECT program, p_type AS panel, count(*) FILTER (rk <= 20) AS top_hits, count(*) AS selected_hits, sum(w) AS wf FROM w JOIN part ON gene_id = CAST(p_partkey AS VARCHAR) GROUP BY ALL)
SELECT program, panel, top_hits, selected_hits, round(wf, 6) AS weight_fraction, CASE WHEN wf >= 0.25 OR top_hits >= 3 THEN 'low' WHEN wf >= 0.15 OR top_hits >= 2 THEN 'medium' ELSE 'high' END AS confidence FROM j"""


def output_validation(spark, d):
    """Violations of an unmerged table: genes repeat within a program."""
    li = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("program"), F.col("l_partkey").cast("string").alias("gene_id"), F.col("l_quantity").alias("score"))
    return Q.validate_rows(li, ["program"]).select("program", "repeated_genes", "bad_score")


SQL_VALID = """SELECT l_returnflag AS program, CAST(count(*) - count(DISTINCT l_partkey) AS BIGINT) AS repeated_genes, CAST(0 AS BIGINT) AS bad_score FROM lineitem GROUP BY 1"""


QUERIES = {
    "atac_bulk": (atac_bulk, SQL_ATAC),
    "atac_enhancer_bias": (atac_enhancer_bias, SQL_ENH),
    "atac_group_vs_rest": (atac_group_vs_rest, SQL_GVR),
    "rna_deg_multi": (rna_deg_multi, SQL_DEG),
    "harmonizome_signatures": (harmonizome_signatures, SQL_HARM),
    "rna_sc_programs": (rna_sc_programs, SQL_PROGRAMS),
    "sc_rna_marker": (sc_rna_marker, SQL_MARKER),
    "rna_de_prepare": (rna_de_prepare, SQL_DEPREP),
    "methylation_programs": (methylation_programs, SQL_METH),
    "drug_response_screen": (drug_response_screen, _drug_sql()),
    "proteomics_diff": (proteomics_diff, SQL_PROT),
    "ptm_site_diff": (ptm_site_diff, SQL_PTM),
    "splice_event_diff": (splice_event_diff, SQL_SPLICE),
    "nmf_programs": (nmf_programs, None),
    "marker_panel": (marker_panel, SQL_PANEL),
    "output_validation": (output_validation, SQL_VALID),
}
