"""Label expansion bound to customers as queries, parts as references and brands as genes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import r6, table
from lociweave.operators import expansion as X
from lociweave.operators.joins import attach_total
from lociweave.session import materialize

KINDS = {0: "compound", 1: "compound", 2: "orf", 3: "crispr"}


def _kind(key: str, n: int):
    out = F.lit("compound")
    for k, name in (("2", "orf"), ("3", "crispr")) if n == 4 else (("1", "orf"), ("2", "crispr")):
        out = F.when(F.col(key) % n == int(k), name).otherwise(out)
    return out


def _world(spark, d):
    """Queries, their neighbours by return flag, genes of references, labels of genes, own genes."""
    c, p = table(spark, d, "customer"), table(spark, d, "part")
    queries = c.select(F.col("c_custkey").alias("query_id"), _kind("c_custkey", 4).alias("query_modality"), (F.col("c_acctbal") < 0).alias("exact"))
    refs = p.select(F.col("p_partkey").alias("ref_id"), _kind("p_partkey", 3).alias("modality"))
    lines = table(spark, d, "orders").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    pairs = lines.groupBy(F.col("o_custkey").alias("query_id"), F.col("l_partkey").alias("ref_id"), F.col("l_returnflag").alias("flag")).agg(F.sum("l_quantity").cast("double").alias("evidence"))
    pairs = pairs.join(queries.select("query_id", "query_modality"), "query_id").join(refs, "ref_id")
    second = F.concat(F.lit("Brand#"), F.col("p_size") % 5 + 1, F.col("p_size") % 5 + 1)
    genes = p.select(F.col("p_partkey").alias("ref_id"), F.inline(F.array(F.struct(F.col("p_brand").alias("gene_id"), F.lit(0.5).alias("weight")), F.struct(second.alias("gene_id"), F.lit(0.25).alias("weight")))))
    genes = genes.groupBy("ref_id", "gene_id").agg(F.sum("weight").alias("weight"))
    digit = lambda k: F.substring("gene_id", 6 + k, 1)
    labels = genes.select("gene_id").distinct().select("gene_id", F.inline(F.array(*[
        F.struct(F.lit(level).alias("level"), label.alias("label"))
        for level, label in (("pathway_seed", F.col("gene_id")), ("target_class", F.concat(F.lit("c"), digit(2))), ("mechanism_label", F.concat(F.lit("m"), digit(1))), ("target_family", F.concat(F.lit("f"), (digit(1).cast("int") % 2).cast("string"))))
    ])))
    own = c.select(F.col("c_custkey").alias("query_id"), F.concat(F.lit("Brand#"), F.col("c_nationkey") % 5 + 1, F.col("c_custkey") % 5 + 1).alias("gene_id"))
    return queries, pairs, genes, labels, own


WORLD = """q AS (SELECT c_custkey AS query_id, CASE c_custkey % 4 WHEN 2 THEN 'orf' WHEN 3 THEN 'crispr' ELSE 'compound' END AS qm, c_acctbal < 0 AS exact FROM customer),
ref AS (SELECT p_partkey AS ref_id, CASE p_partkey % 3 WHEN 1 THEN 'orf' WHEN 2 THEN 'crispr' ELSE 'compound' END AS rm FROM part),
pairs AS (SELECT p.*, qm, rm FROM (SELECT o_custkey AS query_id, l_partkey AS ref_id, l_returnflag AS flag, CAST(sum(l_quantity) AS DOUBLE) AS e
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL) p JOIN q USING (query_id) JOIN ref USING (ref_id)),
g AS (SELECT ref_id, gene, CAST(sum(w) AS DOUBLE) AS w FROM (SELECT p_partkey AS ref_id, p_brand AS gene, 0.5 AS w FROM part
  UNION ALL SELECT p_partkey, 'Brand#' || (p_size % 5 + 1) || (p_size % 5 + 1), 0.25 FROM part) GROUP BY ALL),
lab AS (SELECT gene, unnest([0, 1, 2, 3]) AS lv, unnest([gene, 'c' || gene[8], 'm' || gene[7], 'f' || (CAST(gene[7] AS INT) % 2)]) AS label FROM (SELECT DISTINCT gene FROM g)),
own AS (SELECT c_custkey AS query_id, 'Brand#' || (c_nationkey % 5 + 1) || (c_custkey % 5 + 1) AS gene FROM customer),
rl AS (SELECT ref_id, lv, label, least(1, sum(w)) AS w FROM g JOIN lab USING (gene) GROUP BY ALL),
named AS (SELECT DISTINCT query_id, lv, label FROM own JOIN lab USING (gene))"""


def _pools(pairs):
    by = ["query_id", "ref_id", "modality", "query_modality"]
    # The vote adds up a reference's rows.
    return pairs.select(*by, "evidence"), pairs.filter("flag = 'N'").select(*by, "evidence"), pairs.filter("flag = 'R'").select(*by, "evidence")


def _decisions(spark, d, mode):
    queries, pairs, genes, labels, own = _world(spark, d)
    raw, voted, kept = _pools(materialize(pairs))
    return X.expansion_decision(queries, raw, voted, kept, X.reference_labels(genes, labels), X.own_labels(own, labels), queries.filter("exact"), mode), kept, genes, labels, own


def expansion_decision(spark, d):
    out = _decisions(spark, d, "mechanism")[0]
    return out.select("query_id", "allow", "reason", "level", "label", r6("confidence").alias("confidence"), "raw_kept_mismatch", "raw_voted_mismatch")


def _rules(mode: str) -> str:
    return f"""{WORLD},
nb AS (SELECT 'raw' AS pool, query_id, ref_id, qm, rm, sum(e) AS e FROM pairs GROUP BY ALL
  UNION ALL SELECT 'own', query_id, ref_id, qm, rm, sum(e) FROM pairs WHERE qm = rm GROUP BY ALL
  UNION ALL SELECT CASE flag WHEN 'N' THEN 'voted' ELSE 'kept' END, query_id, ref_id, qm, rm, e FROM pairs WHERE flag IN ('N', 'R')),
v AS (SELECT pool, query_id, lv, label, sum(e * w) AS m, count(DISTINCT ref_id) AS n, count(DISTINCT CASE WHEN qm = rm THEN ref_id END) AS s FROM nb JOIN rl USING (ref_id) GROUP BY ALL),
top AS (SELECT *, m / sum(m) OVER (PARTITION BY pool, query_id, lv) AS share FROM v QUALIFY row_number() OVER (PARTITION BY pool, query_id, lv ORDER BY m DESC, label) = 1),
fit AS (SELECT top.*, named.label IS NOT NULL AS fits FROM top LEFT JOIN named USING (query_id, lv, label)),
wide AS (SELECT query_id, lv, bonus, qm, exact, qm = 'compound' AS comp, qm <> 'compound' AS gen, CASE WHEN qm = 'compound' THEN 0.18 ELSE 0.24 END AS need,
  EXISTS (SELECT 1 FROM named WHERE named.query_id = q.query_id AND named.lv = l.lv) AS named,
  r.label AS rl, coalesce(r.share, 0) AS rm, coalesce(r.n, 0) AS rn, coalesce(r.s, 0) AS rs, coalesce(r.fits, false) AS rf,
  o.label AS ol, coalesce(o.share, 0) AS om, coalesce(o.n, 0) AS "on", coalesce(o.fits, false) AS "of",
  w.label AS wl, coalesce(w.share, 0) AS wm, coalesce(w.n, 0) AS wn, coalesce(w.s, 0) AS ws, coalesce(w.fits, false) AS wf,
  k.label AS kl, coalesce(k.share, 0) AS km, coalesce(k.n, 0) AS kn, coalesce(k.s, 0) AS ks, coalesce(k.fits, false) AS kf
  FROM q CROSS JOIN (VALUES (0, 1.0::DOUBLE), (1, 0.92), (2, 0.85), (3, 0.75)) l(lv, bonus)
  LEFT JOIN (FROM fit WHERE pool = 'raw') r USING (query_id, lv) LEFT JOIN (FROM fit WHERE pool = 'own') o USING (query_id, lv)
  LEFT JOIN (FROM fit WHERE pool = 'voted') w USING (query_id, lv) LEFT JOIN (FROM fit WHERE pool = 'kept') k USING (query_id, lv)),
calc AS (SELECT *, comp AND named AND NOT wf AS astray, comp AND NOT exact AND NOT wf AND (kn <= 2 OR NOT kf) AS lone,
  km * least(1, kn / 2.0) * bonus AS kc, om * least(1, "on" / 4.0) * bonus AS oc, rm * least(1, greatest(rn, rs) / 4.0) * bonus AS rc,
  wm * least(1, wn / 3.0) * bonus * CASE WHEN gen AND ws = 0 THEN 0.65 ELSE 1 END * CASE WHEN rl <> wl THEN 0.75 ELSE 1 END * CASE WHEN rl = wl THEN 1 + least(0.15, 0.5 * rm) ELSE 1 END AS wc,
  bool_or(lv >= 2 AND ((wf AND wm >= 0.18 AND wn >= 2) OR (kf AND km >= 0.15))) OVER (PARTITION BY query_id) AS broad FROM wide),
fired AS (SELECT *, CASE WHEN wl IS NULL THEN NULL
  WHEN astray AND kf AND km >= 0.15 AND kc >= need THEN struct_pack(r := 'retained_query_consistent_label_fallback', l := kl, c := kc)
  WHEN astray AND broad AND lv < 2 THEN NULL
  WHEN comp AND ol <> wl AND ("of" OR NOT named) AND "on" >= greatest(2, wn + 1) AND om >= greatest(0.18, 0.9 * wm) AND wn <= 2 AND NOT (wf AND kf) AND oc >= need THEN struct_pack(r := 'raw_same_modality_coherence_guard', l := ol, c := oc)
  WHEN lone AND "of" AND om >= 0.15 AND "on" >= 2 AND oc >= need THEN struct_pack(r := 'raw_same_modality_query_consistent_label_fallback', l := ol, c := oc)
  WHEN lone AND rf AND rm >= 0.15 AND (rn >= 3 OR rs >= 2) AND rc >= need THEN struct_pack(r := 'raw_query_consistent_label_fallback', l := rl, c := rc)
  WHEN wc >= need THEN struct_pack(r := 'prelabel_coherent_label_support', l := wl, c := wc) END AS f,
  CASE WHEN '{mode}' = 'mechanism' AND gen THEN CASE
    WHEN wf AND ws > 0 AND wm * least(1, greatest(wn, ws) / 2.0) * bonus >= 0.14 THEN struct_pack(r := 'genetic_query_consistent_label_fallback', l := wl, c := wm * least(1, greatest(wn, ws) / 2.0) * bonus)
    WHEN kf AND ks > 0 AND km * least(1, greatest(kn, ks) / 2.0) * bonus >= 0.14 THEN struct_pack(r := 'genetic_query_consistent_label_fallback', l := kl, c := km * least(1, greatest(kn, ks) / 2.0) * bonus) END END AS late FROM calc),
over AS (SELECT fam.query_id, CASE WHEN mec."of" AND mec.om >= 0.15 AND mec."on" >= 2 THEN struct_pack(lv := 2, l := mec.ol, c := mec.om) ELSE struct_pack(lv := 3, l := fam.ol, c := fam.om) END AS o
  FROM fired fam JOIN fired mec ON mec.query_id = fam.query_id AND mec.lv = 2
  WHERE fam.lv = 3 AND fam.comp AND fam."of" AND fam.wl IS NOT NULL AND NOT fam.wf AND fam.wn <= greatest(3, fam."on" - 1) AND fam.om >= 0.2 AND fam."on" >= 2 AND fam.wm <= greatest(1.2 * fam.om, 0.28)),
firsts AS (SELECT query_id, min(lv) FILTER (WHERE f IS NOT NULL) AS fl, min(lv) FILTER (WHERE late IS NOT NULL) AS late_at FROM fired GROUP BY 1),
d AS (SELECT a.query_id, CASE WHEN o IS NOT NULL THEN o.lv WHEN fl IS NOT NULL THEN fl ELSE late_at END AS lv,
  CASE WHEN o IS NOT NULL THEN struct_pack(r := 'compound_family_coherence_override', l := o.l, c := o.c) WHEN fl IS NOT NULL THEN x.f ELSE y.late END AS f,
  o IS NOT NULL AS overridden, fl FROM firsts a LEFT JOIN over USING (query_id) LEFT JOIN fired x ON x.query_id = a.query_id AND x.lv = fl LEFT JOIN fired y ON y.query_id = a.query_id AND y.lv = late_at),
mis AS (SELECT query_id, bool_or(wl IS NOT NULL AND lv <= fl AND rl <> kl) AS ks, bool_or(wl IS NOT NULL AND lv <= fl AND rl <> wl) AS ws,
  bool_or(kl IS NOT NULL AND kl IS DISTINCT FROM rl) AS ke, bool_or(wl IS NOT NULL AND wl IS DISTINCT FROM rl) AS we FROM (SELECT fired.*, d.fl FROM fired JOIN d USING (query_id)) GROUP BY ALL)"""


SQL_DECISION = f"""WITH {_rules('mechanism')}
SELECT query_id, f IS NOT NULL AS allow, coalesce(f.r, 'prelabel_label_support_too_weak') AS reason,
  ['pathway_seed', 'target_class', 'mechanism_label', 'target_family'][CASE WHEN f IS NOT NULL THEN lv + 1 END] AS level, f.l AS label, coalesce(round(f.c, 6), 0.0) AS confidence,
  CASE WHEN overridden THEN false WHEN fl IS NOT NULL THEN coalesce(ks, false) ELSE coalesce(ke, false) END AS raw_kept_mismatch,
  CASE WHEN overridden THEN false WHEN fl IS NOT NULL THEN coalesce(ws, false) ELSE coalesce(we, false) END AS raw_voted_mismatch
FROM d LEFT JOIN mis USING (query_id)"""


def label_expansion(spark, d):
    decision, kept, genes, labels, own = _decisions(spark, d, "mechanism")
    decision = materialize(decision)
    base = materialize(X.neighbour_genes(kept, genes, "score"))
    bundle = genes.filter("gene_id like 'Brand#1%'").select("gene_id")
    out = X.expand_by_label(base, decision, kept, genes, labels, own, bundle)
    share = attach_total(materialize(out), ["query_id"], "score", "total").withColumn("share", F.col("score") / F.col("total"))
    return share.select("query_id", "gene_id", r6("share", 8).alias("share"), "expanded", "scope")


SQL_EXPANSION = f"""WITH {_rules('mechanism')},
near AS (SELECT * FROM pairs WHERE flag = 'R'),
base AS (SELECT query_id, gene, sum(e * w) AS s FROM near JOIN g USING (ref_id) GROUP BY ALL),
ch AS (SELECT query_id, lv, f.l AS label, f.c AS conf FROM d WHERE f IS NOT NULL),
c0 AS (SELECT ch.query_id, lv, lab.gene, lab.gene LIKE 'Brand#1%' AS b, base.s IS NOT NULL AS nr, coalesce(base.s, 0) AS loc, own.gene IS NOT NULL AS own
  FROM ch JOIN lab USING (lv, label) LEFT JOIN base ON base.query_id = ch.query_id AND base.gene = lab.gene LEFT JOIN own ON own.query_id = ch.query_id AND own.gene = lab.gene),
c1 AS (SELECT *, CASE WHEN ab THEN 'bundle' WHEN an THEN 'local' ELSE 'global' END AS scope FROM (SELECT *, bool_or(b) OVER p AS ab, bool_or(nr) OVER p AS an FROM c0 WINDOW p AS (PARTITION BY query_id))
  WHERE lv < 3 OR own OR CASE WHEN ab THEN b WHEN an THEN nr ELSE true END),
bel AS (SELECT c1.query_id, c1.gene, lab.lv AS sub, lab.label AS txt, loc FROM c1 JOIN lab ON lab.gene = c1.gene AND lab.lv < c1.lv),
vt AS (SELECT query_id, sub, txt, sum(loc) AS m, count(*) AS n FROM bel GROUP BY ALL),
va AS (SELECT vt.*, named.label IS NOT NULL AND m > 0 AS asked FROM vt LEFT JOIN named ON named.query_id = vt.query_id AND named.lv = sub AND named.label = txt),
vb AS (SELECT *, bool_or(asked) OVER p AS byq, max(CASE WHEN asked THEN m END) OVER p AS am, sum(m) OVER p AS t,
  row_number() OVER (PARTITION BY query_id, sub ORDER BY m DESC, n DESC, txt DESC) AS rk FROM va WINDOW p AS (PARTITION BY query_id, sub)),
lk AS (SELECT query_id, sub, txt, byq, CASE WHEN byq THEN am ELSE m END AS s FROM vb WHERE asked OR (NOT byq AND rk = 1 AND t > 0 AND m / t >= 0.6 AND n >= 2)),
pg AS (SELECT query_id, gene, sum(s) AS bonus, max(s) AS most, bool_or(byq) AS fits FROM bel JOIN lk USING (query_id, sub, txt) GROUP BY ALL),
nar AS (SELECT DISTINCT query_id, true AS nar FROM lk WHERE byq),
rf AS (SELECT gene, count(DISTINCT ref_id) AS r FROM g GROUP BY 1),
c2 AS (SELECT query_id, gene, own, scope, coalesce(most, 0) AS most, (loc + 0.25 * coalesce(r, 0) + 0.25 * coalesce(bonus, 0)) * CASE WHEN nar AND NOT coalesce(fits, false) THEN 0.25 ELSE 1 END AS w0
  FROM c1 LEFT JOIN pg USING (query_id, gene) LEFT JOIN nar USING (query_id) LEFT JOIN rf USING (gene) WHERE nar IS NULL OR coalesce(fits, false) OR own),
c3 AS (SELECT query_id, gene, scope, CASE WHEN own THEN greatest(w0, 0.75 + 2.5 * most) ELSE w0 END AS w FROM c2),
al AS (SELECT query_id, sum(w) AS allw, min(scope) AS sc FROM c3 GROUP BY 1),
tt AS (SELECT query_id, sum(s) AS t FROM base GROUP BY 1),
j AS (SELECT query_id, gene, base.s, c3.w FROM base FULL JOIN c3 USING (query_id, gene)),
r AS (SELECT j.query_id, gene, s, w, conf, allw, sc, conf IS NOT NULL AND allw IS NOT NULL AS touched, coalesce(t, 0) AS t FROM j LEFT JOIN ch USING (query_id) LEFT JOIN al USING (query_id) LEFT JOIN tt USING (query_id)),
o AS (SELECT query_id, gene AS gene_id, touched, touched AND coalesce(w, 0) > 0 AS expanded, CASE WHEN touched THEN sc ELSE 'none' END AS scope,
  CASE WHEN NOT touched THEN s ELSE coalesce(s, 0) * CASE WHEN w IS NULL THEN greatest(0.2, 1 - 1.1 * conf) ELSE 1 END + CASE WHEN coalesce(w, 0) > 0 THEN greatest(1e-6, 0.35 * t * conf) * w / allw ELSE 0 END END AS score FROM r)
SELECT query_id, gene_id, round(score / sum(score) OVER (PARTITION BY query_id), 8) AS share, expanded, scope FROM o"""


QUERIES = {"expansion_decision": (expansion_decision, SQL_DECISION), "label_expansion": (label_expansion, SQL_EXPANSION)}
