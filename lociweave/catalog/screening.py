"""Drug-screen, segment, identifier and sampling bindings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import day, n_suppliers, part_features, r6, sql_day, table
from lociweave.functions import idf
from lociweave.operators import identifiers as ID
from lociweave.operators import sampling as SA
from lociweave.operators import screens as SC
from lociweave.operators import segments as SEG


def _z(spark, d):
    """Sample = supplier, drug = part brand and size, response = mean quantity, centred per drug."""
    p = part_features(spark, d).select(
        F.col("l_suppkey").alias("sample_id"), F.concat_ws("/", "p_brand", F.col("p_size") % 10).alias("drug_id"), F.col("l_quantity").alias("response")
    )
    return SC.replicate_mean(p).select("sample_id", "drug_id", ((F.col("response") - 25.5) / 7.0).alias("z"))


Z = """z AS (SELECT l_suppkey AS sample_id, p_brand || '/' || (p_size % 10) AS drug_id, (avg(l_quantity) - 25.5) / 7.0 AS z
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""


def _edges(spark, d):
    """Drug -> gene edges from the words of the part names, weight by occurrence, L1 per drug."""
    p = table(spark, d, "part").select(F.concat_ws("/", "p_brand", F.col("p_size") % 10).alias("drug_id"), F.regexp_replace("p_name", " ", ";").alias("t"))
    return ID.packed_edges(p, "drug_id", "t")


E_ = """tok AS (SELECT p_brand || '/' || (p_size % 10) AS drug_id, string_split(p_name, ' ') AS t FROM part),
ex AS (SELECT drug_id, 1.0 / len(t) AS w, unnest(t) AS gene_id FROM tok),
em AS (SELECT drug_id, gene_id, sum(w) AS w FROM ex GROUP BY ALL),
edges AS (SELECT drug_id, gene_id, w / sum(w) OVER (PARTITION BY drug_id) AS weight FROM em)"""


def packed_token_edges(spark, d):
    return _edges(spark, d).select("drug_id", "gene_id", r6("weight", 9).alias("weight"))


SQL_EDGES = f"WITH {E_} SELECT drug_id, gene_id, round(weight, 9) AS weight FROM edges"


def replicate_mean(spark, d):
    return _z(spark, d).select("sample_id", "drug_id", r6("z").alias("z"))


SQL_REP = f"WITH {Z} SELECT sample_id, drug_id, round(z, 6) AS z FROM z"


def response_ubiquity(spark, d):
    out = SC.response_ubiquity(_z(spark, d), 0.5)
    return out.select("drug_id", r6("active_fraction").alias("active_fraction"), r6("weight").alias("weight"))


U = """u AS (SELECT drug_id, count(DISTINCT CASE WHEN z > 0.5 THEN sample_id END) / CAST((SELECT count(DISTINCT sample_id) FROM z) AS DOUBLE) AS fr
  FROM z GROUP BY 1)"""
SQL_UBIQ = f"WITH {Z}, {U} SELECT drug_id, round(fr, 6) AS active_fraction, round(1 / (0.05 + fr), 6) AS weight FROM u"


def polypharmacology(spark, d):
    return SC.polypharmacology(_edges(spark, d)).select("drug_id", "n_targets", r6("weight", 9).alias("weight"))


SQL_POLY = f"""WITH {E_}, n AS (SELECT drug_id, count(DISTINCT gene_id) AS n_targets FROM edges GROUP BY 1)
SELECT drug_id, n_targets, round(1 / (1 + ln(1 + n_targets / 5.0)), 9) AS weight FROM n"""


def target_ubiquity(spark, d):
    return SC.target_ubiquity(_edges(spark, d)).select("gene_id", "n_drugs_with_gene", r6("weight", 9).alias("weight"))


SQL_TUBIQ = f"""WITH {E_} SELECT gene_id, count(DISTINCT drug_id) AS n_drugs_with_gene,
  round(ln(((SELECT count(DISTINCT drug_id) FROM edges) + 1.0) / (count(DISTINCT drug_id) + 1.0)), 9) AS weight FROM edges GROUP BY 1"""


SQL_CAP = f"""WITH {E_}, n AS (SELECT *, count(*) OVER (PARTITION BY drug_id) AS n,
  row_number() OVER (PARTITION BY drug_id ORDER BY round(weight, 12) DESC, gene_id) AS rk FROM edges),
k AS (SELECT * FROM n WHERE n <= 8 OR rk <= 8)
SELECT drug_id, gene_id, round(CASE WHEN n <= 8 THEN weight ELSE weight / sum(weight) OVER (PARTITION BY drug_id) END, 9) AS weight FROM k"""


def _capped(spark, d):
    e = _edges(spark, d)
    return e.withColumn("weight", F.round("weight", 12))


def promiscuity_cap_query(spark, d):
    return SC.promiscuity_cap(_capped(spark, d), 8, "cap").select("drug_id", "gene_id", r6("weight", 9).alias("weight"))


def _groups(spark, d):
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("sample_id"), F.concat(F.lit("n"), F.col("s_nationkey") % 5).alias("group"))


G = "groups AS (SELECT s_suppkey AS sample_id, 'n' || (s_nationkey % 5) AS grp FROM supplier)"


def group_program(spark, d):
    out = SC.group_programs(_z(spark, d), _groups(spark, d), "group_vs_rest")
    return out.select("program", "drug_id", r6("score").alias("score"))


P = """t AS (SELECT drug_id, sum(z) AS ts, count(*) AS tn FROM z GROUP BY 1),
big AS (SELECT grp FROM groups GROUP BY 1 HAVING count(DISTINCT sample_id) >= 5),
g AS (SELECT grp, drug_id, sum(z) AS s, count(*) AS n FROM z JOIN groups USING (sample_id) WHERE grp IN (SELECT grp FROM big) GROUP BY ALL),
prog AS (SELECT grp || '_vs_rest' AS program, drug_id, s / n - (ts - s) / (tn - n) AS score FROM g JOIN t USING (drug_id) WHERE tn > n)"""
SQL_PROGRAM = f"WITH {Z}, {G}, {P} SELECT program, drug_id, round(score, 6) AS score FROM prog"


def target_weighted_sum(spark, d):
    z, e = _z(spark, d), _edges(spark, d)
    prog = SC.group_programs(z, _groups(spark, d), "group_vs_rest")
    out = SC.target_weighted_sum(prog, e, SC.response_ubiquity(z, 0.5), SC.target_ubiquity(e))
    return out.select("program", "gene_id", r6("score").alias("score"))


SQL_TWS = f"""WITH {Z}, {G}, {P}, {E_}, {U},
gw AS (SELECT gene_id, ln(((SELECT count(DISTINCT drug_id) FROM edges) + 1.0) / (count(DISTINCT drug_id) + 1.0)) AS w FROM edges GROUP BY 1)
SELECT program, e.gene_id, round(sum(greatest(score, 0) / (0.05 + fr) * gw.w * e.weight), 6) AS score
FROM prog JOIN edges e USING (drug_id) JOIN u USING (drug_id) JOIN gw ON gw.gene_id = e.gene_id WHERE score > 0 GROUP BY ALL"""


def sparse_deconvolution(spark, d):
    prog = SC.group_programs(_z(spark, d), _groups(spark, d), "group_vs_rest")
    e = SC.weighted_edges(_edges(spark, d), None, None)
    out = SC.sparse_deconvolution(prog, e, alpha=0.001)
    return out.select("program", "gene_id", r6("score", 4).alias("score"))


def strongest_programs(spark, d):
    prog = SC.group_programs(_z(spark, d), _groups(spark, d), "per_sample")
    return SC.strongest_programs(prog, 20).groupBy("program").agg(F.count("*").alias("n"))


SQL_STRONG = f"""WITH {Z}, m AS (SELECT sample_id AS program, avg(abs(z)) AS m, count(*) AS n FROM z GROUP BY 1)
SELECT program, n FROM m ORDER BY m DESC, program LIMIT 20"""


# --- segments ---------------------------------------------------------------------------------


def _segments(spark, d):
    o = table(spark, d, "orders")
    n = n_suppliers(spark, d)
    start = day("o_orderdate")
    return o.select(
        F.concat(F.lit("s"), F.col("o_custkey") % 40).alias("sample_id"), (F.col("o_orderkey") % n).alias("chrom"), start.alias("start"),
        (start + (F.col("o_orderkey") % 60) * (F.col("o_orderkey") % 7) + 5).alias("end"),
        ((F.col("o_totalprice") - 250000.0) / 100000.0).alias("amplitude"), F.col("o_orderkey").alias("seg_id"),
    )


def _genes(spark, d):
    n = n_suppliers(spark, d)
    p = table(spark, d, "part")
    start = (F.lit(8800) + F.col("p_partkey") * 37 % 2600).cast("long")
    return p.select((F.col("p_partkey") % n).alias("chrom"), start.alias("gene_start"), (start + F.col("p_size")).alias("gene_end"),
                    F.col("p_partkey").cast("string").alias("gene_id"))


def _purity(spark, d):
    n = table(spark, d, "nation")
    return n.select(F.concat(F.lit("s"), "n_nationkey").alias("sample_id"), (0.05 + (F.col("n_nationkey") % 10) / 10.0).alias("purity"))


SEGS = f"""seg0 AS (SELECT 's' || (o_custkey % 40) AS sample_id, o_orderkey % (SELECT count(*) FROM supplier) AS chrom, {sql_day('o_orderdate')} AS s,
   {sql_day('o_orderdate')} + (o_orderkey % 60) * (o_orderkey % 7) + 5 AS e, (o_totalprice - 250000.0) / 100000.0 AS amp0, o_orderkey FROM orders),
pur AS (SELECT 's' || n_nationkey AS sample_id, 0.05 + (n_nationkey % 10) / 10.0 AS purity FROM nation),
seg AS (SELECT g.*, greatest(-3, least(3, CASE WHEN purity IS NULL THEN amp0 ELSE amp0 / greatest(purity, 0.1) END)) AS amp
  FROM seg0 g LEFT JOIN pur USING (sample_id) WHERE e - s <= 300),
segs AS (SELECT * FROM seg WHERE abs(amp) >= 0.1),
genes AS (SELECT p_partkey % (SELECT count(*) FROM supplier) AS chrom, 8800 + p_partkey * 37 % 2600 AS gs, 8800 + p_partkey * 37 % 2600 + p_size AS ge,
   CAST(p_partkey AS VARCHAR) AS gene_id FROM part),
l0 AS (SELECT g.*, x.gene_id, (least(e, ge) - greatest(s, gs)) / CAST(ge - gs AS DOUBLE) AS fr, count(*) OVER (PARTITION BY g.orderkey2) AS n
  FROM (SELECT *, o_orderkey AS orderkey2 FROM segs) g JOIN genes x ON g.chrom = x.chrom AND g.s < x.ge AND x.gs < g.e),
links AS (SELECT *, 1 / (1 + (greatest(1, e - s) / 60.0)) AS focal, amp * (1 / (1 + (greatest(1, e - s) / 60.0))) / sqrt(n) AS sc FROM l0),
gscore AS (SELECT sample_id, gene_id, sum(sc * fr) / sum(fr) AS score FROM links GROUP BY ALL)"""

SETTINGS = SEG.SegmentSettings(max_length=300, length_scale=60.0)


def _links(spark, d):
    s = SEG.correct_segments(_segments(spark, d), SETTINGS, _purity(spark, d))
    return s, SEG.segment_links(s, _genes(spark, d), SETTINGS)


def cnv_segment_score(spark, d):
    out = SEG.programs(SEG.gene_scores(_links(spark, d)[1], SETTINGS))
    return out.select("sample_id", "gene_id", "program", r6("score").alias("score"))


SQL_CNV = f"""WITH {SEGS} SELECT sample_id, gene_id, CASE WHEN score > 0 THEN 'amp' ELSE 'del' END AS program, round(abs(score), 6) AS score FROM gscore WHERE score <> 0
UNION ALL SELECT sample_id, gene_id, 'abs', round(abs(score), 6) FROM gscore WHERE score <> 0"""


def cohort_recurrence(spark, d):
    g = SEG.gene_scores(_links(spark, d)[1], SETTINGS)
    n = g.agg(F.countDistinct("sample_id").alias("n_samples"))
    return SEG.recurrence(g, n, 0.05, 0.02).select("program", "gene_id", r6("score").alias("score"))


SQL_RECUR = f"""WITH {SEGS}, n AS (SELECT count(DISTINCT sample_id) AS n FROM gscore),
c AS (SELECT CASE WHEN score > 0.05 THEN 'recurrent_amp' ELSE 'recurrent_del' END AS program, gene_id, count(*) AS k FROM gscore WHERE abs(score) > 0.05 GROUP BY ALL)
SELECT program, gene_id, round(k / CAST(n AS DOUBLE), 6) AS score FROM c, n WHERE n >= 5 AND k / CAST(n AS DOUBLE) >= 0.02"""


def segment_summary(spark, d):
    s, links = _links(spark, d)
    out = SEG.segment_summary(s, links)
    return out.select("sample_id", "n_segments", "min_length", "max_length", r6("median_length").alias("median_length"),
                      r6("median_abs_amplitude").alias("median_abs_amplitude"), "main_chrom", "n_genes")


SQL_SEGSUM = f"""WITH {SEGS}, a AS (SELECT sample_id, count(*) AS n_segments, CAST(min(e - s) AS DOUBLE) AS min_length, CAST(max(e - s) AS DOUBLE) AS max_length,
  round(median(e - s), 6) AS median_length, round(median(abs(amp)), 6) AS median_abs_amplitude FROM segs GROUP BY 1),
c AS (SELECT sample_id, chrom AS main_chrom FROM (SELECT sample_id, chrom, count(*) AS k FROM segs GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY k DESC, chrom DESC) = 1),
g AS (SELECT sample_id, count(DISTINCT gene_id) AS n_genes FROM links GROUP BY 1)
SELECT a.*, main_chrom, n_genes FROM a JOIN c USING (sample_id) LEFT JOIN g USING (sample_id)"""


def selected_breadth(spark, d):
    from lociweave.operators.selection import top_k

    _, links = _links(spark, d)
    g = SEG.gene_scores(links, SETTINGS).withColumn("mag", F.abs("score"))
    sel = top_k(g, ["sample_id"], 10, [F.round("mag", 9).desc(), F.col("gene_id").asc()])
    out = SEG.selected_breadth(links, sel)
    return out.select("sample_id", r6("median_length").alias("median_length"), r6("mean_focal").alias("mean_focal"))


SQL_BREADTH = f"""WITH {SEGS}, sel AS (SELECT sample_id, gene_id FROM gscore QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY round(abs(score), 9) DESC, gene_id) <= 10)
SELECT sample_id, round(median(e - s), 6) AS median_length, round(avg(focal), 6) AS mean_focal FROM links JOIN sel USING (sample_id, gene_id) GROUP BY 1"""


# --- identifiers ------------------------------------------------------------------------------


def alias_priority_join(spark, d):
    """Alias by full name, else by last word, else by first word of the part name."""
    p = table(spark, d, "part")
    a = p.filter("p_size <= 3").groupBy(F.col("p_name").alias("input_key")).agg(F.min("p_brand").alias("canonical_key"))
    b = p.groupBy(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("input_key")).agg(F.max("p_type").alias("canonical_key")).filter("input_key < 'g'")
    c = p.groupBy(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("input_key")).agg(F.min("p_type").alias("canonical_key"))
    al = a.unionByName(b).unionByName(c)
    cand = [F.col("p_name"), F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1))]
    return ID.first_alias(p, al, cand, ["p_partkey"]).select("p_partkey", "alias_canonical_key")


SQL_ALIAS = """WITH a AS (SELECT p_name AS k, min(p_brand) AS v FROM part WHERE p_size <= 3 GROUP BY 1),
b AS (SELECT split_part(p_name, ' ', 2) AS k, max(p_type) AS v FROM part GROUP BY 1 HAVING split_part(p_name, ' ', 2) < 'g'),
c AS (SELECT split_part(p_name, ' ', 1) AS k, min(p_type) AS v FROM part GROUP BY 1)
SELECT p_partkey, coalesce(a.v, b.v, c.v) AS alias_canonical_key FROM part LEFT JOIN a ON p_name = a.k
LEFT JOIN b ON split_part(p_name, ' ', 2) = b.k LEFT JOIN c ON split_part(p_name, ' ', 1) = c.k"""


def ambiguous_split(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.regexp_replace("p_name", " ", "/").alias("ids"),
                                       F.when(F.col("p_partkey") % 2 == 0, F.upper(F.regexp_replace("p_name", " ", ","))).alias("symbols"))
    out = ID.assign_genes(p, "ids", "symbols", "split_equal")
    return out.groupBy("gene_id", "gene_symbol").agg(F.count("*").alias("n"), r6(F.sum("gene_fraction")).alias("total"))


SQL_SPLIT = """WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS t FROM part),
e AS (SELECT p_partkey, unnest(t) AS gene_id, 1.0 / len(t) AS fr FROM p)
SELECT gene_id, CASE WHEN p_partkey % 2 = 0 THEN upper(gene_id) ELSE gene_id END AS gene_symbol, count(*) AS n, round(sum(fr), 6) AS total FROM e GROUP BY ALL"""


def version_strip_resolve(spark, d):
    """Names with a version suffix resolved against a table where some stripped forms are ambiguous."""
    s = table(spark, d, "supplier")
    genes = s.select(F.concat("s_name", F.lit("."), (F.col("s_suppkey") % 4)).alias("gene_id")).unionByName(
        s.filter("s_acctbal > 7000").select(F.concat("s_name", F.lit(".9")).alias("gene_id"))
    )
    rows = table(spark, d, "lineitem").join(s, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat("s_name", F.lit("."), F.col("l_linenumber") % 4).alias("gene_id"), "l_quantity"
    )
    return ID.resolve_gene_ids(rows, genes).groupBy("gene_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


SQL_STRIP = """WITH g AS (SELECT s_name || '.' || (s_suppkey % 4) AS id FROM supplier UNION SELECT s_name || '.9' FROM supplier WHERE s_acctbal > 7000),
s AS (SELECT split_part(id, '.', 1) AS k, min(id) AS one FROM g GROUP BY 1 HAVING count(*) = 1),
r AS (SELECT s_name || '.' || (l_linenumber % 4) AS id, l_quantity FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
j AS (SELECT coalesce(g.id, s.one) AS gene_id, l_quantity FROM r LEFT JOIN g ON r.id = g.id LEFT JOIN s ON split_part(r.id, '.', 1) = s.k)
SELECT gene_id, count(*) AS n, sum(l_quantity) AS quantity FROM j WHERE gene_id IS NOT NULL GROUP BY 1"""


def _ortho(policy):
    def run(spark, d):
        p = table(spark, d, "part").withColumn("src", F.concat_ws("-", "p_name", "p_brand", "p_size"))
        scores = p.groupBy(F.col("src").alias("gene_symbol")).agg(F.sum("p_retailprice").alias("score"))
        scores = scores.withColumn("gene_id", F.concat(F.lit("id_"), "gene_symbol"))
        o = p.select(F.col("src").alias("source_symbol"), F.lit(None).cast("string").alias("source_id"), F.col("p_type").alias("target_symbol"))
        return ID.ortholog_scores(scores, o, [], policy).select("gene_id", r6("score", 4).alias("score"))

    return run


SQL_ORTHO = """WITH s AS (SELECT p_name || '-' || p_brand || '-' || p_size AS k, sum(p_retailprice) AS score FROM part GROUP BY 1),
o AS (SELECT DISTINCT p_name || '-' || p_brand || '-' || p_size AS k, p_type AS t FROM part),
n AS (SELECT *, count(*) OVER (PARTITION BY k) AS n FROM o)
SELECT t AS gene_id, round(sum(score / CAST(n AS DOUBLE)), 4) AS score FROM s JOIN n USING (k) GROUP BY 1"""


# --- inverse frequencies ----------------------------------------------------------------------


def _freq(spark, d):
    p = part_features(spark, d)
    f = p.groupBy("p_partkey").agg(F.countDistinct("l_suppkey").alias("df"))
    n = table(spark, d, "supplier").agg(F.count("*").alias("n")).scalar()
    return f.withColumn("n", n)


def _idf(fn):
    return lambda spark, d: _freq(spark, d).select("p_partkey", "df", r6(fn("df", "n"), 9).alias("idf"))


def _idf_sql(expr):
    return f"""WITH f AS (SELECT p_partkey, count(DISTINCT l_suppkey) AS df, (SELECT count(*) FROM supplier) AS n
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
SELECT p_partkey, df, round({expr}, 9) AS idf FROM f"""


# --- sampling ---------------------------------------------------------------------------------


def hash_rank_sample(spark, d):
    o = table(spark, d, "orders")
    return SA.cap_per_bucket(o, ["o_orderpriority", "o_orderstatus"], ["o_orderkey"], 100, seed=7).groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))


SQL_SAMPLE = """SELECT o_orderpriority, o_orderstatus, least(100, count(*)) AS n FROM orders GROUP BY ALL"""


def balance_arms(spark, d):
    c = table(spark, d, "customer")
    m = c.select(F.col("c_nationkey").alias("comparison_id"), F.when(F.col("c_mktsegment") == "BUILDING", "a").otherwise("b").alias("arm"),
                 F.col("c_custkey").alias("sample_id"))
    return SA.balance_arms(m).groupBy("comparison_id", "arm").agg(F.count("*").alias("n"))


SQL_BALANCE = """WITH m AS (SELECT c_nationkey AS comparison_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'a' ELSE 'b' END AS arm, count(*) AS n FROM customer GROUP BY ALL)
SELECT comparison_id, arm, min(n) OVER (PARTITION BY comparison_id) AS n FROM m"""


def fixpoint_filter(spark, d):
    e = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("cell_id"), F.col("l_partkey").alias("gene_id"), F.col("l_quantity").alias("value"))
    out = SA.fixpoint_filter(e, 30.0, 650.0)
    return out.groupBy("gene_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def _fix_sql(rounds):
    ctes, prev = ["e0 AS (SELECT l_orderkey AS c, l_partkey AS g, l_quantity AS v FROM lineitem WHERE l_quantity <> 0)"], "e0"
    for i in range(1, rounds + 1):
        ctes.append(f"a{i} AS (SELECT * FROM {prev} WHERE c IN (SELECT c FROM {prev} GROUP BY c HAVING sum(v) >= 30))")
        ctes.append(f"e{i} AS (SELECT * FROM a{i} WHERE g IN (SELECT g FROM a{i} GROUP BY g HAVING sum(v) >= 650))")
        prev = f"e{i}"
    return f"WITH {', '.join(ctes)} SELECT g AS gene_id, count(*) AS n, sum(v) AS total FROM {prev} GROUP BY g"


def select_k_stability(spark, d):
    """Curve per customer nation: k = order month, stability from order values."""
    o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    curve = o.groupBy(F.col("c_nationkey").alias("run_id"), F.month(F.col("o_orderdate").cast("date")).alias("k")).agg(
        (F.avg("o_totalprice") / 300000).alias("stability")
    )
    return SA.select_k(curve, fraction=0.97)


SQL_SELECTK = """WITH c AS (SELECT c_nationkey AS run_id, month(o_orderdate) AS k, avg(o_totalprice) / 300000 AS s FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
w AS (SELECT *, coalesce(lag(s) OVER (PARTITION BY run_id ORDER BY k), s) AS l, coalesce(lead(s) OVER (PARTITION BY run_id ORDER BY k), s) AS r,
  max(s) OVER (PARTITION BY run_id) AS m FROM c)
SELECT run_id, CAST(coalesce(max(CASE WHEN s >= l AND s >= r AND s >= 0.97 * m THEN k END), max(CASE WHEN s = m THEN k END)) AS INTEGER) AS k FROM w GROUP BY 1"""


QUERIES = {
    "packed_token_edges": (packed_token_edges, SQL_EDGES),
    "replicate_mean": (replicate_mean, SQL_REP),
    "response_ubiquity": (response_ubiquity, SQL_UBIQ),
    "polypharmacology": (polypharmacology, SQL_POLY),
    "target_ubiquity": (target_ubiquity, SQL_TUBIQ),
    "promiscuity_cap": (promiscuity_cap_query, SQL_CAP),
    "group_program": (group_program, SQL_PROGRAM),
    "target_weighted_sum": (target_weighted_sum, SQL_TWS),
    "sparse_deconvolution": (sparse_deconvolution, None),
    "strongest_programs": (strongest_programs, SQL_STRONG),
    "cnv_segment_score": (cnv_segment_score, SQL_CNV),
    "cohort_recurrence": (cohort_recurrence, SQL_RECUR),
    "segment_summary": (segment_summary, SQL_SEGSUM),
    "selected_breadth": (selected_breadth, SQL_BREADTH),
    "alias_priority_join": (alias_priority_join, SQL_ALIAS),
    "ambiguous_split": (ambiguous_split, SQL_SPLIT),
    "version_strip_resolve": (version_strip_resolve, SQL_STRIP),
    "ortholog_expand": (_ortho("expand_all"), SQL_ORTHO),
    "ortholog_unique": (_ortho("unique_only"), SQL_ORTHO.replace("USING (k) GROUP", "USING (k) WHERE n = 1 GROUP")),
    "idf_peak": (_idf(idf.peak_idf), _idf_sql("ln((n + 1.0) / (df + 1.0)) + 1")),
    "idf_target": (_idf(lambda a, b: idf.target_idf(a, b)), _idf_sql("ln((n + 1.0) / (df + 1.0))")),
    "idf_site": (_idf(idf.site_idf), _idf_sql("ln((n + 1.0) / (df + 1.0))")),
    "idf_event": (_idf(idf.event_idf), _idf_sql("ln(1 + (n + 1.0) / (df + 1.0))")),
    "idf_gene_recurrence": (_idf(idf.gene_recurrence_idf), _idf_sql("ln((n + 1.0) / (df + 1.0)) / ln(n + 1.0)")),
    "hash_rank_sample": (hash_rank_sample, SQL_SAMPLE),
    "balance_arms": (balance_arms, SQL_BALANCE),
    "fixpoint_filter": (fixpoint_filter, _fix_sql(6)),
    "select_k_stability": (select_k_stability, SQL_SELECTK),
}
