"""Filters, identifier maps and screen variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.screening import E_, Z, _edges, _groups, _z
from lociweave.catalog.tables import part_features, r6, table
from lociweave.functions import scalars as S
from lociweave.operators import contrasts as C
from lociweave.operators import identifiers as ID
from lociweave.operators import metadata as META
from lociweave.operators import quality as Q
from lociweave.operators import screens as SC
from lociweave.operators import segments as SEG


def gene_exclusion(spark, d):
    """Case-insensitive name patterns on symbol or id."""
    p = table(spark, d, "part").select(F.col("p_name").alias("gene_symbol"), F.col("p_brand").alias("gene_id"), "p_partkey")
    out = p.filter(~S.matches_any(["gene_symbol", "gene_id"], ["^RED", "#1[0-3]$", "bolt$"]))
    return out.groupBy("gene_id").agg(F.count("*").alias("n"))


SQL_EXCL = """SELECT p_brand AS gene_id, count(*) AS n FROM part WHERE NOT (regexp_matches(p_name, '(?i)^RED') OR regexp_matches(p_brand, '(?i)^RED')
  OR regexp_matches(p_name, '#1[0-3]$') OR regexp_matches(p_brand, '#1[0-3]$') OR regexp_matches(p_name, '(?i)bolt$') OR regexp_matches(p_brand, '(?i)bolt$')) GROUP BY 1"""


def biotype_filter(spark, d):
    p = table(spark, d, "part").withColumn("gene_biotype", F.when(F.col("p_size") > 40, F.lit(None)).otherwise(F.col("p_type")))
    return p.filter(S.biotype_allowed("gene_biotype", ["Economy", "PROMO"])).groupBy("p_type").agg(F.count("*").alias("n"))


SQL_BIO = "SELECT p_type, count(*) AS n FROM part WHERE p_size > 40 OR p_type IN ('ECONOMY', 'PROMO') GROUP BY 1"


def soft_numbers(spark, d):
    """Parsed prices with missing tokens mixed in by brand."""
    p = table(spark, d, "part")
    text = F.when(F.col("p_size") < 5, "NA").when(F.col("p_size") < 9, " inf ").when(F.col("p_size") < 12, "x1").otherwise(F.concat(F.lit(" "), F.col("p_retailprice").cast("string")))
    return p.withColumn("v", S.soft_double(text)).groupBy("p_brand").agg(F.count("v").alias("n"), r6(F.sum("v"), 2).alias("total"))


SQL_SOFT = "SELECT p_brand, count(*) FILTER (p_size >= 12) AS n, round(sum(p_retailprice) FILTER (p_size >= 12), 2) AS total FROM part GROUP BY 1"


def score_formulas(spark, d):
    """Clamped and unclamped p-value scores summed per brand."""
    p = part_features(spark, d).withColumn("p", F.col("l_tax") * 13.0).withColumn("e", F.col("l_quantity") - 25.0)
    return p.groupBy("p_brand").agg(
        r6(F.sum(S.effect_times_p("e", "p")), 4).alias("clamped"), r6(F.sum(S.effect_times_p("e", "p", clamped=False)), 4).alias("floored"),
        r6(F.sum(S.signed_by(S.neglog10_clamped("p"), "e")), 4).alias("signed"), r6(F.sum(S.signed_log1p("e")), 4).alias("log1p"),
    )


SQL_FORM = """WITH b AS (SELECT p_brand, l_tax * 13.0 AS p, l_quantity - 25.0 AS e FROM lineitem JOIN part ON l_partkey = p_partkey),
c AS (SELECT *, least(-log10(least(1, greatest(1e-300, p)) + 1e-300), 50) AS k, least(-log10(greatest(1e-300, p)), 50) AS f FROM b)
SELECT p_brand, round(sum(e * k), 4) AS clamped, round(sum(e * f), 4) AS floored, round(sum(CASE WHEN e > 0 THEN k WHEN e < 0 THEN -k END), 4) AS signed,
  round(sum(sign(e) * ln(1 + abs(e))), 4) AS log1p FROM c GROUP BY 1"""


def chrom_harmonisation(spark, d):
    """Half of the chromosome names carry the prefix; only groups of the gene table survive."""
    li = table(spark, d, "lineitem").select(F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("chr"), "l_suppkey")).otherwise(F.col("l_suppkey").cast("string")).alias("chrom"), "l_quantity")
    genes = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.concat(F.lit("chr"), "s_suppkey").alias("chrom"))
    return ID.harmonize_chrom(li, genes).groupBy("chrom").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


SQL_CHROM = "SELECT 'chr' || l_suppkey AS chrom, count(*) AS n, sum(l_quantity) AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0 GROUP BY 1"


def segment_filter(spark, d):
    from lociweave.catalog.screening import SETTINGS, _purity, _segments

    s = SEG.correct_segments(_segments(spark, d), SETTINGS, _purity(spark, d))
    return s.groupBy("sample_id").agg(F.count("*").alias("n"), r6(F.sum("amplitude")).alias("amplitude"))


def _segment_sql():
    from lociweave.catalog.screening import SEGS

    return f"WITH {SEGS} SELECT sample_id, count(*) AS n, round(sum(amp), 6) AS amplitude FROM segs GROUP BY 1"


def drug_id_merge(spark, d):
    """Drugs of one brand and even size class share an alias; repeated targets add up and renormalise."""
    e = _edges(spark, d)
    al = e.select("drug_id").distinct().filter(F.substring_index("drug_id", "/", -1).cast("int") % 2 == 0).select(
        F.col("drug_id").alias("alias"), F.concat(F.split_part("drug_id", F.lit("/"), F.lit(1)), F.lit("/even")).alias("canonical"), F.lit(0).alias("alias_ordinal"))
    return SC.merge_drug_ids(e, al).select("drug_id", "gene_id", r6("weight", 9).alias("weight"))


SQL_MERGE = f"""WITH {E_}, c AS (SELECT CASE WHEN CAST(split_part(drug_id, '/', 2) AS INTEGER) % 2 = 0 THEN split_part(drug_id, '/', 1) || '/even' ELSE drug_id END AS drug_id, gene_id, weight FROM edges),
m AS (SELECT drug_id, gene_id, sum(weight) AS w FROM c GROUP BY ALL)
SELECT drug_id, gene_id, round(w / sum(w) OVER (PARTITION BY drug_id), 9) AS weight FROM m"""


def compound_drop(spark, d):
    e = _edges(spark, d)
    n = F.split_part("drug_id", F.lit("/"), F.lit(2)).cast("int")
    ids = e.select("drug_id").distinct()
    qc = ids.select("drug_id", F.when(n == 3, "drop").otherwise("keep").alias("recommended"), (n == 4).alias("pan_toxic"), (n >= 7).alias("polypharm"))
    out = SC.drop_compounds(e, ids.filter(n == 0), qc)
    return out.select("drug_id", "gene_id", r6("weight", 9).alias("weight"))


SQL_DROP = f"""WITH {E_}, x AS (SELECT *, CAST(split_part(drug_id, '/', 2) AS INTEGER) AS n FROM edges)
SELECT drug_id, gene_id, round(weight * CASE WHEN n >= 7 THEN 0.5 ELSE 1 END, 9) AS weight FROM x WHERE n NOT IN (0, 3, 4)"""


def case_control_program(spark, d):
    case = _groups(spark, d).select("sample_id", F.col("group").isin("n0", "n1").alias("is_case"))
    return SC.group_programs(_z(spark, d), None, "case_control", case=case).select("program", "drug_id", r6("score").alias("score"))


SQL_CASE = f"""WITH {Z}, s AS (SELECT s_suppkey AS sample_id, s_nationkey % 5 < 2 AS c FROM supplier),
a AS (SELECT drug_id, avg(z) FILTER (c) AS x, avg(z) FILTER (NOT c) AS y FROM z JOIN s USING (sample_id) GROUP BY 1)
SELECT 'case_vs_control' AS program, drug_id, round(x - y, 6) AS score FROM a WHERE x IS NOT NULL AND y IS NOT NULL"""


def target_coverage(spark, d):
    e = _edges(spark, d).filter("weight > 0.15")
    prog = SC.group_programs(_z(spark, d), _groups(spark, d), "group_mean")
    return SC.coverage(prog, e).select("program", "n_drugs", "n_mapped", r6("coverage").alias("coverage"))


SQL_COVER = f"""WITH {Z}, {E_}, p AS (SELECT DISTINCT 'n' || (s_nationkey % 5) AS program, drug_id FROM z JOIN supplier ON sample_id = s_suppkey),
m AS (SELECT DISTINCT drug_id FROM edges WHERE weight > 0.15)
SELECT program, count(*) AS n_drugs, count(m.drug_id) AS n_mapped, round(count(m.drug_id) / CAST(count(*) AS DOUBLE), 6) AS coverage FROM p LEFT JOIN m USING (drug_id) GROUP BY 1"""


def feature_id_map(spark, d):
    """`Ensembl:X|` text and versions are stripped, the first mapping of an id wins, others stay."""
    p = part_features(spark, d).select(F.concat(F.lit("Ensembl:"), "p_brand", F.lit("."), "p_size", F.lit("|x")).alias("feature_id"), "l_quantity")
    m = table(spark, d, "part").filter("p_size > 45").select(F.concat("p_brand", F.lit(".1")).alias("source_id"), F.col("p_type").alias("target_id"), F.col("p_partkey").alias("map_ordinal"))
    return ID.map_feature_ids(p, m).groupBy("feature_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))


SQL_MAP = """WITH m AS (SELECT p_brand AS b, arg_min(p_type, p_partkey) AS t FROM part WHERE p_size > 45 GROUP BY 1)
SELECT coalesce(t, p_brand) AS feature_id, count(*) AS n, sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN m ON b = p_brand GROUP BY 1"""


def sample_alignment(spark, d):
    v = table(spark, d, "orders").select(F.col("o_custkey").alias("sample_id"))
    s = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("sample_id"))
    return META.align(v, s)[2]


SQL_ALIGN = """WITH v AS (SELECT DISTINCT o_custkey AS k FROM orders), s AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0)
SELECT count(*) FILTER (v.k IS NOT NULL AND s.k IS NOT NULL) AS n_shared, count(*) FILTER (s.k IS NULL) AS n_values_only, count(*) FILTER (v.k IS NULL) AS n_metadata_only FROM v FULL JOIN s ON v.k = s.k"""


def significance_counts(spark, d):
    p = part_features(spark, d).select(F.col("l_returnflag").alias("contrast_id"), (F.col("l_tax")).alias("padj"), (F.col("l_quantity") - 25).alias("effect"))
    return C.significance_counts(p)


SQL_SIG = """SELECT l_returnflag AS contrast_id, count(*) AS n_tested, count(*) FILTER (l_tax <= 0.05) AS n_significant, count(*) FILTER (l_tax <= 0.05 AND l_quantity > 25) AS n_up,
  count(*) FILTER (l_tax <= 0.05 AND l_quantity < 25) AS n_down FROM lineitem GROUP BY 1"""


def link_coverage(spark, d):
    li = table(spark, d, "lineitem")
    links = table(spark, d, "part").filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    return Q.link_coverage(li, links, ["l_partkey"], ["l_returnflag"]).select("l_returnflag", "n_features", "n_linked", r6("linked_fraction").alias("linked_fraction"))


SQL_LINKCOV = """SELECT l_returnflag, count(*) AS n_features, count(*) FILTER (p_type <> 'PROMO') AS n_linked, round(count(*) FILTER (p_type <> 'PROMO') / CAST(count(*) AS DOUBLE), 6) AS linked_fraction
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1"""


QUERIES = {
    "gene_exclusion": (gene_exclusion, SQL_EXCL),
    "biotype_filter": (biotype_filter, SQL_BIO),
    "soft_numbers": (soft_numbers, SQL_SOFT),
    "score_formulas": (score_formulas, SQL_FORM),
    "chrom_harmonisation": (chrom_harmonisation, SQL_CHROM),
    "segment_filter": (segment_filter, _segment_sql()),
    "drug_id_merge": (drug_id_merge, SQL_MERGE),
    "compound_drop": (compound_drop, SQL_DROP),
    "case_control_program": (case_control_program, SQL_CASE),
    "target_coverage": (target_coverage, SQL_COVER),
    "feature_id_map": (feature_id_map, SQL_MAP),
    "sample_alignment": (sample_alignment, SQL_ALIGN),
    "significance_counts": (significance_counts, SQL_SIG),
    "link_coverage": (link_coverage, SQL_LINKCOV),
}
