"""Selection, normalisation and gene-set bindings on supplier x part scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from lociweave.catalog.tables import part_features, r6, table
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST


def _scores(spark, d):
    """Score per (program = return flag, gene = part): quantity above or below 25."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_returnflag").alias("program"), F.col("l_partkey").cast("string").alias("gene_id")).agg(
        F.sum(F.col("l_quantity") - 25.0).alias("score")
    )


S = """s AS (SELECT l_returnflag AS program, CAST(l_partkey AS VARCHAR) AS gene_id, sum(l_quantity - 25.0) AS score
  FROM lineitem GROUP BY ALL)"""


def rank_all(spark, d):
    out = SEL.rank_rows(_scores(spark, d), ["program"])
    return out.select("program", "gene_id", "score", "rank")


SQL_RANK = f"""WITH {S} SELECT program, gene_id, score,
  row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM s"""


def select_topk(spark, d):
    out = SEL.select_and_weight(_scores(spark, d), ["program"], "within_set_l1", how="top_k", k=50)
    return out.select("program", "gene_id", "score", "rank", r6("weight", 9).alias("weight"))


SQL_TOPK = f"""WITH {S}, r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY abs(score) DESC, gene_id) AS rank FROM s)
SELECT program, gene_id, score, rank, round(abs(score) / sum(abs(score)) OVER (PARTITION BY program), 9) AS weight
FROM r WHERE rank <= 50"""


def select_quantile(spark, d):
    out = SEL.select_and_weight(_scores(spark, d), ["program"], "l1", how="quantile", q=0.07)
    return out.select("program", "gene_id", "score", "rank", r6("weight", 9).alias("weight"))


SQL_QUANTILE = f"""WITH {S}, r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY abs(score) DESC, gene_id) AS rank,
  count(*) OVER (PARTITION BY program) AS n, sum(abs(score)) OVER (PARTITION BY program) AS total FROM s)
SELECT program, gene_id, score, rank, round(abs(score) / total, 9) AS weight FROM r WHERE rank <= greatest(1, ceil(n * 0.07))"""


def select_threshold(spark, d):
    out = SEL.select_rows(_scores(spark, d), ["program"], "threshold", min_score=20.0)
    return out.select("program", "gene_id", "score", "rank")


SQL_THRESHOLD = f"""WITH {S} SELECT program, gene_id, score,
  row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM s WHERE score >= 20"""


def l1_weights(spark, d):
    s = _scores(spark, d).withColumn("score", F.abs("score"))
    return SEL.global_l1(s, ["program"]).select("program", "gene_id", r6("weight", 10).alias("weight"))


SQL_L1 = f"""WITH {S} SELECT program, gene_id,
  round(abs(score) / sum(abs(score)) OVER (PARTITION BY program), 10) AS weight FROM s"""


def softmax_weights(spark, d):
    return SEL.softmax(_scores(spark, d), ["program"], 40.0).select("program", "gene_id", r6("weight", 10).alias("weight"))


SQL_SOFTMAX = f"""WITH {S}, m AS (SELECT *, max(score) OVER (PARTITION BY program) AS mx FROM s),
e AS (SELECT *, exp((score - mx) / 40.0) AS e FROM m)
SELECT program, gene_id, round(e / sum(e) OVER (PARTITION BY program), 10) AS weight FROM e"""


def softmax_effective_n(spark, d):
    t = SEL.temperature_for_effective_n(_scores(spark, d), ["program"], 40.0)
    return t.select("program", r6("temperature").alias("temperature"))


def gmt_topk(spark, d):
    rows = _scores(spark, d).withColumn("gene_symbol", F.concat(F.lit("G"), F.col("gene_id").cast("long") % 700))
    out = SEL.gene_sets_top_k(rows, ["program"], [50, 200], emit_small=True, require_symbol=True)
    return out.select("program", "variant", "k", "token", "rank")


SQL_GMT = f"""WITH {S}, v AS (SELECT program, gene_id, CASE WHEN score > 0 THEN '__pos' ELSE '__neg' END AS variant,
   abs(score) AS score, 'G' || (CAST(gene_id AS BIGINT) % 700) AS token FROM s WHERE score <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY program, variant ORDER BY score DESC, gene_id) AS rank FROM v),
c AS (SELECT r.*, k FROM r, (VALUES (100), (200)) t(k) WHERE rank <= k)
SELECT program, variant, k, token, min(rank) AS rank FROM c GROUP BY program, variant, k, token"""


def gmt_mass(spark, d):
    s = _scores(spark, d).filter("score > 0")
    out = SEL.mass_cut(s, ["program"], 0.35, low=100, high=500)
    return out.select("program", "gene_id", "score", "rank", "k")


SQL_MASS = f"""WITH {S}, p AS (SELECT * FROM s WHERE score > 0),
r AS (SELECT *, row_number() OVER w AS rank, sum(score) OVER (w ROWS UNBOUNDED PRECEDING) AS run,
   sum(score) OVER (PARTITION BY program) AS total FROM p WINDOW w AS (PARTITION BY program ORDER BY score DESC, gene_id)),
k AS (SELECT program, greatest(100, least(500, min(rank))) AS k FROM r WHERE run / total >= 0.35 - 1e-12 GROUP BY program)
SELECT r.program, gene_id, score, rank, k FROM r JOIN k USING (program) WHERE rank <= k"""


def gene_set_lists(spark, d):
    rows = _scores(spark, d)
    members = SEL.gene_sets_top_k(rows.withColumn("gene_symbol", F.lit(None).cast("string")), ["program"], [100])
    name = F.concat(F.lit("set program/"), "program", "variant", F.lit("__topk="), F.col("k"))
    out = SEL.gene_set_lists(members, ["program", "variant", "k"], name)
    return out.select("set_name", F.concat_ws(" ", "genes").alias("genes"), F.size("genes").alias("n"))


SQL_LISTS = f"""WITH {S}, v AS (SELECT program, gene_id, CASE WHEN score > 0 THEN '__pos' ELSE '__neg' END AS variant,
   abs(score) AS score FROM s WHERE score <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY program, variant ORDER BY score DESC, gene_id) AS rank FROM v)
SELECT 'set_program_' || program || variant || '__topk=100' AS set_name, string_agg(gene_id, ' ' ORDER BY rank) AS genes,
  CAST(count(*) AS INTEGER) AS n FROM r WHERE rank <= 100 GROUP BY program, variant"""


def token_dedupe(spark, d):
    rows = SEL.rank_rows(_scores(spark, d), ["program"])
    rows = rows.withColumn("token", F.concat(F.lit("T"), F.col("gene_id").cast("long") % 97))
    return SEL.dedupe_tokens(rows, ["program"])


SQL_DEDUPE = f"""WITH {S}, r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM s)
SELECT program, 'T' || (CAST(gene_id AS BIGINT) % 97) AS token, min(rank) AS rank FROM r GROUP BY ALL"""


def tie_diagnostics(spark, d):
    s = part_features(spark, d).groupBy(F.col("p_type").alias("program"), F.col("l_partkey").cast("string").alias("gene_id")).agg(
        F.count("*").cast("double").alias("score")
    )
    return SEL.tie_diagnostics(s, ["program"], 40)


SQL_TIES = """WITH s AS (SELECT p_type AS program, CAST(l_partkey AS VARCHAR) AS gene_id, CAST(count(*) AS DOUBLE) AS score
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY program ORDER BY score DESC, gene_id) AS rank FROM s),
c AS (SELECT program, min(score) AS cutoff, count(*) AS n_selected FROM r WHERE rank <= 40 GROUP BY program)
SELECT program, cutoff, n_selected, count(*) FILTER (abs(score - cutoff) <= 1e-12) AS n_tied,
  count(*) FILTER (abs(score - cutoff) <= 1e-12 AND rank <= n_selected) AS n_tied_selected,
  count(*) FILTER (abs(score - cutoff) <= 1e-12 AND rank > n_selected) AS n_tied_left_out
FROM r JOIN c USING (program) GROUP BY program, cutoff, n_selected"""


def cnv_rank_order(spark, d):
    s = _scores(spark, d).withColumn("score", F.floor(F.col("score") / 10)).withColumn(
        "gene_symbol", F.when(F.col("gene_id").cast("long") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("g"), "gene_id"))
    )
    out = SEL.rank_rows(s, ["program"], SEL.cnv_order())
    return out.select("program", "gene_id", "rank")


SQL_CNV_ORDER = f"""WITH {S}, t AS (SELECT program, gene_id, floor(score / 10) AS score,
   CASE WHEN CAST(gene_id AS BIGINT) % 3 = 0 THEN '{{' ELSE 'g' || gene_id END AS sym FROM s)
SELECT program, gene_id, row_number() OVER (PARTITION BY program ORDER BY score DESC, sym, gene_id) AS rank FROM t"""


def robust_z(spark, d):
    """Per part: median and MAD scaled quantity over suppliers."""
    x = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag", "l_linestatus").agg(F.sum("l_extendedprice").alias("value"))
    out = ST.robust_z(x, ["l_returnflag", "l_linestatus"])
    return out.select("l_suppkey", "l_returnflag", "l_linestatus", r6("z").alias("z"))


SQL_ROBUST = """WITH x AS (SELECT l_suppkey, l_returnflag, l_linestatus, sum(l_extendedprice) AS v FROM lineitem GROUP BY ALL),
m AS (SELECT l_returnflag, l_linestatus, median(v) AS med FROM x GROUP BY ALL),
a AS (SELECT x.l_returnflag, x.l_linestatus, any_value(med) AS med, median(abs(v - med)) AS mad
  FROM x JOIN m USING (l_returnflag, l_linestatus) GROUP BY ALL)
SELECT l_suppkey, l_returnflag, l_linestatus, round((v - med) / (mad + 1e-6), 6) AS z FROM x JOIN a USING (l_returnflag, l_linestatus)"""


def rank_normal(spark, d):
    x = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("value"))
    return ST.rank_normal(x, ["l_returnflag"], "value", "l_suppkey").select("l_suppkey", "l_returnflag", r6("z").alias("z"))


def _poly(x, powers):
    out = repr(float(powers[0])) + "::DOUBLE"
    for c in powers[1:]:
        out = f"({out} * {x} + {float(c)!r}::DOUBLE)"
    return out


def _ratio(x, parts):
    return f"({_poly(x, parts[0])} / {_poly(x, parts[1])})"


SQL_RANK_NORMAL = f"""WITH x AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS value FROM lineitem GROUP BY ALL),
p AS (SELECT l_suppkey, l_returnflag, (row_number() OVER w - 0.5::DOUBLE) / count(*) OVER (PARTITION BY l_returnflag) AS p FROM x WINDOW w AS (PARTITION BY l_returnflag ORDER BY value, l_suppkey)),
q AS (SELECT *, p - 0.5::DOUBLE AS q, 0.180625::DOUBLE - (p - 0.5::DOUBLE) * (p - 0.5::DOUBLE) AS c, sqrt(-ln(least(p, 1 - p))) - 1.6::DOUBLE AS r FROM p)
SELECT l_suppkey, l_returnflag, round(CASE WHEN abs(q) <= 0.425 THEN q * {_ratio('c', ST.QUANTILE_CENTRE)} ELSE sign(q) * CASE WHEN r <= 3.4 THEN {_ratio('r', ST.QUANTILE_TAIL)}
  ELSE {_ratio('(r - 3.4::DOUBLE)', ST.QUANTILE_FAR)} END END, 6) + 0.0 AS z FROM q"""


def bh_adjust(spark, d):
    """Rational p surrogate 1/(1+x^2) of a supplier x brand contrast, adjusted per supplier."""
    x = part_features(spark, d).groupBy("l_suppkey", "p_brand").agg((F.avg("l_quantity") - 25.5).alias("t"))
    x = x.withColumn("pvalue", F.when(F.abs("t") > 0.05, 1.0 / (1.0 + F.col("t") * F.col("t"))))
    out = ST.bh_adjust(x, ["l_suppkey"])
    return out.select("l_suppkey", "p_brand", r6("padj", 9).alias("padj"))


SQL_BH = """WITH x AS (SELECT l_suppkey, p_brand, avg(l_quantity) - 25.5 AS t FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL),
p AS (SELECT l_suppkey, p_brand, CASE WHEN abs(t) > 0.05 THEN 1.0 / (1.0 + t * t) END AS p FROM x),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY p, p_brand) AS rk, count(*) OVER (PARTITION BY l_suppkey) AS n
  FROM p WHERE p IS NOT NULL),
a AS (SELECT l_suppkey, p_brand, least(1.0, min(p * n / rk) OVER (PARTITION BY l_suppkey ORDER BY rk
   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS padj FROM r)
SELECT p.l_suppkey, p.p_brand, round(padj, 9) AS padj FROM p LEFT JOIN a USING (l_suppkey, p_brand)"""


QUERIES = {
    "rank_all": (rank_all, SQL_RANK),
    "select_topk": (select_topk, SQL_TOPK),
    "select_quantile": (select_quantile, SQL_QUANTILE),
    "select_threshold": (select_threshold, SQL_THRESHOLD),
    "l1_weights": (l1_weights, SQL_L1),
    "softmax_weights": (softmax_weights, SQL_SOFTMAX),
    "softmax_effective_n": (softmax_effective_n, None),
    "gmt_topk": (gmt_topk, SQL_GMT),
    "gmt_mass": (gmt_mass, SQL_MASS),
    "gene_set_lists": (gene_set_lists, SQL_LISTS),
    "token_dedupe": (token_dedupe, SQL_DEDUPE),
    "tie_diagnostics": (tie_diagnostics, SQL_TIES),
    "cnv_rank_order": (cnv_rank_order, SQL_CNV_ORDER),
    "robust_z": (robust_z, SQL_ROBUST),
    "rank_normal": (rank_normal, SQL_RANK_NORMAL),
    "bh_adjust": (bh_adjust, SQL_BH),
}
