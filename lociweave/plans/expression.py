"""Expression assays: DE signatures, program loadings, markers, DE preparation, matrix preparation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators import contrasts as C
from lociweave.operators import identifiers as ID
from lociweave.operators import sampling as SA
from lociweave.operators import scoring as SC
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST
from lociweave.session import materialize
from lociweave.operators.scoring import with_presence


def filter_rows(de: DataFrame, padj_max: float | None = None, pvalue_max: float | None = None, min_abs_logfc: float | None = None) -> DataFrame:
    """Row thresholds; a missing value fails its threshold."""
    for c, limit in (("padj", padj_max), ("pvalue", pvalue_max)):
        if limit is not None:
            de = de.filter(F.col(c) <= limit)
    return de if min_abs_logfc is None else de.filter(F.abs("logfc") >= min_abs_logfc)


def de_score(de: DataFrame, mode: str, p: str | None, eps: float = 1e-300, cap: float = 50.0) -> DataFrame:
    """Score per row in one mode for all comparisons."""
    if mode in ("stat", "logfc"):
        value = F.col(mode)
    elif mode == "custom_column":
        value = F.col("score")
    elif mode == "logfc_times_neglog10p":
        value = S.effect_times_p("logfc", p, eps, cap)
    else:
        source = F.coalesce(*[F.col(c) for c in ("stat", "logfc") if c in de.columns])
        value = S.signed_by(S.neglog10_clamped(p, eps, cap), source)
    return de.withColumn("score", value).filter("score is not null and gene_id is not null")


def comparison_score(de: DataFrame, keys: Sequence[str] = (), mode: str = "auto", eps: float = 1e-300, cap: float = 50.0) -> DataFrame:
    """Score per row; ``auto`` decides for each comparison: stat, else logFC with padj, else with pvalue.

    A comparison without usable values has no rows left.
    """
    if mode not in ("auto", "logfc_times_neglog10p"):
        return de_score(de, mode, "padj" if mode.endswith("padj") else "pvalue", eps, cap)
    rows = with_presence(de, keys, ["stat", "logfc", "padj", "pvalue"])
    has = lambda *c: reduce(lambda x, y: x & y, [F.col(f"_has_{x}") for x in c])
    value = F.when(has("logfc", "padj"), S.effect_times_p("logfc", "padj", eps, cap)).when(has("logfc", "pvalue"), S.effect_times_p("logfc", "pvalue", eps, cap))
    if mode == "auto":
        value = F.when(has("stat"), F.col("stat")).otherwise(value)
    rows = rows.withColumn("score", value).select(*de.columns, *([] if "score" in de.columns else ["score"]))
    return rows.filter("score is not null and gene_id is not null")


def rna_deg(
    de: DataFrame, keys: Sequence[str] = (), mode: str = "auto", duplicates: str = "sum", genes: DataFrame | None = None,
    exclude: Sequence[str] = S.DEFAULT_EXCLUDE_PATTERNS, select: dict | None = None, eps: float = 1e-300, cap: float = 50.0, **row_filters,
) -> DataFrame:
    """DE table to selected genes, for one comparison or for many keyed by ``keys`` in the same job."""
    scored = gene_scores(de, keys, mode, duplicates, genes, exclude, eps, cap, **row_filters)
    return SEL.select_and_weight(scored, keys, **(select or {}))


def gene_scores(de, keys=(), mode="auto", duplicates="sum", genes=None, exclude=S.DEFAULT_EXCLUDE_PATTERNS, eps=1e-300, cap=50.0, **row_filters) -> DataFrame:
    rows = filter_rows(de, **row_filters)
    carry = [c for c in ("gene_symbol", "gene_biotype") if c in rows.columns]
    merged = SC.merge_duplicates(comparison_score(rows, keys, mode, eps, cap), keys, duplicates, carry=carry)
    if "gene_symbol" not in merged.columns:
        merged = merged.withColumn("gene_symbol", F.lit(None).cast("string"))
    if genes is not None:
        merged = ID.annotate_genes(merged, genes)
    merged = ID.promote_ids_to_symbols(merged, keys)
    return merged.filter(~S.matches_any(["gene_symbol", "gene_id"], exclude)) if exclude else merged


def harmonizome_signatures(de: DataFrame, keys: Sequence[str] = ("comparison_id",), **kw) -> DataFrame:
    """Fixed preset: signed padj score, padj <= .05, |score| >= 1.30103, top 250."""
    s = gene_scores(de, keys, "signed_neglog10padj", padj_max=0.05, **kw).filter(F.abs("score") >= 1.30103)
    return SEL.select_and_weight(s, keys, how="top_k", k=250)


def rna_sc_programs(loadings: DataFrame, transform: str = "positive", genes: DataFrame | None = None, exclude=S.DEFAULT_EXCLUDE_PATTERNS, select: dict | None = None) -> DataFrame:
    """(program, gene_id, score) loadings to selected genes per program."""
    x = loadings.withColumn("score", S.transform_score("score", transform)).filter("score <> 0")
    if "gene_symbol" not in x.columns:
        x = x.withColumn("gene_symbol", F.lit(None).cast("string"))
    if genes is not None:
        x = ID.annotate_genes(x, genes)
    x = ID.promote_ids_to_symbols(x)
    x = x.filter(~S.matches_any(["gene_symbol", "gene_id"], exclude)) if exclude else x
    return SEL.select_and_weight(x, ["program"], **(select or {}))


def sc_rna_marker(counts: DataFrame, groups: DataFrame | None = None, mode: str = "mean") -> DataFrame:
    """Gene summary per group over the barcodes seen in the counts, L1 normalised and ranked."""
    seen = counts.select("cell_id").distinct()
    cells = seen.withColumn("group", F.lit("all")) if groups is None else seen.join(groups.select("cell_id", "group"), "cell_id", "left")
    c = counts.join(cells.filter("group is not null"), "cell_id")
    agg = c.groupBy("group", "gene_id").agg(F.sum("value").alias("_s"), F.count_if(F.col("value") > 0).cast("double").alias("_z"))
    n = C.cell_counts(cells.filter("group is not null"), ["group"])
    score = {"sum": F.col("_s"), "mean": F.col("_s") / F.greatest("n_cells", F.lit(1)), "frac_nonzero": F.col("_z") / F.greatest("n_cells", F.lit(1))}[mode]
    s = agg.join(n, "group").select("group", "gene_id", score.alias("score"))
    return SEL.rank_rows(SEL.global_l1(s, ["group"]), ["group"])


def rna_de_prepare(
    counts: DataFrame, samples: DataFrame, contrasts: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
    low_expression_filter: bool = True, balance: bool = False, min_samples: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Long counts to a long DE table over all contrasts, plus the comparison audit.

    ``contrasts`` is the level membership of ``contrasts.level_contrasts``.
    """
    levels = [c for c in contrasts.columns if c not in ("contrast_id", "arm")]
    members = samples.join(contrasts, levels).select(F.col("contrast_id").alias("comparison_id"), "arm", "sample_id")
    if balance:
        members = SA.balance_arms(members)
    sizes = members.groupBy("comparison_id").agg(F.count_if(F.col("arm") == "a").alias("_a"), F.count_if(F.col("arm") == "b").alias("_b"))
    members = materialize(members.join(sizes.filter(F.least("_a", "_b") >= min_samples), "comparison_id", "left_semi"))
    kept = counts.join(members.select("sample_id").distinct(), "sample_id", "left_semi")
    per = kept.join(members.select("comparison_id", "sample_id"), "sample_id")
    if low_expression_filter:
        per = per.join(ST.expressed_genes(kept, members), ["comparison_id", "gene_id"], "left_semi")
    logs = ST.cpm(per.select("comparison_id", "sample_id", "gene_id", "value"), ["comparison_id"])
    design = ST.design_table(members, samples, numeric, categorical)
    logs = materialize(logs.select("comparison_id", "sample_id", "gene_id", "log_cpm"))
    fit = ST.ols_group_effect(logs, design)
    p = fit.withColumn("pvalue", ST.normal_p("stat"))
    de = ST.bh_adjust(p, ["comparison_id"]).withColumnRenamed("effect", "logfc")
    return de, C.comparison_audit(samples, contrasts)


def scrna_prepare(entries: DataFrame, cells: DataFrame, bucket: Sequence[str], cap: int, min_cell_total: float, min_gene_total: float, seed: int = 0, min_bucket: int = 0) -> DataFrame:
    """Cell caps per bucket, then the joint cell and gene total filter."""
    kept = SA.cap_per_bucket(cells, bucket, ["cell_id"], cap, seed, min_bucket)
    return SA.fixpoint_filter(entries.join(kept.select("cell_id"), "cell_id", "left_semi"), min_cell_total, min_gene_total)


select_factor_count = SA.select_k
