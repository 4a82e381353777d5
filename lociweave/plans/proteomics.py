"""Protein and modification-site tables to gene programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators import contrasts as C
from lociweave.operators import identifiers as ID
from lociweave.operators import priors as P
from lociweave.operators import scoring as SC
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST
from lociweave.session import materialize
from lociweave.operators.scoring import with_presence


def proteomics_diff(rows: DataFrame, keys: Sequence[str] = (), transform: str = "abs", normalize: str = "l1") -> DataFrame:
    """Gene rows add up, then transform, normalise and rank."""
    s = rows.groupBy(*keys, "gene_id").agg(F.sum("logfc").alias("score"))
    s = s.withColumn("score", S.transform_score("score", transform))
    return SEL.select_and_weight(s, keys, normalize, how="none")


def _with(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for c in columns:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def site_score(sites: DataFrame, keys: Sequence[str], mode: str, p: str | None) -> DataFrame:
    """``base_score`` per row; ``auto`` decides for each comparison: stat, else logFC with p, else the score column."""
    own = F.col("score") if "score" in sites.columns else F.lit(None).cast("double")
    value = {"stat": lambda: F.col("stat"), "custom_column": lambda: own, "logfc_times_neglog10p": lambda: S.effect_times_p("logfc", p, clamped=False)}
    if mode != "auto":
        return sites.withColumn("base_score", value[mode]())
    rows = with_presence(sites, keys, ["stat", "logfc"])
    base = F.when(F.col("_has_stat"), value["stat"]())
    if p:
        base = base.when(F.col("_has_logfc"), value["logfc_times_neglog10p"]())
    return rows.withColumn("base_score", base.otherwise(own)).drop("_has_stat", "_has_logfc")


def ptm_site_diff(
    sites: DataFrame, keys: Sequence[str] = (), mode: str = "auto", ptm_type: str = "generic", aliases: DataFrame | None = None, ubiquity: DataFrame | None = None,
    ambiguous: str = "drop", confidence: str = "combined", adjustment: str = "subtract", lam: float = 1.0, transform: str = "signed",
    duplicates: str = "highest_confidence", aggregation: str = "signed_topk_mean", k: int = 3, min_localization: float = 0.75, select: dict | None = None,
) -> DataFrame:
    """Site differences to selected genes: score, canonical key, gene, protein adjustment, weights, collapse, aggregate."""
    # The p column is picked by header: padj when the table has one, even where it is blank.
    p = "padj" if "padj" in sites.columns else "pvalue" if "pvalue" in sites.columns else None
    s = _with(sites, ["site_id", "site_group", "gene_id", "gene_symbol", "protein_accession", "residue", "position"])
    s = site_score(s, keys, mode, p).filter("base_score is not null").withColumn("_id", F.xxhash64("row_ordinal"))
    pos = F.col("position").cast("string")
    own = S.site_key("protein_accession", "residue", pos, F.lit(ptm_type), "site_id", "site_group")
    if aliases is not None:
        full = lambda c: F.when(S.clean(c).isNotNull() & S.clean("residue").isNotNull(), F.concat_ws("|", c, "residue", pos, F.lit(ptm_type)))
        cand = [F.col("site_id"), F.col("site_group"), full("protein_accession"), full("gene_symbol")]
        s = ID.first_alias(s, aliases, cand, ["_id"], alias_columns=["canonical_site_key", "gene_id", "gene_symbol"])
        s = s.withColumn("record_key", F.coalesce("alias_canonical_site_key", own))
        s = s.withColumn("gene_id", F.coalesce(S.clean("alias_gene_id"), "gene_id")).withColumn("gene_symbol", F.coalesce(S.clean("alias_gene_symbol"), "gene_symbol"))
    else:
        s = s.withColumn("record_key", own)
    s = ID.assign_genes(s.filter("record_key is not null"), policy=ambiguous)
    prot = F.coalesce(*[F.col(c) for c in ("protein_logfc", "protein_stat") if c in s.columns], F.lit(None).cast("double"))
    s = ST.residualize(s.withColumn("_prot", prot), keys, "base_score", "_prot", adjustment, lam, "adjusted_score")
    have = lambda c: c if c in s.columns else None
    s = P.site_confidence(s, confidence, p, have("localization_prob"), have("peptide_count"), min_localization, keys=keys)
    if ubiquity is not None:
        u = ubiquity.select(F.col("canonical_site_key").alias("record_key"), "idf_ref")
        s = P.prior_weight(s, u, "record_key", "idf_ref", "ubiquity_weight")
    else:
        s = s.withColumn("ubiquity_weight", F.lit(1.0))
    final = S.transform_score("adjusted_score", transform) * F.col("confidence_weight") * F.col("ubiquity_weight") * F.col("gene_fraction")
    s = s.withColumn("final_score", final).withColumn("quality", F.col("confidence_weight") * F.greatest(F.lit(1e-6), F.abs("adjusted_score")))
    rows = s.select(*keys, "record_key", "gene_id", "gene_symbol", "base_score", "adjusted_score", "final_score", "confidence_weight", "ubiquity_weight", "quality", "row_ordinal")
    one = materialize(SC.collapse_best(rows, [*keys, "record_key", "gene_id"], duplicates, "final_score", "quality", "row_ordinal"))
    genes = SC.records_to_gene(one, keys, aggregation, k)
    names = one.groupBy(*keys, "gene_id").agg(F.min_by("gene_symbol", "row_ordinal").alias("gene_symbol"))
    return SEL.select_and_weight(genes.join(names, [*keys, "gene_id"]), keys, **(select or {}))


def match_protein(site_stats: DataFrame, protein_stats: DataFrame) -> DataFrame:
    """Attach the protein contrast by accession, else gene id, else symbol."""
    pick = lambda c: protein_stats.filter(F.col(c).isNotNull()).groupBy("contrast_id", c).agg(F.max_by("effect", "row_ordinal").alias(f"_{c}"))
    out = site_stats
    cols = [c for c in ("protein_accession", "gene_id", "gene_symbol") if c in protein_stats.columns and c in site_stats.columns]
    for c in cols:
        out = out.join(pick(c), ["contrast_id", c], "left")
    return out.withColumn("protein_logfc", F.coalesce(*[F.col(f"_{c}") for c in cols])).drop(*[f"_{c}" for c in cols])


def ptm_site_matrix(values: DataFrame, site_info: DataFrame, samples: DataFrame, contrasts: DataFrame, proteins: DataFrame | None = None, protein_info: DataFrame | None = None,
                    stat: str = "welch_t", min_present: int = 2, **kw) -> DataFrame:
    """Site x sample matrix: statistic for every contrast in one shuffle, then the site plan keyed by contrast.

    ``values`` and ``site_info`` share ``feature_id``.
    """
    t = C.two_arm_statistic(C.arm_moments(values, samples, contrasts), stat="welch_t", min_present=min_present)
    rows = t.withColumn("logfc", F.col("effect")).withColumn("pvalue", ST.normal_p("stat"))
    if stat == "mean_diff":
        rows = rows.withColumn("stat", F.col("effect"))
    rows = rows.join(site_info, "feature_id")
    if proteins is not None:
        pt = C.two_arm_statistic(C.arm_moments(proteins, samples, contrasts), stat="mean_diff", min_present=min_present).join(protein_info, "feature_id")
        rows = match_protein(rows, pt)
    if "row_ordinal" not in rows.columns:
        rows = rows.withColumn("row_ordinal", F.col("feature_id"))
    return ptm_site_diff(rows, ["contrast_id"], **kw)


ptm_reference_bundle = P.site_bundle
