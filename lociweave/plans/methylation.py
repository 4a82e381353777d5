"""Methylation: CpG and region differences to gene programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators import identifiers as ID
from lociweave.operators import intervals as I
from lociweave.operators import scoring as SC
from lociweave.operators import selection as SEL
from lociweave.plans.accessibility import link_values, program_grid, span_limit, stretch_pairs
from lociweave.session import materialize

# Sex chromosomes by either spelling.
SEX_CHROMS = ("x", "y", "chrx", "chry")
# The promoter program uses promoter overlap, the distal one distance decay.
CONNECTABLE = [("promoter_activity", "promoter_overlap"), ("distal_activity", "distance_decay")]


def score_features(features: DataFrame, mode: str = "delta_times_neglog10p", orientation: str = "activity_oriented", eps: float = 1e-300, cap: float = 50.0) -> DataFrame:
    """Signed feature value; activity orientation flips the methylation change."""
    p = F.coalesce(*[F.col(c) for c in ("padj", "pvalue") if c in features.columns]) if {"padj", "pvalue"} & set(features.columns) else None
    sign = -1.0 if orientation == "activity_oriented" else 1.0
    value = F.col("delta") * sign
    if mode == "delta_times_neglog10p":
        value = value * S.neglog10_clamped(p, eps, cap)
    return features.withColumn("value", value).filter("value is not null")


def _linked_scores(f: DataFrame, genes: DataFrame, grid: Sequence[tuple[str, str]], by: Sequence[str], aggregation: str, transform: str, enhancers: DataFrame | None,
                   harmonize: bool, up: int, down: int, **link_settings) -> DataFrame:
    """Scores per (keys, program, link, gene) from links of every feature row."""
    if harmonize:
        f = ID.harmonize_chrom(f, genes.select("chrom"))
    f = materialize(f)
    prom = I.promoters(genes, up, down).select("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"))
    places = materialize(f.select("chrom", "start", "end").distinct())
    spans = I.overlap_flag(places, prom, "in_promoter", distinct=True)
    if enhancers is not None:
        spans = I.overlap_flag(spans, enhancers, "in_enhancer", distinct=True)
    # Written, as each link method reads it.
    x = materialize(f.join(spans, ["chrom", "start", "end"]))
    distal = ~F.col("in_promoter") & (F.col("in_enhancer") if enhancers is not None else F.lit(True))
    value = {
        "linked_activity": F.col("value"),
        "promoter_activity": F.when(F.col("in_promoter"), F.col("value")).otherwise(0.0),
        "distal_activity": F.when(distal, F.col("value")).otherwise(0.0),
    }
    items = F.array(*[F.struct(F.lit(p).alias("program"), S.transform_score(value[p], transform).alias("v")) for p in sorted({p for p, _ in grid})])
    long = x.withColumn("_i", F.explode(items)).select(*by[:-2], "chrom", "start", "end", "_i.program", F.col("_i.v").alias("value"), *[c for c in ("row_ordinal",) if c in x.columns])
    linked = link_values(long, places, genes, grid, upstream=up, downstream=down, **link_settings)
    ties = [F.col("row_ordinal")] if "row_ordinal" in linked.columns else []
    return SC.aggregate_to_gene(linked, by, aggregation, tiebreak=ties)


def _stretch_scores(f: DataFrame, genes: DataFrame, grid: Sequence[tuple[str, str]], aggregation: str, transform: str, harmonize: bool, longest: int, up: int, down: int,
                    **link_settings) -> DataFrame:
    """The same without keys and enhancers, for sums and weighted means: rows are added up per span, where features and genes meet in stretches.

    The genes take the features' spelling of their chromosome; they are fewer.
    """
    if harmonize:
        lookup = ID.chrom_spellings(f, genes.select("chrom"))
        genes = genes.withColumnRenamed("chrom", "_to").join(lookup, "_to")
    payload = [F.sum(S.transform_score("value", transform)).alias("v"), F.count("*").alias("n")]
    pairs, weight = stretch_pairs(f, payload, genes, grid, longest, up, down, **link_settings)
    value = {
        "linked_activity": F.col("v"),
        "promoter_activity": F.when(F.col("in_promoter"), F.col("v")).otherwise(0.0),
        "distal_activity": F.when(F.col("in_promoter"), 0.0).otherwise(F.col("v")),
    }
    methods = sorted({m for _, m in grid})
    sums = [F.sum(value[p] * weight[m]).alias(f"{p}/{m}") for p, m in grid] + [F.sum(F.abs(weight[m]) * F.col("n")).alias(m) for m in methods]
    rows = []
    for p, m in grid:
        total, by = F.col(f"{p}/{m}"), F.col(m)
        score, there = (total / by, by > 1e-12) if aggregation == "weighted_mean" else (total, by.isNotNull())
        rows.append(F.struct(F.lit(p).alias("program"), F.lit(m).alias("link_method"), score.alias("score"), there.alias("there")))
    found = pairs.groupBy("gene_id").agg(*sums).select("gene_id", F.explode(F.array(*rows)).alias("i")).filter("i.there")
    return found.select("i.program", "i.link_method", "gene_id", "i.score")


def methylation_programs(
    features: DataFrame, genes: DataFrame, grid: Sequence[tuple[str, str]] | None = None, keys: Sequence[str] = (), aggregation: str = "weighted_mean",
    transform: str = "signed", drop_sex: bool = False, blacklist: DataFrame | None = None, enhancers: DataFrame | None = None,
    exclude: Sequence[str] = (), exclude_genes: DataFrame | None = None, select: dict | None = None, harmonize: bool = True, **link_settings,
) -> DataFrame:
    """CpG or region features to selected genes per (keys, program, link).

    Masked features keep their place with value 0, so weighted means count them
    in the denominator.
    """
    f = features
    if blacklist is not None:
        f = f.join(blacklist.select("probe_id").distinct(), "probe_id", "left_anti")
    if drop_sex:
        f = f.filter(~F.lower("chrom").isin(*SEX_CHROMS))
    grid, by = list(grid or CONNECTABLE), [*keys, "program", "link_method"]
    settings = {"up": link_settings.pop("upstream", 2000), "down": link_settings.pop("downstream", 500)}
    if not keys and enhancers is None and aggregation in ("weighted_mean", "sum"):
        if blacklist is not None:
            f = materialize(f)
        longest = span_limit(f, grid, settings["up"], settings["down"], **link_settings)
    else:
        longest = None
    if longest is not None:
        scores = _stretch_scores(f, genes, grid, aggregation, transform, harmonize, longest, **settings, **{k: v for k, v in link_settings.items() if k != "external"})
    else:
        scores = _linked_scores(f, genes, grid, by, aggregation, transform, enhancers, harmonize, **settings, **link_settings)
    scores = scores.join(genes.select("gene_id", "gene_symbol").dropDuplicates(["gene_id"]), "gene_id", "left") if "gene_symbol" in genes.columns else scores
    name = F.coalesce(S.clean("gene_symbol"), F.col("gene_id")) if "gene_symbol" in scores.columns else F.col("gene_id")
    if exclude_genes is not None:
        scores = scores.withColumn("_t", F.upper(name)).join(exclude_genes.select(F.upper("token").alias("_t")).distinct(), "_t", "left_anti").drop("_t")
    if exclude:
        scores = scores.withColumn("_t", name).filter(~S.matches_any(["_t"], exclude)).drop("_t")
    return SEL.select_and_weight(scores.filter("score <> 0"), by, **{"order": SEL.tied_order(), **(select or {})})


def methylation_dmr(rows: DataFrame, keys: Sequence[str] = (), transform: str = "signed", select: dict | None = None) -> DataFrame:
    """Gene-level differences: values of a gene add up, then transform, rank and normalise."""
    s = rows.groupBy(*keys, "gene_id").agg(F.sum("delta").alias("score"))
    s = s.withColumn("score", S.transform_score("score", transform))
    return SEL.select_and_weight(s, keys, **(select or {"how": "none"}))


__all__ = ["CONNECTABLE", "methylation_dmr", "methylation_programs", "program_grid", "score_features"]
