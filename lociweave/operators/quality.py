"""Output checks and quality summaries, all as result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators.joins import attach
from lociweave.operators.selection import top_k


def token() -> Column:
    return F.upper(F.coalesce(F.nullif(F.trim(F.col("gene_symbol")), F.lit("")), F.col("gene_id")))


def marker_panel(full: DataFrame, selected: DataFrame, panels: DataFrame, keys: Sequence[str] = (), top_n: int = 20) -> DataFrame:
    """Per (keys, panel): hits in the top rows, hits and weight share among selected rows, and a confidence.

    ``panels`` has (panel, token). low: share >= .25 or three top hits; medium:
    share >= .15 or two top hits.
    """
    p = panels.select("panel", F.upper("token").alias("token")).distinct()
    top = top_k(full, keys, top_n, rank="_r").withColumn("token", token()).select(*keys, "token")
    t = top.join(p, "token").groupBy(*keys, "panel").agg(F.count("*").alias("top_hits"))
    s = selected.withColumn("token", token()).join(p, "token").groupBy(*keys, "panel").agg(
        F.count("*").alias("selected_hits"), F.sum("weight").alias("weight_fraction")
    )
    j = t.join(s, [*keys, "panel"], "full_outer")
    hits, share = F.coalesce("top_hits", F.lit(0)), F.coalesce("weight_fraction", F.lit(0.0))
    level = F.when((share >= 0.25) | (hits >= 3), "low").when((share >= 0.15) | (hits >= 2), "medium").otherwise("high")
    return j.select(
        *keys, "panel", hits.alias("top_hits"), F.coalesce("selected_hits", F.lit(0)).alias("selected_hits"),
        share.alias("weight_fraction"), level.alias("confidence"),
    )


def run_summary(rows: DataFrame, keys: Sequence[str] = (), score: str = "score") -> DataFrame:
    """Counts and score extremes per key."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n_rows"), F.countDistinct("gene_id").alias("n_genes"),
        F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.avg(score).alias("mean_score"),
    )


def link_coverage(features: DataFrame, links: DataFrame, on: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Share of features with at least one link."""
    has = links.select(*on).distinct().withColumn("_has", F.lit(1))
    return features.join(has, list(on), "left").groupBy(*keys).agg(
        F.count("*").alias("n_features"), F.count("_has").alias("n_linked")
    ).withColumn("linked_fraction", F.col("n_linked") / F.col("n_features"))


def validate_rows(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Violations per key: repeated genes, missing or non-finite numbers, rank gaps. Clean keys give no row."""
    cols = [c for c in ("score", "weight", "rank") if c in rows.columns]
    per = rows.groupBy(*keys, "gene_id").agg(
        F.count("*").alias("_n"),
        *[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(f"_bad_{c}") for c in cols],
        *([F.max("rank").alias("_rank")] if "rank" in cols else []),
    )
    out = per.groupBy(*keys).agg(
        F.sum(F.col("_n") - 1).alias("repeated_genes"),
        *[F.sum(f"_bad_{c}").alias(f"bad_{c}") for c in cols],
        *([(F.max("_rank") - F.sum("_n")).alias("rank_gap")] if "rank" in cols else []),
    )
    bad = F.col("repeated_genes") > 0
    for c in cols:
        bad = bad | (F.col(f"bad_{c}") > 0)
    if "rank" in cols:
        bad = bad | (F.col("rank_gap") != 0)
    return out.filter(bad)


def validate_sets(sets: DataFrame) -> DataFrame:
    """Sets without a name, without genes, or with blank tokens."""
    blank = F.exists("genes", lambda g: F.trim(g) == "")
    return sets.filter((F.coalesce(F.trim("set_name"), F.lit("")) == "") | (F.size("genes") == 0) | blank)


def residue_composition(labels: DataFrame, column: str = "site_label") -> DataFrame:
    """Count of residue letters that precede a position in site labels."""
    found = F.regexp_extract_all(F.col(column), F.lit(r"([A-Za-z])(\d+)"), 1)
    return labels.select(F.explode(found).alias("residue")).groupBy(F.upper("residue").alias("residue")).agg(F.count("*").alias("n"))


def assert_counts(counts: DataFrame, value: str = "value", allow_fractions: bool = False) -> DataFrame:
    """One row: negatives and non-integers; raises when not allowed."""
    row = counts.agg(
        F.count_if(F.col(value) < 0).alias("n_negative"), F.count_if(F.col(value) != F.floor(value)).alias("n_fractional")
    )
    found = row.first()
    if found["n_negative"]:
        raise ValueError("negative counts")
    if found["n_fractional"] and not allow_fractions:
        raise ValueError("non-integer counts need allow_fractions")
    return row


def family_share(selected: DataFrame, families: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weight share of each gene family among selected rows."""
    j = selected.withColumn("token", token()).join(families.select(F.upper("token").alias("token"), "family").distinct(), "token")
    f = j.groupBy(*keys, "family").agg(F.sum("weight").alias("_w"))
    total = selected.groupBy(*keys).agg(F.sum("weight").alias("_t"))
    return attach(f, total, keys).withColumn("share", F.col("_w") / F.col("_t")).drop("_w", "_t")
