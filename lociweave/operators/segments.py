"""Copy-number segments: filters, gene scores, cohort recurrence and quality summaries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators import sliced
from lociweave.operators.intervals import segment_gene_overlaps
from lociweave.operators.joins import attach
from lociweave.operators.scoring import aggregate_to_gene


@dataclass(frozen=True)
class SegmentSettings:
    """Default scales, caps and penalties."""

    purity_floor: float = 0.1
    max_abs_amplitude: float = 3.0
    min_abs_amplitude: float = 0.1
    max_length: int = 0
    length_scale: float = 1e7
    length_alpha: float = 1.0
    count_penalty: str = "inv_sqrt"
    aggregation: str = "weighted_mean"

    def preset(self, name: str) -> "SegmentSettings":
        """focal or broad values replace settings that are still at their default."""
        base = SegmentSettings()
        change = {
            "focal": {"length_scale": 2.5e6, "length_alpha": 1.5, "count_penalty": "inv", "max_length": 50_000_000},
            "broad": {"length_scale": 1e8, "length_alpha": 0.25, "count_penalty": "none"},
        }.get(name, {})
        return replace(self, **{k: v for k, v in change.items() if getattr(self, k) == getattr(base, k)})


def segment_length(start: str = "start", end: str = "end") -> Column:
    return F.greatest(F.lit(1), F.col(end) - F.col(start))


def correct_segments(segments: DataFrame, settings: SegmentSettings, purity: DataFrame | None = None) -> DataFrame:
    """Length cap, purity-corrected and clamped amplitude, minimum amplitude after correction."""
    out = segments
    if settings.max_length > 0:
        out = out.filter(segment_length() <= settings.max_length)
    amp = F.col("amplitude")
    if purity is not None:
        out = out.join(purity.select("sample_id", F.col("purity").alias("_p")), "sample_id", "left")
        amp = F.when(F.col("_p").isNotNull(), amp / F.greatest(F.col("_p"), F.lit(settings.purity_floor))).otherwise(amp)
    cap = abs(settings.max_abs_amplitude)
    if cap > 0:
        amp = F.greatest(F.lit(-cap), F.least(F.lit(cap), amp))
    out = out.withColumn("amplitude", amp)
    if purity is not None:
        out = out.drop("_p")
    return out.filter(F.abs("amplitude") >= settings.min_abs_amplitude)


def focal_penalty(length, scale: float, alpha: float) -> Column:
    x = F.greatest(F.lit(1.0), length.cast("double")) / max(1.0, scale)
    return 1.0 / (1.0 + F.pow(x, F.lit(max(1e-9, alpha))))


def count_penalty(n, mode: str) -> Column:
    n = F.greatest(F.lit(1), n)
    picks = {"none": F.lit(1.0), "inv_sqrt": 1.0 / F.sqrt(n), "inv": 1.0 / n}
    return picks[mode]


def segment_links(segments: DataFrame, genes: DataFrame, settings: SegmentSettings) -> DataFrame:
    """One row per (sample, segment, gene) with the penalised segment score.

    Overlaps are found once per distinct span; a cohort shares them.
    """
    links = segment_gene_overlaps(segments, genes)
    j = segments.join(links, ["chrom", "start", "end"])
    focal = focal_penalty(segment_length(), settings.length_scale, settings.length_alpha)
    score = F.col("amplitude") * focal * count_penalty(F.col("n_genes"), settings.count_penalty)
    return j.withColumn("focal", focal).withColumn("segment_score", score)


def gene_scores(links: DataFrame, settings: SegmentSettings) -> DataFrame:
    """Signed score per (sample, gene); max_abs ties go to the last segment by start, end."""
    ties = [F.col("start"), F.col("end")]
    return aggregate_to_gene(
        links, ["sample_id"], settings.aggregation, "segment_score", "overlap_fraction", tiebreak=ties, last=True
    )


def programs(scores: DataFrame) -> DataFrame:
    """Split signed scores into amp, del and abs programs, positive values only."""
    s = scores.withColumn("program", F.explode(F.array(F.lit("amp"), F.lit("del"), F.lit("abs"))))
    value = F.when(F.col("program") == "amp", F.col("score")).when(F.col("program") == "del", -F.col("score")).otherwise(F.abs("score"))
    return s.withColumn("score", value).filter("score > 0")


def recurrence(
    scores: DataFrame, n_samples: DataFrame, threshold: float = 0.15, min_fraction: float = 0.05, min_samples: int = 5
) -> DataFrame:
    """Fraction of samples whose gene score passes the threshold, per direction.

    ``n_samples`` is a one-row table with column ``n_samples``; small cohorts give no rows.
    """
    hit = scores.withColumn(
        "program", F.when(F.col("score") > threshold, "recurrent_amp").when(F.col("score") < -threshold, "recurrent_del")
    ).filter("program is not null")
    counted = hit.groupBy("program", "gene_id").agg(F.count("*").alias("_k"))
    out = attach(counted, n_samples.select("n_samples"), [])
    out = out.filter(F.col("n_samples") >= min_samples).withColumn("score", F.col("_k") / F.col("n_samples"))
    return out.filter(F.col("score") >= min_fraction).drop("_k", "n_samples")


def segment_summary(segments: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """Per sample: count, amplitude and length extremes with exact medians, main chromosome, top segment."""
    x = segments.withColumn("_abs", F.abs("amplitude")).withColumn("_len", segment_length().cast("double"))
    top = F.struct(F.col("chrom"), F.col("start"), F.col("end"))
    agg = x.groupBy("sample_id").agg(
        F.count("*").alias("n_segments"),
        F.min("_abs").alias("min_abs_amplitude"),
        F.max("_abs").alias("max_abs_amplitude"),
        F.min("_len").alias("min_length"),
        F.max("_len").alias("max_length"),
        F.max_by(top, F.struct(F.col("_abs"), -F.col("start"))).alias("top_segment"),
    )
    med_a = sliced.median(x, ["sample_id"], "_abs", "median_abs_amplitude")
    med_l = sliced.median(x, ["sample_id"], "_len", "median_length")
    by_chrom = x.groupBy("sample_id", "chrom").agg(F.count("*").alias("_c"))
    main = by_chrom.groupBy("sample_id").agg(F.max_by("chrom", F.struct("_c", "chrom")).alias("main_chrom"))
    out = agg.join(med_a, "sample_id").join(med_l, "sample_id").join(main, "sample_id")
    if links is not None:
        out = out.join(links.groupBy("sample_id").agg(F.countDistinct("gene_id").alias("n_genes")), "sample_id", "left")
    return out


def selected_breadth(links: DataFrame, selected: DataFrame) -> DataFrame:
    """Median segment length and mean focal penalty behind the selected genes of a sample."""
    kept = links.join(selected.select("sample_id", "gene_id").distinct(), ["sample_id", "gene_id"], "left_semi")
    kept = kept.withColumn("_len", segment_length().cast("double"))
    med = sliced.median(kept, ["sample_id"], "_len", "median_length")
    return med.join(kept.groupBy("sample_id").agg(F.avg("focal").alias("mean_focal")), "sample_id")
