"""Copy-number segments to amplification, deletion and recurrence programs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.operators import identifiers as ID
from lociweave.operators import segments as SEG
from lociweave.operators import selection as SEL
from lociweave.session import materialize


def cnv_gene_programs(
    segments: DataFrame, genes: DataFrame, purity: DataFrame | None = None, settings: SEG.SegmentSettings | None = None, preset: str = "default",
    select: dict | None = None,
) -> dict[str, DataFrame]:
    """Tables: selected genes per (sample, program), cohort recurrence, segment summary, tie diagnostics, breadth."""
    cfg = (settings or SEG.SegmentSettings()).preset(preset)
    s = SEG.correct_segments(ID.harmonize_chrom(segments, genes.select("chrom")), cfg, purity)
    links = materialize(SEG.segment_links(s, genes, cfg))
    signed = materialize(SEG.gene_scores(links, cfg))
    if "gene_symbol" in genes.columns:
        names = genes.select("gene_id", "gene_symbol").dropDuplicates(["gene_id"])
        prog = SEG.programs(signed).join(names, "gene_id", "left")
    else:
        prog = SEG.programs(signed).withColumn("gene_symbol", F.lit(None).cast("string"))
    keys = ["sample_id", "program"]
    chosen = select or {}
    picked = SEL.select_and_weight(prog, keys, order=SEL.cnv_order(), **chosen)
    n = signed.agg(F.countDistinct("sample_id").alias("n_samples"))
    rec = SEL.rank_rows(SEG.recurrence(signed, n), ["program"])
    return {
        "programs": picked,
        "recurrence": rec,
        "segments": SEG.segment_summary(s, links),
        "ties": SEL.tie_diagnostics(prog, keys, chosen.get("k", 200), SEL.cnv_order()),
        "breadth": SEG.selected_breadth(links, picked),
    }
