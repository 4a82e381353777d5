"""Splice events to gene programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators import contrasts as C
from lociweave.operators import identifiers as ID
from lociweave.operators import priors as P
from lociweave.operators import scoring as SC
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST
from lociweave.operators.scoring import with_presence
from lociweave.plans.proteomics import _with
from lociweave.session import materialize
from lociweave.sources.assays import backfill_cluster_p


def event_type(x) -> Column:
    c = F.regexp_replace(F.lower(F.trim(F.col(x) if isinstance(x, str) else x)), r"[-/ ]+", "_")
    c = F.regexp_replace(F.regexp_replace(c, "_+", "_"), "^_|_$", "")
    # Event-type spellings.
    names = {
        "retained_intron": ("ri", "retained_intron", "intron_retention", "ir"),
        "exon_skip": ("se", "skipped_exon", "cassette_exon", "exon_skip", "es"),
        "alt_donor": ("a5ss", "alt_donor", "alternative_5prime", "alternative_5'_splice_site"),
        "alt_acceptor": ("a3ss", "alt_acceptor", "alternative_3prime", "alternative_3'_splice_site"),
        "mutually_exclusive_exon": ("mxe", "mutually_exclusive_exon"),
        "alt_first_exon": ("afe",),
        "alt_last_exon": ("ale",),
    }
    spelled = F.create_map(*[F.lit(x) for name, spellings in names.items() for s in spellings for x in (s, name)])
    return F.coalesce(F.try_element_at(spelled, c), F.nullif(c, F.lit("")), F.lit("unknown"))


def canonical_key(e: DataFrame) -> DataFrame:
    """Coordinate key with high confidence; stable source id with medium; raw id with low."""
    text = lambda c: S.clean(F.col(c).cast("string"))
    tail = F.coalesce(text("event_group"), text("event_id"))
    placed = text("chrom").isNotNull() & text("start").isNotNull() & text("end").isNotNull()
    coord = F.when(placed, F.concat_ws(":", text("chrom"), F.concat_ws("-", text("start"), text("end")), F.coalesce(text("strand"), F.lit(".")), F.col("event_type"), tail))
    name = F.coalesce(text("gene_symbol"), text("gene_id"))
    stable = F.when(
        (F.col("tool_family") == "tcga_spliceseq") & text("event_id").isNotNull() & name.isNotNull() & (F.col("event_type") != "unknown"),
        F.concat_ws("::", F.lit("tcga_spliceseq_asid"), name, F.col("event_type"), text("event_id")),
    )
    # Later columns refer to the keys by name, so each key is built once per row.
    e = e.withColumn("coord_key", coord).withColumn("_stable", stable)
    placed, named = F.col("coord_key").isNotNull(), F.col("_stable").isNotNull()
    return e.withColumn("record_key", F.coalesce("coord_key", "_stable", text("event_id"), text("event_group"))).withColumn(
        "confidence", F.when(placed, "high").when(named, "medium").otherwise("low")).withColumn(
        "namespace", F.when(placed, "global_coordinate").when(named, "tcga_spliceseq_asid").otherwise("raw_id_fallback")).drop("_stable")


def event_score(e: DataFrame, keys: Sequence[str], mode: str, p: str | None, reads: str | None, prob: str | None) -> DataFrame:
    """``base_score`` per row; ``auto`` decides for each comparison: stat, else delta PSI with p or confidence, else the score column."""
    rows = with_presence(e, keys, ["stat", "delta_psi"]) if mode == "auto" else e
    null = F.lit(None).cast("double")
    has = lambda c: F.col(c) if c in rows.columns else null
    if mode == "delta_psi_times_confidence" or mode == "auto" and not p:
        if reads:
            rows = P.with_maximum(rows, reads, "_mr", keys)
        proxy = F.coalesce(
            *([F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(prob)))] if prob else []),
            *([F.when(F.col("_mr") > 0, F.least(F.lit(1.0), F.log1p(reads) / F.log1p("_mr")))] if reads else []), F.lit(1.0),
        )
        psi = has("delta_psi") * proxy
    else:
        psi = S.effect_times_p("delta_psi", p, clamped=False) if p and mode in ("auto", "delta_psi_times_neglog10p") else null
    if mode == "auto":
        base = F.when(F.col("_has_stat"), has("stat")).when(F.col("_has_delta_psi"), psi).otherwise(has("score"))
    else:
        base = {"stat": has("stat"), "custom_column": has("score")}.get(mode, psi)
    return rows.withColumn("base_score", base).drop("_has_stat", "_has_delta_psi")


def splice_event_diff(
    events: DataFrame, keys: Sequence[str] = (), mode: str = "auto", aliases: DataFrame | None = None, ubiquity: DataFrame | None = None, impact: DataFrame | None = None,
    burden: DataFrame | None = None, ambiguous: str = "drop", confidence: str = "combined", transform: str = "signed", floor: float = 0.05,
    duplicates: str = "highest_confidence", aggregation: str = "signed_topk_mean", k: int = 3, support: str = "auto", burden_mode: str = "auto",
    diversity: str = "none", window: int = 20_000_000, impact_mode: str = "conservative", select: dict | None = None,
    dataset: str | None = None, own_dataset: str = "exclude", ubiquity_by_dataset: DataFrame | None = None, burden_by_dataset: DataFrame | None = None,
    clusters: DataFrame | None = None, loci: DataFrame | None = None,
) -> DataFrame:
    """Event differences to selected genes with priors and penalties.

    Of the per-dataset priors the own ``dataset`` is left out (``own_dataset``
    may also be ignore or fail), and medium-confidence events use a prior only
    where other datasets carry it. ``clusters`` fills p-values by event group,
    ``loci`` (gene_symbol, chromosome_arm) places genes for the diversity penalty.
    """
    if own_dataset not in ("exclude", "ignore", "fail"):
        raise ValueError(f"unknown action {own_dataset!r}")
    if clusters is not None:
        events = backfill_cluster_p(events, clusters)
    allowed = None
    if ubiquity_by_dataset is not None:
        if own_dataset == "fail" and dataset is not None and not ubiquity_by_dataset.filter(F.col("source_dataset") == dataset).isEmpty():
            raise ValueError(f"dataset {dataset!r} is part of its own prior")
        pooled = P.pool_event_ubiquity(ubiquity_by_dataset) if ubiquity is None else ubiquity
        out = dataset if own_dataset == "exclude" else None
        ubiquity = pooled if out is None else P.leave_dataset_out(pooled, ubiquity_by_dataset, out)
        allowed = P.medium_prior_allowed(ubiquity_by_dataset, out).select(F.col("canonical_event_key").alias("record_key"), F.lit(True).alias("_allowed"))
    if burden_by_dataset is not None:
        burden = P.gene_burden(burden_by_dataset, dataset if own_dataset == "exclude" else None)
    p = "padj" if "padj" in events.columns else "pvalue" if "pvalue" in events.columns else None
    cols = ["event_id", "event_group", "event_type", "gene_id", "gene_symbol", "chrom", "start", "end", "strand", "annotation_status", "novel_flag", "tool_family"]
    e = _with(events, cols).withColumn("event_type", event_type("event_type")).withColumn("_id", F.xxhash64("row_ordinal"))
    has = lambda c: c if c in e.columns else None
    reads, prob = has("read_support"), has("probability")
    e = canonical_key(event_score(e, keys, mode, p, reads, prob).filter("base_score is not null"))
    if aliases is not None:
        a = aliases.select("input_key", "canonical_event_key", "gene_symbol")
        e = ID.first_alias(e, a, [F.col("event_id"), F.col("event_group"), F.col("coord_key")], ["_id"], alias_columns=["canonical_event_key", "gene_symbol"])
        e = e.withColumn("record_key", F.coalesce("alias_canonical_event_key", "record_key")).withColumn("gene_symbol", F.coalesce(S.clean("alias_gene_symbol"), "gene_symbol"))
    e = ID.assign_genes(e.filter("record_key is not null"), policy=ambiguous)
    e = P.event_confidence(e, confidence, p, prob, reads, keys=keys)
    x = S.transform_score("base_score", transform)
    e = e.withColumn("_x", x).withColumn("_floor", P.soft_floor("delta_psi", floor) if "delta_psi" in e.columns else F.lit(1.0))
    if ubiquity is not None:
        u = ubiquity.select(F.col("canonical_event_key").alias("record_key"), "idf_ref")
        e = P.prior_weight(e, u, "record_key", "idf_ref", "_idf")
        e = e.join(allowed, "record_key", "left") if allowed is not None else e.withColumn("_allowed", F.lit(True))
        e = e.withColumn("ubiquity_weight", F.when(F.col("confidence") == "high", F.col("_idf")).when(
            (F.col("confidence") == "medium") & F.coalesce("_allowed", F.lit(False)), P.shrink_to_neutral(F.col("_idf"), F.lit("medium"))).otherwise(1.0))
    else:
        e = e.withColumn("ubiquity_weight", F.lit(1.0))
    raw, evid = P.default_impact("event_type", "annotation_status", (S.boolish("novel_flag") | (F.lower(S.clean("novel_flag")) == "novel")))
    fallback = F.greatest(F.lit(0.75), F.least(F.lit(1.35), P.shrink_to_neutral(1.0 + evid * (raw - 1.0), F.col("confidence"))))
    if impact_mode == "none":
        e = e.withColumn("impact_weight", F.lit(1.0))
    elif impact is not None:
        i = impact.select(F.col("canonical_event_key").alias("record_key"), "impact_weight_raw", "impact_evidence", F.col("canonicalization_confidence").alias("_ic"), "n_datasets_ref")
        e = e.join(i, "record_key", "left").withColumn("impact_weight", F.when(
            F.col("impact_weight_raw").isNotNull(), P.impact_weight("impact_weight_raw", "impact_evidence", "_ic", "n_datasets_ref")).otherwise(fallback))
    else:
        e = e.withColumn("impact_weight", fallback)
    e = e.withColumn("final_score", F.col("_x") * F.col("_floor") * F.col("confidence_weight") * F.col("impact_weight") * F.col("ubiquity_weight") * F.col("gene_fraction"))
    pw = P.p_weight(p) if p else F.lit(1.0)
    e = e.withColumn("quality", pw * F.greatest(F.lit(1e-6), F.abs("_x"))).withColumn("event_group", F.coalesce(S.clean("event_group"), "record_key"))
    rows = e.select(*keys, "record_key", "gene_id", "gene_symbol", "event_group", "base_score", "final_score", "confidence_weight", "ubiquity_weight", "quality", "row_ordinal",
                    "chrom", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    one = SC.collapse_best(rows, [*keys, "record_key", "gene_id"], duplicates, "final_score", "quality", "row_ordinal")
    # Read four times below: written once, so the scoring chain runs once.
    grouped = materialize(P.collapse_event_groups(one, keys))
    by = [*keys, "gene_id"]
    genes = SC.records_to_gene(grouped, keys, aggregation, k)
    lead = F.struct((-F.abs("final_score")).alias("a"), (-F.col("quality")).alias("q"), F.col("row_ordinal").alias("o"))
    mid = F.coalesce((F.col("start") + F.col("end")) / 2, F.col("start"), F.col("end"))
    place = F.struct("chrom", F.when(F.col("chrom").isNotNull(), F.concat_ws(":", "chrom", F.floor(mid / float(window)).cast("string"))).alias("locus_key"))
    info = grouped.groupBy(*by).agg(F.min_by("gene_symbol", "row_ordinal").alias("gene_symbol"), F.min_by(place, lead).alias("_p"), F.countDistinct("event_group").alias("n_groups_input"))
    s = P.support_penalty(grouped, genes, keys, support, k, aggregation).join(info.select(*by, "gene_symbol", "_p.chrom", "_p.locus_key"), by)
    s = P.burden_penalty(s, info.select(*by, "n_groups_input"), keys, burden, burden_mode, k)
    if loci is None:
        s = s.withColumn("chromosome_arm", F.lit(None).cast("string"))
    else:
        s = s.join(loci.groupBy("gene_symbol").agg(F.min("chromosome_arm").alias("chromosome_arm")), "gene_symbol", "left")
    s = P.diversity_penalty(s, keys, diversity)
    return SEL.select_and_weight(s, keys, **(select or {}))


def splice_event_matrix(psi: DataFrame, event_info: DataFrame, samples: DataFrame, contrasts: DataFrame, coverage: DataFrame | None = None, min_present: int = 2, **kw) -> DataFrame:
    """PSI matrix: Welch test and BH for every contrast, then the event plan keyed by contrast.

    Coverage is matched by event id; a mean over samples becomes the read support.
    """
    t = C.two_arm_statistic(C.arm_moments(psi, samples, contrasts), min_present=min_present)
    rows = ST.bh_adjust(t.withColumn("pvalue", ST.normal_p("stat")).withColumnRenamed("effect", "delta_psi"), ["contrast_id"]).drop("stat")
    rows = rows.join(event_info, "feature_id")
    if coverage is not None:
        c = coverage.groupBy("feature_id").agg(F.avg("value").alias("read_support"))
        rows = rows.join(c, "feature_id", "left")
    if "row_ordinal" not in rows.columns:
        rows = rows.withColumn("row_ordinal", F.col("feature_id"))
    return splice_event_diff(rows, ["contrast_id"], **kw)


def splice_reference_bundle(rows: DataFrame, min_reads: float = 10.0) -> dict[str, DataFrame]:
    """Alias, ubiquity and burden priors, pooled and per dataset, with impact defaults per event."""
    by = P.event_ubiquity_by_dataset(rows, min_reads)
    burden = P.gene_burden_by_dataset(rows)
    k = P.event_bundle_key("canonical_event_key", "source_dataset", "canonicalization_confidence")
    info = rows.groupBy(k.alias("canonical_event_key")).agg(
        F.min_by(F.struct("event_type", "annotation_status", "canonicalization_confidence"), "row_ordinal").alias("_i"), F.countDistinct("source_dataset").alias("n_datasets_ref")
    ).select("canonical_event_key", "n_datasets_ref", "_i.*")
    raw, evid = P.bundle_impact("event_type", "annotation_status")
    return {
        "aliases": P.event_aliases(rows),
        "ubiquity_by_dataset": by,
        "ubiquity": P.pool_event_ubiquity(by),
        "impact": info.withColumn("impact_weight_raw", raw).withColumn("impact_evidence", evid),
        "burden_by_dataset": burden,
        "burden": P.gene_burden(burden),
    }
