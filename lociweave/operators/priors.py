"""Confidence weights, penalties and reference priors for sites and splice events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.functions.idf import event_idf, site_idf
from lociweave.operators import sliced
from lociweave.operators.joins import attach
from lociweave.operators.selection import top_k

# How far a prior moves from neutral at each confidence.
CONFIDENCE_SHRINK = {"high": 1.0, "medium": 0.6}
LOW_SHRINK = 0.25


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def p_weight(p, eps: float = 1e-300, cap: float = 50.0) -> Column:
    return F.coalesce(S.neglog10_floor(p, eps, cap) / cap, F.lit(1.0))


def floor_weight(x, minimum: float) -> Column:
    """0 under the minimum, then linear up to 1; a missing value weighs 1."""
    x = _c(x)
    scaled = (x - minimum) / max(1e-12, 1.0 - minimum)
    return F.when(x.isNull(), 1.0).when(x < minimum, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)))


def log_share_weight(x, largest, minimum: float | None = None) -> Column:
    """log1p(x)/log1p(max), at most 1; missing weighs 1, and 0 under the minimum when one is set."""
    x, m = _c(x), _c(largest)
    share = F.when(m > 0, F.least(F.lit(1.0), F.log1p(x) / F.log1p(m))).otherwise(1.0)
    if minimum is None:
        return F.when(x.isNull() | (x < 0), 1.0).otherwise(share)
    return F.when(x.isNull(), 1.0).when(x < minimum, 0.0).otherwise(share)


def with_maximum(df: DataFrame, column: str, out: str, keys: Sequence[str] = ()) -> DataFrame:
    """Attach the largest value of a column, per key or over the whole table."""
    return attach(df, df.groupBy(*keys).agg(F.coalesce(F.max(column).cast("double"), F.lit(0.0)).alias(out)), list(keys))


def site_confidence(df: DataFrame, mode: str = "combined", p: str | None = "pvalue", localization: str | None = "localization_prob",
                    peptides: str | None = "peptide_count", min_localization: float = 0.75, out: str = "confidence_weight",
                    keys: Sequence[str] = ()) -> DataFrame:
    one = F.lit(1.0)
    pw = p_weight(p) if p else one
    lw = floor_weight(localization, min_localization) if localization else one
    if peptides:
        df = with_maximum(df, peptides, "_max_pep", keys)
        qw = log_share_weight(peptides, "_max_pep")
    else:
        qw = one
    picks = {"none": one, "pvalue": pw, "localization": lw, "combined": pw * lw * qw}
    res = df.withColumn(out, picks[mode])
    return res.drop("_max_pep")


def event_confidence(df: DataFrame, mode: str = "combined", p: str | None = "pvalue", probability: str | None = "probability",
                     reads: str | None = "read_support", min_probability: float = 0.8, min_reads: float = 10.0,
                     out: str = "confidence_weight", keys: Sequence[str] = ()) -> DataFrame:
    one = F.lit(1.0)
    pw = p_weight(p) if p else one
    qw = floor_weight(probability, min_probability) if probability else one
    if reads:
        df = with_maximum(df, reads, "_max_reads", keys)
        rw = log_share_weight(reads, "_max_reads", min_reads)
    else:
        rw = one
    picks = {"none": one, "pvalue": pw, "probability": qw, "read_support": rw, "combined": pw * qw * rw}
    return df.withColumn(out, picks[mode]).drop("_max_reads")


def soft_floor(delta, floor: float = 0.05) -> Column:
    """min(1, |delta| / floor); missing or a zero floor gives 1."""
    if floor <= 0:
        return F.lit(1.0)
    return F.coalesce(F.least(F.lit(1.0), F.abs(_c(delta)) / floor), F.lit(1.0))


def shrink_to_neutral(value: Column, confidence) -> Column:
    c = F.lower(_c(confidence))
    w = F.when(c == "high", CONFIDENCE_SHRINK["high"]).when(c == "medium", CONFIDENCE_SHRINK["medium"]).otherwise(LOW_SHRINK)
    return 1.0 + w * (value - 1.0)


def impact_weight(raw, evidence, confidence, n_datasets, low: float = 0.75, high: float = 1.35) -> Column:
    """Prior impact shrunk by confidence and clamped; unsupported non-high entries are neutral."""
    base = 1.0 + _c(evidence) * (_c(raw) - 1.0)
    value = F.greatest(F.lit(low), F.least(F.lit(high), shrink_to_neutral(base, confidence)))
    weak = (F.lower(_c(confidence)) != "high") & (F.coalesce(_c(n_datasets), F.lit(0.0)) < 2)
    return F.when(weak, 1.0).otherwise(value)


def default_impact(event_type, annotation, novel) -> tuple[Column, Column]:
    """(raw weight, evidence) by event class, coding annotation and novelty, in that order."""
    t = _c(event_type)
    shifts = t.isin("exon_skip", "alt_donor", "alt_acceptor", "mutually_exclusive_exon")
    intron = t == "retained_intron"
    coding = F.coalesce(F.lower(_c(annotation)).contains("coding"), F.lit(False))
    is_novel = F.coalesce(_c(novel), F.lit(False))
    raw = F.when(shifts, 1.1).when(intron, 0.92).otherwise(1.0)
    evidence = F.when(shifts | intron, 0.4).otherwise(0.2)
    raw = F.when(coding, F.greatest(raw, F.lit(1.12))).otherwise(raw)
    evidence = F.when(coding, F.greatest(evidence, F.lit(0.5))).otherwise(evidence)
    raw = F.when(is_novel, F.least(raw, F.lit(0.95))).otherwise(raw)
    evidence = F.when(is_novel, F.greatest(evidence, F.lit(0.3))).otherwise(evidence)
    return raw, evidence


def bundle_impact(event_type, annotation) -> tuple[Column, Column]:
    """(raw weight, evidence) stored in reference bundles; slightly stronger than the runtime defaults."""
    t, a = _c(event_type), F.lower(F.coalesce(_c(annotation), F.lit("")))
    shifts = t.isin("exon_skip", "alt_donor", "alt_acceptor", "mutually_exclusive_exon")
    intron = t == "retained_intron"
    raw = F.when(shifts, 1.12).when(intron, 0.9).otherwise(1.0)
    evidence = F.when(shifts, 0.45).when(intron, 0.4).otherwise(0.2)
    coding, novel = a.contains("coding"), a.contains("novel") | a.contains("unannotated")
    raw = F.when(coding, F.greatest(raw, F.lit(1.15))).otherwise(raw)
    evidence = F.when(coding, F.greatest(evidence, F.lit(0.55))).otherwise(evidence)
    raw = F.when(novel, F.least(raw, F.lit(0.95))).otherwise(raw)
    evidence = F.when(novel, F.greatest(evidence, F.lit(0.3))).otherwise(evidence)
    return raw, evidence


def prior_weight(df: DataFrame, prior: DataFrame, on: str, weight: str, out: str) -> DataFrame:
    """Left join of a prior weight with neutral default 1."""
    return df.join(prior.select(on, F.col(weight).alias("_w")), on, "left").withColumn(out, F.coalesce("_w", F.lit(1.0))).drop("_w")


def collapse_event_groups(events: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Strongest event per (keys, gene, event group)."""
    by = [*keys, "gene_id", "event_group"]
    rest = [c for c in events.columns if c not in by]
    order = F.struct((-F.abs("final_score")).alias("a"), (-F.col("quality")).alias("q"), F.col("row_ordinal").alias("o"))
    return events.groupBy(*by).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*by, "_r.*")


def support_penalty(events: DataFrame, scores: DataFrame, keys: Sequence[str] = (), mode: str = "auto", k: int = 3,
                    aggregation: str = "signed_topk_mean") -> DataFrame:
    """Scale gene scores by independent event groups and sign coherence of the supporting events."""
    by = [*keys, "gene_id"]
    if aggregation in ("signed_topk_mean", "max_abs"):
        kept = top_k(events, by, max(1, k) if aggregation == "signed_topk_mean" else 1, [F.abs("final_score").desc(), F.col("record_key").asc()], "_r")
    else:
        kept = events
    sup = kept.groupBy(*by).agg(
        F.countDistinct("event_group").alias("n_groups"),
        F.count("*").alias("n_events"),
        F.abs(F.sum("final_score")).alias("_s"),
        F.sum(F.abs("final_score")).alias("_a"),
    )
    coherence = F.when(F.col("_a") > 0, F.col("_s") / F.col("_a")).otherwise(0.0)
    if mode == "auto":
        pen = F.greatest(F.lit(0.55), F.least(F.lit(1.0), F.when(F.col("n_groups") >= 2, 1.0).otherwise(0.85) * (0.75 + 0.25 * coherence)))
    elif mode == "independent_groups":
        pen = F.least(F.lit(1.0), F.sqrt(F.greatest(F.lit(1), F.col("n_groups")) / 2.0))
    elif mode == "none":
        pen = F.lit(1.0)
    else:
        raise ValueError(f"unknown support penalty {mode!r}")
    sup = sup.select(*by, "n_groups", "n_events", coherence.alias("coherence"), pen.alias("support_penalty"))
    return scores.join(sup, by).withColumn("score", F.col("score") * F.col("support_penalty"))


def burden_penalty(scores: DataFrame, current: DataFrame, keys: Sequence[str] = (), bundle: DataFrame | None = None,
                   mode: str = "auto", k: int = 3, floor: float = 0.35) -> DataFrame:
    """sqrt(k / max(k, burden)) with a floor; burden from the reference when it has the gene, else from the input.

    ``current`` has ``n_groups_input`` per (keys, gene). ``bundle`` is keyed by gene_symbol.
    """
    by = [*keys, "gene_id"]
    s = scores.join(current, by, "left")
    own = F.coalesce(F.col("n_groups_input"), F.lit(0))
    burden = own.cast("double")
    if bundle is not None and mode in ("auto", "reference_bundle"):
        g = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        nz = lambda c: F.nullif(g(c), F.lit(0.0))
        groups = F.coalesce(nz("n_unique_event_groups_ref"), g("n_canonical_events_ref"))
        studies = F.coalesce(nz("n_studies_high_confidence_ref"), g("n_studies_ref"))
        eff = F.greatest(groups, g("median_unique_groups_per_study") * F.sqrt(F.greatest(F.lit(1.0), studies)))
        ref = bundle.select("gene_symbol", F.when(eff > 0, F.greatest(F.lit(1.0), F.bround(eff))).otherwise(0.0).alias("_ref"))
        s = s.join(ref, "gene_symbol", "left")
        burden = F.coalesce("_ref", burden)
    pen = F.when(burden > 0, F.sqrt(F.lit(float(k)) / F.greatest(F.lit(float(k)), burden))).otherwise(1.0)
    pen = F.lit(1.0) if mode == "none" else F.greatest(F.lit(floor), F.least(F.lit(1.0), pen))
    return s.withColumn("burden_penalty", pen).withColumn("score", F.col("score") * F.col("burden_penalty")).drop("_ref", "n_groups_input")


def locus_snapshot(scores: DataFrame, keys: Sequence[str] = (), top_n: int = 20) -> DataFrame:
    """Share of the top genes on one window, arm and chromosome, and the chromosome Herfindahl index."""
    t = top_k(scores, keys, top_n, [F.abs("score").desc(), F.col("gene_id").asc()], "_r")
    n = t.groupBy(*keys).agg(F.count("*").alias("n_top"))
    out = n
    for col, name in (("locus_key", "window"), ("chromosome_arm", "arm"), ("chrom", "chromosome")):
        c = t.filter(F.coalesce(F.col(col), F.lit("")) != "").groupBy(*keys, col).agg(F.count("*").alias("_c"))
        c = c.groupBy(*keys).agg(
            F.max("_c").alias(f"_{name}"), F.max_by(col, F.struct("_c", col)).alias(f"dominant_{name}"),
            F.sum(F.col("_c") * F.col("_c")).alias(f"_{name}_sq"),
        )
        out = attach(out, c, keys, "left") if keys else attach(out, c, [])
    frac = lambda x: F.coalesce(F.col(x), F.lit(0)) / F.greatest(F.col("n_top"), F.lit(1))
    out = out.select(
        *keys, "n_top", *[f"dominant_{x}" for x in ("window", "arm", "chromosome")],
        frac("_window").alias("window_fraction"), frac("_arm").alias("arm_fraction"), frac("_chromosome").alias("chromosome_fraction"),
        (F.coalesce("_chromosome_sq", F.lit(0)) / (F.greatest("n_top", F.lit(1)) * F.greatest("n_top", F.lit(1)))).alias("herfindahl"),
    )
    artifact = (F.col("n_top") >= 5) & (
        (F.col("window_fraction") >= 0.5) | (F.col("arm_fraction") >= 0.6) | (F.col("chromosome_fraction") >= 0.7)
    )
    return out.withColumn("likely_artifact", artifact)


def _seen_before(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """How many higher-ranked genes of the key share the column value; null or blank counts as none."""
    named = df.withColumn("_g", F.nullif(F.col(column), F.lit("")))
    order = [F.abs("score").desc(), F.col("gene_id").asc()]
    r = sliced.ranked(named.filter("_g is not null"), [*keys, "_g"], order, "_rk")
    some = r.withColumn(out, F.col("_rk") - 1).drop("_rk", "_g")
    return some.unionByName(named.filter("_g is null").drop("_g").withColumn(out, F.lit(0).cast("long")))


def diversity_penalty(scores: DataFrame, keys: Sequence[str] = (), mode: str = "window_diversity", top_n: int = 20) -> DataFrame:
    """Down-weight genes that follow stronger genes of the same window, arm or chromosome.

    window/chromosome modes: 1/sqrt(count + 1). auto: only for keys whose top
    genes look like an artifact, for each dimension over its trigger (chromosome
    uses 1/(1 + 0.3 count)), and the smallest factor wins.
    """
    if mode == "none":
        return scores.withColumn("diversity_penalty", F.lit(1.0))
    if mode in ("window_diversity", "chromosome_diversity"):
        col = "locus_key" if mode == "window_diversity" else "chrom"
        s = _seen_before(scores, keys, col, "_k")
        pen = 1.0 / F.sqrt(F.col("_k") + 1)
        return s.withColumn("diversity_penalty", pen).withColumn("score", F.col("score") * pen).drop("_k")
    if mode != "auto":
        raise ValueError(f"unknown diversity mode {mode!r}")
    snap = locus_snapshot(scores, keys, top_n)
    s = _seen_before(_seen_before(_seen_before(scores, keys, "locus_key", "_kw"), keys, "chromosome_arm", "_ka"), keys, "chrom", "_kc")
    flags = snap.select(
        *keys,
        (F.col("likely_artifact") & (F.col("window_fraction") >= 0.5)).alias("_fw"),
        (F.col("likely_artifact") & (F.col("arm_fraction") >= 0.6)).alias("_fa"),
        (F.col("likely_artifact") & (F.col("chromosome_fraction") >= 0.7)).alias("_fc"),
    )
    s = attach(s, flags, keys)
    one = F.lit(1.0)
    pen = F.least(
        F.when(F.col("_fw"), 1.0 / F.sqrt(F.col("_kw") + 1)).otherwise(one),
        F.when(F.col("_fa"), 1.0 / F.sqrt(F.col("_ka") + 1)).otherwise(one),
        F.when(F.col("_fc"), 1.0 / (1.0 + 0.3 * F.col("_kc"))).otherwise(one),
    )
    return s.withColumn("diversity_penalty", pen).withColumn("score", F.col("score") * pen).drop("_kw", "_ka", "_kc", "_fw", "_fa", "_fc")


def artifact_decision(snapshot: DataFrame, action: str = "warn") -> DataFrame:
    """What to do with each key whose penalised result still looks like an artifact."""
    return snapshot.withColumn("decision", F.when(F.col("likely_artifact"), F.lit(action)).otherwise("keep"))


# --- reference bundles ----------------------------------------------------------------------


def site_bundle(sites: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(aliases, ubiquity) from (source_path, source_dataset, input_key, canonical_site_key, gene_*) rows.

    A site counts once per source; its IDF is over sources.
    """
    ranked = F.struct("source_path", "row_ordinal")
    aliases = sites.groupBy("input_key").agg(
        F.min_by(F.struct("canonical_site_key", "gene_id", "gene_symbol", "ptm_type"), ranked).alias("_a")
    ).select("input_key", "_a.*")
    n = sites.agg(F.countDistinct("source_path").alias("n_sources"))
    u = sites.groupBy("canonical_site_key").agg(
        F.countDistinct("source_path").alias("df_ref"), F.countDistinct("source_dataset").alias("n_datasets_ref"),
        F.min_by(F.struct("gene_id", "gene_symbol"), ranked).alias("_g"),
    )
    u = attach(u, n, []).select(
        "canonical_site_key", "_g.*", "df_ref", "n_datasets_ref", "n_sources",
        (F.col("df_ref") / F.col("n_sources")).alias("fraction_ref"), site_idf("df_ref", "n_sources").alias("idf_ref"),
    )
    return aliases, u


def event_bundle_key(key, dataset, confidence) -> Column:
    """Low-confidence keys are private to their dataset."""
    return F.when(F.lower(_c(confidence)) == "low", F.concat_ws("::", F.lit("lowconf"), _c(dataset), _c(key))).otherwise(_c(key))


def event_aliases(events: DataFrame) -> DataFrame:
    """One mapping per (input key, confidence): high keeps its first, low and medium only if unique."""
    e = events.withColumn("_bk", event_bundle_key("canonical_event_key", "source_dataset", "canonicalization_confidence"))
    m = F.struct(F.col("_bk").alias("canonical_event_key"), F.coalesce("gene_symbol", F.lit("")).alias("gene_symbol"))
    g = e.groupBy(F.col("input_event_key").alias("input_key"), "canonicalization_confidence").agg(
        F.min_by(m, F.struct("source_dataset", "row_ordinal")).alias("_first"), F.min(m).alias("_lo"), F.max(m).alias("_hi")
    )
    ok = (F.col("canonicalization_confidence") == "high") | (F.col("_lo") == F.col("_hi"))
    return g.filter(ok).select("input_key", "canonicalization_confidence", "_first.*")


def event_ubiquity_by_dataset(events: DataFrame, min_reads: float = 10.0) -> DataFrame:
    """Distinct samples with PSI and enough reads per (event, dataset)."""
    e = events.withColumn("_bk", event_bundle_key("canonical_event_key", "source_dataset", "canonicalization_confidence"))
    seen = F.col("psi").isNotNull() & (F.col("read_support").isNull() | (F.col("read_support") >= min_reads))
    return e.groupBy(F.col("_bk").alias("canonical_event_key"), "source_dataset").agg(
        F.countDistinct(F.when(seen, F.col("sample_id"))).alias("df_ref"), F.countDistinct("sample_id").alias("n_samples_ref")
    )


def pool_event_ubiquity(by_dataset: DataFrame, n_datasets: DataFrame | None = None) -> DataFrame:
    """Pooled prior per event: total df, datasets, dominant share and IDF over datasets.

    ``n_datasets`` is a one-row table (column n_total); by default the datasets present.
    """
    n = n_datasets if n_datasets is not None else by_dataset.agg(F.countDistinct("source_dataset").alias("n_total"))
    p = by_dataset.groupBy("canonical_event_key").agg(
        F.sum("df_ref").alias("df_ref"), F.sum("n_samples_ref").alias("n_samples_ref"),
        F.countDistinct("source_dataset").alias("n_datasets_ref"), F.max("df_ref").alias("_m"),
    )
    share = F.when(F.col("df_ref") > 0, F.col("_m") / F.greatest(F.lit(1), F.col("df_ref"))).otherwise(0.0)
    return attach(p, n, []).select(
        "canonical_event_key", "df_ref", "n_samples_ref", "n_datasets_ref", share.alias("max_dataset_fraction_ref"),
        event_idf("n_datasets_ref", F.greatest(F.col("n_total"), F.lit(1))).alias("idf_ref"),
    )


def leave_dataset_out(pooled: DataFrame, by_dataset: DataFrame, dataset: str) -> DataFrame:
    """Pooled event prior without one dataset: recomputed where it took part, neutral where nothing is left."""
    touched = by_dataset.filter(F.col("source_dataset") == dataset).select("canonical_event_key").distinct()
    rest = by_dataset.filter(F.col("source_dataset") != dataset)
    n = rest.agg(F.greatest(F.countDistinct("source_dataset"), F.lit(1)).alias("n_total"))
    again = pool_event_ubiquity(rest.join(touched, "canonical_event_key", "left_semi"), n)
    cols = ["df_ref", "n_samples_ref", "n_datasets_ref", "max_dataset_fraction_ref", "idf_ref"]
    neutral = {"idf_ref": F.lit(1.0), "n_datasets_ref": F.lit(0), "max_dataset_fraction_ref": F.lit(0.0)}
    t = touched.join(again, "canonical_event_key", "left").select(
        "canonical_event_key", *[F.coalesce(F.col(c), neutral.get(c, F.lit(None))).alias(c) for c in cols]
    )
    kept = pooled.join(touched, "canonical_event_key", "left_anti").select("canonical_event_key", *cols)
    return kept.unionByName(t)


def gene_burden_by_dataset(events: DataFrame) -> DataFrame:
    """Distinct canonical events by confidence and event groups per (gene, dataset)."""
    e = events.filter(S.clean("gene_symbol").isNotNull()).withColumn(
        "_bk", event_bundle_key("canonical_event_key", "source_dataset", "canonicalization_confidence")
    )
    c = F.col("canonicalization_confidence")
    n = lambda cond: F.countDistinct(F.when(cond, F.col("_bk")))
    group = F.coalesce(S.clean("event_group"), F.col("_bk"))
    return e.groupBy("gene_symbol", "source_dataset").agg(
        F.countDistinct("_bk").alias("n_canonical_events_ref"), n(c == "high").alias("n_high_confidence_events_ref"),
        n(c == "medium").alias("n_medium_confidence_events_ref"), n(~c.isin("high", "medium")).alias("n_low_confidence_events_ref"),
        F.countDistinct(group).alias("n_unique_event_groups_ref"),
    )


def gene_burden(by_dataset: DataFrame, exclude: str | None = None) -> DataFrame:
    """Pooled burden per gene from per-dataset counts, optionally without one dataset.

    Median over studies: a gene has one row per dataset here.
    """
    d = by_dataset if exclude is None else by_dataset.filter(F.col("source_dataset") != exclude)
    g = d.groupBy("gene_symbol").agg(
        *[F.sum(c).alias(c) for c in d.columns if c.startswith("n_")],
        F.countDistinct("source_dataset").alias("n_studies_ref"),
        F.count_if(F.col("n_high_confidence_events_ref") > 0).alias("n_studies_high_confidence_ref"),
        F.median("n_unique_event_groups_ref").alias("median_unique_groups_per_study"),
        F.max("n_unique_event_groups_ref").alias("_m"),
    )
    g = g.withColumn("fraction_low_confidence_events_ref", F.col("n_low_confidence_events_ref") / F.greatest(F.lit(1), F.col("n_canonical_events_ref")))
    g = g.withColumn("max_dataset_fraction_ref", F.col("_m") / F.greatest(F.lit(1), F.col("n_unique_event_groups_ref"))).drop("_m")
    if exclude is None:
        return g
    gone = by_dataset.select("gene_symbol").distinct().join(g.select("gene_symbol"), "gene_symbol", "left_anti")
    zero = gone.select("gene_symbol", *[F.lit(0).cast(g.schema[c].dataType).alias(c) for c in g.columns if c != "gene_symbol"])
    return g.unionByName(zero)


def prior_profile(support: DataFrame, requested: str = "auto", public_mode: bool = False, has_bundle: bool = True) -> str:
    """full, nuisance_only or none, from one row of support counts."""
    if requested in ("full", "nuisance_only", "none"):
        return requested
    if not has_bundle:
        return "none"
    row = support.first()
    if row["n_events_nonself"] <= 0 and row["n_genes_burden"] <= 0:
        return "none"
    if public_mode and row["medium_low_fraction"] >= 0.5 and row["n_events_strong"] <= 0:
        return "nuisance_only"
    return "full"


def medium_prior_allowed(by_dataset: DataFrame, dataset: str | None, min_datasets: int = 2, max_share: float = 0.8) -> DataFrame:
    """Events whose prior has enough other datasets and no dominant one."""
    d = by_dataset if dataset is None else by_dataset.filter(F.col("source_dataset") != dataset)
    g = d.groupBy("canonical_event_key").agg(
        F.countDistinct("source_dataset").alias("n"), F.max("df_ref").alias("m"), F.sum("df_ref").alias("s")
    )
    share = F.when(F.col("s") > 0, F.col("m") / F.greatest(F.lit(1), F.col("s"))).otherwise(0.0)
    return g.filter((F.col("n") >= min_datasets) & (share <= max_share)).select("canonical_event_key")
