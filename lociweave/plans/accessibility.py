"""Peak-based assays: bulk and matrix accessibility, single-cell accessibility, ChIP peaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.functions.idf import peak_idf
from lociweave.operators import contrasts as C
from lociweave.operators import intervals as I
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST
from lociweave.operators.joins import attach
from lociweave.operators.scoring import combine_ratio, log_ratio
from lociweave.session import materialize

# Programs of each preset, and the link each program prefers there.
PRESETS = {
    "none": ["linked_activity"],
    "connectable": ["linked_activity", "distal_activity"],
    "qc": ["promoter_activity"],
    "experimental": ["linked_activity", "distal_activity", "enhancer_bias"],
    "all": ["linked_activity", "promoter_activity", "distal_activity", "enhancer_bias"],
}
PREFERRED_LINK = {
    "connectable": {"linked_activity": "nearest_tss", "distal_activity": "distance_decay"},
    "qc": {"promoter_activity": "promoter_overlap", "linked_activity": "promoter_overlap"},
}
PRESET_LINKS = {
    "connectable": ["nearest_tss", "distance_decay"],
    "qc": ["promoter_overlap"],
    "experimental": ["nearest_tss", "distance_decay"],
}
ALL_LINKS = ["promoter_overlap", "nearest_tss", "distance_decay"]


def program_grid(preset: str = "connectable", programs: Sequence[str] | None = None, links: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """(program, link) pairs to score for a preset or an explicit choice."""
    preset = "connectable" if preset in ("", "default") else preset
    chosen = list(programs or PRESETS[preset])
    methods = list(links or PRESET_LINKS.get(preset, ALL_LINKS))
    prefer = PREFERRED_LINK.get(preset, {})
    if preset in PREFERRED_LINK:
        return [(p, prefer[p]) for p in chosen if prefer.get(p) in methods]
    return [(p, m) for p in chosen for m in methods]


def link_values(
    long: DataFrame, spans: DataFrame, genes: DataFrame, need: Sequence[tuple[str, str]],
    external: DataFrame | None = None, upstream: int = 2000, downstream: int = 500, nearest_max: int = 100_000, decay_max: int = 500_000,
    decay_length: float = 50_000.0, max_genes: int = 5,
) -> DataFrame:
    """Rows of ``long`` with link_method, gene_id and link_weight, for the (program, link) pairs in ``need``.

    ``spans`` are the distinct spans of the rows. Values meet the links of a
    centre at the centre: links are never repeated for each span.
    """
    centred = spans.select("chrom", F.floor((F.col("start") + F.col("end")) / 2).cast("long").alias("centre"))
    out = None
    for m in sorted({m for _, m in need}):
        rows, on = long.filter(F.col("program").isin(sorted({p for p, of in need if of == m}))), ["chrom", "centre"]
        if m == "promoter_overlap":
            links, on = I.promoter_links(spans, genes, upstream, downstream), ["chrom", "start", "end"]
        elif m == "nearest_tss":
            links = I.nearest_links(centred, genes, nearest_max)
        elif m == "distance_decay":
            links = I.decay_links(centred, genes, decay_max, decay_length, max_genes)
        elif m == "external":
            links, on = I.external_links(spans, external), ["chrom", "start", "end"]
        else:
            raise ValueError(f"unknown link method {m!r}")
        rows = rows.withColumn("centre", F.floor((F.col("start") + F.col("end")) / 2).cast("long"))
        got = rows.join(links.select(*on, "gene_id", "link_weight"), on).select(*long.columns, F.lit(m).alias("link_method"), "gene_id", "link_weight")
        out = got if out is None else out.unionByName(got)
    return out


#: Spans longer than so many times the links' reach would widen every stretch; they are linked through a grid of size classes.
LONG_SPAN = 16


def span_limit(features: DataFrame, need: Sequence[tuple[str, str]], upstream: int, downstream: int, nearest_max: int | None = 100_000, decay_max: int = 500_000, **_) -> int | None:
    """Length of the longest span where features and genes can meet in stretches, else None."""
    methods = {m for _, m in need}
    if not methods <= set(ALL_LINKS) or ("nearest_tss" in methods and nearest_max is None):
        return None
    longest = features.agg(F.max(F.abs(F.col("end") - F.col("start")))).first()[0]
    reach = max(upstream, downstream, nearest_max if "nearest_tss" in methods else 0, decay_max if "distance_decay" in methods else 0, 1)
    return int(longest or 0) if (longest or 0) <= LONG_SPAN * reach else None


def stretch_pairs(features: DataFrame, payload, genes: DataFrame, need: Sequence[tuple[str, str]], longest: int, upstream: int, downstream: int,
                  nearest_max: int = 100_000, decay_max: int = 500_000, decay_length: float = 50_000.0, max_genes: int = 5) -> tuple[DataFrame, dict]:
    """Linked pairs, and per link method the pair's weight there (null without a link)."""
    methods = {m for _, m in need}
    pairs = I.stretch_links(features, payload, genes, longest, upstream, downstream, nearest_max if "nearest_tss" in methods else None,
                            decay_max if "distance_decay" in methods else None, decay_length, max_genes)
    return pairs, {m: F.when(F.col(m), F.col("decay_weight") if m == "distance_decay" else F.lit(1.0)) for m in ALL_LINKS}


def _stretch_scores(features: DataFrame, payload, genes: DataFrame, value: dict, plain, bias_links, need, longest: int, **settings) -> DataFrame:
    """``program_scores`` without keys and reference: every score of a gene from one pass over its pairs."""
    pairs, weight = stretch_pairs(features, payload, genes, need, longest, **settings)
    name = lambda p, m: f"{p}/{m}"
    sums = pairs.groupBy("gene_id").agg(*[F.sum(value[p] * weight[m]).alias(name(p, m)) for p, m in need])
    rows = [(F.col(name(p, m)), F.col(name(p, m)) != 0, p, m) for p, m in plain]
    for m in bias_links:
        distal, promoter = (F.coalesce(name(p, m), F.lit(0.0)) for p in ("distal_activity", "promoter_activity"))
        rows.append((log_ratio(distal, promoter), (distal != 0) | (promoter != 0), "enhancer_bias", m))
    items = F.array(*[F.struct(F.lit("none").alias("calibration"), F.lit(p).alias("program"), F.lit(m).alias("link_method"), score.alias("score"), there.alias("there"))
                      for score, there, p, m in rows])
    return sums.select("gene_id", F.explode(items).alias("i")).filter("i.there").select("i.calibration", "i.program", "i.link_method", "gene_id", "i.score")


def program_scores(
    features: DataFrame, genes: DataFrame, keys: Sequence[str] = (), grid: Sequence[tuple[str, str]] | None = None, transform: str = "positive",
    reference: DataFrame | None = None, distal_weight: str | None = None, upstream: int = 2000, downstream: int = 500, **link_settings,
) -> DataFrame:
    """Gene scores of every (keys, calibration, program, link) in one job.

    Feature values are transformed, masked per program and summed per span
    before the links are joined; without keys and reference, features and genes
    meet in stretches of positions, each shuffled once. With a reference, values times the reference
    IDF form a second calibration. ``distal_weight`` names a feature column used
    instead of the weight by the tf-idf distal program.
    """
    keys = list(keys)
    grid = list(grid or program_grid())
    plain = [(p, m) for p, m in grid if p != "enhancer_bias"]
    bias_links = [m for p, m in grid if p == "enhancer_bias"]
    need = set(plain) | {(p, m) for m in bias_links for p in ("promoter_activity", "distal_activity")}
    x = S.transform_score("weight", transform)
    agg = [F.sum(x).alias("w")]
    if distal_weight:
        agg.append(F.sum(S.transform_score(distal_weight, transform)).alias("wd"))
    # One column per program: masked features contribute zero.
    value = {
        "linked_activity": F.col("w"),
        "promoter_activity": F.when(F.col("in_promoter"), F.col("w")).otherwise(0.0),
        "distal_activity": F.when(F.col("in_promoter"), 0.0).otherwise(F.col("w")),
    }
    if distal_weight:
        value["tfidf_distal"] = F.when(F.col("in_promoter"), 0.0).otherwise(F.col("wd"))
    longest = span_limit(features, sorted(need), upstream, downstream, **link_settings) if not keys and reference is None else None
    if longest is not None:
        return _stretch_scores(features, agg, genes, value, plain, bias_links, sorted(need), longest, upstream=upstream, downstream=downstream, **link_settings)
    genes = materialize(genes.select("chrom", "tss", "strand", "gene_id", "gene_ordinal"))
    prom = I.promoters(genes, upstream, downstream).select("chrom", F.col("r_start").alias("start"), F.col("r_end").alias("end"))
    # The features are read once; masks, priors and links all start from the written spans.
    collapsed = materialize(features.groupBy(*keys, "chrom", "start", "end").agg(*agg))
    spans = collapsed.select("chrom", "start", "end")
    if keys:
        spans = materialize(spans.distinct())
    flagged = I.overlap_flag(spans, prom, "in_promoter", distinct=True)
    if reference is not None:
        flagged = I.overlap_max(flagged, reference, "idf_ref", "idf")
    # Written, as each link method reads it.
    by_span = materialize(collapsed.join(flagged, ["chrom", "start", "end"]))
    names = sorted({p for p, _ in need})
    calibrations = [F.struct(F.lit("none").alias("calibration"), F.lit(1.0).alias("f"))]
    if reference is not None:
        calibrations.append(F.struct(F.lit("ref_ubiquity").alias("calibration"), F.col("idf").alias("f")))
    items = F.array(*[F.struct(F.lit(p).alias("program"), value[p].alias("v")) for p in names])
    long = by_span.select(*keys, "chrom", "start", "end", F.explode(items).alias("i"), F.array(*calibrations).alias("c")).filter("i.v <> 0")
    long = long.select(*keys, "chrom", "start", "end", "i.program", "i.v", F.explode("c").alias("c")).select("*", "c.*").drop("c")
    g = [*keys, "calibration", "program", "link_method"]
    scores = link_values(long, spans, genes, sorted(need), upstream=upstream, downstream=downstream, **link_settings).groupBy(*g, "gene_id").agg(
        F.sum(F.col("v") * F.col("f") * F.col("link_weight")).alias("score")
    ).filter("score <> 0")
    if not bias_links:
        return scores
    scores = materialize(scores)
    side = lambda p: scores.filter((F.col("program") == p) & F.col("link_method").isin(*bias_links)).drop("program")
    bias = combine_ratio(side("distal_activity"), side("promoter_activity"), [*keys, "calibration", "link_method"])
    keep = F.lit(False)
    for p, m in plain:
        keep = keep | ((F.col("program") == p) & (F.col("link_method") == m))
    return scores.filter(keep).unionByName(bias.withColumn("program", F.lit("enhancer_bias")))


GRID_KEYS = ["calibration", "program", "link_method"]


def atac_bulk(peaks: DataFrame, genes: DataFrame, keys: Sequence[str] = (), select: dict | None = None, atlas: DataFrame | None = None, **kw) -> DataFrame:
    """Peaks with weights to selected, ranked and weighted genes per program grid cell."""
    scores = program_scores(peaks, genes, keys, **kw)
    by = [*keys, *GRID_KEYS]
    if atlas is not None:
        base = scores.filter("calibration = 'none' and program = 'linked_activity'")
        res = ST.baseline_residual(base.drop("program"), atlas, [*keys, "calibration", "link_method"])
        scores = scores.unionByName(res.withColumn("program", F.lit("atlas_residual")))
    return SEL.select_and_weight(scores, by, **{"order": SEL.tied_order(), **(select or {})})


def atac_bulk_matrix(values: DataFrame, peaks: DataFrame, samples: DataFrame, contrasts: DataFrame, genes: DataFrame, stat: str = "log2fc",
                     pseudocount: float = 1.0, **kw) -> DataFrame:
    """Peak x sample matrix: arm means per contrast, OPEN and CLOSE directions, then the bulk plan."""
    m = C.arm_moments(values.withColumnRenamed("peak_id", "feature_id"), samples, contrasts)
    wide = m.groupBy("contrast_id", "feature_id").agg(
        F.max(F.when(F.col("arm") == "a", F.col("mean"))).alias("_a"), F.max(F.when(F.col("arm") == "b", F.col("mean"))).alias("_b")
    )
    c = wide.select("contrast_id", "feature_id", C.contrast_value(F.coalesce("_a", F.lit(0.0)), F.coalesce("_b", F.lit(0.0)), stat, pseudocount).alias("weight"))
    d = C.open_close(c, "weight").join(peaks.select(F.col("peak_id").alias("feature_id"), "chrom", "start", "end"), "feature_id")
    return atac_bulk(d, genes, ["contrast_id", "direction"], **kw)


def atac_sc_10x(entries: DataFrame, cells: DataFrame, features: DataFrame, genes: DataFrame, contrast: str = "group_vs_rest", mode: str = "mean",
                conditions: tuple[str, str] | None = None, donor: str | None = None, tfidf: bool = False, **kw) -> DataFrame:
    """Single-cell peaks: group summary, group vs rest, or condition within group, then the bulk plan per group."""
    pc = C.default_pseudocount(mode)
    if contrast == "none":
        x = C.group_summary(entries, cells, mode).withColumnRenamed("score", "weight")
    elif contrast == "group_vs_rest":
        x = C.group_vs_rest(entries, cells, mode).withColumn("weight", S.log2_ratio("group_score", "rest_score", pc))
    elif contrast == "condition_within_group":
        a, b = conditions
        x = C.condition_within_group(entries, cells, a, b, mode, donor=donor).withColumn("weight", S.log2_ratio("score_a", "score_b", pc))
    else:
        raise ValueError(f"unknown contrast {contrast!r}")
    keys = ["group"]
    if contrast == "condition_within_group":
        x = C.open_close(x, "weight")
        keys.append("direction")
    if tfidf:
        n = cells.agg(F.countDistinct("cell_id").alias("_n"))
        df = entries.filter("value <> 0").groupBy("feature_id").agg(F.count("*").alias("_df"))
        idf = attach(df, n, []).select("feature_id", peak_idf("_df", "_n").alias("_i"))
        x = x.join(idf, "feature_id", "left").withColumn("distal", F.col("weight") * F.coalesce("_i", F.lit(1.0)))
        kw.setdefault("grid", [*program_grid(), ("tfidf_distal", "distance_decay")])
        kw["distal_weight"] = "distal"
    cols = [*keys, "feature_id", "weight", *(["distal"] if tfidf else [])]
    return atac_bulk(x.select(*cols).join(features, "feature_id"), genes, keys, **kw)


def chipseq_peak(peaks: DataFrame, genes: DataFrame, link: str = "promoter_overlap", normalize: str = "within_set_l1", **kw) -> DataFrame:
    """Peak weights summed over one link method, ranked and weighted."""
    return atac_bulk(peaks, genes, grid=[("linked_activity", link)], select={"normalize": normalize, "how": "none"}, **kw)
