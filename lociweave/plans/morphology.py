"""Image-profile queries against a perturbation reference, and the reference builder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators import expansion as X
from lociweave.operators import selection as SEL
from lociweave.operators import similarity as SIM
from lociweave.operators import statistics as ST
from lociweave.operators.joins import attach
from lociweave.session import materialize


def modality(x) -> Column:
    """Normalised perturbation type."""
    t = F.lower(F.trim(F.col(x) if isinstance(x, str) else x))
    # Spellings of perturbation types.
    return F.when(t.isin("compound", "cmpd", "small_molecule"), "compound").when(t.isin("orf", "overexpression"), "orf").when(
        t.isin("crispr", "crispra", "crispri", "knockout"), "crispr").otherwise(t)


def reference_genes(metadata: DataFrame, compound_targets: DataFrame) -> DataFrame:
    """(ref_id, gene_id, weight): compounds through their targets, genetic perturbations through their own gene.

    Weights of a reference that sum above 1 are divided by the sum.
    """
    c = metadata.filter("modality = 'compound'").join(compound_targets, "compound_id").select(F.col("id").alias("ref_id"), "gene_id", "weight")
    g = metadata.filter("modality <> 'compound' and gene_symbol is not null").select(F.col("id").alias("ref_id"), F.col("gene_symbol").alias("gene_id"), F.lit(1.0).alias("weight"))
    both = c.unionByName(g).groupBy("ref_id", "gene_id").agg(F.sum("weight").alias("weight"))
    t = both.groupBy("ref_id").agg(F.sum("weight").alias("_t"))
    return attach(both, t, ["ref_id"]).withColumn("weight", F.col("weight") / F.greatest(F.lit(1.0), F.col("_t"))).drop("_t")


#: Short names of the label levels that expansion uses, besides its own.
LEVEL_NAMES = dict(zip(("pathway", "class", "mechanism", "family"), X.LEVELS))


def expansion(
    rated: DataFrame, kept: DataFrame, support: DataFrame, base: DataFrame, genes: DataFrame, gene_labels: DataFrame, own_genes: DataFrame,
    mode: str = "hybrid", max_neighbours: int = 20, min_effective: int = 5, bundle_genes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Label decision of every query, and its scores after expansion.

    ``rated`` are neighbours with similarity, qc, evidence, modality,
    query_modality and protected; ``kept`` those after the cut, ``support`` the
    genes that they back, ``base`` the scores to expand. Compound queries vote
    with boosted evidence, others with that of their most evident neighbours.
    """
    name = F.col("level")
    for short, level in LEVEL_NAMES.items():
        name = F.when(F.col("level") == short, level).otherwise(name)
    labels = gene_labels.select("gene_id", name.alias("level"), "label").filter(F.col("level").isin(*X.LEVELS) & (F.col("label") != ""))
    pool = max(8 * max_neighbours, min_effective, 50)
    ranked = materialize(SEL.top_k(rated, ["query_id"], max(pool, 80), [F.col("similarity").desc(), F.col("ref_id").asc()], "raw_rank"))
    leading = materialize(SEL.top_k(ranked, ["query_id"], pool, [F.col("protected").desc(), F.col("evidence").desc(), F.col("similarity").desc(), F.col("ref_id").asc()], "_r").drop("_r"))
    by = ["query_id", "ref_id", "similarity", "evidence", "modality", "query_modality"]
    compound = X.vote_neighbours(ranked, genes, labels, own_genes, leading.select("query_id", "ref_id"), ranked.filter("protected").select("query_id", "ref_id"), max_neighbours, min_effective)
    voted = materialize(compound.select(*by).unionByName(leading.filter("query_modality is null or query_modality <> 'compound'").select(*by)))
    raw = ranked.join(voted.select("query_id", "ref_id"), ["query_id", "ref_id"], "left_semi").withColumn("evidence", F.col("similarity") * F.col("qc"))
    exact = support.filter("score > 0").join(own_genes, ["query_id", "gene_id"], "left_semi").select("query_id")
    asked = rated.groupBy("query_id").agg(F.max("query_modality").alias("query_modality"))
    decision = materialize(X.expansion_decision(asked, raw.select(*by), voted, kept.select(*by), X.reference_labels(genes, labels), X.own_labels(own_genes, labels), exact, mode))
    return decision, X.expand_by_label(base, decision, kept, genes, labels, own_genes, bundle_genes)


def align(queries: DataFrame, references: DataFrame, stats: DataFrame | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both long tables on their shared features, standardised when feature statistics are given.

    The feature list is the width of a profile; only names are read.
    """
    shared = SIM.shared_features(queries, references)
    names = [r[0] for r in shared.orderBy("feature").collect()]
    q, r = queries.join(shared, "feature", "left_semi"), references.join(shared, "feature", "left_semi")
    if stats is not None:
        q, r = ST.standardize(q, stats), ST.standardize(r, stats)
    return q, r, names


def morphology_profile_query(
    queries: DataFrame, references: DataFrame, metadata: DataFrame, compound_targets: DataFrame, query_members: DataFrame | None = None,
    stats: DataFrame | None = None, controls: str = "mean_center", metric: str = "cosine", polarity: str = "similar", mode: str = "direct_target",
    gene_labels: DataFrame | None = None, max_neighbours: int = 20, min_similarity: float = 0.0, power: float = 1.0, hub_mode: str = "inverse_rank",
    cross_penalty: float = 0.35, min_effective: int = 5, drop_ratio: float = 0.25, mutual: bool = False, select: dict | None = None,
    own_genes: DataFrame | None = None, bundle_genes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Query profiles to genes by direct targets, mechanism or their merge.

    With ``gene_labels`` (gene_id, level, label), mechanism and hybrid scores are
    expanded by the label that each query's neighbours agree on; ``own_genes``
    (query_id, gene_id) are genes that queries name themselves. The result then
    has ``decision`` and the preferred ``variant`` of every query as well.

    ``queries`` (id, feature, value), ``references`` likewise; ``metadata`` has
    id, modality, gene_symbol, compound_id, is_control, qc_weight, hub_score.
    Controls calibrate both sides and leave the reference, and so do query ids.
    """
    expanding = gene_labels is not None and mode in ("mechanism", "hybrid")
    own_genes = queries.sparkSession.createDataFrame([], "query_id string, gene_id string") if own_genes is None else own_genes
    metadata = metadata.withColumn("modality", modality("modality"))
    q, r, names = align(queries, references, stats)
    ctrl = metadata.filter("is_control").select("id")
    if controls == "mean_center":
        base = r.join(ctrl, "id", "left_semi")
        q, r = SIM.mean_centre(q, base), SIM.mean_centre(r, base)
    # Controls in the units of the vectors that they calibrate.
    cv = SIM.to_vectors(r.join(ctrl, "id", "left_semi"), names)
    r = r.join(ctrl, "id", "left_anti").join(q.select("id").distinct(), "id", "left_anti")
    qv, rv = SIM.to_vectors(q, names), SIM.to_vectors(r, names)
    if controls == "remove_axes":
        qv, rv = SIM.remove_nuisance_axes(qv, cv), SIM.remove_nuisance_axes(rv, cv)
    factors = materialize(SIM.reference_factors(metadata.join(ctrl, "id", "left_anti"), hub_mode))
    kinds = metadata.select(F.col("id").alias("ref_id"), "modality")
    rated = rv.join(factors.join(kinds, "ref_id").select(F.col("ref_id").alias("id"), (F.col("qc") * F.col("hub_factor")).alias("factor"), "modality"), "id")
    # Cross-modality and mutual damping can only lower evidence, and by no more than this.
    least = min(cross_penalty, 1.0) * (0.5 if mutual else 1.0)
    found = materialize(SIM.candidates_by_evidence(
        qv, rated, max_neighbours, power, least, min_similarity, polarity, metric == "pearson", leading=max(8 * max_neighbours, 80) if expanding else max(max_neighbours, 5), near_best=0.9, counts=True))
    counts = found.filter("ref_id is null")
    cand = SIM.polarity_candidates(found.filter("ref_id is not null").select("query_id", "ref_id", "similarity"), polarity, min_similarity)
    if polarity == "opposite":
        cand = cand.withColumn("similarity", F.col("strength"))
        counts = counts.withColumnsRenamed({"n_positive": "n_negative", "n_negative": "n_positive"})
    e = SIM.neighbour_evidence(cand, metadata, power, hub_mode, factors)
    e = e.join(kinds, "ref_id")
    if query_members is not None:
        e = e.join(SIM.query_modality(query_members), "query_id", "left")
    else:
        e = e.withColumn("query_modality", F.lit(None).cast("string"))
    genes = materialize(reference_genes(metadata, compound_targets))
    known = e.filter("query_modality is not null")
    recovered = SIM.modality_penalty(known, cross_penalty, SIM.shared_label_recovery(known, genes, gene_labels))
    e = recovered.unionByName(e.filter("query_modality is null"))
    if mutual:
        e = SIM.mutual_filter(e, rv).drop("mutual_similarity")
    flagged = SIM.protect_same_modality(e, own_genes=own_genes, ref_genes=genes)
    kept = materialize(SIM.neighbour_cut(SIM.keep_protected(flagged, max_neighbours), max_neighbours, min_effective, drop_ratio))
    support = materialize(SIM.nominate_core(SIM.target_support(kept, genes)))
    core = support.filter("core").select("query_id", "gene_id", "score")
    total = core.groupBy("query_id").agg(F.sum("score").alias("_t"))
    core = attach(core, total, ["query_id"]).filter("_t > 0").select("query_id", "gene_id", (F.col("score") / F.col("_t")).alias("score"))
    mech = SIM.mechanism_scores(kept, genes, idf=SIM.gene_recurrence(genes))
    extra = {}
    if expanding:
        extra["decision"], grown = expansion(flagged, kept, support, mech, genes, gene_labels, own_genes, mode, max_neighbours, min_effective, bundle_genes)
        mech = materialize(grown)
        sized = lambda d: SEL.select_and_weight(d.select("query_id", "gene_id", "score"), ["query_id"], **(select or {}))
        extra["variant"] = X.preferred_variant(sized(core), sized(mech), extra["decision"], mode)
        mech = mech.select("query_id", "gene_id", "score")
    scores = {"direct_target": core, "mechanism": mech, "hybrid": SIM.hybrid_merge(core, mech)}[mode]
    picked = SEL.select_and_weight(scores, ["query_id"], **(select or {}))
    out = {"genes": picked, "neighbours": kept, "support": support, **extra}
    if gene_labels is not None:
        lab = genes.join(gene_labels, "gene_id").select("ref_id", "level", "label", "weight")
        out["votes"] = SIM.label_vote(kept, lab)
    out["confidence"] = SIM.confidence_tiers(kept, picked, counts, metadata.select("id", "hub_score"), scores, genes)
    return out


def preferred_variant(direct: DataFrame, hybrid: DataFrame, votes: DataFrame, min_confidence: float = 0.22, top_mass: float = 0.5) -> DataFrame:
    """Per query: hybrid when the label vote is confident and adds genes, else direct when one target dominates, else hybrid."""
    n = lambda d, c: d.groupBy("query_id").agg(F.count("*").alias(c))
    top = votes.groupBy("query_id").agg(F.max("share").alias("_v"))
    lead = direct.groupBy("query_id").agg(F.max("score").alias("_m"))
    j = n(direct, "_d").join(n(hybrid, "_h"), "query_id", "full_outer").join(top, "query_id", "left").join(lead, "query_id", "left")
    more = F.coalesce("_h", F.lit(0)) > F.coalesce("_d", F.lit(0))
    pick = F.when((F.coalesce("_v", F.lit(0.0)) >= min_confidence) & more, "hybrid").when(F.coalesce("_m", F.lit(0.0)) >= top_mass, "direct_target").otherwise("hybrid")
    return j.select("query_id", pick.alias("variant"))


def pick_context(metadata: DataFrame) -> DataFrame:
    """The (cell line, timepoint) covering most modalities, then most profiles, then in name order: one row."""
    g = metadata.filter("not is_control").groupBy("cell_line", "timepoint").agg(F.countDistinct("modality").alias("_m"), F.count("*").alias("_n"))
    return g.orderBy(F.desc("_m"), F.desc("_n"), "cell_line", "timepoint").limit(1).select("cell_line", "timepoint")


def reference_bundle(profiles: DataFrame, metadata: DataFrame, how: str = "median", k: int = 50, any_context: bool = False) -> dict[str, DataFrame]:
    """Consensus profile, replicate counts, QC weight, hub score and feature statistics per perturbation."""
    m = metadata if any_context else metadata.join(F.broadcast(pick_context(metadata)), ["cell_line", "timepoint"], "left_semi")
    rows = profiles.join(m.select(F.col("sample_id").alias("id"), "perturbation_id"), "id").select("perturbation_id", "feature", "value")
    cons = SIM.consensus(rows, ["perturbation_id"], how).withColumnRenamed("perturbation_id", "id")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ";").alias(c)
    reps = m.groupBy(F.col("perturbation_id").alias("id")).agg(
        F.countDistinct("sample_id").alias("replicate_count"), F.max("is_control").alias("is_control"),
        *[joined(c) for c in ("modality", "gene_symbol", "compound_id") if c in m.columns],
    )
    reps = reps.withColumn("qc_weight", F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.col("replicate_count") / 3.0)))
    stats = ST.center_scale(cons)
    names = [r[0] for r in stats.select("feature").orderBy("feature").collect()]
    hub = SIM.hub_scores(SIM.to_vectors(ST.standardize(cons, stats), names), k)
    return {"profiles": cons, "metadata": reps.join(hub, "id", "left"), "feature_stats": stats}


def query_profiles(profiles: DataFrame, groups: DataFrame | None = None, how: str = "median") -> DataFrame:
    """Replicates of a query group to one profile."""
    if groups is None:
        return profiles
    j = profiles.join(groups.select(F.col("sample_id").alias("id"), "query_group"), "id")
    return SIM.consensus(j.select("query_group", "feature", "value"), ["query_group"], how).withColumnRenamed("query_group", "id")

