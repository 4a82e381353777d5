"""Metabolic traces to phenotype terms, reference neighbours and gene programs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.operators import identifiers as ID
from lociweave.operators import selection as SEL
from lociweave.operators import similarity as SIM
from lociweave.operators import statistics as ST
from lociweave.operators import timeseries as TS
from lociweave.operators.joins import attach
from lociweave.session import materialize

# Variables that depend on body mass, and the variables of each program.
MASS_DEPENDENT = ("vo2", "vco2", "ee", "feed", "drink", "feed.acc", "drink.acc")
PROGRAMS = {
    "global": ("vo2", "vco2", "ee", "feed", "drink", "feed.acc", "drink.acc", "rer", "body.temp", "xytot", "xyamb", "wheel", "pedmeter"),
    "thermogenesis": ("vo2", "vco2", "ee", "body.temp"),
    "substrate_use": ("rer", "vo2", "vco2"),
    "intake_balance": ("feed", "feed.acc", "drink", "drink.acc"),
    "activity_circadian": ("xytot", "xyamb", "wheel", "pedmeter", "body.temp"),
}
MASS_ORDER = ("lean_mass", "total_mass", "fat_mass")


def subject_table(trace: DataFrame, session: DataFrame | None = None, manual: DataFrame | None = None, start: float | None = None, end: float | None = None,
                  lights_on: float = 7.0, hours_light: float = 12.0) -> DataFrame:
    """Windowed, exclusion-filtered trace to (subject_id, variable, feature, value)."""
    t = TS.drop_excluded(TS.analysis_window(trace, start, end), session if session is not None and "exc_hour" in session.columns else None, manual)
    feats = TS.subject_features(t, lights_on=lights_on, hours_light=hours_light)
    auc = TS.trapezoid_auc(t.filter(F.col("variable").isin(*TS.INTAKE_VARIABLES)), ["subject_id", "variable"])
    return materialize(TS.feature_rows(feats, auc))


def group_signatures(features: DataFrame, session: DataFrame, min_group: int = 2, covariate: str | None = None) -> DataFrame:
    """(contrast_id, variable, feature, value): every group against the rest.

    Mass-dependent features with the covariate known for all their subjects are
    covariate-adjusted; the others use the standardised difference.
    """
    masses = [c for c in MASS_ORDER if c in session.columns]
    cov = covariate or (TS.choose_covariate(session, masses) if masses else None)
    cols = ["subject_id", "group", *([F.col(cov).alias("mass")] if cov else [F.lit(None).cast("double").alias("mass")])]
    x = features.join(session.select(*cols), "subject_id").withColumn("group", F.coalesce("group", F.lit("all")))
    full = x.groupBy("feature").agg((F.count("mass") == F.count("*")).alias("_full"))
    x = attach(x, full, ["feature"])
    adjusted = x.filter(F.col("variable").isin(*MASS_DEPENDENT) & F.col("_full"))
    a = ST.group_covariate_effect(adjusted, ["variable", "feature"], "group", "value", "mass", min_group)
    plain = x.filter(~(F.col("variable").isin(*MASS_DEPENDENT) & F.col("_full")))
    # A constant covariate has no spread, which is the standardised difference.
    b = ST.group_covariate_effect(plain.withColumn("_zero", F.lit(0.0)), ["variable", "feature"], "group", "value", "_zero", min_group)
    cols = [F.col("group").alias("contrast_id"), "variable", "feature", F.col("effect").alias("value"), "model"]
    return a.select(*cols).unionByName(b.select(*cols))


def program_features(signatures: DataFrame) -> DataFrame:
    """Repeat feature rows for every program their variable belongs to."""
    which = F.array_compact(F.array(*[F.when(F.col("variable").isin(*v), F.lit(p)) for p, v in PROGRAMS.items()]))
    return signatures.withColumn("program", F.explode(which))


def calr_ontology_mapper(signatures: DataFrame, templates: DataFrame, gene_edges: DataFrame, neighbours: DataFrame | None = None, orthologs: DataFrame | None = None,
                         policy: str = "unique_only", select: dict | None = None) -> DataFrame:
    """Signatures to terms to genes per (contrast, program).

    ``templates`` has (term_id, program, feature, weight); a template serves its
    own program, 'global' templates serve all.
    """
    keys = ["contrast_id", "program"]
    f = program_features(signatures).select(*keys, "feature", "value")
    t = templates.withColumn("program", F.coalesce("program", F.lit("global")))
    den = t.groupBy("term_id").agg(F.sum(F.abs("weight")).alias("_d"))
    j = f.join(t.select("term_id", "feature", "weight", F.col("program").alias("_p")), "feature").filter((F.col("_p") == "global") | (F.col("_p") == F.col("program")))
    terms = attach(j.groupBy(*keys, "term_id").agg(F.sum(F.col("weight") * F.col("value")).alias("_n")), den, ["term_id"]).filter("_d > 0").select(
        *keys, "term_id", F.greatest(F.lit(0.0), F.col("_n") / F.col("_d")).alias("score")
    )
    genes = SIM.route_terms(terms, gene_edges, neighbours, keys)
    return _finish(genes, gene_edges, orthologs, policy, keys, select)


def _finish(genes, names, orthologs, policy, keys, select):
    if orthologs is not None:
        sym = names.select("gene_id", F.coalesce("gene_symbol", "gene_id").alias("gene_symbol")).dropDuplicates(["gene_id"]) if "gene_symbol" in names.columns else names.select("gene_id").distinct().withColumn("gene_symbol", F.col("gene_id"))
        genes = ID.ortholog_scores(genes.join(sym, "gene_id", "left"), orthologs, keys, policy)
    return SEL.select_and_weight(genes.filter("score > 0"), keys, **(select or {}))


def calr_profile_query(signatures: DataFrame, references: DataFrame, metadata: DataFrame, stats: DataFrame | None = None, contexts: DataFrame | None = None, pearson: bool = False,
                       power: float = 1.0, hub_mode: str = "inverse_linear", mismatch_penalty: float = 0.15, k: int = 25, orthologs: DataFrame | None = None,
                       policy: str = "unique_only", select: dict | None = None) -> dict[str, DataFrame]:
    """Signatures against reference profiles: context-penalised neighbours, then their genes.

    ``references`` (id, feature, value); ``metadata`` has id, gene_id, qc_weight,
    hub_score and context columns; ``contexts`` the same context per contrast.
    """
    from lociweave.plans.morphology import align

    q = signatures.select(F.col("contrast_id").alias("id"), "feature", "value")
    q, r, names = align(q, references, stats)
    pairs = SIM.similar(SIM.to_vectors(q, names), SIM.to_vectors(r, names), min_similarity=1e-12, pearson=pearson)
    if contexts is not None:
        text = [c for c in ("mass_covariate", "acclimation_state") if c in contexts.columns and c in metadata.columns]
        right = metadata.select(F.col("id").alias("ref_id"), *[F.col(c).alias(f"_r_{c}") for c in [*text, *(["ambient_temperature"] if "ambient_temperature" in metadata.columns else [])]])
        j = pairs.join(contexts.withColumnRenamed("contrast_id", "query_id"), "query_id", "left").join(right, "ref_id", "left")
        miss = F.lit(0)
        for c in text:
            miss = miss + F.coalesce((F.col(c) != F.col(f"_r_{c}")).cast("int"), F.lit(0))
        if "ambient_temperature" in contexts.columns and "_r_ambient_temperature" in j.columns:
            miss = miss + F.coalesce((F.abs(F.col("ambient_temperature") - F.col("_r_ambient_temperature")) > 3.0).cast("int"), F.lit(0))
        pairs = j.select("query_id", "ref_id", "similarity", miss.alias("mismatches"))
    else:
        pairs = pairs.withColumn("mismatches", F.lit(0))
    near = materialize(SIM.calorimetry_evidence(pairs, metadata, power, hub_mode, mismatch_penalty, k))
    genes = near.join(metadata.select(F.col("id").alias("ref_id"), "gene_id"), "ref_id").filter("gene_id is not null")
    scores = genes.groupBy(F.col("query_id").alias("contrast_id"), "gene_id").agg(F.sum("evidence").alias("score"))
    return {"neighbours": near, "genes": _finish(scores, metadata, orthologs, policy, ["contrast_id"], select)}


def calr_reference(signatures: DataFrame, studies: DataFrame, keys: Sequence[str] = ("study_id",)) -> dict[str, DataFrame]:
    """Reference profiles from per-study signatures: one non-reference contrast per study, QC weight and feature statistics.

    QC weight multiplies .7, .8 and .85 for a missing gene, a missing mass
    covariate and a small group, with floor .05. ``studies`` has one row per study.
    """
    s = signatures.join(studies.select(*keys, "reference_group"), list(keys)).filter(F.col("contrast_id") != F.coalesce("reference_group", F.lit("")))
    chosen = s.groupBy(*keys).agg(F.min("contrast_id").alias("_c"))
    prof = s.join(chosen, list(keys)).filter(F.col("contrast_id") == F.col("_c")).select(F.concat_ws("__", *keys, "contrast_id").alias("id"), *keys, "feature", "value")
    flag = lambda cond, w: F.when(cond, F.lit(w)).otherwise(1.0)
    has = lambda c: c in studies.columns
    w = flag(F.col("gene_symbol").isNull(), 0.7) if has("gene_symbol") else F.lit(1.0)
    w = w * (flag(F.col("mass_covariate").isNull(), 0.8) if has("mass_covariate") else F.lit(1.0))
    w = w * (flag(F.col("n_group") < 3, 0.85) if has("n_group") else F.lit(1.0))
    meta = prof.select("id", *keys).distinct().join(studies, list(keys)).withColumn("qc_weight", F.greatest(F.lit(0.05), w))
    return {"profiles": prof.select("id", "feature", "value"), "metadata": meta, "feature_stats": ST.center_scale(prof)}
