"""Drug-response screens to gene programs, and matrix preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import response_sign
from lociweave.operators import sampling as SA
from lociweave.operators import screens as D
from lociweave.operators import selection as SEL
from lociweave.operators import statistics as ST
from lociweave.session import materialize


def scaled_response(response: DataFrame, metric: str = "logfc", transform: str = "robust_z") -> DataFrame:
    """Oriented replicate means, scaled per drug: robust_z, rank_normal or none."""
    r = materialize(D.replicate_mean(response).withColumn("response", F.col("response") * response_sign(metric)))
    if transform == "robust_z":
        return ST.robust_z(r, ["drug_id"], "response", "z").select("sample_id", "drug_id", "z")
    if transform == "rank_normal":
        return ST.rank_normal(r, ["drug_id"], "response", "sample_id", "z").select("sample_id", "drug_id", "z")
    return r.withColumnRenamed("response", "z")


def drug_response_screen(
    response: DataFrame, edges: DataFrame, groups: DataFrame | None = None, case: DataFrame | None = None, kind: str = "group_vs_rest",
    metric: str = "logfc", transform: str = "robust_z", aliases: DataFrame | None = None, blacklist: DataFrame | None = None, qc: DataFrame | None = None,
    promiscuity: str = "warn", max_targets: int = 50, max_programs: int = 50, signed: bool = False, model: str = "target_weighted_sum", alpha: float = 0.01,
    tau: float = 1.0, eps: float = 0.05, t0: int = 5, target_bundle: DataFrame | None = None, select: dict | None = None,
) -> DataFrame:
    """Responses and target edges to selected genes per program, all programs in one job."""
    # Responses and edges feed several weights each: both are written once.
    z = materialize(scaled_response(response, metric, transform))
    e = D.merge_drug_ids(edges, aliases) if aliases is not None else edges
    e = materialize(D.promiscuity_cap(D.drop_compounds(e, blacklist, qc), max_targets, promiscuity))
    prog = D.group_programs(z, groups, kind, case=case)
    if kind == "per_sample":
        prog = D.strongest_programs(prog, max_programs)
    ubi, poly = D.response_ubiquity(z, tau, eps), D.polypharmacology(e, t0)
    dw = ubi.select("drug_id", F.col("weight").alias("_a")).join(poly.select("drug_id", F.col("weight").alias("_b")), "drug_id", "full_outer").select(
        "drug_id", (F.coalesce("_a", F.lit(1.0)) * F.coalesce("_b", F.lit(1.0))).alias("weight")
    )
    gw = D.target_ubiquity(e, target_bundle)
    if model == "sparse_deconvolution":
        scores = D.sparse_deconvolution(prog, D.weighted_edges(e, dw, gw), alpha, signed=signed)
        # Programs whose fit is empty get the weighted sum instead, each for itself.
        scores = materialize(scores)
        rest = prog.join(scores.select("program").distinct(), "program", "left_anti")
        scores = scores.unionByName(D.target_weighted_sum(rest, e, dw, gw, signed))
    else:
        scores = D.target_weighted_sum(prog, e, dw, gw, signed)
    return SEL.select_and_weight(scores.filter("score <> 0"), ["program"], **(select or {}))


def prism_prepare(response: DataFrame, lines: DataFrame, group: str = "primary_tissue", per_group: int = 0, total: int = 0, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(responses, groups) of cell lines with a group, optionally capped per group and overall by hash rank."""
    g = lines.filter(F.col(group).isNotNull()).select("sample_id", F.col(group).alias("group"))
    g = g.join(response.select("sample_id").distinct(), "sample_id", "left_semi")
    if per_group:
        g = SA.cap_per_bucket(g, ["group"], ["sample_id"], per_group, seed)
    if total:
        g = SA.cap_per_bucket(g, [], ["sample_id"], total, seed)
    return response.join(g.select("sample_id"), "sample_id", "left_semi"), g
