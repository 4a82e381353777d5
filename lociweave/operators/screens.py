"""Drug-response screens: response scaling, drug and target weights, programs and gene scores."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.idf import target_idf
from lociweave.operators.identifiers import normalize_edges
from lociweave.operators.joins import attach, attach_count
from lociweave.operators.selection import top_k
from lociweave.session import materialize


def replicate_mean(response: DataFrame) -> DataFrame:
    return response.groupBy("sample_id", "drug_id").agg(F.avg("response").alias("response"))


def response_ubiquity(z: DataFrame, tau: float = 1.0, eps: float = 0.05) -> DataFrame:
    """Weight 1/(eps + fraction of all samples with z > tau) per drug; missing counts as inactive."""
    n = z.agg(F.countDistinct("sample_id").alias("_n"))
    active = z.groupBy("drug_id").agg(F.countDistinct(F.when(F.col("z") > tau, F.col("sample_id"))).alias("_k"))
    frac = F.col("_k") / F.greatest(F.col("_n"), F.lit(1))
    return attach(active, n, []).select("drug_id", frac.alias("active_fraction"), (1.0 / (eps + frac)).alias("weight"))


def polypharmacology(edges: DataFrame, t0: int = 5) -> DataFrame:
    """Weight 1/(1 + ln(1 + n_targets/t0)) per drug."""
    n = edges.groupBy("drug_id").agg(F.countDistinct("gene_id").alias("n_targets"))
    return n.withColumn("weight", 1.0 / (1.0 + F.log(1.0 + F.col("n_targets") / float(max(1, t0)))))


def target_ubiquity(edges: DataFrame, bundle: DataFrame | None = None) -> DataFrame:
    """IDF of a gene over drugs, or the given weights with default 1."""
    f = edges.groupBy("gene_id").agg(F.countDistinct("drug_id").alias("n_drugs_with_gene"))
    if bundle is not None:
        return f.join(bundle.select("gene_id", F.col("weight").alias("_w")), "gene_id", "left").select(
            "gene_id", "n_drugs_with_gene", F.coalesce("_w", F.lit(1.0)).alias("weight")
        )
    n = edges.agg(F.countDistinct("drug_id").alias("_n"))
    return attach(f, n, []).select("gene_id", "n_drugs_with_gene", target_idf("n_drugs_with_gene", "_n").alias("weight"))


def promiscuity_cap(edges: DataFrame, limit: int = 50, policy: str = "warn") -> DataFrame:
    """Drugs with more than ``limit`` targets: kept (warn), dropped, or cut to the heaviest and renormalised."""
    if policy == "warn":
        return edges
    sized = attach_count(edges, ["drug_id"], "_n")
    small = sized.filter(F.col("_n") <= limit).drop("_n")
    if policy == "drop":
        return small
    if policy != "cap":
        raise ValueError(f"unknown promiscuity policy {policy!r}")
    big = top_k(sized.filter(F.col("_n") > limit).drop("_n"), ["drug_id"], limit, [F.col("weight").desc(), F.col("gene_id").asc()], "_r")
    sums = big.groupBy("drug_id").agg(F.sum("weight").alias("_t"), F.count("*").alias("_k"))
    w = F.when(F.col("_t") > 0, F.col("weight") / F.col("_t")).otherwise(1.0 / F.col("_k"))
    capped = attach(big, sums, ["drug_id"]).withColumn("weight", w).drop("_r", "_t", "_k")
    return small.unionByName(capped.select(*small.columns))


def drop_compounds(edges: DataFrame, blacklist: DataFrame | None = None, qc: DataFrame | None = None) -> DataFrame:
    """Remove listed drugs and drugs flagged drop or pan-toxic; halve polypharmacology-flagged ones."""
    out = edges
    if blacklist is not None:
        out = out.join(blacklist.select("drug_id").distinct(), "drug_id", "left_anti")
    if qc is not None:
        q = qc.select(
            "drug_id", ((F.col("recommended") == "drop") | F.col("pan_toxic")).alias("_drop"),
            F.when(F.col("polypharm"), F.lit(0.5)).otherwise(F.lit(1.0)).alias("_f"),
        )
        out = out.join(q, "drug_id", "left").filter(~F.coalesce("_drop", F.lit(False)))
        out = out.withColumn("weight", F.col("weight") * F.coalesce("_f", F.lit(1.0))).drop("_drop", "_f")
    return out


def merge_drug_ids(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Canonical drug ids, repeated targets summed and renormalised."""
    from lociweave.operators.identifiers import canonical_ids

    return normalize_edges(canonical_ids(edges, aliases, "drug_id"), "drug_id")


def group_programs(z: DataFrame, groups: DataFrame, kind: str = "group_vs_rest", min_group: int = 5,
                   case: DataFrame | None = None) -> DataFrame:
    """Drug scores per program: per_sample, group_mean, group_vs_rest, case_control or case_control_within_group.

    Sums and counts per (group, drug) are aggregated once; "rest" is the total
    minus the group. Both arms must be present for a drug. Within groups, each
    group of at least ``min_group`` samples compares its own cases with its own
    controls; samples without a case flag only count for the group's size.
    """
    if kind == "case_control_within_group":
        fit = program_audit(z, groups, min_group, case).filter("reason = ''").select("group")
        arms = groups.select("sample_id", "group").distinct().join(fit, "group", "left_semi").join(case.select("sample_id", "is_case"), "sample_id")
        mean = lambda which: F.avg(F.when(which, F.col("z")))
        both = z.join(arms, "sample_id").groupBy("group", "drug_id").agg(mean(F.col("is_case")).alias("_a"), mean(~F.col("is_case")).alias("_b"))
        return both.filter("_a is not null and _b is not null").select(
            F.concat(F.col("group"), F.lit("_case_vs_control")).alias("program"), "drug_id", (F.col("_a") - F.col("_b")).alias("score"))
    if kind == "per_sample":
        return z.select(F.col("sample_id").alias("program"), "drug_id", F.col("z").alias("score"))
    if kind == "case_control":
        j = z.join(case.select("sample_id", "is_case"), "sample_id")
        a = j.groupBy("drug_id").agg(
            F.avg(F.when(F.col("is_case"), F.col("z"))).alias("_a"), F.avg(F.when(~F.col("is_case"), F.col("z"))).alias("_b")
        )
        return a.filter("_a is not null and _b is not null").select(
            F.lit("case_vs_control").alias("program"), "drug_id", (F.col("_a") - F.col("_b")).alias("score")
        )
    sizes = groups.groupBy("group").agg(F.countDistinct("sample_id").alias("_size")).filter(F.col("_size") >= min_group)
    j = z.join(groups.select("sample_id", "group"), "sample_id")
    per = j.groupBy("group", "drug_id").agg(F.sum("z").alias("_s"), F.count("z").alias("_n"))
    kept = per.join(sizes.select("group"), "group", "left_semi")
    if kind == "group_mean":
        return kept.select(F.col("group").alias("program"), "drug_id", (F.col("_s") / F.col("_n")).alias("score"))
    if kind != "group_vs_rest":
        raise ValueError(f"unknown program kind {kind!r}")
    total = per.groupBy("drug_id").agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    x = kept.join(total, "drug_id").filter("_tn > _n")
    rest = (F.col("_ts") - F.col("_s")) / (F.col("_tn") - F.col("_n"))
    return x.select(F.concat(F.col("group"), F.lit("_vs_rest")).alias("program"), "drug_id", (F.col("_s") / F.col("_n") - rest).alias("score"))


def program_audit(z: DataFrame, groups: DataFrame, min_group: int = 5, case: DataFrame | None = None) -> DataFrame:
    """Per group its samples, those outside, cases and controls, and why it gives no program (empty if it does).

    A group counts the samples that have scores. With ``case`` a group also
    needs a case and a control.
    """
    samples = z.select("sample_id").distinct()
    placed = groups.select("sample_id", "group").distinct().filter("group is not null").join(samples, "sample_id", "left_semi")
    if case is not None:
        placed = placed.join(case.select("sample_id", "is_case"), "sample_id", "left")
    else:
        placed = placed.withColumn("is_case", F.lit(None).cast("boolean"))
    per = placed.groupBy("group").agg(F.count("*").alias("n_group"), F.count_if("is_case").alias("n_case"), F.count_if(~F.col("is_case")).alias("n_control"))
    out = attach(per, samples.agg(F.count("*").alias("_n")), []).withColumn("n_rest", F.col("_n") - F.col("n_group"))
    lacking = F.lit(case is not None) & (F.least("n_case", "n_control") < 1)
    reason = F.when(F.col("n_group") < max(1, min_group), "min_group_size").when(lacking, "missing_case_or_control").otherwise("")
    return out.select("group", "n_group", "n_rest", "n_case", "n_control", reason.alias("reason"))


def strongest_programs(scores: DataFrame, k: int = 50) -> DataFrame:
    """Programs with the largest mean absolute drug score."""
    m = scores.groupBy("program").agg(F.avg(F.abs("score")).alias("_m"))
    keep = top_k(m, [], k, [F.col("_m").desc(), F.col("program").asc()], "_r")
    return scores.join(keep.select("program"), "program", "left_semi")


def target_weighted_sum(
    scores: DataFrame, edges: DataFrame, drug_weights: DataFrame | None = None, gene_weights: DataFrame | None = None,
    signed: bool = False,
) -> DataFrame:
    """Sum of drug score x drug weight x gene weight x target weight per (program, gene)."""
    s = scores if signed else scores.withColumn("score", F.greatest("score", F.lit(0.0)))
    s = s.filter("score <> 0")
    e = weighted_edges(edges, drug_weights, gene_weights)
    return s.join(e, "drug_id").groupBy("program", "gene_id").agg(F.sum(F.col("score") * F.col("x")).alias("score"))


def weighted_edges(edges: DataFrame, drug_weights: DataFrame | None, gene_weights: DataFrame | None) -> DataFrame:
    e = edges.withColumn("x", F.col("weight"))
    if drug_weights is not None:
        e = e.join(drug_weights.select("drug_id", F.col("weight").alias("_dw")), "drug_id", "left")
        e = e.withColumn("x", F.col("x") * F.coalesce("_dw", F.lit(1.0))).drop("_dw")
    if gene_weights is not None:
        e = e.join(gene_weights.select("gene_id", F.col("weight").alias("_gw")), "gene_id", "left")
        e = e.withColumn("x", F.col("x") * F.coalesce("_gw", F.lit(1.0))).drop("_gw")
    return e.select("drug_id", "gene_id", "x")


#: Genes up to which a program's inner products fit one task.
GRAM_GENES = 1024


def _by_inner_products(y: DataFrame, x: DataFrame, alpha: float, tol: float) -> DataFrame:
    """Coordinate descent per (program, sign) on sums over drugs; y has program, _sign, drug_id, y."""
    by = ["program", "_sign"]
    x = x.groupBy("drug_id", "gene_id").agg(F.sum("x").alias("x"))
    n = y.groupBy(*by).agg(F.count("*").alias("n"))
    xty = y.join(x, "drug_id").groupBy(*by, "gene_id").agg(F.sum(F.col("x") * F.col("y")).alias("v")).withColumn("other", F.lit(None).cast(x.schema["gene_id"].dataType))
    pairs = y.select(*by, "drug_id").join(x, "drug_id").join(x.select("drug_id", F.col("gene_id").alias("other"), F.col("x").alias("z")), "drug_id")
    gram = pairs.groupBy(*by, "gene_id", "other").agg(F.sum(F.col("x") * F.col("z")).alias("v"))
    rows = attach(xty.select(*by, "gene_id", "other", "v").unionByName(gram.select(*by, "gene_id", "other", "v")), n, by)

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        genes = np.array(sorted(rows["gene_id"].unique()), dtype=object)
        at = {g: i for i, g in enumerate(genes)}
        own = rows["other"].isna()
        c, g = np.zeros(len(genes)), np.zeros((len(genes), len(genes)))
        c[rows.loc[own, "gene_id"].map(at)] = rows.loc[own, "v"]
        g[rows.loc[~own, "gene_id"].map(at), rows.loc[~own, "other"].map(at)] = rows.loc[~own, "v"]
        c -= alpha * rows["n"].iloc[0]
        b, size = np.zeros(len(genes)), np.diag(g)
        while True:
            moved = 0.0
            for j in np.flatnonzero(size > 0):
                new = max(0.0, b[j] + (c[j] - g[j] @ b) / size[j])
                moved, b[j] = max(moved, abs(new - b[j])), new
            if moved <= 1e-3 * tol * max(b.max(initial=0.0), 1e-300):
                break
        return pd.DataFrame({"program": rows["program"].iloc[0], "gene_id": genes, "score": rows["_sign"].iloc[0] * b})

    schema = f"program {y.schema['program'].dataType.simpleString()}, gene_id {x.schema['gene_id'].dataType.simpleString()}, score double"
    return rows.groupBy(*by).applyInPandas(fit, schema).groupBy("program", "gene_id").agg(F.sum("score").alias("score")).filter("score <> 0")


def sparse_deconvolution(
    scores: DataFrame, edges: DataFrame, alpha: float = 0.01, iterations: int = 5000, signed: bool = False, tol: float = 1e-7,
    check_every: int = 5,
) -> DataFrame:
    """Non-negative lasso per program, min 1/(2n)|y - Xb|^2 + alpha|b|_1, by accelerated proximal steps.

    With at most ``GRAM_GENES`` genes each program's inner products (bounded by
    their square) go to one task, which descends until the optimality conditions
    hold. Beyond that X (drug x gene weights) and y stay distributed; one step is
    a residual join on gene, a gradient join on drug and a soft threshold.
    ``signed`` fits the positive and negative parts separately and subtracts. Stops when no
    coefficient moves by more than ``tol`` of the largest; an error is raised
    if that isn't reached in ``iterations`` steps.
    """
    y = scores.select("program", "drug_id", F.col("score").alias("y"))
    if signed:
        y = y.withColumn("_sign", F.explode(F.array(F.lit(1.0), F.lit(-1.0))))
    else:
        y = y.withColumn("_sign", F.lit(1.0))
    y = materialize(y.withColumn("y", F.greatest(F.col("_sign") * F.col("y"), F.lit(0.0))))
    x = materialize(edges.select("drug_id", "gene_id", "x"))
    # The largest row sum of |X|t|X| bounds the largest eigenvalue of XtX, so a step of its inverse always descends.
    if x.select("gene_id").distinct().limit(GRAM_GENES + 1).count() <= GRAM_GENES:
        return _by_inner_products(y, x, alpha, tol)
    rows = x.groupBy("drug_id").agg(F.sum(F.abs("x")).alias("s"))
    lip = x.join(rows, "drug_id").groupBy("gene_id").agg(F.sum(F.abs("x") * F.col("s")).alias("g")).agg(F.max("g")).first()[0]
    if not lip:
        return scores.select("program", F.lit("").alias("gene_id"), F.lit(0.0).alias("score")).limit(0)
    n = y.groupBy("program", "_sign").agg(F.count("*").alias("n"))
    xty = materialize(y.filter("y <> 0").join(x, "drug_id").groupBy("program", "_sign", "gene_id").agg(F.sum(F.col("x") * F.col("y")).alias("xty")))
    # A coefficient can only become positive where the drugs of the program reach the gene.
    reach = y.select("program", "_sign", "drug_id")
    start = attach(xty.filter("xty > 0"), n, ["program", "_sign"])
    b = materialize(start.select("program", "_sign", "gene_id", "xty", "n", F.lit(0.0).alias("b"), F.lit(0.0).alias("v")))
    t = 1.0
    for step in range(iterations):
        fitted = b.filter("v <> 0").join(x, "gene_id").groupBy("program", "_sign", "drug_id").agg(F.sum(F.col("x") * F.col("v")).alias("f"))
        fitted = fitted.join(reach, ["program", "_sign", "drug_id"], "left_semi")
        grad = fitted.join(x, "drug_id").groupBy("program", "_sign", "gene_id").agg(F.sum(F.col("x") * F.col("f")).alias("xtf"))
        t_next = (1 + (1 + 4 * t * t) ** 0.5) / 2
        new = F.greatest(
            F.lit(0.0), F.col("v") - (F.coalesce("xtf", F.lit(0.0)) - F.col("xty")) / lip - F.lit(alpha) * F.col("n") / lip
        )
        nxt = b.join(grad, ["program", "_sign", "gene_id"], "left").withColumn("_new", new)
        b_new = materialize(
            nxt.select(
                "program", "_sign", "gene_id", "xty", "n", F.col("_new").alias("b"),
                (F.col("_new") + (F.col("_new") - F.col("b")) * ((t - 1) / t_next)).alias("v"),
                F.abs(F.col("_new") - F.col("b")).alias("_move"),
            )
        )
        t = t_next
        b = b_new.drop("_move")
        if (step + 1) % check_every == 0:
            moved, size = b_new.agg(F.max("_move"), F.max("b")).first()
            if (moved or 0.0) <= tol * max(size or 0.0, 1e-300):
                break
    else:
        raise RuntimeError(f"the fit isn't settled after {iterations} steps")
    out = b.groupBy("program", "gene_id").agg(F.sum(F.col("_sign") * F.col("b")).alias("score"))
    return out.filter("score <> 0")


def coverage(scores: DataFrame, edges: DataFrame, keys: Sequence[str] = ("program",)) -> DataFrame:
    """Share of a program's drugs that have at least one target."""
    mapped = edges.select("drug_id").distinct().withColumn("_m", F.lit(1))
    return scores.join(mapped, "drug_id", "left").groupBy(*keys).agg(
        F.countDistinct("drug_id").alias("n_drugs"),
        F.countDistinct(F.when(F.col("_m") == 1, F.col("drug_id"))).alias("n_mapped"),
    ).withColumn("coverage", F.col("n_mapped") / F.greatest(F.col("n_drugs"), F.lit(1)))
