"""Feature -> gene score aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators.joins import attach

from lociweave.functions import scalars as S


def first_by_magnitude(value: str, *tiebreak: Column, last: bool = False) -> Column:
    """Signed value of largest magnitude; ties go to the first row in order (or the last)."""
    if tiebreak:
        best = F.max_by if last else F.min_by
        mag = F.abs(value) if last else -F.abs(value)
        return best(value, F.struct(mag.alias("m"), *[t.alias(f"t{i}") for i, t in enumerate(tiebreak)]))
    return F.max_by(value, F.struct(F.abs(value).alias("m"), F.col(value).alias("v")))


def linked_score(
    features: DataFrame,
    links: DataFrame,
    on: Sequence[str],
    keys: Sequence[str] = (),
    weight: str = "weight",
    transform: str = "signed",
    drop_zero: bool = True,
) -> DataFrame:
    """Sum of transform(weight) * link_weight per (keys, gene).

    Feature weights are summed per link key before the join, so the join sees
    one row per (keys, place) however many features share it.
    """
    on, keys = list(on), list(keys)
    collapsed = features.groupBy(*keys, *on).agg(F.sum(S.transform_score(weight, transform)).alias("_w"))
    out = collapsed.join(links, on).groupBy(*keys, "gene_id").agg(F.sum(F.col("_w") * F.col("link_weight")).alias("score"))
    return out.filter("score <> 0") if drop_zero else out


def aggregate_to_gene(
    linked: DataFrame,
    keys: Sequence[str],
    mode: str = "weighted_mean",
    value: str = "value",
    link_weight: str = "link_weight",
    tiebreak: Sequence[Column] = (),
    last: bool = False,
) -> DataFrame:
    """weighted_mean (dropped when the weight total is <= 1e-12), sum, mean or max_abs of value * link weight.

    ``mean`` divides the weighted sum by the number of contributions.
    """
    contrib = linked.withColumn("_x", F.col(value) * F.col(link_weight))
    g = contrib.groupBy(*keys, "gene_id")
    if mode == "weighted_mean":
        out = g.agg(F.sum("_x").alias("_n"), F.sum(F.abs(link_weight)).alias("_d")).filter("_d > 1e-12")
        return out.select(*keys, "gene_id", (F.col("_n") / F.col("_d")).alias("score"))
    picks = {
        "sum": lambda: F.sum("_x"),
        "mean": lambda: F.avg("_x"),
        "max_abs": lambda: first_by_magnitude("_x", *tiebreak, last=last),
    }
    if mode not in picks:
        raise ValueError(f"unknown aggregation {mode!r}")
    return g.agg(picks[mode]().alias("score"))


def merge_duplicates(
    rows: DataFrame, keys: Sequence[str], policy: str = "sum", value: str = "score", ordinal: str = "row_ordinal",
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per (keys, gene): sum, mean, last or max_abs (first wins ties), first non-blank ``carry`` values."""
    picks = {
        "sum": lambda: F.sum(value),
        "mean": lambda: F.avg(value),
        "last": lambda: F.max_by(value, ordinal),
        "max_abs": lambda: first_by_magnitude(value, F.col(ordinal)),
    }
    if policy not in picks:
        raise ValueError(f"unknown duplicate policy {policy!r}")
    first = [
        F.min_by(S.clean(c), F.when(S.clean(c).isNotNull(), F.col(ordinal))).alias(c) for c in carry
    ]
    return rows.groupBy(*keys, "gene_id").agg(picks[policy]().alias(value), F.count("*").alias("n_rows"), *first)


def combine_ratio(distal: DataFrame, promoter: DataFrame, keys: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """log2((distal+eps)/(promoter+eps)) over the union of genes; a missing side counts as 0."""
    j = [*keys, "gene_id"]
    both = distal.select(*j, F.col("score").alias("_d")).join(promoter.select(*j, F.col("score").alias("_p")), j, "full_outer")
    d, p = F.coalesce("_d", F.lit(0.0)), F.coalesce("_p", F.lit(0.0))
    return both.select(*j, log_ratio(d, p, eps).alias("score"))


def log_ratio(distal: Column, promoter: Column, eps: float = 1e-6) -> Column:
    return F.log2((distal + eps) / (promoter + eps))


def collapse_best(
    df: DataFrame, keys: Sequence[str], policy: str, score: str, quality: str, ordinal: str
) -> DataFrame:
    """One row per key by highest_confidence or max_abs (whole row), mean or sum (averaged fields).

    ``mean`` and ``sum`` combine the score columns; other columns come from the
    first row, quality is the maximum and the ordinal the minimum.
    """
    rest = [c for c in df.columns if c not in keys]
    if policy in ("highest_confidence", "max_abs"):
        q, a = (-F.col(quality)).alias("q"), (-F.abs(score)).alias("a")
        lead = (q, a) if policy == "highest_confidence" else (a, q)
        best = F.min_by(F.struct(*rest), F.struct(*lead, F.col(ordinal).alias("o")))
        return df.groupBy(*keys).agg(best.alias("_r")).select(*keys, "_r.*")
    if policy not in ("mean", "sum"):
        raise ValueError(f"unknown collapse policy {policy!r}")
    summed = {score, "base_score", "adjusted_score"}
    averaged = {"confidence_weight", "ubiquity_weight"}
    aggs = []
    for c in rest:
        if c in summed:
            aggs.append((F.avg(c) if policy == "mean" else F.sum(c)).alias(c))
        elif c in averaged:
            aggs.append(F.avg(c).alias(c))
        elif c == quality:
            aggs.append(F.max(c).alias(c))
        elif c == ordinal:
            aggs.append(F.min(c).alias(c))
        else:
            aggs.append(F.min_by(c, ordinal).alias(c))
    return df.groupBy(*keys).agg(*aggs)


def records_to_gene(
    df: DataFrame, keys: Sequence[str], mode: str = "signed_topk_mean", k: int = 3, score: str = "final_score",
    record_key: str = "record_key",
) -> DataFrame:
    """Site or event scores to one gene score: signed_topk_mean, max_abs, sum or mean."""
    from lociweave.operators.selection import top_k

    by = [*keys, "gene_id"]
    order = [F.abs(score).desc(), F.col(record_key).asc()]
    if mode in ("signed_topk_mean", "max_abs"):
        kept = top_k(df, by, max(1, k) if mode == "signed_topk_mean" else 1, order, "_r")
        return kept.groupBy(*by).agg(F.avg(score).alias("score"))
    if mode in ("sum", "mean"):
        return df.groupBy(*by).agg((F.sum if mode == "sum" else F.avg)(score).alias("score"))
    raise ValueError(f"unknown gene aggregation {mode!r}")


def with_presence(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Adds ``_has_<column>``: whether the row's comparison holds any value there. A column that is missing counts as empty."""
    there = [c for c in columns if c in df.columns]
    out = df
    if there:
        out = attach(df, df.groupBy(*keys).agg(*[F.max(F.col(c).isNotNull()).alias(f"_has_{c}") for c in there]), keys)
    for c in columns:
        if c not in there:
            out = out.withColumn(f"_has_{c}", F.lit(False))
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out
