"""Ranking, selection, normalisation and gene-set cuts over (keys, gene_id, score) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators import sliced
from lociweave.operators.joins import attach, attach_total

# Above this the optimizer no longer limits window groups before the shuffle.
MAP_SIDE_TOP_K = 1000


def score_order(score: str = "score", gene: str = "gene_id") -> list[Column]:
    return [F.col(score).desc(), F.col(gene).asc()]


def tied_order(score: str = "score", gene: str = "gene_id") -> list[Column]:
    """Magnitude, then gene id: genes with the same features tie, whatever the order in which their rows were added up."""
    return [S.significant(F.abs(score)).desc(), F.col(gene).asc()]


def cnv_order(score: str = "score", symbol: str = "gene_symbol", gene: str = "gene_id") -> list[Column]:
    """Score, then lower-case symbol with blank symbols last, then gene id."""
    name = F.coalesce(F.nullif(F.lower(F.trim(F.col(symbol))), F.lit("")), F.lit("{"))
    return [F.col(score).desc(), name.asc(), F.col(gene).asc()]


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None, rank: str = "rank") -> DataFrame:
    """Dense 1..n rank of every row in its key, for keys of any size."""
    return sliced.ranked(df, keys, order or score_order(), rank)


def top_k(
    df: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column] | None = None, rank: str = "rank"
) -> DataFrame:
    """First k rows per key, ranked. Each map task keeps at most k rows of a key before the shuffle."""
    order = order or score_order()
    if k <= 0:
        return df.withColumn(rank, F.lit(0).cast("long")).filter(F.lit(False))
    if k > MAP_SIDE_TOP_K:
        return sliced.ranked(df, keys, order, rank).filter(F.col(rank) <= k)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("long")).filter(F.col(rank) <= k)


def select_rows(
    df: DataFrame,
    keys: Sequence[str],
    how: str = "top_k",
    k: int = 200,
    q: float = 0.01,
    min_score: float = 0.0,
    order: Sequence[Column] | None = None,
    score: str = "score",
) -> DataFrame:
    """Selection by top_k, quantile (max(1, ceil(n*q)) rows), threshold or none; adds ``rank``."""
    order = order or score_order(score)
    if how == "top_k":
        return top_k(df, keys, k, order)
    if how == "quantile":
        if not 0.0 < q < 1.0:
            raise ValueError("q must be in (0,1)")
        ranked = sliced.ranked(df, keys, order, "rank", count="_n")
        return ranked.filter(F.col("rank") <= F.greatest(F.lit(1), F.ceil(F.col("_n") * F.lit(q)))).drop("_n")
    if how == "threshold":
        return sliced.ranked(df.filter(F.col(score) >= min_score), keys, order)
    if how == "none":
        return sliced.ranked(df, keys, order)
    raise ValueError(f"unknown selection {how!r}")


def within_set_l1(selected: DataFrame, keys: Sequence[str], score: str = "score", out: str = "weight") -> DataFrame:
    """Share of the selected total; uniform when the total is not positive."""
    sums = selected.groupBy(*keys).agg(F.sum(score).alias("_total"), F.count("*").alias("_n"))
    w = F.when(F.col("_total") > 0, F.col(score) / F.col("_total")).otherwise(1.0 / F.col("_n"))
    return attach(selected, sums, keys).withColumn(out, w).drop("_total", "_n")


def global_l1(scores: DataFrame, keys: Sequence[str], score: str = "score", out: str = "weight") -> DataFrame:
    """Share of the whole key's total, unchanged when the total is not positive. Apply before selecting."""
    w = F.when(F.col("_total") > 0, F.col(score) / F.col("_total")).otherwise(F.col(score))
    return attach_total(scores, keys, score, "_total").withColumn(out, w).drop("_total")


def select_and_weight(
    scores: DataFrame,
    keys: Sequence[str],
    normalize: str = "within_set_l1",
    magnitude: str | None = None,
    order: Sequence[Column] | None = None,
    **select,
) -> DataFrame:
    """Select on magnitude, rank and weight in one pass; keeps the signed score."""
    df = scores.withColumn("_mag", F.abs("score") if magnitude is None else F.col(magnitude))
    order = order or [F.col("_mag").desc(), F.col("gene_id").asc()]
    if normalize == "l1":
        picked = select_rows(global_l1(df, keys, "_mag"), keys, order=order, score="_mag", **select)
    else:
        picked = select_rows(df, keys, order=order, score="_mag", **select)
        if normalize == "within_set_l1":
            picked = within_set_l1(picked, keys, "_mag")
        elif normalize == "none":
            picked = picked.withColumn("weight", F.col("_mag"))
        else:
            raise ValueError(f"unknown normalisation {normalize!r}")
    return picked.drop("_mag")


def softmax(df: DataFrame, keys: Sequence[str], temperature: float | Column, score: str = "score", out: str = "weight") -> DataFrame:
    t = F.lit(float(temperature)) if not isinstance(temperature, Column) else temperature
    peak = attach(df, df.groupBy(*keys).agg(F.max(score).alias("_max")), keys)
    e = peak.withColumn("_e", F.exp((F.col(score) - F.col("_max")) / t)).drop("_max")
    z = attach_total(e, keys, "_e", "_z")
    return z.withColumn(out, F.col("_e") / F.col("_z")).drop("_e", "_z")


def temperature_for_effective_n(
    df: DataFrame, keys: Sequence[str], target: float, score: str = "score", tol: float = 1e-3
) -> DataFrame:
    """Temperature per key whose softmax has ``target`` effective members, by bisection of [1e-6, 1e6].

    One pass evaluates all 15 midpoints that four bisection steps can reach, as
    partial sums over the scores; one row per key is carried between passes.
    """
    from lociweave.session import materialize

    stats = materialize(df.groupBy(*keys).agg(F.max(score).alias("_max")))
    base = materialize(attach(df, stats, keys).select(*keys, (F.col(score) - F.col("_max")).alias("_d")))
    state = stats.select(
        *keys, F.lit(1e-6).alias("lo"), F.lit(1e6).alias("hi"), F.lit(None).cast("double").alias("temperature")
    )
    point = lambda j: F.col("lo") + (F.col("hi") - F.col("lo")) * (j / 16)
    mid = (F.col("lo") + F.col("hi")) / 2
    for _ in range(25):
        rows = attach(base, state.filter("temperature is null").select(*keys, "lo", "hi"), keys)
        neff = []
        for j in range(1, 16):
            e = F.exp(F.col("_d") / point(j))
            neff.append((F.pow(F.sum(e), 2) / F.sum(e * e)).alias(f"_n{j}"))
        sums = rows.groupBy(*keys).agg(F.max("lo").alias("lo"), F.max("hi").alias("hi"), *neff)
        width = (F.col("hi") - F.col("lo")) / 16
        walk = sums.withColumn("_at", F.lit(8)).withColumn("_t", F.lit(None).cast("double"))
        for step in (4, 2, 1, 0):
            n = F.element_at(F.array(*[F.col(f"_n{j}") for j in range(1, 16)]), F.col("_at"))
            walk = walk.withColumn("_now", n).withColumn(
                "_t", F.coalesce("_t", F.when(F.abs(F.col("_now") - target) <= tol, F.col("lo") + width * F.col("_at")))
            )
            turn = F.when(F.col("_now") < target, F.col("_at") + step).otherwise(F.col("_at") - step)
            if step:
                walk = walk.withColumn("_at", turn)
        low = F.when(F.col("_now") < target, F.col("_at")).otherwise(F.col("_at") - 1)
        moved = walk.select(
            *keys, (F.col("lo") + width * low).alias("lo"), (F.col("lo") + width * (low + 1)).alias("hi"), F.col("_t").alias("temperature")
        )
        state = materialize(state.filter("temperature is not null").unionByName(moved))
        if state.filter("temperature is null").isEmpty():
            break
    return state.select(*keys, F.coalesce("temperature", mid).alias("temperature"))


def sign_variants(df: DataFrame, keys: Sequence[str], split: bool = True, score: str = "score") -> DataFrame:
    """Positive-score rows with a ``variant`` column: '' or '__pos' / '__neg' when a key has negatives."""
    if not split:
        return df.withColumn("variant", F.lit("")).filter(F.col(score) > 0)
    flag = df.groupBy(*keys).agg(F.max((F.col(score) < 0).cast("int")).alias("_neg"))
    both = attach(df, flag, keys)
    name = F.when(F.col("_neg") == 0, F.lit("")).when(F.col(score) > 0, F.lit("__pos")).otherwise(F.lit("__neg"))
    return both.withColumn("variant", name).withColumn(score, F.abs(score)).filter(F.col(score) > 0).drop("_neg")


def gene_token(prefer_symbol: bool = True, require_symbol: bool = False) -> Column:
    symbol, gid = S.clean("gene_symbol"), S.clean("gene_id")
    if require_symbol:
        return F.when(~S.ensembl_like("gene_symbol"), symbol)
    return F.coalesce(symbol, gid) if prefer_symbol else gid


def dedupe_tokens(df: DataFrame, keys: Sequence[str], rank: str = "rank", token: str = "token") -> DataFrame:
    """First row per (key, token) in rank order; null tokens drop out. Partially aggregated."""
    return df.filter(F.col(token).isNotNull()).groupBy(*keys, token).agg(F.min(rank).alias(rank))


def clamp_k(k: int, low: int = 100, high: int = 500) -> int:
    return max(low, min(high, int(k)))


def gene_sets_top_k(
    rows: DataFrame,
    keys: Sequence[str],
    requested: Sequence[int] = (200,),
    low: int = 100,
    high: int = 500,
    split_signed: bool = True,
    prefer_symbol: bool = True,
    require_symbol: bool = False,
    biotypes: Sequence[str] | None = None,
    emit_small: bool = False,
) -> DataFrame:
    """Members of each top-k gene set: (keys, variant, k, token, rank).

    The cut uses the clamped k; names carry it even when fewer genes exist, and
    token dedupe follows the cut. Sets with fewer than ``low`` tokens are left
    out unless ``emit_small``.
    """
    if biotypes and "gene_biotype" in rows.columns:
        rows = rows.filter(S.biotype_allowed("gene_biotype", biotypes))
    cuts = sorted({clamp_k(k, low, high) for k in requested})
    positive = sign_variants(rows, keys, split_signed)
    by = [*keys, "variant"]
    ranked = top_k(positive, by, max(cuts))
    ranked = ranked.withColumn("k", F.explode(F.array(*[F.lit(c) for c in cuts]))).filter("rank <= k")
    tokens = dedupe_tokens(ranked.withColumn("token", gene_token(prefer_symbol, require_symbol)), [*by, "k"])
    if emit_small:
        return tokens
    sizes = tokens.groupBy(*by, "k").agg(F.count("*").alias("_n")).filter(F.col("_n") >= low)
    return tokens.join(sizes.drop("_n"), [*by, "k"], "left_semi")


def mass_cut(
    df: DataFrame, keys: Sequence[str], tau: float, low: int = 100, high: int = 500, score: str = "score"
) -> DataFrame:
    """Smallest k with cumulative share >= tau, clamped; keeps the first k rows with rank and k."""
    pos = df.withColumn("_s", F.greatest(F.col(score), F.lit(0.0)))
    cum = sliced.cumulative(pos, keys, [F.col("_s").desc(), F.col("gene_id").asc()], "_s", "_run", "_total", "rank")
    reached = F.when((F.col("_total") > 0) & (F.col("_run") / F.col("_total") >= F.lit(tau - 1e-12)), F.col("rank"))
    ends = cum.groupBy(*keys).agg(F.min(reached).alias("_k"), F.max("_total").alias("_t"), F.count("*").alias("_n"))
    k = F.when(F.col("_t") > 0, F.coalesce("_k", "_n")).otherwise(F.lit(low))
    k = F.greatest(F.lit(low), F.least(F.lit(high), k)).cast("long")
    out = attach(cum, ends.select(*keys, k.alias("k")), keys).filter(F.col("rank") <= F.col("k"))
    return out.drop("_s", "_run", "_total")


def gene_set_lists(members: DataFrame, keys: Sequence[str], name: Column) -> DataFrame:
    """One row per set with its tokens in rank order; a set holds at most the clamped k tokens."""
    packed = F.sort_array(F.collect_list(F.struct("rank", "token")))
    return members.groupBy(*keys).agg(F.transform(packed, lambda t: t["token"]).alias("genes")).withColumn(
        "set_name", S.set_name(name)
    )


def tie_diagnostics(
    scores: DataFrame, keys: Sequence[str], k: int, order: Sequence[Column] | None = None, tol: float = 1e-12
) -> DataFrame:
    """How many rows share the score of the last selected row, inside and outside the cut."""
    cut = top_k(scores, keys, k, order)
    edge = cut.groupBy(*keys).agg(F.min_by("score", -F.col("rank")).alias("cutoff"), F.count("*").alias("n_selected"))
    at = F.abs(F.col("score") - F.col("cutoff")) <= tol
    tied_all = attach(scores, edge, keys).groupBy(*keys).agg(
        F.max("cutoff").alias("cutoff"),
        F.max("n_selected").alias("n_selected"),
        F.count_if(F.col("score") > F.col("cutoff") + tol).alias("_above"),
        F.count_if(at).alias("n_tied"),
    )
    return tied_all.withColumn("n_tied_selected", F.col("n_selected") - F.col("_above")).withColumn(
        "n_tied_left_out", F.col("n_tied") - F.col("n_tied_selected")
    ).drop("_above")
