"""Robust scaling, multiple testing, regression and expression statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators import sliced
from lociweave.operators.joins import attach, attach_count

# Fixed value: |z| at which the two-sided normal p equals 0.05.
Z_TWO_SIDED_05 = 1.959963984540054


# Cody's rational approximations of the complementary error function, highest power first.
ERF_SMALL = (
    (1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2, 3.77485237685302021e2, 3.20937758913846947e3),
    (1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3, 2.84423683343917062e3),
)
ERFC_MIDDLE = (
    (2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0, 6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2,
     1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3),
    (1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2, 1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3,
     3.43936767414372164e3, 1.23033935480374942e3),
)
ERFC_LARGE = (
    (1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1, 1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4),
    (1.0, 2.56852019228982242e0, 1.87295284992346047e0, 5.27905102951428412e-1, 6.05183413124413191e-2, 2.33520497626869185e-3),
)
# Wichura's rational approximations of the normal quantile (algorithm AS241), highest power first.
QUANTILE_CENTRE = (
    (2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4, 1.3731693765509461125e4, 1.9715909503065514427e3,
     1.3314166789178437745e2, 3.3871328727963666080e0),
    (5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4, 5.3941960214247511077e3, 6.8718700749205790830e2,
     4.2313330701600911252e1, 1.0),
)
QUANTILE_TAIL = (
    (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0, 3.64784832476320460504e0, 5.76949722146069140550e0,
     4.63033784615654529590e0, 1.42343711074968357734e0),
    (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e0,
     2.05319162663775882187e0, 1.0),
)
QUANTILE_FAR = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e0,
     5.46378491116411436990e0, 6.65790464350110377720e0),
    (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
     5.99832206555887937690e-1, 1.0),
)


def _rational(x: Column, parts: tuple[Sequence[float], Sequence[float]]) -> Column:
    """Quotient of two polynomials."""
    value = []
    for powers in parts:
        p = F.lit(powers[0])
        for c in powers[1:]:
            p = p * x + F.lit(c)
        value.append(p)
    return value[0] / value[1]


def normal_p(stat: str | Column) -> Column:
    """Two-sided normal p-value, erfc(|t| / sqrt 2), as an expression; null and NaN give null."""
    t = F.col(stat) if isinstance(stat, str) else stat
    y = F.abs(t) / F.lit(math.sqrt(2.0))
    # The square is split, so that the rounding of y * y isn't blown up by the exponential.
    head = F.floor(y * 16) / 16
    tail = F.exp(-head * head) * F.exp(-(y - head) * (y + head))
    inverse = F.lit(1.0) / (y * y)
    small = F.lit(1.0) - y * _rational(y * y, ERF_SMALL)
    middle = tail * _rational(y, ERFC_MIDDLE)
    large = tail / y * (F.lit(1.0 / math.sqrt(math.pi)) - inverse * _rational(inverse, ERFC_LARGE))
    return F.when(t.isNull() | F.isnan(t), F.lit(None).cast("double")).when(y <= 0.46875, small).when(y <= 4.0, middle).when(y < 27.0, large).otherwise(0.0)


def normal_quantile(p: str | Column) -> Column:
    """Normal quantile of a probability inside (0, 1) as an expression; null and NaN give null."""
    p = F.col(p) if isinstance(p, str) else p
    q = p - 0.5
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    outer = F.when(r <= 5.0, _rational(r - 1.6, QUANTILE_TAIL)).otherwise(_rational(r - 5.0, QUANTILE_FAR))
    centre = q * _rational(F.lit(0.180625) - q * q, QUANTILE_CENTRE)
    return F.when(p.isNull() | F.isnan(p), F.lit(None).cast("double")).when(F.abs(q) <= 0.425, centre).otherwise(F.signum(q) * outer)


def bh_adjust(df: DataFrame, keys: Sequence[str], p: str = "pvalue", out: str = "padj") -> DataFrame:
    """Benjamini-Hochberg per key; null p-values pass through as null.

    An exact zero stays zero. Equal p-values get equal results, so their order
    does not matter.
    """
    tested = df.filter(F.col(p).isNotNull())
    step = lambda rank, n: F.col(p) * n / rank
    adj = sliced.step_up_minimum(tested, keys, [F.col(p).asc()], step, "_q", "_rank", "_n")
    adj = adj.withColumn(out, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "_q"))).drop("_q", "_rank", "_n")
    untested = df.filter(F.col(p).isNull()).withColumn(out, F.lit(None).cast("double"))
    return adj.unionByName(untested)


def robust_z(df: DataFrame, keys: Sequence[str], value: str = "value", out: str = "z", eps: float = 1e-6) -> DataFrame:
    """(x - median) / (MAD + eps) per key, exact and without a scale constant."""
    med = sliced.median(df, keys, value, "_med")
    dev = attach(df, med, keys)
    mad = sliced.median(dev.withColumn("_dev", F.abs(F.col(value) - F.col("_med"))), keys, "_dev", "_mad")
    return attach(dev, mad, keys).withColumn(out, (F.col(value) - F.col("_med")) / (F.col("_mad") + eps)).drop("_med", "_mad")


def median_mad(df: DataFrame, keys: Sequence[str], value: str = "score") -> DataFrame:
    """Exact median and median absolute deviation per key."""
    med = sliced.median(df, keys, value, "median_score")
    dev = attach(df, med, keys).withColumn("_dev", F.abs(F.col(value) - F.col("median_score")))
    return med.join(sliced.median(dev, keys, "_dev", "mad_score"), list(keys))


def rank_normal(df: DataFrame, keys: Sequence[str], value: str, tie: str, out: str = "z") -> DataFrame:
    """Inverse-normal of (rank - 0.5) / n per key, ties broken by ``tie``."""
    r = sliced.ranked(df, keys, [F.col(value).asc(), F.col(tie).asc()], "_r", count="_n")
    return r.withColumn(out, normal_quantile((F.col("_r") - F.lit(0.5)) / F.col("_n"))).drop("_r", "_n")


def center_scale(df: DataFrame, feature: str = "feature", value: str = "value", floor: float = 1e-8) -> DataFrame:
    return df.groupBy(feature).agg(
        F.avg(value).alias("center"), F.greatest(F.stddev_pop(value), F.lit(floor)).alias("scale")
    )


def standardize(df: DataFrame, stats: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """(x - center) / scale with a zero scale read as 1; features without stats are left as they are."""
    s = stats.select(feature, F.col("center").alias("_c"), F.col("scale").alias("_s"))
    scale = F.when(F.coalesce("_s", F.lit(1.0)) == 0, F.lit(1.0)).otherwise(F.coalesce("_s", F.lit(1.0)))
    return df.join(s, feature, "left").withColumn(value, (F.col(value) - F.coalesce("_c", F.lit(0.0))) / scale).drop("_c", "_s")


def standardized_difference(
    df: DataFrame, keys: Sequence[str], arm: str, value: str, target: str = "a", out: str = "effect"
) -> DataFrame:
    """(mean_a - mean_b) / pooled SD; SD is 1 when an arm has fewer than two values, floor 1e-8."""
    a = F.col(arm) == target
    x = F.col(value)
    g = df.filter(x.isNotNull()).groupBy(*keys).agg(
        F.count_if(a).alias("n_a"),
        F.count_if(~a).alias("n_b"),
        F.avg(F.when(a, x)).alias("_ma"),
        F.avg(F.when(~a, x)).alias("_mb"),
        F.var_pop(F.when(a, x)).alias("_va"),
        F.var_pop(F.when(~a, x)).alias("_vb"),
    )
    ss = F.col("n_a") * F.col("_va") + F.col("n_b") * F.col("_vb")
    sd = F.greatest(F.lit(1e-8), F.sqrt(ss / F.greatest(F.lit(1), F.col("n_a") + F.col("n_b") - 2)))
    sd = F.when((F.col("n_a") < 2) | (F.col("n_b") < 2), F.lit(1.0)).otherwise(sd)
    diff = F.when((F.col("n_a") == 0) | (F.col("n_b") == 0), F.lit(0.0)).otherwise((F.col("_ma") - F.col("_mb")) / sd)
    return g.select(*keys, "n_a", "n_b", diff.alias(out))


def group_covariate_effect(
    df: DataFrame, keys: Sequence[str], group: str, value: str, covariate: str, min_group: int = 2
) -> DataFrame:
    """Covariate-adjusted group effect for every (key, group) against the rest.

    One aggregation reduces each (key, group) to counts and sums of products;
    "rest" is total minus group. Separate regression lines give the interaction
    model, a common slope gives ANCOVA: with a significant interaction
    (p < 0.05) the effect is the group coefficient at the mean covariate,
    otherwise the t statistic of the group term. Groups below ``min_group`` on
    either side, or without covariate spread, fall back to the standardised
    difference.
    """
    keys = list(keys)
    d = df.filter(F.col(value).isNotNull() & F.col(covariate).isNotNull())
    mean_c = d.groupBy(*keys).agg(F.avg(covariate).alias("_cbar"), F.avg(value).alias("_ybar"))
    x = attach(d, mean_c, keys).withColumn("_c", F.col(covariate) - F.col("_cbar")).withColumn(
        "_y", F.col(value) - F.col("_ybar")
    )
    per = x.groupBy(*keys, group).agg(
        F.count("*").cast("double").alias("n1"),
        F.sum("_c").alias("c1"),
        F.sum("_y").alias("y1"),
        F.sum(F.col("_c") * F.col("_c")).alias("cc1"),
        F.sum(F.col("_c") * F.col("_y")).alias("cy1"),
        F.sum(F.col("_y") * F.col("_y")).alias("yy1"),
    )
    names = ["n", "c", "y", "cc", "cy", "yy"]
    tot = per.groupBy(*keys).agg(*[F.sum(f"{k}1").alias(f"{k}t") for k in names])
    s = attach(per, tot, keys)
    for k in names:
        s = s.withColumn(f"{k}0", F.col(f"{k}t") - F.col(f"{k}1"))
    for i in "01":
        n = F.greatest(F.col(f"n{i}"), F.lit(1.0))
        s = (
            s.withColumn(f"cm{i}", F.col(f"c{i}") / n)
            .withColumn(f"ym{i}", F.col(f"y{i}") / n)
            .withColumn(f"sxx{i}", F.greatest(F.lit(0.0), F.col(f"cc{i}") - F.col(f"c{i}") * F.col(f"c{i}") / n))
            .withColumn(f"sxy{i}", F.col(f"cy{i}") - F.col(f"c{i}") * F.col(f"y{i}") / n)
            .withColumn(f"syy{i}", F.greatest(F.lit(0.0), F.col(f"yy{i}") - F.col(f"y{i}") * F.col(f"y{i}") / n))
        )
    c = F.col
    tiny = 1e-12
    spread = (c("sxx1") > tiny) & (c("sxx0") > tiny)
    slope = lambda i: c(f"sxy{i}") / c(f"sxx{i}")
    rss_full = F.greatest(
        F.lit(0.0), c("syy1") - c("sxy1") * slope(1) + c("syy0") - c("sxy0") * slope(0)
    )
    s2_full = rss_full / F.greatest(F.lit(1.0), c("nt") - 4)
    se_int = F.sqrt(F.greatest(F.lit(tiny), s2_full * (1 / c("sxx1") + 1 / c("sxx0"))))
    t_int = (slope(1) - slope(0)) / se_int
    at_mean = (c("ym1") - slope(1) * c("cm1")) - (c("ym0") - slope(0) * c("cm0"))
    sxx = c("sxx1") + c("sxx0")
    b = (c("sxy1") + c("sxy0")) / sxx
    effect = (c("ym1") - c("ym0")) - b * (c("cm1") - c("cm0"))
    rss = F.greatest(F.lit(0.0), c("syy1") + c("syy0") - b * (c("sxy1") + c("sxy0")))
    s2 = rss / F.greatest(F.lit(1.0), c("nt") - 3)
    gap = c("cm1") - c("cm0")
    se = F.sqrt(F.greatest(F.lit(tiny), s2 * (1 / c("n1") + 1 / c("n0") + gap * gap / sxx)))
    pooled = F.greatest(F.lit(1e-8), F.sqrt((c("syy1") + c("syy0")) / F.greatest(F.lit(1.0), c("nt") - 2)))
    pooled = F.when((c("n1") < 2) | (c("n0") < 2), F.lit(1.0)).otherwise(pooled)
    simple = F.when((c("n1") == 0) | (c("n0") == 0), F.lit(0.0)).otherwise((c("ym1") - c("ym0")) / pooled)
    small = (c("n1") < min_group) | (c("n0") < min_group) | ~spread
    kept = F.abs(t_int) > Z_TWO_SIDED_05
    model = F.when(small, "standardized_difference").when(kept, "interaction").otherwise("ancova")
    score = F.when(small, simple).when(kept, at_mean).otherwise(effect / se)
    return s.select(
        *keys, group, c("n1").cast("long").alias("n_group"), c("n0").cast("long").alias("n_rest"),
        model.alias("model"), score.alias("effect"),
    )


def residualize(df: DataFrame, keys: Sequence[str], y: str, x: str, mode: str = "subtract", lam: float = 1.0,
                out: str = "adjusted") -> DataFrame:
    """Remove a matched measurement: none, subtract lam*x, or residual of a no-intercept fit. Null x leaves y."""
    if mode == "none":
        return df.withColumn(out, F.col(y))
    if mode == "subtract":
        return df.withColumn(out, F.col(y) - F.lit(lam) * F.coalesce(x, F.lit(0.0)))
    if mode != "residual":
        raise ValueError(f"unknown adjustment {mode!r}")
    both = F.col(y).isNotNull() & F.col(x).isNotNull()
    xy = F.sum(F.when(both, F.col(x) * F.col(y)))
    xx = F.sum(F.when(both, F.col(x) * F.col(x)))
    fit = df.groupBy(*keys).agg(F.coalesce(F.when(xx > 0, xy / xx), F.lit(0.0)).alias("_b"))
    return attach(df, fit, keys).withColumn(out, F.col(y) - F.col("_b") * F.coalesce(x, F.lit(0.0))).drop("_b")


def quantile_floor(scores: DataFrame, keys: Sequence[str], q: float, score: str = "score") -> DataFrame:
    """Score at zero-based index floor(q*(n-1)) in ascending order, per key.

    Equal scores are counted first, so the ordered pass sees distinct values.
    """
    hist = scores.groupBy(*keys, F.col(score).alias("_x")).agg(F.count("*").alias("_c"))
    cum = sliced.cumulative(hist, keys, [F.col("_x").asc()], "_c", "_hi", "_n")
    at = F.floor(F.lit(float(q)) * (F.col("_n") - 1)) + 1
    hit = (F.col("_hi") >= at) & (F.col("_hi") - F.col("_c") < at)
    return cum.filter(hit).select(*keys, F.col("_x").alias("floor_score"))


def baseline_residual(
    scores: DataFrame, baseline: DataFrame, keys: Sequence[str], metric: str = "zscore", eps: float = 1e-6,
    floor_q: float = 0.95, use_log1p: bool = True,
) -> DataFrame:
    """Gene scores against an atlas baseline; genes without a baseline drop out.

    Rows under the key's raw-score quantile floor are set aside. zscore uses
    signed log1p values and the spread between median and median + MAD;
    logratio uses log1p of the non-negative parts and drops undefined ratios.
    """
    from lociweave.functions.scalars import signed_log1p

    kept = scores
    if floor_q > 0:
        kept = attach(scores, quantile_floor(scores, keys, floor_q), keys).filter(F.col("score") >= F.col("floor_score"))
    j = kept.join(baseline.select("gene_id", "median_score", "mad_score"), "gene_id")
    s, m, d = F.col("score"), F.col("median_score"), F.col("mad_score")
    if metric == "zscore":
        if use_log1p:
            spread = F.abs(signed_log1p(m + d) - signed_log1p(m))
            value = (signed_log1p(s) - signed_log1p(m)) / (spread + eps)
        else:
            value = (s - m) / (d + eps)
    elif metric == "logratio":
        part = (lambda x: F.log1p(F.greatest(x, F.lit(0.0)))) if use_log1p else (lambda x: x)
        top, bottom = part(s) + eps, part(m) + eps
        value = F.when((top > 0) & (bottom > 0), F.log(top / bottom))
    else:
        raise ValueError(f"unknown metric {metric!r}")
    return j.select(*keys, "gene_id", value.alias("score")).filter("score is not null")


# --- expression counts ---------------------------------------------------------------------


def pseudobulk(counts: DataFrame, cells: DataFrame, donor: str, columns: Sequence[str], min_cells: int = 1) -> DataFrame:
    """Sum counts per (donor x columns) x gene; sample id spells the key as ``a=b__c=d``."""
    parts = [donor, *columns]
    sid = F.concat_ws("__", *[F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in parts])
    c = cells.select("cell_id", *parts, sid.alias("sample_id"))
    sizes = c.groupBy("sample_id").agg(F.countDistinct("cell_id").alias("n_cells")).filter(F.col("n_cells") >= min_cells)
    summed = counts.join(c, "cell_id").groupBy("sample_id", *parts, "gene_id").agg(F.sum("value").alias("value"))
    return summed.join(sizes, "sample_id")


def cpm(counts: DataFrame, keys: Sequence[str] = (), sample: str = "sample_id") -> DataFrame:
    """Counts per million of the sample's library (floor 1) and log2(cpm + 0.5)."""
    by = [*keys, sample]
    lib = counts.groupBy(*by).agg(F.sum("value").alias("_lib"))
    size = F.when(F.col("_lib") <= 0, F.lit(1.0)).otherwise(F.col("_lib"))
    out = attach(counts, lib, by).withColumn("cpm", F.col("value") / size * 1e6)
    return out.withColumn("log_cpm", F.log2(F.col("cpm") + 0.5)).drop("_lib")


def expressed_genes(counts: DataFrame, members: DataFrame) -> DataFrame:
    """(comparison, gene) with CPM >= 1 in at least max(2, smaller arm) samples of either arm.

    ``members`` is the small (comparison_id, arm, sample_id) table.
    """
    arms = members.groupBy("comparison_id").agg(
        F.count_if(F.col("arm") == "a").alias("_a"), F.count_if(F.col("arm") == "b").alias("_b")
    )
    need = arms.select("comparison_id", F.greatest(F.lit(2), F.least("_a", "_b")).alias("_need"))
    c = cpm(counts).filter("cpm >= 1").join(members, "sample_id")
    hits = c.groupBy("comparison_id", "gene_id").agg(
        F.count_if(F.col("arm") == "a").alias("_a"), F.count_if(F.col("arm") == "b").alias("_b")
    )
    ok = F.greatest("_a", "_b") >= F.col("_need")
    return attach(hits, need, ["comparison_id"]).filter(ok).select("comparison_id", "gene_id")


def design_table(members: DataFrame, samples: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """Long design (comparison_id, sample_id, coef, x): intercept, group, covariates, dummies.

    Dummy levels are those present in a comparison, with the first level as base.
    """
    m = members.join(samples.select("sample_id", *numeric, *categorical), "sample_id")
    parts = [
        F.struct(F.lit("0:intercept").alias("coef"), F.lit(1.0).alias("x")),
        F.struct(F.lit("1:group").alias("coef"), (F.col("arm") == "a").cast("double").alias("x")),
    ]
    parts += [F.struct(F.lit(f"2:{c}").alias("coef"), F.col(c).cast("double").alias("x")) for c in numeric]
    parts += [
        F.struct(F.concat(F.lit(f"3:{c}="), F.col(c).cast("string")).alias("coef"), F.lit(1.0).alias("x")) for c in categorical
    ]
    long = m.select("comparison_id", "sample_id", F.explode(F.array(*parts)).alias("p")).select("comparison_id", "sample_id", "p.*")
    if not categorical:
        return long
    tag = F.split_part("coef", F.lit("="), F.lit(1))
    dummies = long.filter("coef like '3:%'").select("comparison_id", tag.alias("_t"), "coef")
    base = dummies.groupBy("comparison_id", "_t").agg(F.min("coef").alias("coef")).drop("_t")
    return long.join(base, ["comparison_id", "coef"], "left_anti")


def _xtx_inverse():
    """Grouped function: pseudo-inverse of one comparison's XtX, sized by its coefficients.

    A closure travels to the workers by value, so they need no copy of this package.
    """

    def invert(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["i"]) | set(pdf["j"]))
        at = {n: k for k, n in enumerate(names)}
        a = np.zeros((len(names), len(names)))
        a[pdf["i"].map(at), pdf["j"].map(at)] = pdf["v"]
        inv = np.linalg.pinv(a, hermitian=True)
        k = len(names)
        return pd.DataFrame({
            "comparison_id": pdf["comparison_id"].iloc[0],
            "i": np.repeat(names, k), "coef": np.tile(names, k), "inv": inv.ravel(), "p": k,
        })

    return invert


def _estimable():
    """Grouped function: rank of one comparison's Gram matrix, and whether its group coefficient can be told from the others."""

    def judge(pdf: pd.DataFrame) -> pd.DataFrame:
        names = sorted(set(pdf["i"]) | set(pdf["j"]))
        at = {n: k for k, n in enumerate(names)}
        a = np.zeros((len(names), len(names)))
        a[pdf["i"].map(at), pdf["j"].map(at)] = pdf["v"]
        # Columns of unit length, so that rank doesn't depend on units.
        size = np.sqrt(np.maximum(np.diag(a), 1e-300))
        values, vectors = np.linalg.eigh(a / np.outer(size, size))
        span = vectors[:, values > 1e-9 * len(names)]
        group = at.get("1:group")
        told = group is not None and bool(abs((span @ span[group])[group] - 1.0) < 1e-6) and a[group, group] > 0
        return pd.DataFrame({"comparison_id": [pdf["comparison_id"].iloc[0]], "coefficients": [len(names)], "rank": [span.shape[1]], "estimable": [told]})

    return judge


def estimability(design: DataFrame) -> DataFrame:
    """Per comparison: samples of either arm, coefficients, rank of the design, and whether the group effect is estimable.

    ``design`` is that of ``design_table``. A comparison with one arm, or whose
    groups differ exactly as a covariate does, is not estimable.
    """
    a = design.select("comparison_id", "sample_id", F.col("coef").alias("i"), F.col("x").alias("_x"))
    b = design.select("comparison_id", "sample_id", F.col("coef").alias("j"), F.col("x").alias("_z"))
    gram = a.join(b, ["comparison_id", "sample_id"]).groupBy("comparison_id", "i", "j").agg(F.sum(F.col("_x") * F.col("_z")).alias("v"))
    ranks = gram.groupBy("comparison_id").applyInPandas(_estimable(), "comparison_id string, coefficients long, rank long, estimable boolean")
    sizes = design.filter("coef = '1:group'").groupBy("comparison_id").agg(F.count_if(F.col("x") == 1.0).alias("n_a"), F.count_if(F.col("x") == 0.0).alias("n_b"))
    return sizes.join(ranks, "comparison_id")


def ols_group_effect(log_values: DataFrame, design: DataFrame, zero: float = math.log2(0.5)) -> DataFrame:
    """Group coefficient, t and residual variance of every gene in every comparison.

    Normal equations from two aggregations: XtX per comparison over samples and
    Xty per gene over measurements. Only the coefficient-sized XtX is inverted
    in Python. Measurements are shifted by ``zero``, the value of an absent
    count, so absent entries need no rows; the intercept absorbs the shift.
    """
    n = design.filter("coef = '0:intercept'").groupBy("comparison_id").agg(F.count("*").alias("n"))
    a = design.select("comparison_id", "sample_id", F.col("coef").alias("i"), F.col("x").alias("_x"))
    b = design.select("comparison_id", "sample_id", F.col("coef").alias("j"), F.col("x").alias("_z"))
    xtx = a.join(b, ["comparison_id", "sample_id"]).groupBy("comparison_id", "i", "j").agg(F.sum(F.col("_x") * F.col("_z")).alias("v"))
    inv = xtx.groupBy("comparison_id").applyInPandas(_xtx_inverse(), "comparison_id string, i string, coef string, inv double, p long")
    y = log_values.filter("log_cpm is not null").withColumn("_y", F.col("log_cpm") - F.lit(zero))
    # A comparison column on the values (genes kept per comparison) narrows the join.
    on = ["comparison_id", "sample_id"] if "comparison_id" in y.columns else ["sample_id"]
    wide = y.join(design, on).groupBy("comparison_id", "gene_id", "coef").agg(F.sum(F.col("x") * F.col("_y")).alias("xty"))
    sq = (
        y.join(design.filter("coef = '0:intercept'").drop("x", "coef"), on)
        .groupBy("comparison_id", "gene_id").agg(F.sum(F.col("_y") * F.col("_y")).alias("yty"), F.sum("_y").alias("_sy"))
    )
    beta = wide.join(inv, ["comparison_id", "coef"]).groupBy("comparison_id", "gene_id", "i", "p").agg(
        F.sum(F.col("inv") * F.col("xty")).alias("beta")
    )
    fit = beta.join(wide.withColumnRenamed("coef", "i"), ["comparison_id", "gene_id", "i"], "left").groupBy(
        "comparison_id", "gene_id", "p"
    ).agg(
        F.sum(F.col("beta") * F.coalesce("xty", F.lit(0.0))).alias("_fit"),
        F.max(F.when(F.col("i") == "1:group", F.col("beta"))).alias("effect"),
    )
    vg = inv.filter("i = '1:group' and coef = '1:group'").select("comparison_id", F.col("inv").alias("_vg"))
    out = fit.join(sq, ["comparison_id", "gene_id"]).join(vg, "comparison_id").join(n, "comparison_id")
    rss = F.greatest(F.lit(0.0), F.col("yty") - F.col("_fit"))
    sigma2 = rss / F.greatest(F.col("n") - F.col("p"), F.lit(1))
    se = F.sqrt(F.greatest(F.col("_vg") * sigma2, F.lit(1e-12)))
    return out.select(
        "comparison_id", "gene_id", "effect", (F.col("effect") / se).alias("stat"),
        (F.col("_sy") / F.col("n") + F.lit(zero)).alias("mean_expr"), "n",
    )


def pearson(df: DataFrame, keys: Sequence[str], a: str, b: str, out: str = "r") -> DataFrame:
    return df.groupBy(*keys).agg(F.corr(a, b).alias(out))
