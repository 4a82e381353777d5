"""Group and condition contrasts over long (feature_id, sample/cell, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.joins import attach


def _summary(mode: str, total: Column, nonzero: Column, cells: Column) -> Column:
    n = F.greatest(cells, F.lit(1))
    picks = {"sum": total, "mean": total / n, "frac_nonzero": nonzero / n}
    if mode not in picks:
        raise ValueError(f"unknown summary {mode!r}")
    return picks[mode]


def cell_counts(cells: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Cells per group, from the cell table and not from the non-zero entries."""
    return cells.groupBy(*groups).agg(F.countDistinct("cell_id").alias("n_cells"))


def group_summary(
    entries: DataFrame, cells: DataFrame, mode: str = "mean", feature: str = "feature_id", group: str = "group"
) -> DataFrame:
    """sum, mean or frac_nonzero per (group, feature); absent entries count as zero."""
    grouped = entries.join(cells.filter(F.col(group).isNotNull()).select("cell_id", group), "cell_id")
    agg = grouped.groupBy(group, feature).agg(
        F.sum("value").alias("_s"), F.count_if(F.col("value") != 0).cast("double").alias("_z")
    )
    return attach(agg, cell_counts(cells, [group]), [group]).select(
        group, feature, _summary(mode, F.col("_s"), F.col("_z"), F.col("n_cells")).alias("score")
    )


def group_vs_rest(
    entries: DataFrame, cells: DataFrame, mode: str = "mean", feature: str = "feature_id", group: str = "group"
) -> DataFrame:
    """Group and rest summaries per (group, feature) in one pass over the entries.

    rest = all - group, where "all" includes cells without a group. A feature
    seen anywhere is reported for every group.
    """
    joined = entries.join(cells.select("cell_id", group), "cell_id", "left")
    per = joined.groupBy(group, feature).agg(
        F.sum("value").alias("_s"), F.count_if(F.col("value") != 0).cast("double").alias("_z")
    )
    total = per.groupBy(feature).agg(F.sum("_s").alias("_ts"), F.sum("_z").alias("_tz"))
    sizes = cell_counts(cells.filter(F.col(group).isNotNull()), [group])
    everyone = cells.agg(F.countDistinct("cell_id").alias("_all"))
    # The result has one row per feature and group; the group list is as long as the design.
    listed = sizes.agg(F.collect_list(F.struct(group, "n_cells"))).scalar()
    grid = total.withColumn("_g", F.explode(listed)).select("*", "_g.*").drop("_g")
    out = attach(grid, everyone, []).join(per, [group, feature], "left")
    s, z = F.coalesce("_s", F.lit(0.0)), F.coalesce("_z", F.lit(0.0))
    return out.select(
        group,
        feature,
        _summary(mode, s, z, F.col("n_cells")).alias("group_score"),
        _summary(mode, F.col("_ts") - s, F.col("_tz") - z, F.col("_all") - F.col("n_cells")).alias("rest_score"),
    )


def condition_within_group(
    entries: DataFrame,
    cells: DataFrame,
    condition_a: str,
    condition_b: str,
    mode: str = "mean",
    feature: str = "feature_id",
    group: str = "group",
    condition: str = "condition",
    donor: str | None = None,
    min_cells_group: int = 100,
    min_cells_condition: int = 50,
    min_donors_condition: int = 3,
    min_donors_total: int = 3,
) -> DataFrame:
    """Arm a and arm b summaries inside each group that passes the size gates."""
    two = cells.filter(F.col(condition).isin(condition_a, condition_b) & F.col(group).isNotNull())
    is_a, is_b = F.col(condition) == condition_a, F.col(condition) == condition_b
    aggs = [
        F.count_if(is_a).alias("n_a"),
        F.count_if(is_b).alias("n_b"),
    ]
    gate = (F.col("n_a") + F.col("n_b") >= min_cells_group) & (F.least("n_a", "n_b") >= min_cells_condition)
    if donor:
        aggs += [
            F.countDistinct(F.when(is_a, F.col(donor))).alias("_da"),
            F.countDistinct(F.when(is_b, F.col(donor))).alias("_db"),
            F.countDistinct(donor).alias("_dt"),
        ]
        gate = gate & (F.least("_da", "_db") >= min_donors_condition) & (F.col("_dt") >= min_donors_total)
    sizes = two.groupBy(group).agg(*aggs).filter(gate)
    j = entries.join(two.select("cell_id", group, condition), "cell_id")
    nz = F.col("value") != 0
    agg = j.groupBy(group, feature).agg(
        F.sum(F.when(is_a, F.col("value")).otherwise(0.0)).alias("_sa"),
        F.sum(F.when(is_b, F.col("value")).otherwise(0.0)).alias("_sb"),
        F.count_if(is_a & nz).cast("double").alias("_za"),
        F.count_if(is_b & nz).cast("double").alias("_zb"),
    )
    return attach(agg, sizes.select(group, "n_a", "n_b"), [group]).select(
        group,
        feature,
        _summary(mode, F.col("_sa"), F.col("_za"), F.col("n_a")).alias("score_a"),
        _summary(mode, F.col("_sb"), F.col("_zb"), F.col("n_b")).alias("score_b"),
    )


def contrast_value(a, b, stat: str = "log2fc", pseudocount: float = 1.0) -> Column:
    if stat == "log2fc":
        return S.log2_ratio(a, b, pseudocount)
    if stat == "diff":
        return (F.col(a) if isinstance(a, str) else a) - (F.col(b) if isinstance(b, str) else b)
    raise ValueError(f"unknown contrast statistic {stat!r}")


def default_pseudocount(mode: str) -> float:
    """Fractions use 1e-3, sums and means use 1."""
    return 1e-3 if mode == "frac_nonzero" else 1.0


def open_close(contrast: DataFrame, value: str = "score") -> DataFrame:
    """Split a signed contrast into OPEN (positive part) and CLOSE (negative part) directions."""
    d = F.explode(F.array(F.lit("OPEN"), F.lit("CLOSE")))
    out = contrast.withColumn("direction", d)
    part = F.when(F.col("direction") == "OPEN", F.greatest(F.col(value), F.lit(0.0))).otherwise(
        F.greatest(-F.col(value), F.lit(0.0))
    )
    return out.withColumn(value, part).filter(F.col(value) > 0)


# --- contrasts as a small table of levels -------------------------------------------------


def level_contrasts(samples: DataFrame, kind: str, column: str, a: str | None = None, b: str | None = None,
                    within: str | None = None, reference: str | None = None) -> DataFrame:
    """Membership of sample levels in contrast arms: (contrast_id, arm, <level columns>).

    Levels are distinct values of ``column`` (and ``within``), so the table is
    as small as the design and measurements are aggregated per level first.
    kinds: baseline, condition_a_vs_b, group_vs_rest, condition_within_group,
    reference_level.
    """
    cols = [c for c in (within, column) if c]
    lv = samples.filter(F.col(column).isNotNull()).select(*cols).distinct()
    if kind == "baseline":
        return lv.select(F.lit("baseline").alias("contrast_id"), F.lit("a").alias("arm"), *cols)
    if kind in ("condition_a_vs_b", "condition_within_group"):
        arm = F.when(F.col(column) == a, "a").when(F.col(column) == b, "b")
        name = f"{a}_vs_{b}"
        cid = F.concat(F.col(within), F.lit("__" + name)) if within else F.lit(name)
        return lv.select(cid.alias("contrast_id"), arm.alias("arm"), *cols).filter("arm is not null")
    targets = samples.agg(F.collect_set(column)).scalar()  # as long as the design has levels
    spread = lv.withColumn("_t", F.explode(targets))
    if kind == "group_vs_rest":
        return spread.select(
            F.concat(F.col("_t"), F.lit("_vs_rest")).alias("contrast_id"),
            F.when(F.col(column) == F.col("_t"), "a").otherwise("b").alias("arm"),
            *cols,
        )
    if kind == "reference_level":
        pairs = spread.filter(F.col("_t") != reference).filter(
            (F.col(column) == F.col("_t")) | (F.col(column) == reference)
        )
        return pairs.select(
            F.concat(F.col("_t"), F.lit(f"_vs_{reference}")).alias("contrast_id"),
            F.when(F.col(column) == F.col("_t"), "a").otherwise("b").alias("arm"),
            *cols,
        )
    raise ValueError(f"unknown contrast kind {kind!r}")


def _named(column: str, of: Column | str, to: Column | str, strata: Sequence[str]) -> Column:
    """``column=of_vs_to`` and the strata by name."""
    parts = [F.lit(f"{column}="), of if isinstance(of, Column) else F.lit(of), F.lit("_vs_"), to if isinstance(to, Column) else F.lit(to)]
    for s in sorted(strata):
        parts += [F.lit(f"__{s}="), F.col(s)]
    return F.concat(*parts)


def _text(column: str) -> Column:
    return F.trim(F.coalesce(F.col(column).cast("string"), F.lit("")))


def stratified_contrasts(samples: DataFrame, kind: str, column: str, strata: Sequence[str] = (), a: str | None = None, b: str | None = None, reference: str | None = None) -> DataFrame:
    """Samples in the arms of one design made anew in every stratum: (comparison_id, arm, sample_id).

    kinds: condition_a_vs_b, group_vs_rest (``a`` against all others), and
    reference_level (each other level against ``reference``). A stratum lacking
    a level that the design needs gives no comparison. Levels and strata are
    trimmed text; samples without a level take no part; an empty stratum value
    is a stratum. Only levels are compared with levels, never samples with
    samples.
    """
    # Without strata the whole design is one.
    s = samples.select("sample_id", _text(column).alias("_level"), F.lit("").alias("_all"), *[_text(c).alias(c) for c in strata]).filter("_level <> ''")
    keys = ["_all", *strata]
    levels = s.select("_level", *keys).distinct()
    have = levels.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
    if kind == "condition_a_vs_b":
        made = have.filter(F.array_contains("_levels", a) & F.array_contains("_levels", b)).select(*keys, F.lit(a).alias("_a"), F.array(F.lit(b)).alias("_b"), _named(column, a, b, strata).alias("comparison_id"))
    elif kind == "group_vs_rest":
        rest = F.array_remove("_levels", a)
        made = have.filter(F.array_contains("_levels", a) & (F.size(rest) > 0)).select(*keys, F.lit(a).alias("_a"), rest.alias("_b"), _named(column, a, "rest", strata).alias("comparison_id"))
    elif kind == "reference_level":
        each = have.filter(F.array_contains("_levels", reference)).withColumn("_a", F.explode(F.array_remove("_levels", reference)))
        made = each.select(*keys, "_a", F.array(F.lit(reference)).alias("_b"), _named(column, F.col("_a"), reference, strata).alias("comparison_id"))
    else:
        raise ValueError(f"unknown contrast kind {kind!r}")
    arm = F.when(F.col("_level") == F.col("_a"), "a").when(F.array_contains("_b", F.col("_level")), "b")
    member = levels.join(made, keys).select(*keys, "_level", "comparison_id", arm.alias("arm")).filter("arm is not null")
    return s.join(member, [*keys, "_level"]).select("comparison_id", "arm", "sample_id")


def comparison_table(comparisons: DataFrame, samples: DataFrame, default_column: str | None = None, strata: Sequence[str] = ()) -> DataFrame:
    """Samples in the arms of written comparisons: (comparison_id, arm, sample_id).

    ``comparisons`` has comparison_id and group_a, and may have group_column,
    group_b and columns named like strata. Without group_b, all other levels
    are the other arm. A stratum value that is given narrows both arms; an
    empty one doesn't. Rows without an id are left out.
    """
    if missing := {"comparison_id", "group_a"} - set(comparisons.columns):
        raise ValueError(f"comparisons lack {sorted(missing)}")
    given = lambda c, other: _text(c) if c in comparisons.columns else F.lit(other)
    column = given("group_column", "")
    c = comparisons.select(
        _text("comparison_id").alias("comparison_id"), F.when(column == "", F.lit(default_column)).otherwise(column).alias("_column"),
        _text("group_a").alias("_a"), given("group_b", "").alias("_b"), *[given(x, "").alias(f"_want_{x}") for x in strata]).filter("comparison_id <> ''")
    # The columns of a sample table are few; each becomes (column, level) rows that comparisons meet by equality.
    names = [x for x in samples.columns if x != "sample_id"]
    long = samples.select("sample_id", *[_text(x).alias(f"_have_{x}") for x in strata], F.inline(F.array(*[F.struct(F.lit(x).alias("_column"), _text(x).alias("_level")) for x in names]))).filter("_level <> ''")
    on = [long["_column"] == c["_column"]] + [(c[f"_want_{x}"] == "") | (c[f"_want_{x}"] == long[f"_have_{x}"]) for x in strata]
    arm = F.when(F.col("_level") == F.col("_a"), "a").when((F.col("_b") == "") | (F.col("_level") == F.col("_b")), "b")
    return long.join(c, on).select("comparison_id", arm.alias("arm"), "sample_id").filter("arm is not null")


def infer_two_levels(samples: DataFrame, column: str) -> tuple[str, str]:
    """The two levels of a two-level design column, ordered; anything else is an error."""
    levels = [r[0] for r in samples.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(3).collect()]
    if len(levels) != 2:
        raise ValueError(f"{column} must have exactly two levels")
    return levels[1], levels[0]


def arm_moments(values: DataFrame, samples: DataFrame, contrasts: DataFrame, feature: str = "feature_id",
                sample: str = "sample_id", value: str = "value") -> DataFrame:
    """n, mean and sum of squared deviations per (contrast, feature, arm).

    Values are reduced to per-level moments first; only those are repeated
    across contrasts, and moments of several levels are merged exactly.
    """
    levels = [c for c in contrasts.columns if c not in ("contrast_id", "arm")]
    v = values.filter(F.col(value).isNotNull()).join(samples.select(sample, *levels), sample)
    per = v.groupBy(feature, *levels).agg(
        F.count("*").alias("_n"), F.avg(value).alias("_m"), (F.var_pop(value) * F.count("*")).alias("_q")
    )
    m = per.join(contrasts, levels)
    by = ["contrast_id", feature, "arm"]
    means = m.groupBy(*by).agg(F.sum("_n").alias("n"), (F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).alias("mean"))
    # Deviations are taken from the mean before they are squared: sums of squares of large values would cancel.
    off = F.col("_m") - F.col("mean")
    m2 = attach(m, means, by).groupBy(*by).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), F.sum(F.col("_q") + F.col("_n") * off * off).alias("m2"))
    return m2


def two_arm_statistic(moments: DataFrame, feature: str = "feature_id", stat: str = "welch_t", min_present: int = 2) -> DataFrame:
    """Mean difference or Welch t per (contrast, feature) with both arms present often enough."""
    pick = lambda arm, c: F.max(F.when(F.col("arm") == arm, F.col(c)))
    wide = moments.groupBy("contrast_id", feature).agg(
        *[pick(arm, c).alias(f"{c}_{arm}") for arm in ("a", "b") for c in ("n", "mean", "m2")]
    )
    wide = wide.filter((F.col("n_a") >= min_present) & (F.col("n_b") >= min_present))
    diff = F.col("mean_a") - F.col("mean_b")
    var = lambda arm: F.when(F.col(f"n_{arm}") > 1, F.col(f"m2_{arm}") / (F.col(f"n_{arm}") - 1)).otherwise(0.0)
    se = F.sqrt(var("a") / F.col("n_a") + var("b") / F.col("n_b"))
    out = wide.withColumn("effect", diff)
    if stat == "welch_t":
        out = out.withColumn("stat", F.when(se > 0, diff / se).otherwise(0.0))
    elif stat == "mean_diff":
        out = out.withColumn("stat", diff)
    else:
        raise ValueError(f"unknown statistic {stat!r}")
    return out.drop("m2_a", "m2_b")


def baseline_mean(moments: DataFrame, feature: str = "feature_id") -> DataFrame:
    return moments.filter("arm = 'a'").select("contrast_id", feature, F.col("mean").alias("stat"), F.col("n").alias("n_a"))


def comparison_audit(samples: DataFrame, contrasts: DataFrame, unit: str | None = None, sample: str = "sample_id") -> DataFrame:
    """Samples and distinct units per arm with the imbalance ratio, one row per contrast."""
    levels = [c for c in contrasts.columns if c not in ("contrast_id", "arm")]
    j = samples.join(contrasts, levels)
    arm = lambda a: F.when(F.col("arm") == a, F.col(sample))
    u = lambda a: F.when(F.col("arm") == a, F.col(unit or sample))
    out = j.groupBy("contrast_id").agg(
        F.countDistinct(arm("a")).alias("n_a"),
        F.countDistinct(arm("b")).alias("n_b"),
        F.countDistinct(u("a")).alias("units_a"),
        F.countDistinct(u("b")).alias("units_b"),
    )
    return out.withColumn("imbalance", F.greatest("n_a", "n_b") / F.greatest(F.least("n_a", "n_b"), F.lit(1)))


def significance_counts(results: DataFrame, padj: str = "padj", effect: str = "effect", at_most: float = 0.05) -> DataFrame:
    hit = F.col(padj) <= at_most
    return results.groupBy("contrast_id").agg(
        F.count("*").alias("n_tested"),
        F.count_if(hit).alias("n_significant"),
        F.count_if(hit & (F.col(effect) > 0)).alias("n_up"),
        F.count_if(hit & (F.col(effect) < 0)).alias("n_down"),
    )


def resolve_condition_pair(cells: DataFrame, condition: str = "condition", donor: str | None = None) -> DataFrame:
    """Cells and donors per condition."""
    aggs = [F.countDistinct("cell_id").alias("n_cells")]
    if donor:
        aggs.append(F.countDistinct(donor).alias("n_donors"))
    return cells.filter(F.col(condition).isNotNull()).groupBy(condition).agg(*aggs)
