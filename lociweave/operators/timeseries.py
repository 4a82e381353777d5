"""Subject-level features from long (subject_id, t_hours, variable, value) traces."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociweave.functions.scalars import in_light
from lociweave.operators import sliced

# Intake variables that get an area under the curve.
INTAKE_VARIABLES = ("feed", "feed.acc", "drink", "drink.acc")


def analysis_window(trace: DataFrame, start: float | None = None, end: float | None = None) -> DataFrame:
    out = trace
    if start is not None:
        out = out.filter(F.col("t_hours") >= start)
    if end is not None:
        out = out.filter(F.col("t_hours") <= end)
    return out


def drop_excluded(trace: DataFrame, session: DataFrame | None = None, manual: DataFrame | None = None) -> DataFrame:
    """Session rows cut a subject after ``exc_hour``; manual rows from ``start_hour`` on, or wholly when null."""
    out = trace
    if session is not None:
        cut = session.filter("exc_hour is not null").groupBy("subject_id").agg(F.min("exc_hour").alias("_x"))
        out = out.join(cut, "subject_id", "left").filter("_x is null or t_hours <= _x").drop("_x")
    if manual is not None:
        first = manual.groupBy("subject_id").agg(
            F.min(F.coalesce(F.col("start_hour").cast("double"), F.lit(float("-inf")))).alias("_x")
        )
        out = out.join(first, "subject_id", "left").filter("_x is null or t_hours < _x").drop("_x")
    return out


def trapezoid_auc(trace: DataFrame, keys: Sequence[str], time: str = "t_hours", value: str = "value", tie: Sequence[str] = ()) -> DataFrame:
    """Trapezoid area per key over irregular samples; needs two samples, negative widths count as 0.

    The previous sample comes from the sliced lag, so one long trace is spread
    over many tasks.
    """
    t = trace.filter(F.col(value).isNotNull())
    order = [F.col(time).asc(), *[F.col(c).asc() for c in tie]]
    p = sliced.with_previous(t, keys, order, [time, value])
    width = F.greatest(F.lit(0.0), F.col(time) - F.col(f"prev_{time}"))
    area = width * (F.col(value) + F.col(f"prev_{value}")) / 2
    return p.groupBy(*keys).agg(F.sum(area).alias("auc"))


def subject_features(
    trace: DataFrame, keys: Sequence[str] = ("subject_id", "variable"), lights_on: float = 7.0, hours_light: float = 12.0,
    time: str = "t_hours", value: str = "value",
) -> DataFrame:
    """Mean, SD, light and dark means, dark - light, and the 24 h harmonic, in one aggregation."""
    v, t = F.col(value), F.col(time)
    light = in_light(time, lights_on, hours_light)
    angle = F.pmod(t, F.lit(24.0)) * (2.0 * math.pi / 24.0)
    g = trace.filter(v.isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg(v).alias("mean_selected"),
        F.stddev_samp(v).alias("sd_selected"),
        F.avg(F.when(light, v)).alias("mean_light"),
        F.avg(F.when(~light, v)).alias("mean_dark"),
        F.sum(v * F.cos(angle)).alias("_a"),
        F.sum(v * F.sin(angle)).alias("_b"),
    )
    a, b = F.col("_a") * 2 / F.col("n"), F.col("_b") * 2 / F.col("n")
    phase = F.atan2(b, a)
    enough = F.col("n") >= 3
    return (
        g.withColumn("dark_minus_light", F.col("mean_dark") - F.col("mean_light"))
        .withColumn("amp1", F.when(enough, F.sqrt(a * a + b * b)))
        .withColumn("phase1_cos", F.when(enough, F.cos(phase)))
        .withColumn("phase1_sin", F.when(enough, F.sin(phase)))
        .drop("_a", "_b")
    )


def feature_rows(features: DataFrame, auc: DataFrame | None = None) -> DataFrame:
    """Long (subject_id, feature, value) rows named ``<variable>_<feature>``; nulls drop out."""
    names = ["mean_selected", "sd_selected", "mean_light", "mean_dark", "dark_minus_light", "amp1", "phase1_cos", "phase1_sin"]
    src = features
    if auc is not None:
        intake = auc.filter(F.col("variable").isin(*INTAKE_VARIABLES)).withColumnRenamed("auc", "auc_selected")
        src = src.join(intake, ["subject_id", "variable"], "left")
        names = [*names, "auc_selected"]
    long = src.unpivot(["subject_id", "variable"], names, "_f", "value").filter("value is not null")
    return long.select("subject_id", "variable", F.concat_ws("_", "variable", "_f").alias("feature"), "value")


def choose_covariate(subjects: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate present in at least max(2, n // 2) subjects: one aggregate row is read."""
    row = subjects.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in candidates]).first()
    need = max(2, row["_n"] // 2)
    return next((c for c in candidates if row[c] >= need), None)
