"""Joins of per-key summaries back onto rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def same_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where null matches null, as in a group or a window; keys come first, once."""
    renamed = other.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    rest = [c for c in df.columns if c not in keys]
    added = [c for c in other.columns if c not in keys]
    return df.join(renamed, on, how).select(*keys, *rest, *added)


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join one summary row per key onto ``df``.

    Used instead of an aggregate over a window: the summary is partially
    aggregated before its shuffle, the optimizer broadcasts it when its measured
    size allows, and adaptive execution splits a hot key of the row side
    otherwise. Without keys the summary is a single row, read as a scalar.
    """
    if keys:
        return same_keys(df, summary, keys, how)
    fields = summary.columns
    one = summary.select(F.struct(*fields).alias("s")).scalar()
    out = df.withColumn("_one", one)
    for f in fields:
        out = out.withColumn(f, F.col("_one").getField(f))
    return out.drop("_one")


def attach_total(df: DataFrame, keys: Sequence[str], value, out: str) -> DataFrame:
    """Sum of a column or expression per key, attached to every row."""
    expr = F.col(value) if isinstance(value, str) else value
    return attach(df, df.groupBy(*keys).agg(F.sum(expr).alias(out)), keys)


def attach_count(df: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    return attach(df, df.groupBy(*keys).agg(F.count("*").alias(out)), keys)
