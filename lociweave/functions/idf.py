"""Inverse-frequency weights. Five assays use five different formulas; do not merge them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def peak_idf(df, n) -> Column:
    """Peaks over cells, and reference ubiquity: ln((N+1)/(df+1)) + 1."""
    return F.log((_c(n) + 1) / (_c(df) + 1)) + 1


def target_idf(frequency, n_drugs) -> Column:
    """Drug targets: ln((n_drugs+1)/(f+1))."""
    return F.log((_c(n_drugs) + 1) / (_c(frequency) + 1))


def site_idf(df, n_sources) -> Column:
    """Modification sites: ln((n_sources+1)/(df+1))."""
    return F.log((_c(n_sources) + 1) / (_c(df) + 1))


def event_idf(d, n_datasets) -> Column:
    """Splice events: ln(1 + (D+1)/(d+1)) over datasets."""
    return F.log(F.lit(1.0) + (_c(n_datasets) + 1) / (_c(d) + 1))


def gene_recurrence_idf(c, n) -> Column:
    """Image-profile genes: ln((n+1)/(c+1)) / ln(n+1)."""
    return F.log((_c(n) + 1) / (_c(c) + 1)) / F.log(_c(n) + 1)
