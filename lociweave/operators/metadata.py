"""Sample metadata joins and alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_metadata(rows: DataFrame, extra: DataFrame, key: str = "sample_id", suffix: str = "_meta") -> DataFrame:
    """Left join of one metadata row per key; a clashing column keeps both, the joined one suffixed."""
    clash = [c for c in extra.columns if c != key and c in rows.columns]
    for c in clash:
        extra = extra.withColumnRenamed(c, f"{c}{suffix}")
    return rows.join(extra, key, "left")


def align(values: DataFrame, samples: DataFrame, key: str = "sample_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keep what both sides have; the third table counts kept and dropped samples."""
    have = values.select(key).distinct()
    meta = samples.select(key).distinct()
    both = have.join(meta, key)
    counts = have.withColumn("_v", F.lit(1)).join(meta.withColumn("_m", F.lit(1)), key, "full_outer").agg(
        F.count_if(F.col("_v").isNotNull() & F.col("_m").isNotNull()).alias("n_shared"),
        F.count_if(F.col("_m").isNull()).alias("n_values_only"), F.count_if(F.col("_v").isNull()).alias("n_metadata_only"),
    )
    return values.join(both, key, "left_semi"), samples.join(both, key, "left_semi"), counts
