"""Public study reports to standard matrices, sample tables and bundle source rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.selection import rank_rows
from lociweave.plans.splicing import canonical_key, event_type
from lociweave.sources.assays import parse_site_labels


def sample_ids(names: DataFrame, column: str = "sample_id_raw") -> DataFrame:
    """Clean sample ids; a repeated clean name gets _2, _3, ... in raw-name order. Pools are flagged."""
    n = names.select(F.col(column).alias("sample_id_raw")).distinct().withColumn("_n", S.path_component("sample_id_raw"))
    r = rank_rows(n, ["_n"], [F.col("sample_id_raw").asc()], "_r")
    sid = F.when(F.col("_r") == 1, F.col("_n")).otherwise(F.concat_ws("_", "_n", "_r"))
    pool = F.lower("sample_id_raw").contains("pool")
    return r.select("sample_id_raw", sid.alias("sample_id"), F.when(pool, "dropped_pool_reference").otherwise("kept").alias("drop_status"))


def condition_of(sample_type: str | Column) -> Column:
    """Case or control from a sample type; anything else stays open."""
    t = F.lower(F.trim(F.col(sample_type) if isinstance(sample_type, str) else sample_type))
    return F.when(t.isin("normal", "control", "adjacent_normal"), "control").when(t.isin("tumor", "case", "treated"), "case")


def standard_samples(names: DataFrame, annotations: DataFrame, study_id: str, design: DataFrame | None = None) -> DataFrame:
    """Kept samples with condition (given, else derived), group (given, else the study) and design columns."""
    s = sample_ids(names).filter("drop_status = 'kept'").drop("drop_status")
    if design is not None:
        s = s.join(design, "sample_id_raw", "left")
    s = s.join(annotations, "sample_id_raw", "left")
    has = lambda c: S.clean(c) if c in s.columns else F.lit(None).cast("string")
    return s.withColumn("condition", F.coalesce(has("condition"), condition_of(has("sample_type")))).withColumn(
        "group", F.coalesce(has("group"), F.lit(study_id))).withColumn("study_id", F.lit(study_id))


def ptm_standardize(values: DataFrame, annotations: DataFrame, study_id: str, ptm_type: str = "phospho", design: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(site values, site table, samples) of a long public report (site_label, gene_symbol, sample_id, value)."""
    names = values.select(F.col("sample_id").alias("sample_id_raw")).distinct()
    samples = standard_samples(names, annotations, study_id, design)
    sites = parse_site_labels(values.select("site_label", "gene_symbol").distinct(), ptm_type=ptm_type)
    v = values.withColumnRenamed("sample_id", "sample_id_raw").join(samples.select("sample_id_raw", "sample_id"), "sample_id_raw")
    long = v.join(sites.select("site_label", "gene_symbol", "site_group_id"), ["site_label", "gene_symbol"]).select(
        F.col("site_group_id").alias("feature_id"), "sample_id", "value")
    return long, sites, samples


def header_samples(columns: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Sample id and condition from PSI headers: a `_Norm` suffix marks the adjacent normal."""
    raw = F.col("sample_id_raw")
    out = columns.select("sample_id_raw", F.regexp_replace(raw, "_Norm$", "").alias("sample_id"), F.when(raw.endswith("_Norm"), "adjacent_normal").otherwise("tumor").alias("condition"))
    if id_map is not None:
        m = id_map.select(F.col("alias").alias("sample_id"), F.col("canonical").alias("_to"))
        out = out.join(m, "sample_id", "left").withColumn("sample_id", F.coalesce("_to", "sample_id")).drop("_to")
    return out


def backfill_events(events: DataFrame, metadata: DataFrame, key: str = "event_id") -> DataFrame:
    """Fill columns an event lacks from the metadata row of the same id; own values stay."""
    m = metadata.dropDuplicates([key])
    out = events.join(m.select(key, *[F.col(c).alias(f"_m_{c}") for c in m.columns if c != key]), key, "left")
    for c in m.columns:
        if c == key:
            continue
        own = S.clean(c) if c in events.columns else F.lit(None).cast("string")
        out = out.withColumn(c, F.coalesce(own, F.col(f"_m_{c}").cast("string"))).drop(f"_m_{c}")
    return out


def splice_standardize(events: DataFrame, psi: DataFrame, samples: DataFrame, study_id: str, allowed: list[str] | None = None, missing: str = "drop") -> tuple[DataFrame, DataFrame]:
    """(event table, bundle source rows) from event columns and long PSI (event_id, sample_id_raw, psi).

    Missing PSI rows are dropped or kept as null.
    """
    e = canonical_key(events.withColumn("event_type", event_type("event_type")))
    if allowed:
        e = e.filter(F.col("event_type").isin(*allowed))
    status = F.when(F.col("confidence") == "high", "coordinate_canonical").when(F.col("confidence") == "medium", "source_family_stable_id").otherwise("raw_id_fallback")
    e = e.withColumn("canonicalization_status", status)
    rows = psi.join(samples.select("sample_id_raw", "sample_id"), "sample_id_raw")
    if missing == "drop":
        rows = rows.filter("psi is not null")
    cols = ["event_id", "event_group", "event_type", "gene_id", "gene_symbol", "annotation_status"]
    out = rows.join(e.select(*cols, "record_key", "confidence", "canonicalization_status", "namespace", *[c for c in ("row_ordinal",) if c in e.columns]), "event_id")
    return e, out.select(
        F.lit(study_id).alias("source_dataset"), "sample_id", F.col("event_id").alias("input_event_key"), F.col("record_key").alias("canonical_event_key"), "canonicalization_status",
        F.col("confidence").alias("canonicalization_confidence"), F.col("namespace").alias("event_key_namespace"), *cols[1:], "psi", *[c for c in ("row_ordinal",) if c in out.columns],
    )
