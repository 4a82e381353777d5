"""Interval, gene and sparse-matrix readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.functions import idf
from lociweave.functions import scalars as S
from lociweave.operators import statistics as ST
from lociweave.sources.tables import last_per_key, numbered_lines, read_lines, read_table


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """BED rows with at least three fields; comments and blank lines skipped; extra fields kept as an array."""
    f = F.split("value", "\t")
    lines = read_lines(spark, path).filter((F.trim("value") != "") & ~F.col("value").startswith("#"))
    return lines.withColumn("f", f).filter(F.size("f") >= 3).select(
        F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("start"), F.col("f")[2].cast("long").alias("end"),
        F.slice(F.col("f"), F.lit(4), F.size("f")).alias("columns"), "row_ordinal",
    )


def with_feature_id(df: DataFrame) -> DataFrame:
    """Stable row identity from the row's place in its file."""
    return df.withColumn("feature_id", F.xxhash64("row_ordinal"))


def read_peak_weights(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    missing = {"chrom", "start", "end", "weight"} - set(t.columns)
    if missing:
        raise ValueError(f"peak weight table lacks {sorted(missing)}")
    t = t.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"),
                 S.soft_double("weight").alias("weight"), "row_ordinal")
    return last_per_key(t, ["chrom", "start", "end"])


def join_peak_weights(peaks: DataFrame, weights: DataFrame) -> DataFrame:
    """Attach weights by coordinates; a peak without a weight is an error."""
    j = peaks.join(weights, ["chrom", "start", "end"], "left")
    if not j.filter("weight is null").isEmpty():
        raise ValueError("peaks without a weight")
    return j


def _attribute(name: str) -> Column:
    return F.nullif(F.regexp_extract("attributes", rf'(?:^|;\s*){name} "?([^";]*)"?', 1), F.lit(""))


def read_gtf_genes(spark: SparkSession, path: str, id_field: str = "gene_id") -> DataFrame:
    """Gene records: 0-based half-open body, strand-aware TSS, file ordinal."""
    f = F.split("value", "\t")
    lines = read_lines(spark, path).filter(~F.col("value").startswith("#")).withColumn("f", f).filter((F.size("f") >= 9) & (F.col("f")[2] == "gene"))
    start0, end = F.col("f")[3].cast("long") - 1, F.col("f")[4].cast("long")
    strand = F.col("f")[6]
    g = lines.withColumn("attributes", F.col("f")[8])
    return g.select(
        _attribute(id_field).alias("gene_id"), _attribute("gene_name").alias("gene_symbol"), F.col("f")[0].alias("chrom"),
        F.when(strand == "+", start0).otherwise(end - 1).alias("tss"), strand.alias("strand"), start0.alias("gene_start"), end.alias("gene_end"),
        F.coalesce(_attribute("gene_type"), _attribute("gene_biotype")).alias("gene_biotype"), F.col("row_ordinal").alias("gene_ordinal"),
    ).filter("gene_id is not null")


def read_region_links(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    return t.select(
        S.clean("chrom").alias("chrom"), F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end"),
        S.clean("gene_id").alias("gene_id"), S.soft_double("link_weight").alias("link_weight"),
    ).filter("end > start and chrom is not null and gene_id is not null and link_weight is not null")


def _region(text: Column, part: int) -> Column:
    return F.nullif(F.regexp_extract(text, r"^([^:]+):(\d+)-(\d+)$", part), F.lit(""))


def read_10x_matrix(spark: SparkSession, folder: str, matrix: str = "matrix.mtx", barcodes: str = "barcodes.tsv", features: str = "peaks.bed") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, cells, features) of a MatrixMarket folder; entries carry the barcode and the coordinates' index."""
    lines = read_lines(spark, f"{folder}/{matrix}").filter(~F.col("value").startswith("%"))
    f = F.split(F.trim("value"), r"\s+")
    # The dimensions line is the first line that is not a comment.
    first = lines.agg(F.min("row_ordinal").alias("o")).scalar()
    e = lines.filter(F.col("row_ordinal") > first).withColumn("f", f).select(
        (F.col("f")[0].cast("long") - 1).alias("feature_index"), (F.col("f")[1].cast("long") - 1).alias("cell_index"), F.col("f")[2].cast("double").alias("value"),
    )
    cells = numbered_lines(spark, f"{folder}/{barcodes}").select(F.col("index").alias("cell_index"), F.split_part("value", F.lit("\t"), F.lit(1)).alias("cell_id"))
    p = numbered_lines(spark, f"{folder}/{features}").withColumn("f", F.split("value", "\t"))
    label = F.col("f")[0]
    packed = label.rlike(r"^[^:]+:\d+-\d+$")
    feats = p.select(
        F.col("index").alias("feature_id"),
        F.when(packed, _region(label, 1)).otherwise(label).alias("chrom"),
        F.when(packed, _region(label, 2)).otherwise(F.get("f", F.lit(1))).cast("long").alias("start"),
        F.when(packed, _region(label, 3)).otherwise(F.get("f", F.lit(2))).cast("long").alias("end"),
    )
    entries = e.join(cells, "cell_index").select(F.col("feature_index").alias("feature_id"), "cell_id", "value")
    return entries, cells.select("cell_id"), feats


def read_cell_groups(spark: SparkSession, cells: DataFrame, path: str | None = None, column: str = "group") -> DataFrame:
    """Cells with their group; without a table everything is in group 'all'."""
    if path is None:
        return cells.withColumn("group", F.lit("all"))
    g = read_table(spark, path).select(S.clean("barcode").alias("cell_id"), S.clean(column).alias("group"), "row_ordinal")
    return cells.join(last_per_key(g, ["cell_id"]), "cell_id", "left")


def read_cell_metadata(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    first = t.columns[0]
    return last_per_key(t.withColumnRenamed(first, "cell_id"), ["cell_id"])


def read_reference_ubiquity(spark: SparkSession, path: str, regions_path: str | None = None) -> DataFrame:
    """Reference peaks with an IDF: given, or ln((n+1)/(df+1))+1; coordinates own or by region id from a BED."""
    t = read_table(spark, path)
    has = lambda c: c in t.columns
    num = lambda c: S.soft_double(c) if has(c) else F.lit(None).cast("double")
    value = F.coalesce(num("idf_ref"), num("idf"), idf.peak_idf(num("df_ref"), num("n_ref")))
    if has("chrom"):
        out = t.select("chrom", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), value.alias("idf_ref"))
    else:
        b = read_bed(spark, regions_path).select("chrom", "start", "end", F.get("columns", F.lit(0)).alias("ccre_id"))
        out = t.select("ccre_id", value.alias("idf_ref")).join(b, "ccre_id").select("chrom", "start", "end", "idf_ref")
    return out.filter("end > start and idf_ref is not null")


def read_atlas_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Median and MAD per (score_definition, gene): given as columns, or computed from long scores."""
    t = read_table(spark, path)
    definition = S.clean("score_definition") if "score_definition" in t.columns else F.lit("default")
    if {"median_score", "mad_score"} <= set(t.columns):
        return t.select(definition.alias("score_definition"), "gene_id", S.soft_double("median_score").alias("median_score"), S.soft_double("mad_score").alias("mad_score"))
    long = t.select(definition.alias("score_definition"), "gene_id", S.soft_double("score").alias("score")).filter("score is not null")
    return ST.median_mad(long, ["score_definition", "gene_id"])


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """Upper-case gene tokens from the first column; a header-like first token is skipped."""
    tok = F.upper(F.trim(F.split_part(F.regexp_replace("value", ",", "\t"), F.lit("\t"), F.lit(1))))
    t = read_lines(spark, path).select(tok.alias("token"))
    return t.filter((F.col("token") != "") & ~F.col("token").startswith("#") & ~F.col("token").isin("GENE", "GENE_SYMBOL", "SYMBOL", "GENE_ID")).distinct()
