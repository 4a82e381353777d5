"""Writers: gene-set tables, set lists, manifests and prior bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.functions import scalars as S


def write_gene_rows(rows: DataFrame, path: str, partition: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Gene rows as Parquet (canonical) or tab-separated text, one directory per partition value.

    Rows are spread by partition and gene, so a large program is written by many tasks.
    """
    w = rows.repartition(*partition, F.pmod(F.xxhash64("gene_id"), F.lit(32))) if partition else rows
    out = w.write.mode("overwrite").partitionBy(*partition)
    if fmt == "parquet":
        out.parquet(path)
    elif fmt == "tsv":
        out.option("sep", "\t").option("header", True).csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def gmt_lines(sets: DataFrame, layout: str = "dig2col") -> DataFrame:
    """One text line per set: `name<TAB>g1 g2` (dig2col) or `name<TAB>na<TAB>g1<TAB>g2` (classic)."""
    tab = F.lit("\t")
    if layout == "dig2col":
        return sets.select(F.concat("set_name", tab, F.concat_ws(" ", "genes")).alias("value"))
    if layout == "classic":
        return sets.select(F.concat("set_name", tab, F.lit("na"), tab, F.concat_ws("\t", "genes")).alias("value"))
    raise ValueError(f"unknown layout {layout!r}")


def write_gmt(sets: DataFrame, path: str, layout: str = "dig2col") -> None:
    gmt_lines(sets, layout).write.mode("overwrite").text(path)


def manifest(rows: DataFrame, keys: Sequence[str], root: str, label: Column | None = None) -> DataFrame:
    """One row per output group: id, label and directory."""
    parts = [F.concat(F.lit(f"{k}="), S.path_component(F.col(k).cast("string"))) for k in keys]
    place = F.concat_ws("/", F.lit(root), *parts)
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n_genes"))
    return counted.select(*keys, S.params_id(*keys).alias("geneset_id"), (label if label is not None else F.concat_ws("__", *parts)).alias("label"), place.alias("path"), "n_genes")


def write_bundle(tables: dict[str, DataFrame], root: str) -> None:
    """Prior tables side by side as Parquet."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
