"""Deterministic hash-rank sampling, balancing, fixpoint filtering and curve selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.joins import attach
from lociweave.operators.selection import top_k
from lociweave.session import discard, materialize


def hash_order(ids: Sequence[str], seed: int) -> list[Column]:
    """Pseudo-random but repeatable order of rows, ids breaking hash ties."""
    return [F.xxhash64(F.lit(seed), *[F.col(c).cast("string") for c in ids]).asc(), *[F.col(c).asc() for c in ids]]


def cap_per_bucket(df: DataFrame, bucket: Sequence[str], ids: Sequence[str], cap: int, seed: int = 0, min_rows: int = 0) -> DataFrame:
    """Keep at most ``cap`` rows of every bucket by hash rank; buckets below ``min_rows`` drop out."""
    out = df
    if min_rows:
        big = df.groupBy(*bucket).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_rows).drop("_n")
        out = out.join(big, list(bucket), "left_semi")
    return top_k(out, bucket, cap, hash_order(ids, seed), "_r").drop("_r")


def balance_arms(members: DataFrame, keys: Sequence[str] = ("comparison_id",), arm: str = "arm", sample: str = "sample_id", seed: int = 0) -> DataFrame:
    """Downsample the larger arm of each comparison to the smaller one's size."""
    from lociweave.operators.sliced import ranked

    sizes = members.groupBy(*keys, arm).agg(F.count("*").alias("_n")).groupBy(*keys).agg(F.min("_n").alias("_cut"))
    r = ranked(members, [*keys, arm], hash_order([sample], seed), "_r")
    return attach(r, sizes, keys).filter(F.col("_r") <= F.col("_cut")).drop("_r", "_cut")


def fixpoint_filter(
    entries: DataFrame, min_cell_total: float, min_gene_total: float, rounds: int = 6, cell: str = "cell_id", gene: str = "gene_id"
) -> DataFrame:
    """Repeat cell-total and gene-total filters until nothing changes, at most ``rounds`` times; zero genes drop out.

    From the second round on only cells that lost an entry, and genes of cells
    that were dropped, are added up again; the totals of all others still hold.
    """
    low_cell = ~(F.col("_t") >= min_cell_total)
    low_gene = ~((F.col("_t") >= min_gene_total) & (F.col("_t") > 0))

    def low(rows: DataFrame, key: str, rule: Column) -> DataFrame:
        return materialize(rows.groupBy(key).agg(F.sum("value").alias("_t")).filter(rule).select(key))

    def judged(rows: DataFrame, genes: DataFrame) -> DataFrame:
        flagged = rows.join(genes.withColumn("_low", F.lit(True)), gene, "left")
        return materialize(flagged.select(*rows.columns, (F.col("_low").isNull() & F.col(gene).isNotNull()).alias("_stays")))

    if rounds < 1:
        return materialize(entries.filter("value <> 0"))
    start = materialize(entries.filter("value <> 0").filter(F.col(cell).isNotNull()))
    rows = materialize(start.join(low(start, cell, low_cell), cell, "left_anti").select(*start.columns))
    discard(start)
    state = judged(rows, low(rows.filter(F.col(gene).isNotNull()), gene, low_gene))
    discard(rows)
    for _ in range(rounds - 1):
        kept, lost = state.filter("_stays").drop("_stays"), state.filter("not _stays")
        cells = low(kept.join(lost.select(cell).distinct(), cell, "left_semi"), cell, low_cell)
        if cells.isEmpty():
            break
        rows = kept.join(cells, cell, "left_anti").select(*kept.columns)
        touched = kept.join(cells, cell, "left_semi").select(gene).distinct()
        before, state = state, judged(rows, low(rows.join(touched, gene, "left_semi"), gene, low_gene))
        discard(before)
    return state.filter("_stays").drop("_stays")


def select_k(curve: DataFrame, run: str = "run_id", min_stability: float = 0.0, fraction: float = 0.95) -> DataFrame:
    """Largest k that is a local maximum with stability >= max(min, fraction * max), else the most stable k.

    A curve has one row per tried k, a handful per run, so runs fit one task each.
    """
    w = Window.partitionBy(run).orderBy("k")
    s = F.col("stability")
    c = curve.select(
        run, "k", "stability",
        F.lag("stability").over(w).alias("_l"),
        F.lead("stability").over(w).alias("_r"),
    )
    best = c.groupBy(run).agg(F.max("stability").alias("_max"))
    c = attach(c, best, [run])
    local = (s >= F.coalesce("_l", s)) & (s >= F.coalesce("_r", s))
    ok = local & (s >= F.greatest(F.lit(min_stability), F.col("_max") * fraction))
    return c.groupBy(run).agg(
        F.coalesce(F.max(F.when(ok, F.col("k"))), F.max(F.when(s == F.col("_max"), F.col("k")))).alias("k")
    )
