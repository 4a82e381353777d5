"""Identifier resolution: version stripping, annotation, prioritised aliases, packed genes, orthologs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.joins import attach_count, attach_total


def resolve_gene_ids(rows: DataFrame, genes: DataFrame, gene: str = "gene_id") -> DataFrame:
    """Exact id, else its version-stripped form when that names one gene only, else dropped."""
    ids = genes.select(F.col("gene_id").alias("_exact")).distinct()
    short = (
        ids.groupBy(S.strip_version("_exact").alias("_short"))
        .agg(F.min("_exact").alias("_one"), F.max("_exact").alias("_other"))
        .filter("_one = _other")
        .select("_short", "_one")
    )
    joined = rows.join(ids, rows[gene] == ids["_exact"], "left").join(
        short, S.strip_version(rows[gene]) == short["_short"], "left"
    )
    resolved = F.coalesce("_exact", "_one")
    return joined.withColumn(gene, resolved).filter(F.col(gene).isNotNull()).drop("_exact", "_short", "_one")


def annotate_genes(rows: DataFrame, genes: DataFrame) -> DataFrame:
    """Fill missing symbol and biotype from a gene table; stripped ids only when unambiguous."""
    fields = F.struct(S.clean("gene_symbol").alias("s"), S.clean("gene_biotype").alias("b"))
    exact = genes.groupBy(F.col("gene_id").alias("_g")).agg(F.max(fields).alias("_e"))
    short = (
        exact.groupBy(S.strip_version("_g").alias("_sg"))
        .agg(F.min("_e").alias("_a"), F.max("_e").alias("_z"))
        .filter(F.col("_a") == F.col("_z"))
        .select("_sg", F.col("_a").alias("_n"))
    )
    j = rows.join(exact, rows["gene_id"] == exact["_g"], "left").join(
        short, S.strip_version(rows["gene_id"]) == short["_sg"], "left"
    )
    hit = F.when(F.col("_e").isNotNull(), F.col("_e")).otherwise(F.col("_n"))
    j = j.withColumn("_h", hit)
    symbol = S.clean("gene_symbol") if "gene_symbol" in rows.columns else F.lit(None).cast("string")
    biotype = S.clean("gene_biotype") if "gene_biotype" in rows.columns else F.lit(None).cast("string")
    return (
        j.withColumn("gene_symbol", F.coalesce(symbol, F.col("_h.s")))
        .withColumn("gene_biotype", F.coalesce(biotype, F.col("_h.b")))
        .drop("_g", "_e", "_sg", "_n", "_h")
    )


def promote_ids_to_symbols(
    rows: DataFrame, keys: Sequence[str] = (), missing_at_least: float = 0.7, ensembl_at_most: float = 0.7
) -> DataFrame:
    """Use gene ids as symbols when most symbols are missing and the ids do not look like Ensembl ids."""
    from lociweave.operators.joins import attach

    miss = S.clean("gene_symbol").isNull()
    stats = rows.groupBy(*keys).agg(
        F.avg(miss.cast("double")).alias("_m"), F.avg(S.ensembl_like("gene_id").cast("double")).alias("_e")
    )
    promote = (F.col("_m") >= missing_at_least) & (F.col("_e") <= ensembl_at_most) & miss
    return attach(rows, stats, keys).withColumn(
        "gene_symbol", F.when(promote, F.col("gene_id")).otherwise(F.col("gene_symbol"))
    ).drop("_m", "_e")


def first_alias(
    rows: DataFrame, aliases: DataFrame, candidates: Sequence[Column], row_id: Sequence[str],
    alias_key: str = "input_key", alias_columns: Sequence[str] = ("canonical_key",), how: str = "left",
) -> DataFrame:
    """Attach the alias of the first candidate key, in the given priority, that has one.

    Each row contributes one short candidate list; the match is a plain equi
    join on the candidate key and the best priority is a partial aggregate.
    """
    packed = F.struct(*alias_columns)
    alias = aliases.select(F.col(alias_key).alias("_cand"), packed.alias("_alias"))
    cand = rows.select(*row_id, F.posexplode(F.array(*candidates)).alias("_prio", "_cand")).filter(
        F.col("_cand").isNotNull() & (F.col("_cand") != "")
    )
    hits = cand.join(alias, "_cand").groupBy(*row_id).agg(F.min_by("_alias", "_prio").alias("_alias"))
    out = rows.join(hits, list(row_id), how)
    for c in alias_columns:
        out = out.withColumn(f"alias_{c}", F.col("_alias").getField(c))
    return out.drop("_alias")


def assign_genes(
    rows: DataFrame, ids: str | Column = "gene_id", symbols: str | Column = "gene_symbol", policy: str = "drop",
    split=S.packed_tokens,
) -> DataFrame:
    """Zip packed ids and symbols; several genes are dropped, cut to the first, or split 1/n."""
    i = split(F.col(ids) if isinstance(ids, str) else ids)
    s = split(F.col(symbols) if isinstance(symbols, str) else symbols)
    # The shorter list is padded with nulls; either name stands in for the other.
    out = rows.withColumn("_id", i).withColumn("_sym", s)
    out = out.withColumn("_pairs", F.arrays_zip("_id", "_sym")).withColumn("_n", F.size("_pairs")).drop("_id", "_sym")
    if policy == "drop":
        out = out.filter("_n = 1")
    elif policy == "first":
        out = out.withColumn("_pairs", F.slice("_pairs", 1, 1)).withColumn("_n", F.least("_n", F.lit(1)))
    elif policy != "split_equal":
        raise ValueError(f"unknown ambiguity policy {policy!r}")
    out = out.withColumn("_pair", F.explode("_pairs"))
    return (
        out.withColumn("gene_id", F.coalesce("_pair._id", "_pair._sym"))
        .withColumn("gene_symbol", F.coalesce("_pair._sym", "_pair._id"))
        .withColumn("gene_fraction", 1.0 / F.col("_n"))
        .drop("_pairs", "_pair", "_n")
    )


def map_feature_ids(
    rows: DataFrame, mapping: DataFrame, feature: str = "feature_id", unmapped: str = "keep", strip: bool = True
) -> DataFrame:
    """First mapping wins (by its ordinal); `Ensembl:X|` text is extracted; unmapped kept or dropped."""
    raw = F.col(feature)
    inner = F.regexp_extract(raw, r"Ensembl:([^|]+)", 1)
    key = F.when(inner != "", inner).otherwise(raw)
    key = S.strip_version(key) if strip else key
    source = S.strip_version("source_id") if strip else F.col("source_id")
    first = mapping.groupBy(source.alias("_k")).agg(F.min_by("target_id", "map_ordinal").alias("_t"))
    out = rows.withColumn("_k", key).join(first, "_k", "left")
    out = out.withColumn(feature, F.coalesce("_t", "_k")) if unmapped == "keep" else out.filter("_t is not null").withColumn(feature, F.col("_t"))
    return out.drop("_k", "_t")


def ortholog_scores(
    scores: DataFrame, orthologs: DataFrame, keys: Sequence[str], policy: str = "unique_only"
) -> DataFrame:
    """Map genes to the other species: by symbol, else by id; unique_only or expand_all with score/n."""
    o = orthologs.select("source_symbol", "source_id", "target_symbol").distinct()
    by_symbol = o.filter(S.clean("source_symbol").isNotNull()).select(F.col("source_symbol").alias("_k"), "target_symbol").distinct()
    by_id = o.filter(S.clean("source_id").isNotNull()).select(F.col("source_id").alias("_k"), "target_symbol").distinct()
    m_s = attach_count(by_symbol, ["_k"], "_n")
    m_i = attach_count(by_id, ["_k"], "_n")
    s = scores.withColumn("_sym", F.col("gene_symbol"))
    a = s.join(m_s, s["_sym"] == m_s["_k"]).drop("_k")
    rest = s.join(m_s.select("_k").distinct(), s["_sym"] == F.col("_k"), "left_anti")
    b = rest.join(m_i, rest["gene_id"] == m_i["_k"]).drop("_k")
    both = a.unionByName(b)
    if policy == "unique_only":
        both = both.filter("_n = 1")
    elif policy != "expand_all":
        raise ValueError(f"unknown ortholog policy {policy!r}")
    return both.groupBy(*keys, F.col("target_symbol").alias("gene_id")).agg(F.sum(F.col("score") / F.col("_n")).alias("score"))


def packed_edges(
    rows: DataFrame, source: str, packed: str, aliases: DataFrame | None = None, weight: Column | None = None,
    delimiters: str = ";,|", valid: str = r"^[A-Za-z0-9_.-]+$",
) -> DataFrame:
    """Edge table (source, gene_id, weight) from packed target text, L1-normalised per source."""
    tokens = rows.select(
        source, (weight if weight is not None else F.lit(1.0)).alias("_w"), S.packed_tokens(packed, delimiters).alias("_t")
    ).withColumn("_n", F.size("_t"))
    e = tokens.select(source, (F.col("_w") / F.col("_n")).alias("weight"), F.explode("_t").alias("gene_id"))
    e = e.filter(F.col("gene_id").rlike(valid))
    if aliases is not None:
        a = aliases.select(F.col("alias").alias("gene_id"), F.col("gene_symbol").alias("_to"))
        e = e.join(a, "gene_id", "left").withColumn("gene_id", F.coalesce("_to", "gene_id")).drop("_to")
    return normalize_edges(e, source)


def normalize_edges(edges: DataFrame, source: str, target: str = "gene_id", weight: str = "weight") -> DataFrame:
    """Sum repeated edges, then divide by the total absolute weight of the source."""
    merged = edges.groupBy(source, target).agg(F.sum(weight).alias(weight))
    total = attach_total(merged, [source], F.abs(weight), "_total")
    return total.filter("_total > 0").withColumn(weight, F.col(weight) / F.col("_total")).drop("_total")


def canonical_ids(rows: DataFrame, aliases: DataFrame, column: str, alias: str = "alias", target: str = "canonical") -> DataFrame:
    """Replace ids that have an alias entry (last entry wins by ordinal); others stay."""
    a = aliases.groupBy(F.col(alias).alias(column)).agg(F.max_by(target, "alias_ordinal").alias("_to"))
    return rows.join(a, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")


def chrom_spellings(rows: DataFrame, chroms: DataFrame, column: str = "chrom") -> DataFrame:
    """For each chromosome name of the rows its spelling ``_to`` in the gene table, names without a match left out.

    ``chroms`` is the chromosome list of the gene table, joined on the name
    without its prefix; an exact spelling is preferred.
    """
    bare = lambda c: F.regexp_replace(c, "^chr", "")
    named = chroms.select(F.col(column).alias("_to")).distinct()
    names = rows.select(column).distinct()
    pairs = names.join(named, bare(F.col(column)) == bare(F.col("_to")))
    exact_first = F.struct((F.col(column) != F.col("_to")).alias("x"), F.col("_to").alias("n"))
    return pairs.groupBy(column).agg(F.min_by("_to", exact_first).alias("_to"))


def harmonize_chrom(rows: DataFrame, chroms: DataFrame, column: str = "chrom") -> DataFrame:
    """Rename chromosomes to the spelling of the gene table (``chroms``); rows without a match drop out."""
    lookup = chrom_spellings(rows, chroms, column)
    return rows.join(lookup, column).withColumn(column, F.col("_to")).drop("_to")
