"""Assay table readers: each returns typed long tables in the operators' column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.operators.identifiers import normalize_edges
from lociweave.sources.tables import (
    last_per_key, parseable, read_table, require_unique, resolve_column, resolve_columns, select_roles, unpivot_numeric,
)

# Accepted column names per role, in order of preference.
DE_ROLES = {
    "gene_id": ("gene_id",),
    "gene_symbol": ("gene_symbol", "gene_name"),
    "stat": ("stat",),
    "logfc": ("log2fc", "log2FoldChange", "logFC", "avg_log2FC"),
    "padj": ("padj", "FDR", "adj.P.Val"),
    "pvalue": ("pvalue", "PValue", "P.Value"),
    "gene_biotype": ("gene_biotype", "gene_type"),
}
SEGMENT_ROLES = {
    "chrom": ("chromosome", "chrom", "chr"),
    "start": ("start", "loc_start", "loc.start"),
    "end": ("end", "loc_end", "loc.end"),
    "amplitude": ("segment_mean", "segmean", "log2ratio", "log2_copy_ratio", "amplitude", "seg.mean"),
    "sample_id": ("sample", "sample_id", "tumor_sample_barcode", "ID"),
}
METHYLATION_ROLES = {
    "probe_id": ("probe_id",),
    "gene_id": ("gene_id",),
    "chrom": ("chrom",),
    "start": ("start",),
    "end": ("end",),
    "pos": ("pos",),
    "delta": ("delta_beta", "delta_methylation", "delta_meth", "delta"),
    "padj": ("padj", "fdr", "adj.p.val", "qvalue"),
    "pvalue": ("pvalue", "p_value", "p.val", "p"),
}
SITE_ROLES = {
    "site_id": ("site_id",),
    "site_group": ("site_group_id", "site_group"),
    "gene_id": ("gene_id",),
    "gene_symbol": ("gene_symbol", "gene_name"),
    "protein_accession": ("protein_accession", "accession", "uniprot_accession"),
    "residue": ("residue",),
    "position": ("position",),
    "stat": ("stat",),
    "logfc": ("log2fc", "logFC", "log2_fold_change"),
    "padj": ("padj", "FDR", "adj.P.Val"),
    "pvalue": ("pvalue", "PValue", "P.Value"),
    "localization_prob": ("localization_prob", "site_localization_prob"),
    "peptide_count": ("peptide_count", "n_peptides", "peptides"),
    "protein_logfc": ("protein_log2fc", "protein_logFC", "protein_logfc"),
    "protein_stat": ("protein_stat",),
}
EVENT_ROLES = {
    "event_id": ("event_id", "intron", "junction_id", "lsv_id", "Event", "splice_event_id", "as_id"),
    "event_group": ("event_group", "cluster", "cluster_id", "lsv_id"),
    "event_type": ("event_type", "event_class", "splice_type", "Type"),
    "gene_id": ("gene_id", "ensembl_gene_id", "GeneID"),
    "gene_symbol": ("gene_symbol", "gene_name", "gene", "Gene", "symbol"),
    "chrom": ("chrom", "chr", "Chromosome"),
    "start": ("start", "donor_start", "Start"),
    "end": ("end", "acceptor_end", "End"),
    "strand": ("strand", "Strand"),
    "stat": ("stat", "t", "z", "statistic", "dPSI_stat"),
    "delta_psi": ("delta_psi", "dpsi", "DeltaPsi", "dPSI", "deltaPsi", "deltapsi"),
    "padj": ("padj", "fdr", "qvalue", "adj_pvalue", "QValue", "p.adjust"),
    "pvalue": ("pvalue", "p_value", "pval", "PValue", "probability_pvalue"),
    "probability": ("probability", "posterior", "prob", "Probability", "confidence"),
    "read_support": ("read_support", "junction_reads", "coverage", "counts"),
    "novel_flag": ("novel_flag", "novel", "is_novel"),
    "annotation_status": ("annotation_status", "annotation", "status", "Complexity"),
}
CALORIMETRY_VARIABLES = {
    "vo2": ("vo2", "VO2"),
    "vco2": ("vco2", "VCO2"),
    "ee": ("ee", "EE"),
    "rer": ("rer", "RER"),
    "feed": ("feed", "food", "food.intake"),
    "feed.acc": ("feed.acc", "food.acc", "food.cumulative", "feed_acc"),
    "drink": ("drink", "water", "water.intake"),
    "drink.acc": ("drink.acc", "water.acc", "water.cumulative", "drink_acc"),
    "xytot": ("xytot", "XYTOT"),
    "xyamb": ("xyamb", "XYAMB"),
    "wheel": ("wheel",),
    "pedmeter": ("pedmeter",),
    "body.temp": ("body.temp", "body_temp", "Body.Temp"),
}
# Potency classes of compound targets.
POTENCY = {"high": 1.0, "medium": 0.9, "low": 0.8, "weak": 0.7, "primary": 1.0, "secondary": 0.8}

DE_NUMBERS = ("stat", "logfc", "padj", "pvalue")
SITE_NUMBERS = ("stat", "logfc", "padj", "pvalue", "localization_prob", "peptide_count", "protein_logfc", "protein_stat")
EVENT_NUMBERS = ("stat", "delta_psi", "padj", "pvalue", "probability", "read_support")


def read_de(spark: SparkSession, path: str, explicit: dict[str, str] | None = None, extra: Sequence[str] = (), score: str | None = None) -> DataFrame:
    t = read_table(spark, path)
    roles = resolve_columns(t.columns, DE_ROLES, explicit, ["gene_id"])
    if score:
        roles["score"] = resolve_column(t.columns, "score", (), score)
    roles.update({c: c for c in extra})
    return select_roles(t, roles, (*DE_NUMBERS, "score"))


def read_matrix(spark: SparkSession, path: str, orientation: str = "gene_by_sample", id_column: str | None = None, symbol_column: str | None = None, sep: str = "\t") -> DataFrame:
    """Dense matrix of either orientation to (sample_id, gene_id, value[, gene_symbol])."""
    t = read_table(spark, path, sep)
    first = id_column or t.columns[0]
    if orientation == "gene_by_sample":
        ids = [first] + ([symbol_column] if symbol_column else [])
        long = unpivot_numeric(t, ids, "sample_id").withColumnRenamed(first, "gene_id")
        return long.withColumnRenamed(symbol_column, "gene_symbol") if symbol_column else long
    return unpivot_numeric(t, [first], "gene_id").withColumnRenamed(first, "sample_id")


def read_peak_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Peak x sample matrix to (peak_id, sample_id, value); coordinate columns are left out."""
    t = read_table(spark, path)
    reserved = ("chrom", "start", "end", "name")
    key = "peak_id" if "peak_id" in t.columns else t.columns[0]
    return unpivot_numeric(t, [key], "sample_id", exclude=("row_ordinal", *reserved)).withColumnRenamed(key, "peak_id")


def read_program_loadings(spark: SparkSession, path: str, layout: str = "auto", gene_id: str = "gene_id", program: str = "program_id", value: str = "loading") -> DataFrame:
    """Loadings as (program, gene_id, score): long, genes x programs or programs x genes; repeats add up.

    ``auto`` looks at the header only: named long columns, else a gene column, else programs in rows.
    """
    t = read_table(spark, path)
    if layout == "auto":
        layout = "long" if {gene_id, program, value} <= set(t.columns) else "genes_by_programs" if gene_id in t.columns else "programs_by_genes"
    if layout == "long":
        out = t.select(S.clean(program).alias("program"), S.clean(gene_id).alias("gene_id"), S.soft_double(value, S.MISSING_SEGMENT).alias("score"))
    elif layout == "genes_by_programs":
        key = gene_id if gene_id in t.columns else t.columns[0]
        out = unpivot_numeric(t, [key], "program", "score", exclude=("row_ordinal", "gene_symbol"), missing=S.MISSING_SEGMENT).withColumnRenamed(key, "gene_id")
    else:
        key = t.columns[0]
        out = unpivot_numeric(t, [key], "gene_id", "score", missing=S.MISSING_SEGMENT).withColumnRenamed(key, "program")
        out = out.withColumn("program", F.when(F.col("program").rlike(r"^\d+$"), F.concat(F.lit("program_"), "program")).otherwise(F.col("program")))
    return out.filter("score is not null").groupBy("program", "gene_id").agg(F.sum("score").alias("score"))


def read_segments(spark: SparkSession, path: str, explicit: dict[str, str] | None = None, coordinates: str = "one_based_closed", prefix: str = "none") -> DataFrame:
    t = read_table(spark, path)
    roles = resolve_columns(t.columns, SEGMENT_ROLES, explicit, list(SEGMENT_ROLES), ignore_case=True)
    d = select_roles(t, roles, ("start", "end", "amplitude"), S.MISSING_SEGMENT)
    start = F.col("start").cast("long") - (1 if coordinates == "one_based_closed" else 0)
    return d.select(
        "sample_id", S.chrom_prefix("chrom", prefix).alias("chrom"), start.alias("start"), F.col("end").cast("long").alias("end"), "amplitude", "row_ordinal"
    ).filter("sample_id is not null and amplitude is not null and end > start")


def read_purity(spark: SparkSession, path: str, sample: str = "sample_id", purity: str = "purity") -> DataFrame:
    t = read_table(spark, path).select(S.clean(sample).alias("sample_id"), S.soft_double(purity, S.MISSING_SEGMENT).alias("purity"), "row_ordinal")
    return last_per_key(t.filter("sample_id is not null and purity is not null"), ["sample_id"])


def read_response(spark: SparkSession, path: str, sample: str = "sample_id", drug: str = "drug_id", response: str = "response") -> DataFrame:
    t = read_table(spark, path)
    return t.select(S.clean(sample).alias("sample_id"), S.clean(drug).alias("drug_id"), S.soft_double(response, S.MISSING_SEGMENT).alias("response")).filter(
        "sample_id is not null and drug_id is not null and response is not null"
    )


def read_prism_matrix(spark: SparkSession, path: str, treatments: DataFrame | None = None, sample: str = "row_name") -> DataFrame:
    """Wide cell line x treatment matrix to long responses; mapped columns take their drug id."""
    t = read_table(spark, path, ",")
    key = sample if sample in t.columns else t.columns[0]
    long = unpivot_numeric(t, [key], "column_name", "response", missing=S.MISSING_SEGMENT).withColumnRenamed(key, "sample_id")
    if treatments is None:
        return long.withColumnRenamed("column_name", "drug_id")
    m = treatments.select("column_name", F.col("drug_id").alias("_d")).dropDuplicates(["column_name"])
    return long.join(m, "column_name", "left").select("sample_id", F.coalesce("_d", "column_name").alias("drug_id"), "response")


def read_prism_treatments(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path, ",")
    drug = F.coalesce(S.clean("broad_id"), S.clean("name"), S.clean("column_name")) if "broad_id" in t.columns else S.clean("column_name")
    target = S.clean("target") if "target" in t.columns else F.lit(None).cast("string")
    return t.select("column_name", drug.alias("drug_id"), target.alias("target"))


def read_drug_targets(spark: SparkSession, path: str) -> DataFrame:
    """Drug -> gene edges; weight defaults to 1."""
    t = read_table(spark, path)
    gene = resolve_column(t.columns, "gene", ("gene_symbol", "gene_id"), required=True)
    weight = F.coalesce(S.soft_double("weight", S.MISSING_SEGMENT), F.lit(1.0)) if "weight" in t.columns else F.lit(1.0)
    return t.select(S.clean("drug_id").alias("drug_id"), S.clean(gene).alias("gene_id"), weight.alias("weight")).filter(
        "drug_id is not null and gene_id is not null"
    )


def read_sample_groups(spark: SparkSession, path: str, column: str = "group") -> DataFrame:
    t = read_table(spark, path).select(S.clean("sample_id").alias("sample_id"), S.clean(column).alias("group"), "row_ordinal")
    return last_per_key(t.filter("sample_id is not null and group is not null"), ["sample_id"])


def read_case_control(spark: SparkSession, path: str, column: str = "is_case") -> DataFrame:
    t = read_table(spark, path)
    v = F.lower(S.clean(column))
    flag = F.when(v.isin("1", "true", "t", "yes", "y", "case"), True).when(v.isin("0", "false", "f", "no", "n", "control"), False)
    return t.select(S.clean("sample_id").alias("sample_id"), flag.alias("is_case")).filter("is_case is not null")


def read_mapping(spark: SparkSession, path: str, source: str, target: str, out_source: str = "alias", out_target: str = "canonical") -> DataFrame:
    """Two-column mapping; the last row of a key wins."""
    t = read_table(spark, path).select(S.clean(source).alias(out_source), S.clean(target).alias(out_target), "row_ordinal")
    return last_per_key(t.filter(F.col(out_source).isNotNull()), [out_source])


def _cpg_span(position: Column, zero_based: bool) -> tuple[Column, Column]:
    if zero_based:
        return position, position + 1
    return F.greatest(F.lit(0), position - 1), position


def read_cpg(spark: SparkSession, path: str, manifest: str | None = None, zero_based: bool = False) -> DataFrame:
    """CpG table with coordinates from chrom/start/end, else chrom/pos, else the probe manifest."""
    t = read_table(spark, path)
    roles = resolve_columns(t.columns, METHYLATION_ROLES, None, ["delta"], ignore_case=True)
    d = select_roles(t, roles, ("start", "end", "pos", "delta", "padj", "pvalue"))
    for c, kind in (("chrom", "string"), ("start", "double"), ("end", "double"), ("pos", "double"), ("probe_id", "string")):
        if c not in d.columns:
            d = d.withColumn(c, F.lit(None).cast(kind))
    own = F.col("chrom").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull()
    at = F.col("chrom").isNotNull() & F.col("pos").isNotNull()
    if manifest is not None:
        m = read_table(spark, manifest)
        m = last_per_key(m.select(S.clean("probe_id").alias("probe_id"), S.clean("chrom").alias("_mc"), S.soft_double("pos").alias("_mp"), "row_ordinal"), ["probe_id"])
        d = d.join(m, "probe_id", "left")
    else:
        d = d.withColumn("_mc", F.lit(None).cast("string")).withColumn("_mp", F.lit(None).cast("double"))
    p = F.when(at, F.col("pos")).otherwise(F.col("_mp")).cast("long")
    s, e = _cpg_span(p, zero_based)
    return d.withColumn("_s", F.when(own, F.col("start").cast("long")).otherwise(s)).withColumn(
        "_e", F.when(own, F.col("end").cast("long")).otherwise(e)
    ).withColumn("chrom", F.when(own | at, F.col("chrom")).otherwise(F.col("_mc"))).drop("start", "end", "pos", "_mc", "_mp").withColumnRenamed(
        "_s", "start"
    ).withColumnRenamed("_e", "end").filter("chrom is not null and end > start")


def read_dmr(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    d = select_roles(t, resolve_columns(t.columns, METHYLATION_ROLES, None, ["delta"], ignore_case=True), ("start", "end", "delta", "padj", "pvalue"))
    return d.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long")).filter("chrom is not null and end > start")


def read_profiles(spark: SparkSession, path: str, id_column: str = "sample_id", metadata_prefix: str = "Metadata_") -> DataFrame:
    """Profile table (TSV, CSV or Parquet) to (id, feature, value).

    Columns with the metadata prefix are left out. Rows that hold no number drop
    out, and with them columns without any, wherever their first number stands.
    """
    if path.endswith(".parquet"):
        t = spark.read.parquet(path)
    else:
        t = read_table(spark, path, "," if path.endswith((".csv", ".csv.gz")) else "\t")
    cand = [c for c in t.columns if c not in (id_column, "row_ordinal") and not c.startswith(metadata_prefix)]
    if not cand:
        return t.select(F.col(id_column).cast("string").alias("id"), F.lit("").alias("feature"), F.lit(0.0).alias("value")).limit(0)
    # Pairs of name and value, so that names with dots or underscores stay what they are.
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), S.soft_double(F.col(f"`{c}`")).alias("value")) for c in cand])
    return t.select(F.col(id_column).cast("string").alias("id"), F.inline(pairs)).filter("value is not null")


def assay_multiplier(columns: Sequence[str]) -> Column:
    """(.5 + .5 confidence) x .75 for secondary targets x potency class, clamped to [.25, 1]."""
    m = F.lit(1.0)
    conf = [S.soft_double(c) for c in ("confidence", "source_confidence") if c in columns]
    if conf:
        c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(*conf)))
        m = m * F.coalesce(0.5 + 0.5 * c, F.lit(1.0))
    if "primary_target" in columns:
        m = m * F.when(F.lower(F.trim("primary_target")).isin("0", "false", "f", "no", "n", "secondary"), 0.75).otherwise(1.0)
    if "potency_bucket" in columns:
        p = F.lower(F.trim("potency_bucket"))
        scale = F.lit(1.0)
        for name, v in POTENCY.items():
            scale = F.when(p == name, v).otherwise(scale)
        m = m * scale
    return F.greatest(F.lit(0.25), F.least(F.lit(1.0), m))


def read_compound_targets(spark: SparkSession, path: str) -> DataFrame:
    """Compound -> gene edges from strict or packed target tables, L1 per compound."""
    t = read_table(spark, path)
    compound = resolve_column(t.columns, "compound", ("compound_id", "broad_id", "perturbation_id"), required=True)
    gene = resolve_column(t.columns, "target", ("gene_symbol", "targets", "target"), required=True)
    w = F.coalesce(S.soft_double("weight"), F.lit(1.0)) if "weight" in t.columns else F.lit(1.0)
    e = t.select(S.clean(compound).alias("compound_id"), (w * assay_multiplier(t.columns)).alias("weight"), F.explode(S.packed_tokens(gene, ";,|")).alias("gene_id"))
    return normalize_edges(e.filter("compound_id is not null and weight > 0"), "compound_id")


def read_sites(spark: SparkSession, path: str, explicit: dict[str, str] | None = None) -> DataFrame:
    t = read_table(spark, path)
    return select_roles(t, resolve_columns(t.columns, SITE_ROLES, explicit), SITE_NUMBERS)


def event_tool(columns: Sequence[str]) -> str:
    """Which event caller wrote the table, from its header."""
    c = set(columns)
    if {"intron", "cluster"} & c and ("deltapsi" in c or "cluster" in c):
        return "leafcutter"
    if "lsv_id" in c:
        return "majiq"
    if {"DeltaPsi", "Complexity"} & c and "Event" in c:
        return "whippet"
    if {"as_id", "splice_event_id"} & c:
        return "tcga_spliceseq"
    return "generic"


def read_events(spark: SparkSession, path: str, explicit: dict[str, str] | None = None) -> DataFrame:
    t = read_table(spark, path)
    d = select_roles(t, resolve_columns(t.columns, EVENT_ROLES, explicit), EVENT_NUMBERS, S.MISSING_SEGMENT)
    return d.withColumn("tool_family", F.lit(event_tool(t.columns)))


def backfill_cluster_p(events: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster p-values for events that have none of their own."""
    c = clusters.groupBy("event_group").agg(F.min("pvalue").alias("_p"))
    j = events.join(c, "event_group", "left")
    own = F.col("pvalue") if "pvalue" in events.columns else F.lit(None).cast("double")
    return j.withColumn("pvalue", F.coalesce(own, "_p")).drop("_p")


def read_prior(spark: SparkSession, path: str, key: str, numeric: Sequence[str] = ()) -> DataFrame:
    """Prior table keyed by one column; the last row of a key wins."""
    t = read_table(spark, path)
    cols = [S.soft_double(c).alias(c) if c in numeric else S.clean(c).alias(c) for c in t.columns if c != "row_ordinal"]
    return last_per_key(t.select(*cols, "row_ordinal").filter(F.col(key).isNotNull()), [key])


def read_calorimetry(spark: SparkSession, path: str) -> DataFrame:
    """CSV trace to (subject_id, variable, t_hours, value); hours from hour/day, else the timestamp, else the row's number in the file from 0."""
    from lociweave.operators.sliced import ranked

    t = read_table(spark, path, ",")
    numbered = ranked(t.select("row_ordinal"), [], [F.col("row_ordinal").asc()], "_n").select("row_ordinal", (F.col("_n") - 1).cast("double").alias("_index"))
    t = t.join(numbered, "row_ordinal")
    q = lambda c: F.col(f"`{c}`")
    subject = resolve_column(t.columns, "subject", ("subject.id", "subject_id", "id"), required=True)
    hour = resolve_column(t.columns, "hour", ("exp.hour", "exp_hour", "hour"))
    day = resolve_column(t.columns, "day", ("exp.day", "exp_day", "day"))
    stamp = resolve_column(t.columns, "time", ("Date.Time", "date_time", "datetime", "timestamp"))
    null = F.lit(None).cast("double")
    num = lambda c: S.soft_double(q(c), S.MISSING_CALORIMETRY) if c else null
    h, d = num(hour), num(day)
    ts = S.parse_time(q(stamp)) if stamp else F.lit(None).cast("timestamp")
    from_ts = F.hour(ts) + F.minute(ts) / 60.0 + (F.dayofmonth(ts) - 1) * 24.0
    when = F.coalesce(h + (F.coalesce(d, F.lit(1.0)) - 1) * 24.0, from_ts, F.col("_index"))
    found = {v: resolve_column(t.columns, v, names) for v, names in CALORIMETRY_VARIABLES.items()}
    cols = [num(c).alias(v) for v, c in found.items() if c]
    names = [v for v, c in found.items() if c]
    wide = t.select(S.clean(q(subject)).alias("subject_id"), when.alias("t_hours"), *cols).filter("subject_id is not null")
    return wide.unpivot(["subject_id", "t_hours"], [F.col(f"`{n}`") for n in names], "variable", "value").filter("value is not null")


def read_session(spark: SparkSession, path: str) -> DataFrame:
    """Session table to subjects with group, mass and window columns; long (`group` labels) or wide (`groupN` id lists)."""
    t = read_table(spark, path, ",")
    wide = [c for c in t.columns if c.startswith("group") and c[5:].isdigit()]
    num = lambda c, n: S.soft_double(F.col(f"`{c}`"), S.MISSING_CALORIMETRY).alias(n)
    extra = {
        "total_mass": ("Total.Mass", "total.mass", "total_mass", "subject.mass", "body_mass"),
        "lean_mass": ("Lean.Mass", "lean.mass", "lean_mass"),
        "fat_mass": ("Fat.Mass", "fat.mass", "fat_mass"),
        "exc_hour": ("exc",),
        "window_start": ("analysis_start_hour",),
        "window_end": ("analysis_end_hour",),
        "lights_on": ("lights_on_hour",),
    }
    cols = {n: resolve_column(t.columns, n, c) for n, c in extra.items()}
    base = t.select(S.clean("id").alias("subject_id"), *[num(c, n) for n, c in cols.items() if c], *[F.col(w) for w in wide])
    if "group_names" not in t.columns:
        g = wide[0] if wide else resolve_column(t.columns, "group", ("group", "Group"), required=True)
        label = S.clean(g) if g in base.columns else F.lit("all")
        return base.withColumn("group", label).drop(*wide).filter("subject_id is not null")
    # Wide layout: column groupN lists member ids; the N-th non-blank group_names entry is its label.
    members = t.unpivot([], [F.col(w) for w in wide], "_g", "subject_id").filter(S.clean("subject_id").isNotNull())
    from lociweave.operators.sliced import ranked

    labels = ranked(t.filter(S.clean("group_names").isNotNull()).select("group_names", "row_ordinal"), [], [F.col("row_ordinal").asc()], "_n")
    m = members.select(S.clean("subject_id").alias("subject_id"), F.regexp_extract("_g", r"(\d+)$", 1).cast("long").alias("_n"))
    named = m.join(labels.select("_n", F.trim("group_names").alias("group")), "_n", "left").select("subject_id", F.coalesce("group", F.concat(F.lit("group"), "_n")).alias("group"))
    return base.drop(*wide).filter("subject_id is not null").join(named.dropDuplicates(["subject_id"]), "subject_id", "left")


def read_exclusions(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    s = resolve_column(t.columns, "subject", ("subject_id", "subject.id"), required=True)
    h = resolve_column(t.columns, "hour", ("start_hour", "hour_start"))
    hour = S.soft_double(h) if h else F.lit(None).cast("double")
    return t.select(S.clean(F.col(f"`{s}`")).alias("subject_id"), hour.alias("start_hour")).filter("subject_id is not null")


def read_edges(spark: SparkSession, path: str, columns: dict[str, str], weight: str | None = None) -> DataFrame:
    """Ontology templates, gene edges, hierarchies and ortholog tables: named text columns and an optional weight."""
    t = read_table(spark, path)
    cols = [S.clean(src).alias(dst) for src, dst in columns.items()]
    if weight:
        cols.append(F.coalesce(S.soft_double(weight), F.lit(1.0)).alias("weight") if weight in t.columns else F.lit(1.0).alias("weight"))
    return t.select(*cols)


def undirected(hierarchy: DataFrame, parent: str = "parent_id", child: str = "child_id") -> DataFrame:
    a = hierarchy.select(F.col(parent).alias("term_id"), F.col(child).alias("neighbour_id"))
    return a.unionByName(hierarchy.select(F.col(child).alias("term_id"), F.col(parent).alias("neighbour_id"))).distinct()


def read_ptm_report(spark: SparkSession, path: str, site: str = "Phosphosite") -> DataFrame:
    """Public site report to (site_label, gene_symbol, sample_id, value); pooled channels are dropped."""
    t = read_table(spark, path)
    meta = {site, "Peptide", "Gene", "Organism", "Description", "Protein", "row_ordinal"}
    cols = [c for c in t.columns if c not in meta and not c.upper().startswith("POOL")]
    typed = t.select(S.clean(site).alias("site_label"), S.clean("Gene").alias("gene_symbol"), *[S.soft_double(F.col(f"`{c}`")).alias(c) for c in cols])
    return typed.unpivot(["site_label", "gene_symbol"], [F.col(f"`{c}`") for c in cols], "sample_id", "value").filter("value is not null")


def read_proteome_report(spark: SparkSession, path: str) -> DataFrame:
    """Public protein report to (gene_symbol, sample_id, value); summary rows, pools and unshared ratios are dropped."""
    t = read_table(spark, path)
    cols = [c for c in t.columns if c not in {"Gene", "Protein", "Description", "row_ordinal"} and "Unshared" not in c and not c.upper().startswith("POOL")]
    typed = t.filter(~F.lower("Gene").isin("mean", "median", "stddev")).select(S.clean("Gene").alias("gene_symbol"), *[S.soft_double(F.col(f"`{c}`")).alias(c) for c in cols])
    return typed.unpivot(["gene_symbol"], [F.col(f"`{c}`") for c in cols], "sample_id", "value").filter("value is not null")


def parse_site_labels(rows: DataFrame, column: str = "site_label", ptm_type: str = "phospho") -> DataFrame:
    """Accession, residue and position of `ACCESSION:S12` labels.

    One site gives a site id; several give a group id listing them by position;
    anything else falls back to the cleaned label.
    """
    text = F.trim(column)
    acc = F.nullif(F.regexp_extract(text, r"^([A-Za-z0-9_.-]+)\s*[:|]\s*(.+)$", 1), F.lit(""))
    tail = F.when(acc.isNotNull(), F.regexp_extract(text, r"^([A-Za-z0-9_.-]+)\s*[:|]\s*(.+)$", 2)).otherwise(text)
    found = F.regexp_extract_all(F.col("_tail"), F.lit(r"([A-Z]\s*[0-9]+)"), 1)
    as_struct = F.transform(found, lambda t: F.struct(F.regexp_extract(t, r"(\d+)$", 1).cast("long").alias("p"), F.substring(t, 1, 1).alias("r")))
    out = rows.withColumn("protein_accession", acc).withColumn("_tail", tail).withColumn("_t", F.array_sort(F.array_distinct(as_struct)))
    n, known = F.size("_t"), F.col("protein_accession").isNotNull()
    single, group = known & (n == 1), known & (n > 1)
    one = F.get("_t", F.lit(0))
    kind = F.lit(ptm_type)
    site = F.when(single, F.concat_ws("|", "protein_accession", one["r"], one["p"].cast("string"), kind))
    names = F.array_join(F.transform("_t", lambda x: F.concat(x["r"], x["p"].cast("string"))), ";")
    grouped = F.when(group, F.concat_ws("|", "protein_accession", names, kind))
    raw = F.concat(F.lit("raw::"), S.path_component(column), F.lit("|"), kind)
    return out.select(
        *rows.columns, site.alias("site_id"), F.coalesce(site, grouped, raw).alias("site_group_id"), "protein_accession",
        F.when(single, one["r"]).alias("residue"), F.when(single, one["p"]).alias("position"),
        F.when(single, "single_site").when(group, "site_group").otherwise("unparsed_fallback").alias("site_status"), F.greatest(n, F.lit(1)).alias("n_sites"),
    )


def read_sample_annotations(spark: SparkSession, path: str, key: str = "sample_id", id_map: DataFrame | None = None) -> DataFrame:
    """Annotations with an optional id map; a repeated sample is an error."""
    t = read_table(spark, path).withColumn("sample_id", S.clean(key)).drop("row_ordinal")
    if id_map is not None:
        t = t.join(id_map.select(F.col("alias").alias("sample_id"), F.col("canonical").alias("_to")), "sample_id", "left")
        t = t.withColumn("sample_id", F.coalesce("_to", "sample_id")).drop("_to")
    return require_unique(t.filter("sample_id is not null"), ["sample_id"], "sample_id")


def read_stability(spark: SparkSession, path: str) -> DataFrame:
    t = read_table(spark, path)
    k = resolve_column(t.columns, "k", ("k", "K", "n_components"), required=True)
    s = resolve_column(t.columns, "stability", ("stability", "silhouette"), required=True)
    run = F.col("run_id") if "run_id" in t.columns else F.lit("run")
    return t.select(run.alias("run_id"), S.soft_double(k).cast("long").alias("k"), S.soft_double(s).alias("stability")).filter("k is not null and stability is not null")


def read_counts(spark: SparkSession, path: str, gene: str = "gene_id", cell: str = "barcode", value: str = "count") -> DataFrame:
    t = read_table(spark, path)
    return t.select(S.clean(gene).alias("gene_id"), S.clean(cell).alias("cell_id"), S.soft_double(value).alias("value")).filter("gene_id is not null and value is not null")
