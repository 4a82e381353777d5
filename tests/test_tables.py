"""Readers and writers on small files."""

import gzip

import pytest
from pyspark.sql import functions as F

from lociweave.functions import scalars as S
from lociweave.plans import public_tables as PUB
from lociweave.sinks import tables as OUT
from lociweave.sources import assays as A
from lociweave.sources import genomic as G
from lociweave.sources import tables as T
from lociweave.session import scratch_root


def put(path, text):
    path.write_text(text)
    return str(path)


class _Session:
    """The parts of a session that the scratch folder depends on."""

    def __init__(self, master, configured=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: configured or default)})
        self.sparkContext = type("Ctx", (), {"master": master, "applicationId": "t", "getCheckpointDir": staticmethod(lambda: None)})


def test_scratch_follows_the_session_setting(spark):
    assert scratch_root(_Session("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert scratch_root(_Session("local[2]")).startswith("/tmp/")
    with pytest.raises(RuntimeError):
        scratch_root(_Session("yarn"))


def test_bed_and_gzip(spark, tmp_path):
    text = "# head\nchr1\t900\t1100\tp1\t2.0\n\nchr1\t5\nchr2\t1\t2\n"
    plain = G.read_bed(spark, put(tmp_path / "a.bed", text))
    assert [(r["chrom"], r["start"], r["end"], list(r["columns"])) for r in plain.orderBy("row_ordinal").collect()] == [
        ("chr1", 900, 1100, ["p1", "2.0"]), ("chr2", 1, 2, [])]
    with gzip.open(tmp_path / "b.bed.gz", "wt") as fh:
        fh.write(text)
    assert G.read_bed(spark, str(tmp_path / "b.bed.gz")).count() == 2


def test_gtf(spark, tmp_path):
    text = (
        '#!x\nchr1\ts\tgene\t1001\t2000\t.\t+\t.\tgene_id "GENE1"; gene_name "G1"; gene_type "protein_coding";\n'
        'chr1\ts\texon\t1001\t1100\t.\t+\t.\tgene_id "GENE1";\nchr1\ts\tgene\t5001\t6200\t.\t-\t.\tgene_id "GENE2"; gene_biotype "lncRNA";\n'
    )
    g = {r["gene_id"]: r for r in G.read_gtf_genes(spark, put(tmp_path / "a.gtf", text)).collect()}
    assert (g["GENE1"]["gene_start"], g["GENE1"]["gene_end"], g["GENE1"]["tss"], g["GENE1"]["gene_biotype"]) == (1000, 2000, 1000, "protein_coding")
    assert (g["GENE2"]["gene_start"], g["GENE2"]["gene_end"], g["GENE2"]["tss"], g["GENE2"]["gene_biotype"]) == (5000, 6200, 6199, "lncRNA")


def test_matrix_market_folder(spark, tmp_path):
    put(tmp_path / "matrix.mtx", "%%MatrixMarket\n%c\n2 2 3\n1 1 3\n2 2 4\n1 2 1\n")
    put(tmp_path / "barcodes.tsv", "cellA\ncellB\n")
    put(tmp_path / "peaks.bed", "chr1:900-1100\nchr1\t1800\t1900\n")
    e, cells, f = G.read_10x_matrix(spark, str(tmp_path))
    assert {(r["feature_id"], r["cell_id"], r["value"]) for r in e.collect()} == {(0, "cellA", 3.0), (1, "cellB", 4.0), (0, "cellB", 1.0)}
    assert {(r["feature_id"], r["chrom"], r["start"], r["end"]) for r in f.collect()} == {(0, "chr1", 900, 1100), (1, "chr1", 1800, 1900)}
    assert {r["group"] for r in G.read_cell_groups(spark, cells).collect()} == {"all"}


def test_peak_weights_last_row_wins(spark, tmp_path):
    p = put(tmp_path / "w.tsv", "chrom\tstart\tend\tweight\nchr1\t1\t5\t2\nchr1\t1\t5\t7\n")
    assert [r["weight"] for r in G.read_peak_weights(spark, p).collect()] == [7.0]
    with pytest.raises(ValueError):
        G.read_peak_weights(spark, put(tmp_path / "bad.tsv", "chrom\tstart\nchr1\t1\n"))


def test_reference_ubiquity_forms(spark, tmp_path):
    import math

    p = put(tmp_path / "u.tsv", "ccre_id\tdf_ref\tn_ref\nE1\t1\t3\n")
    b = put(tmp_path / "u.bed", "chr1\t10\t20\tE1\n")
    row = G.read_reference_ubiquity(spark, p, b).first()
    assert (row["chrom"], row["start"], row["idf_ref"]) == ("chr1", 10, pytest.approx(math.log(4 / 2) + 1))


def test_role_resolution():
    assert T.resolve_column(["a", "FDR"], "padj", ("padj", "FDR")) == "FDR"
    assert T.resolve_column(["a"], "padj", ("padj",)) is None
    with pytest.raises(ValueError):
        T.resolve_column(["a"], "padj", ("padj",), required=True)
    with pytest.raises(ValueError):
        T.resolve_column(["a"], "x", (), explicit="b")
    with pytest.raises(ValueError):
        T.resolve_column(["Chrom", "chrom"], "chrom", ("chrom",), ignore_case=True)


def test_soft_numbers(spark):
    vals = ["1.5", " 2 ", "NA", "nan", "inf", "x", "", None, "1e3", "Infinity"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(S.soft_double("v").alias("d"))
    assert [r["d"] for r in df.collect()] == [1.5, 2.0, None, None, None, None, None, None, 1000.0, None]


def test_program_loading_layouts(spark, tmp_path):
    long = put(tmp_path / "l.tsv", "program_id\tgene_id\tloading\nP\tA\t1\nP\tA\t2\nP\tB\tNA\n")
    wide = put(tmp_path / "g.tsv", "gene_id\tP\tQ\nA\t3\t4\n")
    rows = put(tmp_path / "p.tsv", "\tA\tB\n1\t3\t4\n")
    get = lambda p: {(r["program"], r["gene_id"]): r["score"] for r in A.read_program_loadings(spark, p).collect()}
    assert get(long) == {("P", "A"): 3.0}
    assert get(wide) == {("P", "A"): 3.0, ("Q", "A"): 4.0}
    assert get(rows) == {("program_1", "A"): 3.0, ("program_1", "B"): 4.0}


def test_segments_one_based(spark, tmp_path):
    p = put(tmp_path / "s.tsv", "sample_id\tChromosome\tStart\tEnd\tSegment_Mean\ns1\t1\t101\t200\t0.5\ns1\t1\t5\t6\tNA\n")
    r = A.read_segments(spark, p, prefix="add_chr").collect()
    assert [(x["sample_id"], x["chrom"], x["start"], x["end"], x["amplitude"]) for x in r] == [("s1", "chr1", 100, 200, 0.5)]


def test_cpg_coordinate_sources(spark, tmp_path):
    m = put(tmp_path / "m.tsv", "probe_id\tchrom\tpos\ncg1\tchr1\t100\n")
    p = put(tmp_path / "c.tsv", "probe_id\tchrom\tpos\tdelta_beta\tpvalue\ncg1\t\t\t0.2\t0.01\ncg2\tchr2\t50\t0.1\t0.5\ncg3\t\t\t0.3\t0.1\n")
    got = {r["probe_id"]: (r["chrom"], r["start"], r["end"]) for r in A.read_cpg(spark, p, m).collect()}
    assert got == {"cg1": ("chr1", 99, 100), "cg2": ("chr2", 49, 50)}


def test_prism_matrix(spark, tmp_path):
    m = put(tmp_path / "m.csv", "row_name,C1,C2\nL1,0.5,\nL2,NA,1.5\n")
    t = put(tmp_path / "t.csv", "column_name,broad_id,name,target\nC1,BRD1,x,G\n")
    rows = A.read_prism_matrix(spark, m, A.read_prism_treatments(spark, t)).collect()
    assert {(r["sample_id"], r["drug_id"], r["response"]) for r in rows} == {("L1", "BRD1", 0.5), ("L2", "C2", 1.5)}


def test_calorimetry_times(spark, tmp_path):
    p = put(tmp_path / "c.csv", "subject.id,Date.Time,exp.hour,exp.day,vo2,feed\nA,2024-01-02 06:30:00,,,1,2\nB,,5,2,3,NA\n")
    got = {(r["subject_id"], r["variable"]): (r["t_hours"], r["value"]) for r in A.read_calorimetry(spark, p).collect()}
    assert got == {("A", "vo2"): (30.5, 1.0), ("A", "feed"): (30.5, 2.0), ("B", "vo2"): (29.0, 3.0)}


def test_trace_without_times_is_numbered(spark, tmp_path):
    bare = put(tmp_path / "bare.csv", "subject.id,vo2\nA,1\nB,2\n,9\nA,3\n")
    assert {(r["subject_id"], r["t_hours"], r["value"]) for r in A.read_calorimetry(spark, bare).collect()} == {("A", 0.0, 1.0), ("B", 1.0, 2.0), ("A", 3.0, 3.0)}
    some = put(tmp_path / "some.csv", "subject.id,exp.hour,exp.day,vo2\nA,5,2,1\nA,,,2\nA,x,1,3\n")
    assert {(r["t_hours"], r["value"]) for r in A.read_calorimetry(spark, some).collect()} == {(29.0, 1.0), (1.0, 2.0), (2.0, 3.0)}


def test_sessions(spark, tmp_path):
    long = put(tmp_path / "l.csv", "id,group1,Lean.Mass\nA,wt,20\nB,ko,21\n")
    wide = put(tmp_path / "w.csv", "id,group1,group2,group_names,exc,Total.Mass\nA,A,B,wt,,30\nB,,,ko,10,31\n")
    assert {(r["subject_id"], r["group"], r["lean_mass"]) for r in A.read_session(spark, long).collect()} == {("A", "wt", 20.0), ("B", "ko", 21.0)}
    assert {(r["subject_id"], r["group"], r["exc_hour"]) for r in A.read_session(spark, wide).collect()} == {("A", "wt", None), ("B", "ko", 10.0)}


def test_profiles_skip_metadata_and_text(spark, tmp_path):
    p = put(tmp_path / "p.csv", "sample_id,Metadata_Plate,f1,note\na,1,0.5,x\nb,1,,y\n")
    assert {(r["id"], r["feature"], r["value"]) for r in A.read_profiles(spark, p).collect()} == {("a", "f1", 0.5)}


def test_site_labels(spark):
    df = spark.createDataFrame([("NP_1:T15S12",), ("NP_2:K7",), ("odd label",)], "site_label string")
    got = {(r["site_id"], r["site_group_id"], r["residue"], r["position"], r["site_status"]) for r in A.parse_site_labels(df).collect()}
    assert got == {
        (None, "NP_1|S12;T15|phospho", None, None, "site_group"), ("NP_2|K|7|phospho", "NP_2|K|7|phospho", "K", 7, "single_site"),
        (None, "raw::odd_label|phospho", None, None, "unparsed_fallback"),
    }


def test_public_standardisation(spark):
    values = spark.createDataFrame([("NP_1:S12", "G", n, 1.0) for n in ("T A", "T/A", "POOL-1")], "site_label string, gene_symbol string, sample_id string, value double")
    anno = spark.createDataFrame([("T A", "Tumor"), ("T/A", "normal")], "sample_id_raw string, sample_type string")
    long, sites, samples = PUB.ptm_standardize(values, anno, "study")
    assert {(r["sample_id"], r["condition"], r["group"]) for r in samples.collect()} == {("T_A", "case", "study"), ("T_A_2", "control", "study")}
    assert {(r["feature_id"], r["sample_id"]) for r in long.collect()} == {("NP_1|S|12|phospho", "T_A"), ("NP_1|S|12|phospho", "T_A_2")}
    ev = spark.createDataFrame([("1", "ES", "G", "tcga_spliceseq", 0), ("2", "??", "G", "tcga_spliceseq", 1)], "event_id string, event_type string, gene_symbol string, tool_family string, row_ordinal long")
    for c in ("event_group", "gene_id", "annotation_status", "chrom", "start", "end", "strand"):
        ev = ev.withColumn(c, F.lit(None).cast("string"))
    psi = spark.createDataFrame([("1", "a", 0.5), ("1", "b_Norm", None), ("2", "a", 0.1)], "event_id string, sample_id_raw string, psi double")
    s = PUB.header_samples(psi.select("sample_id_raw").distinct())
    assert {(r["sample_id"], r["condition"]) for r in s.collect()} == {("a", "tumor"), ("b", "adjacent_normal")}
    _, rows = PUB.splice_standardize(ev, psi, s, "ds", allowed=["exon_skip"])
    assert [(r["canonical_event_key"], r["canonicalization_confidence"], r["sample_id"]) for r in rows.collect()] == [("tcga_spliceseq_asid::G::exon_skip::1", "medium", "a")]


def test_duplicate_annotation_is_an_error(spark, tmp_path):
    p = put(tmp_path / "a.tsv", "sample_id\tx\ns1\t1\ns1\t2\n")
    with pytest.raises(ValueError):
        A.read_sample_annotations(spark, p)


def test_sources_union(spark, tmp_path):
    a, b = put(tmp_path / "a.tsv", "x\ty\n1\t2\n"), put(tmp_path / "b.tsv", "x\n3\n")
    rows = T.union_sources(spark, [(a, "A"), (b, "B")]).collect()
    assert {(r["x"], r["y"], r["source_dataset"]) for r in rows} == {("1", "2", "A"), ("3", None, "B")}


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("p/1", "A", 1.0), ("p/1", "B", 2.0), ("q", "A", 3.0)], "program string, gene_id string, score double")
    OUT.write_gene_rows(rows, str(tmp_path / "g"), ["program"])
    assert spark.read.parquet(str(tmp_path / "g")).count() == 3
    sets = spark.createDataFrame([("s", ["A", "B"])], "set_name string, genes array<string>")
    assert OUT.gmt_lines(sets).first()["value"] == "s\tA B"
    OUT.write_gmt(sets, str(tmp_path / "gmt"), "classic")
    assert spark.read.text(str(tmp_path / "gmt")).first()["value"] == "s\tna\tA\tB"
    m = {r["program"]: (r["path"], r["n_genes"]) for r in OUT.manifest(rows, ["program"], "root").collect()}
    assert m == {"p/1": ("root/program=p_1", 2), "q": ("root/program=q", 1)}


def test_names(spark):
    df = spark.createDataFrame([(" a b/c\\d!é ",)], "x string")
    assert df.select(S.set_name("x").alias("v")).first()["v"] == "a_b_c_d"
    assert df.select(S.path_component("x").alias("v")).first()["v"] == "a_b_c_d"
    barcode = spark.createDataFrame([("TCGA-AA-BB-01A",), ("TCGA-AA-BB-11A",), ("x_Norm",), ("y",)], "b string")
    assert [r["v"] for r in barcode.select(S.tcga_arm("b").alias("v")).collect()] == ["tumor", "adjacent_normal", "adjacent_normal", None]


def test_queries_and_sql_share_names(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert F is not None and len(entry.queries()) > 100
