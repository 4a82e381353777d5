"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from lociweave.catalog.registry import entries  # noqa: E402

HEADLINE = [
    "chipseq_peak", "interval_overlap_join", "overlap_max_prior", "overlap_mask", "nearest_asof", "distance_decay_topk", "segment_gene_overlap",
    "linked_gene_score", "gene_aggregate_weighted_mean", "group_vs_rest", "welch_group_vs_rest", "ols_group_effect", "bh_adjust", "robust_z",
    "rank_all", "select_quantile", "gmt_topk", "target_weighted_sum", "topk_mean", "support_penalty", "event_ubiquity_prior", "subject_features",
    "trapezoid_auc", "hub_score", "rna_deg_multi", "ptm_site_diff",
    "splice_event_diff", "methylation_programs", "atac_bulk", "sparse_deconvolution", "nmf_programs", "rna_de_prepare", "knn_evidence", "mechanism_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("lociweave-bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = entries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        found[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
