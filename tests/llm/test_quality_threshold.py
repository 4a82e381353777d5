"""The fitted threshold against plain numpy, and what it keeps."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm import quality
from lociweave.llm.common import unpack
from tests_llm_prose import prose

BUCKETS = 1 << 12


def fixture(spark, n):
    """Good documents, and junk with every third word unknown: its ratio is below theirs, often above the fixed value."""
    mixed = lambda i: " ".join(w if k % 3 else w.upper() for k, w in enumerate(prose(5000 + i, 90).split()))
    texts = [prose(i, 90) for i in range(n)] + [mixed(i) for i in range(n // 4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < n), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    return texts, docs, labels


def test_threshold_is_the_low_quantile_of_held_out_ratios(spark):
    n = 400
    texts, docs, labels = fixture(spark, n)
    fold = {r.doc_id: r.f for r in docs.select("doc_id", quality.fold_of("doc_id").alias("f")).collect()}
    grams = [quality.ngram_buckets(quality.word_hashes(t.encode().split()), BUCKETS) for t in texts]
    count = lambda ids: sum((np.bincount(grams[i], minlength=BUCKETS) for i in ids), np.zeros(BUCKETS))
    raw = count(range(len(texts)))
    p = (raw + 1) / (raw.sum() + BUCKETS)
    held = []
    for k in range(quality.FOLDS):
        good = count(i for i in range(n) if fold[i] != k)
        w = np.log((good + BUCKETS * p) / (good.sum() + BUCKETS)) - np.log(p)
        held += [w[grams[i]].mean() for i in range(n) if fold[i] == k]
    want = np.quantile(held, quality.QUANTILE, method="inverted_cdf") - quality.MARGIN
    rows = {r.doc_id: r for r in unpack(quality.quality(docs, labels, ["doc_id"], buckets=BUCKETS)).collect()}
    assert {d for d, r in rows.items() if r.kept} == {d for d, r in rows.items() if not r.base_failed and r.log_ratio >= want}
    trusted = quality.trusted_documents(docs, labels, "doc_id")
    weights = quality.ratio_weights(trusted, docs, "text", BUCKETS, quality.fold_of("doc_id"), quality.FOLDS)
    assert quality.held_out_threshold(trusted, "text", quality.fold_of("doc_id"), weights) == pytest.approx(want, abs=1e-12)


def test_junk_near_the_fixed_value_is_rejected(spark):
    n = 400
    _, docs, labels = fixture(spark, n)
    rows = unpack(quality.quality(docs, labels, ["doc_id"], buckets=BUCKETS)).collect()
    junk = [r for r in rows if r.doc_id >= n]
    assert any(not r.base_failed and r.log_ratio >= quality.THRESHOLD for r in junk)
    at_fixed = sum(not r.base_failed and r.log_ratio >= quality.THRESHOLD for r in junk)
    assert sum(r.kept for r in junk) < at_fixed / 2 and all(r.kept for r in rows if r.doc_id < n)


def test_few_trusted_documents_leave_the_fixed_value(spark):
    _, docs, labels = fixture(spark, 40)
    trusted = quality.trusted_documents(docs, labels, "doc_id")
    weights = quality.ratio_weights(trusted, docs, "text", BUCKETS, quality.fold_of("doc_id"), quality.FOLDS)
    assert quality.held_out_threshold(trusted, "text", quality.fold_of("doc_id"), weights) == quality.THRESHOLD


def test_every_good_document_is_trusted(spark):
    n = 20_300
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    assert quality.trusted_documents(docs, labels, "doc_id").count() == n


def test_texts_of_trusted_documents_are_not_shuffled(spark):
    n = 3000
    docs = spark.range(n).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("words "), "id").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 3 > 0).cast("int").alias("quality"))
    want = {i for i in range(n) if i % 7 and i % 3}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        found = quality.trusted_documents(docs, labels, "doc_id")
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.doc_id for r in found.collect()) == sorted(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_ids_that_share_their_bits_are_told_apart(spark):
    docs = spark.range(600).union(spark.range(50)).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"))
    labels = spark.range(600).select(F.col("id").cast("int").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    found = [r.doc_id for r in quality.trusted_documents(docs, labels, "doc_id", bits=64).collect()]
    assert sorted(found) == sorted([i for i in range(600) if i % 2] + [i for i in range(50) if i % 2])
