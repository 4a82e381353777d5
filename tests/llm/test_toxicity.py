import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lociweave.llm import toxicity as tx
from tests_llm_prose import prose


def corpus(n=900):
    r = random.Random(5)
    rude = ["idiot", "worthless", "scum", "pathetic"]
    docs, labels = [], []
    for i in range(n):
        w = prose(i, 60, 900).split()
        bad = i % 8 == 0
        if bad:
            for _ in range(3):
                w.insert(r.randrange(len(w)), r.choice(rude) if i % 16 else "vequd" + r.choice(["an", "on", "er", "ich", "ent", "ou"]))
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    extra = [(None, "an idiot and scum here"), (5000, None), (5001, ""), (5002, prose(3, 20000, 900) + " worthless pathetic scum"), (7, dict(docs)[7])]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string").withColumn("score", F.lit("mine")).withColumn("y", F.lit(1))
    known = labels + [(3, None), (None, 1), (0, 1)]
    rows = tx.toxicity(d, spark.createDataFrame(known, "doc_id long, toxic int")).collect()
    assert len(rows) == len(docs) + len(extra)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = dict(labels)
    out = [(r.score, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    pos, neg = (np.array([s for s, y in out if y == k]) for k in (1, 0))
    assert (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean() > 0.97
    assert (pos >= 0.7).mean() > 0.9 and (neg >= 0.7).mean() < 0.02
    by = {r.doc_id: r for r in rows}
    assert by[5002].predicted == 1 and by[5000].predicted == by[5001].predicted == 0 and by[5000].score == by[5001].score
    assert len({r.score for r in rows if r.doc_id == 7}) == 1


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(300)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (sorted(map(tuple, tx.toxicity(d, spark.createDataFrame(x, "doc_id long, toxic int")).collect())) for x in (labels, turned))
    assert a == b


def test_label_model_finds_accuracies():
    r = np.random.default_rng(1)
    y = r.random(4000) < 0.15
    hit = lambda good, bad: np.where(y, r.random(4000) < good, r.random(4000) < bad).astype(int)
    one = hit(0.8, 0.02)
    v = np.stack([one, one, one, hit(0.7, 0.03), hit(0.75, 0.02), hit(0.3, 0.3)], 1)
    p = tx.label_model(v, 0.15)
    # The best that knows all rates and that three voters are one.
    known = ((one, 0.8, 0.02), (v[:, 3], 0.7, 0.03), (v[:, 4], 0.75, 0.02))
    best = np.log(0.15 / 0.85) + sum(np.where(c == 1, np.log(a / b), np.log((1 - a) / (1 - b))) for c, a, b in known)
    assert ((p > 0.5) == y).mean() > ((best > 0) == y).mean() - 0.02
    alone = (one == 1) & (v[:, 3:5] == 0).all(1)
    assert p[alone].mean() < p[(v[:, 3:5] == 1).all(1)].mean()


def test_without_labels_or_documents(spark):
    docs, labels = corpus(20)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = tx.toxicity(d, none).collect()
    assert len(rows) == 20 and len({r.score for r in rows}) == 1 and not any(r.predicted for r in rows)
    assert tx.toxicity(d.limit(0), spark.createDataFrame(labels, "doc_id long, toxic int")).count() == 0
