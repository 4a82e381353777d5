"""Groups of near copies against all pairs compared in plain Python."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from lociweave.llm import nearcopies as nc
from test_simhash import fingerprint
from tests_llm_prose import prose


def shingles(text):
    t = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())


def groups(texts):
    s, f = [shingles(t) for t in texts], [fingerprint(t) for t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by_jaccard = 0
    for i in range(len(texts)):
        for j in range(i):
            near = bin(f[i] ^ f[j]).count("1") <= 2
            alike = bool(s[i] | s[j]) and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j])
            by_jaccard += alike and not near
            if near or alike:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))], by_jaccard


def edited(words, r, n):
    w = list(words)
    for i in r.sample(range(len(w)), n):
        w[i] = f"x{r.randrange(10**6)}"
    return " ".join(w)


def fixture():
    r = random.Random(3)
    texts = [prose(i, 150) for i in range(20)] + [None, "", "one", "ONE", "one two", "\n"]
    for i in range(6):
        texts.append(edited(prose(i, 150).split(), r, 2))
    # One large group, whose members are similar to its base and often not to each other, with strays at the border.
    base = prose(99, 160).split()
    texts += [" ".join(base)] + [edited(base, r, 1 + i % 5) for i in range(60)] + [prose(0, 150).upper()]
    return texts


def test_groups_are_those_of_all_pairs(spark):
    texts = fixture()
    roots, by_jaccard = groups(texts)
    assert by_jaccard > 20
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)] + [(None, texts[0], "mine")], "doc_id long, text string, row string").withColumn("key", F.lit(1))
    got = nc.representatives(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(roots))


def test_strays_around_a_poor_centre(spark):
    """Members that are far from any one centre, and chains of small steps."""
    r = random.Random(8)
    base = prose(50, 120).split()
    texts, step = [], list(base)
    for i in range(40):
        step = edited(step, r, 1).split()
        texts.append(" ".join(step))
    texts += [edited(base, r, 12) for _ in range(40)] + [" ".join(base)] * 3
    roots, by_jaccard = groups(texts)
    assert 1 < len(set(roots)) < 70 and by_jaccard > 50
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r.doc_id for r in nc.representatives(df).collect()) == sorted(set(roots))


def test_repeated_rows_and_a_very_long_text(spark):
    long = " ".join(prose(i, 400) for i in range(300))
    rows = [(7, long), (8, long + " end"), (3, "a b c"), (3, "a b c"), (3, "A  b c"), (3, "other words here"), (None, None), (None, "")]
    got = nc.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, len((r.text or "").split())) for r in got) == [(False, 3, 3), (False, 3, 3), (False, 7, len(long.split())), (True, 0, 0)]


def test_bands_find_similar_sets():
    r = np.random.RandomState(1)
    missed = 0
    for _ in range(300):
        s = r.randint(0, 1 << 62, 180).astype(np.uint64)
        a, b = nc.bands(np.unique(s[:162])), nc.bands(np.unique(s[18:]))
        missed += not any(x == y for x, y in zip(a, b))
    assert missed == 0


def test_no_documents(spark):
    assert nc.representatives(spark.createDataFrame([], "doc_id long, text string")).count() == 0
