"""Licence scan against plain regular expressions and pairwise nesting."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lociweave.llm import licenses as m
from lociweave.llm.common import table

LOWER = str.maketrans(m.UPPER, m.LOWER)
RULES = m.rules()


def brute(text, rule_list=RULES, base=m.BASE):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for p, label in base for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    line = " " + "".join(w + " " for w in words)
    found = []
    for n, (label, priority, keyword, pattern) in enumerate(rule_list):
        if keyword in words:
            for h in re.finditer(f"(?<= )(?:{pattern})(?= )", line):
                first = line[: h.start()].count(" ") - 1
                found.append((first, first + h[0].count(" ") + 1, priority, n, label))

    def loses(x, y):
        if x is y:
            return False
        (f, l, p, n, _), (g, k, q, o, _) = x, y
        if g <= f and l <= k:
            return q < p or q == p and ((g, k) != (f, l) or o < n)
        return f <= g and k <= l and q < p

    kept = sorted((f, -l, p, n, label) for x in found for f, l, p, n, label in [x] if not any(loses(x, y) for y in found))
    base_labels = sorted({label for _, label in places})
    score = max([m.CONFIDENCE[p - 1] for _, _, p, _, _ in kept] + [m.BASE_CONFIDENCE] * bool(places) + [0.0])
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min((i for i, _ in places), default=None), "last_word": max((i for i, _ in places), default=None),
        "base_labels": ",".join(base_labels), "labels": ",".join(sorted({*base_labels, *[k[4] for k in kept]})), "score": score,
        "detections": [(label, p, f, -l) for f, l, p, _, label in kept],
    }


def got(df, **how):
    out = []
    for r in m.licenses(df, ["doc_id"], **how).orderBy("row.doc_id").collect():
        d = r.res.asDict()
        out.append(d | {"detections": [tuple(x) for x in d["detections"]]})
    return out


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


KNOWN = {
    "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
    "Licensed under the Apache License, Version 2.0.": "apache,apache-2.0",
    "Released under the MIT License.": "mit",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0",
    "GPLv2 or later": "gpl-2.0",
    "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
    "BSD-3-Clause": "bsd-3-clause",
    "under the New BSD License": "bsd-3-clause",
    "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa-4.0",
    "CC0 1.0 Universal": "cc0-1.0",
    "Copyright (c) 2021 Someone. All rights reserved.": "copyright,proprietary",
    "a text about licences and permits": "",
    "the Mozilla Public License 2.0 and the ISC license": "isc,mpl-2.0",
}


def test_known_statements(spark):
    assert {t: r["labels"] for t, r in zip(KNOWN, got(frame(spark, list(KNOWN))))} == KNOWN


ODD = [None, "", " \n..--", "mit license", "MIT-License mit_license mit  license", "general public license general public license", "licenſe MİT license mit licensé", "apache license" * 3, "é mit license\x00mit license"]


def test_odd_texts(spark):
    assert got(frame(spark, ODD)) == [brute(t) for t in ODD]


def test_sample_tables(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    found = got(frame(spark, [r.text for r in rows]))
    assert found == [brute(r.text) for r in rows] and sum(r["n_base"] for r in found) > 0


@pytest.mark.parametrize("seed", range(2))
def test_mixtures_of_rule_words(spark, seed):
    r = random.Random(seed)
    words = sorted({w for _, _, _, p in RULES for w in re.findall("[a-z0-9]{2,}|[0-9]", p)})
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(r.randrange(30)):
            plain = re.sub(r"\(\?: \\S\+\)\{\d,\d+\}", " x y", r.choice(RULES)[3])
            plain = re.sub(r"\[(.)[^\]]*\](?:\{\d\})?", r"\1", re.sub(r"\((?:\?:)?([^()|]*)(?:\|[^()]*)?\)\??", lambda h: h[1] if r.random() < 0.7 else "", plain))
            parts.append(plain.replace("?", "").replace("\\S+", "z") if r.random() < 0.6 else r.choice(words))
        texts.append(r.choice([" ", "-", ", "]).join(parts))
    found = got(frame(spark, texts))
    assert found == [brute(t) for t in texts] and sum(len(d["detections"]) for d in found) > 300


def test_priorities_and_nesting(spark):
    mine = [("outer", 3, "b", "a b c d"), ("inner", 3, "b", "b c"), ("better", 1, "c", "c"), ("same", 3, "b", "a b c d"), ("apart", 2, "d", "d e"), ("run", 4, "a", "a(?: a)?")]
    texts = ["a b c d e", "a b c d", "b c", "x a b x", "a a a a", "d e d e"]
    assert got(frame(spark, texts), rule_list=mine) == [brute(t, mine) for t in texts]
    base = (("a a", "twice"), ("b", "one"))
    assert got(frame(spark, texts), rule_list=mine, base=base) == [brute(t, mine, base) for t in texts]


def test_very_long_text_full_of_statements(spark):
    text = "Licensed under the Apache License, Version 2.0. some words here " * 3000
    (found,) = got(frame(spark, [text]))
    assert found["n_base"] == 3000 and found["last_word"] == found["n_words"] - 8 and len(found["detections"]) == 3000


def test_empty_table_clashing_columns_and_bad_priority(spark):
    assert got(spark.createDataFrame([], "doc_id long, text string")) == []
    df = spark.createDataFrame([(None, "mit license", "x", 3)] * 2, "doc_id long, text string, labels string, n_words int")
    rows = m.licenses(df, df.columns).collect()
    assert [(r.row.labels, r.res.labels, r.row.n_words, r.res.n_words) for r in rows] == [("x", "mit", 3, 2)] * 2
    with pytest.raises(ValueError):
        m.licenses(df, ["doc_id"], rule_list=[("x", 9, "a", "a")])


def test_each_rule_searches_a_text_once(spark):
    docs = spark.createDataFrame([("the mit license",)], "text string")
    plan = docs.select(m._detections(F.col("text"), [("mit", 4, "mit", "mit license")]).alias("found"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1 and "contains(" not in plan.replace("array_contains(", "").lower()


def test_only_ascii_capitals_are_lowered(spark):
    texts = ["THE MIT LICENSE", "ÉTÉ İSTANBUL MIT License", "", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    found = [r.w for r in docs.select("i", m.word_stream(F.col("text")).alias("w")).orderBy("i").collect()]
    assert found == [" the mit license ", " ÉtÉ İstanbul mit license ", " ", " "]
