import re

import pytest
from pyspark.sql import functions as F

from lociweave.llm import mixing
from tests_llm_prose import prose


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def water(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        t = {s: 3 * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in open_) for s in order}
        new = {s for s in open_ if t[s] > 3 * sizes[s] + 1e-9}
        if not new:
            return t
        capped |= new


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("place", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("size", F.lit("s"))
    rows = mixing.mix(df).collect()
    assert sorted(((r.doc_id, r.source, r.size) for r in rows), key=str) == sorted(((d, s, size(t)) for d, s, t in docs), key=str)
    sizes = {}
    for _, s, t in docs:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    for s in sizes:
        own = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] and r.target == pytest.approx(want[s], rel=1e-9) for r in own)
        assert all(0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size for r in own)
        small = sorted(r.size for r in own if r.size)
        if small:
            assert abs(sum(r.taken for r in own) - want[s]) <= max(small[0], 1) + small[min(len(small) - 1, 3)]
    again = mixing.mix(df).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)
    return rows


def test_targets_and_rounding(spark):
    docs = [(i, f"s{i % 7}", prose(i, 5 + i * 7 % 90)) for i in range(400)] + [(1000 + i, "s1", prose(i, 40)) for i in range(300)]
    docs += [(2000, None, "a b c d"), (2001, None, None), (2002, "", "x y"), (2003, "tiny", "one"), (2004, "Z", prose(2, 20000)), (2005, "s0", "\x0b \t"), (5, "s5", prose(5, 40)), (None, "s2", "u\x85v w\xa0x")]
    check(spark, docs)


def test_capped_sources(spark):
    rows = check(spark, [(i, "big" if i < 50 else f"small{i % 5}", prose(i, 60 if i < 50 else 6)) for i in range(90)])
    assert all(r.copies == 3 for r in rows if r.source != "big")


def test_rates_are_tilted_by_size(spark):
    docs = [(i, "a" if i % 3 else "b", prose(i, 10 + i % 50)) for i in range(600)]
    rows = check(spark, docs)
    grown = [r for r in rows if r.source == "b" and r.target > 1.2 * r.source_size]
    assert grown
    mean = lambda rs: sum(r.copies for r in rs) / len(rs)
    assert mean([r for r in grown if r.size > 45]) > mean([r for r in grown if r.size < 25])


def test_words_alone(spark):
    texts = ["a b", " a\tb\nc ", "", None, "\x0b\x0c\r", "x\x85y\xa0z", "é ü", "a  b   c    d"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string").select("i", mixing.word_count().alias("n")).collect()
    assert {r.i: r.n for r in rows} == {i: size(t) for i, t in enumerate(texts)}


def test_nothing_to_mix(spark):
    check(spark, [])
    check(spark, [(1, "a", None), (2, None, "")])
    check(spark, [(1, "only", prose(1, 50)), (2, "only", prose(2, 7))])


def test_mixed_rows(spark):
    docs = [(i, f"s{i % 4}", prose(i, 30)) for i in range(80)] + [(3, "s3", prose(3, 30))]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    rows = mixing.mixed(df).collect()
    assert all(r.copies >= 1 and r.taken == r.copies * size(r.text) and (r.doc_id, r.source, r.text) in docs for r in rows)
