import hashlib

from pyspark.sql import functions as F

from lociweave.llm import suffixes as sx
from tests_llm_prose import prose


def brute(docs, length):
    """Rows that share an id are one document: the first start of a string is the smallest place in any of them."""
    first = {}
    for d, t in docs:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            place = (d is not None, d or 0, p)
            s = b[p : p + length]
            if s not in first or place < first[s]:
                first[s] = place
    out = []
    for d, t in docs:
        b = (t or "").encode()
        gone = set()
        for p in range(len(b) - length + 1):
            if (d is not None, d or 0, p) > first[b[p : p + length]]:
                gone.update(range(p, p + length))
        spans = sum(i - 1 not in gone for i in gone)
        out.append((d, len(b), len(gone), spans, hashlib.sha256(bytes(x for i, x in enumerate(b) if i not in gone)).hexdigest()))
    return out


def fixture():
    line = "Permission is hereby granted to copy this line with all of its words, as long as it is over a hundred bytes."
    short = "This line is common but has fewer than one hundred bytes of text in all."
    docs = [(i, prose(i, 60)) for i in range(8)]
    docs += [(20 + i, f"{prose(30 + i, 20)} {line} {prose(60 + i, 15)}") for i in range(9)] + [(40 + i, f"{prose(90 + i, 12)} {short} {prose(120 + i, 12)}") for i in range(9)]
    docs += [(60, prose(2, 60)), (61, "Ünïcödé " * 40), (62, "a" * 260), (63, "ab" * 90), (64, None), (65, ""), (66, "x" * 99), (67, "x" * 100), (68, "x" * 101), (69, "x" * 100)]
    docs += [(70, prose(3, 60)[:150] + prose(4, 60)[50:200] + prose(5, 60)[-120:]), (71, prose(1, 30) + prose(1, 30)), (72, line[1:]), (73, line[:-1]), (74, line + line)]
    near = prose(7, 60).split()
    for i in range(6):
        w = list(near)
        w[9 * i] = "changed"
        docs.append((80 + i, " ".join(w)))
    return docs + [(3, prose(3, 60)), (80, " ".join(near)[30:]), (None, prose(300, 40) + line), (None, prose(300, 40) + line)]


def run(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("did", F.lit("mine")).withColumn("runs", F.lit(1))
    return sorted(map(tuple, sx.deduplicated(df, **how).collect()), key=str)


def test_matches_brute_force(spark):
    docs = fixture()
    assert run(spark, docs) == sorted(brute(docs, 100), key=str)


def test_other_length(spark):
    docs = fixture()
    assert run(spark, docs, length=50) == sorted(brute(docs, 50), key=str)


def test_long_texts_in_chunks(spark):
    long = prose(500, 4000)
    docs = [(1, long), (2, "y" + long), (3, long[7000:9000])]
    expected = sorted(brute(docs, 100), key=str)
    old = sx.CHUNK
    try:
        sx.CHUNK = 1 << 12
        found = sx.cover([t.encode() for _, t in docs])
        assert found[0].max() == 2
        covered = {(int(r), p) for r, a, b in zip(found[0], found[3], found[4]) for p in range(a, b + 1)}
        assert covered == {(r, p) for r, (_, t) in enumerate(docs) for p in range(len(t) - 99)}
    finally:
        sx.CHUNK = old
    assert run(spark, docs) == expected


def test_no_rows(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 0, 0, hashlib.sha256(b"").hexdigest())]
