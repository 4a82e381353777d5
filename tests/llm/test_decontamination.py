import hashlib
import re

from pyspark.sql import functions as F

from lociweave.llm import decontamination as dc
from tests_llm_prose import prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lower)


def brute(docs, items, window=10):
    wins = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            wins.setdefault(tuple(w[i : i + window]), set()).add(name)
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in wins:
                    hit.update(range(i, i + k))
                    names |= wins[tuple(w[i : i + k])]
        names = sorted(str(n) for n in names if n is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return out


def run(spark, docs, items, **how):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("mine")).withColumn("res", F.lit(1))
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("name", F.lit(0))
    got = dc.contamination(d, b, ["doc_id", "n_words", "res"], **how)
    rows = got.select("row.doc_id", "res.n_words", "res.n_hit", "res.n_items", "res.items_sha256", "res.contaminated", "row.n_words").collect()
    assert all(r[6] == "mine" for r in rows)
    return [tuple(r)[:6] for r in rows]


def fixture():
    items = [(1, prose(1, 40)), (2, "Zwölf Boxkämpfer jagen Viktor"), (3, prose(1, 40)), (4, prose(4, 10)), (5, "..."), (6, None), (7, ""), (10, "a1"), (None, prose(9, 12)), (4, prose(4, 10))]
    passage = prose(1, 40).split()
    docs = [
        (1, prose(20, 60) + " " + " ".join(passage[5:25]).upper() + "!! " + prose(21, 50)), (2, "zwölf-BOXKÄMPFER jagen viktor"), (3, None), (4, ""), (5, "  \x00\x1f "),
        (6, prose(4, 10) + "\n" + prose(4, 10)), (7, prose(22, 9)), (7, prose(22, 9)), (8, "x a1. b a1a1 a1"), (9, prose(23, 30000) + " " + prose(9, 12)), (None, " ".join(passage[:9])),
        (11, " ".join(passage[:10])), (12, "zwölf boxkämpfer jagen"), (13, prose(30, 400) + " " + " ".join(passage[3:14]) + " " + " ".join(passage[4:15])),
    ]
    return docs, items


def test_matches_brute_force(spark):
    docs, items = fixture()
    assert sorted(run(spark, docs, items), key=str) == sorted(brute(docs, items), key=str)


def test_blocks_give_the_same(spark):
    docs, items = fixture()
    assert sorted(run(spark, docs, items, block_bytes=200), key=str) == sorted(brute(docs, items), key=str)


def test_window_of_three(spark):
    docs, items = fixture()
    assert sorted(run(spark, docs, items, window=3), key=str) == sorted(brute(docs, items, 3), key=str)


def test_empty_tables(spark):
    docs, items = fixture()
    assert run(spark, [], items) == []
    assert all(r[2:4] == (0, 0) and not r[5] for r in run(spark, docs, []))
