"""Collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from lociweave.llm import collocations as m

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, longest=4, least=30, subsumed=80, top=2000):
    """rows: (group, text)."""
    counts, total = {}, Counter()
    for g, t in rows:
        g = "und" if g is None else g
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (t or "").translate(LOWER)):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            total[g] += len(ws)
            for n in range(1, longest + 1):
                counts.setdefault(g, Counter()).update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = set()
    for g, c in counts.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + n] for p, a in cand.items() for n in range(2, len(p)) for i in range(len(p) - n + 1) if 100 * a >= subsumed * c[p[i : i + n]]}
        rows = []
        for p, a in cand.items():
            if p not in gone:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((g, rank, p.decode(), -a, l, r, total[g], -s))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


SCHEMA = "doc_id long, text string, lang string"


def made(n, seed, words="a b c d e f ü Ω".split()):
    r = random.Random(seed)
    out = []
    for i in range(n):
        text = "".join(r.choice(words) + r.choice([" ", " ", "  ", "\t", ". ", " ", "\n"]) for _ in range(r.randrange(60)))
        out.append((i, r.choice([text, text.upper(), None, ""]) if i % 9 == 0 else text, r.choice(["en", "en", "de", None, "und"])))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_against_plain_counting(spark, seed):
    rows = made(400, seed) + [(1, "New York City, new york city! New York" * 3, "en")] * 20
    want = brute([(g, t) for _, t, g in rows], least=12)
    assert len(want) > 50 and any(len(p[2].split()) == 4 for p in want)
    assert got(m.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5), least=12)) == want


def test_top_ties_and_lengths(spark):
    rows = made(150, 3)
    pairs = [(g, t) for _, t, g in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(m.collocations(df, least=5, top=7)) == brute(pairs, least=5, top=7)
    assert got(m.collocations(df, least=5, longest=2)) == brute(pairs, longest=2, least=5)


def test_one_group_holds_all_and_a_very_long_text(spark):
    r = random.Random(5)
    long = " ".join(r.choice("the of and cat dog".split()) for _ in range(300_000))
    rows = [(1, long, None), (2, "x" * 2_000_000 + " y", None), (2, "the cat.", None)]
    assert got(m.collocations(spark.createDataFrame(rows, SCHEMA))) == brute([(None, t) for _, t, _ in rows])


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert m.collocations(empty).collect() == []
    rows = [(None, "one two. one two", "en", 1)] * 20 + [(1, None, None, 2)]
    clash = spark.createDataFrame(rows, "phrase string, text string, lang string, f int")
    assert got(m.collocations(clash)) == {("en", 1, "one two", 40, 40, 40, 80, 1_000_000)}


def test_counts_past_64_bits(spark):
    big = 1 << 60
    rows = [("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 1)]
    out = m.candidates(spark.createDataFrame(rows, "grp string, phrase string, n int, f long")).collect()
    assert [tuple(r) for r in out] == [("en", "a b", big - 1, big, big - 1, 2_000_000 * (big - 1) // (2 * big - 1))]


def test_frequent_bitmap_keeps_every_frequent_phrase(spark):
    rows = [("en", f"w{i} v{i}") for i in range(500)] + [("de", "w1 v1")]
    bitmap = m.frequent_bitmap(spark.createDataFrame(rows, "grp string, phrase string"), 2)
    for g, p in rows:
        for bit in m._bits(m.Positions(g, [p.encode()]).hashes(2)):
            assert int(bitmap[int(bit[0]) >> 6]) >> (int(bit[0]) & 63) & 1
