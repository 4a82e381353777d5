"""Alignment against the tokenizers' own whole encodings and plain offset sets."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lociweave.llm import alignment as m
from lociweave.llm.common import table, unpack
from lociweave.llm.tokens import byte_letters

A = Tokenizer.from_file(P.path(m.BYTE_BPE))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=P.path(m.PIECES))
LETTERS = byte_letters()


def piece(i):
    p = B.id_to_piece(i)
    hexa = re.fullmatch("<0x(..)>", p)
    return bytes([int(hexa[1], 16)]) if hexa else p.replace("▁", " ").encode()


def tokens(text):
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, piece(i)) for i in B.encode(text)]
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def ends(side):
    out, at = [], 0
    for i, t in side:
        at += len(t)
        out.append((at, i))
    return out


def brute(texts):
    made, links = [], []
    for t in texts:
        a, b = map(ends, tokens(t))
        cuts = sorted({e for e, _ in a} & {e for e, _ in b})
        pairs = [(i, j) for e, i in a for f, j in b if e == f] if len(a) < 400 else [(dict(a)[e], dict(b)[e]) for e in cuts]
        lo, groups = 0, []
        for c in cuts:
            groups.append("|".join(",".join(str(i) for e, i in side if lo < e <= c) for side in (a, b)))
            lo = c
        made.append((len(a), len(b), len(groups), ";".join(groups)))
        links.append(pairs)
    count = Counter(p for ps in links for p in ps)
    most = Counter()
    for (_, j), c in count.items():
        most[j] = max(most[j], c)
    return [(*x[:3], len(ps), sum(count[p] == most[p[1]] for p in ps), sum(count[p] for p in ps), hashlib.sha256(x[3].encode()).hexdigest() if x[0] else "") for x, ps in zip(made, links)]


def got(df, **how):
    return [tuple(r)[1:] for r in unpack(m.alignments(df, ["doc_id"], **how)).orderBy("doc_id").collect()]


ODD = [
    None, "", " ", "  ", "a ", " a", "\n", "\t\n x", "a▁b", "▁", "<s> </s> <unk> <|endoftext|> <0x41>", "it's we'll 'S ''s", "x   y    z", "über Ωmega 漢字かな 🙂🙂 \U000e0001",
    "a b　c", "1234567 3.14", "é é", "\x00\x01\x7f", "tab\tand  two", "end  ", "CamelCaseIdentifier_with_under-scores/and/paths", "don't stop\r\nnow",
]


def test_odd_texts_against_whole_encodings(spark):
    texts = ODD + ODD[10:14]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert got(df) == brute(texts)


def test_sample_tables(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text").orderBy("doc_id").limit(60).collect()
    df = spark.createDataFrame([(i, r.text) for i, r in enumerate(rows)], "doc_id long, text string")
    assert got(df) == brute([r.text for r in rows])


@pytest.mark.parametrize("seed", range(3))
def test_random_characters_tokenise_like_whole_texts(seed):
    r = random.Random(seed)
    pool = r.choice(["ab  \n\n", "ab  \n\t"]) + "'.-_1é漢🙂 ​\x85 st'llRE" + "".join(chr(r.randrange(0x20, 0x2FFF)) for _ in range(50))
    texts = ["".join(r.choice(pool) for _ in range(r.randrange(1, 60))) for _ in range(600)]
    good, a, ends_a, b, ends_b = m.aligner(m.BYTE_BPE, m.PIECES).tokenizers.texts([t.encode() for t in texts])
    want = [(A.encode(" " + t, add_special_tokens=False).ids, B.encode(t)) for t in texts]
    assert good.tolist() == [b"".join(map(piece, y)) == (" " + t).encode() for t, (_, y) in zip(texts, want)]
    for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
        cut = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert cut == [w[side] for w, g in zip(want, good) if g]


def test_very_long_text_without_a_space(spark):
    long = "".join(random.Random(1).choice("abcdeéz") for _ in range(60_000))
    df = spark.createDataFrame([(0, long), (1, long[:50] + " " + long[:50])], "doc_id long, text string")
    found = got(df)
    a, b = map(ends, tokens(long))
    assert found[0][:2] == (len(a), len(b)) and found[0][2] == len({e for e, _ in a} & {e for e, _ in b})


def test_memory_is_forgotten_without_a_trace(spark, monkeypatch):
    monkeypatch.setattr(m, "REMEMBERED", 3)
    monkeypatch.setattr(m, "LONG_WINDOW", 1)
    one = m.Aligner(m.BYTE_BPE, m.PIECES)
    texts = [t.encode() for t in ODD[4:] * 2]
    first, second = one.aligned(texts), one.aligned(texts)
    usual = m.aligner(m.BYTE_BPE, m.PIECES).aligned(texts)
    for k in usual:
        assert [list(x) if k == "links" else x for x in first[k]] == [list(x) if k == "links" else x for x in second[k]] == [list(x) if k == "links" else x for x in usual[k]]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert got(empty) == []
    df = spark.createDataFrame([(None, "a b", 5, [1]), (None, "a b", None, None)], "doc_id long, text string, n_a int, links array<int>")
    out = m.alignments(df, df.columns).collect()
    assert sorted((r.row.n_a or 0, r.res.n_a, r.res.count_sum) for r in out) == [(0, 2, 4), (5, 2, 4)]
