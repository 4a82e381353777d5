import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociweave.llm import quality, tokens
from lociweave.llm.common import unpack
from tests_llm_prose import prose

ODD = [
    None, "", " ", "\n\n", "<|endoftext|>a<|endoftext|>", "don't 's  \n\n x's''s''s  we'LL I'll", "a  b\n c \t\td", "aaaaaaa" * 90, "日本語 ١٢٣ ½ ² ñ́  x y\x85z \x1cq\x1dz",
    "🙂🙂 ‍ x", "word " * 4000, prose(3, 3000), "x" * 30000, "a b c", "\x00\x01", "|| ## $ % & < > *",
]


def test_tokens_match_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = [(i, t) for i, t in enumerate(ODD)] + [(3, ODD[5]), (None, "x y")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_tokens", F.lit("mine"))
    got = unpack(tokens.token_counts(df, ["doc_id"])).collect()
    want = [(d, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t in docs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_every_character(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    chars = [chr(i) for i in range(0, 0x30000, 7) if not 0xD800 <= i <= 0xDFFF]
    texts = [f"a{c}1 {c}{c} ." for c in chars]
    assert tokens.merger(tokens.VOCABULARY).tokens(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_merger_forgets_and_goes_on(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    m = tokens.merger(tokens.VOCABULARY)
    once = m.tokens(["some words here", "more of them"])
    assert m.tokens(["some words here", "more of them"]) == once


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert unpack(tokens.token_counts(empty, ["doc_id"])).count() == 0


def base(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(wins) if wins.count(w) > 1 for k in range(3)}
    lines, seen, dup = t.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    n, r = len(words), len(covered)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, r, n < 50 or 100 * r > 50 * n)


@pytest.fixture(scope="module")
def judged(spark):
    texts = [t for t in ODD if t is None or len(t) < 3000] + [prose(i, 120) for i in range(40)] + ["alpha beta gamma " * 30, "one line here\n" * 40, "é è ü ß " * 15 + "\r\n\x0b"]
    texts += [" ".join(w.upper() + "!!" for w in prose(100 + i, 80).split()) for i in range(12)] + [prose(5, 120)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(None, texts[-1], "clash")], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, int(bool(t) and "!!" not in t), 0) for i, t in enumerate(texts)], "doc_id long, quality int, toxic int")
    rows = unpack(quality.quality(docs, labels, ["doc_id"], buckets=1 << 12)).collect()
    return texts, {r.doc_id: r for r in rows}


def test_base_counts(judged):
    texts, rows = judged
    for i, t in enumerate(texts):
        assert tuple(rows[i])[1:7] == base(t), (i, t)


def test_rejected_fail_and_ratio_decides(judged):
    texts, rows = judged
    assert not any(r.kept and r.base_failed for r in rows.values())
    clean = [rows[i] for i, t in enumerate(texts) if t in {prose(k, 120) for k in range(40)}]
    shouted = [rows[i] for i, t in enumerate(texts) if t and "!!" in t]
    assert all(r.kept for r in clean) and not any(r.kept for r in shouted)


def test_ratio_is_the_mean_log_ratio(spark):
    docs = [(i, prose(i, 60)) for i in range(20)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r.log_ratio for r in unpack(quality.quality(d, labels, ["doc_id"], buckets=512)).collect()}
    grams = {i: quality.ngram_buckets(quality.word_hashes(t.encode().split()), 512) for i, t in docs}
    count = lambda ids: sum(np.bincount(grams[i], minlength=512) for i in ids)
    raw, good = count(range(20)), count(range(5))
    p = (raw + 1) / (raw.sum() + 512)
    q = (good + 512 * p) / (good.sum() + 512)
    for i in grams:
        assert got[i] == pytest.approx(float((np.log(q) - np.log(p))[grams[i]].mean()), abs=1e-12)


def test_quality_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(1, prose(1, 60)), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in unpack(quality.quality(docs, labels, ["doc_id"])).collect()}
    assert rows[1].kept and rows[1].log_ratio == 0 and not rows[2].kept and rows[2].base_failed
    assert unpack(quality.quality(docs.limit(0), labels, ["doc_id"])).count() == 0
