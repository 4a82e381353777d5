"""The pipeline against plain Python, stage by stage, on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as cp
from lociweave.llm.common import table, unpack
from lociweave.llm import quality
from lociweave.session import materialize
from test_decontamination import brute
from test_mixing import size, water
from test_secrets import base as secret_base
from test_nearcopies import groups
from test_text_counts import base


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = table(spark, sf, "documents")
    out = [docs]
    for _, f in cp.STAGES:
        out.append(materialize(f(spark, out[-1], sf)))
    return out


def test_stages(stages, spark, sf):
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality rules", "near duplicates", "benchmark decontamination", "secret scan", "source mix"]
    rows = [{r.doc_id: r for r in s.collect()} for s in stages]
    assert all(s.columns == stages[0].columns for s in stages[1:-1]) and stages[-1].columns[: len(stages[0].columns)] == stages[0].columns
    ratio = {r.doc_id: r.log_ratio for r in unpack(quality.quality(stages[0], table(spark, sf, "labels"), ["doc_id"])).collect()}
    assert set(rows[1]) == {d for d, r in rows[0].items() if not base(r.text)[5] and ratio[d] >= quality.THRESHOLD}
    ids = sorted(rows[1])
    roots, by_words = groups([rows[1][d].text for d in ids])
    assert by_words > 0 and set(rows[2]) == {ids[r] for r in set(roots)}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    found = brute([(d, r.text) for d, r in rows[2].items()], items)
    assert set(rows[3]) == {f[0] for f in found if not f[5]} and len(rows[3]) < len(rows[2])
    assert set(rows[4]) == set(rows[3])
    for d, r in rows[4].items():
        assert not secret_base(r.text) and r.n_chars == len(r.text)
        if not secret_base(rows[3][d].text) and "[SECRET]" not in r.text:
            assert r.text == rows[3][d].text
    sizes = {}
    for r in rows[4].values():
        sizes[r.source] = sizes.get(r.source, 0) + size(r.text)
    want = water(sizes)
    for s in sizes:
        own = [r for r in rows[5].values() if r.source == s]
        assert all(r.target == pytest.approx(want[s]) and 1 <= r.copies <= 3 for r in own)
        least = sorted(size(r.text) for r in rows[4].values() if r.source == s)
        assert abs(sum(r.taken for r in own) - want[s]) <= least[0] + least[min(3, len(least) - 1)]


def test_run_is_the_stages(spark, sf, stages):
    got = sorted(map(tuple, cp.run(spark, sf).collect()))
    assert got == sorted(map(tuple, stages[-1].collect()))
