"""Label expansion against plain Python, query by query."""

import random
from collections import Counter, defaultdict

import pytest

from lociweave.operators import expansion as X

LEVELS = list(X.LEVELS)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


NEAR = "query_id string, ref_id string, similarity double, evidence double, modality string, query_modality string"
GENES, LABELS, OWN = "ref_id string, gene_id string, weight double", "gene_id string, level string, label string", "query_id string, gene_id string"


def votes(rows, genes, labels, level, modality):
    """rows: (ref, evidence, modality) -> label, share, references, references of the modality."""
    mass, refs, same = Counter(), defaultdict(set), defaultdict(set)
    for ref, e, kind in rows:
        mine = {g: w for r, g, w in genes if r == ref}
        total = max(1.0, sum(mine.values()))
        got = Counter()
        for g, w in mine.items():
            if (g, level) in labels and e > 0:
                got[labels[g, level]] += w / total
        for text, w in got.items():
            mass[text] += e * min(1.0, w)
            refs[text].add(ref)
            if kind == modality:
                same[text].add(ref)
    if not mass:
        return None, 0, 0, 0
    best = min(mass, key=lambda t: (-mass[t], t))
    return best, mass[best] / sum(mass.values()), len(refs[best]), len(same[best])


def decide(mode, modality, raw, voted, kept, genes, labels, own, exact):
    """The rules one after the other."""
    v = {(p, l): votes(rows, genes, labels, l, modality) for p, rows in (("raw", raw), ("own", [r for r in raw if r[2] == modality]), ("voted", voted), ("kept", kept)) for l in LEVELS}
    named = {l: {labels[g, l] for g in own if (g, l) in labels} for l in LEVELS}
    comp, gen = modality == "compound", modality in ("orf", "crispr")
    need = 0.18 if comp else 0.24
    fit = lambda p, l: v[p, l][0] is not None and v[p, l][0] in named[l]
    sure = lambda p, l, n, k: v[p, l][1] * min(1.0, n / k) * X.LEVELS[l]
    if mode == "direct_target":
        return "mode_not_expandable", None, None, 0.0
    f, m = "target_family", "mechanism_label"
    o, w = v["own", f], v["voted", f]
    if comp and fit("own", f) and w[0] and not fit("voted", f) and w[2] <= max(3, o[2] - 1) and o[1] >= 0.2 and o[3] >= 2 and w[1] <= max(1.2 * o[1], 0.28):
        n = v["own", m]
        narrow = fit("own", m) and n[1] >= 0.15 and n[3] >= 2
        return ("compound_family_coherence_override", *((m, n[0], n[1]) if narrow else (f, o[0], o[1])))
    for l in LEVELS:
        r, o, w, k = (v[p, l] for p in ("raw", "own", "voted", "kept"))
        if not w[0]:
            continue
        astray = comp and named[l] and not fit("voted", l)
        if astray and fit("kept", l) and k[1] >= 0.15 and sure("kept", l, k[2], 2) >= need:
            return "retained_query_consistent_label_fallback", l, k[0], sure("kept", l, k[2], 2)
        if astray and l in LEVELS[:2] and any(
            (fit("voted", b) and v["voted", b][1] >= 0.18 and v["voted", b][2] >= 2) or (fit("kept", b) and v["kept", b][1] >= 0.15) for b in (m, f)):
            continue
        os = sure("own", l, o[2], 4)
        if comp and o[0] and o[0] != w[0] and (fit("own", l) or not named[l]) and o[2] >= max(2, w[2] + 1) and o[1] >= max(0.18, 0.9 * w[1]) and w[2] <= 2 and not (fit("voted", l) and fit("kept", l)) and os >= need:
            return "raw_same_modality_coherence_guard", l, o[0], os
        open_ = comp and not exact and not fit("voted", l) and (k[2] <= 2 or not fit("kept", l))
        if open_ and fit("own", l) and o[1] >= 0.15 and o[2] >= 2 and os >= need:
            return "raw_same_modality_query_consistent_label_fallback", l, o[0], os
        rs = sure("raw", l, max(r[2], r[3]), 4)
        if open_ and fit("raw", l) and r[1] >= 0.15 and (r[2] >= 3 or r[3] >= 2) and rs >= need:
            return "raw_query_consistent_label_fallback", l, r[0], rs
        c = sure("voted", l, w[2], 3) * (0.65 if gen and w[3] <= 0 else 1) * (0.75 if r[0] and r[0] != w[0] else 1)
        if r[0] == w[0]:
            c *= 1 + min(0.15, r[1] / 2)
        if c >= need:
            return "prelabel_coherent_label_support", l, w[0], c
    if mode == "mechanism" and gen:
        for l in LEVELS:
            for p in ("voted", "kept"):
                x = v[p, l]
                if fit(p, l) and x[3] > 0 and sure(p, l, max(x[2], x[3]), 2) >= 0.14:
                    return "genetic_query_consistent_label_fallback", l, x[0], sure(p, l, max(x[2], x[3]), 2)
    return "prelabel_label_support_too_weak", None, None, 0.0


def world(seed, queries=160):
    r = random.Random(seed)
    genes = [f"g{i}" for i in range(16)]
    labels = {}
    for i, g in enumerate(genes):
        for l, n in zip(LEVELS, (8, 6, 4, 3)):
            if r.random() < 0.85:
                labels[g, l] = f"{l[:2]}{(i * 7 + r.randrange(2)) % n}"
    refs = {f"r{i}": r.choice(["compound", "compound", "orf", "crispr"]) for i in range(24)}
    of_ref = [(x, g, r.choice([0.25, 0.5, 1.0, 1.5])) for x in refs for g in r.sample(genes, r.randrange(0, 4))]
    cases = []
    for q in range(queries):
        kind = r.choice(["compound", "compound", "compound", "orf", "crispr", None])
        pool = lambda n: [(x, float(r.choice([1, 1, 2, 4, 8])), refs[x]) for x in r.sample(sorted(refs), n)]
        raw = pool(r.randrange(0, 9))
        voted = r.choice([pool(r.randrange(0, 3)), pool(r.randrange(2, 7)), [(x, e * 2, m) for x, e, m in raw[:3]]])
        kept = r.choice([raw[:2], pool(r.randrange(0, 4)), voted])
        cases.append((f"q{q}", kind, raw, voted, kept, r.sample(genes, r.randrange(0, 3)), r.random() < 0.3))
    return labels, of_ref, cases


def pool_frame(spark, cases, at):
    rows = [(c[0], x, e, e, m, c[1]) for c in cases for x, e, m in c[at]]
    return table(spark, rows, NEAR)


@pytest.mark.parametrize("mode", ["hybrid", "mechanism", "direct_target"])
def test_decisions_against_rules_in_order(spark, mode):
    seen = Counter()
    for seed in range(3):
        labels, of_ref, cases = world(seed, 220)
        lab = table(spark, [(g, l, t) for (g, l), t in labels.items()], LABELS)
        own = table(spark, [(c[0], g) for c in cases for g in c[5]], OWN)
        q = table(spark, [(c[0], c[1]) for c in cases], "query_id string, query_modality string")
        exact = table(spark, [(c[0],) for c in cases if c[6]], "query_id string")
        ref_labels = X.reference_labels(table(spark, of_ref, GENES), lab)
        out = X.expansion_decision(q, *[pool_frame(spark, cases, k) for k in (2, 3, 4)], ref_labels, X.own_labels(own, lab), exact, mode)
        got = {r.query_id: r for r in out.collect()}
        assert len(got) == len(cases)
        for c in cases:
            want = decide(mode, c[1], *c[2:5], of_ref, labels, c[5], c[6])
            g = got[c[0]]
            assert (g.reason, g.level, g.label) == want[:3] and g.confidence == pytest.approx(want[3]), (c, want, g)
            assert g.allow == (want[1] is not None) and g.allow_family == (want[1] == "target_family") and g.needs_same_modality == (c[1] in ("orf", "crispr"))
            seen[want[0]] += 1
    if mode == "mechanism":
        assert len(seen) == 8, seen


def expand(scores, choice, near, of_ref, labels, own, bundle):
    """choice: (level, label, confidence) or None."""
    if not choice:
        return dict(scores), set()
    level, text, conf = choice
    has = lambda g, l=level, t=text: labels.get((g, l)) == t
    every = {g for g, l in labels if l == level and has(g)}
    local = Counter()
    touched = set()
    for ref, e in near:
        for r, g, w in of_ref:
            if r == ref and has(g):
                local[g] += e * w
                touched.add(g)
    cand = every & bundle or touched or every
    if level != "target_family":
        cand = every
    mine = {g for g in own if has(g)}
    cand = cand | mine
    if not cand:
        return dict(scores), set()
    below = LEVELS[: LEVELS.index(level)]
    liked, strength, asked = {}, {}, set()
    for b in below:
        mass, n = Counter(), Counter()
        for g in cand:
            if (g, b) in labels:
                mass[labels[g, b]] += local[g]
                n[labels[g, b]] += 1
        hit = {labels[g, b] for g in own if (g, b) in labels and mass[labels[g, b]] > 0}
        if hit:
            liked[b], strength[b] = hit, max(mass[t] for t in hit)
            asked.add(b)
        elif sum(mass.values()) > 0:
            t = max(mass, key=lambda t: (mass[t], n[t], t))
            if mass[t] / sum(mass.values()) >= 0.6 and n[t] >= 2:
                liked[b], strength[b] = {t}, mass[t]
    ok = lambda g, levels: [b for b in levels if labels.get((g, b)) in liked.get(b, ())]
    if asked:
        cand = {g for g in cand if ok(g, asked)} | mine
    weight = {}
    for g in cand:
        w = local[g] + 0.25 * len({r for r, x, _ in of_ref if x == g}) + 0.25 * sum(strength[b] for b in ok(g, below))
        w *= 0.25 if asked and not ok(g, asked) else 1
        weight[g] = max(w, 0.75 + 2.5 * max([strength[b] for b in ok(g, below)], default=0)) if g in mine else w
    mass = max(1e-6, 0.35 * sum(scores.values()) * conf)
    out = {g: s * (1 if g in cand else max(0.2, 1 - 1.1 * conf)) for g, s in scores.items() if s > 0}
    total = sum(weight.values())
    added = {g for g, w in weight.items() if w > 0}
    for g in added:
        out[g] = out.get(g, 0) + mass * weight[g] / total
    return out, added


def test_expansion_against_plain_python(spark):
    reach = set()
    for seed in range(3):
        r = random.Random(100 + seed)
        labels, of_ref, cases = world(seed, 120)
        bundle = set(r.sample([f"g{i}" for i in range(16)], 5))
        texts = sorted({(l, t) for (_, l), t in labels.items()} | {("target_family", "none such")})
        made = []
        for c in cases:
            choice = None if r.random() < 0.1 else (*r.choice(texts), r.choice([0.1, 0.3, 0.9]))
            scores = {g: r.choice([0.0, 0.5, 1.0, 2.0]) for g in r.sample([f"g{i}" for i in range(20)], r.randrange(0, 6))}
            made.append((c[0], choice, scores, [(x, e) for x, e, _ in c[2]], c[5]))
        decisions = table(spark, [(q, *(ch or (None, None, 0.0))) for q, ch, *_ in made], "query_id string, level string, label string, confidence double")
        out = X.expand_by_label(
            table(spark, [(q, g, s) for q, _, sc, *_ in made for g, s in sc.items()], "query_id string, gene_id string, score double"), decisions,
            table(spark, [(q, x, e) for q, _, _, near, _ in made for x, e in near], "query_id string, ref_id string, evidence double"),
            table(spark, of_ref, GENES), table(spark, [(g, l, t) for (g, l), t in labels.items()], LABELS), table(spark, [(q, g) for *x, own in made for q, g in [(x[0], g) for g in own]], OWN),
            table(spark, [(g,) for g in bundle], "gene_id string"))
        got = defaultdict(dict)
        for row in out.collect():
            got[row.query_id][row.gene_id] = row
            reach.add(row.scope)
        for q, choice, scores, near, own in made:
            want, added = expand(scores, choice, near, of_ref, labels, own, bundle)
            assert {g: x.score for g, x in got[q].items()} == pytest.approx(want), (q, choice)
            assert {g for g, x in got[q].items() if x.expanded} == added
    assert reach == {"none", "bundle", "local", "global"}


def voters(cands, of_ref, labels, own, pooled, protected, top_n=2, ratio=0.9, most=20):
    """cands: (ref, similarity, modality, qc) by similarity."""
    named = {l: {labels[g, l] for g in own if (g, l) in labels} for l in LEVELS}
    of = lambda ref, l: {labels[g, l] for x, g, _ in of_ref if x == ref and (g, l) in labels}
    same = [(i, c) for i, c in enumerate(cands) if c[2] == "compound"]
    near = [c for k, (i, c) in enumerate(same) if k < top_n or c[1] >= ratio * cands[0][1]]
    mine = lambda ref: any(x == ref and g in own for x, g, _ in of_ref)
    vote = {c[0] for c in near if mine(c[0]) or any(of(c[0], l) & named[l] for l in LEVELS) or not any(named.values())}
    coherent, best = set(), None
    if len(near) >= 2:
        for l in LEVELS:
            t, mass, n, s = votes([(c[0], c[1] * c[3], c[2]) for c in near], of_ref, labels, l, "compound")
            fits = t in named[l]
            if t and s >= 2 and (fits and mass >= 0.16 or not named[l] and n >= 3 and mass >= 0.32):
                if best is None or (fits, mass, n, t) > best[0]:
                    best = ((fits, mass, n, t), l)
        if best:
            coherent = {c[0] for c in near if best[0][3] in of(c[0], best[1])}
    out = {}
    for i, (ref, sim, kind, qc) in enumerate(cands):
        if ref in vote | coherent | pooled | protected:
            e = sim * qc * (1.3 if kind == "compound" else 1) * (1.1 if i < 6 else 1) * (1.15 if ref in vote else 1) * (1.2 if ref in coherent else 1)
            e *= (1.05 if ref in protected else 1) * (1.25 if mine(ref) else 1)
            e *= next((b for l, b in zip(LEVELS, (1.2, 1.15, 1.12, 1.08)) if of(ref, l) & named[l]), 1)
            out[ref] = e
    return out


def test_voters_and_boosts(spark):
    r = random.Random(4)
    labels, of_ref, cases = world(9, 60)
    refs = sorted({x for x, _, _ in of_ref})
    made, rows = [], []
    for c in cases:
        picked = r.sample(refs, r.randrange(1, len(refs)))
        sims = sorted((r.randrange(50, 100) / 100 for _ in picked), reverse=True)
        cands = [(x, s, r.choice(["compound", "compound", "orf"]), r.choice([0.5, 1.0])) for x, s in zip(picked, sims)]
        pooled, protected = set(r.sample(picked, min(len(picked), 3))), set(r.sample(picked, min(len(picked), 1)))
        made.append((c[0], cands, c[5], pooled, protected))
        rows += [(c[0], x, s, m, "compound", q, i) for i, (x, s, m, q) in enumerate(cands, 1)]
    rows += [("other", refs[0], 0.9, "orf", "orf", 1.0, 1)]
    frame = table(spark, rows, "query_id string, ref_id string, similarity double, modality string, query_modality string, qc double, raw_rank int")
    pair = lambda k: table(spark, [(m[0], x) for m in made for x in m[k]], "query_id string, ref_id string")
    out = X.vote_neighbours(frame, table(spark, of_ref, GENES), table(spark, [(g, l, t) for (g, l), t in labels.items()], LABELS),
                            table(spark, [(m[0], g) for m in made for g in m[2]], OWN), pair(3), pair(4), first=2)
    got = defaultdict(dict)
    for x in out.collect():
        got[x.query_id][x.ref_id] = x.evidence
    assert "other" not in got
    for q, cands, own, pooled, protected in made:
        assert got[q] == pytest.approx(voters(cands, of_ref, labels, own, pooled, protected)), q


def test_voters_cut_keeps_those_kept_anyway(spark):
    rows = [("q", f"r{i:03d}", 1.0 - i / 1000, "orf", "compound", 1.0, i + 1) for i in range(100)]
    frame = table(spark, rows, "query_id string, ref_id string, similarity double, modality string, query_modality string, qc double, raw_rank int")
    every = frame.select("query_id", "ref_id")
    out = X.vote_neighbours(frame, table(spark, [], GENES), table(spark, [], LABELS), table(spark, [], OWN), every, every.filter("ref_id = 'r099'"), max_neighbours=2)
    got = {r.ref_id for r in out.collect()}
    assert len(got) == 60 and "r099" in got and "r058" in got and "r059" not in got


def test_preferred_variant(spark):
    d = table(spark, [("a", 0.3), ("b", 0.1), ("c", 0.1), ("d", 0.0), ("e", 0.5)], "query_id string, confidence double")
    core = table(spark, [("a", "x", 1.0), ("b", "x", 3.0), ("b", "y", 1.0), *[("c", g, 1.0) for g in "xyz"], ("e", "x", 1.0)], "query_id string, gene_id string, score double")
    more = table(spark, [("a", "x", 1.0), ("a", "y", 1.0), ("b", "x", 1.0), ("c", "x", 1.0), ("e", "y", 1.0)], "query_id string, gene_id string, score double")
    got = {r.query_id: (r.variant, r.why) for r in X.preferred_variant(core, more, d).collect()}
    assert got == {"a": ("expanded", "expansion_confidence"), "b": ("core", "exact_target_confidence"), "c": ("expanded", "fallback_expanded"), "d": ("core", "fallback_core"), "e": ("core", "exact_target_confidence")}
    assert {r.why for r in X.preferred_variant(core, more, d, "mechanism").collect()} == {"mechanism_mode"}


def test_profile_query_expands_by_the_agreed_label(spark):
    from lociweave.plans import morphology as MO

    prof = {"q1": (0.95, 0.05, 0), "q2": (0, 0.1, 1), **{f"r{i}": (1, 0.03 * i, 0) for i in range(5)}, "far": (0, 0, 1)}
    long = lambda names: table(spark, [(k, f"f{i}", float(x)) for k in names for i, x in enumerate(prof[k])], "id string, feature string, value double")
    refs = [k for k in prof if k[0] != "q"]
    meta = table(spark, [(k, "compound" if k != "far" else "orf", "GF" if k == "far" else None, f"c{k}", False, 1.0, 0.1) for k in refs],
                 "id string, modality string, gene_symbol string, compound_id string, is_control boolean, qc_weight double, hub_score double")
    targets = table(spark, [(f"cr{i}", f"G{i % 3}", 1.0) for i in range(5)], "compound_id string, gene_id string, weight double")
    labels = table(spark, [(f"G{i}", lv, t) for i in range(3) for lv, t in (("family", "kinase"), ("mechanism", "m1"))] + [("GX", "mechanism", "m1"), ("GY", "family", "kinase"), ("GF", "mechanism", "m1")], LABELS)
    members = table(spark, [("q1", "compound"), ("q2", "orf")], "query_id string, modality string")
    out = MO.morphology_profile_query(long(["q1", "q2"]), long(refs), meta, targets, members, controls="none", mode="hybrid", gene_labels=labels,
                                      own_genes=table(spark, [("q1", "G1")], OWN), select={"how": "none"}, min_similarity=0.1)
    decided = {r.query_id: r for r in out["decision"].collect()}
    assert decided["q1"].level == "mechanism_label" and decided["q1"].label == "m1" and decided["q1"].reason == "prelabel_coherent_label_support"
    genes = {(r.query_id, r.gene_id) for r in out["genes"].collect()}
    # GF carries the label and is no neighbour's target; nothing at all backs GX, and GY only shares the family.
    assert ("q1", "GF") in genes and ("q1", "GX") not in genes and ("q1", "GY") not in genes
    assert {r.query_id: r.variant for r in out["variant"].collect()}["q1"] == "expanded"
    plain = MO.morphology_profile_query(long(["q1"]), long(refs), meta, targets, controls="none", mode="direct_target", gene_labels=labels, select={"how": "none"})
    assert "decision" not in plain and {r.gene_id for r in plain["genes"].collect()} <= {"G0", "G1", "G2", "GF"}


def test_votes_shuffle_no_labels_and_count_a_repeated_reference_once(spark):
    near = table(spark, [("q", "r1", 0.5, 1.0, "orf", "orf"), ("q", "r1", 0.5, 2.0, "orf", "orf"), ("q", "r2", 0.5, 1.0, None, "orf"), ("q", "r3", 0.5, 0.0, "orf", "orf")], NEAR)
    labels = table(spark, [(r, "target_class", t, w) for r in ("r1", "r2", "r3") for t, w in (("a", 0.75), ("b", 0.25))], "ref_id string, level string, label string, weight double")
    votes = X.level_votes(near, labels)
    plan = votes._jdf.queryExecution().executedPlan().toString()
    # A distinct count multiplies the rows that go into the shuffle.
    assert "Expand" not in plan
    assert [tuple(r) for r in votes.collect()] == [("q", "target_class", "a", 0.75, 2, 1)]


def test_label_expansion_reads_what_it_wrote(spark):
    from lociweave.catalog import expansions

    found = expansions.label_expansion(spark, "/root/testdata/sf0.001")
    assert not any(f.endswith("part.parquet") or "part.parquet/" in f for f in found.inputFiles())
