"""Expansion of a query's genes by a label that its neighbours agree on.

Three steps, each for all queries at once: which neighbours may vote
(``vote_neighbours``), which label at which level is trusted
(``expansion_decision``), and what the label does to gene scores
(``expand_by_label``).

Frames: neighbours (query_id, ref_id, similarity, evidence, modality,
query_modality), genes of references (ref_id, gene_id, weight), labels of
genes (gene_id, level, label), and genes that queries name themselves
(query_id, gene_id). Empty labels are left out of the label frame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociweave.operators.joins import attach
from lociweave.operators.selection import top_k
from lociweave.session import materialize

# Levels from narrow to broad, with the certainty that a vote of the level carries.
LEVELS = {"pathway_seed": 1.0, "target_class": 0.92, "mechanism_label": 0.85, "target_family": 0.75}
# Boosts of a compound query's voters.
BOOST = {"same_modality": 1.30, "leading": 1.10, "voter": 1.15, "coherent": 1.20, "protected": 1.05, "own_gene": 1.25}
LABEL_BOOST = {"pathway_seed": 1.20, "target_class": 1.15, "mechanism_label": 1.12, "target_family": 1.08}
# Confidence that a decision needs, by kind of query.
THRESHOLD, COMPOUND_THRESHOLD, GENETIC_THRESHOLD = 0.24, 0.18, 0.14


def reference_labels(ref_genes: DataFrame, gene_labels: DataFrame) -> DataFrame:
    """(ref_id, level, label, weight): weight of the genes that carry the label, 1 at most in all."""
    per_ref = ref_genes.groupBy("ref_id").agg(F.sum("weight").alias("_t"))
    scaled = attach(ref_genes, per_ref, ["ref_id"]).withColumn("weight", F.col("weight") / F.greatest(F.lit(1.0), F.col("_t")))
    found = scaled.filter("weight > 0").join(gene_labels, "gene_id").groupBy("ref_id", "level", "label").agg(F.sum("weight").alias("weight"))
    return found.withColumn("weight", F.least(F.lit(1.0), "weight"))


def _label_sets(ref_labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ref_id, set_id) and (set_id, labels): references with the same labels and weights share one set."""
    packed = ref_labels.groupBy("ref_id").agg(F.sort_array(F.collect_list(F.struct("level", "label", "weight"))).alias("labels"))
    packed = materialize(packed)
    sets = materialize(packed.groupBy("labels").agg(F.min("ref_id").alias("set_id")))
    return packed.join(sets, "labels").select("ref_id", "set_id"), sets.select("set_id", "labels")


def pool_votes(pools: DataFrame, ref_labels: DataFrame) -> DataFrame:
    """``level_votes`` of several pools of neighbours at once, those of ``pool``.

    The neighbours are dealt by query with the number of their label set; what
    follows stays where the query is, so labels are never shuffled.
    """
    same = F.coalesce(F.col("modality") == F.col("query_modality"), F.lit(False))
    of, sets = _label_sets(ref_labels)
    rows = pools.filter("evidence > 0").select("query_id", "pool", "ref_id", "evidence", same.alias("_same")).join(of, "ref_id").repartition("query_id")
    once = rows.groupBy("query_id", "pool", "ref_id").agg(F.sum("evidence").alias("evidence"), F.max("_same").alias("_same"), F.first("set_id").alias("set_id"))
    by_set = once.groupBy("query_id", "pool", "set_id").agg(F.sum("evidence").alias("evidence"), F.count("*").alias("_n"), F.count_if("_same").alias("_s"))
    votes = (
        by_set.join(sets, "set_id").select("query_id", "pool", "evidence", "_n", "_s", F.inline("labels")).groupBy("query_id", "pool", "level", "label")
        .agg(F.sum(F.col("evidence") * F.col("weight")).alias("_m"), F.sum("_n").alias("support"), F.sum("_s").alias("same"))
    )
    first = F.min_by(F.struct("label", "_m", "support", "same"), F.struct((-F.col("_m")).alias("m"), F.col("label").alias("l"))).alias("_b")
    led = votes.groupBy("query_id", "pool", "level").agg(first, F.sum("_m").alias("_t")).filter("_t > 0")
    return led.select("query_id", "pool", "level", "_b.label", (F.col("_b._m") / F.col("_t")).alias("mass"), "_b.support", "_b.same")


def level_votes(neighbours: DataFrame, ref_labels: DataFrame) -> DataFrame:
    """Leading label per (query, level): label, its share ``mass``, references behind it, and those of the query's modality."""
    return pool_votes(neighbours.withColumn("pool", F.lit("")), ref_labels).drop("pool")


def own_labels(own_genes: DataFrame, gene_labels: DataFrame) -> DataFrame:
    """(query_id, level, label) of the genes that queries name."""
    return own_genes.join(gene_labels, "gene_id").select("query_id", "level", "label").distinct()


def _near(candidates: DataFrame, within: int, first: int, ratio: float) -> DataFrame:
    """Among a query's ``within`` most similar references, those of its modality that lead it or come near the best."""
    best = candidates.groupBy("query_id").agg(F.max("similarity").alias("_best"))
    same = attach(candidates.filter((F.col("raw_rank") <= within) & (F.col("modality") == F.col("query_modality"))), best, ["query_id"])
    led = top_k(same, ["query_id"], first, [F.col("raw_rank").asc()], "_n").select("query_id", "ref_id", F.lit(True).alias("_led"))
    out = same.join(led, ["query_id", "ref_id"], "left")
    return out.filter(F.coalesce("_led", F.lit(False)) | (F.col("similarity") >= ratio * F.col("_best"))).drop("_led", "_best")


def coherent_references(candidates: DataFrame, ref_labels: DataFrame, query_labels: DataFrame, first: int = 5, ratio: float = 0.9) -> DataFrame:
    """(query_id, ref_id): near neighbours that share the label on which near neighbours agree best.

    ``candidates`` has raw_rank (from 1 by similarity) and qc. A level counts if
    at least two references of the query's modality back its label, and the
    label is one of the query's own with a share of .16, or the query names no
    label at the level and three references back it with .32. Own labels come
    before others, then share, references and the label itself.
    """
    near = _near(candidates, max(40, 8 * first), first, ratio).withColumn("evidence", F.col("similarity") * F.col("qc"))
    some = near.groupBy("query_id").agg(F.count("*").alias("_n")).filter("_n >= 2").drop("_n")
    votes = level_votes(near.join(some, "query_id", "left_semi"), ref_labels)
    named = query_labels.groupBy("query_id", "level").agg(F.lit(True).alias("_named"))
    hit = query_labels.withColumn("_own", F.lit(True))
    v = votes.join(named, ["query_id", "level"], "left").join(hit, ["query_id", "level", "label"], "left")
    own, free = F.coalesce("_own", F.lit(False)), F.col("_named").isNull()
    fit = (F.col("same") >= 2) & ((own & (F.col("mass") >= 0.16)) | (free & (F.col("support") >= 3) & (F.col("mass") >= 0.32)))
    order = F.struct(own.cast("int").alias("o"), F.col("mass"), F.col("support"), F.col("label"), (-_order("level")).alias("l"))
    chosen = v.filter(fit).groupBy("query_id").agg(F.max_by(F.struct("level", "label"), order).alias("_c")).select("query_id", "_c.*")
    return near.join(ref_labels.drop("weight"), "ref_id").join(chosen, ["query_id", "level", "label"], "left_semi").select("query_id", "ref_id").distinct()


def _order(level: str) -> Column:
    out = F.lit(len(LEVELS))
    for i, name in enumerate(LEVELS):
        out = F.when(F.col(level) == name, F.lit(i)).otherwise(out)
    return out


def voting_references(candidates: DataFrame, ref_genes: DataFrame, ref_labels: DataFrame, own_genes: DataFrame, query_labels: DataFrame, first: int = 5, ratio: float = 0.9) -> DataFrame:
    """(query_id, ref_id): near neighbours with a gene or a label that the query names; all near ones where it names no label."""
    near = _near(candidates, max(80, 8 * first), first, ratio).select("query_id", "ref_id")
    by_gene = near.join(ref_genes.join(own_genes, "gene_id").select("query_id", "ref_id"), ["query_id", "ref_id"], "left_semi")
    by_label = near.join(ref_labels, "ref_id").join(query_labels, ["query_id", "level", "label"], "left_semi").select("query_id", "ref_id")
    unnamed = near.join(query_labels, "query_id", "left_anti")
    return by_gene.unionByName(by_label).unionByName(unnamed).distinct()


def vote_neighbours(
    candidates: DataFrame, ref_genes: DataFrame, gene_labels: DataFrame, own_genes: DataFrame, pooled: DataFrame, protected: DataFrame,
    max_neighbours: int = 20, min_effective: int = 5, first: int = 5, ratio: float = 0.9,
) -> DataFrame:
    """Voters of compound queries with boosted evidence: query_id, ref_id, similarity, evidence, modality, query_modality, kept_anyway.

    ``candidates`` has query_id, ref_id, similarity, modality, query_modality, qc
    and raw_rank; ``pooled`` and ``protected`` (query_id, ref_id) vote besides
    the coherent and the voting references. Evidence is similarity times
    quality, times a boost for each thing a voter has going for it; of labels
    that it shares with the query the narrowest counts. Voters are cut to
    eight times ``max_neighbours`` (at least 60), those kept anyway first to stay.
    """
    c = candidates.filter("query_modality = 'compound'").select("query_id", "ref_id", "similarity", "modality", "query_modality", "qc", "raw_rank")
    ref_labels, query_labels = reference_labels(ref_genes, gene_labels), own_labels(own_genes, gene_labels)
    flags = {
        "voter": voting_references(c, ref_genes, ref_labels, own_genes, query_labels, first, ratio),
        "coherent": coherent_references(c, ref_labels, query_labels, first, ratio),
        "protected": protected.select("query_id", "ref_id").distinct(),
        "_pooled": pooled.select("query_id", "ref_id").distinct(),
        "own_gene": ref_genes.join(own_genes, "gene_id").select("query_id", "ref_id").distinct(),
    }
    shared = c.select("query_id", "ref_id").join(ref_labels, "ref_id").join(query_labels, ["query_id", "level", "label"], "left_semi")
    out = c.join(shared.groupBy("query_id", "ref_id").agg(F.min(_order("level")).alias("_l")), ["query_id", "ref_id"], "left")
    for name, marked in flags.items():
        out = out.join(marked.withColumn(name, F.lit(True)), ["query_id", "ref_id"], "left").withColumn(name, F.coalesce(name, F.lit(False)))
    out = out.filter("voter or coherent or protected or _pooled")
    out = out.withColumns({"same_modality": F.col("modality") == F.col("query_modality"), "leading": F.col("raw_rank") <= 6})
    evidence = F.col("similarity") * F.col("qc")
    for name, factor in BOOST.items():
        evidence = evidence * F.when(F.col(name), factor).otherwise(1.0)
    for i, factor in enumerate(LABEL_BOOST.values()):
        evidence = evidence * F.when(F.col("_l") == i, factor).otherwise(1.0)
    out = out.withColumns({"evidence": evidence, "kept_anyway": F.col("voter") | F.col("coherent") | F.col("protected")})
    order = [F.col("kept_anyway").desc(), F.col("evidence").desc(), F.col("similarity").desc(), F.col("ref_id").asc()]
    cut = top_k(out, ["query_id"], max(8 * max_neighbours, min_effective, 60), order, "_r")
    return cut.select("query_id", "ref_id", "similarity", "evidence", "modality", "query_modality", "kept_anyway")


POOLS = ("raw", "own", "voted", "kept")


class _Seen:
    """Columns of one query: the leading vote of each pool at each level, and whether the query names its label."""

    @staticmethod
    def columns() -> dict[str, Column]:
        """The votes and named labels of the maps ``_votes`` and ``_named`` as plain columns."""
        out = {}
        for level in LEVELS:
            named = F.element_at("_named", F.lit(level))
            out[f"_names_{level}"] = F.coalesce(F.size(named) > 0, F.lit(False))
            for pool in POOLS:
                vote = F.element_at("_votes", F.lit(f"{pool} {level}"))
                out[f"_{pool}_{level}_label"] = vote.getField("label")
                out |= {f"_{pool}_{level}_{f}": F.coalesce(vote.getField(f), F.lit(0)) for f in ("mass", "support", "same")}
                out[f"_{pool}_{level}_fits"] = F.coalesce(F.array_contains(named, vote.getField("label")), F.lit(False))
        return out

    def vote(self, pool: str, level: str, field: str) -> Column:
        return F.col(f"_{pool}_{level}_{field}")

    def has(self, pool: str, level: str) -> Column:
        return self.vote(pool, level, "label").isNotNull()

    def names(self, level: str) -> Column:
        return F.col(f"_names_{level}")

    def fits(self, pool: str, level: str) -> Column:
        """Whether the vote's label is one that the query names."""
        return F.col(f"_{pool}_{level}_fits")

    def sure(self, pool: str, level: str, references: Column, enough: int) -> Column:
        """Share of the vote, less where few references are behind it, and by the level's certainty."""
        return self.vote(pool, level, "mass") * F.least(F.lit(1.0), references / float(enough)) * LEVELS[level]


def _fired(when: Column, reason: str, level: str, label: Column, confidence: Column) -> Column:
    value = F.struct(F.lit(reason).alias("reason"), F.lit(level).alias("level"), label.alias("label"), confidence.cast("double").alias("confidence"))
    return F.when(when, value)


def _override(s: _Seen) -> list[Column]:
    """A compound's own modality agrees with the family that it names, and the voters' other family is shallow."""
    fam, mech = "target_family", "mechanism_label"
    own, voted = lambda f: s.vote("own", fam, f), lambda f: s.vote("voted", fam, f)
    apply = (
        F.col("_compound") & s.fits("own", fam) & s.names(fam) & s.has("voted", fam) & ~s.fits("voted", fam)
        & (voted("support") <= F.greatest(F.lit(3), own("support") - 1)) & (own("mass") >= 0.20) & (own("same") >= 2)
        & (voted("mass") <= F.greatest(1.20 * own("mass"), F.lit(0.28)))
    )
    narrow = s.fits("own", mech) & (s.vote("own", mech, "mass") >= 0.15) & (s.vote("own", mech, "same") >= 2)
    reason = "compound_family_coherence_override"
    return [
        _fired(apply & narrow, reason, mech, s.vote("own", mech, "label"), s.vote("own", mech, "mass")),
        _fired(apply, reason, fam, own("label"), own("mass")),
    ]


def _at_level(s: _Seen, level: str) -> tuple[Column, Column]:
    """What a level decides, null if nothing; and whether it says nothing because a broader level fits the query."""
    vote = lambda pool, field: s.vote(pool, level, field)
    compound, threshold = F.col("_compound"), F.when(F.col("_compound"), COMPOUND_THRESHOLD).otherwise(THRESHOLD)
    label, mass, support = vote("voted", "label"), vote("voted", "mass"), vote("voted", "support")
    fits = {p: s.fits(p, level) for p in POOLS}
    astray = compound & s.names(level) & ~fits["voted"]
    weak_kept = (vote("kept", "support") <= 2) | ~fits["kept"]
    unsupported = compound & ~F.col("_exact") & ~fits["voted"] & weak_kept

    broader = F.lit(False)
    if level in ("pathway_seed", "target_class"):
        for wide in ("mechanism_label", "target_family"):
            voted = s.fits("voted", wide) & (s.vote("voted", wide, "mass") >= 0.18) & (s.vote("voted", wide, "support") >= 2)
            kept = s.fits("kept", wide) & (s.vote("kept", wide, "mass") >= 0.15) & (s.vote("kept", wide, "support") >= 1)
            broader = broader | voted | kept

    differs = s.has("raw", level) & (vote("raw", "label") != label)
    agrees = s.has("raw", level) & (vote("raw", "label") == label)
    voted_sure = s.sure("voted", level, support, 3)
    voted_sure = voted_sure * F.when(F.col("_genetic") & (vote("voted", "same") <= 0), 0.65).otherwise(1.0) * F.when(differs, 0.75).otherwise(1.0)
    voted_sure = voted_sure * F.when(agrees, 1.0 + F.least(F.lit(0.15), 0.5 * vote("raw", "mass"))).otherwise(1.0)

    kept_sure = s.sure("kept", level, vote("kept", "support"), 2)
    own_sure = s.sure("own", level, vote("own", "support"), 4)
    raw_most = F.greatest(vote("raw", "support"), vote("raw", "same"))
    raw_sure = s.sure("raw", level, raw_most, 4)
    rival = (
        compound & s.has("own", level) & (vote("own", "label") != label) & (fits["own"] | ~s.names(level))
        & (vote("own", "support") >= F.greatest(F.lit(2), support + 1)) & (vote("own", "mass") >= F.greatest(F.lit(0.18), 0.9 * mass))
        & (support <= 2) & ~(fits["voted"] & fits["kept"])
    )
    before = [
        _fired(astray & fits["kept"] & (vote("kept", "mass") >= 0.15) & (vote("kept", "support") >= 1) & (kept_sure >= threshold),
               "retained_query_consistent_label_fallback", level, vote("kept", "label"), kept_sure),
    ]
    after = [
        _fired(rival & (own_sure >= threshold), "raw_same_modality_coherence_guard", level, vote("own", "label"), own_sure),
        _fired(unsupported & fits["own"] & (vote("own", "mass") >= 0.15) & (vote("own", "support") >= 2) & (own_sure >= threshold),
               "raw_same_modality_query_consistent_label_fallback", level, vote("own", "label"), own_sure),
        _fired(unsupported & fits["raw"] & (vote("raw", "mass") >= 0.15) & ((vote("raw", "support") >= 3) | (vote("raw", "same") >= 2)) & (raw_sure >= threshold),
               "raw_query_consistent_label_fallback", level, vote("raw", "label"), raw_sure),
        _fired(voted_sure >= threshold, "prelabel_coherent_label_support", level, label, voted_sure),
    ]
    silent = astray & broader
    decided = F.coalesce(*before, F.when(~silent, F.coalesce(*after)))
    return F.when(s.has("voted", level), decided), differs


def _genetic(s: _Seen) -> list[Column]:
    """In mechanism mode a genetic query falls back to the first label of its own that anyone of its modality backs."""
    out = []
    for level in LEVELS:
        for pool in ("voted", "kept"):
            sure = s.sure(pool, level, F.greatest(s.vote(pool, level, "support"), s.vote(pool, level, "same")), 2)
            when = (F.col("_mode") == "mechanism") & F.col("_genetic") & s.fits(pool, level) & (s.vote(pool, level, "same") > 0) & (s.vote(pool, level, "support") > 0)
            out.append(_fired(when & (sure >= GENETIC_THRESHOLD), "genetic_query_consistent_label_fallback", level, s.vote(pool, level, "label"), sure))
    return out


def expansion_decision(
    queries: DataFrame, raw: DataFrame, voted: DataFrame, kept: DataFrame, ref_labels: DataFrame, query_labels: DataFrame,
    exact: DataFrame | None = None, mode: str = "hybrid",
) -> DataFrame:
    """One row per query: allow, reason, level, label, confidence, what may be expanded, and which pools disagree.

    ``queries`` has query_id and query_modality; ``raw``, ``voted`` and ``kept``
    are its neighbours before, for and after the vote; ``exact`` names queries
    whose own genes the kept neighbours support. The rules are tried in one
    fixed order, levels from narrow to broad; the first that holds decides and
    is named in ``reason``. A null modality is neither compound nor genetic.
    """
    same = raw.filter(F.col("modality") == F.col("query_modality"))
    pools = None
    for name, pool in zip(POOLS, (raw, same, voted, kept)):
        part = pool.select(F.lit(name).alias("pool"), "query_id", "ref_id", "evidence", "modality", "query_modality")
        pools = part if pools is None else pools.unionByName(part)
    votes = pool_votes(pools, ref_labels).withColumn("_key", F.concat("pool", F.lit(" "), "level"))
    entry = F.struct("_key", F.struct("label", "mass", "support", "same"))
    # At most one vote per pool and level, and few labels that a query names.
    votes = votes.groupBy("query_id").agg(F.map_from_entries(F.collect_list(entry)).alias("_votes"))
    named = query_labels.groupBy("query_id", "level").agg(F.collect_set("label").alias("_l")).groupBy("query_id").agg(F.map_from_entries(F.collect_list(F.struct("level", "_l"))).alias("_named"))
    q = queries.select("query_id", "query_modality").join(votes, "query_id", "left").join(named, "query_id", "left")
    if exact is not None:
        q = q.join(exact.select("query_id").distinct().withColumn("_exact", F.lit(True)), "query_id", "left")
    kind = F.coalesce(F.col("query_modality").cast("string"), F.lit(""))
    q = q.withColumns({
        "_compound": kind == "compound", "_genetic": kind.isin("orf", "crispr"), "_mode": F.lit(mode),
        "_exact": F.coalesce("_exact", F.lit(False)) if exact is not None else F.lit(False),
    })
    # Written, so that the rules read plain columns.
    s = _Seen()
    q = materialize(q.withColumns(_Seen.columns()).drop("_votes", "_named"))
    levels = {level: _at_level(s, level) for level in LEVELS}
    expandable = F.lit(mode in ("mechanism", "hybrid"))
    first = F.coalesce(*_override(s))
    by_level = [decided for decided, _ in levels.values()]
    q = q.withColumn("_first", F.when(expandable, first))
    q = q.withColumn("_level", F.when(expandable & F.col("_first").isNull(), F.coalesce(*by_level)))
    q = q.withColumn("_last", F.when(expandable & F.col("_first").isNull() & F.col("_level").isNull(), F.coalesce(*_genetic(s))))

    reached = F.element_at(F.create_map(*[x for i, name in enumerate(LEVELS) for x in (F.lit(name), F.lit(i))]), F.col("_level.level"))

    def mismatch(other: str) -> Column:
        """Up to the level that decided: labels of both pools that differ; if none did, also where the raw pool has none."""
        seen, ever = F.lit(False), F.lit(False)
        for i, level in enumerate(LEVELS):
            differs = s.has("raw", level) & s.has(other, level) & (s.vote("raw", level, "label") != s.vote(other, level, "label"))
            seen = seen | (s.has("voted", level) & (reached >= i) & differs)
            ever = ever | (s.has(other, level) & (~s.has("raw", level) | differs))
        out = F.when(F.col("_first").isNotNull() | ~expandable, False).when(F.col("_level").isNotNull(), seen).otherwise(ever)
        return F.coalesce(out, F.lit(False))

    out = F.coalesce("_first", "_level", "_last")
    level = out.getField("level")
    none = F.when(expandable, "prelabel_label_support_too_weak").otherwise("mode_not_expandable")
    return q.select(
        "query_id", out.isNotNull().alias("allow"), F.coalesce(out.getField("reason"), none).alias("reason"), level.alias("level"), out.getField("label").alias("label"),
        F.coalesce(out.getField("confidence"), F.lit(0.0)).alias("confidence"),
        F.coalesce(level == "target_family", F.lit(False)).alias("allow_family"), F.coalesce(level != "target_family", F.lit(False)).alias("allow_mechanism"),
        mismatch("kept").alias("raw_kept_mismatch"), mismatch("voted").alias("raw_voted_mismatch"), F.col("_genetic").alias("needs_same_modality"),
    )


def _narrower(level: Column) -> Column:
    """Levels below a chosen one."""
    names = list(LEVELS)
    out = F.array().cast("array<string>")
    for i, name in enumerate(names):
        out = F.when(level == name, F.array(*map(F.lit, names[:i])).cast("array<string>")).otherwise(out)
    return out


def neighbour_genes(neighbours: DataFrame, ref_genes: DataFrame, out: str) -> DataFrame:
    """(query_id, gene_id, ``out``): evidence times weight over the genes of a query's neighbours, summed where the query is."""
    packed = ref_genes.groupBy("ref_id").agg(F.collect_list(F.struct("gene_id", "weight")).alias("_g"))
    rows = neighbours.select("query_id", "ref_id", "evidence").join(packed, "ref_id").repartition("query_id")
    return rows.select("query_id", "evidence", F.inline("_g")).groupBy("query_id", "gene_id").agg(F.sum(F.col("evidence") * F.col("weight")).alias(out))


def expand_by_label(
    scores: DataFrame, decisions: DataFrame, neighbours: DataFrame, ref_genes: DataFrame, gene_labels: DataFrame, own_genes: DataFrame,
    bundle_genes: DataFrame | None = None, inject: float = 0.35, damp: float = 1.1, least_damped: float = 0.2,
) -> DataFrame:
    """Scores after expansion: query_id, gene_id, score, expanded (whether the label brought mass), scope.

    Genes of the decided label are candidates: at the family level those of the
    bundle, else those of the query's neighbours, else all (``scope`` says
    which); at narrower levels all. Genes that the query names stay in. Labels
    below the decided one, preferably those that the query names, narrow and
    weigh the candidates. A share of the scores' total is dealt to candidates
    by weight; other genes are damped. Queries without a decision or without
    candidates keep their scores.
    """
    chosen = decisions.filter("level is not null").select("query_id", "level", "label", "confidence")
    labelled = chosen.join(gene_labels, ["level", "label"]).select("query_id", "gene_id", "level")
    bundle = (ref_genes if bundle_genes is None else bundle_genes).select("gene_id").distinct().withColumn("_b", F.lit(True))
    local = neighbour_genes(neighbours, ref_genes, "_local")
    named = own_genes.select("query_id", "gene_id").distinct().withColumn("_own", F.lit(True))
    c = labelled.join(bundle, "gene_id", "left").join(local, ["query_id", "gene_id"], "left").join(named, ["query_id", "gene_id"], "left")
    c = c.withColumns({"_b": F.coalesce("_b", F.lit(False)), "_near": F.col("_local").isNotNull(), "_local": F.coalesce("_local", F.lit(0.0)), "_own": F.coalesce("_own", F.lit(False))})
    # Read more than once, here and below.
    c = materialize(c)
    c = attach(c, c.groupBy("query_id").agg(F.max("_b").alias("_any_b"), F.max("_near").alias("_any_near")), ["query_id"])
    scope = F.when(F.col("_any_b"), "bundle").when(F.col("_any_near"), "local").otherwise("global")
    within = F.when(F.col("_any_b"), F.col("_b")).when(F.col("_any_near"), F.col("_near")).otherwise(True)
    c = c.withColumn("scope", scope).filter((F.col("level") != "target_family") | within | F.col("_own"))
    c = c.select("query_id", "gene_id", "level", "scope", "_local", "_own")

    # What the candidates' narrower labels say.
    below = c.withColumn("_sub", F.explode(_narrower(F.col("level")))).join(
        gene_labels.select("gene_id", F.col("level").alias("_sub"), F.col("label").alias("_text")), ["gene_id", "_sub"])
    below = materialize(below)
    votes = below.groupBy("query_id", "_sub", "_text").agg(F.sum("_local").alias("_m"), F.count("*").alias("_n"))
    asked = own_labels(own_genes, gene_labels).select("query_id", F.col("level").alias("_sub"), F.col("label").alias("_text"), F.lit(True).alias("_asked"))
    votes = votes.join(asked, ["query_id", "_sub", "_text"], "left").withColumn("_asked", F.coalesce("_asked", F.lit(False)) & (F.col("_m") > 0))
    votes = materialize(votes)
    lead = votes.groupBy("query_id", "_sub").agg(
        F.max("_asked").alias("_by_query"), F.max(F.when(F.col("_asked"), F.col("_m"))).alias("_asked_m"), F.sum("_m").alias("_t"), F.max(F.struct("_m", "_n", "_text")).alias("_top"))
    v = attach(votes, lead, ["query_id", "_sub"])
    clear = ~F.col("_by_query") & (F.col("_text") == F.col("_top._text")) & (F.col("_t") > 0) & (F.col("_m") / F.col("_t") >= 0.6) & (F.col("_n") >= 2)
    liked = v.filter(F.col("_asked") | clear).select("query_id", "_sub", "_text", "_by_query", F.when(F.col("_by_query"), F.col("_asked_m")).otherwise(F.col("_m")).alias("_s"))
    liked = materialize(liked)
    per_gene = below.join(liked, ["query_id", "_sub", "_text"]).groupBy("query_id", "gene_id").agg(F.sum("_s").alias("_bonus"), F.max("_s").alias("_most"), F.max("_by_query").alias("_fits"))
    narrowed = liked.filter("_by_query").select("query_id").distinct().withColumn("_narrow", F.lit(True))
    c = c.join(per_gene, ["query_id", "gene_id"], "left").join(narrowed, "query_id", "left")
    c = c.withColumns({"_bonus": F.coalesce("_bonus", F.lit(0.0)), "_most": F.coalesce("_most", F.lit(0.0)), "_fits": F.coalesce("_fits", F.lit(False)), "_narrow": F.coalesce("_narrow", F.lit(False))})
    # A label that the query names and candidates carry always leaves some, so narrowing never empties.
    c = c.filter(~F.col("_narrow") | F.col("_fits") | F.col("_own"))

    refs = ref_genes.groupBy("gene_id").agg(F.countDistinct("ref_id").alias("_refs"))
    c = c.join(refs, "gene_id", "left")
    w = F.col("_local") + 0.25 * F.coalesce("_refs", F.lit(0)) + 0.25 * F.col("_bonus")
    w = w * F.when(F.col("_narrow") & ~F.col("_fits"), 0.25).otherwise(1.0)
    w = F.when(F.col("_own"), F.greatest(w, 0.75 + 2.5 * F.col("_most"))).otherwise(w)
    c = materialize(c.select("query_id", "gene_id", "scope", w.alias("_w")))

    total = scores.groupBy("query_id").agg(F.sum("score").alias("_total"))
    weight = c.groupBy("query_id").agg(F.sum("_w").alias("_all"), F.first("scope").alias("_scope"))
    facts = chosen.join(weight, "query_id").join(total, "query_id", "left").select("query_id", "confidence", "_all", "_scope", "_total")
    j = scores.select("query_id", "gene_id", "score").join(c.select("query_id", "gene_id", "_w"), ["query_id", "gene_id"], "full_outer")
    j = j.join(facts, "query_id", "left")
    touched = F.col("confidence").isNotNull()
    base = F.greatest(F.coalesce("score", F.lit(0.0)), F.lit(0.0)) * F.when(F.col("_w").isNull(), F.greatest(F.lit(least_damped), 1.0 - damp * F.col("confidence"))).otherwise(1.0)
    mass = F.greatest(F.lit(1e-6), inject * F.coalesce("_total", F.lit(0.0)) * F.col("confidence"))
    given = (F.coalesce("_w", F.lit(0.0)) > 0) & (F.col("_all") > 0)
    after = base + F.when(given, mass * F.col("_w") / F.col("_all")).otherwise(0.0)
    out = j.select("query_id", "gene_id", F.when(touched, after).otherwise(F.col("score")).alias("score"), (touched & given).alias("expanded"), F.when(touched, F.col("_scope")).otherwise("none").alias("scope"))
    return out.filter((F.col("scope") == "none") | (F.col("score") > 0))


def preferred_variant(core: DataFrame, expanded: DataFrame, decisions: DataFrame, mode: str = "hybrid", confident: float = 0.22, dominant: float = 0.5) -> DataFrame:
    """Per query the variant to report, and why: ``core`` or ``expanded``.

    ``core`` and ``expanded`` are the selected genes of either side with score.
    A confident expansion that adds genes wins, else a dominant target, else
    whatever has genes.
    """
    if mode in ("direct_target", "mechanism"):
        variant, why = {"direct_target": ("core", "exact_target_mode"), "mechanism": ("expanded", "mechanism_mode")}[mode]
        return decisions.select("query_id", F.lit(variant).alias("variant"), F.lit(why).alias("why"))
    size = lambda d, c: d.groupBy("query_id").agg(F.count("*").alias(c))
    share = core.groupBy("query_id").agg((F.max("score") / F.sum("score")).alias("_top"))
    j = decisions.select("query_id", "confidence").join(size(core, "_c"), "query_id", "left").join(size(expanded, "_e"), "query_id", "left").join(share, "query_id", "left")
    c, e = F.coalesce("_c", F.lit(0)), F.coalesce("_e", F.lit(0))
    rules: list[tuple[Column, str, str]] = [
        ((F.col("confidence") >= confident) & (e > c), "expanded", "expansion_confidence"),
        ((F.coalesce("_top", F.lit(0.0)) >= dominant) & (c > 0), "core", "exact_target_confidence"),
        (e > 0, "expanded", "fallback_expanded"),
        (F.lit(True), "core", "fallback_core"),
    ]
    pick: Callable[[int], Column] = lambda k: F.coalesce(*[F.when(r[0], F.lit(r[k])) for r in rules])
    return j.select("query_id", pick(1).alias("variant"), pick(2).alias("why"))
