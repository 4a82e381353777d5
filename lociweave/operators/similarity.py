"""Profile similarity: block products, neighbours, hub scores, control calibration, evidence and votes."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.joins import attach, attach_count, attach_total
from lociweave.operators.selection import top_k
from lociweave.session import write_table

#: References that a task holds at a time, and queries that meet all of them in one task, STEP_ROWS at a time.
BLOCK_ROWS = 16384
QUERY_ROWS = 4096
STEP_ROWS = 128
#: With fewer blocks of queries than this, the files of the references are dealt over so many tasks.
LEAST_TASKS = 16
#: References that a step multiplies at a time where only the leading ones are asked for: the products stay in cache.
TILE_ROWS = 2048
#: Columns whose largest value stands for them where a bound is enough.
GROUP = 32


def to_vectors(long: DataFrame, features: Sequence[str], entity: str = "id") -> DataFrame:
    """Long (id, feature, value) to one array per id over a fixed feature order; missing is 0."""
    one = [F.coalesce(F.max(F.when(F.col("feature") == f, F.col("value"))), F.lit(0.0)) for f in features]
    return long.groupBy(entity).agg(F.array(*one).alias("vec"))


def shared_features(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("feature").distinct().join(b.select("feature").distinct(), "feature", "left_semi")


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: inside a lambda an outer expression is computed again for every element."""
    return F.transform(F.array(value), body).getItem(0)


def unit(vec: str, pearson: bool = False) -> Column:
    """Array scaled to length 1 (after centring for Pearson); a zero vector stays zero."""
    v = F.col(vec)
    zero = F.lit(0.0)
    if pearson:
        mean = F.aggregate(v, zero, lambda s, x: s + x) / F.size(v)
        v = _with(mean, lambda m: F.transform(F.col(vec), lambda x: x - m))

    def scaled(u: Column) -> Column:
        norm = F.sqrt(F.aggregate(u, zero, lambda s, x: s + x * x))
        return _with(norm, lambda n: F.when(n > 0, F.transform(u, lambda x: x / n)).otherwise(F.transform(u, lambda x: x * 0.0)))

    return _with(v, scaled)


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest value of each row, as a column."""
    return -np.partition(-values, k - 1, axis=1)[:, k - 1 : k] if values.shape[1] > k else np.full((len(values), 1), -np.inf)


def _floor(values: np.ndarray, k: int) -> np.ndarray:
    """A bound that at least k values of each row reach, as a column: the k-th largest maximum of groups of columns.

    It is at most the k-th largest value, and costs one pass over the values where that costs a partition of them.
    """
    n = values.shape[1] // GROUP
    if n < 4 * k:
        return _kth(values, k)
    return _kth(values[:, : n * GROUP].reshape(len(values), GROUP, n).max(axis=1), k)


def _no_rows(names: Sequence[str]) -> pd.DataFrame:
    """Columns without a type of their own: empty numbers don't convert to strings."""
    return pd.DataFrame({c: [] for c in names}, dtype=object)


def _block_product(schema: str, keep, exclude_self: bool):
    """Cogrouped function over one query block and one reference block; ``keep(sim, valid, queries, references)`` gives a mask."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return _no_rows(names)
        right, rid = np.stack(r["ref_vec"].to_numpy()).T, r["ref_id"].to_numpy()
        out = []
        for at in range(0, len(q), STEP_ROWS):
            part = q.iloc[at : at + STEP_ROWS]
            qid = part["query_id"].to_numpy()
            sim = np.stack(part["query_vec"].to_numpy()) @ right
            valid = qid[:, None] != rid[None, :] if exclude_self else np.ones(sim.shape, dtype=bool)
            i, j = np.nonzero(keep(sim, valid, part, r) & valid)
            rows = {"query_id": qid[i], "ref_id": rid[j], "similarity": sim[i, j]}
            if "n_all" in names:
                # One further row per query counts what the block holds, kept or not.
                n = len(qid)
                rows = {"query_id": np.concatenate((rows["query_id"], qid)), "ref_id": np.append(rows["ref_id"].astype(object), [None] * n),
                        "similarity": np.concatenate((rows["similarity"], np.zeros(n)))}
                for name, hit in (("n_positive", sim > 0), ("n_negative", sim < 0), ("n_all", sim == sim)):
                    rows[name] = np.concatenate((np.zeros(len(i), np.int64), (hit & valid).sum(1)))
            out.append(pd.DataFrame(rows))
        return pd.concat(out)

    return run


class _Leaders:
    """The k best of each query so far, and every pair that may still be among them.

    With ``first_ids`` only the k of largest score, of equal ones those of smallest id, may be.
    """

    def __init__(self, rows: int, k: int, least: float, first_ids: bool):
        self.best, self.least, self.first_ids, self.found = np.full((rows, k), -np.inf), least, first_ids, []

    def bound(self) -> np.ndarray:
        return self.best.min(axis=1) * self.least

    def add(self, i: np.ndarray, ref: np.ndarray, similarity: np.ndarray, score: np.ndarray) -> None:
        self.found.append((i, ref, similarity, score))
        order = np.lexsort((-score, i))
        rows, first, sizes = np.unique(i[order], return_index=True, return_counts=True)
        place, k = np.arange(len(order)) - np.repeat(first, sizes), self.best.shape[1]
        own, top = np.repeat(np.arange(len(rows)), sizes), place < k
        new = np.full((len(rows), k), -np.inf)
        new[own[top], place[top]] = score[order][top]
        self.best[rows] = -np.partition(-np.hstack((self.best[rows], new)), k - 1, axis=1)[:, :k]

    def cut(self) -> None:
        """Forget the pairs that can't lead any more."""
        if not self.found:
            return
        i, ref, similarity, score = map(np.concatenate, zip(*self.found))
        bound = self.bound()[i]
        stays = score >= bound - np.where(np.isfinite(bound), 1e-12 * np.maximum(1.0, np.abs(bound)), 0.0)
        i, ref, similarity, score = i[stays], ref[stays], similarity[stays], score[stays]
        if self.first_ids:
            order = np.lexsort((np.unique(ref, return_inverse=True)[1], -score, i))
            _, first, sizes = np.unique(i[order], return_index=True, return_counts=True)
            order = order[np.arange(len(order)) - np.repeat(first, sizes) < self.best.shape[1]]
            i, ref, similarity, score = i[order], ref[order], similarity[order], score[order]
        self.found = [(i, ref, similarity, score)]


def _gathered(parts, rows: int) -> Iterator[pd.DataFrame]:
    """Batches (pandas or Arrow) joined to frames of ``rows`` or a little more."""
    held, n = [], 0
    joined = lambda: pd.concat([b.to_pandas() if isinstance(b, pa.RecordBatch) else b for b in held], ignore_index=True)
    for part in parts:
        held.append(part)
        n += len(part)
        if n >= rows:
            yield joined()
            held, n = [], 0
    if n:
        yield joined()


def _stored(folder: str, share: int = 0, shares: int = 1) -> Iterator[pd.DataFrame]:
    """A written table block by block, in the order of its files; of several shares one, dealt by file."""
    store, root = fs.FileSystem.from_uri(folder)
    files = sorted(f.path for f in store.get_file_info(fs.FileSelector(root)) if f.base_name.startswith("part-"))

    def batches() -> Iterator[pa.RecordBatch]:
        for file in files[share::shares]:
            with store.open_input_file(file) as source:
                yield from pq.ParquetFile(source).iter_batches(BLOCK_ROWS, use_threads=False)

    return _gathered(batches(), BLOCK_ROWS)


def _leading_product(
    schema: str, k: int, exclude_self: bool, low: float = -math.inf, positive: bool = False, sign: float = 1.0, power: float = 1.0, least_factor: float = 1.0,
    first_ids: bool = False,
):
    """Cogrouped function over a query block and its references: pairs that may be among a query's k best by strength^power x factor.

    The references are one block, or rows that name the folder where they are
    written; then they are read block by block, and the best so far are carried
    on. The strength is ``sign`` x similarity, at least ``low`` and, if asked,
    positive. References are multiplied by the root of their factor, so products
    order pairs like their evidence, and taken by falling factor: where not even
    a similarity of 1 reaches the k-th best so far, they are left out.
    Products of single precision, widened by their largest error, only say
    which pairs are computed in full; neither step loses one. With ``first_ids``
    pairs that tie for the last place are cut by reference id.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    root = 1.0 / power

    def advance(lead: _Leaders, qid: np.ndarray, left: np.ndarray, rid: np.ndarray, right: np.ndarray, single: np.ndarray, scale: np.ndarray) -> None:
        """Meet the references of one block, by falling scale."""
        # Both sides of a product of unit vectors, each of its sums and the bound are rounded once.
        error = 2.0 ** -24 * (right.shape[1] + 8)
        limited = low > -math.inf and scale[-1] >= 0
        rough = left.astype(np.float32)
        for lo in range(0, len(rid), TILE_ROWS):
            hi = min(lo + TILE_ROWS, len(rid))
            reach, bound = max(abs(scale[lo]), abs(scale[hi - 1])), lead.bound()
            slack = error * reach
            live = np.flatnonzero(~(bound > (1.0 + 1e-6) * reach))
            if not len(live):
                continue
            product = (rough if len(live) == len(rough) else rough[live]) @ single[lo:hi].T
            bound = bound[live]
            new = np.flatnonzero(bound == -np.inf)
            if len(new):
                # A first bound: k pairs of this tile are certain to reach it.
                of = product if len(new) == len(live) else product[new]
                sure = np.ones(of.shape, bool) if low == -math.inf else (of >= low * scale[lo:hi] + slack) & (of > 0 if positive else True) & (scale[lo:hi] >= 0)
                if exclude_self:
                    sure &= qid[live[new], None] != rid[None, lo:hi]
                bound[new] = (_kth(np.where(sure, of, -np.inf), k)[:, 0].astype(float) - slack) * lead.least
            if limited:
                bound = np.maximum(bound, low * scale[hi - 1 if low >= 0 else lo])
            hit = np.flatnonzero(product >= (bound - slack).astype(np.float32)[:, None])
            i, j = live[hit // (hi - lo)], lo + hit % (hi - lo)
            may = qid[i] != rid[j] if exclude_self else np.ones(len(hit), bool)
            if limited:
                may &= product.ravel()[hit] >= low * scale[j] - slack
            i, j = i[may], j[may]
            strength = np.einsum("ij,ij->i", left[i], right[j])
            ok = (strength >= low) & (strength > 0 if positive else True)
            i, j, strength = i[ok], j[ok], strength[ok]
            if len(i):
                lead.add(i, rid[j], sign * strength, strength * scale[j])

    def run(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if q.empty or r.empty:
            return _no_rows(names)
        ids, vectors = q["query_id"].to_numpy(), np.stack(q["query_vec"].to_numpy())
        steps = [(ids[at : at + STEP_ROWS], vectors[at : at + STEP_ROWS]) for at in range(0, len(ids), STEP_ROWS)]
        leads = [_Leaders(len(qid), k, least_factor ** root, first_ids) for qid, _ in steps]
        for block in [r] if "ref_vec" in r else _stored(*r[["folder", "_share", "shares"]].iloc[0]):
            factor = block["factor"].to_numpy(float) if "factor" in block else np.ones(len(block))
            block, factor = block[~np.isnan(factor)], factor[~np.isnan(factor)]
            if block.empty:
                continue
            scale = np.clip(np.sign(factor) * np.abs(factor) ** root, -1e30, 1e30)
            order = np.argsort(-scale, kind="stable")
            scale, rid = scale[order], block["ref_id"].to_numpy()[order]
            right = sign * np.stack(block["ref_vec"].to_numpy())[order]
            single = (right * scale[:, None]).astype(np.float32)
            for lead, (qid, left) in zip(leads, steps):
                advance(lead, qid, left, rid, right, single, scale)
                lead.cut()
        out = [pd.DataFrame({"query_id": qid[i], "ref_id": ref, "similarity": similarity}) for lead, (qid, _) in zip(leads, steps) for i, ref, similarity, _ in lead.found if len(i)]
        return pd.concat(out) if out else _no_rows(names)

    return run


def _block(column: str, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def _blocks(queries: DataFrame, references: DataFrame, pearson: bool, product, extra: Sequence[str] = (), counts: bool = False, leading: bool = False) -> DataFrame:
    """Products of all queries and references (``id, vec`` and the extra columns); pairs never exist as rows.

    ``product`` gives the function for a schema. The references are written once
    and read, block by block, by the task of each query block, so neither side
    is shuffled once for each block of the other. With ``leading`` the function
    carries a query block through all its references; otherwise it gives the
    rows of one block at a time.
    """
    nq = max(1, math.ceil(queries.count() / QUERY_ROWS))
    shares = math.ceil(LEAST_TASKS / nq)
    q = queries.select(F.col("id").alias("query_id"), unit("vec", pearson).alias("query_vec")).withColumn("_qb", _block("query_id", nq))
    r = references.select(F.col("id").alias("ref_id"), unit("vec", pearson).alias("ref_vec"), *extra)
    folder = write_table(r.orderBy(F.col("factor").desc()) if leading and "factor" in extra else r)
    schema = f"query_id {queries.schema['id'].dataType.simpleString()}, ref_id {references.schema['id'].dataType.simpleString()}, similarity double"
    if counts:
        schema += ", n_positive bigint, n_negative bigint, n_all bigint"
    run, by = product(schema), ["_qb", "_share"]
    q = q.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    if leading:
        where = q.sparkSession.range(nq * shares).select(
            F.floor(F.col("id") / shares).cast("int").alias("_qb"), (F.col("id") % shares).cast("int").alias("_share"), F.lit(folder).alias("folder"), F.lit(shares).alias("shares"))
        return q.groupBy(*by).cogroup(where.groupBy(*by)).applyInPandas(run, schema)

    def each(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for gathered in _gathered(parts, BLOCK_ROWS):
            for share, of in gathered.groupby("_share"):
                for block in _stored(folder, share, shares):
                    found = run(of, block)
                    if len(found):
                        yield found

    return q.repartition(nq * shares, *by).mapInPandas(each, schema)


def similar(
    queries: DataFrame, references: DataFrame, k: int | None = None, min_similarity: float | None = None, pearson: bool = False,
    exclude_self: bool = False,
) -> DataFrame:
    """Exact cosine or Pearson of all query x reference pairs, reduced to top k and/or a minimum."""
    if k is None and min_similarity is None:
        raise ValueError("give k or min_similarity")

    if k is None:
        return _blocks(queries, references, pearson, lambda schema: _block_product(schema, lambda sim, valid, q, r: valid & (sim >= min_similarity), exclude_self))
    low = -math.inf if min_similarity is None else min_similarity
    pairs = _blocks(queries, references, pearson, lambda schema: _leading_product(schema, k, exclude_self, low, first_ids=True), leading=True)
    return top_k(pairs, ["query_id"], k, [F.col("similarity").desc(), F.col("ref_id").asc()])


def candidates_by_evidence(
    queries: DataFrame, references: DataFrame, k: int, power: float = 1.0, least_factor: float = 1.0, min_similarity: float = 0.0, polarity: str = "similar",
    pearson: bool = False, exclude_self: bool = False, leading: int = 0, near_best: float | None = None, counts: bool = False,
) -> DataFrame:
    """Pairs that can be among the ``k`` of a query with the most evidence, strength^power x the reference's ``factor``.

    ``references`` has id, vec and factor. Later steps may damp a pair's
    evidence down to ``least_factor`` of it: a pair stays if its evidence
    reaches the k-th largest of the damped ones, so the later cut is exact.
    Also kept are the ``leading`` most similar of each modality and those within
    ``near_best`` of the best similarity, if asked. With ``counts`` a row without
    ref_id per query and block counts positive, negative and all pairs.
    """
    has_modality = "modality" in references.columns

    def keep(sim, valid, q, r):
        strength = sim if polarity == "similar" else -sim
        ok = valid & (strength > 0) & (strength >= min_similarity)
        # The operator squares and copies without calling pow for every pair.
        e = np.where(ok, np.maximum(strength, 0) ** power * r["factor"].to_numpy(float)[None, :], -np.inf)
        # A factor below one in the damped evidence: compare the undamped with the damped k-th. Infinity stays.
        floor = _floor(e, k) * least_factor
        mask = ok & (e >= floor - 1e-12 * np.abs(floor))
        s = np.where(ok, strength, -np.inf)
        if leading:
            kinds = r["modality"].astype(object).to_numpy() if has_modality else np.zeros(len(r))
            for kind in set(kinds):
                of = np.where((kinds == kind)[None, :], s, -np.inf)
                mask |= ok & (of > -np.inf) & (of >= _kth(of, leading) - 1e-12)
        if near_best is not None:
            mask |= ok & (s >= near_best * s.max(axis=1, keepdims=True) - 1e-12)
        return mask

    if not (leading or counts) and near_best is None:
        low, sign = max(min_similarity, 0.0), 1.0 if polarity == "similar" else -1.0
        return _blocks(queries, references, pearson, lambda schema: _leading_product(schema, k, exclude_self, low, True, sign, power, least_factor), ["factor"], leading=True)
    extra = ["factor", "modality"] if has_modality else ["factor"]
    return _blocks(queries, references, pearson, lambda schema: _block_product(schema, keep, exclude_self), extra, counts=counts)


def hub_scores(profiles: DataFrame, k: int = 10) -> DataFrame:
    """Mean of the k largest positive cosines to other profiles; 0 without any."""
    near = similar(profiles, profiles, k=k, exclude_self=True).filter("similarity > 0")
    hub = near.groupBy(F.col("query_id").alias("id")).agg(F.avg("similarity").alias("hub_score"))
    return profiles.select("id").join(hub, "id", "left").select("id", F.coalesce("hub_score", F.lit(0.0)).alias("hub_score"))


def consensus(profiles: DataFrame, keys: Sequence[str], how: str = "median") -> DataFrame:
    """Median (exact, any group size) or mean of replicate profiles per (keys, feature)."""
    from lociweave.operators.sliced import median

    by = [*keys, "feature"]
    return median(profiles, by, "value", "value") if how == "median" else profiles.groupBy(*by).agg(F.avg("value").alias("value"))


def mean_centre(long: DataFrame, controls: DataFrame) -> DataFrame:
    """Subtract the control mean of each feature; features without controls stay."""
    m = controls.groupBy("feature").agg(F.avg("value").alias("_m"))
    return long.join(m, "feature", "left").withColumn("value", F.col("value") - F.coalesce("_m", F.lit(0.0))).drop("_m")


def remove_nuisance_axes(vectors: DataFrame, controls: DataFrame, n_axes: int = 2, min_controls: int = 5) -> DataFrame:
    """Centre on the controls and project out their leading principal axes.

    Axes come from Spark's distributed PCA (a feature x feature matrix). With
    fewer than ``min_controls`` controls only the centring is applied; without
    any the vectors stay as they are.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    width = controls.agg(F.max(F.size("vec"))).first()[0]
    if width is None:
        return vectors
    # One row of feature means; it stays in Spark.
    means = controls.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("m"))
    # A subquery must be a column before a lambda can read it.
    centre = lambda df: df.withColumn("_m", means.scalar()).withColumn("vec", F.zip_with("vec", "_m", lambda x, m: x - m)).drop("_m")
    centred = centre(vectors)
    if controls.count() < min_controls:
        return centred
    c = centre(controls).select(array_to_vector("vec").alias("v"))
    axes = PCA(k=n_axes, inputCol="v", outputCol="p").fit(c).pc.toArray().T
    out = centred
    for axis in axes:
        a = F.array(*[F.lit(float(x)) for x in axis])
        dot = F.aggregate(F.zip_with("vec", a, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        out = out.withColumn("_d", dot)
        out = out.withColumn("vec", F.zip_with("vec", a, lambda x, y: x - F.col("_d") * y)).drop("_d")
    return out


def polarity_candidates(pairs: DataFrame, polarity: str = "similar", min_similarity: float = 0.0) -> DataFrame:
    """Strictly positive evidence in the asked direction, at least the minimum."""
    s = F.col("similarity") if polarity == "similar" else -F.col("similarity")
    return pairs.withColumn("strength", s).filter((F.col("strength") > 0) & (F.col("strength") >= min_similarity))


def reference_factors(refs: DataFrame, hub_mode: str = "none") -> DataFrame:
    """(ref_id, qc, hub_factor): hub none, inverse_linear 1/max(1e-6, hub) or inverse_rank n/rank.

    Ranks run from the least to the most connected reference; one without a hub score keeps factor 1.
    """
    r = refs.select(F.col("id").alias("ref_id"), F.coalesce("qc_weight", F.lit(1.0)).alias("qc"), "hub_score")
    if hub_mode == "inverse_rank":
        from lociweave.operators.sliced import ranked

        known = ranked(r.filter("hub_score is not null").select("ref_id", "hub_score"), [], [F.col("hub_score").asc(), F.col("ref_id").asc()], "_rk", count="_n")
        r = r.join(known.select("ref_id", (F.col("_n") / F.col("_rk")).alias("_f")), "ref_id", "left")
        hub = F.coalesce("_f", F.lit(1.0))
    elif hub_mode == "inverse_linear":
        hub = F.coalesce(1.0 / F.greatest(F.lit(1e-6), F.col("hub_score")), F.lit(1.0))
    elif hub_mode == "none":
        hub = F.lit(1.0)
    else:
        raise ValueError(f"unknown hub mode {hub_mode!r}")
    return r.select("ref_id", "qc", hub.alias("hub_factor"))


def neighbour_evidence(candidates: DataFrame, refs: DataFrame, power: float = 1.0, hub_mode: str = "none", factors: DataFrame | None = None) -> DataFrame:
    """strength^power x qc x hub factor; ``factors`` are those of ``reference_factors`` where they are known already."""
    j = candidates.join(reference_factors(refs, hub_mode) if factors is None else factors, "ref_id")
    return j.withColumn("evidence", F.pow("strength", F.lit(power)) * F.col("qc") * F.col("hub_factor"))


def neighbour_cut(evidence: DataFrame, k: int = 20, keep_first: int = 5, drop_ratio: float = 0.25) -> DataFrame:
    """Top k per query; beyond the first few only while evidence stays >= ratio x the top's."""
    r = top_k(evidence, ["query_id"], k, [F.col("evidence").desc(), F.col("ref_id").asc()], "neighbour_rank")
    # At most k rows of a query are left and stand together: a summary joined back would compute all pairs again.
    top = F.max("evidence").over(Window.partitionBy("query_id"))
    return r.withColumn("_top", top).filter(
        (F.col("neighbour_rank") <= keep_first) | (F.col("evidence") >= drop_ratio * F.col("_top"))
    ).drop("_top")


def keep_protected(evidence: DataFrame, limit: int, protected: str = "protected") -> DataFrame:
    """First ``limit`` rows per query with protected references swapped in for the last unprotected ones.

    Protected rows beyond the cut displace the weakest unprotected rows inside it.
    """
    order = [F.col(protected).desc(), F.col("evidence").desc(), F.col("ref_id").asc()]
    return top_k(evidence, ["query_id"], limit, order, "_r").drop("_r")


def target_support(neighbours: DataFrame, ref_genes: DataFrame) -> DataFrame:
    """Per (query, gene): evidence x weight sum, supporting references, modalities and best similarity.

    Gene weights of a reference that sum above 1 are scaled down to 1.
    """
    g = attach_total(ref_genes, ["ref_id"], "weight", "_t")
    g = g.withColumn("weight", F.when(F.col("_t") > 1, F.col("weight") / F.col("_t")).otherwise(F.col("weight"))).drop("_t")
    j = neighbours.join(g, "ref_id")
    extra = [F.countDistinct("modality").alias("n_modalities")] if "modality" in neighbours.columns else []
    return j.groupBy("query_id", "gene_id").agg(
        F.sum(F.col("evidence") * F.col("weight")).alias("score"), F.countDistinct("ref_id").alias("n_refs"),
        F.max("similarity").alias("best_similarity"), *extra,
    )


def nominate_core(support: DataFrame, top_share: float = 0.8, min_refs: int = 2, near_best: float = 0.95) -> DataFrame:
    """Genes close to the top score, or with several references, or with a near-best similarity."""
    m = support.groupBy("query_id").agg(F.max("score").alias("_s"), F.max("best_similarity").alias("_b"))
    core = (F.col("score") >= top_share * F.col("_s")) | (F.col("n_refs") >= min_refs) | (F.col("best_similarity") >= near_best * F.col("_b"))
    return attach(support, m, ["query_id"]).withColumn("core", core).drop("_s", "_b")


def label_vote(neighbours: DataFrame, ref_labels: DataFrame) -> DataFrame:
    """Evidence mass and share per (query, level, label).

    ``ref_labels`` has (ref_id, level, label, weight); a reference gives a label
    at most its own evidence, however many of its genes carry the label.
    """
    lab = ref_labels.groupBy("ref_id", "level", "label").agg(F.least(F.lit(1.0), F.sum("weight")).alias("_w"))
    same = F.col("modality") == F.col("query_modality") if {"modality", "query_modality"} <= set(neighbours.columns) else F.lit(None).cast("boolean")
    v = neighbours.withColumn("_same", same).join(lab, "ref_id").groupBy("query_id", "level", "label").agg(
        F.sum(F.col("evidence") * F.col("_w")).alias("mass"), F.countDistinct("ref_id").alias("support"),
        F.countDistinct(F.when(F.col("_same"), F.col("ref_id"))).alias("same_modality_support"),
    )
    return attach_total(v, ["query_id", "level"], "mass", "_t").withColumn("share", F.col("mass") / F.col("_t")).drop("_t")


def top_label(votes: DataFrame) -> DataFrame:
    return votes.groupBy("query_id", "level").agg(
        F.min_by(F.struct("label", "mass", "support", "share"), F.struct((-F.col("mass")).alias("m"), F.col("label").alias("l"))).alias("_b")
    ).select("query_id", "level", "_b.*")


# Recovery of cross-modality references by the closest thing they share with the anchors.
RECOVERY = {"target": 1.0, "pathway": 0.8, "class": 0.7, "mechanism": 0.6, "family": 0.5}
COMPOUND_RECOVERY = {"target": 1.0, "pathway": 0.95, "class": 0.9, "mechanism": 0.85, "family": 0.8}
COMPOUND_CROSS_PENALTY = 0.8


def shared_label_recovery(
    neighbours: DataFrame, ref_genes: DataFrame, gene_labels: DataFrame | None = None, anchors: int = 5, anchor_genes: int = 3
) -> DataFrame:
    """Best recovery factor of cross-modality references against same-modality anchors.

    Anchors are the most similar same-modality references of a query with their
    strongest genes; a reference recovers by a shared target, else by a shared
    pathway, class, mechanism or family of a target. ``gene_labels`` has
    (gene_id, level, label). A target counts as its own label of level "target".
    """
    own = ref_genes.select("gene_id").distinct().select("gene_id", F.lit("target").alias("level"), F.col("gene_id").alias("label"))
    labels = own if gene_labels is None else own.unionByName(gene_labels.select("gene_id", "level", "label"))
    cross = F.col("query_modality") != F.col("modality")
    lead = top_k(neighbours.filter(~cross), ["query_id"], anchors, [F.col("similarity").desc(), F.col("ref_id").asc()], "_r")
    strongest = top_k(ref_genes, ["ref_id"], anchor_genes, [F.col("weight").desc(), F.col("gene_id").asc()], "_g")
    have = lead.select("query_id", "ref_id").join(strongest.select("ref_id", "gene_id"), "ref_id").join(labels, "gene_id").select("query_id", "level", "label").distinct()
    per_ref = ref_genes.join(labels, "gene_id").select("ref_id", "level", "label").distinct()
    hit = neighbours.filter(cross).select("query_id", "ref_id", "query_modality").join(per_ref, "ref_id").join(have, ["query_id", "level", "label"], "left_semi")
    factor = F.lit(0.0)
    for level in RECOVERY:
        here = F.when(F.col("query_modality").cast("string") == "compound", COMPOUND_RECOVERY[level]).otherwise(RECOVERY[level])
        factor = F.when(F.col("level") == level, here).otherwise(factor)
    return hit.groupBy("query_id", "ref_id").agg(F.max(factor).alias("factor"))


def modality_penalty(neighbours: DataFrame, penalty: float = 0.35, recovery: DataFrame | None = None) -> DataFrame:
    """Damp cross-modality evidence by the penalty (at least .8 for compound queries) or its recovery, whichever is larger."""
    cross = F.col("query_modality") != F.col("modality")
    base = F.when(F.col("query_modality").cast("string") == "compound", F.lit(max(penalty, COMPOUND_CROSS_PENALTY))).otherwise(F.lit(penalty))
    n = neighbours
    if recovery is not None:
        n = n.join(recovery.select("query_id", "ref_id", F.col("factor").alias("_f")), ["query_id", "ref_id"], "left")
        base = F.greatest(base, F.coalesce("_f", F.lit(0.0)))
    return n.withColumn("evidence", F.when(cross, F.col("evidence") * base).otherwise(F.col("evidence"))).drop("_f")


def mutual_filter(neighbours: DataFrame, vectors: DataFrame, anchors: int = 5, floor: float = 0.1, damp: float = 0.5) -> DataFrame:
    """Halve neighbours whose mean positive cosine to the query's anchors is under the floor; anchors are exempt."""
    order = [F.col("evidence").desc(), F.col("similarity").desc(), F.col("ref_id").asc()]
    a = top_k(neighbours, ["query_id"], anchors, order, "_r")
    v = vectors.select(F.col("id").alias("ref_id"), unit("vec").alias("u"))
    left = neighbours.join(v, "ref_id")
    right = a.select("query_id", F.col("ref_id").alias("anchor_id")).join(
        v.select(F.col("ref_id").alias("anchor_id"), F.col("u").alias("w")), "anchor_id"
    )
    dot = F.aggregate(F.zip_with("u", "w", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    m = left.join(right, "query_id").groupBy("query_id", "ref_id").agg(
        F.avg(F.greatest(dot, F.lit(0.0))).alias("_mutual"), F.max(F.col("ref_id") == F.col("anchor_id")).alias("_anchor")
    )
    out = neighbours.join(m, ["query_id", "ref_id"], "left")
    weak = ~F.coalesce("_anchor", F.lit(True)) & (F.col("_mutual") < floor)
    return out.withColumn("evidence", F.when(weak, F.col("evidence") * damp).otherwise(F.col("evidence"))).withColumnRenamed(
        "_mutual", "mutual_similarity").drop("_anchor")


def protect_same_modality(neighbours: DataFrame, first: int = 5, near_top: float = 0.9, own_genes: DataFrame | None = None, ref_genes: DataFrame | None = None) -> DataFrame:
    """Flag the first same-modality neighbours, those near the best similarity, and references of the query's own gene.

    ``own_genes`` has (query_id, gene_id).
    """
    same = F.col("query_modality") == F.col("modality")
    lead = top_k(neighbours.filter(same), ["query_id"], first, [F.col("similarity").desc(), F.col("ref_id").asc()], "_r").select(
        "query_id", "ref_id", F.lit(True).alias("_lead")
    )
    best = neighbours.groupBy("query_id").agg(F.max("similarity").alias("_best"))
    out = neighbours.join(lead, ["query_id", "ref_id"], "left").join(best, "query_id")
    flag = F.coalesce("_lead", F.lit(False)) | F.coalesce(same & (F.col("similarity") >= near_top * F.col("_best")), F.lit(False))
    if own_genes is not None:
        hit = own_genes.join(ref_genes, "gene_id").select("query_id", "ref_id", F.lit(True).alias("_own")).distinct()
        out = out.join(hit, ["query_id", "ref_id"], "left")
        flag = flag | F.coalesce("_own", F.lit(False))
    return out.withColumn("protected", flag).drop("_lead", "_best", "_own")


def gene_recurrence(ref_genes: DataFrame) -> DataFrame:
    """IDF of a gene over references, scaled to at most 1."""
    from lociweave.functions.idf import gene_recurrence_idf

    n = ref_genes.agg(F.countDistinct("ref_id").alias("_n"))
    c = ref_genes.groupBy("gene_id").agg(F.countDistinct("ref_id").alias("_c"))
    return attach(c, n, []).select("gene_id", gene_recurrence_idf("_c", "_n").alias("idf"))


def mechanism_scores(neighbours: DataFrame, ref_genes: DataFrame, compound_weight: float = 0.5, genetic_weight: float = 0.5, idf: DataFrame | None = None) -> DataFrame:
    """Compound and genetic gene scores, each L1 per query, mixed by modality-dependent weights, times gene IDF.

    A side with fewer than five neighbours next to one with at least five counts a quarter.
    """
    kind = F.when(F.col("modality").cast("string") == "compound", "c").otherwise("g")
    n = neighbours.filter("evidence > 0").withColumn("_k", kind)
    s = n.join(ref_genes, "ref_id").groupBy("query_id", "_k", "gene_id").agg(F.sum(F.col("evidence") * F.col("weight")).alias("_s"))
    s = attach_total(s, ["query_id", "_k"], "_s", "_t").withColumn("_s", F.col("_s") / F.col("_t"))
    have = s.groupBy("query_id").agg(F.max((F.col("_k") == "c").cast("int")).alias("_hc"), F.max((F.col("_k") == "g").cast("int")).alias("_hg"))
    size = n.groupBy("query_id").agg(F.count_if(F.col("_k") == "c").alias("_nc"), F.count_if(F.col("_k") == "g").alias("_ng"), F.max("query_modality").alias("_qm"))
    q = F.col("_qm").cast("string")
    cw = F.lit(compound_weight) * F.when(q == "compound", 1.2).when(q.isin("orf", "crispr"), 0.5).otherwise(1.0)
    gw = F.lit(genetic_weight) * F.when(q == "compound", 0.8).when(q.isin("orf", "crispr"), 1.5).otherwise(1.0)
    cw = cw * F.when((F.col("_nc") < 5) & (F.col("_ng") >= 5), 0.25).otherwise(1.0)
    gw = gw * F.when((F.col("_ng") < 5) & (F.col("_nc") >= 5), 0.25).otherwise(1.0)
    both = (F.col("_hc") == 1) & (F.col("_hg") == 1)
    w = size.join(have, "query_id").select(
        "query_id", F.when(both, cw / (cw + gw)).otherwise(F.col("_hc")).alias("_cw"), F.when(both, gw / (cw + gw)).otherwise(F.col("_hg")).alias("_gw")
    )
    mixed = attach(s, w, ["query_id"]).groupBy("query_id", "gene_id").agg(
        F.sum(F.col("_s") * F.when(F.col("_k") == "c", F.col("_cw")).otherwise(F.col("_gw"))).alias("score")
    )
    if idf is not None:
        mixed = mixed.join(idf, "gene_id", "left").withColumn("score", F.col("score") * F.coalesce("idf", F.lit(1.0))).drop("idf")
    return mixed.filter("score > 0")


def supporting_references(neighbours: DataFrame, ref_genes: DataFrame, genes: DataFrame) -> DataFrame:
    """Neighbours that map to at least one nominated (query_id, gene_id)."""
    hit = ref_genes.join(genes.select("query_id", "gene_id"), "gene_id").select("query_id", "ref_id").distinct()
    return neighbours.join(hit, ["query_id", "ref_id"], "left_semi")


def hybrid_merge(core: DataFrame, expansion: DataFrame) -> DataFrame:
    """Genes in both: max(core, .75 core + .25 expansion); otherwise whichever exists."""
    j = core.select("query_id", "gene_id", F.col("score").alias("_c")).join(
        expansion.select("query_id", "gene_id", F.col("score").alias("_e")), ["query_id", "gene_id"], "full_outer"
    )
    both = F.greatest(F.col("_c"), 0.75 * F.col("_c") + 0.25 * F.col("_e"))
    present = F.col("_c").isNotNull() & F.col("_e").isNotNull()
    return j.select("query_id", "gene_id", F.when(present, both).otherwise(F.coalesce("_c", "_e")).alias("score"))


def query_modality(members: DataFrame) -> DataFrame:
    """The single modality among a query's members, else null."""
    return members.groupBy("query_id").agg(
        F.when(F.countDistinct("modality") == 1, F.max("modality")).alias("query_modality")
    )


def high_hub_mass(neighbours: DataFrame, refs: DataFrame) -> DataFrame:
    """Share of evidence in the quarter of a query's neighbours with the largest hub scores.

    Only neighbours with evidence and a hub score count; fewer than four give 0.
    """
    from lociweave.operators.sliced import ranked

    known = neighbours.filter("evidence > 0").join(refs.filter("hub_score is not null").select(F.col("id").alias("ref_id"), F.col("hub_score").alias("_h")), "ref_id")
    placed = ranked(known, ["query_id"], [F.col("_h").asc(), F.col("ref_id").asc()], "_r", count="_n")
    high = (F.col("_n") >= 4) & (F.col("_r") > F.floor(0.75 * F.col("_n")))
    return placed.groupBy("query_id").agg((F.sum(F.when(high, F.col("evidence")).otherwise(0.0)) / F.sum("evidence")).alias("high_hub_mass"))


def target_agreement(neighbours: DataFrame, ref_genes: DataFrame, k: int = 3) -> DataFrame:
    """Per query the largest mass of one primary target, and the mass of the ``k`` largest targets, among mapped neighbours.

    A reference's evidence goes in equal parts to its heaviest targets for the
    first, by weight to its ``k`` heaviest for the second.
    """
    n = neighbours.filter("evidence > 0").select("query_id", "ref_id", "evidence")
    best = ref_genes.groupBy("ref_id").agg(F.max("weight").alias("_b"))
    first = attach_count(attach(ref_genes, best, ["ref_id"]).filter("weight = _b").select("ref_id", "gene_id"), ["ref_id"], "_c")
    some = attach_total(top_k(ref_genes, ["ref_id"], k, [F.col("weight").desc(), F.col("gene_id").asc()], "_g"), ["ref_id"], "weight", "_w")
    total = n.join(best, "ref_id").groupBy("query_id").agg(F.sum("evidence").alias("_t"))
    primary = n.join(first, "ref_id").groupBy("query_id", "gene_id").agg(F.sum(F.col("evidence") / F.col("_c")).alias("_m"))
    mass = n.join(some, "ref_id").groupBy("query_id", "gene_id").agg(F.sum(F.col("evidence") * F.col("weight") / F.col("_w")).alias("_m"))
    top = top_k(mass, ["query_id"], k, [F.col("_m").desc(), F.col("gene_id").asc()], "_g")
    j = total.join(primary.groupBy("query_id").agg(F.max("_m").alias("_p")), "query_id").join(top.groupBy("query_id").agg(F.sum("_m").alias("_k")), "query_id")
    return j.select("query_id", (F.col("_p") / F.col("_t")).alias("primary_agreement"), (F.col("_k") / F.col("_t")).alias("top_agreement"))


def confidence_tiers(neighbours: DataFrame, weights: DataFrame, counts: DataFrame, refs: DataFrame, scores: DataFrame, ref_genes: DataFrame) -> DataFrame:
    """Retrieval and specificity tiers per query.

    ``weights`` are the selected (query_id, gene_id, weight, rank) rows,
    ``scores`` all (query_id, gene_id, score), ``counts`` the (query_id,
    n_positive, n_negative, n_all) of all candidate similarities, ``refs`` the
    hub scores and ``ref_genes`` the targets of the references.
    """
    r = counts.groupBy("query_id").agg(F.sum("n_positive").alias("n_positive"), (F.sum("n_negative") / F.sum("n_all")).alias("negative_fraction"))
    retrieval = F.when((F.col("n_positive") >= 10) & (F.col("negative_fraction") < 0.4), "high").when(
        (F.col("n_positive") >= 5) & (F.col("negative_fraction") < 0.7), "medium").otherwise("low")
    g = weights.groupBy("query_id").agg(F.sum(F.when(F.col("rank") <= 10, F.col("weight")).otherwise(0.0)).alias("top10_mass"))
    c = scores.groupBy("query_id").agg((F.max("score") / F.sum("score")).alias("top_gene_share"))
    j = r.join(g, "query_id", "left").join(c, "query_id", "left").join(high_hub_mass(neighbours, refs), "query_id", "left").join(target_agreement(neighbours, ref_genes), "query_id", "left")
    at_least = lambda column, bound: F.coalesce(F.col(column) >= bound, F.lit(False))
    strong = at_least("top10_mass", 0.65)
    agree = at_least("top_gene_share", 0.25) | at_least("primary_agreement", 0.35) | at_least("top_agreement", 0.5)
    hubs = F.coalesce("high_hub_mass", F.lit(0.0))
    specific = F.when(F.col("top10_mass").isNull(), "low").when(strong & agree & (hubs <= 0.5), "high").when((strong | agree) & (hubs <= 0.75), "medium").otherwise("low")
    return j.withColumn("retrieval", retrieval).withColumn("specificity", specific)


def calorimetry_evidence(pairs: DataFrame, refs: DataFrame, power: float = 1.0, hub_mode: str = "inverse_linear", mismatch_penalty: float = 0.15,
                         k: int = 25) -> DataFrame:
    """max(0, sim)^p / hub x qc x (1 - penalty)^mismatches; strongest ``k`` per query.

    ``pairs`` carries the number of context ``mismatches``.
    """
    r = refs.select(F.col("id").alias("ref_id"), F.coalesce("qc_weight", F.lit(1.0)).alias("qc"), F.coalesce("hub_score", F.lit(0.0)).alias("h"))
    h = F.greatest(F.lit(0.0), F.col("h"))
    hub = {"none": F.lit(1.0), "inverse_linear": 1.0 + h, "inverse_rank": 1.0 + 2.0 * h}[hub_mode]
    e = F.pow(F.greatest(F.lit(0.0), F.col("similarity")), F.lit(power)) / hub * F.col("qc")
    e = e * F.pow(F.lit(1.0 - mismatch_penalty), F.coalesce(F.col("mismatches"), F.lit(0)).cast("double"))
    out = pairs.join(r, "ref_id").withColumn("evidence", e).filter("evidence > 0")
    return top_k(out, ["query_id"], k, [F.col("evidence").desc(), F.col("ref_id").asc()])


def term_scores(features: DataFrame, templates: DataFrame, keys: Sequence[str] = ("query_id",)) -> DataFrame:
    """max(0, sum w x / sum |w|) per (keys, term) over the whole template; terms without a measured feature drop out."""
    den = templates.groupBy("term_id").agg(F.sum(F.abs("weight")).alias("_d"))
    num = features.join(templates, "feature").groupBy(*keys, "term_id").agg(F.sum(F.col("weight") * F.col("value")).alias("_n"))
    j = attach(num, den, ["term_id"]).filter("_d > 0")
    return j.select(*keys, "term_id", F.greatest(F.lit(0.0), F.col("_n") / F.col("_d")).alias("score"))


def route_terms(terms: DataFrame, gene_edges: DataFrame, neighbours: DataFrame | None = None, keys: Sequence[str] = ("query_id",),
                neighbour_factor: float = 0.5) -> DataFrame:
    """Term score over the term's own degree x edge weight per gene; edges of one-hop neighbour terms count half.

    The degree is that of the scored term (1 without edges), for its own and its neighbours' edges.
    """
    deg = gene_edges.groupBy("term_id").agg(F.count("*").alias("_deg"))
    t = terms.filter("score > 0").join(deg, "term_id", "left").select(*keys, "term_id", (F.col("score") / F.coalesce("_deg", F.lit(1))).alias("_s"))
    if neighbours is not None:
        n = neighbours.select("term_id", F.col("neighbour_id").alias("_t")).distinct()
        hop = t.join(n, "term_id").select(*keys, F.col("_t").alias("term_id"), (F.col("_s") * neighbour_factor).alias("_s"))
        t = t.unionByName(hop)
    return t.join(gene_edges, "term_id").groupBy(*keys, "gene_id").agg(F.sum(F.col("_s") * F.col("weight")).alias("score"))
