"""Gene programs by non-negative factorisation of long count tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociweave.session import discard, materialize

EPS = 1e-10
#: Gene loadings (genes x programs) that may stand on the driver and in every task: 256 KB a step, however many cells there are.
LOADINGS = 1 << 15


def _columns(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def _start_values(key: str, prefix: str, k: int, seed: int) -> list[Column]:
    """Deterministic positive start values from a hash of the key."""
    return [
        (F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed * 1000 + i)), F.lit(1_000_003)) / 1_000_003.0 + 0.1).alias(c)
        for i, c in enumerate(_columns(prefix, k))
    ]


def _start(df: DataFrame, key: str, prefix: str, k: int, seed: int) -> DataFrame:
    return df.select(key).distinct().select(key, *_start_values(key, prefix, k, seed))


def _gram(df: DataFrame, prefix: str, k: int) -> list[list[float]]:
    """k x k inner products of the factor columns: one aggregate row."""
    c = _columns(prefix, k)
    row = df.agg(*[F.sum(F.col(c[i]) * F.col(c[j])).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]).first()
    return [[row[f"g{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]


def _update(entries: DataFrame, mine: DataFrame, other: DataFrame, key: str, other_key: str, a: str, b: str, k: int) -> DataFrame:
    """Multiplicative update of one factor: mine *= (V other) / (mine gram(other)).

    Also gives each row's share of the inner product of V with the new product, as ``_cross``. Factors are
    merged, not broadcast: a broadcast takes a whole factor through the driver at every step.
    """
    mc, oc = _columns(a, k), _columns(b, k)
    gram = _gram(other, b, k)
    num = entries.join(other.hint("merge"), other_key).groupBy(key).agg(*[F.sum(F.col("value") * F.col(c)).alias(f"n_{c}") for c in oc])
    j = mine.hint("merge").join(num, key)

    def den(i: int) -> Column:
        total = F.lit(EPS)
        for x in range(k):
            total = total + F.col(mc[x]) * F.lit(float(gram[x][i]))
        return total

    new = [F.col(mc[i]) * F.col(f"n_{oc[i]}") / den(i) for i in range(k)]
    cross = sum((new[i] * F.col(f"n_{oc[i]}") for i in range(k)), F.lit(0.0))
    return materialize(j.select(key, *[new[i].alias(mc[i]) for i in range(k)], cross.alias("_cross")))


def _residual(total: float, w: DataFrame, h: DataFrame, k: int) -> float:
    """Squared distance of V from W H, from sums over rows and the inner products of both factors."""
    gw, gh = _gram(w, "w", k), _gram(h, "h", k)
    return total - 2 * w.agg(F.sum("_cross")).first()[0] + sum(gw[i][j] * gh[i][j] for i in range(k) for j in range(k))


def _run(step: Callable[[], None], residual: Callable[[], float], total: float, iterations: int, tol: float, check_every: int) -> None:
    """Take steps until the residual settles; an error if it doesn't."""
    before = None
    for done in range(1, iterations + 1):
        step()
        if done % check_every == 0:
            now = residual()
            if now <= 1e-12 * total or before is not None and before - now <= tol * check_every * now:
                return
            before = now
    raise RuntimeError(f"the factors aren't settled after {iterations} steps")


def nmf_programs(
    entries: DataFrame, k: int, iterations: int = 1000, seed: int = 0, cell: str = "cell_id", gene: str = "gene_id", tol: float = 1e-4, check_every: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(cell usage W, gene loadings H) of a long non-negative table, by multiplicative updates.

    Cells stay distributed. Up to ``LOADINGS`` gene loadings are held on the driver, and a step updates every
    cell beside its own entries; with more, both factors stay distributed, and per half-step the only values on
    the driver are the k x k inner products. Ends when the residual falls by less than ``tol`` of itself per
    step; an error is raised if that isn't reached in ``iterations``. Values depend on the start and are not
    comparable with another solver's.
    """
    v = materialize(entries.filter("value > 0").groupBy(cell, gene).agg(F.sum("value").cast("double").alias("value")))
    h = materialize(_start(v, gene, "h", k, seed + 1))
    total = v.agg(F.sum(F.col("value") * F.col("value"))).first()[0]
    if total is None:
        return _start(v, cell, "w", k, seed), h
    fit = _beside_cells if h.count() * k <= LOADINGS else _distributed
    return fit(v, h, k, seed, cell, gene, float(total), iterations, tol, check_every)


def _distributed(
    v: DataFrame, h: DataFrame, k: int, seed: int, cell: str, gene: str, total: float, iterations: int, tol: float, check_every: int
) -> tuple[DataFrame, DataFrame]:
    """The fit with both factors as tables."""
    w = materialize(_start(v, cell, "w", k, seed))

    def step() -> None:
        nonlocal w, h
        old = w, h
        h = _update(v, h, w, gene, cell, "h", "w", k)
        w = _update(v, w, h, cell, gene, "w", "h", k)
        for t in old:
            discard(t)

    _run(step, lambda: _residual(total, w, h, k), total, iterations, tol, check_every)
    discard(v)
    return w.drop("_cross"), h.drop("_cross")


def _beside_cells(
    v: DataFrame, h: DataFrame, k: int, seed: int, cell: str, gene: str, total: float, iterations: int, tol: float, check_every: int
) -> tuple[DataFrame, DataFrame]:
    """The fit with gene loadings as one array that every task gets, and each cell's usage beside its entries.

    A step writes the cells anew in the tasks that read them, with each task's sums per gene beside them. These
    sums are all that is shuffled and collected, so that grows with genes and tasks and not with cells.
    """
    genes = materialize(h.filter(F.col(gene).isNotNull()).withColumn("_at", F.row_number().over(Window.orderBy(gene)) - 1))
    found = genes.orderBy("_at").collect()
    loadings = np.array([[r[c] for c in _columns("h", k)] for r in found], dtype=float).reshape(-1, k)
    placed = v.filter(F.col(cell).isNotNull()).join(F.broadcast(genes.select(gene, "_at")), gene)
    lists = placed.groupBy(cell).agg(F.sort_array(F.collect_list(F.struct("_at", "value"))).alias("_e"))
    usage = F.array(*_start_values(cell, "w", k, seed)).alias("_usage")
    none = [F.lit(None).cast(t).alias(c) for c, t in (("_part", "int"), ("_sums", "array<double>"))]
    rows = lists.select(cell, F.col("_e._at").alias("_genes"), F.col("_e.value").alias("_values"), usage, *none)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    state = materialize(rows.mapInArrow(_cell_step(len(loadings), k), schema))
    discard(v)
    sums = _gene_sums(state, len(loadings), k)

    def step() -> None:
        nonlocal state, sums, loadings
        loadings = loadings * sums[:-k] / (loadings @ sums[-k:] + EPS)
        moved = state.filter("_part is null").mapInArrow(_cell_step(len(loadings), k, loadings), schema)
        old, state = state, materialize(moved)
        discard(old)
        sums = _gene_sums(state, len(loadings), k)

    def residual() -> float:
        return total - 2 * float((loadings * sums[:-k]).sum()) + float((sums[-k:] * (loadings.T @ loadings)).sum())

    _run(step, residual, total, iterations, tol, check_every)
    w = state.filter("_part is null").select(cell, *[F.col("_usage")[i].alias(c) for i, c in enumerate(_columns("w", k))])
    settled = [(r[gene], *map(float, x)) for r, x in zip(found, loadings)]
    return w, materialize(v.sparkSession.createDataFrame(settled, h.schema))


def _cell_step(n: int, k: int, loadings: np.ndarray | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Update every cell's usage by ``loadings``, if given; then a row per gene and program with the task's sums.

    Row g < n holds the sum over cells of value times usage, row n + i that of usage i times usage.
    """

    def lists(rows: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * k, rows.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, batch = np.zeros((n + k, k)), None
        gram = None if loadings is None else loadings.T @ loadings
        for batch in batches:
            if not batch.num_rows:
                continue
            at, values, usage = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("_genes", "_values", "_usage"))
            sizes = batch.column("_genes").value_lengths().to_numpy(zero_copy_only=False)
            usage = usage.reshape(-1, k)
            if gram is not None:
                num = np.add.reduceat(values[:, None] * loadings[at], np.cumsum(sizes) - sizes, axis=0)
                usage = usage * num / (usage @ gram + EPS)
            for i in range(k):
                sums[:n, i] += np.bincount(at, values * np.repeat(usage[:, i], sizes), n)
            sums[n:] += usage.T @ usage
            yield batch.set_column(3, batch.schema.field(3), lists(usage))
        if batch is not None:
            parts = [pa.nulls(n + k, f.type) for f in batch.schema]
            parts[4:] = pa.array(np.arange(n + k, dtype=np.int32)), lists(sums)
            yield pa.RecordBatch.from_arrays(parts, schema=batch.schema)

    return run


def _gene_sums(state: DataFrame, n: int, k: int) -> np.ndarray:
    """Sums of all tasks, by row."""
    parts = state.filter("_part is not null").groupBy("_part").agg(*[F.sum(F.col("_sums")[i]) for i in range(k)])
    sums = np.zeros((n + k, k))
    for r in parts.collect():
        sums[r[0]] = r[1:]
    return sums


def loadings_long(h: DataFrame, k: int, gene: str = "gene_id") -> DataFrame:
    """(program, gene_id, score) rows of the gene loadings."""
    return h.unpivot([gene], _columns("h", k), "program", "score").withColumn("program", F.regexp_replace("program", "^h", "program_"))
