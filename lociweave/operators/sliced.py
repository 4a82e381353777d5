"""Ordered computations over groups of any size.

A window over ``partitionBy(key)`` puts a whole key into one task. Here the
rows are range-partitioned on (keys, order) instead, so one key may span many
tasks ("slices"). Each slice is processed on its own and then corrected by a
small per-(key, slice) summary of its neighbours; the only window over a full
key sees one row per slice.

The slice number is a physical placement, so the sliced table is written
before it is used twice. ``order`` must order rows of a key uniquely, up to
rows that are interchangeable.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociweave.operators.joins import same_keys
from lociweave.session import materialize

SLICE, POS = "_slice", "_pos"


def slice_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort by (keys, order); add slice number and position in slice."""
    by = [F.col(k).asc() for k in keys] + list(order)
    serial = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("_sl_serial", serial)
        .withColumn(SLICE, F.shiftright("_sl_serial", 33).cast("int"))
        .withColumn(POS, F.col("_sl_serial").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_sl_serial")
    )
    return materialize(placed)


def _across(keys: Sequence[str]) -> Window:
    """Window over the slices of a key: one row per (key, slice)."""
    return Window.partitionBy(*keys).orderBy(SLICE)


def _within(keys: Sequence[str], descending: bool = False) -> Window:
    pos = F.col(POS).desc() if descending else F.col(POS).asc()
    return Window.partitionBy(*keys, SLICE).orderBy(pos)


def _join_slices(sliced: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    return same_keys(sliced, summary, [*keys, SLICE])


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    count: str | None = None,
) -> DataFrame:
    """Dense 1..n rank per key; optionally the key's row count as well."""
    sliced = slice_rows(df, keys, order)
    sizes = sliced.groupBy(*keys, SLICE).agg(F.count("*").alias("_sl_n"), F.min(POS).alias("_sl_first"))
    w = _across(keys)
    before = F.coalesce(F.sum("_sl_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cols = [*keys, SLICE, (before - F.col("_sl_first") + 1).alias("_sl_shift")]
    if count:
        cols.append(F.sum("_sl_n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(count))
    out = _join_slices(sliced, sizes.select(*cols), keys)
    return out.withColumn(rank, (F.col(POS) + F.col("_sl_shift")).cast("long")).drop(SLICE, POS, "_sl_shift")


def cumulative(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: str,
    running: str = "running",
    total: str | None = None,
    rank: str | None = None,
) -> DataFrame:
    """Running sum of ``value`` in order, with optional key total and rank."""
    sliced = slice_rows(df, keys, order)
    sums = sliced.groupBy(*keys, SLICE).agg(
        F.sum(value).alias("_sl_s"), F.count("*").alias("_sl_n"), F.min(POS).alias("_sl_first")
    )
    w = _across(keys)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summary = sums.select(
        *keys,
        SLICE,
        F.coalesce(F.sum("_sl_s").over(earlier), F.lit(0)).alias("_sl_before"),
        F.sum("_sl_s").over(whole).alias("_sl_total"),
        (F.coalesce(F.sum("_sl_n").over(earlier), F.lit(0)) - F.col("_sl_first") + 1).alias("_sl_shift"),
    )
    local = F.sum(value).over(_within(keys).rowsBetween(Window.unboundedPreceding, 0))
    out = _join_slices(sliced.withColumn("_sl_local", local), summary, keys)
    out = out.withColumn(running, F.col("_sl_local") + F.col("_sl_before"))
    if total:
        out = out.withColumn(total, F.col("_sl_total"))
    if rank:
        out = out.withColumn(rank, (F.col(POS) + F.col("_sl_shift")).cast("long"))
    return out.drop(SLICE, POS, "_sl_local", "_sl_before", "_sl_total", "_sl_shift")


def step_up_minimum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    expr,
    out: str,
    rank: str = "rank",
    count: str = "n",
) -> DataFrame:
    """Minimum of ``expr(rank, count)`` over this row and all later rows of its key."""
    r = ranked(df, keys, order, rank, count)
    # The rank fixes the order now, so slices can be cut by rank and need no second sort pass.
    sliced = r.withColumn("_sl_v", expr(F.col(rank), F.col(count))).withColumn(
        SLICE, F.floor((F.col(rank) - 1) / F.lit(100_000)).cast("int")
    ).withColumn(POS, F.col(rank))
    later = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc()).rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        sliced.groupBy(*keys, SLICE)
        .agg(F.min("_sl_v").alias("_sl_m"))
        .select(*keys, SLICE, F.min("_sl_m").over(later).alias("_sl_after"))
    )
    local = F.min("_sl_v").over(_within(keys, descending=True).rowsBetween(Window.unboundedPreceding, 0))
    joined = _join_slices(sliced.withColumn("_sl_local", local), summary, keys)
    return joined.withColumn(out, F.least("_sl_local", "_sl_after")).drop(SLICE, POS, "_sl_v", "_sl_local", "_sl_after")


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """Attach the previous row's ``columns`` (lag 1 in order) to every row."""
    sliced = slice_rows(df, keys, order)
    carried = F.struct(*columns)
    last = sliced.groupBy(*keys, SLICE).agg(F.max_by(carried, POS).alias("_sl_last"))
    summary = last.select(*keys, SLICE, F.lag("_sl_last").over(_across(keys)).alias("_sl_carry"))
    local = F.lag(carried).over(_within(keys))
    out = _join_slices(sliced.withColumn("_sl_lag", local), summary, keys)
    out = out.withColumn("_sl_p", F.coalesce("_sl_lag", "_sl_carry"))
    for c in columns:
        out = out.withColumn(f"{prefix}{c}", F.col("_sl_p").getField(c))
    return out.drop(SLICE, POS, "_sl_lag", "_sl_carry", "_sl_p")


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, q: float, out: str) -> DataFrame:
    """Exact interpolated quantile of ``value`` per key; one row per key.

    Values are counted first, so repeated values travel once and a hot key is
    reduced on the map side. Nulls are ignored.
    """
    hist = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_sl_x")).agg(F.count("*").alias("_sl_c"))
    cum = cumulative(hist, keys, [F.col("_sl_x").asc()], "_sl_c", running="_sl_hi", total="_sl_n")
    # Zero-based target position t between floor(t) and ceil(t); a value covers (_hi - _c, _hi].
    cum = cum.withColumn("_sl_t", (F.col("_sl_n") - 1) * F.lit(float(q)))
    lo, hi = F.floor("_sl_t") + 1, F.ceil("_sl_t") + 1
    covers = lambda p: (F.col("_sl_hi") >= p) & (F.col("_sl_hi") - F.col("_sl_c") < p)
    hit = cum.filter(covers(lo) | covers(hi))
    picked = hit.groupBy(*keys).agg(
        F.max(F.when(covers(lo), F.col("_sl_x"))).alias("_sl_a"),
        F.max(F.when(covers(hi), F.col("_sl_x"))).alias("_sl_b"),
        F.max(F.col("_sl_t") - F.floor("_sl_t")).alias("_sl_f"),
    )
    return picked.select(*keys, (F.col("_sl_a") + (F.col("_sl_b") - F.col("_sl_a")) * F.col("_sl_f")).alias(out))


def median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median") -> DataFrame:
    return exact_quantile(df, keys, value, 0.5, out)
