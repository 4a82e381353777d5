"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Targets share the corpus' words among the sources by weight, each at most a
few times its source. Document rates stay as close to one as the targets allow
in relative entropy: minimising the divergence under one token constraint per
source gives rates exp(l * z) with z the document's size over its source's mean
size, cut at the cap, and one dual variable l per source. Newton steps on the
convex dual read sums over (source, size) cells, which are far fewer than
documents. The rates are then rounded into copies: cell by cell with an even
spread, and a last correction with the smallest documents brings each source's
words to within a small document of its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociweave.llm.common import col, table
from lociweave.operators.sliced import cumulative, ranked
from lociweave.session import materialize

CAP = 3
WEIGHTS = (1, 2, 3)
#: Relative error of a source's expected words at which the dual counts as solved; more steps than this are an error.
TOLERANCE = 1e-9
MAX_STEPS = 200


def word_count(text: str = "text"):
    """Number of runs of characters other than the six ASCII spaces; counting run starts keeps it one expression."""
    plain = F.translate(F.coalesce(col(text).cast("string"), F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(plain, " +"), lambda w: w != "")).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """Columns ``source``, ``source_size``, ``target`` from sizes per source.

    Sources by code point, null last, take the weights in turn. Sharing the
    excess over the caps again and again ends at min(cap * size, t * weight)
    with one level t for all; the sources that are capped are a prefix of the
    order by cap * size / weight, so running sums find t.
    """
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    placed = ranked(sizes, [], order, "place").withColumn("weight", F.element_at(cycle, ((F.col("place") - 1) % len(weights) + 1).cast("int")))
    placed = materialize(placed.withColumn("most", F.lit(float(cap)) * F.col("source_size")))
    total, weight = placed.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return placed.select("source", "source_size", F.lit(0.0).alias("target"))
    up = placed.withColumn("ratio", F.col("most") / F.col("weight"))
    run = cumulative(up, [], [F.col("ratio").asc(), F.col("place").asc()], "most", "most_run")
    run = cumulative(run, [], [F.col("ratio").asc(), F.col("place").asc()], "weight", "weight_run")
    # The level if exactly this row and all before it are capped; it holds if they are and the rest aren't.
    left = F.greatest(F.lit(float(weight)) - F.col("weight_run"), F.lit(0.0))
    level = run.withColumn("level", F.when(left > 1e-12, (F.lit(float(total)) - F.col("most_run")) / left))
    found = level.filter("ratio < level").agg(F.max("level")).first()[0]
    t = max(found if found is not None else 0.0, total / weight)
    return placed.select("source", "source_size", F.least(F.col("most"), F.lit(t) * F.col("weight")).alias("target"))


def solve_rates(cells: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """Dual variable ``l`` per source: the sum of n * size * min(cap, exp(l * z)) meets the target.

    Newton steps inside a bracket; a step that leaves it is replaced by its
    middle. Sources whose target is the cap itself get an infinite ``l``.
    """
    n = cells.groupBy("source").agg(F.sum("n").alias("docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    base = goals.join(n, goals["source"].eqNullSafe(n["source"])).select(
        goals["source"], "source_size", "target", (F.col("source_size") / F.col("docs")).alias("mean"), "least"
    ).filter("source_size > 0")
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    ratio = F.col("target") / F.col("source_size")
    # At hi every document is at the cap; at lo every one is below the target's share.
    state = base.withColumn("hi", F.lit(float(cap)).cast("double")).withColumn("hi", F.log(F.lit(float(cap))) * F.col("mean") / F.col("least")).withColumn(
        "lo", F.least(F.log(ratio), F.lit(0.0)) * F.col("mean") / F.col("least")
    ).select("source", "source_size", "target", "mean", "lo", "hi", F.when(full, F.lit(float("inf"))).otherwise(F.log(ratio)).alias("l"), full.alias("done"))
    state = materialize(state)
    for _ in range(MAX_STEPS):
        if state.filter(~F.col("done")).isEmpty():
            return state.select("source", "mean", "l")
        open_ = state.filter(~F.col("done"))
        z = F.col("size") / F.col("mean")
        raw = F.exp(F.least(F.col("l") * z, F.lit(50.0)))
        below = raw < cap
        words = F.col("n") * F.col("size")
        joined = cells.withColumnRenamed("source", "of").join(open_.select("source", "mean", "l"), F.col("of").eqNullSafe(F.col("source")))
        sums = joined.groupBy("of").agg(F.sum(words * F.least(raw, F.lit(float(cap)))).alias("got"), F.sum(F.when(below, words * z * raw).otherwise(0.0)).alias("slope"))
        step = state.join(sums, F.col("source").eqNullSafe(F.col("of")), "left")
        over = F.col("got") > F.col("target")
        near = F.abs(F.col("got") - F.col("target")) <= TOLERANCE * F.col("target")
        step = step.select(
            "source", "source_size", "target", "mean", "got", "slope", "l", "done", near.alias("near"),
            F.when(~F.col("done") & ~over, F.greatest("lo", "l")).otherwise(F.col("lo")).alias("lo"), F.when(~F.col("done") & over, F.least("hi", "l")).otherwise(F.col("hi")).alias("hi"),
        )
        newton = F.col("l") - (F.col("got") - F.col("target")) / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi"))
        stuck = F.col("hi") - F.col("lo") <= 1e-13 * F.greatest(F.abs("lo"), F.abs("hi"))
        state = materialize(step.select(
            "source", "source_size", "target", "mean", "lo", "hi",
            F.when(F.col("done") | F.col("near"), F.col("l")).when(inside, newton).otherwise((F.col("lo") + F.col("hi")) / 2).alias("l"),
            (F.col("done") | F.coalesce("near", F.lit(False)) | stuck).alias("done"),
        ))
    raise RuntimeError(f"the dual isn't solved after {MAX_STEPS} steps")


def copies_per_cell(cells: DataFrame, goals: DataFrame, dual: DataFrame, cap: int = CAP) -> DataFrame:
    """Whole copies for each (source, size) cell: ``copies`` among its ``n`` documents."""
    joined = cells.join(dual.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    rate = F.when(F.col("size") > 0, F.least(F.lit(float(cap)), F.exp(F.least(F.col("l") * F.col("size") / F.col("mean"), F.lit(50.0))))).otherwise(F.lit(1.0))
    rated = joined.withColumn("want", F.col("n") * rate).select("source", "size", "n", "want").withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    keys = ["key", "none"]
    run = cumulative(rated, keys, [F.col("size").desc()], "want", "upto")
    # Rounding the running sum, largest first, lets neighbouring sizes make up for each other.
    even = materialize(run.withColumn("copies", F.least((F.floor(F.col("upto") + 0.5) - F.floor(F.col("upto") - F.col("want") + 0.5)).cast("long"), cap * F.col("n"))))
    taken = even.groupBy(*keys).agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
    aim = goals.select(F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none"), "target")
    gap = taken.join(aim, keys).select(*keys, F.round(F.col("target") - F.col("taken")).cast("long").alias("gap"))
    # The smallest documents take up the gap: room is how many copies a cell can gain or lose.
    room = even.join(gap, keys).withColumn("room", F.when(F.col("size") == 0, 0).when(F.col("gap") > 0, cap * F.col("n") - F.col("copies")).otherwise(F.col("copies")))
    filled = cumulative(room.withColumn("words", F.col("room") * F.col("size")), keys, [F.col("size").asc()], "words", "filled")
    rest = F.abs("gap") - (F.col("filled") - F.col("words"))
    more = F.when(F.col("size") > 0, F.greatest(F.lit(0), F.least(F.col("room"), F.floor(rest / F.col("size"))))).otherwise(F.lit(0))
    return filled.select("source", "size", "n", (F.col("copies") + F.signum(F.col("gap").cast("double")).cast("long") * more).cast("long").alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[float] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Columns doc_id, source, size, source_size, target, copies, taken; one row per row of ``docs``.

    A null text has size 0; documents without words keep their one copy of
    nothing. Within a cell of equal source and size the documents with the
    smallest ids take the odd copies; repeated rows are interchangeable, so
    reruns agree. An empty table gives an empty result.
    """
    sized = materialize(docs.select(col(doc_id).alias("doc_id"), col(source).cast("string").alias("source"), word_count(text).alias("size")))
    cells = materialize(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    goals = materialize(targets(cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), weights, cap))
    dual = solve_rates(cells, goals, cap)
    planned = materialize(copies_per_cell(cells, goals, dual, cap).withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull()))
    keyed = sized.withColumn("key", F.coalesce("source", F.lit(""))).withColumn("none", F.col("source").isNull())
    placed = ranked(keyed, ["key", "none", "size"], [F.col("doc_id").asc()], "place")
    whole = placed.join(planned.drop("source"), ["key", "none", "size"])
    odd = F.col("place") <= F.col("copies") % F.col("n")
    aim = goals.select(F.coalesce("source", F.lit("")).alias("key"), F.col("source").isNull().alias("none"), "source_size", "target")
    out = whole.withColumn("own", F.floor(F.col("copies") / F.col("n")) + odd.cast("long")).join(aim, ["key", "none"])
    return out.select("doc_id", "source", "size", "source_size", "target", F.col("own").cast("long").alias("copies"), (F.col("own") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the mix takes at least once, with size, source_size, target, copies and taken."""
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("rid"), F.struct(*[col(c) for c in docs.columns]).alias("row")))
    plan = mix(rows.select("rid", "row.*").select("rid", *[col(how.get(c, c)).alias(c) for c in ("source", "text")]), doc_id="rid")
    plan = plan.filter("copies > 0").select(F.col("doc_id").alias("rid"), F.struct("size", "source_size", "target", "copies", "taken").alias("mix"))
    new = [c for c in ("size", "source_size", "target", "copies", "taken") if c not in docs.columns]
    return rows.join(plan, "rid").select("row.*", *[F.col("mix").getField(c).alias(c) for c in new])


def op8_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op8_entropy_balance": (op8_entropy_balance, None)}
