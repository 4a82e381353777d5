"""Genomic interval, nearest-anchor and distance joins.

Intervals are 0-based half-open. All joins are equi joins on (group columns,
grid cell); no join is on the group columns alone. Equal intervals or centres
are collapsed before the join, so many features at one place cost one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINEST_BITS = 7
STEP_BITS = 3
#: A stretch, within which features and genes stand together, is so many times as long as the links reach.
STRETCH = 8


def _grid_width(start: str, end: str) -> Column:
    """Cell width of the size class, 2^(7+3k): at least the interval's length, so it meets at most two cells."""
    length = F.greatest(F.col(end) - F.col(start), F.lit(1)).cast("double")
    step = F.greatest(F.lit(0), F.ceil((F.log2(length) - FINEST_BITS) / STEP_BITS))
    return F.pow(F.lit(2.0), (step * STEP_BITS + FINEST_BITS).cast("double")).cast("long")


def _cell(pos: Column) -> Column:
    return F.floor(pos / F.col("_grid")).cast("long")


def _spread(df: DataFrame, start: str, end: str, own: str, widths: DataFrame | None, strict: bool) -> DataFrame:
    """Place rows in grid cells of their own width, or of every wider width in ``widths``.

    ``widths`` holds the distinct size classes of the other side: at most 19
    rows for 64-bit coordinates, so its broadcast is bounded.
    """
    if widths is None:
        placed = df.withColumn("_grid", F.col(own))
    else:
        wide_enough = F.col("_grid") > F.col(own) if strict else F.col("_grid") >= F.col(own)
        placed = df.join(F.broadcast(widths), wide_enough)
    first, last = _cell(F.col(start)), _cell(F.greatest(F.col(end) - 1, F.col(start)))
    placed = placed.withColumn("_c0", first).withColumn("_c1", last)
    both = F.when(F.col("_c0") == F.col("_c1"), F.array("_c0")).otherwise(F.array("_c0", "_c1"))
    return placed.withColumn("_cell", F.explode(both)).drop("_c0", "_c1")


def overlap_pairs(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """All (left, right) pairs with ``l_start < r_end and r_start < l_end`` per ``on`` group.

    Expects ``l_start, l_end`` on the left and ``r_start, r_end`` on the right.
    Interval sizes may span many orders of magnitude: the longer interval of a
    pair decides the grid, so neither side is exploded to more than a few cells.
    """
    lt = left.withColumn("_ll", _grid_width("l_start", "l_end"))
    rt = right.withColumn("_rl", _grid_width("r_start", "r_end"))
    widths = lambda d, c: d.select(F.col(c).alias("_grid")).distinct()
    meets = (F.col("l_start") < F.col("r_end")) & (F.col("r_start") < F.col("l_end"))
    # A pair may share two cells; it is kept in the one where the later interval starts.
    home = F.col("_cell") == _cell(F.greatest("l_start", "r_start"))

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        return a.join(b, [*on, "_grid", "_cell"]).filter(meets & home).drop("_grid", "_cell", "_ll", "_rl")

    right_longer = join(
        _spread(lt, "l_start", "l_end", "_ll", widths(rt, "_rl"), strict=False),
        _spread(rt, "r_start", "r_end", "_rl", None, strict=False),
    )
    left_longer = join(
        _spread(lt, "l_start", "l_end", "_ll", None, strict=False),
        _spread(rt, "r_start", "r_end", "_rl", widths(lt, "_ll"), strict=True),
    )
    return right_longer.unionByName(left_longer)


def _distinct_spans(df: DataFrame, on: Sequence[str], start: str, end: str) -> DataFrame:
    return df.select(*on, F.col(start).alias("l_start"), F.col(end).alias("l_end")).distinct()


def promoters(genes: DataFrame, upstream: int = 2000, downstream: int = 500) -> DataFrame:
    """Strand-aware promoter interval per gene, clipped at zero."""
    plus = F.col("strand") == "+"
    before = F.when(plus, F.lit(upstream)).otherwise(F.lit(downstream))
    after = F.when(plus, F.lit(downstream)).otherwise(F.lit(upstream))
    return genes.withColumn("r_start", F.greatest(F.lit(0), F.col("tss") - before)).withColumn(
        "r_end", F.col("tss") + after
    )


def interval_links(
    spans: DataFrame, regions: DataFrame, on: Sequence[str] = ("chrom",), start: str = "start", end: str = "end"
) -> DataFrame:
    """Distinct feature span -> gene links for every overlapping region row, weight summed per gene.

    ``regions`` carries ``r_start, r_end, gene_id, link_weight``; equal regions
    of a gene are summed before the join.
    """
    on = list(on)
    packed = regions.groupBy(*on, "r_start", "r_end", "gene_id").agg(F.sum("link_weight").alias("link_weight"))
    pairs = overlap_pairs(_distinct_spans(spans, on, start, end), packed, on)
    return (
        pairs.groupBy(*on, F.col("l_start").alias(start), F.col("l_end").alias(end), "gene_id")
        .agg(F.sum("link_weight").alias("link_weight"))
        .withColumn("distance", F.lit(0).cast("long"))
    )


def overlap_score(
    features: DataFrame,
    regions: DataFrame,
    keys: Sequence[str] = (),
    weight: str | Column = "weight",
    on: Sequence[str] = ("chrom",),
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Sum of weight * link_weight over overlapping (feature, region) pairs, per (keys, gene).

    Same result as linking and then scoring, without a per-feature link table:
    weights are summed per distinct span, region weights per (span, gene), and
    the pairs are aggregated as they are produced.
    """
    on, keys = list(on), list(keys)
    w = F.col(weight) if isinstance(weight, str) else weight
    own = [k for k in keys if k not in on]
    spans = features.groupBy(*on, *own, F.col(start).alias("l_start"), F.col(end).alias("l_end")).agg(F.sum(w).alias("_w"))
    packed = regions.groupBy(*on, "r_start", "r_end", "gene_id").agg(F.sum("link_weight").alias("link_weight"))
    pairs = overlap_pairs(spans, packed, on)
    return pairs.groupBy(*keys, "gene_id").agg(F.sum(F.col("_w") * F.col("link_weight")).alias("score"))


def promoter_links(spans: DataFrame, genes: DataFrame, upstream: int = 2000, downstream: int = 500) -> DataFrame:
    """Promoter overlap: weight 1 per (span, gene). A gene listed once gives one link."""
    regions = promoters(genes, upstream, downstream).select(
        "chrom", "r_start", "r_end", "gene_id", F.lit(1.0).alias("link_weight")
    )
    return interval_links(spans, regions)


def external_links(spans: DataFrame, links: DataFrame) -> DataFrame:
    """Links from a region -> gene table; weights of all overlapping regions add up."""
    regions = links.select("chrom", F.col("start").alias("r_start"), F.col("end").alias("r_end"), "gene_id", "link_weight")
    return interval_links(spans, regions)


def overlap_max(
    spans: DataFrame,
    refs: DataFrame,
    value: str,
    out: str,
    on: Sequence[str] = ("chrom",),
    start: str = "start",
    end: str = "end",
    default: float = 1.0,
) -> DataFrame:
    """Attach ``greatest(default, max(value))`` over all overlapping reference intervals."""
    on = list(on)
    best = refs.groupBy(*on, F.col(start).alias("r_start"), F.col(end).alias("r_end")).agg(F.max(value).alias("_v"))
    # A value at or below the default can never change the result.
    best = best.filter(F.col("_v") > F.lit(float(default)))
    hits = (
        overlap_pairs(_distinct_spans(spans, on, start, end), best, on)
        .groupBy(*on, F.col("l_start").alias(start), F.col("l_end").alias(end))
        .agg(F.max("_v").alias("_v"))
    )
    return spans.join(hits, [*on, start, end], "left").withColumn(
        out, F.coalesce("_v", F.lit(float(default)))
    ).drop("_v")


def overlap_flag(
    spans: DataFrame,
    regions: DataFrame,
    out: str,
    on: Sequence[str] = ("chrom",),
    start: str = "start",
    end: str = "end",
    distinct: bool = False,
) -> DataFrame:
    """Attach a boolean: does the span meet any region?

    Only the furthest end per region start matters for existence, so the
    region side shrinks to at most one row per start position. ``distinct``
    says that no span comes twice.
    """
    on = list(on)
    places = spans.select(*on, F.col(start).alias("l_start"), F.col(end).alias("l_end")) if distinct else _distinct_spans(spans, on, start, end)
    reach = regions.groupBy(*on, F.col(start).alias("r_start")).agg(F.max(end).alias("r_end"))
    hits = (
        overlap_pairs(places, reach, on)
        .select(*on, F.col("l_start").alias(start), F.col("l_end").alias(end))
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    return spans.join(hits, [*on, start, end], "left").withColumn(out, F.coalesce("_hit", F.lit(False))).drop("_hit")


def nearest_links(
    centres: DataFrame,
    anchors: DataFrame,
    max_distance: int | None = 100_000,
    on: Sequence[str] = ("chrom",),
    centre: str = "centre",
    tss: str = "tss",
    gene: str = "gene_id",
    ordinal: str = "gene_ordinal",
    cell_bits: int = 16,
) -> DataFrame:
    """Nearest anchor per distinct centre; at most one link each.

    A tie between the two sides goes to the anchor at or after the centre.
    Among equal anchors the first in file order wins at or after the centre,
    the last wins before it. The ordered pass runs inside (group, grid cell)
    partitions of at most 2^cell_bits positions; neighbouring cells are carried
    in through one summary row per cell.
    """
    on = list(on)
    cell = lambda c: F.floor(F.col(c) / F.lit(float(1 << cell_bits))).cast("long")
    at = anchors.groupBy(*on, F.col(tss).cast("long").alias("_pos")).agg(
        F.min_by(gene, ordinal).alias("_g_first"),
        F.max_by(gene, ordinal).alias("_g_last"),
    )
    anchor_rows = at.select(
        *on,
        "_pos",
        F.lit(1).alias("_kind"),
        F.struct(F.col("_pos").alias("p"), F.col("_g_first").alias("g")).alias("_after"),
        F.struct(F.col("_pos").alias("p"), F.col("_g_last").alias("g")).alias("_before"),
    )
    centre_rows = (
        centres.select(*on, F.col(centre).cast("long").alias("_pos"))
        .distinct()
        .select(
            *on,
            "_pos",
            F.lit(0).alias("_kind"),
            F.lit(None).cast(anchor_rows.schema["_after"].dataType).alias("_after"),
            F.lit(None).cast(anchor_rows.schema["_before"].dataType).alias("_before"),
        )
    )
    rows = anchor_rows.unionByName(centre_rows).withColumn("_cell", cell("_pos"))
    # Centres sort before anchors at the same position: that anchor then lies "at or after".
    # Both directions use running frames; a frame to the end of the partition would rescan it per row.
    fwd = Window.partitionBy(*on, "_cell").orderBy("_pos", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    rev = Window.partitionBy(*on, "_cell").orderBy(F.col("_pos").desc(), F.col("_kind").desc()).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(
        *on,
        "_pos",
        "_cell",
        "_kind",
        F.last("_before", ignorenulls=True).over(fwd).alias("_lb"),
        F.last("_after", ignorenulls=True).over(rev).alias("_la"),
    ).filter("_kind = 0")
    up = Window.partitionBy(*on).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*on).orderBy(F.col("_cell").desc()).rowsBetween(Window.unboundedPreceding, -1)
    cells = (
        rows.groupBy(*on, "_cell")
        .agg(
            F.max_by("_before", F.when(F.col("_kind") == 1, F.col("_pos"))).alias("_cb"),
            F.min_by("_after", F.when(F.col("_kind") == 1, F.col("_pos"))).alias("_ca"),
        )
        .select(
            *on,
            "_cell",
            F.last("_cb", ignorenulls=True).over(up).alias("_pb"),
            F.last("_ca", ignorenulls=True).over(down).alias("_na"),
        )
    )
    found = local.join(cells, [*on, "_cell"]).select(
        *on,
        F.col("_pos").alias(centre),
        F.coalesce("_lb", "_pb").alias("_b"),
        F.coalesce("_la", "_na").alias("_a"),
    )
    d_after, d_before = F.col("_a.p") - F.col(centre), F.col(centre) - F.col("_b.p")
    pick_after = F.col("_a").isNotNull() & (F.col("_b").isNull() | (d_after <= d_before))
    out = found.filter(F.col("_a").isNotNull() | F.col("_b").isNotNull()).select(
        *on,
        centre,
        F.when(pick_after, F.col("_a.g")).otherwise(F.col("_b.g")).alias(gene),
        F.when(pick_after, d_after).otherwise(d_before).alias("distance"),
        F.lit(1.0).alias("link_weight"),
    )
    return out if max_distance is None else out.filter(F.col("distance") <= max_distance)


def decay_links(
    centres: DataFrame,
    anchors: DataFrame,
    max_distance: int = 500_000,
    decay_length: float = 50_000.0,
    max_genes: int = 5,
    on: Sequence[str] = ("chrom",),
    centre: str = "centre",
    tss: str = "tss",
    gene: str = "gene_id",
) -> DataFrame:
    """Links to anchors within ``max_distance``, weight exp(-d/L), best ``max_genes`` per centre.

    Anchors at one position are equally far from any centre, so only the first
    ``max_genes`` names of a position can ever be linked; the rest are dropped
    before the join. The rank filter is applied on the map side as well.
    """
    on = list(on)
    width = float(max(max_distance, 1))
    cell = lambda c: F.floor(F.col(c) / F.lit(width)).cast("long")
    w_pos = Window.partitionBy(*on, "_tss").orderBy(gene)
    a = (
        anchors.select(*on, F.col(tss).cast("long").alias("_tss"), gene)
        .withColumn("_r", F.row_number().over(w_pos))
        .filter(F.col("_r") <= max_genes)
        .drop("_r")
        .withColumn("_near", F.explode(F.sequence(cell("_tss") - 1, cell("_tss") + 1)))
    )
    c = centres.select(*on, F.col(centre).cast("long").alias(centre)).distinct().withColumn("_near", cell(centre))
    d = F.abs(F.col(centre) - F.col("_tss"))
    weight = F.exp(-d.cast("double") / F.lit(float(decay_length))) if decay_length > 0 else F.lit(0.0)
    pairs = c.join(a, [*on, "_near"]).filter(d <= max_distance).select(
        *on, centre, gene, d.alias("distance"), weight.alias("link_weight")
    )
    w = Window.partitionBy(*on, centre).orderBy(F.col("link_weight").desc(), F.col(gene).asc())
    return pairs.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_genes).drop("_r")


def stretch_links(
    features: DataFrame,
    payload: Sequence[Column],
    genes: DataFrame,
    longest: int,
    upstream: int = 2000,
    downstream: int = 500,
    nearest_max: int | None = None,
    decay_max: int | None = None,
    decay_length: float = 50_000.0,
    max_genes: int = 5,
) -> DataFrame:
    """Pairs of a distinct span and a gene that are linked, each side shuffled once.

    ``payload`` are the aggregates of a span's features. A pair has
    ``in_promoter`` (the span meets any promoter), ``promoter_overlap`` (it meets
    this gene's), ``nearest_tss`` and ``distance_decay`` (with ``decay_weight``),
    as in ``promoter_links``, ``nearest_links`` and ``decay_links``; a distance of
    None leaves that link out. No span may be longer than ``longest``.

    A feature belongs to the stretch of positions that holds its centre, a gene
    to every stretch that its links reach into, so pairs, flags and ranks are
    formed where the rows are.
    """
    reach = max(nearest_max or 0, decay_max or 0, longest // 2 + max(upstream, downstream, 0) + 2, 1)
    at = lambda c: F.floor(c / F.lit(float(STRETCH * reach))).cast("long")
    place, span = ["chrom", "_stretch"], ["chrom", "_stretch", "start", "end"]
    centre = F.floor((F.col("start") + F.col("end")) / 2).cast("long")
    spans = features.withColumn("_stretch", at(centre)).repartition(*place).groupBy(*span).agg(*payload)
    spans = spans.withColumn("centre", centre)
    tss = F.col("tss").cast("long")
    reached = F.explode(F.sequence(at(tss - reach), at(tss + reach)))
    g = genes.select("chrom", tss.alias("tss"), "strand", "gene_id", "gene_ordinal", reached.alias("_stretch")).repartition(*place)
    # Genes of one position are equally far from any centre: only the first names, and the first and last of the file, can be linked by distance.
    here = Window.partitionBy(*place, "tss")
    ordinal = F.col("gene_ordinal")
    g = g.withColumn("_name", F.row_number().over(here.orderBy(F.col("gene_id").asc())) <= max_genes)
    g = g.withColumn("_first", F.row_number().over(here.orderBy(ordinal.asc_nulls_last())) == 1).withColumn("_last", F.row_number().over(here.orderBy(ordinal.desc_nulls_last())) == 1)
    g = promoters(g, upstream, downstream)
    d, after = F.abs(F.col("centre") - F.col("tss")), F.col("tss") >= F.col("centre")
    never = F.lit(False)
    weight = F.exp(-d.cast("double") / F.lit(float(decay_length))) if decay_length > 0 else F.lit(0.0)
    pairs = spans.join(g, place).select(
        *spans.columns, "gene_id", ((F.col("start") < F.col("r_end")) & (F.col("r_start") < F.col("end"))).alias("promoter_overlap"),
        (never if decay_max is None else F.col("_name") & (d <= decay_max)).alias("_may"), weight.alias("decay_weight"),
        (F.when(F.lit(False), F.lit(0)) if nearest_max is None else F.when((d <= nearest_max) & F.when(after, F.col("_first")).otherwise(F.col("_last")), 2 * d + F.when(after, 0).otherwise(1))).cast("long").alias("_far"),
    ).filter(F.col("promoter_overlap") | F.col("_may") | F.col("_far").isNotNull())
    w = Window.partitionBy(*span)
    rank = F.row_number().over(w.orderBy(F.col("_may").desc(), F.col("decay_weight").desc(), F.col("gene_id").asc()))
    ranked = pairs if decay_max is None else pairs.withColumn("_rank", rank)
    ranked = ranked.withColumn("in_promoter", F.max("promoter_overlap").over(w)).withColumn("_least", F.min("_far").over(w))
    return ranked.withColumn("distance_decay", never if decay_max is None else F.col("_may") & (F.col("_rank") <= max_genes)).withColumn(
        "nearest_tss", F.coalesce(F.col("_far") == F.col("_least"), never)).drop("_may", "_far", "_rank", "_least", "_stretch")


def segment_gene_overlaps(
    segments: DataFrame, genes: DataFrame, on: Sequence[str] = ("chrom",), start: str = "start", end: str = "end"
) -> DataFrame:
    """Distinct segment span x gene body with ``overlap_fraction`` of the gene and genes per span."""
    on = list(on)
    bodies = genes.select(*on, F.col("gene_start").alias("r_start"), F.col("gene_end").alias("r_end"), "gene_id")
    bodies = bodies.filter("r_end > r_start")
    pairs = overlap_pairs(_distinct_spans(segments, on, start, end), bodies, on)
    shared = F.least("l_end", "r_end") - F.greatest("l_start", "r_start")
    links = pairs.select(
        *on,
        F.col("l_start").alias(start),
        F.col("l_end").alias(end),
        "gene_id",
        (shared / (F.col("r_end") - F.col("r_start"))).alias("overlap_fraction"),
    )
    per = links.groupBy(*on, start, end).agg(F.count("*").alias("n_genes"))
    return links.join(per, [*on, start, end])
