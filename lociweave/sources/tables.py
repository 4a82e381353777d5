"""Generic delimited-table reading and column-role resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.functions import scalars as S


def _place() -> Column:
    """Orderable place of a row in its file(s); no global numbering job is needed."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_table(spark: SparkSession, path: str | Sequence[str], sep: str = "\t", comment: str | None = None) -> DataFrame:
    """Delimited file with header, all columns as text, plus ``row_ordinal`` in file order. Gzip by suffix."""
    opts = {"sep": sep, "header": True, "inferSchema": False, "quote": '"'}
    if comment:
        opts["comment"] = comment
    df = spark.read.options(**opts).csv(path)
    return df.select("*", _place().alias("row_ordinal"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", _place().alias("row_ordinal"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with a dense 0-based number, for formats whose rows are referred to by position."""
    from lociweave.operators.sliced import ranked

    r = ranked(read_lines(spark, path), [], [F.col("row_ordinal").asc()], "_n")
    return r.select("value", (F.col("_n") - 1).alias("index"))


def resolve_column(
    columns: Sequence[str], role: str, candidates: Sequence[str], explicit: str | None = None, required: bool = False,
    ignore_case: bool = False,
) -> str | None:
    """An explicit name must exist; else the first candidate present; else an error when required.

    With ``ignore_case`` a role matching several spellings of one candidate is an error.
    """
    same = (lambda a, b: a.lower() == b.lower()) if ignore_case else (lambda a, b: a == b)
    if explicit:
        hit = [c for c in columns if same(c, explicit)]
        if not hit:
            raise ValueError(f"column {explicit!r} for {role} not found")
        return hit[0]
    for cand in candidates:
        hit = [c for c in columns if same(c, cand)]
        if len(hit) > 1:
            raise ValueError(f"ambiguous columns for {role}: {hit}")
        if hit:
            return hit[0]
    if required:
        raise ValueError(f"no column for {role}; tried {list(candidates)}")
    return None


def resolve_columns(
    columns: Sequence[str], spec: Mapping[str, Sequence[str]], explicit: Mapping[str, str] | None = None, required: Sequence[str] = (),
    ignore_case: bool = False,
) -> dict[str, str]:
    given = explicit or {}
    found = {r: resolve_column(columns, r, c, given.get(r), r in required, ignore_case) for r, c in spec.items()}
    return {r: c for r, c in found.items() if c is not None}


def select_roles(df: DataFrame, roles: Mapping[str, str], numeric: Sequence[str] = (), missing: Sequence[str] = S.MISSING_DE,
                 keep: Sequence[str] = ("row_ordinal",)) -> DataFrame:
    """Project roles to their names; numeric roles are soft-parsed, text is trimmed with blank as null."""
    quoted = lambda c: F.col(f"`{c}`")
    cols = [(S.soft_double(quoted(c), missing) if r in numeric else S.clean(quoted(c))).alias(r) for r, c in roles.items()]
    return df.select(*cols, *[k for k in keep if k in df.columns])


def parseable(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Which columns hold at least one number: one aggregate row."""
    if not columns:
        return {}
    row = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in columns]).first()
    return {c: bool(row[c]) for c in columns}


def unpivot_numeric(df: DataFrame, ids: Sequence[str], name: str, value: str = "value", exclude: Sequence[str] = ("row_ordinal",),
                    missing: Sequence[str] = S.MISSING_DE) -> DataFrame:
    """Wide measurement columns to long rows; empty cells drop out."""
    skip = {*ids, *exclude}
    cols = [c for c in df.columns if c not in skip]
    typed = df.select(*[f"`{i}`" for i in ids], *[S.soft_double(F.col(f"`{c}`"), missing).alias(c) for c in cols])
    return typed.unpivot([F.col(f"`{i}`") for i in ids], [F.col(f"`{c}`") for c in cols], name, value).filter(F.col(value).isNotNull())


def union_sources(spark: SparkSession, manifest: Sequence[tuple[str, str]], reader=read_table) -> DataFrame:
    """Tables of a (path, source_dataset) manifest, unioned by name with their source columns."""
    parts = [
        reader(spark, path).withColumn("source_path", F.lit(path)).withColumn("source_dataset", F.lit(ds)) for path, ds in manifest
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def last_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each key in file order."""
    rest = [c for c in df.columns if c not in keys and c != "row_ordinal"]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "row_ordinal").alias("_r")).select(*keys, "_r.*")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    if not df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError(f"duplicate {what}")
    return df
