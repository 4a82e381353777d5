"""Shared pieces: opening tables, mapping whole texts as UTF-8 bytes, bounded slices of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one step of a task holds as Python or numpy values, unless a single text is longer.
SLICE_BYTES = 1 << 20

LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def body(name: str = "text") -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    return F.coalesce(col(name).cast("binary"), F.lit(bytearray()))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold at most ``limit`` bytes, or one row each."""
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    fields: str,
    compute: Callable[[list[bytes]], dict],
) -> DataFrame:
    """Columns ``row`` (a struct of ``keep``) and ``res`` (a struct of ``fields``), one row per row of ``df``.

    ``compute`` gets the whole texts of some rows as bytes and returns a list
    per field. The kept columns travel inside one struct, so their names can't
    clash with the results'. Row-wise: rows that repeat are judged alike.
    """
    packed = df.select(F.struct(*[col(c) for c in keep]).alias("row"), body(text).alias("body"))
    result = T._parse_datatype_string(fields)
    schema = T.StructType([packed.schema["row"], T.StructField("res", result)])
    inner = pa.struct([(f.name, _arrow(f.dataType)) for f in result.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "body"):
                found = compute(part.column("body").to_pylist())
                arrays = [pa.array(found[f.name], f.type) for f in inner]
                res = pa.StructArray.from_arrays(arrays, fields=list(inner))
                yield pa.RecordBatch.from_arrays([part.column("row"), res], names=["row", "res"])

    return packed.mapInArrow(run, schema)


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def unpack(mapped: DataFrame, *fields: str) -> DataFrame:
    """Kept columns followed by the named result columns (all of them without names)."""
    names = fields or mapped.schema["res"].dataType.names
    kept = mapped.schema["row"].dataType.names
    return mapped.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col("res").getField(c).alias(c) for c in names])
