"""Session helpers: where intermediate tables go, and how to write one."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_TEST_ROOT: dict[str, str] = {}
_OWNED: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, taken from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would lose the table with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _TEST_ROOT:
        _TEST_ROOT[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _TEST_ROOT[app]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    The written table cuts lineage, survives executor loss, and pins values
    that depend on physical placement (see ``operators.sliced``). Columnar
    files keep column pruning and row-count statistics for the readers.
    """
    return df.sparkSession.read.schema(df.schema).parquet(write_table(df))


def write_table(df: DataFrame) -> str:
    """Write ``df`` as Parquet under the shared scratch folder; returns the folder, for tasks that read it block by block."""
    path = f"{scratch_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def scratch_folder(spark: SparkSession) -> str:
    """Folder of this application under the scratch root; removed when the application ends."""
    app = spark.sparkContext.applicationId
    folder = f"{scratch_root(spark)}/lociweave/{app}"
    if folder not in _OWNED:
        store, path = _hadoop(spark, folder)
        store.mkdirs(path)
        store.deleteOnExit(path)
        _OWNED.add(folder)
    return folder


def discard(table: DataFrame) -> None:
    """Remove a table of ``materialize`` that no later step reads."""
    spark = table.sparkSession
    root = scratch_folder(spark).rpartition(":")[2].replace("//", "/")
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        if root not in folder.replace("//", "/"):
            raise ValueError("only tables written by materialize can be discarded")
        store, path = _hadoop(spark, folder)
        store.delete(path, True)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files of a table."""
    store, at = _hadoop(spark, path)
    return store.getContentSummary(at).getLength()


def _hadoop(spark: SparkSession, folder: str):
    """File system and path object of a folder, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path
