"""Scratch tables: removed on request and with their application, never outside a shared folder on a cluster."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from lociweave import session


def test_discard_removes_only_written_tables(spark, tmp_path):
    kept, gone = (session.materialize(spark.range(10)) for _ in range(2))
    folder = gone.inputFiles()[0].rpartition("/")[0].removeprefix("file:").replace("//", "/")
    session.discard(gone)
    assert not os.path.exists(folder) and kept.count() == 10
    spark.range(3).write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError):
        session.discard(spark.read.parquet(f"{tmp_path}/own"))


def test_scratch_folder_is_empty_after_the_application(tmp_path):
    code = (
        "from pyspark.sql import SparkSession\nfrom lociweave.session import materialize\n"
        f"s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', 'file://{tmp_path}/shared').getOrCreate()\n"
        "assert materialize(s.range(5)).count() == 5\ns.stop()\n"
    )
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    subprocess.run([sys.executable, "-c", code], check=True, env=env, timeout=120)
    assert not list(Path(tmp_path).glob("shared/lociweave/*"))


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "local-cluster[2,1,1024]"
        applicationId = "a"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError):
        session.scratch_root(Session())
