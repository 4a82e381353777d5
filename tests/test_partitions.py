"""Shuffles start with partitions in proportion to the input."""

import pytest
from pyspark.sql import functions as F

from lociweave.catalog import tables
from lociweave.session import stored_bytes


@pytest.fixture
def initial(spark):
    names = (tables.INITIAL, *tables.PORTIONS)
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.unset(n)
    yield
    for n in names:
        spark.conf.unset(n)
        if before[n]:
            spark.conf.set(n, before[n])


def test_partitions_follow_the_size_of_the_table(spark, tmp_path, monkeypatch, initial):
    spark.range(20_000).select("id", F.xxhash64("id").alias("h")).write.parquet(f"{tmp_path}/rows.parquet")
    size = stored_bytes(spark, f"{tmp_path}/rows.parquet")
    monkeypatch.setattr(tables, "PARTITION_BYTES", size // 10)
    tables.table(spark, str(tmp_path), "rows")
    assert 10 <= int(spark.conf.get(tables.INITIAL)) <= 11


def test_partitions_never_become_fewer(spark, initial):
    tables.enough_partitions(spark, 1)
    assert spark.conf.get(tables.INITIAL, None) is None
    tables.enough_partitions(spark, 100 * tables.PARTITION_BYTES)
    tables.enough_partitions(spark, 50 * tables.PARTITION_BYTES)
    assert spark.conf.get(tables.INITIAL) == "100"


def test_small_inputs_leave_the_session_and_its_own_choice_stays(spark, initial):
    read, joined = tables.PORTIONS
    tables.enough_partitions(spark, 1)
    assert spark.conf.get(read, None) is None and spark.conf.get(joined, None) is None
    spark.conf.set(joined, "1000000")
    tables.enough_partitions(spark, 100 * tables.PARTITION_BYTES)
    assert spark.conf.get(joined) == "1000000" and int(spark.conf.get(read)) == tables.PORTIONS[read]
