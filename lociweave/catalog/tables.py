"""Views of the star-schema tables in the roles the operators expect."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.session import stored_bytes

#: Bytes of a table's files for each shuffle partition; rows that are read, joined and widened take several times as many.
PARTITION_BYTES = 4 << 20
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: A large input is read and joined together in portions of so many bytes, unless the session says otherwise: rows that a
#: task gets from the defaults (128 and 64 MB) can need several GB once a join has widened them and a sort holds them.
PORTIONS = {"spark.sql.files.maxPartitionBytes": 8 << 20, "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20}


_OPENED: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Open a table once per application: reading a footer for the schema is a job of its own."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/{name}.parquet")
    if key not in _OPENED:
        _OPENED[key] = spark.read.parquet(key[1])
    enough_partitions(spark, stored_bytes(spark, key[1]))
    return _OPENED[key]


def enough_partitions(spark: SparkSession, size: int) -> None:
    """Let shuffles begin with partitions in proportion to an input of ``size`` bytes, never with fewer than before.

    Adaptive execution joins small partitions again, but can't cut a large one
    before a sort, a window or an aggregate: with a fixed number the memory of
    one task grows with the input.
    """
    now = int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(size / PARTITION_BYTES)
    if wanted > now:
        spark.conf.set(INITIAL, str(wanted))
        for name, portion in PORTIONS.items():
            if spark.conf.get(name, None) is None:
                spark.conf.set(name, str(portion))


def day(ts: str) -> Column:
    """Whole days since 1970-01-01."""
    return F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")).cast("long")


def r6(c, digits: int = 6) -> Column:
    """Rounded for comparison; adding zero folds -0.0 into 0.0."""
    return (F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)).cast("double")


# SQL fragment matching ``day``.
DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({0} AS DATE)) AS BIGINT)"


def sql_day(column: str) -> str:
    return DAY.format(column)


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as weighted intervals: group = supplier, start = ship day, length = quantity."""
    li = table(spark, sf_dir, "lineitem")
    start = day("l_shipdate")
    return li.select(
        F.col("l_suppkey").alias("chrom"),
        start.alias("start"),
        (start + F.col("l_quantity").cast("long")).alias("end"),
        F.col("l_extendedprice").alias("weight"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_returnflag").alias("flag"),
    )


FEATURES_SQL = f"""features AS (
  SELECT l_suppkey AS chrom, {sql_day('l_shipdate')} AS "start",
         {sql_day('l_shipdate')} + CAST(l_quantity AS BIGINT) AS "end", l_extendedprice AS weight,
         l_orderkey AS order_id, l_partkey AS part_id, l_linenumber AS line_no, l_returnflag AS flag
  FROM lineitem)"""


def n_suppliers(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "supplier").agg(F.count("*").alias("n")).scalar()


def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as genes: group = customer spread over as many groups as suppliers, position = order day."""
    o = table(spark, sf_dir, "orders")
    n = n_suppliers(spark, sf_dir)
    return o.select(
        (F.col("o_custkey") % n).alias("chrom"),
        day("o_orderdate").alias("tss"),
        F.col("o_orderkey").cast("string").alias("gene_id"),
        F.col("o_orderkey").alias("gene_ordinal"),
        F.when(F.col("o_orderstatus") == "F", "-").otherwise("+").alias("strand"),
        F.col("o_orderpriority").alias("program"),
        F.col("o_totalprice").alias("price"),
    )


ANCHORS_SQL = f"""anchors AS (
  SELECT o_custkey % (SELECT count(*) FROM supplier) AS chrom, {sql_day('o_orderdate')} AS tss,
         CAST(o_orderkey AS VARCHAR) AS gene_id, o_orderkey AS gene_ordinal,
         CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '+' END AS strand,
         o_orderpriority AS program, o_totalprice AS price
  FROM orders)"""


def part_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined to the brand and type of their part."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    li = table(spark, sf_dir, "lineitem")
    return li.join(p, li["l_partkey"] == p["p_partkey"])
