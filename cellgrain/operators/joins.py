"""Joins with lookup tables of unknown size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cellgrain.sources.layers import checkpoint

#: Rows of a lookup table that may be broadcast; beyond them a shuffle deals every key over SALT tasks.
BROADCAST_ROWS, SALT = 100_000, 24


def lookup(left: DataFrame, right: DataFrame, keys: list[str], salt_by: list[str], how: str = "left", rows: int | None = None) -> DataFrame:
    """Joins a table with unique keys, none null. Its rows are counted first: few are broadcast, many are shuffled by
    key and salt (a hash of the columns ``salt_by`` of the left side), so that no task gets all rows of a hot key. A
    caller that knows a bound of its ``rows`` spares the count."""
    if rows is None:
        right = checkpoint(right)
        rows = right.count()
    if rows <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    # Spark's estimate of a size leaves out what explode() adds, so without the hint it may broadcast SALT copies of a large table.
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))).hint("merge")
    return left.withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.lit(SALT)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def numbered(df: DataFrame, order: list[str], out: str = "at") -> DataFrame:
    """Adds a row's number, from 0, in the order of some columns: rows are range-partitioned, numbered in their partition,
    and the sizes of the partitions before it (a row each at the driver) are added."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpoint(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    base, before = [], 0
    for r in sorted(ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        base.append((r["_part"], before))
        before += r["n"]
    starts = spark.createDataFrame(base, "_part int, _start long")
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_k", inner).join(F.broadcast(starts), "_part").withColumn(out, F.col("_start") + F.col("_k")).drop("_part", "_start", "_k")
