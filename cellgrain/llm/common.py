"""Helpers shared by the training-data operators: safe lineage cuts, checked broadcasts, prefix sums."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Rows of a lookup table that may be broadcast. Beyond it the join is a salted shuffle.
BROADCAST_ROWS = 100_000
#: Buckets over which a shuffle join deals out one key.
SALT = 24
#: The contract's word class as a Java regular expression: anything but ASCII white space.
SPACE = "[\\x20\\x09-\\x0D]+"


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """Python's search for reference cycles is off: it would walk lists of millions of words, which hold none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one made for this session on a local master, else an
    error: executors don't see each other's disks."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cellgrain-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later jobs read it from the shared folder, whichever executors are left."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """As cut(), as compressed Parquet: for wide rows."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(left: DataFrame, right: DataFrame, keys: list[str], salt_by: Column, how: str = "left") -> DataFrame:
    """Joins a lookup with unique keys. Its rows are counted: up to BROADCAST_ROWS it is broadcast, else
    both sides are shuffled by key and salt, so that one hot key is dealt over SALT tasks. No key may be null."""
    right = cut(right)
    if right.count() <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    salted = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return left.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(SALT)).cast("int")).join(salted, [*keys, "_salt"], how).drop("_salt")


def prefix_sums(df: DataFrame, order: list[str], size: str, out: str = "start", also: str | None = None) -> tuple[DataFrame, int]:
    """Adds ``out``, the sum of ``size`` over all rows before this one in the order of ``order``, and ``also``, the
    number of those rows; returns the total, too. Rows are range-partitioned and checkpointed; the partitions' totals
    are summed on their own (one row each), and a running sum inside each partition is added."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(F.sum(size).alias("_size"), F.count("*").alias("_rows")).collect()  # a row a partition
    base, before, rows = [], 0, 0
    for r in sorted(totals, key=lambda r: r["_part"]):
        base.append((r["_part"], before, rows))
        before, rows = before + int(r["_size"] or 0), rows + r["_rows"]
    starts = spark.createDataFrame(base, "_part int, _before long, _rows long")
    inner = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumns({"_run": F.coalesce(F.sum(size).over(inner), F.lit(0)), "_n": F.count(F.lit(1)).over(inner)})
    joined = summed.join(F.broadcast(starts), "_part").withColumn(out, (F.col("_before") + F.col("_run")).cast("long"))
    if also:
        joined = joined.withColumn(also, F.col("_rows") + F.col("_n"))
    return joined.drop("_part", "_before", "_rows", "_run", "_n"), before


def parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
