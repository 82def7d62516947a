"""Layered storage: raw, standardized and analysis-ready tables as Parquet; catalogue and sizes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

LAYERS = ("raw", "standardized", "analysis_ready")


def shared(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one of this session's on a local master, else an error:
    executors don't see each other's disks."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cellgrain-"))
    return (spark.conf.get("spark.checkpoint.dir", None) or context._jsc.sc().getCheckpointDir().get()).rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, by: str | None = None, plain: bool = False) -> DataFrame:
    """As checkpoint(), as a Parquet table of the shared folder. For loops with joins: a checkpoint keeps the estimate of its
    size, a join's estimate is a product, and its digits double from round to round until planning takes longer than the work.
    With ``by``, a folder a value of that column, so that a filter on it reads its rows only. ``plain`` is for bytes that no
    compression makes shorter."""
    path = f"{shared(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    out = df.write.partitionBy(by) if by else df.write
    (out.options(**{"compression": "none", "parquet.enable.dictionary": "false"}) if plain else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def location(root: str, layer: str, name: str = "") -> str:
    if layer not in LAYERS:
        raise ValueError(f"layer {layer!r} is none of {LAYERS}")
    return "/".join(x for x in (root.rstrip("/"), layer, name) if x)


def write(tables: dict[str, DataFrame], root: str, layer: str, name: str, compression: str = "gzip", mode: str = "overwrite", max_rows: int = 0) -> None:
    """Writes expr, cells, genes and so on below root/layer/name. ``max_rows`` bounds the rows of a file (0: none)."""
    for part, df in tables.items():
        text = [c for c, t in df.dtypes if t == "void"]
        df.withColumns({c: F.col(c).cast("string") for c in text}).write.mode(mode).option("compression", compression).option("maxRecordsPerFile", max_rows).parquet(f"{location(root, layer, name)}/{part}")


def read(spark: SparkSession, root: str, layer: str, name: str, part: str = "expr") -> DataFrame:
    """Lazy; a missing table raises when the plan is made."""
    return spark.read.parquet(f"{location(root, layer, name)}/{part}")


def files(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """path, length of all data files, without their contents."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(location(root, layer))
    return found.select("path", "length")


def available(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Names of the layer's datasets."""
    return files(spark, root, layer).select(F.regexp_extract("path", f"/{layer}/([^/]+)/", 1).alias("dataset")).distinct().orderBy("dataset")


def storage_info(spark: SparkSession, root: str, layer: str) -> DataFrame:
    return files(spark, root, layer).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).withColumn("gb", F.round(F.col("bytes") / 2**30, 2))


def write_text(df: DataFrame, path: str, kind: str = "csv", mode: str = "overwrite") -> None:
    """Leaderboards and logs as CSV or JSON."""
    if kind == "csv":
        df.write.mode(mode).option("header", True).csv(path)
    elif kind == "json":
        df.write.mode(mode).json(path)
    else:
        raise ValueError(f"kind {kind!r} is neither 'csv' nor 'json'")
