"""Readers of count files, and the joins that put datasets together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cellgrain.sources.layers import stored


def unique_names(genes: DataFrame, name: str = "gene_name", order: str = "ord") -> DataFrame:
    """Repeated names get -1, -2 and so on, in order."""
    k = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    return genes.withColumn("_k", k).withColumn(name, F.when(F.col("_k") > 0, F.concat_ws("-", name, F.col("_k").cast("string"))).otherwise(F.col(name))).drop("_k")


def numbered(files: DataFrame, out: str) -> DataFrame:
    """(sample_id, out, text): lines of whole files, numbered from 1 in each. Feature and barcode lists are small; as
    one row a file their numbers don't depend on how files are split."""
    text = F.regexp_replace("value", r"\s+$", "")
    return files.select("sample_id", F.posexplode(F.split(text, "\r?\n")).alias("_k", "text")).select("sample_id", (F.col("_k") + 1).alias(out), "text")


def assemble(matrix: DataFrame, barcodes: DataFrame, features: DataFrame) -> DataFrame:
    """put_together() of whole lists (sample_id, value), each of which a task holds."""
    return put_together(matrix, numbered(barcodes, "c"), numbered(features, "g"))


def listed(files: DataFrame, out: str, by: list[str]) -> DataFrame:
    """(sample_id, out, text) as numbered(), from lines (sample_id, _path, value, and more columns ``by``) that were read with \\n as
    separator: lists of any length, numbered from 1 in each value of ``by``, whose files follow in the order of their paths.

    A task reads a range of a file from front to back, so a line's number is its place in that range, and the ranges before it add their
    sizes, a row a range. The trailing blank of the last line that isn't blank is no part of it."""
    lines = files.withColumns({"_start": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id(), "text": F.regexp_replace("value", r"\r$", "")})
    lines = stored(lines.select(*dict.fromkeys(["sample_id", *by, "_path"]), "_start", "_id", "text"))
    ranges = lines.groupBy(*by, *({"_path"} - {*by}), "_start").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"), F.max(F.when(F.col("text").rlike(r"\S"), F.col("_id"))).alias("_last"))
    w = Window.partitionBy(*by).orderBy("_path", "_start")
    ranges = ranges.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).withColumn("_k", F.col("_before") + F.col("_last") - F.col("_first") + 1)
    ranges = ranges.withColumn("_end", F.max("_k").over(Window.partitionBy(*by))).select(*by, *({"_path"} - {*by}), "_start", "_first", "_before", "_end")
    k = F.col("_id") - F.col("_first") + F.col("_before") + 1
    found = lines.join(F.broadcast(ranges), [*dict.fromkeys([*by, "_path"]), "_start"]).withColumn(out, k)
    return found.select("sample_id", out, F.when(F.col(out) == F.col("_end"), F.regexp_replace("text", r"\s+$", "")).otherwise(F.col("text")).alias("text"))


def put_together(matrix: DataFrame, bars: DataFrame, feats: DataFrame) -> DataFrame:
    """(cell_id, gene_id, value) from lines of triplet files (sample_id, value) and numbered lists (sample_id, c or g, text). Cell
    ids get the sample's name in front; repeated gene names of a sample get a number. Comments and the line of sizes,
    whose count is that of all entries, are no entries; an entry that looks like the line of sizes comes beside it and stays."""
    part = F.split("value", r"\s+")
    m = matrix.where(~F.col("value").startswith("%")).select("sample_id", part[0].cast("int").alias("g"), part[1].cast("int").alias("c"), part[2].cast("double").alias("value"))
    sizes = m.groupBy("sample_id").agg(F.max("g").alias("_g"), F.max("c").alias("_c"), (F.count("*") - 1).alias("_n"))
    is_size = (F.col("g") == F.col("_g")) & (F.col("c") == F.col("_c")) & (F.col("value") == F.col("_n"))
    lines = m.join(F.broadcast(sizes), "sample_id").withColumn("_size", is_size)  # a row a sample
    twice = lines.where("_size").groupBy("sample_id", "g", "c", "value").agg(F.count("*").alias("_k")).where("_k > 1").drop("_k")
    entries = lines.where("not _size").select("sample_id", "g", "c", "value").unionByName(twice)
    bars = bars.withColumnRenamed("text", "barcode")
    feats = feats.select("sample_id", "g", F.split("text", "\t")[1].alias("gene_name"))
    k = F.row_number().over(Window.partitionBy("sample_id", "gene_name").orderBy("g")) - 1
    feats = feats.select("sample_id", "g", F.when(k > 0, F.concat_ws("-", "gene_name", k.cast("string"))).otherwise(F.col("gene_name")).alias("gene_id"))
    joined = entries.join(bars, ["sample_id", "c"]).join(feats, ["sample_id", "g"])
    return joined.select("sample_id", F.concat_ws("_", "sample_id", "barcode").alias("cell_id"), "gene_id", "value")


def triplets(spark: SparkSession, path: str) -> DataFrame:
    """assemble() of folders by sample with matrix.mtx, features.tsv and barcodes.tsv, packed or not."""
    sample = F.element_at(F.split(F.input_file_name(), "/"), -2).alias("sample_id")
    matrix = spark.read.text(path, recursiveFileLookup=True, pathGlobFilter="matrix.mtx*").select(sample, "value")
    lists = lambda name, out: listed(spark.read.text(path, lineSep="\n", recursiveFileLookup=True, pathGlobFilter=name).select(sample, F.input_file_name().alias("_path"), "value", "_metadata"), out, ["_path"])
    return put_together(matrix, lists("barcodes.tsv*", "c"), lists("features.tsv*", "g"))


def wide_matrix(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(cell_id, gene_id, value) of a delimited matrix with a header; the longer axis is the genes."""
    df = spark.read.csv(path, sep=sep, header=True)
    return unpivot_matrix(df)


def unpivot_matrix(df: DataFrame) -> DataFrame:
    name, *rest = df.columns
    typed = df.select(F.col(f"`{name}`").alias("_row"), *(F.col(f"`{c}`").cast("double").alias(c) for c in rest))
    long = typed.unpivot(["_row"], rest, "_column", "value").where("value <> 0")
    rows_are_genes = df.count() >= len(rest)
    cell, gene = ("_column", "_row") if rows_are_genes else ("_row", "_column")
    return long.select(F.col(cell).alias("cell_id"), F.col(gene).alias("gene_id"), "value")


def attach_clinical(cells: DataFrame, clinical: DataFrame, key: str = "sample_id") -> DataFrame:
    """Left join by sample name; without any common name the cells stay as they are."""
    shared = cells.select(key).join(clinical.select(key), key, "left_semi").limit(1)
    if not shared.head(1):
        return cells
    return cells.join(clinical, key, "left")


def concat_datasets(datasets: dict[str, DataFrame], tag: str = "dataset") -> DataFrame:
    """Union of all rows and all columns, tagged by name. Genes that a dataset lacks simply have no rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn(tag, F.lit(name)) for name, df in datasets.items()))


def series_metadata(samples: DataFrame, series: str = "series_id") -> DataFrame:
    """Per series the first organism that isn't blank, and the first sample's platform."""
    organism = F.when(F.trim("organism") != "", F.struct("ord", "organism"))
    return samples.groupBy(series).agg(F.count("*").alias("n_samples"), F.min(organism)["organism"].alias("organism"), F.min(F.struct("ord", "platform"))["platform"].alias("platform"))
