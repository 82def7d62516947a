"""Correction of ambient signal. All steps map zero to zero, so they work on the stored counts only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.model import ratio
from cellgrain.operators.quantiles import exact
from cellgrain.sources.layers import checkpoint


def profile(expr: DataFrame) -> DataFrame:
    """Each gene's share of all counts."""
    gene = expr.groupBy("gene_id").agg(F.sum("value").alias("gene_total"))
    return gene.crossJoin(F.broadcast(gene.agg(F.sum("gene_total").alias("_all")))).select("gene_id", "gene_total", ratio(F.col("gene_total"), F.col("_all")).alias("share"))


def top_genes(shares: DataFrame, n: int = 100) -> DataFrame:
    """The n genes with most ambient signal; ties by gene."""
    return shares.orderBy(F.desc("share"), "gene_id").limit(n)


def soupx_fraction(expr: DataFrame, cells: DataFrame, n_top: int = 100, most: float = 0.9) -> DataFrame:
    """Per cell its total and ``rho``, the share of its counts in the top genes, at most ``most``; 0 without counts."""
    top = F.broadcast(top_genes(profile(expr), n_top).select("gene_id", F.lit(True).alias("_top")))  # n_top rows
    agg = expr.join(top, "gene_id", "left").groupBy("cell_id").agg(F.sum("value").alias("total"), F.sum(F.when(F.col("_top"), F.col("value")).otherwise(0.0)).alias("_in"))
    out = cells.select("cell_id").join(agg, "cell_id", "left").fillna(0)
    return out.select("cell_id", "total", F.least(F.coalesce(ratio(F.col("_in"), F.col("total")), F.lit(0.0)), F.lit(most)).alias("rho"))


def soupx_correct(expr: DataFrame, cells: DataFrame, n_top: int = 100) -> DataFrame:
    """Counts less the expected ambient ones, share * total * rho, not below 0. Zeros are not stored."""
    shares = profile(expr).select("gene_id", "share")
    value = F.greatest(F.col("value") - F.col("share") * F.col("total") * F.col("rho"), F.lit(0.0))
    joined = expr.join(shares, "gene_id").join(soupx_fraction(expr, cells, n_top), "cell_id")
    return joined.select("cell_id", "gene_id", value.alias("value")).where("value > 0")


def background_genes(expr: DataFrame, cells: DataFrame, genes: DataFrame, share: float = 0.25) -> DataFrame:
    """Genes whose mean over all cells is under the given quantile of all genes' means (interpolated; genes without
    counts take part)."""
    n = cells.agg(F.count("*").alias("_n"))
    mean = genes.select("gene_id").join(expr.groupBy("gene_id").agg(F.sum("value").alias("_sum")), "gene_id", "left").fillna(0).crossJoin(F.broadcast(n)).select("gene_id", (F.col("_sum") / F.col("_n")).alias("mean"))
    mean = checkpoint(mean)
    return mean.crossJoin(F.broadcast(exact(mean, {"_low": ("mean", share)}))).where("mean < _low").select("gene_id")


def decontx_score(expr: DataFrame, cells: DataFrame, genes: DataFrame, background: DataFrame | None = None) -> DataFrame:
    """Per cell the share of its counts in background genes (by default those of background_genes()), and the probability
    that such a count is real."""
    bg = (background_genes(expr, cells, genes) if background is None else background).withColumn("_bg", F.lit(True))
    agg = expr.join(bg, "gene_id", "left").groupBy("cell_id").agg(F.sum("value").alias("total"), F.sum(F.when(F.col("_bg"), F.col("value")).otherwise(0.0)).alias("_in"))
    score = F.coalesce(ratio(F.col("_in"), F.col("total")), F.lit(0.0))
    out = cells.select("cell_id").join(agg, "cell_id", "left").select("cell_id", score.alias("contamination_score"))
    return out.withColumn("native_prob", 1 - F.least(F.col("contamination_score"), F.lit(0.99)))


def decontx_correct(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Counts of background genes times the cell's probability; other counts as they are."""
    low = checkpoint(background_genes(expr, cells, genes))
    joined = expr.join(low.withColumn("_bg", F.lit(True)), "gene_id", "left").join(decontx_score(expr, cells, genes, low), "cell_id")
    return joined.select("cell_id", "gene_id", F.when(F.col("_bg"), F.col("value") * F.col("native_prob")).otherwise(F.col("value")).alias("value"))


def correct(expr: DataFrame, cells: DataFrame, genes: DataFrame, method: str = "soupx") -> DataFrame:
    if method == "soupx":
        return soupx_correct(expr, cells)
    if method == "decontx":
        return decontx_correct(expr, cells, genes)
    raise ValueError(f"method {method!r} is neither 'soupx' nor 'decontx'")
