"""Quality control of cells and genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cellgrain.model import need, ratio
from cellgrain.operators.quantiles import exact
from cellgrain.sources.layers import checkpoint

TOP = (50, 100, 200, 500)


def gene_flags(genes: DataFrame, name: str = "gene_id") -> DataFrame:
    """``mito``: the name starts with MT-; ``ribo``: it starts with RPS or RPL. Both by case."""
    need(genes, name)
    text = F.col(name).cast("string")
    return genes.withColumns({"mito": F.coalesce(text.startswith("MT-"), F.lit(False)), "ribo": F.coalesce(text.rlike("^RP[SL]"), F.lit(False))})


def cell_metrics(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One row a cell: detected genes, total, mito and ribo totals and percentages (null without counts). ``genes``
    has the flags. Cells without counts have zeros."""
    flags = genes.select("gene_id", "mito", "ribo")
    agg = expr.where("value <> 0").join(flags, "gene_id", "left").groupBy("cell_id").agg(
        F.count("*").alias("n_genes_by_counts"),
        F.sum("value").alias("total_counts"),
        F.sum(F.when(F.col("mito"), F.col("value")).otherwise(0.0)).alias("total_counts_mito"),
        F.sum(F.when(F.col("ribo"), F.col("value")).otherwise(0.0)).alias("total_counts_ribo"),
    )
    out = cells.select("cell_id").join(agg, "cell_id", "left").fillna(0)
    total = F.col("total_counts")
    return out.withColumns({f"pct_counts_{k}": 100 * ratio(F.col(f"total_counts_{k}"), total) for k in ("mito", "ribo")})


def top_share(expr: DataFrame, cells: DataFrame, top: tuple[int, ...] = TOP) -> DataFrame:
    """Per cell the percentage of counts in its n strongest genes, for each n. Null without counts."""
    w = Window.partitionBy("cell_id").orderBy(F.desc("value"), "gene_id")
    ranked = expr.where("value <> 0").withColumn("rank", F.row_number().over(w))
    total = F.sum("value")
    agg = ranked.groupBy("cell_id").agg(*((100 * F.sum(F.when(F.col("rank") <= n, F.col("value")).otherwise(0.0)) / total).alias(f"pct_counts_in_top_{n}_genes") for n in top))
    return cells.select("cell_id").join(agg, "cell_id", "left")


def gene_metrics(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """One row a gene: cells that have it, total, mean over all cells and percentage of cells without it."""
    n = cells.agg(F.count("*").alias("n_cells"))
    agg = expr.where("value <> 0").groupBy("gene_id").agg(F.count("*").alias("n_cells_by_counts"), F.sum("value").alias("total_counts"))
    out = genes.select("gene_id").join(agg, "gene_id", "left").fillna(0).crossJoin(F.broadcast(n))  # one row
    return out.select("gene_id", "n_cells_by_counts", "total_counts", ratio(F.col("total_counts"), F.col("n_cells")).alias("mean_counts"), (100 - 100 * ratio(F.col("n_cells_by_counts"), F.col("n_cells"))).alias("pct_dropout_by_counts"))


def passes(min_genes: int = 200, max_genes: int = 6000, min_umi: float = 500, max_mito: float = 20, max_ribo: float = 50) -> Column:
    """The cell predicate, all bounds inclusive. A cell without counts has no percentage and fails."""
    x = F.col("n_genes_by_counts").between(min_genes, max_genes) & (F.col("total_counts") >= min_umi)
    return F.coalesce(x & (F.col("pct_counts_mito") <= max_mito) & (F.col("pct_counts_ribo") <= max_ribo), F.lit(False))


def filter_cells(metrics: DataFrame, **bounds) -> DataFrame:
    """The rows of cell_metrics() that pass. ``min_umis_per_cell`` is another name of ``min_umi``."""
    if "min_umis_per_cell" in bounds:
        bounds["min_umi"] = bounds.pop("min_umis_per_cell")
    return metrics.where(passes(**bounds))


def filter_genes(metrics: DataFrame, min_cells: int = 10) -> DataFrame:
    """The rows of gene_metrics() with enough cells. The metrics are those of all cells, before filter_cells()."""
    return metrics.where(F.col("n_cells_by_counts") >= min_cells)


def restrict(expr: DataFrame, cells: DataFrame | None = None, genes: DataFrame | None = None) -> DataFrame:
    """The counts of the given cells and genes."""
    if cells is not None:
        expr = expr.join(cells.select("cell_id"), "cell_id", "left_semi")
    return expr if genes is None else expr.join(genes.select("gene_id"), "gene_id", "left_semi")


def report(metrics: DataFrame, genes: DataFrame, min_cells: int = 10, **bounds) -> DataFrame:
    """One row: cells and genes before and after, percentages removed, means over the cells kept."""
    ok = passes(**bounds)
    kept = lambda c: F.avg(F.when(ok, F.col(c)))
    cell = metrics.agg(F.count("*").alias("n_cells_before"), F.count_if(ok).alias("n_cells_after"), kept("n_genes_by_counts").alias("mean_genes_per_cell"), kept("total_counts").alias("mean_counts_per_cell"), kept("pct_counts_mito").alias("mean_pct_mito"), kept("pct_counts_ribo").alias("mean_pct_ribo"))
    gene = genes.agg(F.count("*").alias("n_genes_before"), F.count_if(F.col("n_cells_by_counts") >= min_cells).alias("n_genes_after"))
    removed = lambda k: (100 * (1 - ratio(F.col(f"n_{k}_after"), F.col(f"n_{k}_before")))).alias(f"pct_{k}_removed")
    return cell.crossJoin(gene).select("*", removed("cells"), removed("genes"))


def outliers(metrics: DataFrame, column: str, n_mads: float = 5.0, method: str = "mad") -> DataFrame:
    """Adds ``is_outlier``: beyond n_mads median absolute deviations of the median, or beyond 1.5 interquartile ranges
    of the quartiles (``iqr``). Medians are exact and interpolated."""
    x = F.col(column)
    if method == "mad":
        metrics = checkpoint(metrics)
        near = metrics.crossJoin(F.broadcast(exact(metrics, {"_mid": (column, 0.5)})))  # one row
        mad = exact(near.select(F.abs(x - F.col("_mid")).alias("_far")), {"_mad": ("_far", 0.5)})
        flagged = near.crossJoin(F.broadcast(mad)).withColumn("is_outlier", F.abs(x - F.col("_mid")) > n_mads * F.col("_mad"))
        return flagged.drop("_mid", "_mad")
    if method != "iqr":
        raise ValueError(f"method {method!r} is neither 'mad' nor 'iqr'")
    metrics = checkpoint(metrics)
    q = exact(metrics, {"_q1": (column, 0.25), "_q3": (column, 0.75)})
    span = 1.5 * (F.col("_q3") - F.col("_q1"))
    return metrics.crossJoin(F.broadcast(q)).withColumn("is_outlier", (x < F.col("_q1") - span) | (x > F.col("_q3") + span)).drop("_q1", "_q3")


def dataset_summary(cells: DataFrame, dataset: str = "dataset", cell_type: str = "cell_type") -> DataFrame:
    """A row a dataset: cells, medians of detected genes, counts and mitochondrial percentage, and cell types, of
    cells with the columns of cell_metrics()."""
    cells = checkpoint(cells.select(dataset, cell_type, "n_genes_by_counts", "total_counts", "pct_counts_mito"))
    medians = exact(cells, {"median_genes": ("n_genes_by_counts", 0.5), "median_counts": ("total_counts", 0.5), "median_pct_mito": ("pct_counts_mito", 0.5)}, [dataset])
    counts = cells.groupBy(dataset).agg(F.count("*").alias("n_cells"), F.count_distinct(cell_type).alias("n_cell_types"))
    joined = counts.join(medians.withColumnRenamed(dataset, "_d"), F.col(dataset).eqNullSafe(F.col("_d")))
    return joined.select(dataset, "n_cells", "median_genes", "median_counts", "median_pct_mito", "n_cell_types")


def mask(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition, and all others; unknown counts as not met."""
    known = F.coalesce(condition, F.lit(False))
    return df.where(known), df.where(~known)
