"""The preprocessing pipeline: quality control, ambient correction, normalisation, variable genes, metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.functions import metadata
from cellgrain.operators import ambient, doublets, normalize, qc
from cellgrain.sources.layers import stored


def run(expr: DataFrame, cells: DataFrame, genes: DataFrame, bounds: dict, min_cells: int = 10, doublet_column: str | None = None, doublet_rate: float | None = None, ambient_method: str | None = "soupx", normalization: str = "log", n_hvg: int = 2000, flavor: str = "seurat_v3", hvg_on: str = "counts", report_only: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables counts, expr, cells and genes after all steps, and a one-row report. Doublet calls are taken from
    ``doublet_column`` where given, or are the ``doublet_rate`` highest scores of simulated doublets on the n_hvg most variable
    genes; ``ambient_method`` None leaves that step out. Kept cells and genes, the counts without doublets and the corrected
    counts are stored as tables, since several later steps read each. ``hvg_on`` "values" ranks genes by the normalised values with
    every flavour, as published runs of seurat_v3 did. ``report_only`` leaves out the tables and what only they need."""
    steps = ["qc"]
    expr = stored(expr)
    before = qc.cell_metrics(expr, cells, genes)
    kept_cells = stored(cells.join(qc.filter_cells(before, **bounds).select("cell_id"), "cell_id", "left_semi"))
    kept_genes = stored(genes.join(qc.filter_genes(qc.gene_metrics(expr, cells, genes), min_cells).select("gene_id"), "gene_id", "left_semi"))
    if doublet_column:
        kept_cells = doublets.consensus(kept_cells, doublet_column, None).where("not is_doublet").drop("is_doublet")
        steps.append("doublets")
    later = [*(["ambient"] if ambient_method else []), "normalize", "hvg", "batch"]
    if report_only and not doublet_rate:
        return {}, report(cells, genes, kept_cells, kept_genes, steps + later)
    counts = stored(qc.restrict(expr, kept_cells, kept_genes))
    if doublet_rate:
        best = normalize.select_hvgs(normalize.log_normalize(counts), kept_cells, kept_genes, n_hvg, "seurat").where("highly_variable")
        calls = doublets.scores(counts, kept_cells, stored(best.select("gene_id")), rate=doublet_rate).where("doublet")
        kept_cells = stored(kept_cells.join(calls.select("cell_id"), "cell_id", "left_anti"))
        counts = qc.restrict(counts, kept_cells)
        steps.append("doublets")
        if report_only:
            return {}, report(cells, genes, kept_cells, kept_genes, steps + later)
    if ambient_method:
        counts = stored(ambient.correct(counts, kept_cells, kept_genes, ambient_method))
    if normalization == "log":
        values = normalize.log_normalize(counts)
    elif normalization == "scran":
        values = normalize.scran_normalize(counts, kept_cells)
    elif normalization == "pearson_residuals":
        values = normalize.pearson_residuals(counts, kept_cells, kept_genes)
    else:
        raise ValueError(f"normalization {normalization!r} is unknown")
    if hvg_on not in ("counts", "values"):
        raise ValueError(f"hvg_on {hvg_on!r} is neither 'counts' nor 'values'")
    flags = normalize.select_hvgs(values if flavor == "seurat" or hvg_on == "values" else counts, kept_cells, kept_genes, n_hvg, flavor)
    out = {"counts": counts, "expr": values, "cells": metadata.annotate(kept_cells), "genes": kept_genes.join(flags.select("gene_id", "highly_variable"), "gene_id", "left")}
    return out, report(cells, genes, kept_cells, kept_genes, steps + later)


def report(cells: DataFrame, genes: DataFrame, kept_cells: DataFrame, kept_genes: DataFrame, steps: list[str]) -> DataFrame:
    n = lambda df, name: df.agg(F.count("*").alias(name))
    row = n(cells, "n_cells_before").crossJoin(n(kept_cells, "n_cells_after")).crossJoin(n(genes, "n_genes_before")).crossJoin(n(kept_genes, "n_genes_after"))  # one row each
    return row.withColumns({"pct_cells_retained": 100 * F.col("n_cells_after") / F.col("n_cells_before"), "steps": F.array(*(F.lit(s) for s in steps))})
