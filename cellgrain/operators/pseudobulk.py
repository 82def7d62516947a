"""Sums of expression by groups of cells, and cell fractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.model import need, ratio


def group_sizes(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of each group; cells with a null key belong to none."""
    return need(cells, *keys).dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n_cells"))


def aggregate(expr: DataFrame, cells: DataFrame, keys: list[str], min_cells: int = 0) -> DataFrame:
    """Group by gene sums in long form. A group without counts has no rows here but has its size in group_sizes()."""
    known = need(cells, "cell_id", *keys).dropna(subset=keys).select("cell_id", *keys)
    if min_cells:
        large = group_sizes(cells, keys).where(F.col("n_cells") >= min_cells)
        known = known.join(large.select(*keys), keys, "left_semi")
    return expr.join(known, "cell_id").groupBy(*keys, "gene_id").agg(F.sum("value").alias("value"))


def wide(expr: DataFrame, cells: DataFrame, keys: list[str], genes: list, with_sizes: bool = True) -> DataFrame:
    """A column a gene, for the listed genes; missing sums are 0. Keys come first, then n_cells."""
    sums = aggregate(expr.where(F.col("gene_id").isin(genes)), cells, keys)
    table = group_sizes(cells, keys).join(sums.groupBy(*keys).pivot("gene_id", genes).sum("value"), keys, "left").fillna(0)
    return table if with_sizes else table.drop("n_cells")


def fractions(cells: DataFrame, patient: str, cell_type: str) -> DataFrame:
    """Per patient the share of each of its cell types."""
    n = group_sizes(cells, [patient, cell_type])
    total = n.groupBy(patient).agg(F.sum("n_cells").alias("_all"))
    return n.join(total, patient).select(patient, cell_type, (F.col("n_cells") / F.col("_all")).alias("fraction"))


def fractions_wide(cells: DataFrame, patient: str, cell_type: str, types: list[str]) -> DataFrame:
    """A column a type, 0 where a patient has none."""
    return fractions(cells, patient, cell_type).groupBy(patient).pivot(cell_type, types).sum("fraction").fillna(0.0)


def subtotals(expr: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Group sums with all roll-ups of the keys."""
    return expr.join(cells.dropna(subset=keys).select("cell_id", *keys), "cell_id").rollup(*keys).agg(F.sum("value").alias("value"))


def share_of(df: DataFrame, key: str) -> DataFrame:
    """Counts of a key with their share of all rows."""
    n = df.groupBy(key).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all")))).select(key, "n", ratio(F.col("n"), F.col("_all")).alias("share"))
