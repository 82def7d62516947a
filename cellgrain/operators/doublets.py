"""Doublet scores from simulated doublets and nearest neighbours, and their consensus."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.model import hash_int, hash_rank, need
from cellgrain.operators import embed, normalize, sparse_pca
from cellgrain.operators.joins import lookup, numbered
from cellgrain.operators.quantiles import exact
from cellgrain.sources.layers import checkpoint, stored

#: Most variable genes on which doublets are scored, as published.
GENES = 2000


def pairs(cells: DataFrame, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """cell_id, sim_id (``sim_`` and a number): two cells that are neighbours in a shuffled order, which is a range sort of
    digests. The last of an odd number of cells stays alone and is left out."""
    few = cells.select("cell_id").withColumn("_h", hash_rank("cell_id", seed=seed)).where((hash_int(F.concat(F.col("_h"), F.lit("r"))) % 10_000) < ratio * 10_000)
    rows = checkpoint(numbered(few, ["_h", "cell_id"]))
    return rows.where(F.col("at") < rows.count() // 2 * 2).select("cell_id", F.concat(F.lit("sim_"), F.floor(F.col("at") / 2).cast("string")).alias("sim_id"))


def selected(expr: DataFrame, genes: DataFrame) -> tuple[DataFrame, int]:
    """(cell_id, lib, few): the sum of all of a cell's counts, and its counts of the selected genes as a list of (at, value);
    and the number of these genes. A small row a cell, so the whole matrix is shuffled once."""
    order = checkpoint(numbered(genes.select("gene_id").distinct(), ["gene_id"]).withColumn("at", F.col("at").cast("int")))
    n = order.count()
    marked = lookup(expr, order, ["gene_id"], ["cell_id"], "left", rows=n)
    own = F.when(F.col("at").isNotNull(), F.struct("at", F.col("value").cast("double").alias("value")))
    return marked.groupBy("cell_id").agg(F.sum("value").cast("double").alias("lib"), F.collect_list(own).alias("few")), n


def simulated(rows: DataFrame, pair: DataFrame) -> DataFrame:
    """As ``rows`` (cell_id, lib, few), sums of two cells, where they have a selected gene."""
    both = rows.join(pair, "cell_id").groupBy("sim_id").agg(F.sum("lib").alias("lib"), F.flatten(F.collect_list("few")).alias("few")).where(F.size("few") > 0)
    by_gene = both.select("sim_id", "lib", F.explode("few").alias("e")).groupBy("sim_id", "lib", "e.at").agg(F.sum("e.value").alias("value"))
    return by_gene.groupBy("sim_id", "lib").agg(F.collect_list(F.struct("at", "value")).alias("few")).select(F.col("sim_id").alias("cell_id"), "lib", "few")


def logged(rows: DataFrame) -> DataFrame:
    """(cell_id, few): log-normalised values of the selected genes, as a list of (at, value), of ``rows`` (cell_id, lib, few) with any."""
    value = lambda v: F.log1p(F.coalesce(F.when(F.col("lib") != 0, v * 1e4 / F.col("lib")), v))
    return rows.where(F.size("few") > 0).select("cell_id", F.transform("few", lambda e: F.struct(e["at"].alias("at"), value(e["value"]).alias("value"))).alias("few"))


def profiles(rows: DataFrame, n: int) -> DataFrame:
    """(cell_id, vec): as logged(), all n selected genes in their order."""
    m = logged(rows).select("cell_id", F.map_from_entries("few").alias("m"))
    return m.select("cell_id", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("vec"))


def shares(expr: DataFrame, cells: DataFrame, genes: DataFrame, k: int = 15, n_pcs: int = 10, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """id (a text), simulated, share: of every real and simulated cell with counts of a selected gene, the part of simulated
    ones among its k nearest, in principal components of these genes. The cells' sums, their lists of selected genes' values (of
    cells with any) and the components are stored, since later steps read each several times; rows are never made dense."""
    rows, n = selected(expr, genes)
    rows = stored(rows)
    few = rows.where(F.size("few") > 0).withColumn("cell_id", F.col("cell_id").cast("string"))
    p = stored(logged(few.unionByName(simulated(rows, pairs(cells, ratio, seed)))))
    if not p.head(1):
        return p.select(F.col("cell_id").alias("id"), F.lit(False).alias("simulated"), F.lit(0.0).alias("share"))
    # Neighbours tie by id: the search takes twice an id's place among all, odd for simulated cells, since it sorts numbers faster than texts.
    ids = stored(numbered(p.select(F.col("cell_id").alias("id")), ["id"]).select("id", (2 * F.col("at") + F.col("id").startswith("sim_").cast("int")).alias("cell_id")))
    placed = p.withColumnRenamed("cell_id", "id").join(ids, "id").select("cell_id", "few")
    near = embed.knn(stored(sparse_pca.exact(stored(placed), n, n_pcs)[0]), k)
    share = near.groupBy(F.col("src").alias("cell_id")).agg(F.avg((F.col("dst") % 2).cast("double")).alias("share"))
    return ids.join(share, "cell_id").select("id", (F.col("cell_id") % 2 == 1).alias("simulated"), "share")


def real(cells: DataFrame, found: DataFrame, score: Column) -> DataFrame:
    """cell_id, score of all cells; 0 for those without neighbours."""
    own = found.where("NOT simulated").select("id", score.alias("score"))
    return cells.select("cell_id", F.col("cell_id").cast("string").alias("id")).join(own, "id", "left").select("cell_id", F.coalesce("score", F.lit(0.0)).alias("score"))


def scores(expr: DataFrame, cells: DataFrame, genes: DataFrame, k: int = 15, rate: float = 0.06, n_pcs: int = 10, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """cell_id, score: the share of simulated cells among the k nearest of real and simulated ones (in principal components of
    the selected genes), and ``doublet``: above the (1 - rate) quantile of all scores. Cells without counts of a selected gene have
    score 0."""
    out = checkpoint(real(cells, shares(expr, cells, genes, k, n_pcs, ratio, seed), F.col("share")))
    return out.crossJoin(F.broadcast(exact(out, {"_t": ("score", 1 - rate)}))).select("cell_id", "score", (F.col("score") > F.col("_t")).alias("doublet"))


def variable_genes(expr: DataFrame, cells: DataFrame, n_genes: int, min_counts: float = 0, min_cells: int = 0) -> DataFrame:
    """gene_id of the most variable genes, of those with at least ``min_counts`` counts in at least ``min_cells`` cells."""
    seen = expr.where(F.col("value") >= min_counts).groupBy("gene_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_cells).select("gene_id")
    x = stored(normalize.log_normalize(expr.join(seen, "gene_id", "left_semi")))
    return checkpoint(normalize.select_hvgs(x, cells, x.select("gene_id").distinct(), n_genes, "seurat").where("highly_variable").select("gene_id"))


#: Bins of the histogram whose valley is the threshold, and most rounds of smoothing.
BINS, SMOOTHED = 50, 1000


def valley(simulated: DataFrame, score: str = "score", bins: int = BINS) -> float | None:
    """The least frequent score between the two modes of simulated doublets (of one kind of cell, and of two): the
    histogram, a row a bin, is smoothed until it has two peaks. None if it has no two."""
    rows = simulated.groupBy(F.least(F.floor(F.col(score) * bins + 1e-9), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n")).collect()
    bars = np.zeros(bins)
    for r in rows:
        bars[r["bin"]] = r["n"]
    for _ in range(SMOOTHED):
        wide = np.concatenate([[-1.0], bars, [-1.0]])
        keep = np.concatenate([[True], np.diff(bars) != 0])  # a plateau is one peak
        at, level = np.flatnonzero(keep), bars[keep]
        edge = np.concatenate([[-1.0], level, [-1.0]])
        peaks = at[(edge[1:-1] > edge[:-2]) & (edge[1:-1] > edge[2:])]
        if len(peaks) < 2:
            return None
        if len(peaks) == 2:
            a, b = peaks
            inside = bars[a : b + 1]
            return float((a + np.flatnonzero(inside == inside.min()).mean() + 0.5) / bins)
        wide[0], wide[-1] = bars[0], bars[-1]
        bars = (wide[:-2] + wide[1:-1] + wide[2:]) / 3
    return None


def call_by_valley(expr: DataFrame, cells: DataFrame, rate: float = 0.06, min_counts: float = 2, min_cells: int = 2, n_genes: int = GENES, k: int = 15, n_pcs: int = 10, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """cell_id, score (the likelihood of a doublet by Bayes' rule from its simulated neighbours and the expected rate) and
    ``doublet``: above the valley of the simulated cells' scores, or of the (1 - rate) quantile where they have one mode."""
    expr = stored(expr)
    genes = variable_genes(expr, cells, n_genes, min_counts, min_cells)
    found = checkpoint(shares(expr, cells, genes, k, n_pcs, ratio, seed))
    n = found.agg(F.count_if("simulated").alias("s"), F.count_if(~F.col("simulated")).alias("r")).first()
    odds = max(n["s"], 1) / max(n["r"], 1)
    out = checkpoint(real(cells, found, F.col("share")).withColumnRenamed("score", "share"))
    # Scores rise with the share, so the cut is made in shares, whose k + 1 levels leave no bin empty.
    cut = valley(found.where("simulated"), "share", k)
    if cut is None:
        cut = exact(out, {"t": ("share", 1 - rate)}).first()["t"]
    q = (F.col("share") * k + 1) / (k + 2)
    likely = q * rate / odds / (1 - rate - q * (1 - rate - rate / odds))
    return out.select("cell_id", likely.alias("score"), (F.col("share") > F.lit(cut)).alias("doublet"))


def call_by_share(expr: DataFrame, cells: DataFrame, rate: float = 0.06, n_genes: int = GENES, k: int = 15, n_pcs: int = 10, ratio: float = 1.0, seed: int = 42) -> DataFrame:
    """cell_id, score (the part of simulated cells among the k nearest) and ``doublet``: the round(rate * cells) cells with the
    highest scores, ties by id."""
    expr = stored(expr)
    found = shares(expr, cells, variable_genes(expr, cells, n_genes), k, n_pcs, ratio, seed)
    ordered = checkpoint(numbered(real(cells, found, F.col("share")).withColumn("_low", -F.col("score")), ["_low", "cell_id"]))
    return ordered.select("cell_id", "score", (F.col("at") < round(rate * ordered.count())).alias("doublet"))


def consensus(calls: DataFrame, first: str | None = "scrublet", second: str | None = "doubletfinder", require_both: bool = False) -> DataFrame:
    """Adds ``is_doublet``: either call (or both), or the one that there is; null counts as no. ValueError without any."""
    have = [c for c in (first, second) if c and c in calls.columns]
    if not have:
        raise ValueError("no doublet calls")
    x = [F.coalesce(F.col(c), F.lit(False)) for c in have]
    return calls.withColumn("is_doublet", x[0] if len(x) == 1 else (x[0] & x[1] if require_both else x[0] | x[1]))


def consensus_stats(flagged: DataFrame, method: str = "either") -> DataFrame:
    need(flagged, "is_doublet")
    return flagged.agg(F.lit(method).alias("method"), F.count("*").alias("n_cells"), F.count_if("is_doublet").alias("n_doublets"), (100 * F.count_if("is_doublet") / F.count("*")).alias("pct_doublets"))
