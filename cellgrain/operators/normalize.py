"""Normalisation, variable genes, scaling and binning."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from cellgrain.model import ratio


def library_sizes(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Per cell the sum of its values, 0 without any."""
    return cells.select("cell_id").join(expr.groupBy("cell_id").agg(F.sum("value").alias("lib")), "cell_id", "left").fillna(0)


def log_normalize(expr: DataFrame, target: float = 1e4) -> DataFrame:
    """ln(1 + value * target / cell total). Cells without counts have no rows and stay as they are."""
    lib = expr.groupBy("cell_id").agg(F.sum("value").alias("lib"))
    return expr.join(lib, "cell_id").select("cell_id", "gene_id", F.log1p(F.coalesce(ratio(F.col("value") * target, F.col("lib")), F.col("value"))).alias("value"))


def normalize_stats(before: DataFrame, after: DataFrame, cells: DataFrame) -> DataFrame:
    """One row: the mean library size before and after."""
    mean = lambda df, name: library_sizes(df, cells).agg(F.avg("lib").alias(name))
    return mean(before, "mean_library_before").crossJoin(mean(after, "mean_library_after"))


def scran_factors(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """Per cell a size factor from its peers: cells whose library lies strictly between half and twice its own. For each gene the
    peers' median m (zeros count); the factor is exp(median(ln(value / (m + 1)))) over the cell's genes, 0 without
    any, and 0.5 at least.

    Cells of one library size share their peers, so peers are matched on distinct sizes, and values enter as a
    histogram (size, gene, value, frequency). Only genes that half of the peers have can have a median above 0: how many
    have one is the difference of two running sums along the gene's sizes, and only pairs of size and gene that pass meet the histogram."""
    lib = library_sizes(expr, cells)
    sizes = lib.where("lib > 0").groupBy("lib").agg(F.count("*").alias("n"))
    # A range join: sizes in octaves, so that a size meets its own octave and the two beside it only.
    octave = F.floor(F.log2("lib")).cast("int")
    reach = F.explode(F.array(octave - 1, octave, octave + 1)).alias("octave")
    pairs = sizes.select(F.col("lib").alias("size"), reach).join(sizes.select("lib", "n", octave.alias("octave")), "octave").where("lib > size / 2 AND lib < 2 * size")
    peers = pairs.groupBy("size").agg(F.sum("n").alias("peers"))
    bars = expr.where("value <> 0").join(lib.where("lib > 0"), "cell_id").groupBy("lib", "gene_id", "value").agg(F.count("*").alias("freq"))
    at_size = bars.groupBy("gene_id", "lib").agg(F.sum("freq").alias("freq"))
    # Both bounds are strict: at equal sizes the upper one (-1) is read before the count (0), the lower one (1) after it.
    bound = lambda at, sign: F.struct(at.cast("double").alias("at"), F.lit(sign).alias("sign"), F.col("lib").cast("double").alias("size"), F.lit(0).cast("long").alias("freq"))
    count = F.struct(F.col("lib").cast("double").alias("at"), F.lit(0).alias("sign"), F.lit(None).cast("double").alias("size"), "freq")
    events = at_size.select("gene_id", F.explode(F.array(count, bound(F.col("lib") * 2, -1), bound(F.col("lib") / 2, 1))).alias("e")).select("gene_id", "e.*")
    run = F.sum("freq").over(Window.partitionBy("gene_id").orderBy("at", "sign").rowsBetween(Window.unboundedPreceding, 0))
    have = events.withColumn("_run", run).where("sign <> 0").groupBy("gene_id", "size").agg(F.sum(-F.col("sign") * F.col("_run")).alias("have"))
    common = have.join(peers.withColumn("size", F.col("size").cast("double")), "size").where("2 * have >= peers")
    size_octave = F.floor(F.log2("size")).cast("int")
    wide = common.select("gene_id", "size", F.explode(F.array(size_octave - 1, size_octave, size_octave + 1)).alias("octave"))
    near = wide.join(bars.withColumn("octave", octave), ["gene_id", "octave"]).where("lib > size / 2 AND lib < 2 * size")
    kept = near.groupBy("size", "gene_id", "value").agg(F.sum("freq").alias("freq"))
    zeros = common.where("peers > have").select("size", "gene_id", F.lit(0.0).alias("value"), (F.col("peers") - F.col("have")).alias("freq"))
    median = kept.unionByName(zeros).groupBy("size", "gene_id").agg(F.percentile("value", F.lit(0.5), F.col("freq")).alias("m"))
    values = expr.where("value > 0").join(lib.select("cell_id", F.col("lib").cast("double").alias("size")), "cell_id").join(median, ["size", "gene_id"], "left")
    raw = values.groupBy("cell_id").agg(F.exp(F.median(F.log(F.col("value") / (F.coalesce("m", F.lit(0.0)) + 1)))).alias("raw"))
    return cells.select("cell_id").join(raw, "cell_id", "left").select("cell_id", F.greatest(F.coalesce("raw", F.lit(0.0)), F.lit(0.5)).alias("size_factor"))


def scran_normalize(expr: DataFrame, cells: DataFrame) -> DataFrame:
    """ln(1 + value / size factor)."""
    return expr.join(scran_factors(expr, cells), "cell_id").select("cell_id", "gene_id", F.log1p(F.col("value") / F.col("size_factor")).alias("value"))


def gene_moments(expr: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Per gene mean and population variance over all cells, zeros included."""
    n = cells.agg(F.count("*").alias("n_cells"))
    agg = expr.groupBy("gene_id").agg(F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_q"))
    out = genes.select("gene_id").join(agg, "gene_id", "left").fillna(0).crossJoin(F.broadcast(n))
    mean = F.col("_s") / F.col("n_cells")
    return out.select("gene_id", "n_cells", mean.alias("mean"), F.greatest(F.col("_q") / F.col("n_cells") - mean * mean, F.lit(0.0)).alias("var"))


def pearson_residuals(expr: DataFrame, cells: DataFrame, genes: DataFrame, dense: bool = True) -> DataFrame:
    """Residuals of all cells by the selected ``genes`` (zeros have residuals, too). s = total / mean total over all
    genes, mu = s * mean, theta from the gene's overdispersion, variance 0.1 at least. If not ``dense``, only stored
    entries have rows, with zero_value, the residual that a zero would have there: for all genes of a large matrix."""
    lib = library_sizes(expr, cells)
    s = lib.crossJoin(F.broadcast(lib.agg(F.avg("lib").alias("_mean")))).select("cell_id", ratio(F.col("lib"), F.col("_mean")).alias("s"))
    few = expr.join(genes.select("gene_id"), "gene_id", "left_semi")
    g = gene_moments(few, cells, genes)
    theta = F.least(F.greatest(g["mean"] * g["mean"] / F.greatest(g["var"] - g["mean"], F.lit(1e-6)), F.lit(1e-6)), F.lit(1e6))
    mu = F.col("s") * F.col("mean")
    v = F.greatest(mu + mu * mu / F.col("theta"), F.lit(0.1))
    g = g.select("gene_id", "mean", theta.alias("theta"))
    if not dense:
        return few.join(g, "gene_id").join(s, "cell_id").select("cell_id", "gene_id", ((F.col("value") - mu) / F.sqrt(v)).alias("value"), (-mu / F.sqrt(v)).alias("zero_value"))
    # The result is this large; the selected genes come to every cell.
    grid = s.crossJoin(g).join(few, ["cell_id", "gene_id"], "left")
    return grid.select("cell_id", "gene_id", ((F.coalesce("value", F.lit(0.0)) - mu) / F.sqrt(v)).alias("value"))


def hvg_seurat(expr: DataFrame, cells: DataFrame, genes: DataFrame, n_top: int = 2000, bins: int = 20) -> DataFrame:
    """Adds mean, normalised dispersion and ``highly_variable``: dispersion (variance / mean, sample variance) of
    log values is scaled inside of ``bins`` equal bins of the mean; the n_top highest are flagged, ties by gene."""
    m = gene_moments(expr, cells, genes)
    var = m["var"] * ratio(F.col("n_cells"), F.col("n_cells") - 1)
    d = m.select("gene_id", F.log1p("mean").alias("mean"), F.when(F.col("mean") > 0, F.log(F.when(var > 0, var) / F.col("mean"))).alias("dispersion"))
    span = d.agg(F.min("mean").alias("_a"), F.max("mean").alias("_b"))
    binned = d.crossJoin(F.broadcast(span)).withColumn("bin", F.when(F.col("_b") > F.col("_a"), F.least(F.floor((F.col("mean") - F.col("_a")) / (F.col("_b") - F.col("_a")) * bins), F.lit(bins - 1))).otherwise(0).cast("int"))
    w = Window.partitionBy("bin")
    sd, mid = F.stddev_samp("dispersion").over(w), F.avg("dispersion").over(w)
    # A bin of one gene has no spread: its gene scores 1.
    scored = binned.withColumn("dispersion_norm", F.when(sd > 0, (F.col("dispersion") - mid) / sd).when(F.col("dispersion").isNotNull(), F.lit(1.0)))
    top = scored.where("dispersion_norm is not null").select("gene_id", "dispersion_norm").orderBy(F.desc(F.round("dispersion_norm", 6)), "gene_id").limit(n_top).select("gene_id", F.lit(True).alias("_hv"))
    return scored.join(top, "gene_id", "left").select("gene_id", "mean", "dispersion", "bin", "dispersion_norm", F.coalesce("_hv", F.lit(False)).alias("highly_variable"))


#: Cells of the grid along the log mean, on which the trend of variances is fitted.
GRID = 1000


def trend_at(knots: np.ndarray, sums: np.ndarray, span: float = 0.3) -> np.ndarray:
    """Local quadratic fit with tricube weights: level, slope and curvature at every knot. ``sums`` has a row a knot:
    its points' number, sums of x to x ** 4, of y, x * y and x * x * y, with x taken from the knot. A neighbourhood holds ``span`` of all
    points, three at least; a knot without curvature around it gets a lower degree."""
    n = sums[:, 0]
    need_points = min(n.sum(), max(3, np.ceil(span * n.sum())))
    out = np.zeros((len(knots), 3))
    for i, at in enumerate(knots):
        d = knots - at
        near = np.argsort(np.abs(d), kind="stable")
        h = np.abs(d[near[np.searchsorted(np.cumsum(n[near]), need_points)]])
        w = (1 - np.minimum(np.abs(d) / h, 1) ** 3) ** 3 + 1e-12 * (np.abs(d) <= h) if h > 0 else (d == 0).astype(float)
        _, x1, x2, x3, x4, y, xy, xxy = sums.T
        # Moments about this knot, from those about each point's own.
        m1, m2, m3, m4 = x1 + d * n, x2 + 2 * d * x1 + d**2 * n, x3 + 3 * d * x2 + 3 * d**2 * x1 + d**3 * n, x4 + 4 * d * x3 + 6 * d**2 * x2 + 4 * d**3 * x1 + d**4 * n
        a = np.array([[w @ n, w @ m1, w @ m2], [w @ m1, w @ m2, w @ m3], [w @ m2, w @ m3, w @ m4]])
        b = np.array([w @ y, w @ (xy + d * y), w @ (xxy + 2 * d * xy + d**2 * y)])
        scale = np.array([1, 1 / h, 1 / h**2]) if h > 0 else np.array([1.0, 0.0, 0.0])
        out[i] = scale * np.linalg.lstsq(a * np.outer(scale, scale), b * scale, rcond=1e-12)[0]
    return out


def variance_trend(moments: DataFrame, span: float = 0.3) -> DataFrame:
    """Adds reg_std, the root of the variance that the trend of log10 variance on log10 mean expects; 0 for genes without
    variance. Genes meet as sums by cell of a grid of GRID cells, so fitting costs the same at any number of genes, and
    each gene takes the fit of its cell's mean point."""
    x, y = F.log10("mean"), F.log10("var")
    rows = moments.withColumns({"_x": F.when((F.col("mean") > 0) & (F.col("var") > 0), x), "_y": F.when((F.col("mean") > 0) & (F.col("var") > 0), y)})
    lo, hi, n = rows.agg(F.min("_x"), F.max("_x"), F.count("_x")).head()
    if n < 3:
        return moments.withColumn("reg_std", F.lit(0.0))
    cell = F.least(F.floor((F.col("_x") - lo) / (hi - lo) * GRID), F.lit(GRID - 1)).cast("int") if hi > lo else F.when(F.col("_x").isNotNull(), 0)
    rows = rows.withColumn("_cell", cell)
    used = rows.where("_x is not null")
    middle = used.groupBy("_cell").agg(F.avg("_x").alias("_k"))  # a row a cell of the grid
    u = F.col("_x") - F.col("_k")
    sums = used.join(F.broadcast(middle), "_cell").groupBy("_cell", "_k").agg(F.count("*"), F.sum(u), F.sum(u**2), F.sum(u**3), F.sum(u**4), F.sum("_y"), F.sum(u * F.col("_y")), F.sum(u**2 * F.col("_y")))
    grid = sums.orderBy("_cell").collect()  # GRID rows at most
    knots = np.array([r[1] for r in grid])
    fits = trend_at(knots, np.array([r[2:] for r in grid], float), span)
    table = moments.sparkSession.createDataFrame([(r[0], float(r[1]), *map(float, f)) for r, f in zip(grid, fits, strict=True)], "_cell int, _k double, _a double, _b double, _c double")
    joined = rows.join(F.broadcast(table), "_cell", "left")
    level = F.col("_a") + F.col("_b") * u + F.col("_c") * u * u
    return joined.select(*moments.columns, F.coalesce(F.sqrt(F.pow(F.lit(10.0), level)), F.lit(0.0)).alias("reg_std"))


def hvg_seurat_v3(expr: DataFrame, cells: DataFrame, genes: DataFrame, n_top: int = 2000, span: float = 0.3) -> DataFrame:
    """Variance of counts standardised by its trend, log10 variance on log10 mean by a local fit, values clipped at the root of
    the number of cells."""
    m = gene_moments(expr, cells, genes)
    m = m.withColumn("var", F.col("var") * ratio(F.col("n_cells"), F.col("n_cells") - 1))
    trend = variance_trend(m, span)
    limit = F.col("mean") + F.col("reg_std") * F.sqrt("n_cells")
    clipped = expr.join(trend, "gene_id").withColumn("v", F.least(F.col("value"), limit)).groupBy("gene_id").agg(F.sum("v").alias("_s"), F.sum(F.col("v") * F.col("v")).alias("_q"))
    j = trend.join(clipped, "gene_id", "left").fillna(0.0, ["_s", "_q"])
    norm = F.when(F.col("reg_std") > 0, (F.col("n_cells") * F.col("mean") * F.col("mean") + F.col("_q") - 2 * F.col("_s") * F.col("mean")) / ((F.col("n_cells") - 1) * F.col("reg_std") * F.col("reg_std"))).otherwise(0.0)
    scored = j.select("gene_id", "mean", "var", norm.alias("variance_norm"))
    top = scored.orderBy(F.desc(F.round("variance_norm", 9)), "gene_id").limit(n_top).select("gene_id", F.lit(True).alias("_hv"))
    return scored.join(top, "gene_id", "left").withColumn("highly_variable", F.coalesce("_hv", F.lit(False))).drop("_hv")


def select_hvgs(expr: DataFrame, cells: DataFrame, genes: DataFrame, n_top: int = 2000, flavor: str = "seurat_v3") -> DataFrame:
    if flavor not in ("seurat", "seurat_v3"):
        raise ValueError(f"flavor {flavor!r} is neither 'seurat' nor 'seurat_v3'")
    return (hvg_seurat if flavor == "seurat" else hvg_seurat_v3)(expr, cells, genes, n_top)


def scale(expr: DataFrame, cells: DataFrame, genes: DataFrame, most: float | None = None) -> DataFrame:
    """(value - mean) / sample deviation of all cells by the selected genes, at most ``most``. Constant genes are 0."""
    few = expr.join(genes.select("gene_id"), "gene_id", "left_semi")
    m = gene_moments(few, cells, genes).withColumn("sd", F.sqrt(F.col("var") * ratio(F.col("n_cells"), F.col("n_cells") - 1)))
    grid = cells.select("cell_id").crossJoin(m.select("gene_id", "mean", "sd")).join(few, ["cell_id", "gene_id"], "left")
    z = F.coalesce(ratio(F.coalesce("value", F.lit(0.0)) - F.col("mean"), F.col("sd")), F.lit(0.0))
    return grid.select("cell_id", "gene_id", (z if most is None else F.least(z, F.lit(most))).alias("value"))


def bin_expression(expr: DataFrame, n_bins: int = 51) -> DataFrame:
    """ln(1 + value) scaled by the least (0: there are zeros) and the largest of all, and put into n_bins - 1 equal
    bins numbered from 1."""
    top = expr.agg(F.max(F.log1p("value")).alias("_top"))
    x = F.log1p("value") / (F.col("_top") + 1e-8)
    return expr.crossJoin(F.broadcast(top)).select("cell_id", "gene_id", F.least(F.greatest(F.floor(x * (n_bins - 1)) + 1, F.lit(1)), F.lit(n_bins - 1)).cast("int").alias("bin"))


def gene_overlap(genes: DataFrame, listed: DataFrame, warn: float = 0.8) -> DataFrame:
    """One row: listed genes, those present, their share, and whether it is under ``warn``."""
    marked = listed.select("gene_id").distinct().join(genes.select("gene_id").distinct().withColumn("_in", F.lit(True)), "gene_id", "left")
    share = ratio(F.count("_in"), F.count("*"))
    return marked.agg(F.count("*").alias("n_listed"), F.count("_in").alias("n_common"), share.alias("overlap"), (share < warn).alias("low_overlap"))
