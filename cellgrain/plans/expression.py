"""Queries over the expression matrix: quality control, ambient signal, normalisation, groups of cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cellgrain.operators import ambient, normalize, pseudobulk, qc
from cellgrain.plans.adapter import BASE, cells, expr, genes, table
from cellgrain.plans.registry import query
from cellgrain.sources.layers import checkpoint, stored

#: Bounds for the driver's tables, whose cells have about four genes.
BOUNDS = {"min_genes": 2, "max_genes": 6, "min_umi": 50, "max_mito": 60, "max_ribo": 80}
MIN_CELLS = 10


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Float sums depend on the order of rows: digits that don't are compared."""
    return df.withColumns({x: F.round(x, digits) for x in names})


def metrics(s, d) -> DataFrame:
    return qc.cell_metrics(expr(s, d), cells(s, d), genes(s, d))


METRICS = """m AS (SELECT c.cell_id, coalesce(n, 0) AS n_genes_by_counts, coalesce(t, 0) AS total_counts, coalesce(mt, 0) AS total_counts_mito, coalesce(rb, 0) AS total_counts_ribo,
  CASE WHEN t <> 0 THEN 100 * mt / t END AS pct_counts_mito, CASE WHEN t <> 0 THEN 100 * rb / t END AS pct_counts_ribo FROM cells c LEFT JOIN (
    SELECT cell_id, count(*) AS n, sum(value) AS t, sum(CASE WHEN mito THEN value ELSE 0 END) AS mt, sum(CASE WHEN ribo THEN value ELSE 0 END) AS rb FROM expr LEFT JOIN genes USING (gene_id) WHERE value <> 0 GROUP BY cell_id) USING (cell_id))"""
GENE_METRICS = "gm AS (SELECT gene_id, coalesce(n, 0) AS n_cells_by_counts, coalesce(t, 0) AS total_counts, coalesce(t, 0) / (SELECT count(*) FROM cells) AS mean_counts, 100 - 100 * coalesce(n, 0) / (SELECT count(*) FROM cells) AS pct_dropout_by_counts FROM genes LEFT JOIN (SELECT gene_id, count(*) AS n, sum(value) AS t FROM expr WHERE value <> 0 GROUP BY gene_id) USING (gene_id))"
PASSES = "n_genes_by_counts BETWEEN 2 AND 6 AND total_counts >= 50 AND pct_counts_mito <= 60 AND pct_counts_ribo <= 80"
KEPT = f"kept AS (SELECT * FROM m WHERE {PASSES})"


@query("gene_flags", "SELECT p_partkey AS gene_id, n AS gene_name, starts_with(n, 'MT-') AS mito, regexp_matches(n, '^RP[SL]') AS ribo FROM (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'MT-' WHEN 'SMALL' THEN 'RPS' WHEN 'LARGE' THEN 'RPA' ELSE '' END || p_name AS n FROM part)")
def gene_flags(s, d):
    p = table(s, d, "part")
    prefix = F.when(F.col("p_type") == "ECONOMY", "MT-").when(F.col("p_type") == "SMALL", "RPS").when(F.col("p_type") == "LARGE", "RPA").otherwise("")
    return qc.gene_flags(p.select(F.col("p_partkey").alias("gene_id"), F.concat(prefix, "p_name").alias("gene_name")), "gene_name")


@query("qc_cell_metrics", f"{BASE}, {METRICS} SELECT cell_id, n_genes_by_counts, total_counts, total_counts_mito, total_counts_ribo, round(pct_counts_mito, 6) AS pct_counts_mito, round(pct_counts_ribo, 6) AS pct_counts_ribo FROM m")
def qc_cell_metrics(s, d):
    return rounded(metrics(s, d), "pct_counts_mito", "pct_counts_ribo")


@query("qc_top_share", f"{BASE}, r AS (SELECT *, row_number() OVER (PARTITION BY cell_id ORDER BY value DESC, gene_id) AS k FROM expr WHERE value <> 0), a AS (SELECT cell_id, round(100 * sum(value) FILTER (k <= 1) / sum(value), 6) AS pct_counts_in_top_1_genes, round(100 * sum(value) FILTER (k <= 3) / sum(value), 6) AS pct_counts_in_top_3_genes FROM r GROUP BY cell_id) SELECT cell_id, pct_counts_in_top_1_genes, pct_counts_in_top_3_genes FROM cells LEFT JOIN a USING (cell_id)")
def qc_top_share(s, d):
    return rounded(qc.top_share(expr(s, d), cells(s, d), (1, 3)), "pct_counts_in_top_1_genes", "pct_counts_in_top_3_genes")


@query("qc_gene_metrics", f"{BASE}, {GENE_METRICS} SELECT gene_id, n_cells_by_counts, total_counts, round(mean_counts, 6) AS mean_counts, round(pct_dropout_by_counts, 6) AS pct_dropout_by_counts FROM gm")
def qc_gene_metrics(s, d):
    return rounded(qc.gene_metrics(expr(s, d), cells(s, d), genes(s, d)), "mean_counts", "pct_dropout_by_counts")


@query("qc_filter_cells", f"{BASE}, {METRICS}, {KEPT} SELECT cell_id, gene_id, value FROM expr SEMI JOIN kept USING (cell_id)")
def qc_filter_cells(s, d):
    return qc.restrict(expr(s, d), cells=qc.filter_cells(metrics(s, d), **BOUNDS))


@query("qc_filter_genes", f"{BASE}, {METRICS}, {KEPT}, {GENE_METRICS} SELECT cell_id, gene_id, value FROM expr SEMI JOIN kept USING (cell_id) WHERE gene_id IN (SELECT gene_id FROM gm WHERE n_cells_by_counts >= {MIN_CELLS})")
def qc_filter_genes(s, d):
    kept_genes = qc.filter_genes(qc.gene_metrics(expr(s, d), cells(s, d), genes(s, d)), MIN_CELLS)  # of all cells
    return qc.restrict(expr(s, d), qc.filter_cells(metrics(s, d), **BOUNDS), kept_genes)


REPORT = f"""SELECT n_cells_before, n_cells_after, round(mean_genes_per_cell, 6) AS mean_genes_per_cell, round(mean_counts_per_cell, 6) AS mean_counts_per_cell, round(mean_pct_mito, 6) AS mean_pct_mito, round(mean_pct_ribo, 6) AS mean_pct_ribo, n_genes_before, n_genes_after,
  round(100 * (1 - n_cells_after / n_cells_before), 6) AS pct_cells_removed, round(100 * (1 - n_genes_after / n_genes_before), 6) AS pct_genes_removed FROM
  (SELECT count(*) AS n_cells_before, count(*) FILTER ({PASSES}) AS n_cells_after, avg(n_genes_by_counts) FILTER ({PASSES}) AS mean_genes_per_cell, avg(total_counts) FILTER ({PASSES}) AS mean_counts_per_cell, avg(pct_counts_mito) FILTER ({PASSES}) AS mean_pct_mito, avg(pct_counts_ribo) FILTER ({PASSES}) AS mean_pct_ribo FROM m),
  (SELECT count(*) AS n_genes_before, count(*) FILTER (n_cells_by_counts >= {MIN_CELLS}) AS n_genes_after FROM gm)"""
REPORT_ROUNDED = ("mean_genes_per_cell", "mean_counts_per_cell", "mean_pct_mito", "mean_pct_ribo", "pct_cells_removed", "pct_genes_removed")


@query("qc_report", f"{BASE}, {METRICS}, {GENE_METRICS} {REPORT}")
def qc_report(s, d):
    g = qc.gene_metrics(expr(s, d), cells(s, d), genes(s, d))
    return rounded(qc.report(metrics(s, d), g, MIN_CELLS, **BOUNDS), *REPORT_ROUNDED)


@query("qc_outliers_mad", f"{BASE}, {METRICS}, a AS (SELECT median(total_counts) AS mid FROM m), b AS (SELECT median(abs(total_counts - mid)) AS mad FROM m, a) SELECT cell_id, total_counts, abs(total_counts - mid) > 2 * mad AS is_outlier FROM m, a, b")
def qc_outliers_mad(s, d):
    return qc.outliers(metrics(s, d), "total_counts", 2.0).select("cell_id", "total_counts", "is_outlier")


@query("qc_outliers_iqr", f"{BASE}, {METRICS}, a AS (SELECT quantile_cont(total_counts, 0.25) AS q1, quantile_cont(total_counts, 0.75) AS q3 FROM m) SELECT cell_id, total_counts, total_counts < q1 - 1.5 * (q3 - q1) OR total_counts > q3 + 1.5 * (q3 - q1) AS is_outlier FROM m, a")
def qc_outliers_iqr(s, d):
    return qc.outliers(metrics(s, d), "total_counts", method="iqr").select("cell_id", "total_counts", "is_outlier")


@query("row_mask", "SELECT o_orderkey AS cell_id, coalesce(o_totalprice > 200000, false) AS kept FROM orders")
def row_mask(s, d):
    yes, no = qc.mask(cells(s, d).select("cell_id", "price"), F.col("price") > 200000)
    return yes.select("cell_id", F.lit(True).alias("kept")).unionByName(no.select("cell_id", F.lit(False).alias("kept")))


SHARES = "p AS (SELECT gene_id, gene_total, gene_total / sum(gene_total) OVER () AS share FROM (SELECT gene_id, sum(value) AS gene_total FROM expr GROUP BY gene_id))"
RHO = "rho AS (SELECT cell_id, coalesce(t, 0) AS total, coalesce(CASE WHEN t <> 0 THEN least(i / t, 0.9) END, 0) AS rho FROM cells LEFT JOIN (SELECT cell_id, sum(value) AS t, sum(CASE WHEN gene_id IN (SELECT gene_id FROM p ORDER BY share DESC, gene_id LIMIT 100) THEN value ELSE 0 END) AS i FROM expr GROUP BY cell_id) USING (cell_id))"


@query("ambient_profile", f"{BASE}, {SHARES} SELECT gene_id, gene_total, round(share, 9) AS share FROM p")
def ambient_profile(s, d):
    return rounded(ambient.profile(expr(s, d)), "share", digits=9)


@query("ambient_top_genes", f"{BASE}, {SHARES} SELECT gene_id, gene_total FROM p ORDER BY share DESC, gene_id LIMIT 100")
def ambient_top_genes(s, d):
    return ambient.top_genes(ambient.profile(expr(s, d))).select("gene_id", "gene_total")


@query("soupx_fraction", f"{BASE}, {SHARES}, {RHO} SELECT cell_id, total, round(rho, 6) AS rho FROM rho")
def soupx_fraction(s, d):
    return rounded(ambient.soupx_fraction(expr(s, d), cells(s, d)), "rho")


@query("soupx_correct", f"{BASE}, {SHARES}, {RHO} SELECT cell_id, gene_id, round(greatest(value - share * total * rho, 0), 6) AS value FROM expr JOIN p USING (gene_id) JOIN rho USING (cell_id) WHERE value - share * total * rho > 0")
def soupx_correct(s, d):
    return rounded(ambient.correct(expr(s, d), cells(s, d), genes(s, d), "soupx"), "value")


BACKGROUND = "mean_of AS (SELECT gene_id, coalesce(t, 0) / (SELECT count(*) FROM cells) AS mean FROM genes LEFT JOIN (SELECT gene_id, sum(value) AS t FROM expr GROUP BY gene_id) USING (gene_id)), bg AS (SELECT gene_id FROM mean_of WHERE mean < (SELECT quantile_cont(mean, 0.25) FROM mean_of)), sc AS (SELECT cell_id, coalesce(CASE WHEN t <> 0 THEN i / t END, 0) AS score FROM cells LEFT JOIN (SELECT cell_id, sum(value) AS t, sum(CASE WHEN gene_id IN (SELECT gene_id FROM bg) THEN value ELSE 0 END) AS i FROM expr GROUP BY cell_id) USING (cell_id))"


@query("decontx_score", f"{BASE}, {BACKGROUND} SELECT cell_id, round(score, 6) AS contamination_score, round(1 - least(score, 0.99), 6) AS native_prob FROM sc")
def decontx_score(s, d):
    return rounded(ambient.decontx_score(expr(s, d), cells(s, d), genes(s, d)), "contamination_score", "native_prob")


@query("decontx_correct", f"{BASE}, {BACKGROUND} SELECT cell_id, gene_id, round(CASE WHEN gene_id IN (SELECT gene_id FROM bg) THEN value * (1 - least(score, 0.99)) ELSE value END, 6) AS value FROM expr JOIN sc USING (cell_id)")
def decontx_correct(s, d):
    return rounded(ambient.correct(expr(s, d), cells(s, d), genes(s, d), "decontx"), "value")


LOGNORM = "ln_expr AS (SELECT cell_id, gene_id, ln(1 + value * 1e4 / sum(value) OVER (PARTITION BY cell_id)) AS value FROM expr)"


@query("log_normalize", f"{BASE}, {LOGNORM} SELECT cell_id, gene_id, round(value, 6) AS value FROM ln_expr")
def log_normalize(s, d):
    return rounded(normalize.log_normalize(expr(s, d)), "value")


@query("log_normalize_stats", f"{BASE}, {LOGNORM} SELECT round((SELECT sum(value) FROM expr SEMI JOIN cells USING (cell_id)) / count(*), 6) AS mean_library_before, round((SELECT sum(value) FROM ln_expr SEMI JOIN cells USING (cell_id)) / count(*), 6) AS mean_library_after FROM cells")
def log_normalize_stats(s, d):
    e = expr(s, d)
    return rounded(normalize.normalize_stats(e, normalize.log_normalize(e), cells(s, d)), "mean_library_before", "mean_library_after")


# Cells of one library size share their peers, so the reference plan goes by distinct sizes as well; its medians come
# from cumulated frequencies.
SCRAN = f"""{BASE}, lib AS (SELECT cell_id, coalesce(sum(value), 0) AS lib FROM cells LEFT JOIN expr USING (cell_id) GROUP BY cell_id),
sz AS (SELECT lib, count(*) AS n FROM lib WHERE lib > 0 GROUP BY lib), pr AS (SELECT a.lib AS size, b.lib, b.n FROM sz a JOIN sz b ON b.lib > a.lib / 2 AND b.lib < 2 * a.lib), pn AS (SELECT size, sum(n) AS peers FROM pr GROUP BY size),
hb AS (SELECT lib, gene_id, value, count(*) AS f FROM expr JOIN lib USING (cell_id) WHERE value <> 0 GROUP BY ALL),
nr AS (SELECT size, gene_id, value, sum(f) AS f FROM pr JOIN hb USING (lib) GROUP BY ALL),
cm AS (SELECT size, gene_id, sum(f) AS have, any_value(peers) AS peers FROM nr JOIN pn USING (size) GROUP BY ALL HAVING 2 * sum(f) >= any_value(peers)),
al AS (SELECT size, gene_id, value, f FROM nr SEMI JOIN cm USING (size, gene_id) UNION ALL SELECT size, gene_id, 0, peers - have FROM cm WHERE peers > have),
cu AS (SELECT *, sum(f) OVER (PARTITION BY size, gene_id ORDER BY value) AS run, sum(f) OVER (PARTITION BY size, gene_id) AS total FROM al),
md AS (SELECT size, gene_id, (min(value) FILTER (run >= floor((total + 1) / 2)) + min(value) FILTER (run >= floor(total / 2) + 1)) / 2 AS m FROM cu GROUP BY ALL),
fc AS (SELECT cell_id, exp(median(ln(value / (coalesce(m, 0) + 1)))) AS raw FROM expr JOIN lib USING (cell_id) LEFT JOIN md ON md.size = lib.lib AND md.gene_id = expr.gene_id WHERE value > 0 GROUP BY cell_id),
sf AS (SELECT cell_id, greatest(coalesce(raw, 0), 0.5) AS size_factor FROM cells LEFT JOIN fc USING (cell_id))"""


@query("scran_factors", f"{SCRAN} SELECT cell_id, round(size_factor, 6) AS size_factor FROM sf")
def scran_factors(s, d):
    return rounded(normalize.scran_factors(checkpoint(expr(s, d)), cells(s, d)), "size_factor")


@query("scran_normalize", f"{SCRAN} SELECT cell_id, gene_id, round(ln(1 + value / size_factor), 6) AS value FROM expr JOIN sf USING (cell_id)")
def scran_normalize(s, d):
    return rounded(normalize.scran_normalize(checkpoint(expr(s, d)), cells(s, d)), "value")


MOMENTS = "mo AS (SELECT gene_id, n, coalesce(t, 0) / n AS mean, greatest(coalesce(q, 0) / n - (coalesce(t, 0) / n) * (coalesce(t, 0) / n), 0) AS var FROM {genes} LEFT JOIN (SELECT gene_id, sum(value) AS t, sum(value * value) AS q FROM {expr} GROUP BY gene_id) USING (gene_id), (SELECT count(*) AS n FROM cells))"
DISPERSION = f"""{LOGNORM}, {MOMENTS.format(genes='genes', expr='ln_expr')}, dd AS (SELECT gene_id, ln(1 + mean) AS mean, CASE WHEN mean > 0 AND var * n / (n - 1) > 0 THEN ln(var * n / (n - 1) / mean) END AS dispersion FROM mo),
bb AS (SELECT *, CAST(CASE WHEN b > a THEN least(floor((mean - a) / (b - a) * 20), 19) ELSE 0 END AS INTEGER) AS bin FROM dd, (SELECT min(mean) AS a, max(mean) AS b FROM dd)),
zz AS (SELECT *, CASE WHEN stddev_samp(dispersion) OVER w > 0 THEN (dispersion - avg(dispersion) OVER w) / stddev_samp(dispersion) OVER w WHEN dispersion IS NOT NULL THEN 1.0 END AS z FROM bb WINDOW w AS (PARTITION BY bin))"""
TOP = "{name} AS (SELECT gene_id FROM zz WHERE z IS NOT NULL ORDER BY round(z, 6) DESC, gene_id LIMIT {n})"
#: Highly variable genes that are scaled: the result has a row for each cell and each of them.
SCALED = 50


def variable(s, d, n: int) -> DataFrame:
    """The ``n`` most variable genes of the log-normalised matrix."""
    return normalize.select_hvgs(stored(normalize.log_normalize(expr(s, d))), cells(s, d), genes(s, d), n, "seurat").where("highly_variable").select("gene_id")


@query("pearson_residuals", f"{BASE}, {MOMENTS.format(genes='genes', expr='expr')}, lib AS (SELECT cell_id, coalesce(sum(value), 0) AS lib FROM cells LEFT JOIN expr USING (cell_id) GROUP BY cell_id), s AS (SELECT cell_id, lib / avg(lib) OVER () AS s FROM lib), g AS (SELECT gene_id, mean, least(greatest(mean * mean / greatest(var - mean, 1e-6), 1e-6), 1e6) AS theta FROM mo) SELECT cell_id, gene_id, round((value - s * mean) / sqrt(greatest(s * mean + s * mean * s * mean / theta, 0.1)), 6) AS value, round(-s * mean / sqrt(greatest(s * mean + s * mean * s * mean / theta, 0.1)), 6) AS zero_value FROM expr JOIN s USING (cell_id) JOIN g USING (gene_id)")
def pearson_residuals(s, d):
    return rounded(normalize.pearson_residuals(expr(s, d), cells(s, d), genes(s, d), dense=False), "value", "zero_value")


@query("scale_hvg", f"{BASE}, {DISPERSION}, {TOP.format(name='few', n=SCALED)}, {MOMENTS.format(genes='few', expr='ln_expr').replace('mo AS', 'ms AS', 1)} SELECT cell_id, gene_id, round(least(coalesce(CASE WHEN var > 0 THEN (coalesce(value, 0) - mean) / sqrt(var * n / (n - 1)) END, 0), 10), 6) AS value FROM cells CROSS JOIN ms LEFT JOIN ln_expr USING (cell_id, gene_id)")
def scale_hvg(s, d):
    return rounded(normalize.scale(normalize.log_normalize(expr(s, d)), cells(s, d), variable(s, d, SCALED), 10.0), "value")


@query("hvg_seurat", f"""{BASE}, {DISPERSION}, {TOP.format(name='tt', n=200)}
SELECT gene_id, round(mean, 6) AS mean, round(dispersion, 6) AS dispersion, bin, round(z, 6) AS dispersion_norm, gene_id IN (SELECT gene_id FROM tt) AS highly_variable FROM zz""")
def hvg_seurat(s, d):
    return rounded(normalize.select_hvgs(checkpoint(normalize.log_normalize(expr(s, d))), cells(s, d), genes(s, d), 200, "seurat"), "mean", "dispersion", "dispersion_norm")


@query("hvg_seurat_v3")
def hvg_seurat_v3(s, d):
    return normalize.select_hvgs(expr(s, d), cells(s, d), genes(s, d), 200)


@query("expr_binning", f"{BASE} SELECT cell_id, gene_id, CAST(least(greatest(floor(ln(1 + value) / ((SELECT max(ln(1 + value)) FROM expr) + 1e-8) * 50) + 1, 1), 50) AS INTEGER) AS bin FROM expr")
def expr_binning(s, d):
    return normalize.bin_expression(expr(s, d))


@query("gene_overlap", f"{BASE} SELECT count(*) AS n_listed, count(*) FILTER (gene_id IN (SELECT gene_id FROM expr)) AS n_common, round(count(*) FILTER (gene_id IN (SELECT gene_id FROM expr)) / count(*), 6) AS overlap, count(*) FILTER (gene_id IN (SELECT gene_id FROM expr)) / count(*) < 0.8 AS low_overlap FROM genes")
def gene_overlap(s, d):
    return rounded(normalize.gene_overlap(expr(s, d), genes(s, d)), "overlap")


@query("pseudobulk", f"{BASE} SELECT patient_id, cell_type, gene_id, sum(value) AS value FROM expr JOIN cells USING (cell_id) WHERE patient_id IS NOT NULL AND cell_type IS NOT NULL GROUP BY ALL")
def pseudobulk_(s, d):
    return pseudobulk.aggregate(expr(s, d), cells(s, d), ["patient_id", "cell_type"])


@query("pseudobulk_sizes", f"{BASE} SELECT patient_id, cell_type, count(*) AS n_cells FROM cells WHERE patient_id IS NOT NULL AND cell_type IS NOT NULL GROUP BY ALL")
def pseudobulk_sizes(s, d):
    return pseudobulk.group_sizes(cells(s, d), ["patient_id", "cell_type"])


@query("pseudobulk_compartment", f"{BASE} SELECT patient_id, batch AS compartment, cell_type, gene_id, sum(value) AS value FROM expr JOIN cells USING (cell_id) GROUP BY ALL")
def pseudobulk_compartment(s, d):
    return pseudobulk.aggregate(expr(s, d), cells(s, d).withColumnRenamed("batch", "compartment"), ["patient_id", "compartment", "cell_type"])


@query("pseudobulk_min_cells", f"{BASE}, k AS (SELECT patient_id FROM cells GROUP BY 1 HAVING count(*) >= 10) SELECT patient_id, gene_id, sum(value) AS value FROM expr JOIN cells USING (cell_id) SEMI JOIN k USING (patient_id) GROUP BY ALL")
def pseudobulk_min_cells(s, d):
    return pseudobulk.aggregate(expr(s, d), cells(s, d), ["patient_id"], min_cells=10)


@query("pseudobulk_slice", f"{BASE}, {METRICS}, {KEPT}, {GENE_METRICS}, f AS (SELECT cell_id, gene_id, value FROM expr SEMI JOIN kept USING (cell_id) WHERE gene_id IN (SELECT gene_id FROM gm WHERE n_cells_by_counts >= {MIN_CELLS})), nn AS (SELECT cell_id, gene_id, ln(1 + value * 1e4 / sum(value) OVER (PARTITION BY cell_id)) AS value FROM f) SELECT patient_id, cell_type, gene_id, round(sum(value), 6) AS value FROM nn JOIN cells USING (cell_id) GROUP BY ALL")
def pseudobulk_slice(s, d):
    return rounded(pseudobulk.aggregate(normalize.log_normalize(qc_filter_genes(s, d)), cells(s, d), ["patient_id", "cell_type"]), "value")


TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query("pseudobulk_wide", f"{BASE}, x AS (SELECT cell_id, marker_set AS gene_id, sum(value) AS value FROM expr JOIN genes USING (gene_id) GROUP BY ALL), n AS (SELECT cell_type, count(*) AS n_cells FROM cells GROUP BY 1) SELECT cell_type, n_cells, {', '.join(f'''coalesce(sum(value) FILTER (gene_id = '{b}'), 0) AS "{b}"''' for b in BRANDS)} FROM n JOIN cells USING (cell_type) LEFT JOIN x USING (cell_id) GROUP BY ALL")
def pseudobulk_wide(s, d):
    by_brand = expr(s, d).join(genes(s, d).select("gene_id", "marker_set"), "gene_id").groupBy("cell_id", F.col("marker_set").alias("gene_id")).agg(F.sum("value").alias("value"))
    return pseudobulk.wide(by_brand, cells(s, d), ["cell_type"], BRANDS)


@query("cell_fractions", f"{BASE} SELECT patient_id, cell_type, round(n / sum(n) OVER (PARTITION BY patient_id), 6) AS fraction FROM (SELECT patient_id, cell_type, count(*) AS n FROM cells GROUP BY ALL)")
def cell_fractions(s, d):
    return rounded(pseudobulk.fractions(cells(s, d), "patient_id", "cell_type"), "fraction")


@query("cell_fractions_wide", f"{BASE} SELECT patient_id, {', '.join(f'''round(count(*) FILTER (cell_type = '{t}') / count(*), 6) AS "{t}"''' for t in TYPES)} FROM cells GROUP BY patient_id")
def cell_fractions_wide(s, d):
    out = pseudobulk.fractions_wide(cells(s, d), "patient_id", "cell_type", TYPES)
    return out.select("patient_id", *(F.round(F.col(f"`{t}`"), 6).alias(t) for t in TYPES))


@query("pseudobulk_rollup", f"{BASE} SELECT batch, cell_type, sum(value) AS value FROM expr JOIN cells USING (cell_id) GROUP BY ROLLUP (batch, cell_type)")
def pseudobulk_rollup(s, d):
    return pseudobulk.subtotals(expr(s, d), cells(s, d), ["batch", "cell_type"])


@query("distinct_counts", f"{BASE} SELECT count(DISTINCT patient_id) AS n_patients, count(DISTINCT cell_type) AS n_cell_types, count(DISTINCT batch) AS n_batches FROM cells")
def distinct_counts(s, d):
    c = cells(s, d)
    return c.agg(F.count_distinct("patient_id").alias("n_patients"), F.count_distinct("cell_type").alias("n_cell_types"), F.count_distinct("batch").alias("n_batches"))


@query("dataset_summary", f"{BASE}, {METRICS} SELECT batch AS dataset, count(*) AS n_cells, median(n_genes_by_counts) AS median_genes, median(total_counts) AS median_counts, round(median(pct_counts_mito), 6) AS median_pct_mito, count(DISTINCT cell_type) AS n_cell_types FROM cells JOIN m USING (cell_id) GROUP BY batch")
def dataset_summary(s, d):
    return rounded(qc.dataset_summary(cells(s, d).join(metrics(s, d), "cell_id").withColumnRenamed("batch", "dataset")), "median_pct_mito")


@query("celltype_distribution", f"{BASE} SELECT cell_type, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM cells GROUP BY cell_type")
def celltype_distribution(s, d):
    return rounded(pseudobulk.share_of(cells(s, d), "cell_type"), "share")
