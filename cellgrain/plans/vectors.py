"""Queries over embeddings and neighbour graphs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from cellgrain.operators import communities, embed, metrics, normalize, sparse_pca
from cellgrain.plans.adapter import EMB, cells, emb, expr
from cellgrain.plans.expression import rounded
from cellgrain.plans.registry import query
from cellgrain.sources.layers import checkpoint

DIST = "ds AS MATERIALIZED (SELECT a.cell_id AS src, b.cell_id AS dst, round(list_distance(a.vec, b.vec), 9) AS dist FROM emb a, emb b WHERE a.cell_id <> b.cell_id)"
KNN = f"WITH {EMB}, {DIST}, nn AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS rank FROM ds) WHERE rank <= 15)"
SIL = "sl AS MATERIALIZED (SELECT cell_id, label, CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS silhouette FROM (SELECT cell_id, own AS label, max(CASE WHEN own = other THEN s / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM (SELECT x.cell_id, x.{k} AS own, y.{k} AS other, sum(CASE WHEN x.cell_id = y.cell_id THEN 0 ELSE list_distance(x.vec, y.vec) END) AS s, count(*) AS n FROM emb x, emb y GROUP BY ALL) GROUP BY ALL))"


def edges(s, d) -> DataFrame:
    return embed.knn(emb(s, d), 15)


@query("knn_graph", f"{KNN} SELECT src, dst, rank, round(dist, 5) AS dist FROM nn")
def knn_graph(s, d):
    return rounded(edges(s, d), "dist", digits=5)


@query("knn_approx")
def knn_approx(s, d):
    """Neighbours of every point whose id is divisible by 50, among all points."""
    e = emb(s, d)
    return embed.knn_approx(e, 15, queries=e.where(F.pmod("cell_id", F.lit(50)) == 0).select("cell_id"))


@query("silhouette", f"WITH {EMB}, {SIL.format(k='label')} SELECT cell_id, CAST(label AS VARCHAR) AS label, round(silhouette, 5) AS silhouette FROM sl")
def silhouette(s, d):
    return rounded(embed.silhouette(emb(s, d), "label"), "silhouette", digits=5)


# Mean squared distance to a cluster's points: |x|^2 + mean |y|^2 - 2 x . mean y.
SQUARED = "cl AS (SELECT label AS c, dim, avg(x) AS m FROM (SELECT label, unnest(range(1, len(vec) + 1)) AS dim, unnest(vec) AS x FROM emb) GROUP BY ALL), cv AS (SELECT c, list(m ORDER BY dim) AS m FROM cl GROUP BY c), cq AS (SELECT label AS c, count(*) AS n, avg(list_dot_product(vec, vec)) AS q FROM emb GROUP BY label), ds AS (SELECT cell_id, label, c, n, list_dot_product(vec, vec) + q - 2 * list_dot_product(vec, m) AS d FROM emb, cv JOIN cq USING (c)), ab AS (SELECT cell_id, max(CASE WHEN c = label AND n > 1 THEN d * n / (n - 1) END) AS a, min(CASE WHEN c <> label THEN d END) AS b FROM ds GROUP BY cell_id)"


@query("silhouette_fast", f"WITH {EMB}, {SQUARED} SELECT count(*) AS n, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM ab")
def silhouette_fast(s, d):
    return rounded(emb(s, d).agg(F.count("*").alias("n")).withColumn("silhouette", F.lit(embed.silhouette_fast(emb(s, d), "label"))), "silhouette")


@query("batch_asw", f"WITH {EMB}, {SIL.format(k='batch')} SELECT round(avg(silhouette), 5) AS batch_asw FROM sl")
def batch_asw(s, d):
    return rounded(embed.silhouette(emb(s, d), "batch").agg(F.avg("silhouette").alias("batch_asw")), "batch_asw", digits=5)


@query("asw_bands", f"WITH {EMB}, {SIL.format(k='label')} SELECT CASE WHEN silhouette < 0.25 THEN 'poor' WHEN silhouette < 0.5 THEN 'fair' WHEN silhouette < 0.7 THEN 'good' ELSE 'excellent' END AS band, count(*) AS n FROM sl GROUP BY 1")
def asw_bands(s, d):
    return embed.silhouette(emb(s, d), "label").groupBy(metrics.band(F.col("silhouette")).alias("band")).agg(F.count("*").alias("n"))


@query("graph_connectivity", f"{KNN} SELECT round(avg(s), 6) AS graph_connectivity FROM (SELECT src, avg(CASE WHEN a.label = b.label THEN 1.0 ELSE 0.0 END) AS s FROM nn JOIN emb a ON a.cell_id = src JOIN emb b ON b.cell_id = dst GROUP BY src)")
def graph_connectivity(s, d):
    return rounded(metrics.connectivity(edges(s, d), emb(s, d), "label"), "graph_connectivity")


@query("batch_entropy", f"{KNN}, c AS (SELECT src, batch, count(*) AS n FROM nn JOIN emb ON cell_id = dst GROUP BY ALL) SELECT round(avg(h) / ln((SELECT count(DISTINCT batch) FROM emb)), 6) AS batch_entropy FROM (SELECT src, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM c GROUP BY src)")
def batch_entropy(s, d):
    return rounded(metrics.batch_entropy(edges(s, d), emb(s, d), "batch"), "batch_entropy")


@query("lisi", f"{KNN}, c AS (SELECT src, batch, count(*) AS n FROM nn JOIN emb ON cell_id = dst GROUP BY ALL) SELECT round(avg(h), 6) AS lisi FROM (SELECT src, sum(n) * sum(n) / sum(n * n) AS h FROM c GROUP BY src)")
def lisi(s, d):
    return rounded(metrics.lisi(edges(s, d), emb(s, d), "batch"), "lisi")


MAJOR = "se AS (SELECT src, dst FROM nn WHERE rank <= 14 UNION ALL SELECT cell_id, cell_id FROM emb), mc AS (SELECT src, b.label, count(*) AS n FROM se JOIN emb b ON b.cell_id = dst GROUP BY ALL), pr AS (SELECT a.label AS y_true, m.label AS y_pred FROM (SELECT src, arg_min(label, (-n, label)) AS label FROM mc GROUP BY src) m JOIN emb a ON a.cell_id = src), ct AS (SELECT y_true, y_pred, count(*) AS n FROM pr GROUP BY ALL), ra AS (SELECT y_true, sum(n) AS n FROM ct GROUP BY 1), rb AS (SELECT y_pred, sum(n) AS n FROM ct GROUP BY 1)"
NMI = "SELECT (ha + hb - hc) / ((ha + hb) / 2) AS nmi FROM (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS hc FROM ct), (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS ha FROM ra), (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) AS hb FROM rb)"
BIO = f"{KNN}, {SIL.format(k='label')}, {MAJOR}, bio AS (SELECT (((SELECT avg(silhouette) FROM sl) + 1) / 2 + nmi) / 2 AS bio_conservation FROM ({NMI}))"


@query("bio_conservation", f"{BIO} SELECT round(bio_conservation, 5) AS bio_conservation FROM bio")
def bio_conservation(s, d):
    e = checkpoint(emb(s, d))
    near = checkpoint(embed.knn(e, 15, with_self=True))
    return rounded(metrics.bio_conservation(e, near, "label"), "bio_conservation", digits=5)


@query("integration_metrics", f"{BIO}, sb AS (SELECT x.cell_id, x.batch AS own, y.batch AS other, sum(CASE WHEN x.cell_id = y.cell_id THEN 0 ELSE list_distance(x.vec, y.vec) END) AS s, count(*) AS n FROM emb x, emb y GROUP BY ALL), ba AS (SELECT avg((b - a) / greatest(a, b)) AS batch_asw FROM (SELECT cell_id, max(CASE WHEN own = other THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM sb GROUP BY ALL)), gc AS (SELECT avg(s) AS graph_connectivity FROM (SELECT src, avg(CASE WHEN a.label = b.label THEN 1.0 ELSE 0.0 END) AS s FROM nn JOIN emb a ON a.cell_id = src JOIN emb b ON b.cell_id = dst GROUP BY src)) SELECT round(bio_conservation, 5) AS bio_conservation, round(graph_connectivity, 5) AS graph_connectivity, round(batch_asw, 5) AS batch_asw, round(0.333 * bio_conservation + 0.333 * graph_connectivity + 0.334 * (batch_asw + 1) / 2, 5) AS score FROM bio, gc, ba")
def integration_metrics(s, d):
    e = checkpoint(emb(s, d))
    near = checkpoint(embed.knn(e, 15))  # one search for both metrics of the graph
    mean = checkpoint(metrics.mean_silhouettes(e, {"silhouette": "label", "batch_asw": "batch"}))  # and one pass for both silhouettes
    row = metrics.bio_conservation(e, embed.add_self(near, e), "label", mean).crossJoin(metrics.connectivity(near, e, "label")).crossJoin(mean.select("batch_asw"))  # one row each
    return rounded(metrics.composite(row, metrics.INTEGRATION_WEIGHTS, rescale=("batch_asw",)), "bio_conservation", "graph_connectivity", "batch_asw", "score", digits=5)


CENTRES = "lo AS (SELECT cell_id, label, unnest(range(64)) AS dim, unnest(vec) AS x FROM emb), ce AS (SELECT label, dim, avg(x) AS c, count(*) AS n FROM lo GROUP BY ALL)"


@query("davies_bouldin", f"WITH {EMB}, {CENTRES}, sp AS (SELECT label, avg(d) AS s FROM (SELECT cell_id, label, sqrt(sum((x - c) * (x - c))) AS d FROM lo JOIN ce USING (label, dim) GROUP BY ALL) GROUP BY label), md AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m FROM ce a JOIN ce b USING (dim) WHERE a.label <> b.label GROUP BY ALL) SELECT round(avg(r), 6) AS davies_bouldin FROM (SELECT i, max((p.s + q.s) / m) AS r FROM md JOIN sp p ON p.label = i JOIN sp q ON q.label = j GROUP BY i)")
def davies_bouldin(s, d):
    return rounded(metrics.davies_bouldin(emb(s, d), "label"), "davies_bouldin")


@query("calinski_harabasz", f"WITH {EMB}, {CENTRES}, g AS (SELECT dim, avg(x) AS g FROM lo GROUP BY dim) SELECT round((SELECT sum(n * (c - g) * (c - g)) FROM ce JOIN g USING (dim)) / (k - 1) / ((SELECT sum((x - c) * (x - c)) FROM lo JOIN ce USING (label, dim)) / (n - k)), 5) AS calinski_harabasz FROM (SELECT count(*) AS n, count(DISTINCT label) AS k FROM emb)")
def calinski_harabasz(s, d):
    return rounded(metrics.calinski_harabasz(emb(s, d), "label"), "calinski_harabasz", digits=5)


@query("modularity", f"{KNN}, e AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v FROM nn), j AS (SELECT a.label AS a, b.label AS b FROM e JOIN emb a ON a.cell_id = u JOIN emb b ON b.cell_id = v), dg AS (SELECT sum(d * d) AS dd FROM (SELECT count(*) AS d FROM (SELECT a AS c FROM j UNION ALL SELECT b FROM j) GROUP BY c)) SELECT round(i / m - dd / (4 * m * m), 6) AS modularity FROM dg, (SELECT CAST(count(*) AS DOUBLE) AS m, sum(CASE WHEN a = b THEN 1.0 ELSE 0.0 END) AS i FROM j)")
def modularity(s, d):
    return rounded(embed.modularity(edges(s, d), emb(s, d), "label"), "modularity")


@query("graph_communities")
def graph_communities(s, d):
    return embed.communities(edges(s, d))


@query("graph_clusters")
def graph_clusters(s, d):
    return communities.find(edges(s, d))


@query("cluster_counts")
def cluster_counts(s, d):
    return communities.counts(communities.find(edges(s, d)))


@query("pca_embed")
def pca_embed(s, d):
    return embed.pca(emb(s, d), 10)[0]


@query("pca_expression")
def pca_expression(s, d):
    """Of the normalised matrix of all cells and genes."""
    return sparse_pca.components(normalize.log_normalize(expr(s, d)), cells(s, d), 20)[0]


@query("pca_expression_variance")
def pca_expression_variance(s, d):
    shares = sparse_pca.components(normalize.log_normalize(expr(s, d)), cells(s, d), 20)[1]
    return s.createDataFrame(list(enumerate(shares)), "component int, share double")


@query("batch_mean_shift", f"WITH {EMB}, lo AS (SELECT cell_id, batch, unnest(range(64)) AS dim, unnest(vec) AS x FROM emb), b AS (SELECT batch, dim, avg(x) AS b FROM lo GROUP BY ALL), g AS (SELECT dim, avg(x) AS g FROM lo GROUP BY dim) SELECT cell_id, dim, round(x + g - b, 6) AS x FROM lo JOIN b USING (batch, dim) JOIN g USING (dim)")
def batch_mean_shift(s, d):
    return rounded(embed.batch_shift(emb(s, d), "batch").select("cell_id", F.posexplode("vec").alias("dim", "x")), "x")


def modalities(s, d) -> dict[str, DataFrame]:
    e = emb(s, d)
    part = lambda a, n: e.select("cell_id", F.slice("vec", a, n).alias("vec"))
    return {"genomics": part(33, 16), "clinical": part(1, 32), "imaging": part(49, 8).where("cell_id <> 3")}


@query("fuse_concat", f"WITH {EMB} SELECT cell_id, dim, round(x, 6) AS x FROM (SELECT cell_id, unnest(range(56)) AS dim, unnest(list_concat(list_concat(vec[1:32], vec[33:48]), vec[49:56])) AS x FROM emb WHERE cell_id <> 3)")
def fuse_concat(s, d):
    return rounded(embed.fuse_concat(modalities(s, d)).select("cell_id", F.posexplode("vec").alias("dim", "x")), "x")


@query("fuse_attention", f"""WITH {EMB}, v AS (SELECT cell_id, vec[1:32] AS a, list_concat(vec[33:48], list_transform(range(16), lambda k: 0.0)) AS b, list_concat(vec[49:56], list_transform(range(24), lambda k: 0.0)) AS c FROM emb WHERE cell_id <> 3),
n AS (SELECT *, sqrt(list_sum(list_transform(a, lambda k: k * k))) AS na, sqrt(list_sum(list_transform(b, lambda k: k * k))) AS nb, sqrt(list_sum(list_transform(c, lambda k: k * k))) AS nc FROM v), w AS (SELECT *, exp(na) + exp(nb) + exp(nc) AS t FROM n)
SELECT cell_id, dim, round((x * exp(na) + y * exp(nb) + z * exp(nc)) / t, 6) AS x FROM (SELECT *, unnest(range(32)) AS dim, unnest(a) AS x, unnest(b) AS y, unnest(c) AS z FROM w)""")
def fuse_attention(s, d):
    return rounded(embed.fuse_attention(modalities(s, d)).select("cell_id", F.posexplode("vec").alias("dim", "x")), "x")


FILLED = "fi AS (SELECT cell_id, [vec[1:32], list_concat(vec[33:48], list_transform(range(16), lambda k: 0.0)), list_concat(vec[49:56], list_transform(range(24), lambda k: 0.0))] AS v FROM emb WHERE cell_id <> 3), ml AS (SELECT cell_id, i, (v[1][i + 1] + v[2][i + 1] + v[3][i + 1]) / 3 AS x FROM fi, range(32) r(i)), hi AS (SELECT cell_id, j, greatest(sum(x * cos(i * (1 + j))), 0) AS h FROM ml, range(8) r(j) GROUP BY ALL), ga AS (SELECT cell_id, k, sum(h * sin(j * (1 + k))) AS z FROM hi, range(3) r(k) GROUP BY ALL), so AS (SELECT cell_id, k, exp(z - max(z) OVER (PARTITION BY cell_id)) AS e FROM ga), ws AS (SELECT cell_id, list(e / t ORDER BY k) AS w FROM (SELECT *, sum(e) OVER (PARTITION BY cell_id) AS t FROM so) GROUP BY cell_id)"


@query("fuse_moe_apply", f"WITH {EMB}, {FILLED} SELECT cell_id, CAST(i AS INTEGER) AS dim, round(v[1][i + 1] * w[1] + v[2][i + 1] * w[2] + v[3][i + 1] * w[3], 6) AS x FROM fi JOIN ws USING (cell_id), range(32) r(i)")
def fuse_moe_apply(s, d):
    i = np.arange(32)
    fused = embed.fuse_moe(modalities(s, d), np.cos(i[:, None] * (1 + np.arange(8))), np.sin(np.arange(8)[:, None] * (1 + np.arange(3))))
    return rounded(fused.select("cell_id", F.posexplode("vec").alias("dim", "x")), "x")


@query("label_transfer", f"{KNN}, l AS (SELECT cell_id, CASE WHEN cell_id % 4 = 0 THEN 'Unknown' ELSE CAST(label AS VARCHAR) END AS label FROM emb), c AS (SELECT src, label, count(*) AS n FROM nn JOIN l ON cell_id = dst WHERE label <> 'Unknown' GROUP BY ALL), b AS (SELECT src, arg_min(label, (-n, label)) AS best, max(n) / sum(n) AS share FROM c GROUP BY src) SELECT cell_id, CASE WHEN label <> 'Unknown' THEN label ELSE coalesce(best, 'Unknown') END AS predicted, round(CASE WHEN label <> 'Unknown' THEN 1 ELSE coalesce(share, 0) END, 6) AS confidence FROM l LEFT JOIN b ON src = cell_id")
def label_transfer(s, d):
    labels = emb(s, d).select("cell_id", F.when(F.pmod("cell_id", F.lit(4)) == 0, "Unknown").otherwise(F.col("label").cast("string")).alias("label"))
    return rounded(embed.transfer_labels(edges(s, d), labels, "label"), "confidence")


@query("label_propagation")
def label_propagation(s, d):
    """From a tenth of the labels to all points that they reach."""
    labels = emb(s, d).select("cell_id", F.when(F.pmod("cell_id", F.lit(10)) > 0, "Unknown").otherwise(F.col("label").cast("string")).alias("label"))
    return embed.propagate_labels(checkpoint(edges(s, d)), labels, "label")


@query("evaluate_all")
def evaluate_all(s, d):
    e = emb(s, d).withColumn("pred", F.when(F.pmod("cell_id", F.lit(7)) == 0, "").otherwise(F.pmod("label", F.lit(4)).cast("string")))
    e = checkpoint(e)
    return metrics.evaluate(e, checkpoint(embed.knn(e, 15)), "label", "pred", "batch")
