"""Evaluation metrics. Label metrics come from one contingency table; geometric ones from blocks of distances."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cellgrain.model import ratio
from cellgrain.operators import embed
from cellgrain.sources.layers import checkpoint


def contingency(df: DataFrame, true: str, pred: str) -> DataFrame:
    return df.groupBy(F.col(true).alias("y_true"), F.col(pred).alias("y_pred")).agg(F.count("*").alias("n"))


def pairs_of(c: Column) -> Column:
    n = c.cast("double")
    return n * (n - 1) / 2


def label_sums(table: DataFrame) -> DataFrame:
    """One row of sums over cells, rows and columns of a contingency table."""
    part = lambda key, name: table.groupBy(key).agg(F.sum("n").alias("n")).agg(F.sum(pairs_of(F.col("n"))).alias(f"p{name}"), F.sum(F.col("n") * F.log("n")).alias(f"e{name}"), F.count("*").alias(f"k{name}"))
    cells = table.agg(F.sum(pairs_of(F.col("n"))).alias("pc"), F.sum(F.col("n") * F.log("n")).alias("ec"), F.sum("n").cast("double").alias("n"), F.count("*").alias("kc"))
    return cells.crossJoin(part("y_true", "a")).crossJoin(part("y_pred", "b"))  # one row each


def ari(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Adjusted Rand index; 1 where both partitions are equal and trivial."""
    s = label_sums(contingency(df, true, pred))
    expected = F.col("pa") * F.col("pb") / pairs_of(F.col("n"))
    top = (F.col("pa") + F.col("pb")) / 2
    return s.select(F.coalesce(ratio(F.col("pc") - expected, top - expected), F.lit(1.0)).alias("ari"))


def nmi(df: DataFrame, true: str, pred: str) -> DataFrame:
    """Mutual information over the mean of both entropies; 1 for one cluster on both sides."""
    s = label_sums(contingency(df, true, pred))
    n = F.col("n")
    ha, hb, hc = (F.log(n) - F.col(f"e{k}") / n for k in "abc")
    mutual = F.greatest(ha + hb - hc, F.lit(0.0))
    return s.select(F.when((F.col("ka") <= 1) & (F.col("kb") <= 1), 1.0).otherwise(F.coalesce(ratio(F.when(mutual < 1e-12, 0.0).otherwise(mutual), (ha + hb) / 2), F.lit(0.0))).alias("nmi"))


def report(df: DataFrame, true: str, pred: str) -> DataFrame:
    """One row: accuracy, mean recall over the true classes, and F1 weighted by support (0 where undefined)."""
    t = contingency(df, true, pred)
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)
    row = t.groupBy("y_true").agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    col = t.groupBy(F.col("y_pred").alias("y_true")).agg(F.sum("n").alias("called"))
    j = row.join(col, "y_true", "left").fillna(0)
    f1 = 2 * F.col("tp") / (F.col("support") + F.col("called"))
    total = F.sum("support")
    return j.agg((F.sum("tp") / total).alias("accuracy"), F.avg(F.col("tp") / F.col("support")).alias("balanced_accuracy"), (F.sum(f1 * F.col("support")) / total).alias("f1_weighted"))


def confusion(df: DataFrame, true: str, pred: str, labels: list) -> DataFrame:
    """A column a predicted label."""
    return df.groupBy(F.col(true).alias("y_true")).pivot(pred, labels).count().fillna(0)


def rare_recall(df: DataFrame, true: str, pred: str, types: DataFrame) -> DataFrame:
    """Recall of each listed type, 0 where no row has it."""
    hits = df.groupBy(F.col(true).cast("string").alias("cell_type")).agg(F.avg(F.when(F.col(true).cast("string") == F.col(pred).cast("string"), 1.0).otherwise(0.0)).alias("recall"))
    return types.select(F.col("cell_type").cast("string")).join(hits, "cell_type", "left").fillna(0.0, ["recall"])


def composite(row: DataFrame, weights: dict[str, float], out: str = "score", rescale: tuple[str, ...] = ()) -> DataFrame:
    """Adds the weighted sum of metric columns over the weights of those that are known; ``rescale`` maps [-1, 1] to
    [0, 1] first."""
    value = lambda k: (F.col(k) + 1) / 2 if k in rescale else F.col(k)
    top = reduce(lambda a, b: a + b, (F.coalesce(value(k) * w, F.lit(0.0)) for k, w in weights.items()))
    below = reduce(lambda a, b: a + b, (F.when(F.col(k).isNotNull(), w).otherwise(0.0) for k, w in weights.items()))
    return row.withColumn(out, ratio(top, below))


ANNOTATION_WEIGHTS = {"ari": 0.5, "nmi": 0.5}
INTEGRATION_WEIGHTS = {"bio_conservation": 0.333, "graph_connectivity": 0.333, "batch_asw": 0.334}


def band(score: Column) -> Column:
    """Quality bands of a silhouette."""
    return F.when(score < 0.25, "poor").when(score < 0.5, "fair").when(score < 0.7, "good").when(score.isNotNull(), "excellent")


def connectivity(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Mean share of a point's neighbours (itself excluded) with its label."""
    j = label_edges(edges.where("src <> dst"), labels, label)
    return j.groupBy("src").agg(F.avg((F.col("a") == F.col("b")).cast("double")).alias("s")).agg(F.avg("s").alias("graph_connectivity"))


def label_edges(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    a = labels.select(F.col("cell_id").alias("src"), F.col(label).alias("a"))
    b = labels.select(F.col("cell_id").alias("dst"), F.col(label).alias("b"))
    return edges.join(a, "src").join(b, "dst")


def batch_entropy(edges: DataFrame, labels: DataFrame, batch: str) -> DataFrame:
    """Mean entropy of the batches among a point's neighbours, over that of all batches being equal."""
    n = labels.agg(F.count_distinct(batch).alias("_k"))
    j = label_edges(edges.where("src <> dst"), labels, batch).groupBy("src", "b").agg(F.count("*").alias("n"))
    h = j.groupBy("src").agg((F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("h"))
    return h.agg(F.avg("h").alias("_h")).crossJoin(F.broadcast(n)).select(F.when(F.col("_k") > 1, F.col("_h") / F.log("_k")).otherwise(0.0).alias("batch_entropy"))


def lisi(edges: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Mean inverse Simpson index of a label among a point's neighbours."""
    j = label_edges(edges.where("src <> dst"), labels, label).groupBy("src", "b").agg(F.count("*").alias("n"))
    s = j.groupBy("src").agg((F.sum("n") * F.sum("n") / F.sum(F.col("n") * F.col("n"))).alias("s"))
    return s.agg(F.avg("s").alias("lisi"))


def mean_silhouettes(emb: DataFrame, labels: dict[str, str]) -> DataFrame:
    """One row: by name the mean silhouette of a column, all from one pass over the pairs."""
    s = embed.silhouettes(emb, sorted(set(labels.values())))
    return s.agg(*(F.avg(F.when(F.col("column") == c, F.col("silhouette"))).alias(name) for name, c in labels.items()))


def bio_conservation(emb: DataFrame, edges_with_self: DataFrame, label: str, silhouette: DataFrame | None = None) -> DataFrame:
    """Mean of the silhouette (a row with ``silhouette`` where it is known), rescaled, and the NMI of labels with the majority
    label of the neighbours, the point itself among them."""
    sil = (embed.silhouette(emb, label).agg(F.avg("silhouette").alias("silhouette")) if silhouette is None else silhouette).select(F.col("silhouette").alias("_s"))
    n = label_edges(edges_with_self, emb, label).groupBy("src", "a", "b").agg(F.count("*").alias("n"))
    major = n.groupBy("src", "a").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("b").alias("b"))).alias("m")).select("a", F.col("m.b").alias("b"))
    return sil.crossJoin(nmi(major, "a", "b")).select((((F.col("_s") + 1) / 2 + F.col("nmi")) / 2).alias("bio_conservation"))


def centroids(emb: DataFrame, label: str) -> DataFrame:
    """label, dim, centre, n."""
    return emb.select(label, F.posexplode("vec").alias("dim", "x")).groupBy(label, "dim").agg(F.avg("x").alias("centre"), F.count("*").alias("n"))


def davies_bouldin(emb: DataFrame, label: str) -> DataFrame:
    """Mean over clusters of the worst ratio of spreads to centre distance."""
    c = centroids(emb, label)
    whole = c.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "centre"))), lambda x: x["centre"]).alias("_c"))
    squares = F.zip_with("vec", "_c", lambda x, y: (x - y) * (x - y))
    d = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))
    spread = emb.join(F.broadcast(whole), label).groupBy(label).agg(F.avg(d).alias("s"))  # a row a cluster
    a = c.select(F.col(label).alias("i"), "dim", F.col("centre").alias("ci"))
    b = c.select(F.col(label).alias("j"), "dim", F.col("centre").alias("cj"))
    m = a.join(b, "dim").where("i <> j").groupBy("i", "j").agg(F.sqrt(F.sum(F.pow(F.col("ci") - F.col("cj"), F.lit(2.0)))).alias("m"))
    r = m.join(spread.select(F.col(label).alias("i"), F.col("s").alias("si")), "i").join(spread.select(F.col(label).alias("j"), F.col("s").alias("sj")), "j")
    return r.groupBy("i").agg(F.max((F.col("si") + F.col("sj")) / F.col("m")).alias("r")).agg(F.avg("r").alias("davies_bouldin"))


def calinski_harabasz(emb: DataFrame, label: str) -> DataFrame:
    """Spread between cluster centres over spread inside of clusters, by degrees of freedom. Sums only: one pass."""
    x = emb.select(label, F.posexplode("vec").alias("dim", "x")).groupBy(label, "dim").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"))
    dim = x.groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("b"), F.count("*").alias("k"))
    t = dim.agg(F.sum(F.col("b") - F.col("s") * F.col("s") / F.col("n")).alias("between"), F.sum(F.col("q") - F.col("b")).alias("within"), F.max("n").alias("n"), F.max("k").alias("k"))
    return t.select(ratio(F.col("between") * (F.col("n") - F.col("k")), F.col("within") * (F.col("k") - 1)).alias("calinski_harabasz"))


def evaluate(emb: DataFrame, edges: DataFrame, true: str, pred: str, batch: str) -> DataFrame:
    """metric, value of all metrics; rows without a prediction are left out of the label metrics."""
    known = emb.where(F.col(pred).isNotNull() & (F.col(pred).cast("string") != ""))
    rows = [ari(known, true, pred), nmi(known, true, pred), report(known, true, pred).select("f1_weighted", "balanced_accuracy"), connectivity(edges, emb, true), checkpoint(mean_silhouettes(emb, {"silhouette": true, "batch_asw": batch}))]
    long = [r.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in r.columns))).alias("e")).select("e.*") for r in rows]
    return reduce(DataFrame.unionByName, long)
