"""Labelling of cells by a stored linear reference model, a table (label, gene_id, weight) whose rows without a gene are
intercepts. Genes are matched by name; scores are sparse products, so genes that a cell or the query lacks add nothing."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from cellgrain.operators import annotate, communities, embed
from cellgrain.operators.joins import lookup, numbered
from cellgrain.sources.layers import checkpoint


def train(expr: DataFrame, cells: DataFrame, label: str, genes: DataFrame, ridge: float = 0.01, rounds: int = 100) -> DataFrame:
    """The model's table, by multinomial logistic regression over the given genes (gene_id: a chosen set, of a size for
    dense rows, such as variable genes). Cells without a label or without counts of these genes aren't used."""
    at = checkpoint(numbered(genes.select("gene_id").distinct(), ["gene_id"]))
    names = [r["gene_id"] for r in at.orderBy("at").collect()]  # the chosen genes
    x = lookup(expr, at, ["gene_id"], ["cell_id"], "inner").groupBy("cell_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), lambda i: F.coalesce(F.try_element_at("m", i.cast("long")), F.lit(0.0)).cast("double"))
    rows = x.join(cells.where(F.col(label).isNotNull()).select("cell_id", F.col(label).alias("_l")), "cell_id").select(array_to_vector(dense).alias("features"), "_l")
    rows = checkpoint(rows)
    index = StringIndexer(inputCol="_l", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    fitted = LogisticRegression(family="multinomial", regParam=ridge, maxIter=rounds).fit(index.transform(rows))
    weights, starts = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    table = [(name, None, float(starts[k])) for k, name in enumerate(index.labels)] + [(name, g, float(w)) for k, name in enumerate(index.labels) for g, w in zip(names, weights[k], strict=True)]
    return expr.sparkSession.createDataFrame(table, f"label string, gene_id {dict(expr.dtypes)['gene_id']}, weight double")


def scored(expr: DataFrame, cells: DataFrame, model: DataFrame) -> DataFrame:
    """cell_id, _all (label and score of every label), _top (the largest score), _sum (of exp(score - _top))."""
    labels = [r[0] for r in model.select("label").distinct().orderBy("label").collect()]  # a row a label
    by_gene = model.where("gene_id IS NOT NULL").groupBy("gene_id").agg(*(F.sum(F.when(F.col("label") == name, F.col("weight")).otherwise(0.0)).alias(f"_w{k}") for k, name in enumerate(labels)))
    start = {r["label"]: r["w"] for r in model.where("gene_id IS NULL").groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    met = lookup(expr, by_gene, ["gene_id"], ["cell_id"], "inner")
    sums = met.groupBy("cell_id").agg(*(F.sum(F.col("value") * F.col(f"_w{k}")).alias(f"_s{k}") for k in range(len(labels))))
    found = cells.select("cell_id").join(sums, "cell_id", "left")
    score = F.array(*(F.struct(F.lit(name).alias("label"), (F.coalesce(f"_s{k}", F.lit(0.0)) + start.get(name, 0.0)).alias("score")) for k, name in enumerate(labels)))
    rows = found.select("cell_id", score.alias("_all")).withColumn("_top", F.array_max(F.transform("_all", lambda e: e["score"])))
    return rows.withColumn("_sum", F.aggregate("_all", F.lit(0.0), lambda a, e: a + F.exp(e["score"] - F.col("_top"))))


def probabilities(expr: DataFrame, cells: DataFrame, model: DataFrame) -> DataFrame:
    """cell_id, label, score, probability (softmax over the labels): a row a cell and label. A cell without genes of the
    model has the intercepts' probabilities."""
    rows = scored(expr, cells, model).select("cell_id", "_top", "_sum", F.explode("_all").alias("e"))
    return rows.select("cell_id", "e.label", "e.score", (F.exp(F.col("e.score") - F.col("_top")) / F.col("_sum")).alias("probability"))


def predict(expr: DataFrame, cells: DataFrame, model: DataFrame) -> DataFrame:
    """cell_id, predicted (ties: the first by alphabet) and confidence, its probability. Scores whose exponentials agree to 12
    digits of the largest tie: sums of floats differ by their order."""
    share = lambda e: F.exp(e["score"] - F.col("_top"))
    best = F.array_min(F.transform("_all", lambda e: F.struct((-F.round(share(e), 12)).alias("v"), e["label"].alias("l"), (share(e) / F.col("_sum")).alias("p"))))
    told = scored(expr, cells, model).groupBy("cell_id").agg(F.min(best).alias("_b"))
    return told.select("cell_id", F.col("_b.l").alias("predicted"), F.col("_b.p").alias("confidence"))


def coverage(genes: DataFrame, model: DataFrame) -> DataFrame:
    """One row: the model's genes, and how many of them the query has."""
    known = model.where("gene_id IS NOT NULL").select("gene_id").distinct()
    return known.join(genes.select("gene_id").distinct().withColumn("_hit", F.lit(True)), "gene_id", "left").agg(F.count("*").alias("n_model_genes"), F.count("_hit").alias("n_found"))


def annotate_by_model(expr: DataFrame, cells: DataFrame, model: DataFrame, emb: DataFrame, k: int = 15, resolution: float = 5.0) -> DataFrame:
    """cell_id, predicted, confidence, over_cluster, majority_label: the model's labels, and their vote in fine
    communities of the neighbour graph. A cell outside of the graph is a cluster of its own."""
    own = predict(expr, cells, model)
    fine = communities.find(embed.knn(emb, k), (resolution,)).select("cell_id", F.col("community").alias("over_cluster"))
    joined = own.join(fine, "cell_id", "left").withColumn("over_cluster", F.coalesce("over_cluster", "cell_id"))
    return annotate.cluster_majority(joined, "over_cluster", "predicted")

