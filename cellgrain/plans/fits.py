"""Queries with fitted models, simulations, readers and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from cellgrain.operators import doublets, embed, folds, integrate as harmony, joins, models, preprocess, splits, trials
from cellgrain.plans.adapter import BASE, CELLS, cells, emb, expr, genes, table
from cellgrain.plans.expression import BOUNDS, KEPT, METRICS, GENE_METRICS, MIN_CELLS, rounded, variable
from cellgrain.plans.logs import rank_of
from cellgrain.plans.registry import query
from cellgrain.sources import ingest, layers, triplet_source


def root(s) -> str:
    """A new folder in the shared one."""
    return f"{layers.shared(s)}/layers/{uuid.uuid4().hex}"


@query("ingest_samples", f"{BASE} SELECT 'S' || batch AS sample_id, 'S' || batch || '_bc' || cell_id AS cell_id, 'G' || gene_id AS gene_id, value FROM expr JOIN cells USING (cell_id)")
def ingest_samples(s, d):
    """Counts written as triplet files by sample and read back."""
    x = layers.stored(expr(s, d).join(cells(s, d).select("cell_id", F.concat(F.lit("S"), "batch").alias("sample_id")), "cell_id"))
    here, coded, numbers = root(s), x, {}
    for k, c in (("c", "cell_id"), ("g", "gene_id")):  # from 1 in each sample, by range partitions
        places = joins.numbered(x.select("sample_id", c).distinct(), ["sample_id", c], "_at")
        first = places.groupBy("sample_id").agg(F.min("_at").alias("_first"))  # a row a sample
        numbers[k] = layers.stored(places.join(F.broadcast(first), "sample_id").select("sample_id", c, (F.col("_at") - F.col("_first") + 1).alias(k)))
        coded = coded.join(numbers[k], ["sample_id", c])
    coded = layers.stored(coded)
    size = coded.groupBy("sample_id").agg(F.concat_ws(" ", F.max("g"), F.max("c"), F.count("*")).alias("value"))
    entries = coded.select("sample_id", F.concat_ws(" ", "g", "c", F.col("value").cast("long")).alias("value"))
    # A list is files in the order of their names.
    in_order = lambda k, text: numbers[k].select("sample_id", k, text.alias("value")).repartitionByRange("sample_id", k).sortWithinPartitions("sample_id", k).select("sample_id", "value")
    bars, feats = in_order("c", F.concat(F.lit("bc"), "cell_id")), in_order("g", F.concat_ws("\t", F.concat(F.lit("ENS"), "gene_id"), F.concat(F.lit("G"), "gene_id")))
    for name, df in (("matrix", entries.unionByName(size)), ("barcodes", bars), ("features", feats)):
        df.write.partitionBy("sample_id").text(f"{here}/{name}")
    read = lambda name, *more: s.read.text(f"{here}/{name}", lineSep="\n").select(F.col("sample_id").cast("string"), "value", *more)
    lists = lambda name, out: ingest.listed(read(name, F.input_file_name().alias("_path"), "_metadata"), out, ["sample_id"])
    return ingest.put_together(read("matrix"), lists("barcodes", "c"), lists("features", "g"))


@query("clinical_join", f"WITH {CELLS} SELECT cell_id, patient_id, c_mktsegment AS segment, c_acctbal AS balance FROM cells LEFT JOIN customer ON patient_id = c_custkey")
def clinical_join(s, d):
    c = table(s, d, "customer").select(F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))
    return ingest.attach_clinical(cells(s, d).select("cell_id", "patient_id"), c, "patient_id").select("cell_id", "patient_id", "segment", "balance")


@query("merge_samples", f"{BASE} SELECT batch AS dataset, cell_id, gene_id, value FROM expr JOIN cells USING (cell_id)")
def merge_samples(s, d):
    """Samples come with their name as a column, so one pass tags all of them, however many there are."""
    return expr(s, d).join(cells(s, d).select("cell_id", F.col("batch").alias("dataset")), "cell_id").select("dataset", "cell_id", "gene_id", "value")


@query("concat_datasets", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS brand, 'customers' AS dataset FROM customer UNION ALL SELECT p_partkey, p_name, NULL, p_brand, 'parts' FROM part")
def concat_datasets(s, d):
    a = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    b = table(s, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    return ingest.concat_datasets({"customers": a, "parts": b})


@query("series_metadata", "WITH a AS (SELECT o_custkey AS series_id, o_orderkey AS ord, CASE WHEN o_orderstatus = 'F' THEN ' ' ELSE o_orderstatus END AS organism, o_orderpriority AS platform FROM orders) SELECT series_id, count(*) AS n_samples, arg_min(organism, ord) FILTER (trim(organism) <> '') AS organism, arg_min(platform, ord) AS platform FROM a GROUP BY series_id")
def series_metadata(s, d):
    o = table(s, d, "orders").select(F.col("o_custkey").alias("series_id"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "F", " ").otherwise(F.col("o_orderstatus")).alias("organism"), F.col("o_orderpriority").alias("platform"))
    return ingest.series_metadata(o)


@query("ingest_matrix", "SELECT CAST(c_custkey AS VARCHAR) AS gene_id, unnest(['balance', 'key', 'nation']) AS cell_id, unnest([c_acctbal, c_custkey, c_nationkey]) AS value FROM customer")
def ingest_matrix(s, d):
    """A delimited matrix written as text and read back; zeros aren't stored, so they are filled in for the SQL."""
    here = f"{root(s)}/matrix.tsv"
    c = table(s, d, "customer").select(F.col("c_custkey").cast("string").alias("gene"), F.col("c_acctbal").alias("balance"), F.col("c_custkey").cast("double").alias("key"), F.col("c_nationkey").cast("double").alias("nation"))
    c.write.option("sep", "\t").option("header", True).csv(here)
    long = ingest.wide_matrix(s, here)
    grid = c.select(F.col("gene").alias("gene_id"), F.explode(F.array(F.lit("balance"), F.lit("key"), F.lit("nation"))).alias("cell_id"))
    return grid.join(long, ["gene_id", "cell_id"], "left").fillna(0.0, ["value"]).select("cell_id", "gene_id", "value")


@query("storage_roundtrip", f"{BASE} SELECT cell_id, gene_id, value FROM expr")
def storage_roundtrip(s, d):
    here = root(s)
    layers.write({"expr": expr(s, d), "cells": cells(s, d)}, here, "standardized", "driver", max_rows=10_000)
    return layers.read(s, here, "standardized", "driver")


def as_triplets(s, d, samples=None):
    """Counts with their batch as sample, written to the library's own source and read back."""
    x = expr(s, d).join(cells(s, d).select("cell_id", F.col("batch").alias("sample_id")), "cell_id")
    here = root(s)
    triplet_source.write(x.select("sample_id", F.col("gene_id").cast("string"), F.col("cell_id").cast("string"), "value"), here)
    return triplet_source.read(s, here, samples)


TRIPLETS = "SELECT batch AS sample_id, CAST(gene_id AS VARCHAR) AS gene_id, CAST(cell_id AS VARCHAR) AS cell_id, value FROM expr JOIN cells USING (cell_id)"


@query("triplet_source", f"{BASE} {TRIPLETS}")
def triplet_roundtrip(s, d):
    return as_triplets(s, d)


@query("triplet_source_sample", f"{BASE} {TRIPLETS} WHERE batch IN ('F', 'P')")
def triplet_sample(s, d):
    """Two samples, whose files are the only ones read."""
    return as_triplets(s, d, ["F", "P"])


@query("storage_info")
def storage_info(s, d):
    here = root(s)
    for name, df in (("a", expr(s, d)), ("b", cells(s, d))):
        layers.write({"expr": df}, here, "raw", name)
    info = layers.storage_info(s, here, "raw")
    return info.crossJoin(layers.available(s, here, "raw").agg(F.array_sort(F.collect_list("dataset")).alias("datasets")))  # one row each


@query("doublet_score")
def doublet_score(s, d):
    return doublets.scores(expr(s, d), cells(s, d), variable(s, d, doublets.GENES))


@query("doublet_valley")
def doublet_valley(s, d):
    return doublets.call_by_valley(expr(s, d), cells(s, d))


@query("doublet_neighbours")
def doublet_neighbours(s, d):
    return doublets.call_by_share(expr(s, d), cells(s, d))


@query("doublet_consensus", f"WITH {CELLS} SELECT cell_id, batch = 'O' OR cell_type = '5-LOW' AS is_doublet FROM cells")
def doublet_consensus(s, d):
    calls = cells(s, d).select("cell_id", (F.col("batch") == "O").alias("scrublet"), (F.col("cell_type") == "5-LOW").alias("doubletfinder"))
    return doublets.consensus(calls).select("cell_id", "is_doublet")


@query("doublet_stats", f"WITH {CELLS} SELECT 'both' AS method, count(*) AS n_cells, count(*) FILTER (batch = 'O' AND cell_type = '5-LOW') AS n_doublets, round(100 * count(*) FILTER (batch = 'O' AND cell_type = '5-LOW') / count(*), 6) AS pct_doublets FROM cells")
def doublet_stats(s, d):
    calls = cells(s, d).select("cell_id", (F.col("batch") == "O").alias("scrublet"), (F.col("cell_type") == "5-LOW").alias("doubletfinder"))
    return rounded(doublets.consensus_stats(doublets.consensus(calls, require_both=True), "both"), "pct_doublets")


@query("preprocess_report", f"{BASE}, {METRICS}, {KEPT}, {GENE_METRICS} SELECT n_cells_before, n_cells_after, n_genes_before, n_genes_after, round(100 * n_cells_after / n_cells_before, 6) AS pct_cells_retained, 'qc,ambient,normalize,hvg,batch' AS steps FROM (SELECT count(*) AS n_cells_before FROM cells), (SELECT count(*) AS n_cells_after FROM kept), (SELECT count(*) AS n_genes_before, count(*) FILTER (n_cells_by_counts >= {MIN_CELLS}) AS n_genes_after FROM gm)")
def preprocess_report(s, d):
    _, report = preprocess.run(expr(s, d), cells(s, d), genes(s, d), BOUNDS, MIN_CELLS, report_only=True)
    return rounded(report, "pct_cells_retained").withColumn("steps", F.array_join("steps", ","))


CORRECTED = f"""co AS (SELECT expr.* FROM expr SEMI JOIN kept USING (cell_id) WHERE gene_id IN (SELECT gene_id FROM gm WHERE n_cells_by_counts >= {MIN_CELLS})),
gt AS (SELECT gene_id, sum(value) AS t FROM co GROUP BY 1), sh AS (SELECT gene_id, t / (SELECT sum(t) FROM gt) AS share FROM gt), tp AS (SELECT gene_id FROM sh ORDER BY share DESC, gene_id LIMIT 100),
rh AS (SELECT cell_id, sum(value) AS total, least(coalesce(sum(value) FILTER (gene_id IN (SELECT gene_id FROM tp)), 0) / sum(value), 0.9) AS rho FROM co GROUP BY 1),
am AS (SELECT cell_id, gene_id, value - share * total * rho AS value FROM co JOIN sh USING (gene_id) JOIN rh USING (cell_id) WHERE value - share * total * rho > 0)"""


@query("preprocess_pipeline", f"{BASE}, {METRICS}, {KEPT}, {GENE_METRICS}, {CORRECTED} SELECT cell_id, gene_id, round(ln(1 + value * 10000 / sum(value) OVER (PARTITION BY cell_id)), 6) AS value FROM am")
def preprocess_pipeline(s, d):
    tables, _ = preprocess.run(expr(s, d), cells(s, d), genes(s, d), BOUNDS, MIN_CELLS)
    return rounded(tables["expr"], "value")


@query("preprocess_counts", f"{BASE}, {METRICS}, {KEPT}, {GENE_METRICS}, {CORRECTED} SELECT cell_id, gene_id, round(value, 6) AS value FROM am")
def preprocess_counts(s, d):
    """The pipeline's snapshot of counts, before normalisation."""
    tables, _ = preprocess.run(expr(s, d), cells(s, d), genes(s, d), BOUNDS, MIN_CELLS)
    return rounded(tables["counts"], "value")


@query("preprocess_doublets")
def preprocess_doublets(s, d):
    """Cells that the pipeline keeps when it scores doublets itself."""
    tables, _ = preprocess.run(expr(s, d), cells(s, d), genes(s, d), BOUNDS, MIN_CELLS, doublet_rate=0.06, n_hvg=doublets.GENES)
    return tables["cells"].select("cell_id", "patient_id", "sample_type")


@query("harmony_correct")
def harmony_correct(s, d):
    return harmony.integrate(emb(s, d).drop("label"), "batch", 20)[0]


@query("harmony_objective")
def harmony_objective(s, d):
    """A row a round, of which there are ten at most."""
    history = harmony.harmony_rounds(emb(s, d), "batch")[1]
    return s.createDataFrame(list(enumerate(history, 1)), "round int, objective double")


def labelled(s, d):
    return emb(s, d).withColumn("label", F.col("label").cast("string"))


@query("lr_classify")
def lr_classify(s, d):
    return models.held_out(labelled(s, d), "lr").select("cell_id", "label", "predicted", "class_probability")


@query("rf_classify")
def rf_classify(s, d):
    return models.held_out(labelled(s, d), "rf").select("cell_id", "label", "predicted", "class_probability")


@query("rf_importances")
def rf_importances(s, d):
    return models.forest_importances(labelled(s, d))


@query("svm_classify")
def svm_classify(s, d):
    return models.held_out(labelled(s, d), "svm").select("cell_id", "label", "predicted", "class_probability")


@query("ensemble_classify")
def ensemble_classify(s, d):
    return models.held_out(labelled(s, d), "ensemble").select("cell_id", "label", "lr", "rf", "svm", "predicted", "soft")


@query("cv_scores")
def cv_scores(s, d):
    return models.cross_validate(labelled(s, d), "lr")


@query("cv_scores_forest")
def cv_scores_forest(s, d):
    return models.cross_validate(labelled(s, d), "rf")


@query("cv_scores_margins")
def cv_scores_margins(s, d):
    return models.cross_validate(labelled(s, d), "svm")


@query("cv_one_pass")
def cv_one_pass(s, d):
    return folds.cross_validate(labelled(s, d), "lr")


@query("cv_one_pass_margins")
def cv_one_pass_margins(s, d):
    return folds.cross_validate(labelled(s, d), "svm")


@query("cv_out_of_fold")
def cv_out_of_fold(s, d):
    return folds.out_of_fold(folds.fit(labelled(s, d), "lr"))


DEALT = f"dealt AS (SELECT CAST(({rank_of('vec_id', 'label')} - 1) % 5 AS INTEGER) AS fold, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), long AS (SELECT fold, unnest(v) AS v, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS k FROM dealt)"


@query("cv_fold_scalers", f"WITH {DEALT} SELECT held.fold, k, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS deviation FROM (SELECT DISTINCT fold FROM dealt) held JOIN long ON long.fold <> held.fold GROUP BY held.fold, k")
def cv_fold_scalers(s, d):
    """What each fold's model scales by: its training rows' moments, from one pass for all folds."""
    return rounded(folds.scalers(folds.fit(labelled(s, d), "lr", passes=0)), "mean", "deviation")


@query("modeling_stage")
def modeling_stage(s, d):
    return models.modeling_stage(labelled(s, d), "lr")


@query("modeling_stage_grouped")
def modeling_stage_grouped(s, d):
    x = labelled(s, d).withColumn("patient_id", F.pmod("cell_id", F.lit(40)))
    return models.modeling_stage(x, "lr", group="patient_id")


@query("fused_classify")
def fused_classify(s, d):
    x = labelled(s, d)
    fused = embed.fuse_concat({"a": x.select("cell_id", F.slice("vec", 1, 32).alias("vec")), "b": x.select("cell_id", F.slice("vec", 33, 32).alias("vec"))})
    return models.fused_classify(fused.join(x.select("cell_id", "label"), "cell_id"), maxIter=100).select("cell_id", "label", "predicted")


@query("benchmark_leaderboard")
def benchmark_leaderboard(s, d):
    return models.benchmark(labelled(s, d))


@query("transfer_score")
def transfer_score(s, d):
    x = labelled(s, d)
    return models.transfer_score(models.fit(x.where("batch = 0"), "lr"), x.where("batch = 1"))


FOLDS = "x AS (SELECT vec_id AS cell_id, CAST(vec_id % 2 AS INTEGER) AS batch, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS k FROM embeddings)"


@query("fit_train_only", f"WITH {FOLDS}, f AS (SELECT k, avg(v) AS m, stddev_samp(v) AS sd FROM x WHERE batch = 0 GROUP BY k) SELECT cell_id, batch, CAST(k - 1 AS INTEGER) AS k, round(CASE WHEN sd > 0 THEN (v - m) / sd ELSE 0 END, 6) AS v FROM x JOIN f USING (k)")
def fit_train_only(s, d):
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    x = emb(s, d).select("cell_id", "batch", array_to_vector("vec").alias("v"))
    both = splits.fit_on_train([StandardScaler(inputCol="v", outputCol="z", withMean=True)], x.where("batch = 0"), x.where("batch = 1"))
    return rounded(trials.union_all([b.select("cell_id", "batch", F.posexplode(vector_to_array("z")).alias("k", "v")) for b in both]), "v")


PRED = "pr AS (SELECT vec_id AS cell_id, CAST(label AS VARCHAR) AS lr, CAST((label + vec_id) % 3 AS VARCHAR) AS rf, CAST(vec_id % 3 AS VARCHAR) AS svm FROM embeddings)"


@query("ensemble_vote", f"WITH {PRED} SELECT cell_id, CASE WHEN rf = svm THEN rf ELSE lr END AS predicted FROM pr")
def ensemble_vote(s, d):
    v, e = F.col, table(s, d, "embeddings")
    text = lambda c: c.cast("string")
    return e.select(v("vec_id").alias("cell_id"), models.hard_vote(text(v("label")), text(F.pmod(v("label") + v("vec_id"), F.lit(3))), text(F.pmod(v("vec_id"), F.lit(3)))).alias("predicted"))


@query("ensemble_soft_vote", "SELECT vec_id AS cell_id, k, round((v[k + 1] + v[k + 11]) / 2, 6) AS p FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, unnest(range(10)) AS k FROM embeddings)")
def ensemble_soft_vote(s, d):
    e = emb(s, d).select("cell_id", models.soft_vote(F.slice("vec", 1, 10), F.slice("vec", 11, 10)).alias("p"))
    return rounded(e.select("cell_id", F.posexplode("p").alias("k", "p")), "p")
