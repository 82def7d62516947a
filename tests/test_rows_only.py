"""Invariants of the queries without SQL."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from cellgrain.plans import catalogue

Q = catalogue.queries()


def test_hvg_v3_flags_the_asked_number(spark):
    assert Q["hvg_seurat_v3"](spark, SF).where("highly_variable").count() == 200


def test_doublet_scores_are_shares(spark):
    r = Q["doublet_score"](spark, SF).agg(F.min("score"), F.max("score"), F.count("*"), F.avg(F.col("doublet").cast("int"))).first()
    assert r[0] >= 0 and r[1] <= 1 and r[2] == 1500 and r[3] <= 0.06 + 1e-9


def test_preprocessing_drops_the_doublets_it_scores(spark):
    kept, plain = Q["preprocess_doublets"](spark, SF).count(), Q["preprocess_pipeline"](spark, SF).select("cell_id").distinct().count()
    assert 0.9 * plain < kept <= 1500


def test_approximate_neighbours_recall(spark):
    from cellgrain.operators import embed
    from cellgrain.plans.adapter import emb

    for sf in (SF, SF.replace("0.001", "0.1")):
        exact = embed.knn(emb(spark, sf), 15).where("src % 50 = 0")
        got = Q["knn_approx"](spark, sf)
        assert got.join(exact, ["src", "dst"]).count() >= 0.9 * exact.count()
        assert got.groupBy("src").count().where("count > 15").count() == 0 and got.where("src = dst").count() == 0


def test_approximate_neighbours_of_odd_tables(spark):
    from cellgrain.operators import embed

    schema = "cell_id long, vec array<double>"
    assert embed.knn_approx(spark.createDataFrame([], schema), 3).count() == 0
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema)  # one cell, three blocks
    assert {r["count"] for r in embed.knn_approx(same, 3, size=4).groupBy("src").count().collect()} == {3}


@pytest.mark.parametrize("n", [300, 6000])
def test_harmony_lowers_its_objective_and_keeps_labels(spark, n):
    """Three labels, two batches of unequal size, the second shifted: neighbours' batches mix, labels stay apart."""
    from cellgrain.operators.integrate import harmony_rounds

    rng = np.random.default_rng(n)
    label, batch = rng.integers(0, 3, n), (rng.random(n) < 0.3).astype(int)
    x = np.eye(3, 8)[label] * 6 + batch[:, None] * np.array([0, 0, 0, 3, 3, 0, 0, 0]) + rng.normal(0, 0.5, (n, 8))
    e = spark.createDataFrame([(i, int(b), v.tolist()) for i, (b, v) in enumerate(zip(batch, x, strict=True))], "cell_id long, batch int, vec array<double>")
    out, history = harmony_rounds(e, "batch", k=5)
    assert len(history) >= 2 and all(b <= a for a, b in zip(history, history[1:], strict=False))
    got = np.array([r["vec"] for r in out.orderBy("cell_id").collect()])

    def entropy(v):
        near = np.argsort(((v[:200, None] - v[None]) ** 2).sum(-1), axis=1)[:, 1:31]
        p = batch[near].mean(axis=1).clip(1e-9, 1 - 1e-9)
        return float(-(p * np.log(p) + (1 - p) * np.log(1 - p)).mean())

    def silhouette(v):
        d = np.sqrt(((v[:200, None] - v[None]) ** 2).sum(-1))
        mean = np.stack([d[:, label == c].mean(axis=1) for c in range(3)], axis=1)
        own = mean[np.arange(200), label[:200]]
        mean[np.arange(200), label[:200]] = np.inf
        return float(((mean.min(axis=1) - own) / np.maximum(own, mean.min(axis=1))).mean())

    assert entropy(x) < 0.05 and entropy(got) > 0.4
    assert silhouette(got) >= silhouette(x)


def test_harmony_of_odd_tables(spark):
    from cellgrain.operators.integrate import harmony_rounds

    empty = spark.createDataFrame([], "cell_id long, batch string, vec array<double>")
    assert harmony_rounds(empty, "batch")[0].count() == 0
    odd = spark.createDataFrame([(1, None, [0.0, 0.0], 9), (2, "a", [0.0, 0.0], 9), (2, "a", [0.0, 0.0], 9), (3, "b", [1.0, 2.0], 9)], "cell_id long, batch string, vec array<double>, block int")
    rows = harmony_rounds(odd, "batch", k=3)[0].collect()
    assert sorted(r["cell_id"] for r in rows) == [1, 2, 2, 3] and all(np.isfinite(r["vec"]).all() for r in rows)


def test_harmony_mixes_batches(spark):
    e = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 6.0 * (i % 2)], i % 2) for i in range(200)], "cell_id long, vec array<double>, batch int")
    from cellgrain.operators.integrate import harmony

    gap = lambda df: abs(df.groupBy("batch").agg(F.avg(F.col("vec")[2]).alias("m")).agg(F.max("m") - F.min("m")).first()[0])
    assert gap(harmony(e, "batch", k=3, rounds=4)) < 0.5 * gap(e)


def blobs(spark, n: int = 400):
    """Four well separated classes, and a key."""
    return spark.createDataFrame([(i, str(i % 4), [float(6 * (i % 4 == k)) + ((i * 37 + k * 11) % 17) / 17 for k in range(4)] + [0.5], i % 20) for i in range(n)], "cell_id long, label string, vec array<double>, patient_id long")


@pytest.mark.parametrize("kind", ["lr", "rf", "svm"])
def test_models_know_held_out_rows(spark, kind):
    from cellgrain.operators import models

    r = models.held_out(blobs(spark), kind)
    assert 70 <= r.count() <= 90
    assert r.agg(F.avg((F.col("label") == F.col("predicted")).cast("int"))).first()[0] > 0.95  # chance is 0.25


def test_ensemble_votes_over_its_models(spark):
    from cellgrain.operators import models

    r = models.held_out(blobs(spark, 200), "ensemble", rf={"numTrees": 10}).collect()
    assert all(x["predicted"] == (x["rf"] if x["rf"] == x["svm"] else x["lr"]) for x in r)
    assert sum(x["soft"] == x["label"] for x in r) > 0.95 * len(r)


def test_forest_importances_find_the_columns_that_tell(spark):
    from cellgrain.operators import models

    r = {x["feature"]: x["importance"] for x in models.importances(models.fit(blobs(spark), "rf", numTrees=20)).collect()}
    assert sum(r.values()) == pytest.approx(1) and r[4] < 0.01 < min(r[k] for k in range(4))


def test_grouped_split_keeps_groups_whole(spark):
    from cellgrain.operators import models

    df = blobs(spark)
    r = models.modeling_stage(df, "lr", group="patient_id").join(df.select("cell_id", "patient_id"), "cell_id")
    mixed = r.groupBy("patient_id").agg(F.count_distinct(F.col("predicted") == "").alias("k")).where("k > 1")
    assert mixed.count() == 0 and r.where("predicted <> ''").count() > 0


def test_perceptron_predicts_known_labels(spark):
    df = Q["fused_classify"](spark, SF)
    assert df.count() >= 90 and df.join(df.select(F.col("label").alias("predicted")).distinct(), "predicted", "left_anti").count() <= df.count() // 10


def test_modeling_stage_leaves_training_rows_blank(spark):
    r = Q["modeling_stage"](spark, SF).agg(F.count("*"), F.count_if(F.col("predicted") == "")).first()
    assert r[0] == 500 and 380 <= r[1] <= 420


def test_cross_validation_rows(spark):
    r = Q["cv_scores"](spark, SF).collect()
    assert len(r) == 10 and all(0 <= x["accuracy"] <= 1 for x in r)


def test_leaderboard_is_sorted(spark):
    v = [r["value"] for r in Q["benchmark_leaderboard"](spark, SF).collect()]
    assert v == sorted(v, reverse=True) and len(v) == 8


def test_moe_weights_sum_to_one(spark):
    from cellgrain.operators import embed
    from cellgrain.plans import vectors

    fused = embed.fuse_moe(vectors.modalities(spark, SF), np.ones((32, 4)), np.ones((4, 3)))
    r = fused.select(F.aggregate("weights", F.lit(0.0), lambda a, x: a + x).alias("s")).agg(F.min("s"), F.max("s")).first()
    assert r[0] == pytest.approx(1) and r[1] == pytest.approx(1)


def test_training_rows_alone_are_scaled_to_unit(spark):
    r = Q["fit_train_only"](spark, SF).where("k = 0").groupBy("batch").agg(F.avg("v").alias("m")).collect()
    m = {x["batch"]: abs(x["m"]) for x in r}
    assert m[0] < 1e-6 < m[1]


def test_storage(spark):
    r = Q["storage_info"](spark, SF).first()
    assert list(r["datasets"]) == ["a", "b"] and r["n_files"] >= 2 and r["bytes"] > 0


def test_remaining_queries_run(spark):
    for name in ("marker_score", "bootstrap_intervals", "pairwise_better", "evaluate_all", "graph_communities", "pca_embed", "silhouette_fast", "transfer_score", "fingerprint", "preprocess_pipeline", "harmony_correct"):
        assert Q[name](spark, SF).count() > 0


def test_text_sinks(spark, tmp_path):
    from cellgrain.sources import layers

    df = spark.range(5).withColumn("x", F.col("id") / 2)
    for kind in ("csv", "json"):
        layers.write_text(df, str(tmp_path / kind), kind)
        back = spark.read.option("header", True).option("inferSchema", True)
        assert (back.csv if kind == "csv" else back.json)(str(tmp_path / kind)).count() == 5
    with pytest.raises(ValueError):
        layers.write_text(df, str(tmp_path / "x"), "xml")
    with pytest.raises(ValueError):
        layers.write({"expr": df}, str(tmp_path), "nope", "a")


def test_triplet_folders(spark, tmp_path):
    from cellgrain.sources import ingest

    for s in ("A", "B", "C"):
        (tmp_path / s).mkdir()
        (tmp_path / s / "matrix.mtx").write_text("%%MatrixMarket\n%\n3 2 3\n1 1 5\n2 2 1\n3 2 7\n")
        (tmp_path / s / "barcodes.tsv").write_text("AAA\nCCC\n")
        (tmp_path / s / "features.tsv").write_text("E1\tG\nE2\tH\nE3\tG\n")
    # An entry in the last place that looks like the line of sizes.
    (tmp_path / "C" / "matrix.mtx").write_text("%%MatrixMarket\n3 2 2\n1 1 5\n3 2 2\n")
    got = sorted((r["cell_id"], r["gene_id"], r["value"]) for r in ingest.triplets(spark, str(tmp_path)).collect())
    assert got == [(f"{s}_{b}", g, v) for s in "AB" for b, g, v in (("AAA", "G", 5.0), ("CCC", "G-1", 7.0), ("CCC", "H", 1.0))] + [("C_AAA", "G", 5.0), ("C_CCC", "G-1", 2.0)]


def test_clinical_table_without_common_names(spark):
    from cellgrain.sources import ingest

    cells = spark.createDataFrame([("a",)], "sample_id string")
    assert ingest.attach_clinical(cells, spark.createDataFrame([("z", 1)], "sample_id string, age int")).columns == ["sample_id"]
    assert ingest.attach_clinical(cells, spark.createDataFrame([("a", 1)], "sample_id string, age int")).first()["age"] == 1


def test_lists_of_triplet_files_are_numbered_across_ranges_and_files(spark, tmp_path):
    from cellgrain.sources import ingest

    want = {}
    for sample, n in (("a", 2000), ("b", 3)):
        names = [f"{sample}{i:05d}" for i in range(n)]
        names[1] = ""  # a blank line has a number
        want |= {(sample, i + 1): x for i, x in enumerate(names)}
        (tmp_path / f"sample_id={sample}").mkdir()
        for part, rows in (("part-00000.txt", names[: n // 2]), ("part-00001.txt", names[n // 2 :])):
            (tmp_path / f"sample_id={sample}" / part).write_bytes("".join(f"{x}\r\n" for x in rows).encode().rstrip(b"\r\n" if part.endswith("1.txt") else b"") + (b" \n\n" if part.endswith("1.txt") else b""))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        read = spark.read.text(str(tmp_path), lineSep="\n").select("sample_id", F.input_file_name().alias("_path"), "value", "_metadata")
        found = {(r["sample_id"], r["c"]): r["text"] for r in ingest.listed(read, "c", ["sample_id"]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert {k: v for k, v in found.items() if k in want} == want
    assert not any(v.strip() for k, v in found.items() if k not in want)


def test_forest_is_fitted_a_few_trees_at_a_time(spark, monkeypatch):
    from cellgrain.operators import models

    rows = blobs(spark, 200)
    whole = {r["cell_id"]: r["predicted"] for r in models.held_out(rows, "rf", numTrees=10, maxDepth=6).collect()}
    sizes, grove = [], models.grove

    def counted(*args, **options):
        for model, n in grove(*args, **options):
            sizes.append((n, model.stages[-1].getNumTrees, model.stages[-1].totalNumNodes))
            yield model, n

    monkeypatch.setattr(models, "grove", counted)
    monkeypatch.setattr(models, "NODES", 300)
    r = models.held_out(rows, "rf", numTrees=11, maxDepth=6).collect()
    assert sum(n for n, _, _ in sizes) == 11 and all(n == t and n > 1 for n, t, _ in sizes) and len(sizes) > 1
    assert max(x for n, _, x in sizes if n > 3) <= 300 if any(n > 3 for n, _, _ in sizes) else True
    assert np.mean([x["predicted"] == whole[x["cell_id"]] for x in r]) > 0.9 and {x["cell_id"] for x in r} == set(whole)
    assert all(abs(sum(x["class_probability"]) - 1) < 1e-9 for x in r)
    got = models.cross_validate(rows, "rf", numTrees=4, maxDepth=4).collect()
    assert len(got) == 10 and {x["part"] for x in got} == {"train", "test"}


def test_fits_read_few_parts(spark):
    from cellgrain.operators import models

    rows = blobs(spark, 200).repartition(60)
    assert models.dealt_out(rows, label="label", key="cell_id", parts=3).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
