"""Exact quantiles, exact rank tests, communities and components against brute force."""

import itertools
import math

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from cellgrain.operators import communities, embed, joins, quantiles, sparse_pca, stats
from cellgrain.plans.adapter import emb


def test_quantiles_of_odd_columns(spark):
    """Nulls, ties, one value, no value, infinities, a null group, and every rank."""
    values = {"a": [3.0, 1.0, 2.0, 2.0, None], "b": [7.0], None: [1e300, -1e300, 0.0, 5e-324], "c": [None], "d": [float("inf"), 1.0, float("-inf"), 2.0], "e": [float(i % 10) for i in range(100)]}
    rows = [(g, x, None if x is None else -x) for g, v in values.items() for x in v]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    wanted = {f"{c}_{n}": (c, p) for c in "xy" for n, p in ps.items()}
    for bins in (2, 5, 4096):
        got = {r["g"]: r for r in quantiles.exact(df, wanted, ["g"], bins).collect()}
        assert set(got) == set(values)
        for g, v in values.items():
            for c, sign in (("x", 1), ("y", -1)):
                known = sorted(sign * x for x in v if x is not None)
                for n, p in ps.items():
                    at = p * (len(known) - 1)
                    low, high = math.floor(at), math.ceil(at)
                    want = None if not known else known[low] if known[low] == known[high] else (high - at) * known[low] + (at - low) * known[high]
                    have = got[g][f"{c}_{n}"]
                    assert have == want or (math.isnan(have) and math.isnan(want))
    assert [tuple(r) for r in quantiles.exact(df.where("false"), {"m": ("x", 0.5)}).collect()] == [(None,)]


def test_quantiles_of_ten_million_distinct_values(spark, monkeypatch):
    """One group holds half of them; the state of a pass is a few rows, met in a salted shuffle here."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    n = 10_000_000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)).alias("g"), (F.pow(F.col("id").cast("double"), F.lit(1.5)) - 1e9).alias("x"))
    got = {r["g"]: r["m"] for r in quantiles.exact(df, {"m": ("x", 0.5)}, ["g"]).collect()}
    x = np.arange(n, dtype=float)
    for g in got:
        some = x[::2] if g == "hot" else x[(np.arange(n) % 5 == int(g[1])) & (np.arange(n) % 2 == 1)]
        assert got[g] == pytest.approx(np.median(some**1.5 - 1e9), rel=1e-12)


@pytest.mark.parametrize("n", [2, 5, 9])
def test_signed_rank_p_value_by_all_signs(spark, n):
    ranks = np.arange(1, n + 1)
    sums = [int(ranks[np.array(s, bool)].sum()) for s in itertools.product([0, 1], repeat=n)]
    for signs in itertools.islice(itertools.product([1, -1], repeat=n), 0, None, max(1, 2**n // 16)):
        d = ranks * np.array(signs)
        w = min(d[d > 0].sum(), -d[d < 0].sum())
        assert stats.signed_rank_p(n, n, float(w), 0.0) == pytest.approx(min(1.0, 2 * np.mean(np.array(sums) <= w)), abs=1e-12)


def test_five_folds_of_one_sign_are_not_significant(spark):
    df = spark.createDataFrame([(m, b, 0.1 * b * b + k * (0.5 + 0.01 * b)) for k, m in enumerate("ab") for b in range(5)], "method string, block int, score double")
    r = stats.all_pairs(df, "method", "block", "score").first()
    assert (r["p_value"], r["exact"], r["significant"]) == (0.0625, True, False)
    assert abs(stats.signed_rank_p(50, 50, 434.0, 0.0) - stats.signed_rank_p(51, 50, 434.0, 0.0)) < 0.005  # the tail joins the exact values


def planted(spark, groups: int, size: int):
    """Rings of near complete groups, one link between neighbours."""
    e = [(g * size + i, g * size + j) for g in range(groups) for i in range(size) for j in range(i) if (i * 7 + j) % 5]
    return spark.createDataFrame(e + [(g * size, (g + 1) % groups * size + 1) for g in range(groups)], "src long, dst long")


def test_communities_find_planted_groups(spark, monkeypatch):
    edges = planted(spark, 12, 8)
    found = communities.find(edges, (1.0,)).collect()
    assert {tuple(sorted(r["cell_id"] for r in v)) for _, v in itertools.groupby(sorted(found, key=lambda r: r["community"]), key=lambda r: r["community"])} == {tuple(range(g * 8, g * 8 + 8)) for g in range(12)}
    assert communities.find(edges.limit(0)).count() == 0
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    assert sorted(communities.find(edges, (1.0,)).collect()) == sorted(found)


def test_communities_of_many_nodes_are_not_broadcast(spark, monkeypatch):
    edges = planted(spark, 4, 8)
    links = communities.stored(communities.links_of(edges, (1.0,)))
    state = communities.stored(links.groupBy("gamma", F.col("src").alias("node")).agg(F.sum("w").alias("k")).withColumns({"loop": F.lit(0.0), "community": F.col("node")}))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 0)
    looked = communities.look(links, state, 32, 1.0)
    assert "Broadcast" not in looked._jdf.queryExecution().executedPlan().toString()


def test_communities_at_three_resolutions(spark):
    edges = spark.createDataFrame(embed.knn(emb(spark, SF).where("cell_id < 200"), 8).collect())
    found = spark.createDataFrame(communities.find(edges).collect())
    n = {r["resolution"]: r for r in communities.counts(found).collect()}
    assert n[0.5]["n_clusters"] <= n[1.0]["n_clusters"] <= n[1.5]["n_clusters"] and n[0.5]["n_clusters"] < n[1.5]["n_clusters"]
    assert {r["n_cells"] for r in n.values()} == {200}
    plain = embed.modularity(edges, embed.communities(edges), "community").first()[0]
    mine = embed.modularity(edges, found.where("resolution = 1.0"), "community").first()[0]
    assert mine >= plain and mine > 0.25


def test_components_of_the_sparse_matrix(spark):
    """Against a dense solution: eigenvalues within 1 %, the same spans, distances of cells; cells and genes without counts."""
    rng = np.random.default_rng(3)
    x = rng.poisson(0.3, (120, 3)) @ rng.poisson(1.0, (3, 90)) * rng.integers(0, 2, (120, 90)) + rng.poisson(0.05, (120, 90)).astype(float)
    x[7] = 0
    expr = spark.createDataFrame([(int(i), f"g{j}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id string, value double")
    got, share = sparse_pca.components(expr, spark.range(120).withColumnRenamed("id", "cell_id"), 5)
    y = np.array([r["vec"] for r in got.orderBy("cell_id").collect()])
    c = x - x.mean(0)
    u, s, v = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(share, s[:5] ** 2 / (s**2).sum(), rtol=0.01)
    angles = np.linalg.svd(np.linalg.qr(y)[0].T @ u[:, :5])[1]
    assert angles[:3].min() > 0.999
    assert np.allclose(np.abs(y[:, 0]), np.abs(c @ v[0]), rtol=0.01, atol=0.02)
    none, share = sparse_pca.components(expr.limit(0), spark.range(3).withColumnRenamed("id", "cell_id"), 5)
    assert [r["vec"] for r in none.collect()] == [[], [], []] and share == []


def test_components_send_no_row_a_gene_to_the_driver(spark, monkeypatch):
    """Cells in many groups, counts in many pieces: the dense solution, from fewer rows at the driver than genes, and without broadcasts of a basis."""
    rng = np.random.default_rng(4)
    x = rng.poisson(0.5, (80, 4)) @ rng.poisson(0.6, (4, 700)) * rng.integers(0, 2, (80, 700)) + 0.0
    x[:, 5] += 3  # a gene that all cells have
    expr = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "cell_id long, gene_id long, value double")
    rows, collect, frame = [], type(expr).toPandas, type(expr)
    monkeypatch.setattr(frame, "toPandas", lambda self: rows.append(len(out := collect(self))) or out)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: pytest.fail("broadcast"))
    for name, size in (("COUNTS", 3000), ("PIECE", 512), ("STORED", 300)):
        monkeypatch.setattr(sparse_pca, name, size, raising=False)
    got, share = sparse_pca.components(expr, spark.range(80).withColumnRenamed("id", "cell_id"), 3, extra=2)
    y = np.array([r["vec"] for r in got.orderBy("cell_id").collect()])
    u, s, _ = np.linalg.svd(x - x.mean(0), full_matrices=False)
    assert np.allclose(share, s[:3] ** 2 / (s**2).sum(), rtol=1e-3)
    assert np.allclose(np.abs(y), np.abs(u[:, :3] * s[:3]), rtol=0.02, atol=0.02 * s[0] / 9)
    assert max(rows, default=0) < 700


def test_poisson_bootstrap_agrees_with_drawn_rows(spark):
    """Intervals of small groups as by whole draws, a group of a million values in many tasks, and repeated runs alike."""
    rng = np.random.default_rng(5)
    rows = [(g, i, float(x)) for g in ("a", None) for i, x in enumerate(rng.gamma(2.0, 3.0, 400))] + [("one", 0, 5.0)]
    df = spark.createDataFrame(rows, "g string, i int, x double")
    drawn = {r["g"]: r for r in stats.bca(df.where("g = 'a'"), ["g"], ["i"], "x").collect()}
    mine = {r["g"]: r for r in stats.bca_large(df.where("g IS NOT NULL"), ["g"], ["i"], "x").collect()}
    assert mine["a"]["estimate"] == pytest.approx(drawn["a"]["estimate"]) and mine["a"]["acceleration"] == pytest.approx(drawn["a"]["acceleration"])
    width = drawn["a"]["high"] - drawn["a"]["low"]
    assert abs(mine["a"]["low"] - drawn["a"]["low"]) < 0.12 * width and abs(mine["a"]["high"] - drawn["a"]["high"]) < 0.12 * width
    assert mine["one"]["low"] == mine["one"]["high"] == 5.0
    means = stats.poisson_resamples(df, ["g"], ["i"], "x", 50)
    again = {(r["g"], r["b"]): r["mean"] for r in stats.poisson_resamples(df.repartition(7), ["g"], ["i"], "x", 50).collect()}
    assert {(r["g"], r["b"]): pytest.approx(r["mean"]) for r in means.collect()} == again
    many = spark.range(1_000_000).select(F.lit("g").alias("g"), "id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("x"))
    r = stats.bca_large(many, ["g"], ["id"], "x").first()
    sd = 1000 / math.sqrt(12) / 1000
    assert r["high"] - r["low"] == pytest.approx(2 * 1.96 * sd, rel=0.1)


def test_calibrated_margins_beat_raw_shares(spark):
    """The Brier score of held-out rows, against a softmax of the margins as they are."""
    from cellgrain.operators import models, splits

    rng = np.random.default_rng(7)
    y = rng.integers(0, 3, 360)
    x = np.eye(3)[y] * 1.2 + rng.normal(0, 1, (360, 3))
    df = splits.stratified(spark.createDataFrame([(i, str(y[i]), x[i].tolist()) for i in range(360)], "cell_id long, label string, vec array<double>"), "label", "cell_id")
    train, test = df.where("not is_test").drop("is_test"), df.where("is_test").drop("is_test")
    model = models.CalibratedMargins(train)
    got = model.predict(test).collect()
    raw = {r["cell_id"]: np.exp(np.array(r["_margins"])[:3]) for r in model.margins(model.model, test).collect()}
    truth = lambda r: np.eye(3)[int(r["label"])]
    assert all(abs(sum(r["class_probability"]) - 1) < 1e-6 and len(r["class_probability"]) == 3 for r in got)
    brier = np.mean([((np.array(r["class_probability"]) - truth(r)) ** 2).sum() for r in got])
    assert brier < np.mean([((raw[r["cell_id"]] / raw[r["cell_id"]].sum() - truth(r)) ** 2).sum() for r in got]) and brier < 0.6


def test_reference_model_labels_cells_with_missing_genes(spark):
    """Trained on one table, stored as rows, applied to cells that lack a quarter of its genes and know others."""
    from cellgrain.operators import reference_model

    rng = np.random.default_rng(11)
    kinds = rng.integers(0, 3, 240)
    rows = [(i, f"g{j}", float(1 + rng.poisson(4 if j % 3 == kinds[i] else 0.3))) for i in range(240) for j in range(12)]
    expr = spark.createDataFrame(rows, "cell_id long, gene_id string, value double")
    cells = spark.createDataFrame([(i, f"kind{kinds[i]}") for i in range(240)], "cell_id long, cell_type string")
    genes = spark.createDataFrame([(f"g{j}",) for j in range(12)], "gene_id string")
    model = reference_model.train(expr.where("cell_id < 160"), cells, "cell_type", genes)
    assert model.count() == 3 * 13
    query = expr.where("cell_id >= 160 AND gene_id NOT IN ('g0', 'g4', 'g8')").unionByName(spark.createDataFrame([(200, "other", 50.0)], expr.schema))
    assert tuple(reference_model.coverage(query.select("gene_id").distinct(), model).first()) == (12, 9)
    told = reference_model.predict(query, cells.where("cell_id >= 160"), model).join(cells, "cell_id").collect()
    assert len(told) == 80 and np.mean([r["predicted"] == r["cell_type"] for r in told]) > 0.9
    vec = spark.createDataFrame([(i, [float(kinds[i] == k) * 9 + rng.random() for k in range(3)]) for i in range(160, 240)], "cell_id long, vec array<double>")
    voted = reference_model.annotate_by_model(query, cells.where("cell_id >= 160"), model, vec, k=5, resolution=1.0).join(cells, "cell_id").collect()
    assert np.mean([r["majority_label"] == r["cell_type"] for r in voted]) >= np.mean([r["predicted"] == r["cell_type"] for r in voted])
    lone = reference_model.probabilities(query.limit(0), cells.where("cell_id = 3"), model).collect()
    assert sum(r["probability"] for r in lone) == pytest.approx(1)


def test_labels_spread_along_a_chain(spark):
    """One label at an end reaches everything that hangs together, a step a round; a lone pair stays unknown."""
    edges = spark.createDataFrame([(i, i - 1) for i in range(1, 6)] + [(10, 11)], "src long, dst long")
    labels = spark.createDataFrame([(i, "x" if i == 0 else None if i == 3 else "Unknown") for i in [*range(6), 10, 11]], "cell_id long, label string")
    got = {r["cell_id"]: (r["predicted"], r["confidence"], r["round"]) for r in embed.propagate_labels(edges, labels, "label").collect()}
    assert got == {0: ("x", 1.0, 0), **{i: ("x", 1.0, i) for i in range(1, 6)}, 10: ("Unknown", 0.0, None), 11: ("Unknown", 0.0, None)}


def test_variable_genes_may_be_ranked_by_values(spark):
    from cellgrain.operators import preprocess
    from cellgrain.plans.adapter import cells, expr, genes

    kept = {}
    for on in ("counts", "values"):
        tables, _ = preprocess.run(expr(spark, SF), cells(spark, SF), genes(spark, SF), {"min_genes": 1, "min_umi": 1, "max_mito": 100, "max_ribo": 100}, 1, n_hvg=40, hvg_on=on)
        kept[on] = {r["gene_id"] for r in tables["genes"].where("highly_variable").collect()}
    assert len(kept["counts"]) == len(kept["values"]) == 40 and kept["counts"] != kept["values"]
    with pytest.raises(ValueError, match="hvg_on"):
        preprocess.run(expr(spark, SF), cells(spark, SF), genes(spark, SF), {}, 1, hvg_on="logs")


def test_planted_doublets_are_found(spark):
    """Two kinds of cells and sums of one of each: recall and precision of 0.8 by either call."""
    from cellgrain.operators import doublets

    rng = np.random.default_rng(13)
    base = np.array([[8.0] * 12 + [0.2] * 12, [0.2] * 12 + [8.0] * 12])
    one = [rng.poisson(base[i % 2] * rng.uniform(0.7, 1.3)) for i in range(360)]
    two = [rng.poisson(base[0]) + rng.poisson(base[1]) for _ in range(24)]
    rows = [(i, f"g{j}", float(v)) for i, x in enumerate(one + two) for j, v in enumerate(x) if v]
    expr, cells = spark.createDataFrame(rows, "cell_id long, gene_id string, value double"), spark.range(384).withColumnRenamed("id", "cell_id")
    for called in (doublets.call_by_valley(expr, cells, n_genes=24), doublets.call_by_share(expr, cells)):
        hits = [r["cell_id"] for r in called.where("doublet").collect()]
        right = sum(i >= 360 for i in hits)
        assert right >= 0.8 * 24 and right >= 0.8 * len(hits)
    hist = lambda counts: spark.createDataFrame([((b + 0.5) / 50,) for b, n in counts.items() for _ in range(n)], "score double")
    assert 0.2 < doublets.valley(hist({5: 40, 6: 30, 7: 10, 30: 20, 31: 25, 32: 5})) < 0.6
    assert doublets.valley(hist({5: 40})) is None


def test_labels_tie_whatever_the_order_of_sums(spark):
    """Equal scores whose float sums differ in the last digit are ties, so the first label by alphabet wins."""
    from cellgrain.operators import reference_model

    expr = spark.createDataFrame([(1, g, 1.0) for g in range(3)], "cell_id long, gene_id long, value double")
    model = spark.createDataFrame([("a", 0, 0.3), ("a", 1, 0.2), ("a", 2, 0.1), ("b", 0, 0.6), ("a", None, 0.0), ("b", None, 5e-16)], "label string, gene_id long, weight double")
    told = reference_model.predict(expr, expr.select("cell_id").distinct(), model).first()
    assert told["predicted"] == "a" and told["confidence"] == pytest.approx(0.5)


def test_many_rows_of_a_lookup_are_not_broadcast(spark):
    """Spark's estimate of the salted table is that of the table alone."""
    right = spark.range(200_000).withColumnRenamed("id", "k").withColumn("w", F.col("k") * 2)
    joined = joins.lookup(spark.range(10).select(F.col("id").alias("k")), right, ["k"], ["k"], "inner")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SortMergeJoin" in plan and "BuildRight" not in plan
    assert sorted((r["k"], r["w"]) for r in joined.collect()) == [(i, 2 * i) for i in range(10)]


def test_doublet_profiles_come_from_one_small_row_a_cell(spark):
    """Simulated cells are sums of two cells' totals and selected counts; the whole matrix isn't made again for them."""
    from cellgrain.operators import doublets

    expr = spark.createDataFrame([(1, "a", 3.0), (1, "x", 7.0), (2, "a", 2.0), (2, "b", 8.0), (3, "x", 5.0)], "cell_id long, gene_id string, value double")
    rows, n = doublets.selected(expr, spark.createDataFrame([("a",), ("b",)], "gene_id string"))
    assert n == 2 and {r["cell_id"]: (r["lib"], len(r["few"])) for r in rows.collect()} == {1: (10.0, 1), 2: (10.0, 2), 3: (5.0, 0)}
    pair = spark.createDataFrame([(1, "sim_0"), (2, "sim_0"), (3, "sim_1"), (4, "sim_1")], "cell_id long, sim_id string")
    sims = doublets.simulated(rows, pair)
    assert [(r["cell_id"], r["vec"]) for r in doublets.profiles(sims, n).collect()] == [("sim_0", [pytest.approx(math.log1p(5 * 1e4 / 20)), pytest.approx(math.log1p(8 * 1e4 / 20))])]
    assert {r["cell_id"]: r["vec"] for r in doublets.profiles(rows, n).collect()} == {1: [pytest.approx(math.log1p(3000)), 0.0], 2: [pytest.approx(math.log1p(2000)), pytest.approx(math.log1p(8000))]}
