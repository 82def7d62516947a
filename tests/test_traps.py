"""Hand-made rows for cases where a plain reading of an operator goes wrong."""

import math

import pytest
from pyspark.sql import functions as F

from cellgrain.functions import metadata
from cellgrain.operators import ambient, annotate, doublets, embed, metrics, normalize, pseudobulk, qc, splits, stats, trials


def rows(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(scope="module")
def tiny(spark):
    expr = spark.createDataFrame([("a", "MT-1", 2.0), ("a", "G1", 6.0), ("b", "G1", 1.0), ("b", "RPS6", 3.0), ("c", "G1", 5.0)], "cell_id string, gene_id string, value double")
    cells = spark.createDataFrame([(x,) for x in "abcd"], "cell_id string")
    genes = spark.createDataFrame([(x,) for x in ("MT-1", "G1", "RPS6", "mt-2", "RPA1", "MRPS1")], "gene_id string")
    return expr, cells, qc.gene_flags(genes)


def test_flags(tiny):
    assert rows(tiny[2], "gene_id", "mito", "ribo") == [("G1", False, False), ("MRPS1", False, False), ("MT-1", True, False), ("RPA1", False, False), ("RPS6", False, True), ("mt-2", False, False)]


def test_empty_cell_has_zeros_and_fails(tiny):
    m = qc.cell_metrics(*tiny)
    d = {r["cell_id"]: r for r in m.collect()}
    assert (d["d"]["n_genes_by_counts"], d["d"]["total_counts"], d["d"]["pct_counts_mito"]) == (0, 0, None)
    assert d["a"]["pct_counts_mito"] == 25 and d["b"]["pct_counts_ribo"] == 75
    assert rows(qc.filter_cells(m, min_genes=0, max_genes=9, min_umis_per_cell=0, max_mito=100, max_ribo=80), "cell_id") == [("a",), ("b",), ("c",)]


def test_gene_filter_uses_all_cells(tiny):
    expr, cells, genes = tiny
    kept = qc.filter_genes(qc.gene_metrics(expr, cells, genes), 3)
    assert rows(qc.restrict(expr, cells.where("cell_id = 'a'"), kept), "cell_id", "gene_id") == [("a", "G1")]


def test_soupx(tiny):
    expr, cells, _ = tiny
    assert rows(ambient.soupx_fraction(expr, cells), "cell_id", "rho") == [("a", 0.9), ("b", 0.9), ("c", 0.9), ("d", 0.0)]
    assert all(r["value"] > 0 for r in ambient.soupx_correct(expr, cells).collect())


def test_background_is_strictly_under_the_quantile(tiny):
    # Means 0, 0, 0, 0.5, 0.75, 3: the quantile is 0, and none is under it.
    assert ambient.background_genes(*tiny).count() == 0
    with pytest.raises(ValueError):
        ambient.correct(*tiny, method="other")


def test_log_normalize(tiny):
    got = {(r["cell_id"], r["gene_id"]): r["value"] for r in normalize.log_normalize(tiny[0]).collect()}
    assert got["a", "MT-1"] == pytest.approx(math.log1p(2500)) and got["c", "G1"] == pytest.approx(math.log1p(1e4))


def test_scran_factor_by_hand(spark):
    # All totals are 4, so all cells are peers; the median of g over them is 2, of h 2.
    expr = spark.createDataFrame([(1, "g", 2.0), (1, "h", 2.0), (2, "g", 2.0), (2, "h", 2.0), (3, "g", 4.0)], "cell_id int, gene_id string, value double")
    cells = spark.createDataFrame([(1,), (2,), (3,), (4,)], "cell_id int")
    got = {r[0]: r[1] for r in normalize.scran_factors(expr, cells).collect()}
    assert got[1] == pytest.approx(2 / 3) and got[3] == pytest.approx(4 / 3) and got[4] == 0.5


def test_variance_trend_keeps_a_parabola(spark):
    import numpy as np
    from pyspark.sql import functions as F

    for n in (40, 20_000):  # fewer genes than cells of the grid, and more
        m = spark.range(n).select(F.col("id").alias("gene_id"), F.pow(F.lit(10.0), F.col("id") / n).alias("mean"), (F.col("id") / n).alias("_t"))
        m = m.withColumn("var", F.pow(F.lit(10.0), 1 + F.col("_t") - 3 * F.col("_t") ** 2))
        rows = normalize.variance_trend(m).select(F.log10(F.col("reg_std") ** 2).alias("got"), F.log10("var").alias("want")).collect()
        assert len(rows) == n and np.allclose([r["got"] for r in rows], [r["want"] for r in rows], atol=1e-6)


def test_variance_trend_is_a_local_fit(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    x = np.sort(rng.uniform(-2, 2, 60))
    y = np.sin(2 * x) + rng.normal(0, 0.1, 60)
    rows = [(i, float(10**a), float(10**b)) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [(60, 0.0, 0.0), (61, 1.0, 0.0)]
    got = {r["gene_id"]: r["reg_std"] for r in normalize.variance_trend(spark.createDataFrame(rows, "gene_id int, mean double, var double")).collect()}
    assert got[60] == got[61] == 0
    for i in range(60):  # one point a cell of the grid but for chance: 18 nearest points, tricube weights, second degree
        d = np.abs(x - x[i])
        h = np.sort(d)[17]
        w = np.where(d <= h, (1 - np.minimum(d / h, 1) ** 3) ** 3, 0)
        assert np.log10(got[i] ** 2) == pytest.approx(np.polynomial.polynomial.polyfit(x - x[i], y, 2, w=np.sqrt(w))[0], abs=0.02)


def test_variance_trend_of_few_or_equal_genes(spark):
    few = spark.createDataFrame([(1, 2.0, 3.0), (2, 1.0, 0.0)], "gene_id int, mean double, var double")
    assert {r["reg_std"] for r in normalize.variance_trend(few).collect()} == {0.0}
    same = spark.createDataFrame([(i, 2.0, 9.0) for i in range(5)], "gene_id int, mean double, var double")
    assert [r["reg_std"] for r in normalize.variance_trend(same).collect()] == pytest.approx([3.0] * 5)


@pytest.mark.parametrize(("name", "want"), [("Patient_3_cell_1", "Patient_3"), ("P01", "P01"), ("MM_7", "MM_7")])
def test_patient(spark, name, want):
    assert spark.range(1).select(metadata.patient_id(F.lit(name)).alias("x")).first()["x"] == want


def test_unknown_patient_is_stable(spark):
    x = [spark.range(1).select(metadata.patient_id(F.lit("xyz"))).first()[0] for _ in range(2)]
    assert x[0] == x[1] and 0 <= int(x[0].removeprefix("unknown_")) < 1000


@pytest.mark.parametrize(("status", "plain", "strict"), [("SMM", "MM", "SMM"), ("smoldering myeloma", "MM", "SMM"), ("smoldering", "SMM", "SMM"), ("MGUS", "MGUS", "MGUS"), ("Healthy donor", "healthy", "healthy"), ("x", "unknown", "unknown")])
def test_sample_type(spark, status, plain, strict):
    r = spark.range(1).select(metadata.sample_type(F.lit(status)).alias("p"), metadata.sample_type(F.lit(status), True).alias("s")).first()
    assert (r["p"], r["s"]) == (plain, strict)


def test_technology(spark):
    r = spark.range(1).select(metadata.technology(F.lit("10x Genomics")), metadata.technology(F.lit("SmartSeq2")), metadata.technology(F.lit(None).cast("string"))).first()
    assert list(r) == ["10x_genomics genomics", "smart_seq2", "unknown"]


def test_assign_skips_nan_and_breaks_ties_by_order(spark):
    s = spark.createDataFrame([(1, "A", 0, float("nan")), (1, "B", 1, 0.6), (2, "A", 0, 0.1), (2, "B", 1, 0.4), (3, "A", 0, 0.7), (3, "B", 1, 0.7), (4, "A", 0, None)], "cell_id int, cell_type string, set_order int, score double")
    assert [(r[0], r[1]) for r in sorted(annotate.assign(s).collect())] == [(1, "B"), (2, "Unknown"), (3, "A"), (4, "Unknown")]


def test_votes(spark):
    v = spark.createDataFrame([("B", "T", "P"), ("", "T", None), (None, None, None), ("T", "T", "B")], "a string, b string, c string")
    free = [tuple(r)[3:6] for r in annotate.consensus(v, ["a", "b", "c"]).collect()]
    assert [(x, round(y, 6), z) for x, y, z in free] == [("B", 0.333333, 1), ("T", 1.0, 1), ("Unknown", 0.0, 0), ("T", 0.666667, 2)]
    assert tuple(annotate.build_consensus(v, ["a", "b", "c"]).collect()[1])[3:6] == ("", 0.5, 1)
    with pytest.raises(ValueError):
        annotate.build_consensus(v, ["a"])
    with pytest.raises(ValueError):
        annotate.build_consensus(v, ["a", "nope"])


def test_ontology(spark):
    onto = annotate.ontology_table(spark)
    assert onto.count() == 69
    df = spark.createDataFrame([(" b CELL ",), ("odd ",), (None,)], "label string")
    assert [r["cl_id"] for r in annotate.map_labels(df, "label", onto).collect()] == ["CL:0000236", "odd ", None]
    assert [r["cl_id"] for r in annotate.map_labels(df, "label", onto, keep_unmapped=False).collect()][1:] == ["CL:0000000"] * 2
    names = {r["cl_id"]: (r["first_label"], r["last_label"]) for r in annotate.label_names(onto).collect()}
    assert names["CL:0000786"] == ("Plasma cell", "Plasmacyte")


def test_markers_share_a_gene(spark):
    m = annotate.marker_table(spark)
    assert m.where("gene_id = 'KIT'").count() == 2
    expr = spark.createDataFrame([(1, "KIT", 3.0)], "cell_id int, gene_id string, value double")
    genes = spark.createDataFrame([("KIT",), ("CD34",)], "gene_id string")
    got = {r["cell_type"]: r["score"] for r in annotate.marker_scores(expr, expr.select("cell_id"), genes, m).collect()}
    assert got["Mast cells"] == 3.0 and got["HSC/progenitors"] == 1.5 and got["T cells"] is None


def test_pseudobulk(spark):
    expr = spark.createDataFrame([(1, "g", 2.0), (2, "g", 3.0), (4, "g", 9.0)], "cell_id int, gene_id string, value double")
    cells = spark.createDataFrame([(1, "P1", "T"), (2, "P1", "T"), (3, "P2", "B"), (4, None, "B")], "cell_id int, patient_id string, cell_type string")
    keys = ["patient_id", "cell_type"]
    assert rows(pseudobulk.aggregate(expr, cells, keys), *keys, "value") == [("P1", "T", 5.0)]
    assert rows(pseudobulk.group_sizes(cells, keys), *keys, "n_cells") == [("P1", "T", 2), ("P2", "B", 1)]
    assert rows(pseudobulk.wide(expr, cells, keys, ["g"]), *keys, "n_cells", "g") == [("P1", "T", 2, 5.0), ("P2", "B", 1, 0.0)]
    with pytest.raises(ValueError):
        pseudobulk.aggregate(expr, cells, ["nope"])


def test_label_metrics(spark):
    same = spark.createDataFrame([(i // 3, i // 3) for i in range(9)], "t int, p int")
    assert metrics.ari(same, "t", "p").first()[0] == 1.0 and metrics.nmi(same, "t", "p").first()[0] == pytest.approx(1.0)
    one = spark.createDataFrame([(1, 1), (1, 1)], "t int, p int")
    assert metrics.ari(one, "t", "p").first()[0] == 1.0 and metrics.nmi(one, "t", "p").first()[0] == 1.0
    pairs = spark.createDataFrame(list(zip("0001122222", "0000022000", strict=True)), "t string, p string")
    types = spark.createDataFrame([("0",), ("1",), ("2",), ("9",)], "cell_type string")
    assert rows(metrics.rare_recall(pairs, "t", "p", types), "cell_type", "recall") == [("0", 1.0), ("1", 0.0), ("2", 0.4), ("9", 0.0)]


def points(spark):
    data = [(30 * c + i, [float(5 * c * (-1) ** c) + ((i * 7 + k * 3) % 11) / 11 for k in range(10)], c) for c in range(3) for i in range(30)]
    return spark.createDataFrame(data, "cell_id long, vec array<double>, cell_type int")


@pytest.mark.parametrize("block", [7, 2048])
def test_neighbours_do_not_depend_on_blocks(spark, block):
    import numpy as np

    e = points(spark)
    data = sorted((r["cell_id"], r["vec"]) for r in e.collect())
    x = np.array([v for _, v in data])
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    np.fill_diagonal(d, np.inf)
    got = {(r["src"], r["rank"]): r["dist"] for r in embed.knn(e, 4, size=block).collect()}
    want = np.sort(d, axis=1)[:, :4]
    assert all(abs(got[i, k + 1] - want[i, k]) < 1e-6 for i in range(90) for k in range(4))


def test_neighbours_of_copies_and_texts(spark):
    """Copies are at distance 0 (not at the root of a rounding error), by the least ids; ids may be texts."""
    e = spark.createDataFrame([(f"c{i:03}", [0.1 * j + 0.3 * (i % 3 == 0) for j in range(8)]) for i in range(60)], "cell_id string, vec array<double>")
    got = {}
    for r in embed.knn(e, 5, size=9).collect():
        got.setdefault(r["src"], {})[r["rank"]] = (r["dst"], r["dist"])
    for i in range(60):
        same = [f"c{j:03}" for j in range(60) if (j % 3 == 0) == (i % 3 == 0) and j != i]
        assert got[f"c{i:03}"] == {k + 1: (same[k], 0.0) for k in range(5)}


def test_exact_search_gives_a_row_a_neighbour(spark):
    """A task gives k rows a point, not k for every block that the point was compared with."""
    e = spark.range(400).select(F.col("id").alias("cell_id"), F.array(F.sin("id"), F.cos(F.col("id") * 3)).alias("vec"))
    seen = embed.facing(e, 50)
    assert seen.rdd.getNumPartitions() == 8 and seen.where("_pass = 0").count() == 400 and seen.where("_pass = 1").count() == 3200
    assert embed.knn(e, 4, size=50).count() == 1600


def test_silhouettes_of_two_columns_at_once(spark):
    e = points(spark).withColumn("half", F.when(F.col("cell_id") % 9 > 0, F.pmod("cell_id", F.lit(2))))
    both = embed.silhouettes(e, ["cell_type", "half"], size=16)
    for c in ("cell_type", "half"):
        one = {r["cell_id"]: (r["label"], r["silhouette"]) for r in embed.silhouette(e, c, size=2048).collect()}
        two = {r["cell_id"]: (r["label"], r["silhouette"]) for r in both.where(F.col("column") == c).collect()}
        assert set(one) == set(two) and len(one) == (90 if c == "cell_type" else 80)
        assert all(one[k][0] == two[k][0] and abs(one[k][1] - two[k][1]) < 1e-9 for k in one)


def test_well_separated_clusters(spark):
    e = points(spark)
    g = embed.knn(e, 15)
    assert metrics.connectivity(g, e, "cell_type").first()[0] == 1.0
    s = embed.silhouette(e, "cell_type", size=16).agg(F.min("silhouette"), F.count("*")).first()
    assert s[0] > 0.5 and s[1] == 90
    assert embed.communities(g).join(e, "cell_id").groupBy("community").agg(F.count_distinct("cell_type").alias("k")).where("k > 1").count() == 0
    assert 0 <= metrics.bio_conservation(e, embed.knn(e, 15, with_self=True), "cell_type").first()[0] <= 1


def test_pca_is_centred_and_ordered(spark):
    reduced, share = embed.pca(points(spark), 3)
    assert share == sorted(share, reverse=True)
    assert all(abs(x) < 1e-9 for x in reduced.select(*(F.avg(F.col("vec")[i]) for i in range(3))).first())


def test_splits(spark):
    c = spark.createDataFrame([(i, f"P{i // 10}", "xy"[i % 2]) for i in range(100)] + [(100, None, "x")], "cell_id int, patient_id string, cell_type string")
    s = splits.patient_split(c, "patient_id", 0.15)
    assert s.count() == 100 and s.where("is_test").select("patient_id").distinct().count() == 2
    assert splits.overlap(s.where("is_test"), s.where("not is_test")).first()["disjoint"]
    f = splits.patient_folds(c, "patient_id", 20)
    assert sorted(r["fold"] for r in f.collect()) == list(range(10))
    assert splits.fold_overlap(c.join(f, "patient_id")).count() == 0
    k = splits.stratified(c, "cell_type", "cell_id", parts=5).groupBy("cell_type", "fold").count().collect()
    assert {r["count"] for r in k} <= {10, 11}


def test_statistics(spark):
    x = spark.createDataFrame([("g", i, d) for i, d in enumerate([0.0, 1.0, -1.0, 2.0, 3.0])], "grp string, block int, d double")
    r = stats.wilcoxon(x, ["grp"]).first()
    assert (r["n"], r["n_used"], r["w"]) == (5, 4, 1.5) and r["effect"] == pytest.approx(1 - 3 / 30)
    p = spark.createDataFrame([(0.01,), (0.04,), (0.5,)], "p_value double")
    assert [round(r["p_corrected"], 6) for r in stats.bonferroni(p).collect()] == [0.03, 0.12, 1.0]
    z = spark.createDataFrame([(1.959964,), (0.0,)], "z double").select(stats.normal_tail(F.col("z"))).collect()
    assert z[0][0] == pytest.approx(0.05, abs=1e-6) and z[1][0] == pytest.approx(1.0, abs=1e-6)
    assert stats.chi2_tail(5.991, 2) == pytest.approx(0.05, abs=1e-4) and stats.t_quantile(4) == pytest.approx(2.7764, abs=1e-3)
    b = stats.bca(x.withColumn("score", F.col("d")), ["grp"], ["block"], "score", 300).first()
    assert b["low"] < b["estimate"] < b["high"]


def test_logs(spark):
    t = spark.createDataFrame([(1, i, m) for i, m in enumerate([0.5, 0.6, 0.7, 0.8, 0.9] + [0.85] * 10)], "run int, trial_id int, metric double")
    assert trials.early_stop(t, ["run"]).first()["stop"] and not trials.early_stop(t.where("trial_id < 10"), ["run"]).first()["stop"]
    assert trials.improvements(t, ["run"]).first()["n_improvements"] == 4
    down = t.withColumn("trial_id", (-1000 * F.col("metric")).cast("int") * 100 + F.col("trial_id"))
    assert trials.improvements(down, ["run"]).first()["n_improvements"] == 0
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "a int, b string")
    assert trials.fingerprint(a).first() == trials.fingerprint(a.orderBy(F.desc("a"))).first() != trials.fingerprint(a.distinct()).first()


def test_doublet_consensus(spark):
    c = spark.createDataFrame([(True, False), (None, True), (False, False)], "scrublet boolean, doubletfinder boolean")
    flags = lambda **k: [r["is_doublet"] for r in doublets.consensus(c, **k).collect()]
    assert flags() == [True, True, False] and flags(require_both=True) == [False, False, False] and flags(second=None) == [True, False, False]
    with pytest.raises(ValueError):
        doublets.consensus(c.select(F.lit(1)))


def arrow_rows(ids, x, **labels):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(x.tolist(), pa.list_(pa.float64())), *(pa.array(v) for v in labels.values())], names=["cell_id", "vec", *labels])


def test_search_works_on_tiles_and_lopsided_finds(monkeypatch):
    """Distances are made a tile at a time, whatever a group has; a row with far more finds than the others (copies at the edge) gets the least ids."""
    import numpy as np

    rng, sizes = np.random.default_rng(5), []
    x = np.round(rng.normal(size=(500, 6)), 1)
    x[200:420], x[3] = x[7], x[7]
    ids = rng.permutation(500)
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 9)
    d[ids[:, None] == ids[None]] = np.inf
    look = embed.within
    monkeypatch.setattr(embed, "within", lambda part, limit: sizes.append(part.size) or look(part, limit))
    monkeypatch.setattr(embed, "NEAR_TILE", (37, 16))
    seer = embed.Nearest(arrow_rows(ids[:90], x[:90]), 9)
    for i in range(0, 500, 70):
        seer.see(arrow_rows(ids[i : i + 70], x[i : i + 70]))
    got = {(s, r): (t, v) for b in seer.out() for s, t, r, v in zip(*(b.column(c).to_pylist() for c in ("src", "dst", "rank", "dist")))}
    assert max(sizes) <= 37 * 36 and len(got) == 810
    for i in range(90):
        want = np.lexsort((ids, d[i]))[:9]
        assert [got[ids[i], k + 1] for k in range(9)] == [(ids[j], d[i, j]) for j in want]


def test_flags_are_looked_at_in_words():
    import numpy as np

    rng = np.random.default_rng(3)
    for shape in ((1, 1), (3, 5), (8, 16), (7, 33)):
        part, limit = rng.normal(size=shape).astype(np.float32), rng.normal(size=shape[0]).astype(np.float32)
        part[0, 0] = np.nan
        assert all((a == b).all() for a, b in zip(embed.within(part, limit), np.nonzero(~(part > limit[:, None]))))


def test_groups_fill_the_cores(spark):
    """More groups than cores are a multiple of them, so that no core waits for a last few groups."""
    e = spark.range(6000).select(F.col("id").alias("cell_id"), F.array(F.sin("id")).alias("vec"))
    cores = spark.sparkContext.defaultParallelism
    assert cores == 4 and embed.facing(e).rdd.getNumPartitions() == 8  # five groups of 1,024 or more


def test_sums_by_label_work_on_tiles(monkeypatch):
    """Sums of distances don't depend on tiles; rows without a label are in no sum, and a row's distance to itself is 0."""
    import numpy as np

    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(60, 5)), rng.permutation(60)
    a, b = [f"a{i % 3}" for i in range(60)], [None if i % 4 == 0 else f"b{i % 2}" for i in range(60)]
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    monkeypatch.setattr(embed, "SUM_TILE", (7, 11))
    rows = arrow_rows(ids, x, _l0=a, _l1=b)
    seer = embed.Sums(rows.slice(0, 25), 2)
    assert list(seer.see(rows)) == []
    got = {(k, i, o): (own, s) for batch in seer.out() for k, i, own, o, s in zip(*(batch.column(c).to_pylist() for c in ("_k", "cell_id", "own", "other", "s")))}
    want = {(k, ids[i], o): (labels[i], sum(d[i, j] for j in range(60) if labels[j] == o)) for k, labels in enumerate((a, b)) for i in range(25) if labels[i] for o in set(labels) - {None}}
    assert set(got) == set(want) and all(got[key][0] == want[key][0] and abs(got[key][1] - want[key][1]) < 1e-9 for key in want)
