"""One-pass cross-validation: against fits of one fold at a time, and a solution by another road."""

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from cellgrain.operators import folds, models
from cellgrain.plans.adapter import emb


@pytest.fixture(scope="module")
def made(spark):
    """Three overlapping classes of unequal size, dimensions of different scale, one without spread."""
    rng = np.random.default_rng(3)
    y = rng.choice(3, 900, p=[0.6, 0.3, 0.1])
    x = np.concatenate([np.eye(3, 6)[y] * 1.5 + rng.normal(0, 1, (900, 6)), np.full((900, 1), 7.0)], axis=1) * np.array([1, 100, 0.01, 1, 1, 1, 1]) + 5
    return spark.createDataFrame([(i, f"t{c}", v.tolist(), "x") for i, (c, v) in enumerate(zip(y, x, strict=True))], "cell_id long, label string, vec array<double>, fold string").cache()


def scaled(got, fold):
    """A fold's training rows as numpy: scaled vectors, classes, weights."""
    rows = got.rows.where(F.col("fold") != fold).collect()
    x, y = np.array([r["vec"] for r in rows]), np.array([r["_class"] for r in rows])
    sd = x.std(axis=0, ddof=1)
    z = np.where(sd > 1e-9, (x - x.mean(axis=0)) / np.where(sd > 1e-9, sd, 1), 0)
    return z, y, 1 / (3 * np.bincount(y)[y]), x.mean(axis=0), sd


def loss(kind, z, y, share, w, b, ridge):
    s, true = z @ w.T + b, np.eye(3)[y]
    if kind == "lr":
        per = np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(y)), y]
        slope = np.exp(s) / np.exp(s).sum(axis=1, keepdims=True) - true
    else:
        short = np.maximum(1 - (2 * true - 1) * s, 0)
        per, slope = (short**2).sum(axis=1), -2 * (2 * true - 1) * short
    slope *= share[:, None]
    return (per * share).sum() + ridge / 2 * (w**2).sum(), slope.T @ z + ridge * w, slope.sum(axis=0)


@pytest.mark.parametrize("kind", folds.KINDS)
def test_each_fold_is_at_its_own_minimum(made, kind):
    """Plain descent on a fold's training rows finds no lower loss, and the scaler has seen no test row."""
    got = folds.fit(made, kind, ridge=0.01)
    for fold in (0, 4):
        z, y, share, mean, sd = scaled(got, fold)
        assert np.allclose(got.mean[fold], mean) and np.allclose(got.deviation[fold][:6], sd[:6]) and got.deviation[fold][6] == 0
        w, b = np.zeros((3, 7)), np.zeros(3)
        for _ in range(3000):
            _, by_w, by_b = loss(kind, z, y, share, w, b, 0.01)
            w, b = w - 0.1 * by_w, b - 0.1 * by_b
        best = loss(kind, z, y, share, w, b, 0.01)[0]
        assert got.losses[fold] == pytest.approx(best, rel=1e-3)
        theirs, ours = z @ w.T + b, np.array([r["vec"] for r in got.rows.where(F.col("fold") != fold).collect()]) @ got.weights[fold].T + got.bias[fold]
        assert np.mean(theirs.argmax(axis=1) == ours.argmax(axis=1)) > 0.98
    assert got.passes <= 100


@pytest.mark.parametrize("kind", folds.KINDS)
def test_accuracies_are_those_of_one_fit_a_fold(made, kind):
    ours = {(r["fold"], r["part"]): r for r in folds.cross_validate(made, kind, ridge=0.01).collect()}
    theirs = {(r["fold"], r["part"]): r for r in models.cross_validate(made.drop("fold"), kind, regParam=0.01).collect()}
    assert set(ours) == set(theirs) and len(ours) == 10
    for at in ours:
        # The one-fit margins weigh no class, so their accuracy is another trade; a logistic fit's is the same.
        assert abs(ours[at]["accuracy"] - theirs[at]["accuracy"]) < (0.03 if kind == "lr" else 0.12)
        if kind == "lr":
            assert abs(ours[at]["balanced_accuracy"] - theirs[at]["balanced_accuracy"]) < 0.03


def test_rows_by_models_that_have_not_seen_them(made):
    got = folds.fit(made, "lr")
    rows = folds.out_of_fold(got).collect()
    assert sorted(r["cell_id"] for r in rows) == list(range(900))
    assert all(abs(sum(r["scores"]) - 1) < 1e-9 and got.classes[int(np.argmax(r["scores"]))] == r["predicted"] for r in rows)
    test = {r["fold"]: r["accuracy"] for r in folds.cross_validate(made, "lr").where("part = 'test'").collect()}
    for fold, accuracy in test.items():
        mine = [r for r in rows if r["fold"] == fold]
        assert accuracy == pytest.approx(np.mean([r["label"] == r["predicted"] for r in mine]))


def test_odd_tables(spark):
    schema = "cell_id long, label string, vec array<double>"
    assert folds.cross_validate(spark.createDataFrame([], schema), "lr").collect() == []
    rows = [(1, "a", [0.0]), (1, "a", [0.0]), (2, "b", [1.0]), (3, None, [1.0]), (4, "b", None), (5, "only", [3.0])]
    got = folds.fit(spark.createDataFrame(rows, schema), "svm")
    assert sorted(r["cell_id"] for r in folds.out_of_fold(got).collect()) == [1, 1, 2, 5]
    assert np.isfinite(got.weights).all() and np.isfinite(got.bias).all()
    with pytest.raises(ValueError, match="none of"):
        folds.fit(spark.createDataFrame(rows, schema), "forest")


def test_embeddings(spark):
    got = folds.cross_validate(emb(spark, SF), "lr").collect()
    assert len(got) == 10 and all(0 <= r["balanced_accuracy"] <= 1 for r in got)
    assert np.mean([r["accuracy"] for r in got if r["part"] == "train"]) > np.mean([r["accuracy"] for r in got if r["part"] == "test"])
