"""Cross-validation of linear classifiers in one pass for all folds: a round reads the rows once, whatever the number of folds.

Each fold's model is fitted on the other folds' rows, scaled by these rows' means and deviations only, with weights that balance
its classes. Losses: the multinomial logistic one (``lr``), or squared hinges of one class against the rest (``svm``), plus ridge / 2 times
the squared scaled coefficients. Limited-memory quasi-Newton searches run side by side, one a fold: each asks for the loss and gradient
at its next point, all points go to the tasks together, and sums of folds * classes * dimensions numbers come back. Folds that stand still drop out.

Cases: rows without a label or a vector are left out; a class that a training part lacks has no weight there (its rows are
still tested); a dimension without spread gets no coefficient; repeated rows count each; of an empty table nothing comes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellgrain.operators import splits
from cellgrain.sources.layers import stored

KINDS = ("lr", "svm")


class Search:
    """A limited-memory quasi-Newton search that is told values from outside: ``trial`` is the point to be valued next,
    ``best`` the last one taken."""

    def __init__(self, start: np.ndarray, memory: int = 10, tolerance: float = 1e-6):
        self.trial, self.best, self.memory, self.tolerance = start, start, memory, tolerance
        self.value, self.slope, self.pairs, self.done = np.inf, None, [], False

    def tell(self, value: float, slope: np.ndarray) -> None:
        if self.slope is not None and not value <= self.value + 1e-4 * self.step * float(self.slope @ self.direction):
            self.step /= 2
            self.done = self.step < 1e-10
            self.trial = self.best + self.step * self.direction
            return
        if self.slope is not None:
            s, y = self.trial - self.best, slope - self.slope
            if s @ y > 1e-12 * (y @ y):
                self.pairs = [*self.pairs[1 - self.memory :], (s, y)]
            self.done = self.value - value <= self.tolerance * max(abs(value), 1e-12)
        self.best, self.value, self.slope = self.trial, value, slope
        self.done |= float(np.abs(slope).max(initial=0)) < 1e-10
        self.direction = -self.bent(slope)
        self.step = 1.0 if self.pairs else 1 / max(1.0, float(np.linalg.norm(slope)))
        self.trial = self.best + self.step * self.direction

    def bent(self, q: np.ndarray) -> np.ndarray:
        """The inverse curvature of the remembered steps, applied to a slope."""
        parts = []
        for s, y in reversed(self.pairs):
            parts.append((s @ q) / (s @ y))
            q = q - parts[-1] * y
        if self.pairs:
            s, y = self.pairs[-1]
            q = q * (s @ y) / (y @ y)
        for (s, y), part in zip(self.pairs, reversed(parts), strict=True):
            q = q + s * (part - (y @ q) / (s @ y))
        return q


@dataclass
class FoldModels:
    """Linear models of all folds: scores are x @ weights[fold].T + bias[fold], a column a class."""

    rows: DataFrame
    kind: str
    classes: list[str]
    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    losses: list[float]
    passes: int


def arrays(found: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, classes and folds of a batch's rows."""
    x = found.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, -1)
    return x, found.column("_class").to_numpy(zero_copy_only=False), found.column("fold").to_numpy(zero_copy_only=False)


def added(rows: DataFrame, partial, size: int) -> np.ndarray:
    """Sums over all batches of ``partial`` (vectors, classes, folds -> array of ``size`` numbers), added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for found in batches:
            if found.num_rows:
                total += partial(*arrays(found))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["at", "x"])

    out = np.zeros(size)
    for r in rows.select("vec", "_class", "fold").mapInArrow(run, "at long, x double").groupBy("at").agg(F.sum("x").alias("x")).collect():
        out[r["at"]] = r["x"]
    return out


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def fit(df: DataFrame, kind: str, label: str = "label", key: str = "cell_id", folds: int = 5, seed: int = 42, ridge: float = 1e-3, passes: int = 200, tolerance: float = 1e-6) -> FoldModels | None:
    """A model for each stratified fold; None of an empty table. ``passes`` bounds the readings of the rows, of which each search
    takes its best point; ``tolerance`` is the relative gain at which one ends."""
    if kind not in KINDS:
        raise ValueError(f"kind {kind!r} is none of {KINDS}")
    known = df.where(F.col(label).isNotNull() & F.col("vec").isNotNull()).select(key, F.col(label).cast("string").alias("_label"), F.col("vec").cast("array<double>").alias("vec"))
    classes = [r["_label"] for r in known.select("_label").distinct().orderBy("_label").collect()]  # labels
    if not classes:
        return None
    of = F.array_position(F.array(*(F.lit(x) for x in classes)), F.col("_label")) - 1
    rows = stored(splits.stratified(known, "_label", key, parts=folds, seed=seed).select(key, "_label", "vec", of.cast("int").alias("_class"), F.col("fold").cast("int")))
    k, dim = len(classes), rows.select(F.size("vec").alias("n")).head()["n"]

    def moments(x: np.ndarray, y: np.ndarray, f: np.ndarray) -> np.ndarray:
        out = np.zeros((folds, k + 2 * dim))
        np.add.at(out, (f, y), 1)
        np.add.at(out[:, k : k + dim], f, x)
        np.add.at(out[:, k + dim :], f, x * x)
        return out.ravel()

    found = added(rows, moments, folds * (k + 2 * dim)).reshape(folds, -1)
    train = found.sum(axis=0) - found  # all other folds' sums
    held, n = train[:, :k], np.maximum(train[:, :k].sum(axis=1, keepdims=True), 1)
    mean = train[:, k : k + dim] / n
    spread = np.maximum(train[:, k + dim :] - n * mean**2, 0)
    deviation = np.sqrt(np.where(spread > 1e-12 * train[:, k + dim :], spread, 0) / np.maximum(n - 1, 1))
    inverse = np.divide(1, deviation, out=np.zeros_like(deviation), where=deviation > 0)
    present = np.maximum((held > 0).sum(axis=1, keepdims=True), 1)
    weight = np.divide(1.0, present * held, out=np.zeros_like(held), where=held > 0)  # of a fold's training rows, adding up to 1

    def plain(points: list[np.ndarray], active: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients and intercepts for unscaled vectors."""
        w = np.stack([p[: k * dim].reshape(k, dim) * inverse[i] for p, i in zip(points, active, strict=True)])
        b = np.stack([p[k * dim :] for p in points]) - np.einsum("fkd,fd->fk", w, mean[active])
        return w, b

    searches = [Search(np.zeros(k * dim + k), tolerance=tolerance) for _ in range(folds)]
    taken = 0
    while taken < passes and (active := [i for i, s in enumerate(searches) if not s.done]):
        points = [searches[i].trial for i in active]
        w, b = plain(points, active)
        mine = weight[active]

        def slopes(x: np.ndarray, y: np.ndarray, f: np.ndarray, w=w, b=b, mine=mine, active=tuple(active)) -> np.ndarray:
            m = len(active)
            share = mine[:, y] * (f[None, :] != np.array(active)[:, None])  # fold, row
            z = (x @ w.reshape(m * k, dim).T).reshape(len(x), m, k).transpose(1, 0, 2) + b[:, None, :]
            true = np.eye(k)[y]
            if kind == "lr":
                top = z.max(axis=2, keepdims=True)
                loss = (np.log(np.exp(z - top).sum(axis=2)) + top[:, :, 0] - (z * true).sum(axis=2)) * share
                part = (softmax(z) - true) * share[:, :, None]
            else:
                sign = 2 * true - 1
                short = np.maximum(1 - sign * z, 0)
                loss = (short**2).sum(axis=2) * share
                part = -2 * sign * short * share[:, :, None]
            by_x = (part.transpose(0, 2, 1).reshape(m * k, -1) @ x).reshape(m, k * dim)
            return np.concatenate([loss.sum(axis=1, keepdims=True), by_x, part.sum(axis=1)], axis=1).ravel()

        sums = added(rows, slopes, len(active) * (1 + k * dim + k)).reshape(len(active), -1)
        taken += 1
        for i, point, s in zip(active, points, sums, strict=True):
            coefficients, by_bias = point[: k * dim], s[1 + k * dim :]
            by_w = (s[1 : 1 + k * dim].reshape(k, dim) - by_bias[:, None] * mean[i]) * inverse[i]
            searches[i].tell(s[0] + ridge / 2 * float(coefficients @ coefficients), np.concatenate([by_w.ravel() + ridge * coefficients, by_bias]))
    w, b = plain([s.best for s in searches], list(range(folds)))
    return FoldModels(rows, kind, classes, mean, deviation, w, b, [float(s.value) for s in searches], taken)


def scalers(models: FoldModels) -> DataFrame:
    """fold, k (from 0), mean, deviation of the training rows: folds * dimensions rows."""
    rows = [(i, j, float(models.mean[i, j]), float(models.deviation[i, j])) for i, j in np.ndindex(models.mean.shape)]
    return models.rows.sparkSession.createDataFrame(rows, "fold int, k int, mean double, deviation double")


def out_of_fold(models: FoldModels, key: str = "cell_id") -> DataFrame:
    """key, label, fold, predicted, scores: each row by the model that hasn't seen it. Scores are probabilities (lr) or
    margins (svm), in the order of the classes."""
    w, b, names, lr = models.weights, models.bias, np.array(models.classes, object), models.kind == "lr"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            if not found.num_rows:
                continue
            x, _, f = arrays(found)
            z = np.zeros((len(x), len(names)))
            for i in np.unique(f):
                z[f == i] = x[f == i] @ w[i].T + b[i]
            out = softmax(z) if lr else z
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, len(names)), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([found.column(key), found.column("_label"), found.column("fold"), pa.array(names[z.argmax(axis=1)], pa.string()), lists], names=[key, "label", "fold", "predicted", "scores"])

    return models.rows.mapInArrow(run, f"{key} {dict(models.rows.dtypes)[key]}, label string, fold int, predicted string, scores array<double>")


def cross_validate(df: DataFrame, kind: str, label: str = "label", key: str = "cell_id", **options) -> DataFrame:
    """model, fold, part (train, test), accuracy, balanced_accuracy; all folds' models judge a row in one pass."""
    models = fit(df, kind, label, key, **options)
    if models is None:
        return df.sparkSession.createDataFrame([], "model string, fold int, part string, accuracy double, balanced_accuracy double")
    w, b = models.weights, models.bias
    folds, k = b.shape

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((folds, 2, k, 2), np.int64)  # fold, tested, class, hit
        for found in batches:
            if found.num_rows:
                x, y, f = arrays(found)
                for i in range(folds):
                    np.add.at(n[i], ((f == i).astype(int), y, ((x @ w[i].T + b[i]).argmax(axis=1) == y).astype(int)), 1)
        at = np.argwhere(n)
        yield pa.RecordBatch.from_arrays([*(pa.array(at[:, j].astype(np.int32)) for j in range(4)), pa.array(n[n != 0])], names=["fold", "tested", "y", "hit", "n"])

    by_class = models.rows.mapInArrow(judge, "fold int, tested int, y int, hit int, n long").groupBy("fold", "tested", "y").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("hit")).alias("hits"))
    part = F.when(F.col("tested") == 1, "test").otherwise("train").alias("part")
    return by_class.groupBy("fold", "tested").agg((F.sum("hits") / F.sum("n")).alias("accuracy"), F.avg(F.col("hits") / F.col("n")).alias("balanced_accuracy")).select(F.lit(kind).alias("model"), "fold", part, "accuracy", "balanced_accuracy")
